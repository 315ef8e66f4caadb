"""Payload files: one file for each row, and files of unsure content read back as variants."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_payloads(rows: DataFrame, path: str, name: str = "name", body: str = "body", variable: str | None = None, ending: str = ".js") -> DataFrame:
    """Write body (JSON text) of each row into the file path/name + ending and return (name, n_bytes) of what was written.

    With `variable` the file assigns to that name of the window object. A name
    must be letters, digits, points, hyphens and underscores, and not begin
    with a point; two rows of one name are an error, as are null bodies.
    `path` is a folder that executors reach, as a path or URI. A task that is
    run again writes the same files again.
    """
    told = rows.select(F.col(name).cast("string").alias("name"), F.col(body).cast("string").alias("body"))
    bad = told.groupBy("name").agg(F.count("*").alias("n"), F.count("body").alias("full")).where("n > 1 or full < n or name is null or not (name rlike '^[A-Za-z0-9_-][A-Za-z0-9._-]*$')")
    if not bad.isEmpty():
        raise ValueError(f"no file can be written for {bad.first()['name']!r}")
    head, tail = (f"window.{variable} = ", ";\n") if variable else ("", "")

    def run(batches):
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(path if "://" in path else f"file://{path}")
        fs.create_dir(root, recursive=True)
        for b in batches:
            sizes = []
            for n, text in zip(b.column("name").to_pylist(), b.column("body").to_pylist(), strict=True):
                data = f"{head}{text}{tail}".encode()
                with fs.open_output_stream(f"{root}/{n}{ending}", compression=None) as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column("name"), pa.array(sizes, pa.int64())], ["name", "n_bytes"])

    return told.mapInArrow(run, "name string, n_bytes long")


def payload_text(content: Column) -> Column:
    """The JSON text inside a file's bytes: without byte order mark, assignment, closing semicolon and control characters."""
    text = F.regexp_replace(F.try_validate_utf8(content.cast("string")), "^﻿", "")
    bare = F.regexp_replace(F.regexp_replace(text, r"^\s*(?:window\s*\.\s*|var\s+|const\s+|let\s+)[A-Za-z_$][A-Za-z0-9_$.]*\s*=\s*", ""), r"\s*;?\s*$", "")
    return F.regexp_replace(bare, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def read_payloads(spark: SparkSession, path: str, pattern: str = "*.js") -> DataFrame:
    """(name, payload variant, fault) of the files under path; fault tells of content that is no JSON object or array, whose payload is null. Spark passes over files without a byte."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[A-Za-z0-9]+$", "")
    read = files.select(name.alias("name"), F.try_parse_json(payload_text(F.col("content"))).alias("payload"))
    kind = F.schema_of_variant("payload")
    ok = F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))
    return read.select("name", F.when(ok, F.col("payload")).alias("payload"), F.when(~ok, "no payload").alias("fault"))
