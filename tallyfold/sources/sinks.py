"""Sinks: hashed data sets with a pointer, calendars, tables with joined lists, routes, versioned state."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def escaped_json(columns: list[str]) -> Column:
    """The row as JSON that may stand inside a page: & < > as escapes."""
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    for sign, code in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e")):
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def digest(df: DataFrame) -> tuple[str, int]:
    """(64 hex digits, rows) of the rows whatever their order and partitions; repeated rows count.

    Four 64-bit quarters of each row's SHA-256 are summed, so the aggregate is partial and nothing is sorted.
    """
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    sums = [F.sum(F.conv(F.substring("_h", 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")).alias(f"s{i}") for i in range(4)]
    total = df.select(row.alias("_h")).agg(F.count("*").alias("n"), *sums)
    out = total.select(F.sha2(F.concat_ws(",", "n", *(F.coalesce(F.col(f"s{i}").cast("string"), F.lit("0")) for i in range(4))), 256).alias("d"), "n").first()
    return out["d"], out["n"]


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written beside and renamed over the old one in a single step, so that readers see the old or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    new, old = hadoop.Path(path + ".next"), hadoop.Path(path)
    context = hadoop.FileContext.getFileContext(old.getFileSystem(conf).getUri(), conf)
    stream = new.getFileSystem(conf).create(new, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(new, old, options)


def publish(df: DataFrame, folder: str, name: str, published_at: str) -> dict:
    """Rows as escaped JSON lines under name.<digest>/, then the pointer name.json; returns the pointer.

    The data set's name follows its content: a repeated run writes the same place.
    """
    sha, n = digest(df)
    data = f"{name}.{sha[:16]}"
    df.select(escaped_json(df.columns).alias("value")).write.mode("overwrite").text(f"{folder}/{data}")
    pointer = {"data": data, "sha256": sha, "count": n, "publishedAt": published_at}
    _write_text(df.sparkSession, f"{folder}/{name}.json", json.dumps(pointer))
    return pointer


def read_published(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """The published rows, after the name, digest and count of the pointer have been checked; empty sets are errors."""
    pointer = json.loads("".join(r.value for r in spark.read.text(f"{folder}/{name}.json").collect()))  # one line
    if pointer["data"] != f"{name}.{pointer['sha256'][:16]}" or pointer["count"] < 1:
        raise ValueError("the pointer is not valid")
    df = spark.read.schema(schema).json(f"{folder}/{pointer['data']}")
    if digest(df) != (pointer["sha256"], pointer["count"]):
        raise ValueError("the data set is not the published one")
    return df


write_state, read_state = publish, read_published  # state is a published data set: versioned by content, checked when read


def write_csv(df: DataFrame, path: str) -> None:
    """CSV in which lists are joined by " | "."""
    flat = [F.array_join(F.col(c.name).cast("array<string>"), " | ").alias(c.name) if isinstance(c.dataType, ArrayType) else F.col(c.name) for c in df.schema]
    df.select(flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_routes(df: DataFrame, path: str, kind: str, slug: str, order: list[Column]) -> None:
    """One row per (kind, slug): the first by `order` owns it; partitioned by kind."""
    first = F.row_number().over(Window.partitionBy(kind, slug).orderBy(*order))
    df.where(F.col(slug) != "").withColumn("_n", first).where("_n = 1").drop("_n").write.mode("overwrite").partitionBy(kind).parquet(path)


def ics_escape(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for sign, code in (("\\", "\\\\"), ("\n", "\\n"), (",", "\\,"), (";", "\\;")):
        out = F.replace(out, F.lit(sign), F.lit(code))
    return out


def ics_event(uid: Column, stamp: Column, day: Column, time: Column, title: Column, venue: Column, city: Column, openers: Column, festival: Column, url: Column, zone: str = "Europe/Paris", home: str = "paris") -> Column:
    """One VEVENT with CRLF line ends: timed where `time` (HH:MM) is given, else all day; a time of another form gives null.

    The city follows the venue unless it is `home`; a festival lists its whole line-up.
    """
    date8 = F.date_format(day, "yyyyMMdd")
    some = F.size(F.coalesce(openers, F.array().cast("array<string>"))) > 0
    acts = F.array_join(F.coalesce(openers, F.array().cast("array<string>")), ", ")
    about = F.when(festival.isNotNull(), F.concat(F.lit("Festival lineup: "), title, F.when(some, F.concat(F.lit(", "), acts)).otherwise(""))).when(some, F.concat(F.lit("With "), acts))
    start = F.when(time.isNull(), F.concat(F.lit("DTSTART;VALUE=DATE:"), date8)).when(time.rlike(r"^(?:[01]\d|2[0-3]):[0-5]\d$"), F.concat(F.lit(f"DTSTART;TZID={zone}:"), date8, F.lit("T"), F.replace(time, F.lit(":"), F.lit("")), F.lit("00")))
    end = F.when(time.isNull(), F.concat(F.lit("DTEND;VALUE=DATE:"), F.date_format(F.date_add(day, 1), "yyyyMMdd")))
    place = F.concat(venue, F.when(F.lower(city) == home, "").otherwise(F.concat(F.lit(", "), F.coalesce(city, F.lit("")))))
    lines = [F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), uid), F.concat(F.lit("DTSTAMP:"), stamp), start, end, F.concat(F.lit("SUMMARY:"), ics_escape(title)), F.concat(F.lit("LOCATION:"), ics_escape(place)), F.concat(F.lit("DESCRIPTION:"), ics_escape(F.concat_ws("\n", about, url))), F.lit("END:VEVENT")]
    return F.when(start.isNotNull(), F.concat_ws("\r\n", *lines))


def ics_file(event: Column, product: str) -> Column:
    head = F.lit(f"BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:{product}\r\nCALSCALE:GREGORIAN\r\n")
    return F.concat(head, event, F.lit("\r\nEND:VCALENDAR\r\n"))
