"""Sources: how they are declared, checked, scanned together and judged."""

from __future__ import annotations

import posixpath
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .staging import cut

Load = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class Source:
    """`load` plans a scan; `fallback` is another plan for when that one fails or is empty."""

    name: str
    load: Load
    priority: int = 100
    allow_empty: bool = False
    fallback: Load | None = None
    fallback_name: str | None = None


def ordered(sources: list[Source]) -> list[Source]:
    """By (priority, name); blank names and names equal but for case are errors."""
    names = [s.name.strip().casefold() for s in sources]
    if "" in names or len(set(names)) < len(names):
        raise ValueError("sources need names that differ")
    return sorted(sources, key=lambda s: (s.priority, s.name))


def scan(spark: SparkSession, sources: list[Source]) -> tuple[DataFrame, DataFrame]:
    """(rows, loads): one union with source, source_order; and how each source was loaded.

    Spark runs the scans in parallel, and the order column keeps the declared
    order whatever ends first. A primary plan that raises, or holds no row, gives
    way to its fallback; loads(source, source_order, path, fallback_source,
    allow_empty, error) says so.
    """
    parts, loads = [], []
    for i, s in enumerate(ordered(sources)):
        path, error, df = "primary", None, None
        for path, load in (("primary", s.load), ("fallback", s.fallback)):
            if load is None:
                path = "primary"
                continue
            try:
                df = load(spark)
                if s.fallback is None or path == "fallback" or not df.isEmpty():
                    break
            except Exception as e:  # a source's failure is a result, reported in `loads`
                df, error = None, f"{type(e).__name__}: {str(e)[:200]}"
        loads.append((s.name, i, path, s.fallback_name or s.name if path == "fallback" else None, s.allow_empty, error if df is None else None))
        if df is not None:
            parts.append(df.withColumn("source", F.lit(s.name)).withColumn("source_order", F.lit(i)))
    if not parts:
        raise ValueError("no source could be read")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows, spark.createDataFrame(loads, "source string, source_order int, path string, fallback_source string, allow_empty boolean, error string")


def health(rows: DataFrame, loads: DataFrame) -> DataFrame:
    """loads with n and status: failed (error, or empty where that is not allowed), empty, ok."""
    n = rows.groupBy("source").agg(F.count("*").alias("n"))
    out = loads.join(n, "source", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("n") > 0, "ok").when(F.col("allow_empty"), "empty").otherwise("failed")
    return out.withColumn("status", status)


def provenance_fault(path: Column, fallback_source: Column, incomplete: Column) -> Column:
    """Why a load's provenance is not valid, null if it is."""
    named = F.coalesce(F.trim(fallback_source), F.lit("")) != ""
    return (
        F.when(path.isNull() | ~path.isin("primary", "fallback"), "unknown path")
        .when((path == "fallback") & ~named, "fallback without a source")
        .when((path == "primary") & fallback_source.isNotNull(), "primary with a fallback source")
        .when(F.coalesce(incomplete, F.lit(False)) & (path != "fallback"), "incomplete primary")
    )


def fullest_read(reads: DataFrame, read: str, row: str) -> DataFrame:
    """Rows of the best of repeated reads: most distinct rows, then the set most reads agree on, then the earliest.

    A read is known by its count and an order-free sum of row hashes, so no read is gathered in one place.
    """
    marks = reads.select(read, row).distinct().groupBy(read).agg(F.count("*").alias("_n"), F.sum(F.xxhash64(row).cast("decimal(38,0)")).alias("_set"))
    agree = marks.groupBy("_n", "_set").agg(F.count("*").alias("_agree"), F.min(read).alias(read))
    best = agree.agg(F.max_by(F.struct("_n", "_set"), F.struct("_n", "_agree", -F.col(read))).alias("_b"), F.max_by(read, F.struct("_n", "_agree", -F.col(read))).alias(read))
    return reads.join(F.broadcast(best.select(read)), read, "left_semi").dropDuplicates([row])  # one row is broadcast


class Pages(DataSource):
    """Format "tallyfold_pages": the lines of landed page files, a task for each file, with retries.

    Options: path (folder that every executor reaches), attempts (3), delay in
    seconds before the second attempt (0.5, growing by as much, at most 30);
    `delay.<error>` sets it for one kind of error by its class name, and a
    negative one ends the attempts. A line that begins with the option
    `declared` and goes on with a number tells how many lines the page should
    have, and is none of them. An empty file is tried again like a failing one,
    and is empty in the end. With the option `loads` set to true the scan gives
    what each load was like instead of its lines, and an error is a result.
    """

    @classmethod
    def name(cls) -> str:
        return "tallyfold_pages"

    def schema(self) -> str:
        return LOADS if self.options.get("loads") == "true" else "page string, line long, value string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PageReader(dict(self.options))


#: How a page was loaded: attempts, seconds waited between them, lines declared and read, the last error.
LOADS = "page string, attempts int, waited double, declared long, lines long, error string"


@dataclass
class _Page(InputPartition):
    path: str


class _PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.attempts, self.delay = options["path"], int(options.get("attempts", 3)), float(options.get("delay", 0.5))
        self.delays = {k[len("delay.") :].lower(): float(v) for k, v in options.items() if k.lower().startswith("delay.")}
        self.declared, self.loads = options.get("declared"), options.get("loads") == "true"

    def partitions(self) -> list[InputPartition]:
        import os  # pages are landed in a folder that driver and executors mount alike

        return [_Page(posixpath.join(self.folder, f)) for f in sorted(os.listdir(self.folder)) if f[0] not in "._"]

    def load(self, path: str) -> tuple[list[str], int | None, int, float, Exception | None]:
        """(lines, lines declared, attempts, seconds waited, error)."""
        waited, lines, declared, error = 0.0, [], None, None
        for attempt in range(1, self.attempts + 1):
            try:  # stat, open and every read belong to the attempt; lines wait until all of them came
                with open(path, encoding="utf-8") as f:
                    lines, declared = self.taken(line.rstrip("\n") for line in f)
                error = None
                if lines or attempt == self.attempts:
                    return lines, declared, attempt, waited, None
                pause = self.delay
            except (OSError, UnicodeDecodeError) as e:
                error, pause = e, self.delays.get(type(e).__name__.lower(), self.delay)
                if attempt == self.attempts or pause < 0:
                    return [], None, attempt, waited, e
            pause = min(30.0, pause * attempt)
            time.sleep(pause)
            waited += pause
        return lines, declared, self.attempts, waited, error

    def taken(self, lines: Iterator[str]) -> tuple[list[str], int | None]:
        out, declared = [], None
        for line in lines:
            number = line[len(self.declared) :].strip() if self.declared and line.startswith(self.declared) else ""
            if number.isdigit():
                declared = int(number)
            else:
                out.append(line)
        return out, declared

    def read(self, partition: _Page) -> Iterator[tuple]:
        name = posixpath.basename(partition.path)
        lines, declared, attempts, waited, error = self.load(partition.path)
        if self.loads:
            yield name, attempts, waited, declared, len(lines), f"{type(error).__name__}: {str(error)[:200]}" if error else None
        elif error:
            raise error
        else:
            yield from ((name, i, line) for i, line in enumerate(lines))


def page_health(loads: DataFrame, allow_empty: bool = False) -> DataFrame:
    """loads with status: failed (an error, or nothing where that is not allowed), partial (fewer or more lines than declared), empty, ok."""
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("declared").isNotNull() & (F.col("declared") != F.col("lines")), "partial")
    return loads.withColumn("status", status.when(F.col("lines") > 0, "ok").otherwise("empty" if allow_empty else "failed"))


def expect_count(df: DataFrame, declared: int) -> DataFrame:
    """`df`, written once, if it holds as many rows as its feed declares, else an error."""
    df = cut(df)
    found = df.count()
    if found != declared:
        raise ValueError(f"the feed declares {declared} rows and holds {found}")
    return df


def whole_feed(pages: DataFrame, cursor: str, after: str) -> DataFrame:
    """Pages of a cursor-paged feed in which no cursor repeats; a repeat is an error, not an end."""
    if not pages.where(F.col(after).isNotNull()).groupBy(after).count().where("count > 1").isEmpty() or not pages.where(F.col(after) == F.col(cursor)).isEmpty():
        raise ValueError("a cursor repeats")
    return pages
