"""Entity resolution: exact groups, survivors, and the ordered merge inside blocks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def richness(columns: list[str]) -> Column:
    """How many of the columns hold something."""
    return sum((F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 1).otherwise(0) for c in columns), F.lit(0))


def survivors(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the largest by `order` (a strict order)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def merge_blocks(df: DataFrame, block: list[str], row: str, time: str) -> DataFrame:
    """(row, group): rows of one block merge unless both have times that differ.

    Not transitive: rows with a time form groups by time first; a row without
    one joins only where the block has a single time, or none. Groups are named
    by their least row. Blocks are (date, place) pairs; a block's decision needs
    only its distinct times, so the merge is an aggregate and no block is held
    in one task.
    """
    times = df.groupBy(*block).agg(F.count_distinct(time).alias("_times"))
    keyed = df.join(times, block).withColumn("_g", F.when(F.col("_times") <= 1, F.lit("all")).when(F.col(time).isNull(), F.concat(F.lit("row:"), F.col(row).cast("string"))).otherwise(F.col(time).cast("string")))
    least = keyed.groupBy(*block, "_g").agg(F.min(row).alias("group"))
    return keyed.join(least, [*block, "_g"]).select(row, "group")


def similar(left: Column, right: Column) -> Column:
    """Ratio of matching blocks of two strings, 0 to 1."""
    from difflib import SequenceMatcher

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x, y, autojunk=False).ratio() if x is not None and y is not None else None for x, y in zip(a, b, strict=True)])

    return run(left, right)
