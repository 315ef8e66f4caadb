"""Eligibility, facets and quarantine filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, null if none does; the order is part of the meaning."""
    out = F
    for name, rule in rules:
        out = out.when(rule, F.lit(name))
    return out


def split_eligible(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """`df` with reason (null: eligible); rejects are kept for the report."""
    return df.withColumn("reason", first_reason(rules))


def reject_repeated(df: DataFrame, value: str, holder: str, least: int) -> DataFrame:
    """Rows whose value is not shared by `least` or more distinct holders; null values stay."""
    shared = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count_distinct(holder).alias("_n")).where(F.col("_n") >= least)
    return df.join(shared.select(value), value, "left_anti")


def any_of(values: Column, wanted: list[str]) -> Column:
    """Facet test: the array shares a value with `wanted`; Unsorted stands for an empty array."""
    hit = F.arrays_overlap(values, F.array(*map(F.lit, wanted)))
    return hit | (F.size(values) == 0) if "Unsorted" in wanted else hit
