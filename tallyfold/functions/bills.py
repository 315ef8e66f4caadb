"""Bills: who of a title plays, resolved by a catalogue or by performers the source names."""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import bound, distinct_by_key, each, fold_content

#: Signs that may part two names when white space surrounds them (fixed values).
SEPARATOR = re.compile(r"(\s+(?:\+|/|•|&|et|[–—-])\s+)", re.I)
MOST_SEPARATORS = 8


def split_plus(text: str) -> list[str]:
    """Parts around spaced plus signs outside parentheses; one part gives none."""
    parts, depth = [""], 0
    for token in re.split(r"(\s+\+\s+|[()])", text):
        depth += (token == "(") - (token == ")")
        if depth == 0 and token.strip() == "+":
            parts.append("")
        else:
            parts[-1] += token
    return [p.strip() for p in parts] if len(parts) > 1 else []


def plus_parts(text: Column) -> Column:
    """array<string> of split_plus; null texts give an empty array."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return each(texts, split_plus, list)

    return run(text)


def partition(text: str, known: Mapping[str, str]) -> list[str]:
    """The only way to cover the whole bill with two or more distinct known names, or nothing.

    Counted from the end: ways[i] holds up to two covers of the pieces from i on,
    which is all that "exactly one" needs. A bill that is itself a known name is no bill.
    """
    text = " ".join(text.split())
    pieces = SEPARATOR.split(text)
    n = len(pieces) // 2 + 1
    if not 1 < n <= MOST_SEPARATORS + 1 or fold_content(text) in known:
        return []
    ways: list[list[list[str]]] = [[] for _ in range(n)] + [[[]]]
    for i in reversed(range(n)):
        for j in range(i + 1, n + 1):
            name = known.get(fold_content("".join(pieces[2 * i : 2 * j - 1])))
            if name is not None:
                ways[i] += [[name, *rest] for rest in ways[j]]
    covers = [w for w in ways[0] if len(w) > 1 and len({fold_content(v) for v in w}) == len(w)]
    return covers[0] if len(covers) == 1 else []


def candidate_names(bill: Column) -> Column:
    """Folded names that a partition of the bill might use: every run of its pieces."""

    @F.pandas_udf("array<string>")
    def run(bills: pd.Series) -> pd.Series:
        def runs(text: object) -> list[str]:
            pieces = SEPARATOR.split(" ".join(text.split())) if isinstance(text, str) else []
            n = len(pieces) // 2 + 1
            if not pieces or n > MOST_SEPARATORS + 1:
                return []
            return sorted({fold_content("".join(pieces[2 * i : 2 * j - 1])) for i in range(n) for j in range(i + 1, n + 1)})

        return each(bills, runs, list)

    return run(bill)


def resolve_bills(bills: DataFrame, catalogue: DataFrame, row: str, bill: str) -> DataFrame:
    """(row, members) of bills that one partition over catalogue(key, name) explains.

    The catalogue may be of any size: only the names that a bill could use are
    joined to it, at most 45 a bill, so nothing is broadcast. Keys are unique.
    """
    wanted = bills.select(row, bill, F.explode(candidate_names(F.col(bill))).alias("key"))
    known = wanted.join(catalogue.select("key", "name"), "key").groupBy(row, bill).agg(F.map_from_entries(F.collect_list(F.struct("key", "name"))).alias("_known"))

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, tables: pd.Series) -> pd.Series:
        return pd.Series([partition(t, dict(k)) for t, k in zip(texts, tables, strict=True)])

    return known.select(row, run(F.col(bill), F.col("_known")).alias("members")).where(F.size("members") > 0)


def promote_performers(headliner: Column, co_headliners: Column, openers: Column, performers: Column) -> Column:
    """struct(headliner, co_headliners): the performer the title names leads, else the first.

    The other performers join the co-headliners unless they open; no performers change nothing.
    """
    key = lambda c: F.lower(F.trim(c))
    given = distinct_by_key(F.filter(F.coalesce(performers, F.array().cast("array<string>")), lambda p: F.trim(p) != ""), key)
    opening = F.transform(F.coalesce(openers, F.array().cast("array<string>")), key)

    def lead(names: Column, title: Column) -> Column:
        same = F.filter(names, lambda p: key(p) == title)
        return F.when(F.size(same) > 0, same[0]).when(F.size(names) > 0, names[0]).otherwise(headliner)

    def told(names: Column, first: Column, taken: Column) -> Column:
        others = F.filter(names, lambda p: ~F.array_contains(taken, key(p)))
        both = distinct_by_key(F.concat(F.coalesce(co_headliners, F.array().cast("array<string>")), others), key)
        return bound(both, lambda b: F.struct(first.alias("headliner"), F.when(F.size(b) > 0, b).alias("co_headliners")))

    # each list is named several times, also inside lambdas, so each is bound once
    return bound(given, lambda names: bound(key(headliner), lambda title: bound(lead(names, title), lambda first: bound(F.concat(opening, F.array(key(first))), lambda taken: told(names, first, taken)))))
