"""Known names inside running texts: an Aho-Corasick automaton over Arrow batches, then the leftmost longest of its matches.

The names travel to the tasks in parts of bounded size; each part is one pass
over the texts, and matches of all parts meet by row, so no catalogue is too
large.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import cut

#: Names that one pass looks for, at most.
PART_TERMS = 200_000
#: Signs that count as an apostrophe (fixed values).
APOSTROPHES = "’‘ʼ＇"


def plain(text: str) -> str:
    """Lower case sign by sign, so places stay; a sign whose lower case is longer stays as it is."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.translate({ord(c): "'" for c in APOSTROPHES})


def matches(text: str, automaton) -> Iterator[tuple[int, int, str]]:
    """(start, end, slug) of the longest name at every start, between signs that are neither letters nor digits."""
    low, best = plain(text), {}
    for last, (size, slug) in automaton.iter(low):
        start, end = last - size + 1, last + 1
        if (start and low[start - 1].isalnum()) or (end < len(low) and low[end].isalnum()):
            continue
        if end > best.get(start, (0, ""))[0]:
            best[start] = (end, slug)
    return ((s, e, slug) for s, (e, slug) in sorted(best.items()))


def _found(texts: DataFrame, terms: list[tuple[str, str]]) -> DataFrame:
    def run(batches):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, slug in terms:
            automaton.add_word(term, (len(term), slug))
        automaton.make_automaton()
        for b in batches:
            rows = [(r, *m) for r, t in zip(b.column("row").to_pylist(), b.column("text").to_pylist(), strict=True) if t for m in matches(t, automaton)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())], ["row", "start", "end", "slug"])

    return texts.mapInArrow(run, "row long, start int, end int, slug string")


def linked(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: bool = False) -> DataFrame:
    """(id, start, end, slug) of the names to link: leftmost longest matches, each slug at its first one unless `every`.

    terms(term, slug): names that compare without case and with any apostrophe;
    of one name the least slug counts, empty ones are left out. Places count
    code points, the end exclusive. Every row is a text of its own, also with a
    repeated or null id; null and empty texts have no names.
    """
    term = F.translate(F.lower("term"), APOSTROPHES, "'" * len(APOSTROPHES))
    known = cut(terms.where(F.coalesce("term", F.lit("")) != "").select(term.alias("term"), F.col("slug").cast("string").alias("slug")).groupBy("term").agg(F.min("slug").alias("slug")))
    parts = -(-known.count() // PART_TERMS)
    rows = cut(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))) if parts != 1 else docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = known.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(max(1, parts))))
    found = [_found(rows.select("row", "text"), [(r["term"], r["slug"]) for r in dealt.where(F.col("part") == k).select("term", "slug").collect()]) for k in range(parts)]  # a part is bounded
    if not found:
        return rows.select("id", F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("slug")).where("false")
    met = cut(reduce(DataFrame.union, found).join(rows.select("row", "id"), "row")) if parts != 1 else found[0].join(rows.select("row", "id"), "row")
    # one text's matches, in order: what begins before the last one's end falls away
    at = F.array_sort(F.collect_list(F.struct("start", (-F.col("end")).alias("back"), "end", "slug")))
    kind = "array<struct<start:int,back:int,end:int,slug:string>>"
    free = lambda a, x: F.when((F.size(a) == 0) | (F.try_element_at(a, F.lit(-1))["end"] <= x["start"]), F.array_append(a, x)).otherwise(a)
    kept = met.groupBy("row").agg(F.first("id").alias("id"), at.alias("at")).select("row", "id", F.explode(F.aggregate("at", F.array().cast(kind), free)).alias("m")).select("row", "id", "m.start", "m.end", "m.slug")
    if not every:
        kept = kept.groupBy("row", "slug").agg(F.first("id").alias("id"), F.min(F.struct("start", "end")).alias("m")).select("row", "id", "m.start", "m.end", "slug")
    return kept.select("id", "start", "end", "slug")
