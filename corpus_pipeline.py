"""Corpus preparation: toxicity, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), where docs has the columns of the table
documents, works on every row its predecessor kept, and returns a DataFrame;
all but the last return those columns. Null and empty texts, repeated rows,
null ids and empty tables pass through as the operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import common, decontam, line_dedup, minhash, packing, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS[:-1], F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents graded toxic go; the model is fitted on labelled rows of the table documents."""
    model = toxicity.train(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where("not toxic").select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found on many sites leave every document; a document left without text stays, empty."""
    return _documents(line_dedup.remove_boilerplate(docs.select(*COLUMNS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8) stays: the one with the smallest id.

    Ids that are null or repeated name no document, so rows then get numbers
    of their own, and of equal ids the first number counts; null ids come last.
    Documents without words stay.
    """
    docs = docs.select(*COLUMNS)
    n = docs.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if n["rows"] == n["ids"]:
        kept = minhash.near_duplicates(docs).where("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)
    rows = common.materialize(docs.withColumn("_row", F.monotonically_increasing_id()))
    groups = minhash.near_duplicates(rows, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first"))
    return rows.join(first.select("first._row"), "_row", "left_semi").select(*COLUMNS)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that share a window of ten words with a benchmark item are cut out of their documents."""
    return _documents(decontam.decontaminate(docs.select(*COLUMNS), common.read_table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_boilerplate), ("near_dedup", drop_near_duplicates), ("decontamination", cut_benchmark), ("packing", pack)]

#: No SQL trains the toxicity model or tokenizes; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again."""
    common.shared_dir(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
