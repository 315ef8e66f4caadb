"""The registered queries of the corpus operators, thin over their general interfaces, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import alignment, ann, centroids, decontam, license_scan, line_dedup, minhash, packing, pii, sharding, suffix_dedup, toxicity, warc
from .common import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(read_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_paragraphs(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "grade", "expected_severity", "toxic")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(read_table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read_table(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_statistics(read_table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(warc.archived(read_table(spark, sf_dir, "pages")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_line_dedup, op2_license_scan, op3_toxicity, op4_packing, op5_ann, op6_decontamination, op7_suffix_dedup, op8_minhash, op9_sharding, op10_pii, op11_alignment, op12_centroids, op13_warc)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.line_dedup_sql(), "op6_decontamination": decontam.contamination_sql(), "op8_minhash": minhash.near_duplicates_sql(), "op9_sharding": sharding.place_sql(), "op12_centroids": centroids.cluster_sql(), "op13_warc": warc.page_records_sql()}
