"""Staging points: lineage is cut into the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; one of our own only in a local session that names none."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyfold-stage-"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    folder(df.sparkSession)
    return df.checkpoint(eager=True)
