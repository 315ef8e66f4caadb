"""Keyed assets in shards: a data set that readers ask for by key, with a manifest that tells what each shard must hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

#: Shards of an asset.
SHARDS = 64


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    """The shard of a key, as text is hashed by Spark; null keys have none."""
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key.cast("string")), F.lit(shards)).cast("int"))


def _marks(rows: DataFrame) -> DataFrame:
    """(shard, n, sum of row hashes): does not depend on order."""
    told = [c for c in rows.columns if c != "shard"]
    return rows.groupBy("shard").agg(F.count("*").alias("n"), F.sum(F.xxhash64(F.to_json(F.struct(*told))).cast("decimal(38,0)")).cast("string").alias("mark"))


def write_shards(rows: DataFrame, path: str, key: str, shards: int = SHARDS) -> None:
    """Write rows as JSON lines under path/rows/shard=k, then path/manifest; rows without a key are an error.

    A key's rows lie in one shard; a key with very many rows is split into
    files by Spark's own size, so no task holds more than its share. The
    manifest is written last: without it nothing can be read.
    """
    if "shard" in rows.columns or not rows.where(F.col(key).isNull()).isEmpty():
        raise ValueError("rows need a key, and no column called shard")
    placed = rows.withColumn("shard", shard_of(F.col(key), shards))
    placed.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").json(f"{path}/rows", ignoreNullFields=False)
    written = read_rows(rows.sparkSession, path, rows.schema)
    _marks(written).select("shard", "n", "mark", F.lit(shards).alias("shards"), F.lit(key).alias("key")).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def read_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields]).add("shard", IntegerType())).json(f"{path}/rows")


def read_shards(spark: SparkSession, path: str, schema: StructType, keys: list | None = None) -> DataFrame:
    """The rows, or those of some keys from their shards alone; a shard that is not as the manifest has it is an error."""
    manifest = spark.read.schema("shard int, n long, mark string, shards int, key string").json(f"{path}/manifest")
    about = manifest.select("shards", "key").first()
    if about is None:
        return spark.createDataFrame([], schema)
    rows = read_rows(spark, path, schema)
    if keys is not None:
        own = [r[0] for r in spark.createDataFrame([(str(k),) for k in keys], "k string").select(shard_of(F.col("k"), about["shards"])).distinct().collect()]
        rows, manifest = rows.where(F.col("shard").isin(own)), manifest.where(F.col("shard").isin(own))
    found = _marks(rows).select("shard", F.col("n").alias("_n"), F.col("mark").alias("_mark"))
    odd = manifest.join(found, "shard", "full").where(~(F.equal_null("n", "_n") & F.equal_null("mark", "_mark")))
    if not odd.isEmpty():
        raise ValueError("a shard is not the one that was written")
    out = rows.drop("shard")
    return out if keys is None else out.where(F.col(about["key"]).cast("string").isin([str(k) for k in keys]))
