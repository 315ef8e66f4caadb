"""Keyed assets: whole and by key, and what happens to broken ones."""

import re

import pytest

from tallyfold.sources import shards

SCHEMA = "slug string, n long, names array<string>, at timestamp"


def test_shards_round_trip_and_lookups(spark, tmp_path):
    import datetime as dt

    rows = [(f"s{i % 30}", i, None if i % 7 == 0 else [f"é{i}", ""], dt.datetime(2026, 1, 1, 0, i % 60)) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    shards.write_shards(df, str(tmp_path / "a"), "slug", 8)
    back = shards.read_shards(spark, str(tmp_path / "a"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and len({p.name for p in (tmp_path / "a" / "rows").glob("shard=*")}) <= 8
    some = shards.read_shards(spark, str(tmp_path / "a"), df.schema, ["s3", "s4", "none"])
    assert sorted(r["n"] for r in some.collect()) == [r[1] for r in rows if r[0] in ("s3", "s4")]
    assert re.search(r"PartitionFilters: \[[^\]]*shard", some._jdf.queryExecution().toString())  # other shards are not opened
    victim = next((tmp_path / "a" / "rows").glob("shard=*/*.json"))
    victim.write_text(victim.read_text().replace("2026", "2027"))
    for crc in victim.parent.glob(".*.crc"):
        crc.rename(tmp_path / crc.name)
    with pytest.raises(ValueError, match="not the one"):
        shards.read_shards(spark, str(tmp_path / "a"), df.schema)


def test_shards_of_nothing_and_without_keys(spark, tmp_path):
    shards.write_shards(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), "slug")
    assert shards.read_shards(spark, str(tmp_path / "e"), spark.createDataFrame([], SCHEMA).schema).count() == 0
    with pytest.raises(ValueError):
        shards.write_shards(spark.createDataFrame([(None, 1, None, None)], SCHEMA), str(tmp_path / "n"), "slug")
