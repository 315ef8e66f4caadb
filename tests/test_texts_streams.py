"""Names in texts, payload files, adaptive windows and keyed state in streams, each against a plain loop."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import autolinks, programmes
from tallyfold.sources import payload_files
from tallyfold.streaming import keyed_state

TERMS = [("The Cure", "cure"), ("Cure", "cure-2"), ("L’Impératrice", "imp"), ("a b", "ab"), ("b c d", "bcd"), ("c", "c"), ("été", "ete"), ("中文", "zh"), ("", "none"), (None, "none"), ("CURE", "cure-0")]
TEXTS = [(1, "The Cure, the cure and Cure; obscure cures."), (2, "l'impératrice L‘IMPÉRATRICE L’impératrice"), (3, "a b c d"), (4, "x a b c"), (5, None), (6, ""), (7, "Été. étés 中文x 中文 中文。"), (7, "cure"), (None, "cure"), (8, "İ cure"), (9, "the cure" * 3), (10, "c " * 5000)]


def _loop(text, terms, every):
    found, at, seen, low = [], 0, set(), autolinks.plain(text or "")
    while at < len(low):
        best = None
        for term, slug in terms.items():
            end = at + len(term)
            if low.startswith(term, at) and not (at and low[at - 1].isalnum()) and not (end < len(low) and low[end].isalnum()) and (best is None or end > best[0]):
                best = (end, slug)
        if best:
            if every or best[1] not in seen:
                found.append((at, best[0], best[1]))
            seen.add(best[1])
        at = best[0] if best else at + 1
    return found


@pytest.mark.parametrize("every", [False, True])
@pytest.mark.parametrize("part", [200_000, 3])
def test_names_in_texts_equal_a_plain_loop(spark, part, every, monkeypatch):
    monkeypatch.setattr(autolinks, "PART_TERMS", part)
    terms = {}
    for t, s in TERMS:
        if t:
            terms[autolinks.plain(t)] = min(terms.get(autolinks.plain(t), s), s)
    want = sorted(str((i, *m)) for i, t in TEXTS for m in _loop(t, terms, every))
    got = autolinks.linked(spark.createDataFrame(TEXTS, "doc_id long, text string"), spark.createDataFrame(TERMS, "term string, slug string"), every=every)
    assert sorted(str(tuple(r)) for r in got.collect()) == want and len(want) > 12
    none = spark.createDataFrame([], "term string, slug string")
    assert autolinks.linked(spark.createDataFrame(TEXTS, "doc_id long, text string"), none).count() == 0


def test_payload_files_round_trip(spark, tmp_path):
    rows = [("a", '{"x": 1, "t": "é\\u2028"}'), ("b.c", "[1, 2]"), ("d-1", '{"s": ";"}')]
    sizes = payload_files.write_payloads(spark.createDataFrame(rows, "name string, body string"), str(tmp_path), variable="data").collect()
    assert {r["name"]: r["n_bytes"] for r in sizes} == {f.name.removesuffix(".js"): f.stat().st_size for f in tmp_path.iterdir()}
    (tmp_path / "odd.js").write_bytes(b"\xef\xbb\xbfvar  some.thing = {\"k\": \"v\x01\"} ; \n")
    (tmp_path / "empty.js").write_bytes(b"")
    (tmp_path / "broken.js").write_bytes(b"window.data = {\"k\": ")
    (tmp_path / "text.js").write_bytes(b"\"only a text\"")
    (tmp_path / "bytes.js").write_bytes(b"\xff\xfe\x00")
    (tmp_path / "other.txt").write_bytes(b"{}")
    got = {r["name"]: (r["p"], r["fault"]) for r in payload_files.read_payloads(spark, str(tmp_path)).select("name", F.to_json("payload").alias("p"), "fault").collect()}
    assert got == {"a": ('{"t":"é ","x":1}', None), "b.c": ("[1,2]", None), "d-1": ('{"s":";"}', None), "odd": ('{"k":"v"}', None), "broken": (None, "no payload"), "text": (None, "no payload"), "bytes": (None, "no payload")}
    for bad in ([("../x", "{}")], [("a", "{}"), ("a", "[]")], [("a", None)], [(None, "{}")]):
        with pytest.raises(ValueError):
            payload_files.write_payloads(spark.createDataFrame(bad, "name string, body string"), str(tmp_path))


@pytest.mark.parametrize(("most", "incomplete"), [(95, 1), (5, 3)])
def test_windows_halve_until_none_overflows(spark, most, incomplete):
    first = dt.date(2026, 1, 1)
    days = [first + dt.timedelta(days=k) for k in range(20) for _ in range({3: 9, 4: 2, 10: 4}.get(k, 1))]
    e = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, day date")
    asked = []

    def fetch(windows):
        asked.extend((r["start"], r["stop"]) for r in windows.collect())
        met = windows.join(e, e.day.between(windows.start, windows.stop))
        n = met.groupBy("start", "stop").count()
        return met.select("start", "stop", "id"), windows.join(n, ["start", "stop"], "left").select("start", "stop", (F.coalesce("count", F.lit(0)) > 5).alias("more"))

    rows, told = programmes.adaptive_windows(programmes.date_windows(spark, first, 20), fetch, most)
    told = {(r["start"], r["stop"]): r["status"] for r in told.collect()}
    assert len(asked) <= most and len(asked) == len(set(asked)) == sum(s != "not asked" for s in told.values())
    ends = sorted(w for w, s in told.items() if s != "halved")
    assert [w[0] for w in ends] == [first, *[w[1] + dt.timedelta(days=1) for w in ends[:-1]]] and ends[-1][1] == days[-1]
    assert sum(s in ("overflow", "not asked") for s in told.values()) == incomplete or most == 5 and "not asked" in told.values()
    covered = [w for w, s in told.items() if s in ("complete", "overflow")]
    assert sorted(r["id"] for r in rows.collect()) == [i for i, d in enumerate(days) if any(a <= d <= b for a, b in covered)]


def test_keyed_state_over_batches_with_its_end(spark, tmp_path):
    schema = "key string, day date, at timestamp"
    t = lambda d, h=0: dt.datetime(2026, 1, d, h)
    files = [[("a", t(1).date(), t(1, 5)), ("a", t(1).date(), t(1, 3)), ("b", None, t(1, 1)), (None, None, t(1, 1)), ("c", t(9).date(), t(1, 2))], [("a", t(2).date(), t(2, 1)), ("d", None, None)], [("z", None, t(20))], [("z", None, t(21)), ("c", t(9).date(), t(20, 20))], [("a", t(21).date(), t(21, 4))]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    names = sorted((tmp_path / "in").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    for i, p in enumerate(names):
        os.utime(p, (1_700_000_000 + i * 60,) * 2)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    changes = keyed_state.drain(spark, source, str(tmp_path / "run"), past=5, idle=None, delay="1 day")
    rows = changes.collect()
    ended = {(r["key"], r["first_seen"], r["last_seen"]) for r in rows if r["expired"]}
    assert ended >= {("a", t(1, 3), t(2, 1)), ("b", t(1, 1), t(1, 1))}
    live = {r["key"]: (str(r["day"]), r["first_seen"], r["last_seen"]) for r in keyed_state.current(changes).collect()}
    assert live["a"] == ("2026-01-21", t(21, 4), t(21, 4)) and live["z"][1:] == (t(20), t(21)) and "b" not in live and "d" not in live


def test_keyed_state_equals_the_batch_upsert(spark, tmp_path):
    schema = "key string, day date, at timestamp"
    rows = [(f"k{i % 5}", dt.date(2026, 1, 1 + i % 3), dt.datetime(2026, 1, 1 + i % 3, i % 24)) for i in range(40)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got = {r["key"]: (r["first_seen"], r["last_seen"]) for r in keyed_state.current(keyed_state.drain(spark, source, str(tmp_path / "run"))).collect()}
    assert got == {k: (min(a for x, _, a in rows if x == k), max(a for x, _, a in rows if x == k)) for k in {r[0] for r in rows}}
