"""Votes and the operators that had neither test nor query."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import bills
from tallyfold.operators import calendar, cascades, filters, reports, snapshots, votes


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_consensus_admission_and_verdict(spark):
    rows = spark.createDataFrame([("a", "rock", 1, "s"), ("a", "rock", 2, "t"), ("a", "jazz", 1, "s"), ("b", "rock", 1, "s"), ("b", "rock", 1, "s"), ("c", None, 1, "s"), ("c", None, 2, "t"), ("d", "pop", 1, "s"), ("d", "pop", 2, "s"), ("e", "x", 1, "s"), ("e", "x", 2, "s"), ("e", "y", 1, "t"), ("e", "y", 3, "t")], "k string, v string, u int, s string")
    assert _set(votes.consensus(rows, "k", "v", F.col("u"), 2)) == {("a", "rock", 2), ("d", "pop", 2)}
    assert _set(votes.admitted(rows, "k", "s", F.col("u"))) == {("a",), ("c",), ("e",)}
    assert _set(votes.verdict(rows, "k", "v", "s")) == {("a", None, "ambiguous"), ("b", "rock", "review"), ("d", "pop", "review"), ("e", None, "ambiguous")}


def test_preferred_collapsed_roles_and_names(spark):
    rows = spark.createDataFrame([("a", 3, True, "user", " B  b "), ("a", 1, None, "x", "A"), ("a", 2, True, "user", "B b"), ("b", 5, True, "x", ""), ("b", 5, True, "y", None)], "k string, place int, out boolean, role string, name string")
    assert _set(votes.preferred(rows, "k", "place", F.col("out"), F.col("place"))) == {("a", 3), ("b", 5)}
    assert _set(votes.collapsed(rows, "k", "place", F.col("out"))) == {("a", 1, False, 3), ("b", 5, True, 2)}
    assert sorted((r["place"], r["part"]) for r in votes.roles(rows, "k", "place", F.col("role") == "user").collect()) == [(1, "headliner"), (2, "co_headliner"), (3, "co_headliner"), (5, "headliner"), (5, "headliner")]
    known = spark.createDataFrame([("A", "Alpha")], "name string, canonical string")
    assert {r["k"]: r["names"] for r in votes.canonical_list(rows, "k", "name", known).collect()} == {"a": ["Alpha", "B b"], "b": None}
    assert {r["k"]: tuple(r)[1:] for r in votes.quality(rows.withColumn("out", F.col("out").cast("int")), "k", "out", "name").select("k", "n", "missing", "people").collect()} == {"a": (3, 1, 3), "b": (2, 0, 1)}


def test_performance_consensus(spark):
    rows = [("a", "rock", "source_explicit", 1, "v"), ("a", "rock", "source_mapping", 2, "v"), ("b", "rock", "source_explicit", 1, "v"), ("b", "rock", "source_explicit", 1, "v"), ("c", "rock", "source_explicit", 1, "v"), ("c", "rock", "source_explicit", 2, "v"), ("c", "jazz", "source_explicit", 3, "v"), ("d", "rock", "artist_mapping", 1, "v"), ("d", "rock", "artist_mapping", 2, "v")]
    assert _set(cascades.performance_consensus(spark.createDataFrame(rows, "artist string, genre string, method string, day int, venue string"), "artist")) == {("a", "rock")}


@pytest.mark.parametrize(("day", "frequency", "publishes"), [("2026-11-23", "weekly", True), ("2026-11-24", "weekly", False), ("2026-12-01", "monthly", True), ("2026-12-02", "monthly", False)])
def test_publication_days(spark, day, frequency, publishes):
    assert spark.range(1).select(reports.publishes_today(F.lit(dt.date.fromisoformat(day)), frequency)).first()[0] is publishes


def test_facets_and_the_collision_gate(spark):
    rows = spark.createDataFrame([(["a", "b"],), ([],), (["c"],)], "g array<string>")
    assert [r[0] for r in rows.select(filters.any_of(F.col("g"), ["b", "Unsorted"])).collect()] == [True, True, False]
    assert [r[0] for r in rows.select(filters.any_of(F.col("g"), ["b"])).collect()] == [True, False, False]
    public = spark.createDataFrame([(f"{i:016x}", "2026-01-01", f"H{i}", "V", None, "Rock") for i in range(120)], "public_id string, day string, headliner string, venue string, time string, genre string")
    assert reports.gate(public, 0, ["Rock"]).first()["refusals"] == []
    told = spark.createDataFrame([("b lies in c",), ("a lies in b",)], "message string")
    one = reports.gate(public, 0, ["Rock"], collisions=told).first()
    assert (one["refusals"], one["collisions"], one["collision"]) == (["collisions"], 2, "a lies in b")


def test_page_loads_tell_of_errors_and_counts(spark, tmp_path):
    from tallyfold.sources import registry

    (tmp_path / "a.txt").write_text("# rows 2\nx\ny\n")
    (tmp_path / "b.txt").write_text("# rows 3\nx\n# rows of seats\n")
    (tmp_path / "c.txt").write_text("")
    (tmp_path / "d.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "e.txt").mkdir()
    spark.dataSource.register(registry.Pages)
    read = lambda **o: spark.read.format("tallyfold_pages").options(path=str(tmp_path), delay="0.01", declared="# rows ", **o)
    loads = read(loads="true", **{"delay.IsADirectoryError": "-1"}).load()
    got = {r["page"]: (r["attempts"], r["declared"], r["lines"], r["error"] is None, r["status"]) for r in registry.page_health(loads).collect()}
    assert got == {"a.txt": (1, 2, 2, True, "ok"), "b.txt": (1, 3, 2, True, "partial"), "c.txt": (3, None, 0, True, "failed"), "d.txt": (3, None, 0, False, "failed"), "e.txt": (1, None, 0, False, "failed")}
    with pytest.raises(Exception, match="e.txt|d.txt|decode|directory"):
        read().load().collect()
    ok = registry.expect_count(spark.range(3), 3)
    assert ok.count() == 3
    with pytest.raises(ValueError, match="declares 4"):
        registry.expect_count(spark.range(3), 4)


def test_locale_orders(spark):
    from tallyfold.operators import calendar

    names = ["zoo", "Étoile", "etoile", "été", "Eté", "cote", "côte", "coté", "côté", "œuf", "oeuf", "ours", "Ånd"]
    df = spark.createDataFrame([(i, n, n, dt.date(2026, 1, 1)) for i, n in enumerate(names)], "id int, headliner string, venue string, day date")
    assert [r["headliner"] for r in calendar.locale_order(df, "artist-asc").collect()] == ["Ånd", "cote", "coté", "côte", "côté", "Eté", "été", "etoile", "Étoile", "oeuf", "œuf", "ours", "zoo"]
    assert [r["id"] for r in calendar.locale_order(df, "venue-asc").collect()] == [r["id"] for r in calendar.locale_order(df, "date-asc").collect()]
    got = {r["headliner"]: (r["spellings"], r["rows"]) for r in calendar.same_names(df, "headliner").collect()}
    assert got["cote"] == (4, 4) and got["etoile"] == (2, 2) and len(got) == 8 - ("oeuf" in got and "œuf" not in got)


def test_review_places_with_overrides(spark):
    from tallyfold.operators import editorial

    articles = spark.createDataFrame([(1, "Ana @ Le Club - 1 mai", "concert_review"), (2, "Bob @ Salle X, Paris", "concert_review"), (3, "Cy live", "concert_review"), (4, "Dee @ Le Club - x", "news"), (5, "Eve @ Elsewhere - x", "concert_review"), (6, None, "concert_review")], "id int, title string, type string")
    places = spark.createDataFrame([("le club", "Le Club"), ("le club", "Le Club Z"), ("salle x", "Salle X")], "key string, venue string")
    manual = spark.createDataFrame([("Cy live", "Le Club"), ("Ana @ Le Club - 1 mai", "Salle X")], "title string, venue string")
    known = spark.createDataFrame([("Le Club",)], "venue string")
    assert _set(editorial.review_places(articles, places)) == {(1, "Le Club", "associated"), (2, "Salle X", "associated"), (3, None, "unresolved"), (5, None, "unresolved"), (6, None, "unresolved")}
    assert _set(editorial.review_places(articles, places, manual, known)) == {(1, "Salle X", "outside"), (2, "Salle X", "outside"), (3, "Le Club", "associated"), (5, None, "unresolved"), (6, None, "unresolved")}


def test_release_monitor(spark):
    schema = "public_id int, genre string, bill array<string>, method string, flat_bill boolean, programme_title boolean"
    base = [(i, "Rock", [f"A{i}"], "m", None, None) for i in range(200)]
    told = lambda rows: reports.release_monitor(spark.createDataFrame(base, schema), spark.createDataFrame(rows, schema)).first()
    calm = told(base)
    assert (calm["status"], calm["alerts"]) == ("normal", []) and calm["metrics"]["compared"] == 200
    some = told([(i, None if i < 3 else g, b if i > 9 else ["other"], m, f, p) for i, g, b, m, f, p in base])
    assert some["status"] == "investigate" and [tuple(a) for a in some["alerts"]] == [("genre_loss", "review", 3), ("billing_churn", "investigate", 10)]
    odd = told([(i + 150, "Rock" if i < 5 else None, [f"A{i + 150}"], None if i < 2 else "m", i < 100, True) for i in range(120)])
    assert [tuple(a) for a in odd["alerts"]] == [("genre_provenance", "investigate", 2), ("genre_loss", "review", 45), ("flat_bill_review_queue", "review", 100), ("programme_title_review_queue", "review", 120), ("low_genre_coverage", "investigate", 115)]
    assert (odd["metrics"]["new_ids"], odd["metrics"]["missing_ids"]) == (70, 150)


def test_replay_suppresses_what_the_merge_holds_equal(spark):
    from tallyfold.operators import snapshots

    schema = "row int, day date, venue_key string, title string, time string, source string, official boolean, ticket string, last_success timestamp"
    d, now = dt.date(2026, 5, 1), dt.datetime(2026, 4, 20)
    row = lambda i, title, source, time=None, day=d, at=now: (i, day, "v", title, time, source, False, None, at)
    fresh = spark.createDataFrame([row(1, "Ana & Bob", "b", "19:00"), row(2, "Cy", "b", "21:00")], schema)
    held = spark.createDataFrame([row(1, "Bob x Ana", "a"), row(2, "Cy", "a", "19:00"), row(3, "Dee", "a"), row(4, "Eve", "a", day=dt.date(2026, 4, 1)), row(5, "Fay", "a", at=dt.datetime(2026, 4, 1)), row(6, "Ana & Bob", "ok")], schema)
    judged = spark.createDataFrame([("a", "failed"), ("b", "ok"), ("ok", "ok")], "source string, status string")
    got = snapshots.replay_equivalent(fresh, held, judged, F.lit(now), F.lit(dt.date(2026, 4, 20)))
    assert {r["row"]: r["fate"] for r in got.collect()} == {1: "suppressed", 2: "restored", 3: "restored", 4: "past", 5: "expired"}


def test_few_sources_and_groups_are_no_few_tasks(spark):
    judged = spark.createDataFrame([("A", "ok"), ("N", "failed"), ("R", "empty")], "source string, status string")
    each = spark.createDataFrame([(1, "A"), (1, "N"), (2, "A"), (2, "R"), (3, "N"), (4, "N"), (4, "R")], "row long, source string")
    got = snapshots.unmixed_sources(each, judged)
    assert {r["row"] for r in got.collect()} == {1, 4}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source" not in plan and "collect_set" not in plan
    rows = spark.createDataFrame([(i, [None, "a", "b"][i % 3], (i * 7) % 50) for i in range(300)], "id long, g string, v long")
    out = calendar.placed(rows, "g", [F.asc("v"), F.asc("id")], "place")
    want = {}
    for g in (None, "a", "b"):
        mine = sorted((r["v"], r["id"]) for r in rows.collect() if r["g"] == g)
        want |= {i: n for n, (_, i) in enumerate(mine, 1)}
    assert {r["id"]: r["place"] for r in out.collect()} == want
    assert "_range" in out._jdf.queryExecution().optimizedPlan().toString()
    assert calendar.placed(rows.where("false"), "g", [F.asc("v"), F.asc("id")], "place").count() == 0


def test_promotion_names_each_list_once(spark):
    df = spark.createDataFrame([("b", ["C"], ["o"], ["A", "B", "o", "a", "c"]), ("x", None, None, None)], "h string, c array<string>, o array<string>, p array<string>")
    got = df.select(bills.promote_performers(F.col("h"), F.col("c"), F.col("o"), F.col("p")).alias("b"))
    assert [(r.b.headliner, r.b.co_headliners) for r in got.collect()] == [("B", ["C", "A"]), ("x", None)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction(") < 40
