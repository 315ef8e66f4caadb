"""Titles, bills, payloads, sources, sinks, identities and gates on small cases."""

import datetime as dt
import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import bills, payloads, titles
from tallyfold.operators import identity, listings, reports, snapshots
from tallyfold.sources import registry, sinks


@pytest.mark.parametrize(
    ("title", "artist", "event_title", "rule"),
    [
        ("Anna (première partie : Bob)", "Anna", None, "support"),
        ("Anna à Le Trabendo", "Anna", None, "venue"),
        ("Anna à Lyon", "Anna à Lyon", None, None),
        ("Anna I 14.11.26", "Anna", None, "day"),
        ("Anna I 15.11.26", "Anna I 15.11.26", None, None),
        ('Anna "World Tour 26"', "Anna", "World Tour 26", "quoted tour"),
        ('Anna "Red"', 'Anna "Red"', None, None),
        ("Anna with special guests", "Anna", "Anna with special guests", "unnamed guest"),
        ("Club X présente : Anna", "Anna", "Club X", "presents"),
        ("Super Records invites Anna, Bob b2b Carl", "Anna", "Super Records", "invites"),
        ("Anna invites Bob, Carl", "Anna invites Bob, Carl", None, None),
        ("Strangelove - The Depeche Mode Experience", "Strangelove", "The Depeche Mode Experience", "tribute show"),
        ("Anna (FR)", "Anna", None, "label"),
        ("Anna (trio)", "Anna (trio)", None, None),
        ("", "", None, None),
    ],
)
def test_title_rules(title, artist, event_title, rule):
    x = titles.rewrite(titles.Listing(title, "LE TRABENDO", "2026-11-14", "19:30"))
    assert (x.title, x.event_title, x.rules) == (artist, event_title, [rule] if rule else [])
    assert x.originals == ([title] if rule else [])


@pytest.mark.parametrize(
    ("title", "artist", "event_title", "rule"),
    [
        ("Anna (Opening Act: Bob)", "Anna", None, "support"),
        ("Anna (support: Bob)", "Anna (support: Bob)", None, None),
        ("Anna - Album Release Party at noon", "Anna", "Album Release Party at noon", "release"),
        ("Anna - 19h30", "Anna", None, "time"),
        ("Anna, 19:30", "Anna", None, "time"),
        ("Anna 20h", "Anna 20h", None, None),
        ("Anna | 14.11.2026", "Anna", None, "day"),
        ("Anna “Tournée d'adieu”", "Anna", "Tournée d'adieu", "quoted tour"),
        ("Anna « Red Tour »", "Anna", "Red Tour", "quoted tour"),
        ("Anna with Very Special Guest", "Anna", "Anna with Very Special Guest", "unnamed guest"),
        ("Anna with Bob", "Anna with Bob", None, None),
        ("Scène Ouverte + Anna + Bob", "Anna + Bob", "Scène Ouverte", "open stage"),
        ("Anna + Bob", "Anna + Bob", None, None),
        ("Radio presents Anna", "Anna", "Radio", "presents"),
        ("Club présentent: Anna", "Anna", "Club", "presents"),
        ("Blue Club invite : Anna b2b Bob", "Anna", "Blue Club", "invites"),
        ("Blue Club invites Anna, TBA", "Blue Club invites Anna, TBA", None, None),
        ("Launch Party of Red — Anna", "Anna", "Launch Party of Red", "release party"),
        ("Anna – Nouvel album Rouge", "Anna", "Nouvel album Rouge", "album"),
        ("Anna - The Blue Show", "Anna", "The Blue Show", "tribute show"),
        ("Anna Release Party II", "Anna", "Anna Release Party II", "release suffix"),
        ('Anna launch party "Red"', "Anna", 'Anna launch party "Red"', "release suffix"),
        ("Anna release party + Bob", "Anna release party + Bob", None, None),
        ("Anna: The Red Tour", "Anna", "Anna: The Red Tour", "tour"),
        ("Anna – Detour", "Anna – Detour", None, None),
        ("Anna (release party)", "Anna", "Release Party", "label"),
        ("Anna (usa)", "Anna", None, "label"),
    ],
)
def test_title_marks(title, artist, event_title, rule):
    test_title_rules(title, artist, event_title, rule)


def test_title_rules_follow_each_other():
    x = titles.rewrite(titles.Listing('Radio présente : Anna "Red Tour" (FR)', day="2026-11-14"))
    assert (x.title, x.event_title, x.rules) == ('Anna "Red Tour"', "Radio", ["presents", "label"])
    x = titles.rewrite(titles.Listing("Anna (première partie : Bob) (FR)"))
    assert x.rules == ["label"]  # brackets in the middle are no mark
    x = titles.rewrite(titles.Listing("Jam menée par X", about="Jam menée par Zoé Durand, et amis"))
    assert x.rules == []
    x = titles.rewrite(titles.Listing("Jam Zoé Durand", about="Jam menée par Zoé Durand, et amis"))
    assert (x.title, x.event_title, x.rules) == ("Zoé Durand", "Jam Zoé Durand", ["described"])


def test_article_types(spark):
    cases = [
        ("x", ["Concert Review"], "concert_review"), ("x", ["concert", "review"], "concert_review"), ("x", ["Interview", "album review"], "interview"), ("Album review : Red", [], "album_review"), ("Album Review: Red", ["news"], "album_review"),
        ("x", ["Friday's Playlist"], "playlist"), ("Interview: x", ["Announcement"], "news"), ("Anna @ Hall, Paris – March 3rd, 2024", None, "concert_review"), ("Anna @ Hall - March 2024", None, "other"), ("Anna - March 3, 2024", None, "other"),
        ("An interview with Anna", None, "interview"), ("An interview without", None, "other"), ("Friday’s Playlist 12", None, "playlist"), ("Playlist: May", None, "playlist"), ("Anna announces tour", None, "news"), ("Anna shares a new song", None, "news"), ("Anna shared the new", None, "news"), ("New Albums", None, "other"), ("Anna, new album", None, "news"), (None, None, "other"),
    ]
    df = spark.createDataFrame([(i, t, l) for i, (t, l, _) in enumerate(cases)], "i int, t string, l array<string>")
    got = {r.i: r.k for r in df.select("i", payloads.article_type(F.col("t"), F.col("l")).alias("k")).collect()}
    assert got == {i: k for i, (_, _, k) in enumerate(cases)}


def test_locked_rows_keep_wrappers_only():
    assert titles.rewrite(titles.Listing("Club X présente : Anna"), locked=True).rules == []
    assert titles.rewrite(titles.Listing('Anna "Big Tour"'), locked=True).title == "Anna"


def test_tribute_describes_no_performer():
    about = "Soirée animée par Bob Dole."
    assert titles.rewrite(titles.Listing("Hommage à Bob Dole", about=about)).title == "Hommage à Bob Dole"
    assert titles.rewrite(titles.Listing("Hommage à Ella avec Bob Dole", about=about)).title == "Bob Dole"


def test_bill_partition_needs_one_cover():
    known = {n.casefold(): n for n in ("Earth, Wind & Fire", "A", "B", "A & B", "C")}
    assert bills.partition("Earth, Wind & Fire + C", known) == ["Earth, Wind & Fire", "C"]
    assert bills.partition("A & B + C", known) == []  # two covers
    assert bills.partition("A & B", known) == []  # a name of its own
    assert bills.partition("A + A", known) == [] and bills.partition("", known) == []
    assert bills.split_plus("A + B (x + y) + C") == ["A", "B (x + y)", "C"] and bills.split_plus("A+B") == []
    assert titles.credits_of("Piano: Anna Foo\nbasse - Bob Bar\nbla") == ["Anna Foo", "Bob Bar"] and titles.credits_of("Piano: Anna Foo") == []


def test_payloads():
    page = '<script type="application/ld+json">{"@graph":[{"@type":"Event","name":"é"},{"@type":"Place"}]}</script><script type="application/ld+json">{bad</script>'
    assert [json.loads(e)["name"] for e in payloads.linked_events(page)] == ["é"]
    assert payloads.js_literal_text("var x = 1; const data = [1, ']', {a: \"}\"} /* ] */ ]; y", "data") == "[1, ']', {a: \"}\"} /* ] */ ]"
    assert payloads.js_literal_text("data = [1, 2", "data") is None and payloads.js_literal_text("data = [}", "data") is None
    assert payloads.expand_indexed([{"a": 1, "b": 2}, "x", ["Reactive", 3], [1, 1]]) == {"a": "x", "b": ["x", "x"]}
    loop = payloads.expand_indexed([{"self": 0}])
    assert loop["self"] is loop


def test_written_dates_and_sitemap(spark):
    df = spark.createDataFrame([("le 12 mars 2026",), ("1er aout",), ("31 fevrier 2026",), ("x",), (None,)], "t string")
    got = [str(r.d) for r in df.select(payloads.written_date(F.col("t"), F.lit(2025)).alias("d")).collect()]
    assert got == ["2026-03-12", "2025-08-01", "None", "None", "None"]
    xml = spark.createDataFrame([("<loc> a?b&amp;c </loc><loc>d</loc><loc>d</loc>",)], "x string")
    assert xml.select(payloads.sitemap_urls(F.col("x"))).first()[0] == ["a?b&c", "d"]


def listed(row, title, time=None, source="a", official=False, ticket=None):
    return {"row": row, "title": title, "time": time, "source": source, "official": official, "ticket": ticket}


@pytest.mark.parametrize(
    ("rows", "merged"),
    [
        ([("A", "19:00"), ("A", "21:00", "b")], False),
        ([("A", "19:00"), ("A", None, "b")], True),
        ([("A & B", None, "a"), ("B x A", None, "b")], True),
        ([("A & B", None, "a"), ("A + B", None, "a")], False),
        ([("A", None, "a"), ("A + B", None, "b")], True),
        ([("A - Big Tour", None, "a"), ("A", None, "b")], True),
        ([("A - Big Tour", None, "a"), ("A", None, "a")], False),
        ([("A - Big Tour", None, "a"), ("A - Other Tour", None, "b")], False),
        ([("A", "19:00", "v", True), ("A", "20:00", "b")], True),
        ([("A", "19:00", "c"), ("A", "20:00", "b")], False),
        ([("Foo", None, "a", False, "t"), ("Bar", None, "a", False, "t")], True),
        ([("Foo", "19:00", "a", False, "t"), ("Bar", "20:00", "b", False, "t")], False),
        ([("A tribute", None, "a", False, "t"), ("A", None, "b", False, "t")], False),
        ([("A pass", None, "a"), ("A", None, "b")], False),
        ([("Éa (live)", None, "a"), ("EA", None, "b")], True),
        ([("A early show", None, "a", False, "t"), ("A late show", None, "b", False, "t")], False),
    ],
)
def test_listing_merge_rules(rows, merged):
    for order in (rows, rows[::-1]):
        got = listings.groups_of([listed(i, *r) for i, r in enumerate(order)])
        assert (got[0] == got[1]) is merged


def test_untimed_row_is_no_bridge_and_copies_follow(spark):
    schema = "row int, day string, venue_key string, title string, time string, source string, official boolean, ticket string"
    rows = [(1, "d", "v", "A", "19:00", "a", None, None), (2, "d", "v", "A", None, "b", None, None), (3, "d", "v", "A", "21:00", "c", None, None), (4, "d", "v", "A", "19:00", "a", False, None), (5, "d", "w", None, None, None, None, None)]
    rows += [(6, "d", None, "A", "19:00", "a", None, None), (7, "d", None, "A", "19:00", "a", None, None), (8, None, "v", "A", "19:00", "b", None, None), (9, "d", "", "A", None, "b", None, None)]
    rows += [(10, "e", "v", "A", "19:00", "a", None, None), (11, "e", "v", "A", "19h00", "b", None, None), (12, "f", "v", "X", None, "a", None, "https://t.org/e/1?utm_source=a"), (13, "f", "v", "Y", None, "b", None, "https://T.org/e/1/")]
    got = {r.row: r.group for r in listings.merge(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 1, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10, 11: 10, 12: 12, 13: 12}
    assert listings.merge(spark.createDataFrame([], schema)).count() == 0


SIDE = "row string, day date, time string, headliner string, co_headliners array<string>, venue string, city string, ticket string"
D = dt.date


def brute_score(a, b, alone):
    """The edge rules said again, plainly, for names of ASCII letters and full tickets."""
    if a[2] and b[2] and a[2] != b[2]:
        return None
    ticket, venue = a[7] is not None and a[7] == b[7], (a[5], a[6]) == (b[5], b[6])
    n, o = a[3].lower(), b[3].lower()
    bill = n == o
    if a[1] != b[1] and not (ticket and venue and bill and alone(a[7]) and abs((a[1] - b[1]).days) <= 180):
        return None
    richer = o != n and f" {o} " in f" {' '.join(n.replace('+', ' ').split())} " and " + " in a[3]
    spelled = SequenceMatcher(None, o, " ".join(n.replace("+", " ").split()), autojunk=False).ratio() >= 0.96
    dressed = any(o == f"{n} {w}" or n == f"{o} {w}" for w in identity.PRESENTATION)
    if not ticket and not (venue and (bill or richer or spelled or dressed)):
        return None
    score = 400 if ticket else 340 if bill else 300 if spelled else 280
    return score + 40 * venue + 20 * bill + 10 * bool(a[2] and a[2] == b[2])


def test_continuity_equals_all_pairs(spark):
    d1, d2, far = D(2026, 5, 1), D(2026, 6, 1), D(2027, 5, 1)
    old = [("p1", d1, "19:00", "Anna", None, "Hall", "Paris", "https://t.org/e/1"), ("p2", d1, None, "Bob", None, "Hall", "Paris", None), ("p3", d1, "20:00", "Carl Long Name And More Words", None, "Hall", "Paris", "https://t.org/e/2"), ("p4", d1, None, "Dan", None, "Club", "Paris", "https://t.org/e/2"), ("p5", d1, None, "Eve", None, "Club", "Paris", "https://t.org/e/5")]
    new = [("a", d2, "19:00", "Anna", None, "Hall", "Paris", "https://t.org/e/1"), ("b", d1, "21:00", "Bob + Zed", None, "Hall", "Paris", None), ("c", d1, None, "Carl Long Name And More Wordz", None, "Hall", "Paris", None), ("d", d2, None, "Dan", None, "Club", "Paris", "https://t.org/e/2"), ("e", far, None, "Eve", None, "Club", "Paris", "https://t.org/e/5"), ("f", d1, None, "Dan Live", None, "Club", "Paris", None), ("g", d1, "18:00", "Anna", None, "Hall", "Paris", None)]
    alone = lambda t: sum(r[7] == t for r in old) == 1 and sum(r[7] == t for r in new) == 1
    want = {(a[0], b[0], s) for a in new for b in old if (s := brute_score(a, b, alone)) is not None}
    got = identity.continuity(spark.createDataFrame(new, SIDE), spark.createDataFrame(old, SIDE).withColumnRenamed("row", "pid"), "row", "pid")
    assert {tuple(r) for r in got.collect()} == want and len(want) >= 4


def test_names_of_one_place_and_day_meet_by_keys(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abc ") for _ in range(n)).strip() + "z" for n in [*range(3, 16), *range(20, 34)] * 2]
    less = lambda n: (lambda i: n[:i] + n[i + 1 :])(rng.randrange(len(n)))
    vary = lambda n: rng.choice([n, n, less(n), less(less(n)), n + "q", n[:-1] + "y", f"{n} live", f"{n} world tour", f"{n} + {rng.choice(base)}", f"{rng.choice(base)} + {n} + x"])
    side = lambda tag: [(f"{tag}{i}", D(2026, 5, 1), rng.choice([None, "19:00", "20:00"]), " ".join(vary(n).split()), None, "Hall", "Paris", None) for i, n in enumerate(base * 2)]
    old, new = side("p"), side("n")
    old = [r for r in old if "+" not in r[3]]
    want = {(a[0], b[0], s) for a in new for b in old if (s := brute_score(a, b, lambda t: False)) is not None}
    got = identity.continuity(spark.createDataFrame(new, SIDE), spark.createDataFrame(old, SIDE).withColumnRenamed("row", "pid"), "row", "pid")
    assert {tuple(r) for r in got.collect()} == want and {300, 280} <= {s // 20 * 20 - 40 for _, _, s in want}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    met = [line for line in plan.splitlines() if "Join Inner" in line and "a_venue" in line and "a_day" in line]
    loose = [line for line in met if "_key" not in line and "a_bill" not in line.split("a_time")[0] and "a_ticket" not in line]
    assert met and len(loose) <= 1 and "length(a_name" in plan and ">= 24)" in plan


def test_assigned_identities_are_kept_and_unique(spark):
    rows = spark.createDataFrame([("a", "x", ""), ("b", "x", "19:00"), ("c", "y", ""), ("d", "y", ""), ("e", "z", "")], "row string, base string, performance string")
    state = spark.createDataFrame([("k1", "id1", "x", "19:00"), ("k2", "id2", "q", "")], "key string, public_id string, base string, performance string")
    got = {r.row: (r.key, r.public_id) for r in identity.assign(rows, state, spark.createDataFrame([("e", "id2")], "row string, public_id string"), "row").collect()}
    assert got["b"] == ("k1", "id1") and got["e"] == ("k2", "id2") and got["c"][0] == "y"
    assert len({v[0] for v in got.values()}) == len({v[1] for v in got.values()}) == 5


def test_quarantine(spark):
    df = spark.createDataFrame([("x", ""), ("x", ""), ("x", "1"), ("y", "")], "base string, performance string")
    kept, bad = identity.quarantine(df, "base", "performance")
    assert (kept.count(), bad.count()) == (1, 3)
    with pytest.raises(ValueError):
        identity.quarantine(df.where("base = 'x'"), "base", "performance")


def test_snapshot_update(spark):
    now, today = F.lit("2026-05-08 00:00:00").cast("timestamp"), F.lit("2026-05-08").cast("date")
    held = spark.createDataFrame([("a", D(2026, 5, 9), "k1"), ("a", D(2026, 5, 1), "k2"), ("b", D(2026, 5, 9), "k3"), ("c", D(2026, 5, 9), "k4")], "source string, day date, k string").withColumn("last_success", F.lit("2026-05-07 00:00:00").cast("timestamp"))
    fresh = spark.createDataFrame([("b", D(2026, 5, 9), "n"), ("c", D(2026, 5, 9), "k4")], "source string, day date, k string")
    judged = spark.createDataFrame([("a", "failed"), ("b", "ok"), ("c", "partial")], "source string, status string")
    fates = snapshots.replay(fresh, held, judged, ["k"], now, today)
    assert {(r.k, r.fate) for r in fates.collect()} == {("k1", "restored"), ("k2", "past"), ("k4", "suppressed")}
    assert {(r.source, r.k) for r in snapshots.update(fresh, fates, judged, now, today).collect()} == {("a", "k1"), ("b", "n"), ("c", "k4")}


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")

    def broken(_):
        raise OSError("no")

    S = registry.Source
    rows, loads = registry.scan(spark, [S("b", broken, 1), S("a", lambda s: df, 2), S("c", broken, 3, fallback=lambda s: df, fallback_name="c2"), S("d", lambda s: df.where("false"), 4, allow_empty=True)])
    assert {(r.source, r.status, r.path) for r in registry.health(rows, loads).collect()} == {("b", "failed", "primary"), ("a", "ok", "primary"), ("c", "ok", "fallback"), ("d", "empty", "primary")}
    with pytest.raises(ValueError):
        registry.ordered([S("A", broken), S("a", broken)])
    (tmp_path / "p1.json").write_text('{"a":1}\n{"a":2}\n')
    (tmp_path / "p2.json").write_text("")
    spark.dataSource.register(registry.Pages)
    got = spark.read.format("tallyfold_pages").option("path", str(tmp_path)).option("delay", "0").load()
    assert [(r.page, r.line, r.value) for r in got.orderBy("line").collect()] == [("p1.json", 0, '{"a":1}'), ("p1.json", 1, '{"a":2}')]
    opened = []

    def flaky(path, **kw):
        opened.append(path)
        if len(opened) < 3:
            raise OSError("busy")
        return open(path, **kw)

    reader = registry._PageReader({"path": str(tmp_path), "delay": "0"})
    import builtins

    registry.__dict__["open"] = flaky
    try:
        assert len(list(reader.read(registry._Page(str(tmp_path / "p1.json"))))) == 2 and len(opened) == 3
    finally:
        del registry.__dict__["open"]
    assert registry.__dict__.get("open", builtins.open) is builtins.open
    reads = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "a"), (3, "c"), (4, "a"), (4, "c")], "read int, k string")
    assert {r.k for r in registry.fullest_read(reads, "read", "k").collect()} == {"a", "c"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "<a&b>", ["x", "y"]), (2, None, [])], "i int, t string, l array<string>")
    assert sinks.digest(df) == sinks.digest(df.repartition(3)) != sinks.digest(df.union(df.limit(1)))
    pointer = sinks.publish(df, str(tmp_path), "set", "now")
    assert sinks.publish(df.repartition(2), str(tmp_path), "set", "now") == pointer
    text = "".join(r.value for r in spark.read.text(f"{tmp_path}/{pointer['data']}").collect())
    assert not set("<>&") & set(text)
    assert sorted(map(tuple, sinks.read_published(spark, str(tmp_path), "set", df.schema).collect())) == sorted(map(tuple, df.collect()))
    df.limit(1).select(sinks.escaped_json(df.columns).alias("value")).write.mode("overwrite").text(f"{tmp_path}/{pointer['data']}")
    with pytest.raises(ValueError):
        sinks.read_published(spark, str(tmp_path), "set", df.schema)
    sinks.write_csv(df, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").where("i = 1").first().l == "x | y"
    routes = spark.createDataFrame([("artist", "a", 2), ("artist", "a", 1), ("genre", "a", 3), ("genre", "", 4)], "kind string, slug string, n int")
    sinks.write_routes(routes, f"{tmp_path}/routes", "kind", "slug", [F.col("n")])
    assert {(r.kind, r.n) for r in spark.read.parquet(f"{tmp_path}/routes").collect()} == {("artist", 1), ("genre", 3)}


def test_gate_and_periods(spark):
    rows = spark.createDataFrame([(f"{i:016x}", D(2026, 5, 1), f"A{i}", "Hall", None, "Rock") for i in range(120)], "public_id string, day date, headliner string, venue string, time string, genre string")
    refused = lambda d, n=0: reports.gate(d, n, ["Rock"]).first().refusals
    assert refused(rows, 100) == [] and refused(rows, 300) == ["count"] and refused(rows.limit(9)) == ["too few"]
    assert refused(rows.union(rows.limit(1))) == ["repeated ids", "twins"]
    assert refused(rows.withColumn("headliner", F.concat(F.lit("<b>"), "headliner"))) == ["faults"]
    assert refused(rows.where("false")) == ["too few"]
    one = spark.range(1)
    got = [one.select(*reports.last_period(F.lit("2027-01-05").cast("date"), f)).first() for f in ("weekly", "monthly")]
    assert [tuple(map(str, r)) for r in got] == [("2026-W53", "2026-12-28", "2027-01-04"), ("2026-12", "2026-12-01", "2027-01-01")]


def test_places(spark):
    from tallyfold.operators import places

    text = spark.createDataFrame([(1, "at the grand hall tonight"), (2, "the grandhall"), (3, "hall"), (4, ""), (5, None)], "row int, t string")
    aliases = spark.createDataFrame([("grand hall", "G", 1), ("hall", "H", 2)], "alias string, place string, order int")
    assert {tuple(r) for r in places.named_places(text, "row", "t", aliases).collect()} == {(1, "G"), (3, "H")}
    with pytest.raises(ValueError):
        places.named_places(text, "row", "t", aliases, longest=1)
    bills_ = spark.createDataFrame([(1, "d", "v", ["B", "a"], "x"), (2, "d", "w", ["a"], "x")], "row int, day string, venue string, names array<string>, source string")
    rosters = spark.createDataFrame([("d", "v", ["A", "B"], "y"), ("d", "w", ["a"], "x")], "day string, venue string, members array<string>, source string")
    assert [tuple(r) for r in places.rosters_elsewhere(bills_, rosters, "row").collect()] == [(1, ["A", "B"])]


def test_enrichment_rungs(spark):
    from tallyfold.operators import enrichment

    df = spark.createDataFrame([(1, "Pop, Rock"), (2, "pop, odd"), (3, "jazz/odd"), (4, "cumbia grime"), (5, None), (6, "Jazz actuel")], "row int, raw string")
    exact = spark.createDataFrame([("pop", "Pop"), ("rock", "Rock")], "term string, genre string")
    none = spark.createDataFrame([], "term string, genres array<string>")
    got = {r.row: (r.genres, r.method) for r in enrichment.raw_genres(df, "row", "raw", exact, none, {"W": ["cumbia"], "R": ["grime"]}).collect()}
    assert got == {1: (["Pop", "Rock"], "exact"), 6: (["Jazz / Blues"], "jazz")}
    ctx = spark.createDataFrame([(1, "a techno night"), (2, "techno and punk"), (3, "techno")], "row int, t string")
    acts = spark.createDataFrame([(3, "x")], "row int, artist string")
    known = spark.createDataFrame([("x", "P")], "artist string, genre string")
    assert [tuple(r) for r in enrichment.agreed_context(ctx, "row", "t", {"E": ["techno"], "P": ["punk"]}, acts, known).collect()] == [(1, "E")]


def test_ranges_keep_repeated_points(spark):
    from tallyfold.operators import joins

    points = spark.createDataFrame([("v", 1, "x"), ("v", 1, "x"), ("v", 9, "y"), (None, 1, "z")], "k string, at int, note string")
    ranges = spark.createDataFrame([("v", 0, 5, "A"), ("v", 1, 2, "A"), ("v", 8, 9, "A"), ("v", 9, 9, "B")], "k string, first int, last int, credit string")
    assert sorted(map(tuple, joins.unique_in_range(points, ranges, ["k"], "at", "first", "last", "credit").collect())) == [("v", 1, "x", "A")] * 2


def test_only_engagements_alike_are_folded_again(spark, monkeypatch):
    folded, real = [], listings._engagements
    monkeypatch.setattr(listings, "_engagements", lambda rows, fills, row: folded.append(rows.select(row).collect()) or real(rows, fills, row))
    at = lambda i, title, time=None, source="a", programme=None: (i, "2026-01-01", "v", title, time, source, False, None, "2025-01-01", False, programme, i)
    data = [at(1, "Ana"), at(2, "Ben", "19:00"), at(3, "Ben", "19:00", "b"), at(4, "Cy"), at(5, "Cy + Guests", None, "b"), at(6, "Été", "20:00"), at(7, "Ana", "21:00", "a", "p"), at(8, "Cleo & Dan", "19:00"), at(9, "Cleo", "19:00", "b"), at(10, "Dan", "19:00", "c"), at(11, "Cleo", "19:00", "c")]
    df = spark.createDataFrame(data, "row int, day string, venue_key string, title string, time string, source string, official boolean, ticket string, first_seen string, sold_out boolean, programme string, price int")
    got = {r["group"]: r["rows"] for r in listings.merged(df, ["price"]).collect()}
    assert sum(got.values()) == len(data)
    assert len(folded) == 2 and len(folded[1]) < len(folded[0]) == len(data)
