"""Articles, programmes, archives and images on small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import media
from tallyfold.operators import calendar, editorial, programmes


@pytest.mark.parametrize(
    ("title", "kind", "about"),
    [
        ("Anna Lou @ Le Trabendo - May 1st, 2026", "concert_review", "Anna Lou"),
        ("Album review: Anna – Red", "album_review", "Anna"),
        ("A conversation with Anna - at home", "interview", "Anna"),
        ("Interview with Anna", "interview", "Anna"),
        ("The Shares shares: a new song", "news", "The"),
        ("Anna announces  a tour", "news", "Anna"),
        ("Anna to celebrate ten years", "news", "Anna"),
        ("Anna", "news", None),
        ("Announces", "news", None),
        ("", "other", None),
        (None, "news", None),
    ],
)
def test_subject(spark, title, kind, about):
    got = spark.createDataFrame([(title, kind)], "t string, k string").select(editorial.subject(F.col("t"), F.col("k"))).first()[0]
    assert got == about


def test_labels_follow_the_subject(spark):
    a = spark.createDataFrame([(1, "Anna announces a tour", "news", ["Anna", "Bob", "Anna", None]), (2, "On tour", "other", ["Anna", "Rock"]), (3, "Rock announces more", "news", ["Rock"]), (4, "x", "other", None)], "id int, title string, type string, labels array<string>")
    got = {(r.id, r.label) for r in editorial.primary_labels(a, ["rock"]).collect()}
    assert got == {(1, "Anna"), (2, "Anna"), (3, "Rock")}


def test_known_artists(spark):
    known = spark.createDataFrame([(n,) for n in ("Brant Bjork", "Bjork", "Duff McKagan", "Pineapple Thief", "Abba", "Été", "", None)], "artist string")
    asked = {1: "brant bjork", 2: "Brant Bjork Trio", 3: "Duff Mc Kagan", 4: "The Pineapple Thief (DJ Set)", 5: "Abba Tribute", 6: "ABBA", 7: "Ete", 8: None, 9: "", 10: "Lex Bjork"}
    got = dict(tuple(r) for r in editorial.known_artists(spark.createDataFrame(list(asked.items()), "id int, name string"), known).collect())
    assert got == {1: "Brant Bjork", 2: "Brant Bjork", 3: "Duff McKagan", 4: "Pineapple Thief", 6: "Abba", 10: "Bjork"}
    assert editorial.known_artists(spark.createDataFrame([(1, "a")], "id int, name string"), known.where("false")).count() == 0


def test_who_may_found(spark):
    names = {"Anna": True, "Anna @ Club": False, "Anna & Bob": False, "Anna feat. Bob": False, "Anna - Lyon, FR": False, "Rock": False, "Festival X": False, "Andy": True, None: False, "": False}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0]: r[1] for r in df.select("n", editorial.may_found(F.col("n"), ["rock"])).collect()} == names


def test_editorial_genres(spark):
    artists = spark.createDataFrame([("a", "Anna", "anna", None), ("b", "Bob", "bob", None), ("c", "Carl", "carl", ["Jazz", "Jazz"]), ("d", "Dee", "dee", ["Jazz", None]), ("e", "Eve", "eve", None), ("f", "Eve", "eve", None)], "slug string, name string, key string, reviewed array<string>")
    articles = spark.createDataFrame([(i, t) for i, t in enumerate(["Anna: live!", "ANNA again", "Bob", "Bob 2", "Annabel", "Dee", "Dee", "Eve", "Eve"])], "id int, title string")
    credits = spark.createDataFrame([(0, "a"), (1, "a"), (1, "a"), (2, "b"), (3, "b"), (4, "a"), (5, "d"), (6, "d"), (7, "e"), (8, "e")], "id int, slug string")
    labels = spark.createDataFrame([(0, "Rock"), (1, "Rock"), (2, "Rock"), (3, "Pop"), (4, "Pop"), (5, "Pop"), (6, "Pop"), (7, "Pop"), (8, "Pop")], "id int, genre string")
    genres = editorial.editorial_genres(artists, articles, credits, labels)
    assert {tuple(r) for r in genres.collect()} == {("anna", "Rock", "editorial_article_consensus"), ("carl", "Jazz", "editorial_reviewed_identity")}
    events = spark.createDataFrame([(1, "anna", None, None, True), (2, "anna", "Pop", "m", True), (3, "anna", None, None, False), (4, None, None, None, True)], "id int, key string, genre string, method string, alone boolean")
    assert {r.id: r.genre for r in editorial.editorial_fill(events, genres).collect()} == {1: "Rock", 2: "Pop", 3: None, 4: None}


def test_review_places(spark):
    a = spark.createDataFrame([(1, "Anna @ Le Club - May 1st, 2026", "concert_review"), (2, "Anna @ Elsewhere", "concert_review"), (3, "Anna", "news"), (4, "Anna live", "concert_review")], "id int, title string, type string")
    places = spark.createDataFrame([("le club", "LE CLUB")], "key string, venue string")
    assert {tuple(r) for r in editorial.review_places(a, places).collect()} == {(1, "LE CLUB", "associated"), (2, None, "unresolved"), (4, None, "unresolved")}


def test_festival_days_and_windows(spark):
    acts = spark.createDataFrame([("d", 1, "A", 60, True), ("d", 2, "B", 90, True), ("d", 3, "C", 120, False), ("d", 4, "D", 90, True), ("e", 1, "E", 10, False)], "day string, position int, artist string, minutes int, main boolean")
    assert [tuple(r) for r in programmes.festival_days(acts, F.col("main")).collect()] == [("d", "B", ["A", "C", "D"])]
    first = dt.date(2026, 1, 1)
    w = programmes.date_windows(spark, first, 16, 7)
    assert sorted(tuple(r) for r in w.collect()) == [(first, dt.date(2026, 1, 7)), (dt.date(2026, 1, 8), dt.date(2026, 1, 14)), (dt.date(2026, 1, 15), dt.date(2026, 1, 16))]
    halves = sorted(tuple(r) for r in programmes.bisected(w.withColumn("more", F.col("start") >= dt.date(2026, 1, 8))).collect())
    assert halves == [(dt.date(2026, 1, 8), dt.date(2026, 1, 11)), (dt.date(2026, 1, 12), dt.date(2026, 1, 14)), (dt.date(2026, 1, 15), dt.date(2026, 1, 15)), (dt.date(2026, 1, 16), dt.date(2026, 1, 16))]
    assert programmes.bisected(w.selectExpr("start", "start stop", "true more")).count() == 0
    assert programmes.within_windows(w.withColumn("day", F.lit(first)), "day").count() == 1


def test_structured_identities(spark):
    rows = [("x", ["Anna", "Bob"], ["s1"]), ("x", ["Anna", "Ed"], ["s1", "s2"]), ("x", ["Solo"], ["s1"]), ("x", ["Gus", "gus"], ["s1"]), ("A + B", ["A + B", "Zoe"], ["s1"]), ("x", ["Hugo", "Ines"], []), ("x", None, ["s1"]), ("x", ["Known", "Guests"], ["s1"])]
    e = spark.createDataFrame(rows, "title string, performers array<string>, sources array<string>")
    known = spark.createDataFrame([("known", "The Known")], "key string, name string")
    got = {r.key: (r.status, r.name, r.sources, r.events) for r in programmes.structured_identities(e, known).collect()}
    assert got == {"anna": ("new_verified", "Anna", 2, 2), "bob": ("short_name", "Bob", 1, 1), "ed": ("new_verified", "Ed", 2, 1), "known": ("already_known", "The Known", 1, 1), "guests": ("new_verified", "Guests", 1, 1)}
    sure = programmes.structured_identities(e, known, F.lower("name") != "guests").collect()
    assert {r.key for r in sure} == {"anna", "bob", "ed"}


def test_merged_bills_and_those_kept_apart(spark):
    rows = [(1, "Anna & Eve", "s"), (1, "Anna & Eve + Bob, Carl", "t"), (2, "Anna", "s"), (2, "Anna + Bob", "s"), (3, "Anna", "s"), (3, "Annabel + Bob", "t")]
    got = {r["group"]: (r.headliner, r.co_headliners) for r in programmes.headlined(spark.createDataFrame(rows, "group int, title string, source string")).collect()}
    assert got == {1: ("Anna & Eve", ["Bob", "Carl"]), 2: ("Anna", []), 3: ("Anna", [])}
    m = spark.createDataFrame([("d", "v", "a", 1), ("d", "v", "b", 2), ("d", "w", "b", 3), ("d", None, "a", 4), ("d", None, "a", 5)], "day string, venue string, key string, group int")
    equal = spark.createDataFrame([("d", "v", "b", "a")], "day string, venue string, key string, same string")
    assert programmes.kept_apart(m).count() == 0
    assert [tuple(r) for r in programmes.kept_apart(programmes.reviewed_titles(m, equal)).collect()] == [("d", "v", "a", 2, 1, 2)]


def test_archive(spark):
    posts, payloads, static = (spark.createDataFrame(r, s) for r, s in (([(1, "a"), (2, "b")], "post int, x string"), ([(2, "p"), (3, "q")], "post int, y string"), ([(3, "s"), (4, "t")], "post int, z string")))
    assert {r.post: r.sides for r in programmes.archive_audit(posts, payloads, static).collect()} == {1: "post", 2: "post+payload", 3: "payload+static", 4: "static"}
    ids = spark.createDataFrame([(1, ["A"], True, "7"), (2, ["a "], True, "7"), (3, ["B"], True, "1"), (4, ["B"], True, "2"), (5, ["C", "D"], True, "3"), (6, ["E"], False, "4"), (7, ["F"], True, "")], "post int, names array<string>, confident boolean, external string")
    assert [tuple(r) for r in programmes.agreed_ids(ids).collect()] == [("a", "7", 2)]


def test_images_and_times(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    host = "https://1.bp.blogspot.com"
    assert one(media.large_image(F.lit(f"{host}/a/S72-w640-h426-c-rw/x.jpg?u=/s72/"))) == f"{host}/a/w1200-h800/x.jpg?u=/s72/"
    assert one(media.large_image(F.lit("https://blogger.googleusercontent.com/img/abc=s400#top"))) == "https://blogger.googleusercontent.com/img/abc=w1200-h800#top"
    assert one(media.large_image(F.lit("https://x.org/s72/x.jpg"))) == "https://x.org/s72/x.jpg"
    assert one(media.thumbnail(F.lit(f"{host}/s72-c/x.jpg"))) == f"{host}/s320-c/x.jpg"
    assert one(media.thumbnail(F.lit("http://x.org/s72/x.jpg"))) is None
    assert one(media.widest(F.lit("a 300w, b 1200w, c 2x"), F.lit("d"))) == "b"
    assert one(media.widest(F.lit(None).cast("string"), F.lit("d"))) == one(media.widest(F.lit(" , "), F.lit("d"))) == "d"
    assert one(media.utc_iso(media.zoned_time(F.lit("2026-01-31T19:05:00+01:00")))) == "2026-01-31T18:05:00Z"
    assert one(media.zoned_time(F.lit("2026-01-31T19:05:00"))) is None and one(media.zoned_time(F.lit("2026-13-31T19:05:00Z"))) is None


def test_orders_and_genre_lists(spark):
    e = spark.createDataFrame([(1, "d", "b", "V", "20:00", None), (2, "d", "A", "v", None, None), (3, "d", "B", "u", "20:00", "x")], "id int, day string, headliner string, venue string, start_time string, public_id string")
    ids = lambda keys: [r.id for r in e.orderBy(*keys).collect()]
    assert ids(calendar.venue_order()) == [2, 1, 3]
    assert ids(calendar.concert_order()) == [2, 3, 1]
    assert ids(calendar.canonical_order(F.struct(*e.columns))) == [2, 3, 1]
    g = spark.createDataFrame([(1, "Rock"), (2, "Punk"), (3, "Pop"), (4, None)], "id int, genre string")
    tree = spark.createDataFrame([("Punk", "Rock")], "genre string, ancestor string")
    assert {r.id for r in calendar.in_genres(g, "genre", ["Rock"], tree).collect()} == {1, 2}


def test_feeds_and_calendar_files(spark):
    from tallyfold.sources import registry, sinks

    pages = spark.createDataFrame([("a", "b"), ("b", None)], "cursor string, after string")
    assert registry.whole_feed(pages, "cursor", "after").count() == 2
    for bad in ([("a", "b"), ("b", "b")], [("a", "c"), ("b", "c")]):
        with pytest.raises(ValueError):
            registry.whole_feed(spark.createDataFrame(bad, pages.schema), "cursor", "after")
    text = spark.range(1).select(sinks.ics_file(F.lit("BEGIN:VEVENT\r\nEND:VEVENT"), "-//x//y")).first()[0]
    assert text.split("\r\n") == ["BEGIN:VCALENDAR", "VERSION:2.0", "PRODID:-//x//y", "CALSCALE:GREGORIAN", "BEGIN:VEVENT", "END:VEVENT", "END:VCALENDAR", ""]


def test_names_keep_the_place_of_their_first_spelling():
    from tallyfold.functions import titles

    assert titles.unique(["Anna", "Bob", " ANNA ", "", "Carl", "bob"]) == ["Anna", "Bob", "Carl"]


def test_periods_begin_on_mondays(spark):
    from tallyfold.streaming.first_seen import period_counts

    e = spark.createDataFrame([("2026-11-15 23:59:59", "a"), ("2026-11-16 00:00:00", "a"), ("2026-11-22 23:00:00", "a"), ("2026-11-18 10:00:00", "b")], "at string, event_type string").select(F.to_timestamp_ntz("at").alias("ts"), "event_type")
    got = {(str(r.window.start)[:10], r.event_type): r["count"] for r in period_counts(e).collect()}
    assert got == {("2026-11-09", "a"): 1, ("2026-11-16", "a"): 2, ("2026-11-16", "b"): 1}


def test_events_with_the_same_bill_share_what_is_found(spark):
    from tallyfold.operators import enrichment

    links = [(e, s, n) for e in range(30) for s, n in [("a", "A"), ("b", "B"), ("c", "C")][: 1 + e % 3]] + [(1, "a", "Á"), (99, "a", "A")]
    articles = [("a", "u1", "x", "2026-01-01"), ("a", "u1", "w", "2026-01-02"), ("b", "u1", "y", "2026-01-03"), ("c", "u2", "z", None), ("d", "u3", "z", None)]
    want = {}
    for e, s, n in links:
        for slug, url, kind, day in articles:
            if s == slug and e < 31:
                kinds, days, names = want.setdefault((e, url), (set(), set(), set()))
                kinds.add(kind), days.add(day or ""), names.add(n)
    got = enrichment.coverage(spark.createDataFrame([(e,) for e in [*range(31), 3]], "event int"), spark.createDataFrame(links, "event int, slug string, name string"), spark.createDataFrame(articles, "slug string, url string, type string, day string"))
    assert sorted(tuple(r) for r in got.fillna("").collect()) == sorted((e, u, min(k), max(d), sorted(n)) for (e, u), (k, d, n) in want.items())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # events meet what was found, it is not found for each
