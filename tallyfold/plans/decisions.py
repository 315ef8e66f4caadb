"""Queries of eligibility, genre and bill cascades, identities carried over, filled blanks and calendar orders, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import titles
from ..operators import calendar, cascades, eligibility
from ..sources.tables import table
from .registry import day, query

_TITLES = ("'Sold out !'", "'Blind-Test rock'", "'Soirée speed-dating'", "c_name || ' VIP pass'", "c_name", "'Club night'", "c_name || ' party'", "'Bloc Party + ' || c_name", "'Indie night'", "'Écoute immersive de disque'", "'Foo ep12'", "c_name || ' release party'")
_REASONS = ("'placeholder_title'", "'non_music_quiz_event'", "'non_music_social_event'", "'legacy_title_exclusion'", "'non_concert_category'", "NULL", "'legacy_title_exclusion'", "NULL", "NULL", "'non_music_listening_session'", "'unverified_late_night_edition'", "NULL")
_case = lambda values: "CASE c_custkey % 12 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query(f"SELECT c_custkey, {_case(_TITLES)} AS headliner, {_case(_REASONS)} AS reason FROM customer")
def eligibility_checks(spark, d):
    k, text = F.col("c_custkey") % 12, F.lit(None).cast("string")
    e = table(spark, d, "customer").select("c_custkey", F.expr(_case(_TITLES)).alias("headliner"), text.alias("raw_title"), text.alias("event_title"), text.alias("category"), F.when(k == 4, F.array(F.lit("Workshop"))).alias("tags"), F.when(k == 5, "Concert").alias("event_type"), F.when(k == 5, F.array("c_name")).alias("performers"), F.lit(None).cast("array<string>").alias("openers"), F.lit(None).cast("array<string>").alias("co_headliners"), text.alias("genre"), F.when(k == 10, "23:30").alias("start_time"), F.array(F.lit("DICE")).alias("sources"))
    return eligibility.judged(e).select("c_custkey", "headliner", "reason")


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_returnflag AS raw, CASE WHEN l_linestatus = 'O' THEN [l_returnflag] WHEN l_linenumber = 1 THEN ['A', 'N', 'R'] WHEN l_linenumber = 2 THEN ['A', 'N'] ELSE [] END AS genres, l_linestatus <> 'O' AND l_linenumber = 1 AS unordered, l_quantity < 20 AS weak FROM lineitem),
s AS (SELECT *, CASE WHEN unordered THEN [] ELSE genres END AS one FROM l),
g AS (SELECT l_orderkey, list_sort(list_distinct(flatten(list(one)))) AS mapped, list_distinct(list(one)) AS sets, bool_or(unordered) AS unresolved, bool_and(weak) AS weak, list(raw) AS raws FROM s GROUP BY 1),
e AS (SELECT o.*, g.*, o_totalprice > 480000 AS festival, o_orderpriority IN ('1-URGENT', '2-HIGH') AS artist, o_totalprice < 150000 AS override, o_orderstatus <> 'P' AS alone FROM orders o LEFT JOIN g ON l_orderkey = o_orderkey),
m AS (SELECT o_orderkey, CASE WHEN festival THEN 'blank_festival' WHEN unresolved AND len(mapped) = 0 THEN 'blank_unresolved_taxonomy' WHEN artist AND len(mapped) = 1 AND weak THEN 'artist_mapping' WHEN len(mapped) = 1 AND list_contains(raws, mapped[1]) THEN 'source_explicit' WHEN len(mapped) = 1 THEN 'source_mapping'
 WHEN len(mapped) > 1 AND list_contains(sets, mapped) THEN 'source_mapping' WHEN override AND alone THEN 'manual_override' WHEN len(mapped) > 1 THEN 'conflict' WHEN artist AND alone THEN 'artist_mapping' WHEN contains(o_orderpriority, 'LOW') THEN 'event_context' WHEN contains(o_orderpriority, 'MEDIUM') THEN 'event_context' WHEN o_orderstatus = 'O' THEN 'bill_consensus' WHEN mapped IS NULL THEN 'blank_no_raw' ELSE 'blank_unresolved_raw' END AS method, mapped, o_orderpriority FROM e)
SELECT o_orderkey, method, CASE method WHEN 'artist_mapping' THEN 'Artist' WHEN 'manual_override' THEN 'Override' WHEN 'source_explicit' THEN mapped[1] WHEN 'source_mapping' THEN mapped[1] WHEN 'event_context' THEN CASE WHEN contains(o_orderpriority, 'LOW') THEN 'Jazz' ELSE 'Pop' END WHEN 'bill_consensus' THEN 'Rock' END AS genre FROM m""")
def genre_branches(spark, d):
    open_, line = F.col("l_linestatus") == "O", F.col("l_linenumber")
    genres = F.when(open_, F.array("l_returnflag")).when(line == 1, F.array(*map(F.lit, "ANR"))).when(line == 2, F.array(*map(F.lit, "AN"))).otherwise(F.array().cast("array<string>"))
    e = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("raw"), genres.alias("genres"), (~open_ & (line == 1)).alias("unordered"), (F.col("l_quantity") < 20).alias("weak"))
    o = table(spark, d, "orders").join(cascades.source_genres(e, "o_orderkey"), "o_orderkey", "left")
    known = lambda test, g: F.when(test, F.struct(F.lit(g).alias("genre"), F.lit("registry").alias("source")))
    price, priority, status = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus")
    o = o.withColumns({"festival": F.when(price > 480000, "f"), "artist": known(priority.isin("1-URGENT", "2-HIGH"), "Artist"), "override": known(price < 150000, "Override"), "co_headliners": F.when(status == "P", F.array(F.lit("x"))), "venue_genre": F.when(F.contains(priority, F.lit("LOW")), "Jazz"), "context_genre": F.when(F.contains(priority, F.lit("MEDIUM")), "Pop"), "bill_genre": F.when(status == "O", "Rock")})
    return cascades.genre_cascade(o, "o_orderkey").select("o_orderkey", "method", "genre")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'reviewed_event' WHEN o_orderkey % 7 = 0 THEN 'structured_source' WHEN o_orderkey % 13 = 0 THEN 'reviewed_registry' WHEN o_orderstatus = 'P' THEN 'known_identity' WHEN o_orderkey % 5 = 0 THEN 'cross_source' WHEN o_orderkey % 3 = 0 THEN 'canonical_identity' WHEN o_orderkey % 2 = 0 AND 80 + o_custkey % 20 >= 90 THEN 'external_corroboration' ELSE 'unresolved' END AS method,
CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 13 = 0 THEN 100 WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderkey % 5 = 0 THEN 95 WHEN o_orderkey % 3 = 0 THEN 90 WHEN o_orderkey % 2 = 0 AND 80 + o_custkey % 20 >= 90 THEN CAST(80 + o_custkey % 20 AS INTEGER) ELSE 0 END AS confidence FROM orders""")
def bill_evidence(spark, d):
    k = F.col("o_orderkey")
    pair = lambda n, v="b": F.when(k % n == 0, F.array(F.lit("a"), F.lit(v)))
    o = table(spark, d, "orders").select("o_orderkey", pair(11).alias("reviewed_event"), pair(7).alias("structured"), F.lit(None).cast("string").alias("reviewed_description"), pair(13).alias("reviewed_bill"), F.lit(None).cast("string").alias("canonical"), (F.col("o_orderstatus") == "P").alias("known"), pair(5).alias("cross_source"), F.when(k % 4 == 0, F.array(F.lit("a"))).alias("same_source"), pair(3).alias("catalogue"), pair(2).alias("external"), (F.lit(80) + F.col("o_custkey") % 20).cast("int").alias("external_confidence"))
    return cascades.resolve_bills(o, "o_orderkey").select("o_orderkey", "method", F.coalesce("confidence", F.lit(0)).alias("confidence"))


@query("""WITH e AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, lower(c_name) AS h, 'hall ' || c_nationkey AS v, o_orderkey % 3 AS kind, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey),
ids AS (SELECT o_orderkey, sha256(day || chr(31) || h || chr(31) || v) AS id FROM e UNION ALL SELECT o_orderkey, sha256(day || chr(31) || 'old ' || h || chr(31) || v) FROM e WHERE kind = 0 UNION ALL SELECT o_orderkey, sha256(day || chr(31) || h || ' – 19h30' || chr(31) || v) FROM e WHERE kind = 1),
s AS (SELECT sha256(day || chr(31) || CASE kind WHEN 0 THEN 'old ' || h WHEN 1 THEN h || ' – 19h30' ELSE h END || chr(31) || v) AS id, min(o_orderdate) - INTERVAL 10 DAY AS first_seen FROM e WHERE o_orderkey % 2 = 0 GROUP BY 1)
SELECT e.o_orderkey, coalesce((SELECT min(first_seen) FROM ids JOIN s USING (id) WHERE ids.o_orderkey = e.o_orderkey), TIMESTAMP '2024-02-01 00:00:00') AS first_seen FROM e""")
def carried_sightings(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lower("c_name").alias("headliner"), F.concat(F.lit("hall "), "c_nationkey").alias("venue"))
    e = table(spark, d, "orders").join(c, "o_custkey").select("o_orderkey", day("o_orderdate").alias("day"), "headliner", "venue", "o_orderdate", (F.col("o_orderkey") % 3).alias("kind"))
    e = e.withColumns({"aliases": F.when(F.col("kind") == 0, F.array(F.concat(F.lit("old "), "headliner"))), "raw_title": F.lit(None).cast("string"), "event_title": F.lit(None).cast("string"), "time": F.when(F.col("kind") == 1, "19:30")})
    name = F.when(F.col("kind") == 0, F.concat(F.lit("old "), "headliner")).when(F.col("kind") == 1, F.concat("headliner", F.lit(" – 19h30"))).otherwise(F.col("headliner"))
    held = e.where("o_orderkey % 2 = 0").select(cascades.event_identity(F.col("day").cast("string"), name, F.col("venue")).alias("identity"), "o_orderdate").groupBy("identity").agg((F.min("o_orderdate") - F.expr("interval 10 days")).alias("first_seen"))
    none = spark.createDataFrame([], "day date, headliner string, venue string, old_venue string")
    before = cascades.predecessors(e, "o_orderkey", none, spark.createDataFrame([], "headliner string, old_title string"))
    return cascades.carried(e.select("o_orderkey", "day", "headliner", "venue"), before, held, "o_orderkey", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("""WITH s AS (SELECT s_nationkey, min_by(s_name, s_suppkey) AS name, min_by(s_acctbal, s_suppkey) AS bal FROM supplier GROUP BY 1)
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_name END, name) AS image, coalesce(CASE WHEN c_custkey % 2 > 0 THEN c_acctbal END, bal) AS price FROM customer LEFT JOIN s ON s_nationkey = c_nationkey""")
def corroborated_blanks(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("key"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("image"), F.when(F.col("c_custkey") % 2 > 0, F.col("c_acctbal")).alias("price"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("key"), F.col("s_name").alias("image"), F.col("s_acctbal").alias("price"), "s_suppkey")
    return cascades.fill_blanks(c, s, ["key"], ["image", "price"], "s_suppkey").drop("key")


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE) DESC, lower(c_name), o_orderkey) AS place FROM orders JOIN customer ON o_custkey = c_custkey WHERE contains(lower(c_name || ' ' || c_mktsegment), 'building')""")
def calendar_listing(spark, d):
    from pyspark.sql import Window

    asked = calendar.facets("?q=BUILDING&sort=date-desc&venue=nowhere&when=week&month=2024-01", [], [], ["2024-01"])
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("headliner"), F.col("c_mktsegment").alias("venue"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), day("o_orderdate").alias("day"), "o_custkey").join(c, "o_custkey")
    found = calendar.listed(o, asked["q"], ["headliner", "venue"])
    # pages of a printed list need one order over all rows found
    return found.select(F.col("id").alias("o_orderkey"), F.row_number().over(Window.orderBy(*calendar.sort_keys(asked["sort"]))).cast("long").alias("place"))


_RULED = ("c_name || ' (opening act : Guest)'", "c_name || ' - release party of spring'", "c_name || ' with special guests'", "'Scène ouverte + ' || c_name", "'Radio présente : ' || c_name", "'Blue Club invites ' || c_name || ', Bob'", "'Release party of Red - ' || c_name", "c_name || ' - nouvel album Red'", "c_name || ' - The Blue Experience'", "c_name || ' release party II'", "c_name || ' - Red Tour'", "c_name || ' (FR)'", "c_name || ' \"Red Tour\"'", "c_name || ' I 14.11.26'", "c_name || ' - 19h30'", "c_name || ' à Le Club'", "'Jam ' || c_name")
_NAMES = ("support", "release", "unnamed guest", "open stage", "presents", "invites", "release party", "album", "tribute show", "release suffix", "tour", "label", "quoted tour", "day", "time", "venue", "")
_pick = lambda values: "CASE c_custkey % 17 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query(f"""SELECT c_custkey, CASE WHEN c_custkey % 17 = 16 THEN 'Jam ' || c_name ELSE c_name END AS title, {_pick([repr(n) for n in _NAMES])} AS rules FROM customer""")
def title_rules(spark, d):
    lit = lambda v: F.lit(v)
    c = table(spark, d, "customer").select("c_custkey", titles.resolve(F.expr(_pick(_RULED)), lit("LE CLUB"), lit("2026-11-14"), lit("19:30"), lit(None), F.lit(False)).alias("t"))
    return c.select("c_custkey", "t.title", F.array_join("t.rules", "|").alias("rules"))
