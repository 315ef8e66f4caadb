"""Queries of sources, sinks, titles, bills, identities, snapshots, enrichment and reports, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import bills, payloads, titles
from ..functions import keys as K
from ..operators import enrichment, identity, listings, places, reports, snapshots
from ..sources import registry as sources
from ..sources import sinks
from ..sources.staging import folder
from ..sources.tables import table
from .registry import HALF, NOW, day, query


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("""SELECT c_custkey, c_name AS title, CASE c_custkey % 6 WHEN 1 THEN 'Scène ouverte' WHEN 2 THEN 'Club Nord' WHEN 3 THEN 'World Tour' WHEN 4 THEN 'new album Red' END AS event_title,
CASE WHEN c_custkey % 6 = 0 THEN 'Guest ' || c_custkey ELSE '' END AS openers, CASE c_custkey % 6 WHEN 0 THEN 'support' WHEN 1 THEN 'open stage' WHEN 2 THEN 'presents' WHEN 3 THEN 'quoted tour' WHEN 4 THEN 'album' ELSE '' END AS rules FROM customer""")
def title_rule_chain(spark, d):
    n, k = F.col("c_name"), F.col("c_custkey") % 6
    raw = F.when(k == 0, F.concat(n, F.lit(" (première partie : Guest "), "c_custkey", F.lit(")"))).when(k == 1, F.concat(F.lit("Scène ouverte + "), n)).when(k == 2, F.concat(F.lit("Club Nord présente : "), n)).when(k == 3, F.concat(n, F.lit(' "World Tour"'))).when(k == 4, F.concat(n, F.lit(" - new album Red"))).otherwise(n)
    none = F.lit(None)
    c = table(spark, d, "customer").select("c_custkey", titles.resolve(raw, none, none, none, none, F.lit(False)).alias("t"))
    return c.select("c_custkey", "t.title", "t.event_title", F.array_join("t.openers", "|").alias("openers"), F.array_join("t.rules", "|").alias("rules"))


@query("SELECT o_orderkey, c_name || '|' || s_name AS members FROM orders JOIN customer ON o_custkey = c_custkey JOIN supplier ON s_suppkey = o_orderkey % 10 + 1 WHERE o_orderkey % 3 > 0")
def bill_partition(spark, d):
    c, s = table(spark, d, "customer").select("c_custkey", "c_name"), table(spark, d, "supplier").select("s_suppkey", "s_name")
    j = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 10 + 1).alias("s_suppkey")).join(c, "c_custkey").join(s, "s_suppkey")
    bill = F.concat("c_name", F.when(F.col("o_orderkey") % 3 == 0, ", ").when(F.col("o_orderkey") % 3 == 1, " & ").otherwise(" + "), "s_name")
    known = c.select("c_name").union(s.select("s_name")).distinct().select(F.lower("c_name").alias("key"), F.col("c_name").alias("name"))
    return bills.resolve_bills(j.select("o_orderkey", bill.alias("bill")), known, "o_orderkey", "bill").select("o_orderkey", F.array_join("members", "|").alias("members"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'Lead' END AS headliner, CASE WHEN c_custkey % 2 = 0 THEN 'Lead' ELSE lower(c_name) END AS co_headliners FROM customer""")
def promoted_performers(spark, d):
    n, even = F.col("c_name"), F.col("c_custkey") % 2 == 0
    acts = F.array(F.lit("Lead"), F.when(even, n).otherwise(F.lower(n)), F.lit("Opener"))
    c = table(spark, d, "customer").select("c_custkey", bills.promote_performers(F.when(even, n).otherwise(F.lit("Show")), F.lit(None).cast("array<string>"), F.array(F.lit("opener")), acts).alias("b"))
    return c.select("c_custkey", "b.headliner", F.array_join("b.co_headliners", "|").alias("co_headliners"))


@query("SELECT page_id, url FROM pages")
def json_ld_events(spark, d):
    body = F.to_json(F.struct(F.array(F.struct(F.lit("Event").alias("@type"), F.col("url").alias("name")), F.struct(F.lit("Place").alias("@type"), F.lit("x").alias("name"))).alias("@graph")))
    page = F.concat(F.coalesce("html", F.lit("")), F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    p = table(spark, d, "pages").select("page_id", "url", payloads.json_ld(page).alias("e"))
    return p.select("page_id", F.get_json_object(F.col("e")[0], "$.name").alias("url"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderdate AS DATE)::VARCHAR END AS day FROM orders""")
def written_dates(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", day("o_orderdate").alias("day"))
    text = F.concat_ws(" ", F.lit("le"), F.dayofmonth("day"), F.element_at(F.array(*map(F.lit, payloads.MONTHS)), F.month("day")), F.when(F.col("o_orderkey") % 4 > 0, F.year("day")))
    return o.select("o_orderkey", payloads.written_date(text).cast("string").alias("day"))


@query("""SELECT doc_id, CASE WHEN source LIKE '%news%' THEN 'news' WHEN regexp_matches(lower(text), '^(interview\\s*:|an interview with)') THEN 'interview' ELSE 'other' END AS kind FROM (SELECT doc_id, coalesce(source, '') AS source, 'Interview: ' || doc_id AS text FROM documents)""")
def article_types(spark, d):
    labels = F.when(F.contains(F.coalesce("source", F.lit("")), F.lit("news")), F.array(F.lit("News")))
    return table(spark, d, "documents").select("doc_id", payloads.article_type(F.concat(F.lit("Interview: "), "doc_id"), labels).alias("kind"))


@query("SELECT n_nationkey AS key, n_name AS name, 'nations' AS source, 0 AS source_order FROM nation UNION ALL SELECT r_regionkey, r_name, 'regions', 1 FROM region")
def source_scan_union(spark, d):
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    declared = [sources.Source("regions", lambda s: regions.where("false"), 2, fallback=lambda s: regions), sources.Source("nations", lambda s: nations, 1)]
    return sources.scan(spark, declared)[0]


@query("SELECT n_nationkey, n_name || ' <&>' AS n_name, n_regionkey FROM nation")
def published_dataset(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit(" <&>")).alias("n_name"), "n_regionkey")
    base = f"{folder(spark)}/published-{uuid.uuid4().hex}"
    sinks.publish(n, base, "nations", NOW)
    return sinks.read_published(spark, base, "nations", n.schema)


@query("""SELECT o_orderkey, concat_ws(chr(13) || chr(10), 'BEGIN:VEVENT', 'UID:' || o_orderkey, 'DTSTAMP:20240201T000000Z',
CASE WHEN o_orderkey % 2 = 0 THEN 'DTSTART;TZID=Europe/Paris:' || strftime(o_orderdate, '%Y%m%d') || 'T193000' ELSE 'DTSTART;VALUE=DATE:' || strftime(o_orderdate, '%Y%m%d') END,
CASE WHEN o_orderkey % 2 = 1 THEN 'DTEND;VALUE=DATE:' || strftime(CAST(o_orderdate AS DATE) + 1, '%Y%m%d') END,
'SUMMARY:A\\, ' || o_orderpriority, 'LOCATION:Hall', 'DESCRIPTION:With Bob\\nhttps://x.org/' || o_orderkey, 'END:VEVENT') AS ics FROM orders""")
def ics_events(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", day("o_orderdate").alias("day"), "o_orderpriority")
    text = sinks.ics_event(F.col("o_orderkey").cast("string"), F.lit("20240201T000000Z"), F.col("day"), F.when(F.col("o_orderkey") % 2 == 0, "19:30"), F.concat(F.lit("A, "), "o_orderpriority"), F.lit("Hall"), F.lit("Paris"), F.array(F.lit("Bob")), F.lit(None).cast("string"), F.concat(F.lit("https://x.org/"), "o_orderkey"))
    return o.select("o_orderkey", text.alias("ics"))


def _listings(spark, d, late: bool):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    e = e.where(F.col("ts") >= _ntz(HALF) if late else F.col("ts") < _ntz(HALF))
    return e.select(F.col("event_id").alias("row"), F.date_add(day("ts"), 0 if late else 15).alias("day"), F.when(F.col("event_id") % 3 > 0, F.date_format("ts", "HH:00")).alias("time"), F.concat(F.lit("Artist "), "user_id").alias("headliner"), F.lit(None).cast("array<string>").alias("co_headliners"), F.concat(F.lit("Hall "), F.col("user_id") % 50).alias("venue"), F.lit("Paris").alias("city"), F.concat(F.lit("https://t.org/e/"), "user_id", F.lit("-"), F.hour("ts")).alias("ticket"))


@query()
def continuity_match(spark, d):
    return identity.match_continuity(_listings(spark, d, True), _listings(spark, d, False).withColumnRenamed("row", "public_id"), "row", "public_id")


@query()
def assigned_identities(spark, d):
    new, old = _listings(spark, d, True), _listings(spark, d, False)
    base = K.event_identity(F.col("day").cast("string"), F.lower("headliner"), F.lower("venue"))
    held = old.select(base.alias("base"), F.coalesce("time", F.lit("")).alias("performance"), "row").withColumn("key", F.sha2(F.concat_ws("|", "base", "performance", "row"), 256)).withColumn("public_id", K.public_id(F.col("key")))
    matched = identity.match_continuity(new, old.withColumnRenamed("row", "_old"), "row", "_old").join(held.select(F.col("row").alias("_old"), "public_id"), "_old").select("row", "public_id")
    return identity.require_unique(identity.assign(new.select("row", base.alias("base"), F.col("time").alias("performance")), held, matched, "row"), "key", "public_id")


@query()
def listing_merge(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("row"), day("ts").alias("day"), (F.col("user_id") % 20).cast("string").alias("venue_key"), F.concat(F.lit("Artist "), F.col("user_id"), F.when(F.col("event_id") % 4 == 0, " + Band").otherwise("")).alias("title"), F.when(F.col("event_id") % 3 > 0, F.date_format("ts", "HH:00")).alias("time"), F.col("event_type").alias("source"), (F.col("event_type") == "click").alias("official"), F.lit(None).cast("string").alias("ticket"))
    return listings.merge(e)


@query(f"""WITH e AS (SELECT event_type AS source, CAST(ts AS DATE) AS day, ts FROM events), p AS (SELECT source, count(*) AS prior_n FROM e WHERE ts < TIMESTAMP '{HALF}' AND day >= DATE '2024-01-10' GROUP BY 1),
f AS (SELECT source, count(*) FILTER (WHERE day >= DATE '2024-01-28') AS fresh_n FROM e WHERE ts >= TIMESTAMP '{HALF}' GROUP BY 1)
SELECT source, coalesce(prior_n, 0) AS prior_n, coalesce(fresh_n, 0) AS fresh_n, CASE WHEN prior_n > 0 AND fresh_n < 0.5 * prior_n AND prior_n - fresh_n >= 20 THEN 'partial' ELSE 'ok' END AS status
FROM (SELECT DISTINCT source FROM e) LEFT JOIN p USING (source) LEFT JOIN f USING (source)""")
def source_judgement(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("source"), day("ts").alias("day"), "ts")
    loads = e.select("source").distinct().select("source", F.lit("ok").alias("status"), F.lit("fallback").alias("path"), F.lit(False).alias("incomplete"))
    fresh = e.where((F.col("ts") >= _ntz(HALF)) & (F.col("day") >= F.lit("2024-01-28").cast("date")))
    return snapshots.judge(loads, fresh, e.where(F.col("ts") < _ntz(HALF)), F.lit("2024-01-10").cast("date")).select("source", "prior_n", "fresh_n", "status")


@query(f"""WITH e AS (SELECT event_id, event_type AS source, user_id, CAST(ts AS DATE) AS day, ts FROM events), s AS (SELECT source, max(ts) AS last_success FROM e WHERE ts < TIMESTAMP '{HALF}' GROUP BY 1),
l AS (SELECT DISTINCT user_id FROM e WHERE ts >= TIMESTAMP '{HALF}')
SELECT event_id, CASE WHEN NOT (epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(date_trunc('second', last_success)) BETWEEN 0 AND 604800) THEN 'expired' WHEN day < DATE '2024-01-12' THEN 'past' WHEN l.user_id IS NOT NULL THEN 'suppressed' ELSE 'restored' END AS fate
FROM e JOIN s USING (source) LEFT JOIN l USING (user_id) WHERE ts < TIMESTAMP '{HALF}'""")
def snapshot_replay(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("source"), "user_id", day("ts").alias("day"), "ts")
    old, new = e.where(F.col("ts") < _ntz(HALF)), e.where(F.col("ts") >= _ntz(HALF))
    last = old.groupBy("source").agg(F.max("ts").cast("timestamp").alias("last_success"))
    judged = last.select("source", F.lit("failed").alias("status"))
    return snapshots.replay(new, old.join(last, "source"), judged, ["user_id"], F.lit("2024-01-20 00:00:00").cast("timestamp"), F.lit("2024-01-12").cast("date")).select("event_id", "fate")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'Metal|Rock' WHEN p_size % 4 = 1 THEN 'Pop|Rock' WHEN p_size % 4 = 2 THEN 'Jazz / Blues' ELSE 'Electronic' END AS genres,
CASE WHEN p_size % 4 = 0 THEN 'compound' WHEN p_size % 4 = 1 THEN 'exact' WHEN p_size % 4 = 2 THEN 'jazz' ELSE 'token' END AS method FROM part""")
def raw_genre_map(spark, d):
    label = F.element_at(F.array(*map(F.lit, ("Rock / Metal", "Pop,  rock", "Jazz actuel", "Live electronica set"))), (F.col("p_size") % 4 + 1).cast("int"))
    exact = spark.createDataFrame([("pop", "Pop"), ("rock", "Rock")], "term string, genre string")
    pairs = spark.createDataFrame([("rock / metal", ["Metal", "Rock"])], "term string, genres array<string>")
    out = enrichment.raw_genres(table(spark, d, "part").select("p_partkey", label.alias("raw")), "p_partkey", "raw", exact, pairs, {"Electronic": ["electronica"], "World": ["cumbia"]})
    return out.select("p_partkey", F.array_join("genres", "|").alias("genres"), "method")


@query("""WITH s AS (SELECT l_partkey, l_returnflag, CAST(sum(CASE WHEN l_linenumber = 1 THEN 4 ELSE 1 END) AS BIGINT) AS votes FROM lineitem GROUP BY 1, 2), t AS (SELECT *, max(votes) OVER (PARTITION BY l_partkey) AS top FROM s)
SELECT l_partkey, min(l_returnflag) AS l_returnflag, max(votes) AS votes FROM t WHERE votes = top GROUP BY 1 HAVING count(*) = 1 AND max(votes) >= 8""")
def seed_votes(spark, d):
    return enrichment.votes(table(spark, d, "lineitem"), "l_partkey", "l_returnflag", F.when(F.col("l_linenumber") == 1, 4).otherwise(1), 8)


@query("""WITH s AS (SELECT l_suppkey, l_returnflag AS genre, sum(greatest(coalesce(CAST(l_quantity AS BIGINT), 0), 1)) AS v FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, string_agg(genre, '|' ORDER BY v DESC, lower(genre)) AS genres FROM s GROUP BY 1""")
def ranked_tags(spark, d):
    l = table(spark, d, "lineitem").select("l_suppkey", F.col("l_returnflag").alias("tag"), F.col("l_quantity").cast("long").alias("n"))
    canonical = l.select("tag", F.col("tag").alias("genre")).distinct()
    return enrichment.ranked_tags(l, "l_suppkey", "tag", "n", canonical).select("l_suppkey", F.array_join("genres", "|").alias("genres"))


@query("""SELECT c_custkey AS key, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, o.v, 'none') AS genre, CASE WHEN c_custkey % 3 = 0 THEN 'editorial' WHEN o.v IS NOT NULL THEN 'direct' ELSE 'default' END AS layer
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS v FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def provider_ladder(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("genre"))
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.min("o_orderpriority").alias("genre"))
    o = o.join(c.select("key"), "key", "left_semi")
    return enrichment.first_layer([("editorial", c.where("key % 3 = 0")), ("direct", o), ("default", c.select("key", F.lit("none").alias("genre")))], "key", "genre")


@query("""WITH g AS (SELECT DISTINCT user_id AS artist, event_type AS genre FROM events WHERE user_id % 2 = 0), e AS (SELECT DISTINCT user_id AS artist, event_id % 40 AS other FROM events),
c AS (SELECT e.artist, genre, count(*) AS n FROM e JOIN g ON e.other = g.artist WHERE e.artist NOT IN (SELECT artist FROM g) GROUP BY 1, 2)
SELECT artist, string_agg(genre, '|' ORDER BY n DESC, genre) AS genres FROM c GROUP BY 1""")
def inherited_genres(spark, d):
    e = table(spark, d, "events")
    g = e.where("user_id % 2 = 0").select(F.col("user_id").alias("artist"), F.col("event_type").alias("genre")).distinct()
    edges = e.select(F.col("user_id").alias("artist"), (F.col("event_id") % 40).alias("other"), F.lit("member of band").alias("kind"))
    return enrichment.inherited(edges, g).select("artist", F.array_join("genres", "|").alias("genres"))


@query("""WITH t AS (SELECT p_brand AS "group", p_partkey AS id, p_name AS name, lower(p_name) AS term FROM part), s AS (SELECT *, CASE WHEN term = 'red' THEN 0 WHEN starts_with(term, 'red') THEN 20 WHEN contains(' ' || term || ' ', ' red ') THEN 40 WHEN contains(term, 'red') THEN 50 END AS score FROM t),
r AS (SELECT "group", id, name, score, row_number() OVER (PARTITION BY "group" ORDER BY score, name, id) AS rank FROM s WHERE score IS NOT NULL) SELECT * FROM r WHERE rank <= 8""")
def search_top_k(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("group"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lower("p_name").alias("term"), F.lit(False).alias("alias"))
    return enrichment.search(p, "red")


@query("""WITH a AS (SELECT conv_id AS event, turn - min(turn) OVER (PARTITION BY conv_id) AS p, role FROM conversations)
SELECT event, role AS slug, role AS name, CAST(min(p) AS INTEGER) AS role FROM a GROUP BY 1, 2""")
def bill_links(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    names = c.groupBy(F.col("conv_id").alias("event")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("names"))
    known = c.select(F.lower("role").alias("key"), F.col("role").alias("slug")).distinct()
    return enrichment.bill_links(names, known)


@query("""SELECT substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) AS public_id, min(CAST(ts AS DATE))::VARCHAR AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-21' AND CAST(ts AS DATE) >= DATE '2024-01-17' GROUP BY 1""")
def period_report(spark, d):
    today = F.lit("2024-01-24").cast("date")
    _, first, end = reports.last_period(today, "weekly")
    e = table(spark, d, "events").select(F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 16).alias("public_id"), F.col("ts").alias("first_seen"), day("ts").alias("day"), F.col("event_type").alias("artist"), F.lit("").alias("venue"))
    return reports.discovered(e, first, end, F.lit("2024-01-17").cast("date")).select("public_id", F.col("day").cast("string").alias("day"))


@query("SELECT coalesce(props, '') AS value, count(*) AS n FROM events GROUP BY 1")
def frequency_counters(spark, d):
    return reports.counters(table(spark, d, "events"), "props")


@query("""SELECT l_suppkey, count(DISTINCT l_linenumber) AS genres, count(DISTINCT l_returnflag) AS roots, CASE WHEN count(DISTINCT l_linenumber) >= 7 THEN 'genres' ELSE 'roots' END AS reason FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) >= 7 OR count(DISTINCT l_returnflag) >= 3""")
def genre_outliers(spark, d):
    return reports.genre_outliers(table(spark, d, "lineitem"), "l_suppkey", "l_linenumber", "l_returnflag", F.lit(False), most_genres=7, most_roots=3)


@query("""SELECT CAST(user_id AS VARCHAR) AS venue_key, count(*) AS events, count(DISTINCT event_type) AS cities, coalesce(CASE WHEN user_id % 2 = 0 THEN 'Own' END, (SELECT max_by(event_type, struct_pack(n := n, c := event_type)) FROM (SELECT event_type, count(*) AS n FROM events x WHERE x.user_id = e.user_id GROUP BY 1))) AS city, user_id % 2 = 1 AS provisional, count(DISTINCT event_type) > 1 AS conflict FROM events e GROUP BY user_id""")
def venue_index(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("venue_key"), F.col("event_type").alias("city"))
    v = e.where(F.col("venue_key").cast("long") % 2 == 0).select("venue_key").distinct().withColumn("city", F.lit("Own"))
    return reports.venue_index(e, v)


@query(f"""WITH b AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-03'), c AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29')
SELECT CASE WHEN c.user_id IS NULL THEN 'baseline only' WHEN b.user_id IS NULL THEN 'candidate only' ELSE 'same' END AS kind, count(*) AS n FROM b FULL JOIN c ON b.user_id = c.user_id GROUP BY 1""")
def release_difference(spark, d):
    e = table(spark, d, "events").select("user_id", "ts")
    b, c = e.where(F.col("ts") < _ntz("2024-01-03")).select("user_id").distinct(), e.where(F.col("ts") >= _ntz("2024-01-29")).select("user_id").distinct()
    return reports.release_difference(b, c, "user_id")


@query("""SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus <> '') AS with_genre, count(*) FILTER (WHERE o_orderstatus = 'P') AS faulty, count(*) - count(DISTINCT o_orderkey) AS repeated_ids,
CAST(count(*) - count(DISTINCT (o_orderdate, o_custkey, o_orderpriority)) AS BIGINT) AS twins, array_to_string(list_filter([CASE WHEN count(*) < 100 THEN 'too few' END, CASE WHEN count(*) > count(DISTINCT (o_orderdate, o_custkey, o_orderpriority)) THEN 'twins' END, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'faults' END], lambda x: x IS NOT NULL), '|') AS refusals FROM orders""")
def gate_refusals(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("public_id"), day("o_orderdate").alias("day"), F.col("o_custkey").cast("string").alias("headliner"), F.col("o_orderpriority").alias("venue"), F.lit("20:00").alias("time"), F.col("o_orderstatus").alias("genre"))
    return reports.gate(o, 0, ["F", "O"]).drop("collisions", "collision").withColumn("refusals", F.array_join("refusals", "|"))


def _opener_changes(events):
    e = events.select(F.col("user_id").alias("key"), "ts", F.concat(F.hour("ts"), "event_type").alias("act"))
    side = lambda c: e.where(c).groupBy("key").agg(F.collect_set("act").alias("openers")).withColumn("genre", F.lit("")).withColumn("status", F.lit("tickets"))
    return identity.changes(side(F.col("ts") < _ntz(HALF)), side(F.col("ts") >= _ntz(HALF)), "key").select("key", F.array_join("change", "|").alias("change"))


@query(f"""WITH h AS (SELECT user_id AS key, ts < TIMESTAMP '{HALF}' AS old, CAST(hour(ts) AS VARCHAR) || event_type AS props FROM events), b AS (SELECT key, list(DISTINCT lower(props)) AS o FROM h WHERE old GROUP BY 1), a AS (SELECT key, list(DISTINCT lower(props)) AS o FROM h WHERE NOT old GROUP BY 1)
SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'new' WHEN a.key IS NULL THEN 'gone' ELSE 'openers' END AS change FROM b FULL JOIN a ON a.key = b.key
WHERE b.key IS NULL OR a.key IS NULL OR len(list_filter(a.o, lambda x: NOT list_contains(b.o, x))) > 0""")
def opener_changes(spark, d):
    return _opener_changes(table(spark, d, "events"))


@query("""WITH a AS (SELECT lower(n_name) AS alias, n_name AS place, n_nationkey AS o FROM nation), t AS (SELECT c_custkey, lower('live at ' || n_name || CASE WHEN c_custkey % 2 = 0 THEN ' hall' ELSE 'hall' END || CASE WHEN c_custkey % 3 = 0 THEN ' and ' || (SELECT n_name FROM nation WHERE n_nationkey = 0) ELSE '' END) AS t FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, min_by(place, o) AS place FROM t JOIN a ON contains(' ' || t || ' ', ' ' || alias || ' ') GROUP BY 1""")
def named_places(spark, d):
    n = table(spark, d, "nation")
    first = n.where("n_nationkey = 0").select(F.col("n_name").alias("zero"))  # one row
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(n.select("n_nationkey", "n_name"), "n_nationkey").join(first)
    text = F.lower(F.concat(F.lit("live at "), "n_name", F.when(F.col("c_custkey") % 2 == 0, " hall").otherwise("hall"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" and "), "zero")).otherwise("")))
    aliases = n.select(F.lower("n_name").alias("alias"), F.col("n_name").alias("place"), F.col("n_nationkey").alias("order"))
    return places.named_places(c.select("c_custkey", text.alias("t")), "c_custkey", "t", aliases)


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'main hall' WHEN 1 THEN lower(s_name) ELSE 'room ' || s_suppkey || '|paris' END AS key, CASE s_suppkey % 3 WHEN 0 THEN 'alias' WHEN 1 THEN 'suffix' ELSE 'name' END AS how FROM supplier""")
def resolved_venues(spark, d):
    s, k = table(spark, d, "supplier").select("s_suppkey", F.lower("s_name").alias("key")), F.col("s_suppkey") % 3
    name = F.when(k == 0, F.concat(F.lit("old hall "), "s_suppkey")).when(k == 1, F.concat(F.lit("the club at "), "key")).otherwise(F.concat(F.lit("room "), "s_suppkey"))
    rows = s.select("s_suppkey", name.alias("venue"), F.lit("paris").alias("city"))
    aliases = rows.where("s_suppkey % 3 = 0").select(F.col("venue").alias("alias"), F.lit("main hall").alias("key"))
    return places.resolve_venues(rows, "s_suppkey", "venue", "city", aliases, s.select("key").distinct())


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, CASE WHEN event_id % 4 > 0 THEN hour(ts) // 6 END AS t FROM events)
SELECT a.event_id, EXISTS (SELECT 1 FROM e b WHERE b.event_type <> 'view' AND b.user_id = a.user_id AND b.day = a.day AND (a.t IS NULL OR b.t IS NULL OR a.t = b.t)) AS covered FROM e a WHERE a.event_type = 'view'""")
def coverage_overlap(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", day("ts").alias("day"), "event_type", F.when(F.col("event_id") % 4 > 0, F.floor(F.hour("ts") / 6).cast("string")).alias("t"))
    return places.covered_by(e.where("event_type = 'view'"), e.where("event_type <> 'view'"), "event_id", ["user_id", "day"], "t").select("event_id", "covered")


@query("""SELECT event_id FROM events WHERE props IS NOT NULL AND (event_type, props) IN (SELECT (event_type, props) FROM events GROUP BY event_type, props HAVING count(DISTINCT user_id) >= 20)""")
def series_evidence(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "props", "user_id")
    return places.series(e, "event_type", "props", "user_id", 20).select("event_id")
