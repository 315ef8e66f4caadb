"""Queries of states, provenance, survivors, lookups and editions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bills, payloads, titles
from ..functions import keys as K
from ..operators import enrichment, listings, reports, snapshots
from ..sources import registry as sources
from ..sources.tables import table
from .registry import NOW, day, query


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'cancelled' WHEN o_orderkey % 3 = 0 THEN 'sold_out' WHEN o_orderkey % 2 = 0 THEN 'tickets' END AS status FROM orders""")
def ticket_states(spark, d):
    k = F.col("o_orderkey")
    status = payloads.ticket_status(F.when(F.col("o_orderstatus") == "F", "cancelled"), k % 3 == 0, F.when(k % 2 == 0, "https://t.org"))
    return table(spark, d, "orders").select("o_orderkey", status.alias("status"))


@query("""WITH l AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS v, o_orderpriority AS a, o_orderkey % 2 = 0 AND o_orderkey % 5 = 0 AS gone FROM orders)
SELECT o_orderkey FROM l WHERE NOT EXISTS (SELECT 1 FROM l g WHERE g.gone AND g.day = l.day AND g.v = l.v AND g.a = l.a)""")
def postponed_dropped(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select("o_orderkey", day("o_orderdate").alias("day"), F.col("o_orderstatus").alias("venue_key"), F.col("o_orderpriority").alias("artist_key"), (k % 2 == 0).alias("official"), F.when(k % 5 == 0, "postponed").alias("status"))
    return listings.drop_postponed(o, "o_orderkey").select("o_orderkey")


@query("""SELECT l_orderkey AS row FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag = 'N') AND bool_or(l_returnflag <> 'N')""")
def mixed_sources(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("row"), F.col("l_returnflag").alias("source"))
    return snapshots.unmixed_sources(rows, spark.createDataFrame([("A", "ok"), ("N", "failed"), ("R", "empty")], "source string, status string"))


@query("""SELECT o_orderkey AS public_id FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0""")
def identities_lost(spark, d):
    before = table(spark, d, "orders").select(F.col("o_orderkey").alias("public_id"), F.col("o_orderdate").alias("first_seen"))
    later = F.when(F.col("public_id") % 7 == 0, F.col("first_seen") + F.expr("interval 1 day")).otherwise(F.col("first_seen"))
    return snapshots.lost_identities(before, before.where("public_id % 10 > 0").withColumn("first_seen", later)).select("public_id")


@query("""WITH l AS (SELECT o_orderkey, ['primary', 'fallback', 'other', NULL][1 + o_orderkey % 4] AS path, ['x', ' ', NULL][1 + o_custkey % 3] AS fallback, o_orderkey % 5 = 0 AS part FROM orders)
SELECT o_orderkey, CASE WHEN path IS NULL OR path = 'other' THEN 'unknown path' WHEN path = 'fallback' AND trim(coalesce(fallback, '')) = '' THEN 'fallback without a source' WHEN path = 'primary' AND fallback IS NOT NULL THEN 'primary with a fallback source' WHEN part AND path <> 'fallback' THEN 'incomplete primary' END AS fault FROM l""")
def load_faults(spark, d):
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey") % 3
    path = F.when(k == 0, "primary").when(k == 1, "fallback").when(k == 2, "other")
    return table(spark, d, "orders").select("o_orderkey", sources.provenance_fault(path, F.when(c == 0, "x").when(c == 1, " "), F.col("o_orderkey") % 5 == 0).alias("fault"))


@query("""WITH a AS (SELECT o_custkey, 'u' || o_orderpriority || o_custkey AS url, min(o_orderstatus) AS type, max(CAST(o_orderdate AS DATE)) AS day FROM orders GROUP BY 1, 2)
SELECT o_orderkey AS event, url, type, CAST(day AS VARCHAR) AS day, c_name AS artists FROM orders JOIN a USING (o_custkey) JOIN customer ON o_custkey = c_custkey""")
def event_coverage(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    o = table(spark, d, "orders")
    events = o.join(c, "o_custkey").select(F.col("o_orderkey").alias("event"), F.array("c_name").alias("names"))
    links = enrichment.bill_links(events, c.select(K.fold_latin(F.col("c_name")).alias("key"), F.col("o_custkey").alias("slug")))
    articles = o.select(F.col("o_custkey").alias("slug"), F.concat(F.lit("u"), "o_orderpriority", "o_custkey").alias("url"), F.col("o_orderstatus").alias("type"), day("o_orderdate").alias("day"))
    return enrichment.coverage(events, links, articles).withColumns({"day": F.col("day").cast("string"), "artists": F.array_join("artists", "|")})


@query("""SELECT o_orderkey AS event FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey = 7""")
def one_artist_page(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    events = table(spark, d, "orders").join(c, "o_custkey").select(F.col("o_orderkey").alias("event"), F.array("c_name").alias("names"))
    links = events.where("event % 2 = 0").select("event", F.regexp_replace(F.get("names", F.lit(0)), "[^0-9]|^0+", "").alias("name")).select("event", F.regexp_replace("name", "^0+", "").alias("slug"))
    return enrichment.artist_page(events, links, "7", "customer#000000007").select("event")


@query("""WITH u AS (SELECT n_name AS genre, n_regionkey, c_custkey FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_custkey % 5 = 0)
SELECT genre, count(c_custkey) AS own, count(c_custkey) AS total, count(c_custkey) > 0 AS visible FROM u GROUP BY 1 UNION ALL SELECT r_name, 0, count(c_custkey), count(c_custkey) > 0 FROM region JOIN u ON n_regionkey = r_regionkey GROUP BY 1""")
def genre_tree_counts(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    below = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("child"), F.col("r_name").alias("ancestor"))
    itself = n.select(F.col("n_name").alias("child")).union(r.select("r_name")).select("child", F.col("child").alias("ancestor"))
    used = table(spark, d, "customer").where("c_custkey % 5 = 0").join(n.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey").select(F.col("n_name").alias("genre"), F.col("c_custkey").alias("event"))
    return reports.visible_genres(below.union(itself), used)


@query("""SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS end_exclusive, CASE WHEN o_orderkey % 2 = 0 THEN 'weekly' ELSE 'monthly' END AS frequency, o_orderkey AS identifier FROM orders ORDER BY 1 DESC, o_orderkey % 2, o_orderkey LIMIT 1""")
def newest_edition(spark, d):
    o = table(spark, d, "orders").select(day("o_orderdate").alias("end_exclusive"), F.when(F.col("o_orderkey") % 2 == 0, "weekly").otherwise("monthly").alias("frequency"), F.col("o_orderkey").alias("identifier"))
    return reports.latest_edition(o).withColumn("end_exclusive", F.col("end_exclusive").cast("string"))


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1""")
def manifest_merge(spark, d):
    return reports.newest_by(table(spark, d, "events"), "user_id", [F.desc("ts"), F.asc("event_id")]).select("user_id", "event_id")


@query("""SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem WHERE l_quantity * 2 >= 90 GROUP BY 1 HAVING count(*) = 1""")
def lookup_matches(spark, d):
    found = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).alias("score"))
    return enrichment.single_match(found, "l_orderkey").select("l_orderkey", "l_linenumber")


@query("""SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""")
def lookups_pending(spark, d):
    held = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return enrichment.pending(table(spark, d, "orders"), held, "o_custkey")


@query("""WITH f AS (SELECT *, o_orderkey % 3 = 0 AS official, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS image, CASE WHEN o_orderkey % 5 > 0 THEN 't' || o_orderkey END AS ticket FROM orders),
r AS (SELECT *, CAST(image IS NOT NULL AS INTEGER) + CAST(ticket IS NOT NULL AS INTEGER) AS rich FROM f)
SELECT o_custkey, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS sources, min(o_orderdate) AS first_seen, bool_or(o_totalprice > 100000) AS sold_out, arg_max(image, (official, rich, -o_orderkey)) FILTER (image IS NOT NULL) AS image, arg_max(ticket, (official, rich, -o_orderkey)) FILTER (ticket IS NOT NULL) AS ticket FROM r GROUP BY 1""")
def group_survivors(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("source"), F.col("o_orderdate").alias("first_seen"), (F.col("o_totalprice") > 100000).alias("sold_out"), (k % 3 == 0).alias("official"), F.when(k % 2 == 0, F.col("o_orderpriority")).alias("image"), F.when(k % 5 > 0, F.concat(F.lit("t"), k)).alias("ticket"))
    return listings.fold_groups(o, "o_custkey", "o_orderkey", ["image", "ticket"]).withColumn("sources", F.array_join("sources", "|"))


@query(f"""SELECT event_id, strftime(CAST(ts + INTERVAL 1 HOUR AS DATE), '%Y-%m-%d') AS day, ts <= TIMESTAMP '{NOW}' AND ts >= TIMESTAMP '{NOW}' - INTERVAL 72 HOUR AS new,
CASE WHEN event_id % 26 < 24 AND event_id % 3 < 2 THEN lpad(CAST(event_id % 26 AS VARCHAR), 2, '0') || CASE event_id % 3 WHEN 0 THEN ':00' ELSE ':05' END END AS clock FROM events""")
def listing_clocks(spark, d):
    """All events lie in winter, when the local day begins an hour early."""
    k = F.col("event_id")
    told = F.concat((k % 26).cast("string"), F.when(k % 3 == 0, "h").when(k % 3 == 1, "H05").otherwise(":60"))
    return table(spark, d, "events").select("event_id", K.local_date(F.col("ts")).cast("string").alias("day"), K.is_new(F.col("ts"), F.lit(NOW).cast("timestamp_ntz")).alias("new"), K.normal_time(told).alias("clock"))


@query("""SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS title, c_name || ' (a + b)|Guest' AS parts, CASE WHEN c_custkey % 2 = 0 THEN 'Anna Lou|Bob Ray' ELSE '' END AS credits FROM customer""")
def spelled_names(spark, d):
    told = F.when(F.col("c_custkey") % 2 == 0, "guitar: Anna Lou\nbass: Bob Ray\nguitar: Anna Lou").otherwise("guitar: Anna Lou\nsomething else")
    return table(spark, d, "customer").select("c_custkey", K.title_case(F.upper("c_mktsegment")).alias("title"), F.array_join(bills.plus_parts(F.concat("c_name", F.lit(" (a + b) + Guest"))), "|").alias("parts"), F.array_join(titles.labelled_credits(told), "|").alias("credits"))
