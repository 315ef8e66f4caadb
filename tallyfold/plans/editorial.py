"""Queries of articles, programmes, archives and listing outcomes, with their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import media
from ..operators import calendar, editorial, programmes
from ..sources.tables import table
from .registry import day, query

_HEADLINES = ("c_name || ' @ Le Club - May 1st, 2024'", "'Album review: ' || c_name || ' – Red'", "'Interview with ' || c_name || ' - on tour'", "c_name || ' Trio announces a tour'", "c_name || ' to celebrate ten years'", "'Nothing about ' || c_name")
_TYPES = ("concert_review", "album_review", "interview", "news", "news", "other")
_six = lambda values: "CASE c_custkey % 6 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"
_LABELS = "[c_name, 'Concert', c_mktsegment, c_name]"


@query(f"""WITH a AS (SELECT c_custkey AS id, c_name, c_custkey % 6 AS k, unnest(list_distinct({_LABELS})) AS label FROM customer)
SELECT id, label, CASE k WHEN 3 THEN c_name || ' Trio' WHEN 5 THEN NULL ELSE c_name END AS subject FROM a WHERE label <> 'Concert' AND (label = c_name OR k = 5)""")
def article_subjects(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.expr(_six(_HEADLINES)).alias("title"), F.expr(_six([repr(t) for t in _TYPES])).alias("type"), F.array("c_name", F.lit("Concert"), "c_mktsegment", "c_name").alias("labels"))
    return editorial.primary_labels(a, ["concert"])


@query("""SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 3 THEN NULL ELSE s_name END AS artist FROM customer JOIN supplier ON s_suppkey = 1 + c_custkey % 10
WHERE c_custkey % 4 < 3""")
def review_artists(spark, d):
    s = table(spark, d, "supplier")
    c = table(spark, d, "customer").withColumn("s_suppkey", F.lit(1) + F.col("c_custkey") % 10).join(s.select("s_suppkey", "s_name"), "s_suppkey")
    k = F.col("c_custkey") % 4
    spelled = F.when(k == 0, F.upper("s_name")).when(k == 1, F.concat(F.lit("The "), "s_name", F.lit(" Band (DJ Set)"))).when(k == 2, F.replace("s_name", F.lit("#"), F.lit(" #"))).otherwise(F.lit("Somebody else"))
    return editorial.known_artists(c.select(F.col("c_custkey").alias("id"), spelled.alias("name")), s.select(F.col("s_name").alias("artist")))


@query("""WITH l AS (SELECT l_orderkey AS id, min(l_suppkey) AS slug FROM lineitem GROUP BY 1 HAVING min(l_suppkey) = max(l_suppkey)),
g AS (SELECT l_orderkey AS id, min(CASE WHEN l_suppkey % 3 = 0 THEN 'Rock' ELSE l_linestatus END) AS low, max(CASE WHEN l_suppkey % 3 = 0 THEN 'Rock' ELSE l_linestatus END) AS high FROM lineitem GROUP BY 1),
a AS (SELECT s_suppkey, count(*) AS n, min(low) AS genre, max(high) AS high FROM l JOIN g USING (id) JOIN supplier ON s_suppkey = slug WHERE s_suppkey % 4 > 0 AND id % 5 > 0 GROUP BY 1)
SELECT lower(s_name) AS key, CASE WHEN s_suppkey % 4 = 0 THEN 'Jazz' ELSE genre END AS genre, CASE WHEN s_suppkey % 4 = 0 THEN 'editorial_reviewed_identity' ELSE 'editorial_article_consensus' END AS method
FROM supplier LEFT JOIN a USING (s_suppkey) WHERE s_suppkey % 8 = 0 OR s_suppkey % 4 > 0 AND n > 1 AND genre = high""")
def editorial_consensus(spark, d):
    k = F.col("s_suppkey")
    artists = table(spark, d, "supplier").select(k.alias("slug"), F.col("s_name").alias("name"), F.lower("s_name").alias("key"), F.when(k % 8 == 0, F.array(F.lit("Jazz"), F.lit("Jazz"))).when(k % 4 == 0, F.array(F.lit("Jazz"), F.lit("Pop"))).alias("reviewed"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("slug"), "l_linestatus")
    names = lines.groupBy("id").agg(F.min("slug").alias("slug")).join(artists.select("slug", "name"), "slug")
    titles = names.select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("Live: "), "name", F.lit("!"))).otherwise("Live").alias("title"))
    labels = lines.select("id", F.when(F.col("slug") % 3 == 0, "Rock").otherwise(F.col("l_linestatus")).alias("genre"))
    return editorial.editorial_genres(artists, titles, lines.select("id", "slug"), labels)


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, arg_max(c_name, (o_totalprice, -o_orderkey)) FILTER (o_orderstatus = 'O') AS headliner, count(*) - 1 AS openers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'O') > 0""")
def festival_line_ups(spark, d):
    acts = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("artist")), "o_custkey").select(day("o_orderdate").alias("day"), F.col("o_orderkey").alias("position"), "artist", F.col("o_totalprice").alias("minutes"), "o_orderstatus")
    return programmes.festival_days(acts, F.col("o_orderstatus") == "O").select(F.col("day").cast("string").alias("day"), "headliner", F.size("openers").cast("long").alias("openers"))


@query("""WITH w AS (SELECT DATE '1995-01-01' + CAST(7 * i AS INTEGER) AS start, least(DATE '1995-01-01' + CAST(7 * i + 6 AS INTEGER), DATE '1996-01-20') AS stop FROM range(55) t(i)),
f AS (SELECT start, stop, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN start AND stop) > 44 AND stop > start AS more, CAST((stop - start) // 2 AS INTEGER) AS half FROM w)
SELECT CAST(start AS VARCHAR) AS start, CAST(stop AS VARCHAR) AS stop FROM (SELECT start, stop FROM f WHERE NOT more UNION ALL SELECT start, start + half FROM f WHERE more UNION ALL SELECT start + half + 1, stop FROM f WHERE more)""")
def date_partitions(spark, d):
    w = programmes.date_windows(spark, dt.date(1995, 1, 1))
    days = table(spark, d, "orders").groupBy(day("o_orderdate").alias("day")).count()
    each = w.select("start", "stop", F.explode(F.sequence("start", "stop")).alias("day")).join(days, "day", "left").groupBy("start", "stop").agg((F.coalesce(F.sum("count"), F.lit(0)) > 44).alias("more"))
    out = each.where("not more or start = stop").select("start", "stop").unionByName(programmes.bisected(each))
    return out.select(F.col("start").cast("string").alias("start"), F.col("stop").cast("string").alias("stop"))


@query("""WITH e AS (SELECT o_orderkey, o_custkey, c_name, o_orderkey % 3 AS src, o_orderkey % 5 AS k FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 > 0),
a AS (SELECT o_orderkey, CASE WHEN k = 1 THEN upper(c_name) ELSE c_name END AS name, src FROM e UNION ALL SELECT o_orderkey, 'b' || src, src FROM e),
g AS (SELECT lower(name) AS key, min(name) AS name, count(DISTINCT o_orderkey) AS events, count(DISTINCT src) AS sources, bool_or(name LIKE '%#%') AS act FROM a GROUP BY 1)
SELECT g.key, CASE WHEN s.key IS NOT NULL THEN 'already_known' WHEN length(g.key) < 4 AND sources < 2 THEN 'short_name' ELSE 'new_verified' END AS status, coalesce(s.name, g.name) AS name, sources, events
FROM g LEFT JOIN (SELECT lower(c_name) AS key, 'Known ' || c_custkey AS name FROM customer WHERE c_custkey % 4 = 0) s ON s.key = g.key""")
def performer_evidence(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    src = (F.col("o_orderkey") % 3).cast("string")
    name = F.when(F.col("o_orderkey") % 5 == 1, F.upper("c_name")).otherwise(F.col("c_name"))
    e = o.select(F.lit("An evening").alias("title"), F.when(F.col("o_orderkey") % 7 > 0, F.array(name, F.concat(F.lit("b"), src))).otherwise(F.array("c_name")).alias("performers"), F.array(src).alias("sources"))
    known = c.where("c_custkey % 4 = 0").select(F.lower("c_name").alias("key"), F.concat(F.lit("Known "), "c_custkey").alias("name"))
    return programmes.structured_identities(e, known)


@query("""SELECT o_custkey AS "group", min(c_name) AS headliner, CASE WHEN count(DISTINCT o_orderkey % 2) > 1 AND bool_or(o_orderkey % 4 = 1) THEN 'Guest|Friends' ELSE '' END AS co_headliners FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 <> 1) GROUP BY 1""")
def merged_bills(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    o = table(spark, d, "orders").join(c, "o_custkey")
    plain = o.where("o_orderkey % 4 <> 1").select("o_custkey").distinct()
    x = o.join(plain, "o_custkey", "left_semi").select(F.col("o_custkey").alias("group"), F.when(F.col("o_orderkey") % 4 == 1, F.concat("c_name", F.lit(" + Guest & Friends"))).otherwise(F.col("c_name")).alias("title"), (F.col("o_orderkey") % 2).alias("source"))
    return programmes.headlined(x).withColumn("co_headliners", F.array_join("co_headliners", "|"))


@query("""WITH r AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS venue, CASE WHEN o_orderpriority = '5-LOW' THEN '1-URGENT' ELSE o_orderpriority END AS key, o_orderkey FROM orders)
SELECT CAST(day AS VARCHAR) AS day, venue, key, groups, first, last, groups > 1 AS apart FROM (SELECT day, venue, key, count(*) AS groups, min(o_orderkey) AS first, max(o_orderkey) AS last FROM r GROUP BY 1, 2, 3) WHERE groups > 1""")
def titles_kept_apart(spark, d):
    o = table(spark, d, "orders").select(day("o_orderdate").alias("day"), F.col("o_orderstatus").alias("venue"), F.col("o_orderpriority").alias("key"), F.col("o_orderkey").alias("group"))
    equal = o.where("key = '5-LOW'").select("day", "venue", "key").distinct().withColumn("same", F.lit("1-URGENT"))
    return programmes.kept_apart(programmes.reviewed_titles(o, equal)).withColumns({"day": F.col("day").cast("string"), "apart": F.col("groups") > 1})


@query("""SELECT p_partkey AS post, CASE WHEN p_size % 10 = 0 THEN 'D' WHEN p_size % 7 = 0 THEN 'C' WHEN p_size % 5 = 1 OR p_size > 45 THEN 'A' WHEN p_size % 3 = 0 THEN 'C' WHEN p_partkey % 4 = 0 THEN 'A' ELSE 'B' END AS tier,
CASE WHEN p_size % 10 = 0 THEN 'DEFERRED_NON_ORDINARY_OR_AMBIGUOUS' WHEN p_size % 7 = 0 THEN 'NO_READY_RECOMMENDATION_PAYLOAD' WHEN p_size % 5 = 1 AND p_size > 45 THEN 'WRONG_PRIMARY|SUSPICIOUS_SHARED_APPLE_ID' WHEN p_size % 5 = 1 THEN 'WRONG_PRIMARY' WHEN p_size > 45 THEN 'SUSPICIOUS_SHARED_APPLE_ID'
WHEN p_size % 3 = 0 THEN 'CATALOGUE_UNRESOLVED' WHEN p_partkey % 4 = 0 THEN 'INDEPENDENT_IDENTITY_EVIDENCE_INCOMPLETE_OR_CONFLICTING' ELSE 'INDEPENDENT_HEALTHY_LEGACY_IDENTITY' END AS reasons FROM part""")
def archive_repair_tiers(spark, d):
    size, no, name = F.col("p_size"), F.lit(False), F.lower("p_name")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("post"), F.lit(True).alias("ordinary"), F.col("p_name").alias("subject"), name.alias("artist_key"), (size % 10 > 0).alias("confident"), (size % 7 > 0).alias("has_payload"), (size % 5 == 1).alias("wrong_primary"), no.alias("catalogue_owner_mismatch"), no.alias("context_as_artist"), no.alias("contamination"), (size > 45).alias("shared_id"), F.lit(None).cast("boolean").alias("unproven_recovery"), F.lit(True).alias("found"), name.alias("found_key"), F.when(size % 3 > 0, F.upper("p_name")).alias("found_name"), F.lit("7").alias("found_id"), F.when(F.col("p_partkey") % 4 > 0, "7").otherwise("8").alias("payload_id"), F.lit(True).alias("valid"), F.lit(True).alias("exact"))
    return programmes.archive_tiers(p).withColumn("reasons", F.array_join("reasons", "|"))


@query("""WITH a AS (SELECT c_custkey AS post, c_mktsegment AS kind FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT o_custkey AS post, count(*) AS payloads FROM orders GROUP BY 1), c AS (SELECT s_suppkey * 3 AS post, s_name AS held FROM supplier)
SELECT post, kind, payloads, held, concat_ws('+', CASE WHEN kind IS NOT NULL THEN 'post' END, CASE WHEN payloads IS NOT NULL THEN 'payload' END, CASE WHEN held IS NOT NULL THEN 'static' END) AS sides FROM a FULL JOIN b USING (post) FULL JOIN c USING (post)""")
def archive_sides(spark, d):
    a = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("post"), F.col("c_mktsegment").alias("kind"))
    b = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("post")).agg(F.count("*").alias("payloads"))
    c = table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("post"), F.col("s_name").alias("held"))
    return programmes.archive_audit(a, b, c)


@query("""SELECT lower(c_name) AS key, min(CAST(o_custkey % 9 + CASE WHEN o_custkey % 4 = 0 THEN o_orderkey ELSE 0 END AS VARCHAR)) AS external, count(*) AS posts FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' GROUP BY 1, o_custkey HAVING o_custkey % 4 > 0 OR count(*) = 1""")
def agreed_external_ids(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    ext = F.col("o_custkey") % 9 + F.when(F.col("o_custkey") % 4 == 0, F.col("o_orderkey")).otherwise(0)
    return programmes.agreed_ids(o.select(F.col("o_orderkey").alias("post"), F.array("c_name").alias("names"), (F.col("o_orderstatus") != "P").alias("confident"), ext.cast("string").alias("external")))


@query("""SELECT page_id, 'https://1.bp.blogspot.com/w1200-h800/' || page_id || '.jpg?s=/s72/x' AS large, 'https://1.bp.blogspot.com/s320-c/' || page_id || '.jpg?s=/s72/x' AS small, 'https://x.org/b' || page_id AS widest FROM pages""")
def sized_images(spark, d):
    n = F.col("page_id").cast("string")
    large = media.large_image(F.concat(F.lit("https://1.bp.blogspot.com/s72-w640-h426-c-rw/"), n, F.lit(".jpg?s=/s72/x")))
    small = F.concat(F.substring_index(media.thumbnail(F.concat(F.lit("https://1.bp.blogspot.com/s72-c/"), n, F.lit(".jpg"))), "?", 1), F.lit("?s=/s72/x"))
    wide = media.widest(F.concat(F.lit("https://x.org/a 300w, https://x.org/b"), n, F.lit(" 1200w, https://x.org/c 2x")), F.lit("https://x.org/d"))
    return table(spark, d, "pages").select("page_id", large.alias("large"), small.alias("small"), wide.alias("widest"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, event_id % 2 = 0 AS zoned FROM events""")
def utc_times(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    moment = media.zoned_time(F.concat(text, F.lit("+00:00")))
    e = table(spark, d, "events")
    return e.select("event_id", media.utc_iso(moment).alias("iso"), media.zoned_time(F.when(F.col("event_id") % 2 == 0, F.concat(text, F.lit("Z"))).otherwise(text)).isNotNull().alias("zoned"))


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY CAST(o_orderdate AS DATE), CASE WHEN o_orderkey % 3 = 0 THEN '20:00' ELSE '' END, lower(c_name), o_orderkey) AS at_venue, row_number() OVER (PARTITION BY o_orderstatus ORDER BY CAST(o_orderdate AS DATE), lower(c_name), lower(o_orderpriority), o_orderkey) AS in_letter FROM orders JOIN customer ON o_custkey = c_custkey""")
def letter_and_venue_orders(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("headliner"))
    o = table(spark, d, "orders").join(c, "o_custkey").select(F.col("o_orderkey").alias("id"), day("o_orderdate").alias("day"), "headliner", F.col("o_orderpriority").alias("venue"), F.when(F.col("o_orderkey") % 3 == 0, "20:00").alias("start_time"), "o_orderstatus")
    both = calendar.placed(calendar.placed(o, "o_orderstatus", calendar.venue_order(), "at_venue"), "o_orderstatus", calendar.concert_order(), "in_letter")
    return both.select(F.col("id").alias("o_orderkey"), "at_venue", "in_letter")
