"""Queries of names in texts, payload files and adaptive windows, with their SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import autolinks, calendar, editorial, programmes, reports, snapshots
from ..sources import payload_files, registry, shards, sites
from ..sources.staging import cut, folder
from ..sources.tables import table
from .registry import day, query

_OUTSIDE = "[^\\p{L}\\p{N}]"


@query(f"""WITH t AS (SELECT lower(array_to_string(string_split(text, ' ')[1:3], ' ')) AS term, min(CAST(item_id AS VARCHAR)) AS slug FROM benchmark GROUP BY 1),
m AS MATERIALIZED (SELECT doc_id, slug, term, lower(text) AS low FROM documents JOIN t ON contains(lower(text), term))
SELECT DISTINCT doc_id, slug FROM m WHERE regexp_matches(low, '(^|{_OUTSIDE})' || regexp_escape(term) || '($|{_OUTSIDE})')""")
def linked_names(spark, d):
    """The first three words of each benchmark item as names, looked up in all documents."""
    terms = table(spark, d, "benchmark").select(F.array_join(F.slice(F.split("text", " "), 1, 3), " ").alias("term"), F.col("item_id").cast("string").alias("slug"))
    return autolinks.linked(table(spark, d, "documents"), terms).select(F.col("id").alias("doc_id"), "slug")


@query("SELECT page_id, strlen(url) AS url_bytes, strlen(html) AS html_bytes, CAST(NULL AS VARCHAR) AS fault FROM pages")
def payload_round_trip(spark, d):
    """Each page as a payload file of its own, written, read back and taken apart."""
    path = f"{folder(spark)}/payloads-{uuid.uuid4().hex}"
    body = F.to_json(F.struct(F.lit(1).alias("schemaVersion"), "page_id", F.struct("url", "html").alias("subject")))
    cut(payload_files.write_payloads(table(spark, d, "pages").select(F.concat(F.lit("page-"), "page_id").alias("name"), body.alias("body")), path if "://" in path else path.replace("file:", "file://"), variable="payload"))
    got = payload_files.read_payloads(spark, path)
    part = lambda p, kind="string": F.try_variant_get("payload", p, kind)
    size = lambda p: F.octet_length(part(p)).cast("long")
    return got.select(part("$.page_id", "long").alias("page_id"), size("$.subject.url").alias("url_bytes"), size("$.subject.html").alias("html_bytes"), "fault")


_CAP = 40


@query(f"""WITH RECURSIVE days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1), first AS (SELECT min(day) AS day FROM days),
w(start, stop) AS (SELECT CAST(day + CAST(i * 7 AS INTEGER) AS DATE), CAST(day + CAST(i * 7 + 6 AS INTEGER) AS DATE) FROM first, range(8) r(i)
 UNION ALL SELECT CAST(CASE WHEN h = 0 THEN start ELSE start + CAST((stop - start) // 2 + 1 AS INTEGER) END AS DATE), CAST(CASE WHEN h = 0 THEN start + CAST((stop - start) // 2 AS INTEGER) ELSE stop END AS DATE) FROM w, range(2) x(h) WHERE start < stop AND (SELECT sum(n) FROM days WHERE day BETWEEN start AND stop) > {_CAP})
SELECT strftime(start, '%Y-%m-%d') AS start, strftime(stop, '%Y-%m-%d') AS stop, CASE WHEN coalesce(n, 0) <= {_CAP} THEN 'complete' WHEN start < stop THEN 'halved' ELSE 'overflow' END AS status, CASE WHEN coalesce(n, 0) <= {_CAP} OR start = stop THEN least(coalesce(n, 0), {_CAP}) ELSE 0 END AS found
FROM (SELECT start, stop, (SELECT sum(n) FROM days WHERE day BETWEEN start AND stop) AS n FROM w)""")
def adaptive_windows(spark, d):
    """Eight weeks asked of a source that gives at most 40 rows a request."""
    e = table(spark, d, "events").select("event_id", "ts", day("ts").alias("day"))

    def fetch(windows):
        place = F.row_number().over(Window.partitionBy("start", "stop").orderBy("ts", "event_id"))
        met = windows.join(e, e.day.between(windows.start, windows.stop)).withColumn("place", place)
        size = met.groupBy("start", "stop").agg(F.count("*").alias("n"))
        return met.where(F.col("place") <= _CAP).select("start", "stop", "event_id"), windows.join(size, ["start", "stop"], "left").select("start", "stop", (F.coalesce("n", F.lit(0)) > _CAP).alias("more"))

    first = e.agg(F.min("day")).first()[0] or dt.date(2024, 1, 1)
    rows, asked = programmes.adaptive_windows(programmes.date_windows(spark, first, 56), fetch)
    found = rows.groupBy("start", "stop").agg(F.count("*").alias("found"))
    return asked.join(found, ["start", "stop"], "left").select(F.col("start").cast("string").alias("start"), F.col("stop").cast("string").alias("stop"), "status", F.coalesce("found", F.lit(0).cast("long")).alias("found"))


@query("""WITH w AS (SELECT DISTINCT regexp_extract(text, '^[A-Za-zÀ-ÿ]+') AS word, lang FROM documents), k AS (SELECT word, lang, strip_accents(lower(word)) AS key FROM w WHERE word <> '')
SELECT lang, word, CAST(row_number() OVER (PARTITION BY lang, substr(key, 1, 1) ORDER BY key COLLATE fr, word COLLATE fr, word) AS INTEGER) AS place FROM k""")
def locale_places(spark, d):
    """First words of the documents in French order, numbered under each first letter."""
    words = table(spark, d, "documents").select("lang", F.regexp_extract("text", "^[A-Za-zÀ-ÿ]+", 0).alias("word")).where("word <> ''").distinct()
    loose = calendar.in_locale("word", "fr", False, False)
    first = calendar.in_locale(F.substring("word", 1, 1), "fr", False, False)
    place = F.row_number().over(Window.partitionBy("lang", first).orderBy(loose, calendar.in_locale("word"), F.col("word")))
    return words.select("lang", "word", place.alias("place"))


@query("""WITH w AS (SELECT regexp_extract(text, '^[A-Za-zÀ-ÿ]+') AS word FROM documents)
SELECT replace(strip_accents(lower(word)), 'ß', 'ss') AS key, count(DISTINCT word) AS spellings, count(*) AS rows FROM w WHERE word <> '' GROUP BY 1""")
def locale_spellings(spark, d):
    words = table(spark, d, "documents").select(F.regexp_extract("text", "^[A-Za-zÀ-ÿ]+", 0).alias("word")).where("word <> ''")
    return calendar.same_names(words, "word").select(calendar.fold_latin(F.col("word")).alias("key"), "spellings", "rows")


@query("""SELECT lpad(CAST(page_id % 7 AS VARCHAR), 3, '0') AS shard, 1 AS attempts, count(*) AS declared, count(*) AS lines, 'ok' AS status FROM pages GROUP BY page_id % 7""")
def page_loads(spark, d):
    """Addresses of the pages, landed as files that declare their number, and how each was loaded."""
    base = f"{folder(spark)}/landed-{uuid.uuid4().hex}"
    p = table(spark, d, "pages").select("url", (F.col("page_id") % 7).alias("k"))
    head = p.groupBy("k").agg(F.concat(F.lit("# rows "), F.count("*").cast("string")).alias("url"))
    p.unionByName(head.select("url", "k")).repartition("k").sortWithinPartitions("k").write.partitionBy("k").text(base)
    local = base.removeprefix("file:") if base.startswith("file:") else base
    spark.dataSource.register(registry.Pages)
    shards = [r["k"] for r in p.select("k").distinct().collect()]
    read = lambda k: spark.read.format("tallyfold_pages").option("path", f"{local}/k={k}").option("declared", "# rows ").option("loads", "true").load().withColumn("shard", F.lpad(F.lit(str(k)), 3, "0"))
    loads = read(shards[0])
    for k in shards[1:]:
        loads = loads.unionByName(read(k))
    return registry.page_health(loads).select("shard", "attempts", "declared", "lines", "status")


@query("""WITH r AS (SELECT o_orderkey AS id, 'Act ' || o_custkey || ' @ ' || CASE WHEN o_orderstatus = 'P' THEN 'Nowhere' ELSE n_name END || ' - 2026' AS title, n_name, o_orderstatus, n_regionkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
m AS (SELECT title, min(n_name) AS venue FROM r WHERE o_orderstatus = 'P' AND n_regionkey < 2 GROUP BY 1),
v AS (SELECT id, coalesce(m.venue, n.n_name) AS venue FROM r LEFT JOIN m USING (title) LEFT JOIN nation n ON lower(n.n_name) = lower(regexp_extract(title, '@ (.*) - ', 1)))
SELECT id, venue, CASE WHEN venue IS NULL THEN 'unresolved' WHEN venue NOT IN (SELECT n_name FROM nation WHERE n_regionkey > 0) THEN 'outside' ELSE 'associated' END AS status FROM v""")
def review_venues(spark, d):
    """Orders as concert reviews at a nation: by the title's place, by reviewed titles, outside the registry, unresolved."""
    n, c = table(spark, d, "nation"), table(spark, d, "customer")
    at = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("o_custkey"), "n_name", "n_regionkey")
    place = F.when(F.col("o_orderstatus") == "P", "Nowhere").otherwise(F.col("n_name"))
    r = table(spark, d, "orders").join(at, "o_custkey").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("Act "), "o_custkey", F.lit(" @ "), place, F.lit(" - 2026")).alias("title"), F.lit("concert_review").alias("type"), "n_name", "n_regionkey", "o_orderstatus")
    manual = r.where("o_orderstatus = 'P' and n_regionkey < 2").select("title", F.col("n_name").alias("venue"))
    return editorial.review_places(r, n.select(F.lower("n_name").alias("key"), F.col("n_name").alias("venue")), manual, n.where("n_regionkey > 0").select(F.col("n_name").alias("venue")))


@query("""WITH l AS (SELECT l_orderkey, min(p_name) FILTER (WHERE l_returnflag = 'A') AS old_genre, list_sort(list(DISTINCT p_brand) FILTER (WHERE l_linenumber < 3)) AS old_bill, min(p_name) FILTER (WHERE l_discount < 0.07) AS genre, list_sort(list(DISTINCT p_brand) FILTER (WHERE l_linenumber < 3 OR l_tax > 0.07)) AS bill FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
o AS (SELECT *, o_orderdate < TIMESTAMP '2001-01-01' AS b, o_orderdate >= TIMESTAMP '1996-01-01' AS c FROM orders JOIN l ON l_orderkey = o_orderkey),
m AS (SELECT count(*) FILTER (WHERE c) AS events, count(*) FILTER (WHERE c AND genre IS NULL) AS blank, count(*) FILTER (WHERE b AND c) AS compared, count(*) FILTER (WHERE c AND NOT b) AS new_ids, count(*) FILTER (WHERE b AND NOT c) AS missing_ids, count(*) FILTER (WHERE c AND genre IS NOT NULL AND o_orderstatus = 'P') AS genre_provenance, count(*) FILTER (WHERE b AND c AND old_genre IS NOT NULL AND genre IS NULL) AS genre_loss, count(*) FILTER (WHERE b AND c AND bill <> coalesce(old_bill, [])) AS billing_churn, count(*) FILTER (WHERE c AND o_totalprice > 400000) AS flat_bill, count(*) FILTER (WHERE c AND o_orderpriority = '1-URGENT') AS programme_title FROM o)
SELECT CASE WHEN genre_provenance > 0 OR (compared >= 100 AND (genre_loss >= greatest(5, floor(compared * 0.01)) OR billing_churn >= greatest(10, floor(compared * 0.02)))) OR blank * 2 > events THEN 'investigate' WHEN genre_loss + billing_churn > 0 OR flat_bill >= 100 OR programme_title >= 50 THEN 'review' ELSE 'normal' END AS status,
concat_ws(' ', CASE WHEN genre_provenance > 0 THEN 'genre_provenance:investigate:' || genre_provenance END, CASE WHEN genre_loss > 0 THEN 'genre_loss:' || CASE WHEN compared >= 100 AND genre_loss >= greatest(5, floor(compared * 0.01)) THEN 'investigate:' ELSE 'review:' END || genre_loss END, CASE WHEN billing_churn > 0 THEN 'billing_churn:' || CASE WHEN compared >= 100 AND billing_churn >= greatest(10, floor(compared * 0.02)) THEN 'investigate:' ELSE 'review:' END || billing_churn END,
 CASE WHEN flat_bill >= 100 THEN 'flat_bill_review_queue:review:' || flat_bill END, CASE WHEN programme_title >= 50 THEN 'programme_title_review_queue:review:' || programme_title END, CASE WHEN blank * 2 > events THEN 'low_genre_coverage:investigate:' || blank END) AS alerts, events, compared, new_ids, missing_ids FROM m""")
def release_watch(spark, d):
    """Orders before 2001 as the published release, those since 1996 as the candidate."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    own = lambda test, c: F.when(test, F.col(c))
    line, tax = F.col("l_linenumber") < 3, F.col("l_tax") > 0.07
    l = table(spark, d, "lineitem").join(p, "l_partkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(own(F.col("l_returnflag") == "A", "p_name")).alias("old_genre"), F.array_sort(F.collect_set(own(line, "p_brand"))).alias("old_bill"), F.min(own(F.col("l_discount") < 0.07, "p_name")).alias("genre"), F.array_sort(F.collect_set(own(line | tax, "p_brand"))).alias("bill"))  # noqa: E741
    o = table(spark, d, "orders").join(l, "o_orderkey").withColumnRenamed("o_orderkey", "public_id")
    when = lambda text: F.lit(text).cast("timestamp_ntz")
    base = o.where(F.col("o_orderdate") < when("2001-01-01 00:00:00")).select("public_id", F.col("old_genre").alias("genre"), F.col("old_bill").alias("bill"))
    new = o.where(F.col("o_orderdate") >= when("1996-01-01 00:00:00")).select("public_id", "genre", "bill", F.when(F.col("o_orderstatus") != "P", "source").alias("method"), (F.col("o_totalprice") > 400000).alias("flat_bill"), (F.col("o_orderpriority") == "1-URGENT").alias("programme_title"))
    told = F.array_join(F.transform("alerts", lambda a: F.concat_ws(":", a["code"], a["severity"], a["n"].cast("string"))), " ")
    return reports.release_monitor(base, new).select("status", told.alias("alerts"), *[f"metrics.{c}" for c in ("events", "compared", "new_ids", "missing_ids")])


@query()
def replayed_listings(spark, d):
    """Events of the first half month as held rows of a failed source, judged against the second half's by the merge."""
    e = table(spark, d, "events")
    rows = e.select(F.col("event_id").alias("row"), F.to_date(F.date_trunc("month", "ts")).alias("day"), F.get_json_object("props", "$.k").alias("venue_key"), F.concat(F.lit("Artist "), "user_id").alias("title"), F.when(F.minute("ts") < 20, F.date_format("ts", "HH:00")).alias("time"), F.col("event_type").alias("source"), F.lit(False).alias("official"), F.lit(None).cast("string").alias("ticket"), F.col("ts").cast("timestamp").alias("last_success"))
    first = F.dayofmonth("last_success") < 16
    judged = e.select(F.col("event_type").alias("source")).distinct().withColumn("status", F.when(F.col("source") == "click", "failed").otherwise("ok"))
    now = F.lit("2024-01-17 00:00:00").cast("timestamp")
    return snapshots.replay_equivalent(rows.where(~first), rows.where(first), judged, now, F.lit("2024-01-01").cast("date")).select("row", "source", "fate")


@query("""WITH n AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS titles FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS card, titles[i] AS title, 'https://x.org' || hrefs[i] AS link FROM n, range(1, 99) r(i) WHERE i <= len(hrefs)""")
def site_cards(spark, d):
    """The links of each page's navigation as the cards of a declared site."""
    site = {"nav": sites.Site("nav li", {"title": "a", "ticket": "a@href"}, "https://x.org/")}
    pages = table(spark, d, "pages").select(F.lit("nav").alias("source"), F.col("page_id").alias("page"), "html")
    return sites.cards(pages, site).select(F.col("page").cast("long").alias("page_id"), "card", F.col("fields")["title"].alias("title"), sites.absolute(F.col("fields")["ticket"], F.lit("https://x.org/")).alias("link"))


@query("""SELECT s_nationkey AS nation, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 2) GROUP BY 1""")
def sharded_assets(spark, d):
    """Suppliers as a keyed asset by nation, written in shards, and read for the nations of two regions."""
    path = f"{folder(spark)}/asset-{uuid.uuid4().hex}"
    s = table(spark, d, "supplier")
    shards.write_shards(s, path, "s_nationkey", 8)
    keys = [r[0] for r in table(spark, d, "nation").where("n_regionkey < 2").select("n_nationkey").collect()]
    return shards.read_shards(spark, path, s.schema, keys).groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))
