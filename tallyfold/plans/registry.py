"""The query registry: name to plan, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import filters, graph, joins, resolution, state, votes
from ..sources.tables import table
from ..streaming.first_seen import stream_first_seen
from ..streaming.keyed_state import stream_keyed_state

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: The fixed points of time of queries that look back from a "now".
HALF, NOW = "2024-01-16 00:00:00", "2024-02-01 00:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return _QUERIES | {"stream_first_seen": stream_first_seen, "stream_keyed_state": stream_keyed_state}


def oracle_sql() -> dict[str, str]:
    return _SQL | {
        "stream_keyed_state": "SELECT user_id, strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS day, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1",
        "stream_first_seen": "SELECT DISTINCT user_id, event_type FROM events",
    }


def day(c):
    return F.to_date(c)


def money(c):
    return F.round(c, 2)


_EV = "(SELECT *, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour FROM events)"


@query("SELECT source, lang, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY ALL")
def source_scan_counts(spark, d):
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("chars"))


@query("SELECT name, min(priority) AS priority, min_by(key, priority) AS key FROM (SELECT c_name AS name, c_custkey AS key, 1 AS priority FROM customer UNION ALL SELECT s_name, s_suppkey, 0 FROM supplier) GROUP BY name")
def source_priority_union(spark, d):
    a = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key"), F.lit(1).alias("priority"))
    b = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.lit(0).alias("priority"))
    return a.unionByName(b).groupBy("name").agg(F.min("priority").alias("priority"), F.min_by("key", "priority").alias("key"))


@query("""SELECT source, count(*) AS n, count(quality) AS labelled, CASE WHEN count(quality) = 0 THEN 'empty' WHEN CAST(sum(quality) AS DOUBLE) / count(quality) < 0.5 THEN 'failed' ELSE 'ok' END AS status
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def source_health(spark, d):
    g = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").groupBy("source")
    ratio = F.sum("quality") / F.count("quality")
    return g.agg(F.count("*").alias("n"), F.count("quality").alias("labelled"), F.when(F.count("quality") == 0, "empty").when(ratio < 0.5, "failed").otherwise("ok").alias("status"))


@query("SELECT p_partkey, trim(regexp_replace(replace(strip_accents(lower(p_name)), 'ß', 'ss'), '\\s+', ' ', 'g')) AS key FROM part")
def fold_text_key(spark, d):
    return table(spark, d, "part").select("p_partkey", K.fold("p_name", "text").alias("key"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM part")
def slug(spark, d):
    return table(spark, d, "part").select("p_partkey", K.slug(F.col("p_name")).alias("slug"))


@query(r"""WITH t AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages)
SELECT page_id, CASE WHEN length(text) <= 300 THEN text ELSE regexp_replace(substr(text, 1, 300), '\s+\S*$', '') || '…' END AS summary FROM t""")
def html_strip(spark, d):
    return table(spark, d, "pages").select("page_id", K.summarize(K.strip_html(F.col("html"))).alias("summary"))


@query("""WITH p AS (SELECT page_id, regexp_extract(trim(url), '^(?i:(https?))://([^/?#]*)([^?#]*)[?]?([^#]*)', ['scheme', 'host', 'path', 'query']) AS u FROM pages),
k AS (SELECT page_id, lower(u.scheme) AS scheme, lower(u.host) AS host, rtrim(u.path, '/') AS path, list_sort(list_transform(list_filter(string_split(u.query, '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_') AND lower(split_part(x, '=', 1)) NOT IN ('lang', 'locale', 'hl', 'language')), lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END)) AS kept FROM p)
SELECT page_id, CASE WHEN host <> '' AND (path <> '' OR len(kept) > 0) THEN scheme || '://' || host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS url FROM k""")
def url_canonical(spark, d):
    return table(spark, d, "pages").select("page_id", K.canonical_url("url").alias("url"))


@query("SELECT o_orderkey, TRY_CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS DATE)::VARCHAR AS day FROM orders")
def safe_parse_date(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.try_to_date(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).cast("string").alias("day"))


@query("SELECT CAST(date_trunc('week', ts) AS DATE)::VARCHAR AS week, CAST(date_trunc('month', ts) AS DATE)::VARCHAR AS month, isoyear(ts) || '-W' || lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS period, count(*) AS n FROM events GROUP BY ALL")
def week_month_period(spark, d):
    e = table(spark, d, "events").select(day("ts").alias("day"))
    return e.groupBy(F.to_date(F.date_trunc("week", "day")).cast("string").alias("week"), F.to_date(F.date_trunc("month", "day")).cast("string").alias("month"), K.iso_week(F.col("day")).alias("period")).agg(F.count("*").alias("n"))


@query("""SELECT day::VARCHAR AS day, (CASE WHEN isodow(day) = 7 THEN CAST(day - INTERVAL 2 DAY AS DATE) ELSE CAST(day + to_days(CAST(5 - isodow(day) AS INTEGER)) AS DATE) END)::VARCHAR AS first,
CAST(CASE WHEN isodow(day) = 7 THEN day ELSE day + to_days(CAST(7 - isodow(day) AS INTEGER)) END AS DATE)::VARCHAR AS last FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)""")
def quick_weekend_range(spark, d):
    e = table(spark, d, "events").select(day("ts").alias("day")).distinct()
    first, last = K.quick_range(F.col("day"), "weekend")
    return e.select(F.col("day").cast("string").alias("day"), first.cast("string").alias("first"), last.cast("string").alias("last"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT doc_id, CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' WHEN lang <> 'en' THEN 'region' WHEN n_chars < 200 THEN 'short' WHEN n_chars > 20000 THEN 'long' WHEN contains(lower(text), 'licensed under') THEN 'notice' END AS reason FROM documents")
def eligibility_reason(spark, d):
    t = F.col("text")
    rules = [("empty", t.isNull() | (F.trim(t) == "")), ("region", F.col("lang") != "en"), ("short", F.col("n_chars") < 200), ("long", F.col("n_chars") > 20000), ("notice", F.contains(F.lower(t), F.lit("licensed under")))]
    return filters.split_eligible(table(spark, d, "documents"), rules).select("doc_id", "reason")


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'a') AND p_brand IN (SELECT p_brand FROM part WHERE p_partkey < 10) AND p_size BETWEEN 5 AND 30")
def facet_filter_and_or(spark, d):
    p = table(spark, d, "part")
    brands = p.where("p_partkey < 10").select("p_brand").distinct()
    return p.where(F.contains(F.lower("p_name"), F.lit("a")) & F.col("p_size").between(5, 30)).join(brands, "p_brand", "left_semi").select("p_partkey")


@query("SELECT event_id, props FROM events WHERE props IS NULL OR props NOT IN (SELECT props FROM events WHERE props IS NOT NULL GROUP BY props HAVING count(DISTINCT user_id) >= 100)")
def repeated_value_reject(spark, d):
    return filters.reject_repeated(table(spark, d, "events").select("event_id", "props", "user_id"), "props", "user_id", 100).select("event_id", "props")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')")
def region_semi_join(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region").where("r_name = 'EUROPE'"), F.expr("n_regionkey = r_regionkey")).select(F.col("n_nationkey").alias("s_nationkey"))
    return table(spark, d, "supplier").join(n, "s_nationkey", "left_semi").select("s_suppkey", "s_name")


@query("SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 10 = 0 THEN 'alias-' || s_suppkey END, n_name, 'Unsorted') AS place FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey % 2 = 0")
def lookup_priority_coalesce(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    alias = s.where("s_suppkey % 10 = 0").select("s_suppkey", F.concat(F.lit("alias-"), "s_suppkey").alias("alias"))
    nation = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    out = joins.priority_lookup(s, [(alias, "s_suppkey", "alias"), (nation, "s_nationkey", "n_name")], "place")
    return out.select("s_suppkey", F.coalesce("place", F.lit("Unsorted")).alias("place"))


@query("""SELECT event_id, min(o_orderpriority) AS credit FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events) e
JOIN (SELECT o_custkey, o_orderpriority, CAST(o_orderdate + INTERVAL 9130 DAY AS DATE) AS first, CAST(o_orderdate + INTERVAL 9220 DAY AS DATE) AS last FROM orders) o ON user_id = o_custkey AND day BETWEEN first AND last
GROUP BY event_id HAVING count(DISTINCT o_orderpriority) = 1""")
def range_join_credit(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("user_id").alias("who"), day("ts").alias("day"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("who"), F.col("o_orderpriority").alias("credit"), F.date_add(day("o_orderdate"), 9130).alias("first"), F.date_add(day("o_orderdate"), 9220).alias("last"))
    return joins.unique_in_range(e, o, ["who"], "day", "first", "last", "credit").select("event_id", "credit")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) = 1)")
def unique_one_to_one_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("who"))
    return joins.one_to_one(o, table(spark, d, "customer").select(F.col("c_custkey").alias("who"), "c_name"), ["who"]).select("o_orderkey", "c_name")


@query(f"SELECT event_id, user_id FROM events WHERE ts < TIMESTAMP '{HALF}' AND (user_id, hour(ts)) NOT IN (SELECT (user_id, hour(ts)) FROM events WHERE ts >= TIMESTAMP '{HALF}')")
def retained_anti_join(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.hour("ts").alias("h"))
    split = F.lit(HALF).cast("timestamp_ntz")
    return e.where(F.col("ts") < split).join(e.where(F.col("ts") >= split).select("user_id", "h"), ["user_id", "h"], "left_anti").select("event_id", "user_id")


@query("""SELECT o_orderkey, count(l_orderkey) AS overlaps, count(l_orderkey) > 0 AS covered FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate >= o_orderdate AND l_quantity > 25 GROUP BY 1""")
def overlap_residual_join(spark, d):
    o, l = table(spark, d, "orders").select("o_orderkey", "o_orderdate"), table(spark, d, "lineitem").where("l_quantity > 25").select("l_orderkey", "l_shipdate")
    j = o.join(l, (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("l_shipdate") >= F.col("o_orderdate")), "left")
    return j.groupBy("o_orderkey").agg(F.count("l_orderkey").alias("overlaps"), (F.count("l_orderkey") > 0).alias("covered"))


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT s_name)), ' | ') AS promoters FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def promoter_array_canonical(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    told = votes.canonical_list(table(spark, d, "lineitem").join(s, "l_suppkey"), "l_orderkey", "s_name")
    return told.select("l_orderkey", F.array_join("names", " | ").alias("promoters"))


@query("SELECT md5(coalesce(text, '')) AS key, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def exact_dedup(spark, d):
    return table(spark, d, "documents").groupBy(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query(f"SELECT day::VARCHAR AS day, user_id, max_by(event_id, struct_pack(v := coalesce(value, -1), i := -event_id)) AS event_id, min(ts) AS first_seen FROM {_EV} GROUP BY 1, 2")
def richest_survivor_merge(spark, d):
    e = table(spark, d, "events").select(day("ts").alias("day"), "user_id", "event_id", "ts", "value")
    e = e.withColumn("day", F.col("day").cast("string"))
    return e.groupBy("day", "user_id").agg(F.max_by("event_id", F.struct(F.coalesce("value", F.lit(-1.0)), -F.col("event_id"))).alias("event_id"), F.min("ts").alias("first_seen"))


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 > 0 THEN hour(ts) END AS t FROM events),
k AS (SELECT *, (SELECT 1) AS one, count(DISTINCT t) OVER (PARTITION BY day, user_id) AS n FROM e)
SELECT event_id, min(event_id) OVER (PARTITION BY day, user_id, CASE WHEN n <= 1 THEN 'all' WHEN t IS NULL THEN 'row:' || event_id ELSE CAST(t AS VARCHAR) END) AS "group" FROM k""")
def nontransitive_block_merge(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", day("ts").alias("day"), F.when(F.col("event_id") % 3 > 0, F.hour("ts")).alias("t"))
    return resolution.merge_blocks(e, ["day", "user_id"], "event_id", "t")


@query("SELECT o_orderkey, sha256(CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || chr(31) || lower(s_name) || chr(31) || CAST(s_nationkey AS VARCHAR)) AS identity, substr(sha256(CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || chr(31) || lower(s_name) || chr(31) || CAST(s_nationkey AS VARCHAR)), 1, 16) AS public_id FROM orders JOIN supplier ON o_custkey = s_suppkey")
def identity_hash(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("s_suppkey"), day("o_orderdate").cast("string").alias("day"))
    j = o.join(table(spark, d, "supplier"), "s_suppkey")
    return j.select("o_orderkey", K.event_identity(F.col("day"), F.lower("s_name"), F.col("s_nationkey").cast("string")).alias("identity")).withColumn("public_id", K.public_id(F.col("identity")))


@query(f"""WITH s AS (SELECT user_id, CAST(max(ts) AS DATE) AS day, min(ts) AS first_seen, max(ts) AS last_seen FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY 1),
n AS (SELECT user_id, CAST(max(ts) AS DATE) AS day FROM events WHERE ts >= TIMESTAMP '{HALF}' GROUP BY 1)
SELECT user_id, coalesce(n.day, s.day)::VARCHAR AS day, coalesce(s.first_seen, TIMESTAMP '{NOW}') AS first_seen, CASE WHEN n.day IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE s.last_seen END AS last_seen
FROM s FULL JOIN n USING (user_id) WHERE coalesce(n.day, s.day) >= DATE '2024-01-05'""")
def state_upsert_first_seen(spark, d):
    e, split = table(spark, d, "events").select("user_id", "ts"), F.lit(HALF).cast("timestamp_ntz")
    held = e.where(F.col("ts") < split).groupBy("user_id").agg(day(F.max("ts")).alias("day"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    seen = e.where(F.col("ts") >= split).groupBy("user_id").agg(day(F.max("ts")).alias("day"))
    return state.upsert(held, seen, "user_id", F.lit(NOW).cast("timestamp_ntz"), F.lit("2024-01-05").cast("date")).withColumn("day", F.col("day").cast("string"))


@query(f"""WITH b AS (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY 1), a AS (SELECT user_id, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{HALF}' GROUP BY 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN b.n IS NULL THEN 'new' WHEN a.n IS NULL THEN 'gone' WHEN a.n <> b.n THEN 'changed' ELSE 'same' END AS change FROM b FULL JOIN a ON a.user_id = b.user_id""")
def change_report(spark, d):
    e, split = table(spark, d, "events").select("user_id", "ts"), F.lit(HALF).cast("timestamp_ntz")
    b, a = (e.where(c).groupBy("user_id").agg(F.count("*").alias("n")) for c in (F.col("ts") < split, F.col("ts") >= split))
    return joins.full_compare(b, a, "user_id", F.col("a.n") != F.col("b.n")).select(F.coalesce("a.user_id", "b.user_id").alias("user_id"), "change")


@query(f"SELECT user_id, max(ts) AS last_seen FROM events GROUP BY 1 HAVING max(ts) >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY")
def ttl_expiry(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last_seen"))
    return g.where(F.col("last_seen") >= F.expr(f"timestamp_ntz'{NOW}' - interval 7 days"))


@query()
def greedy_match(spark, d):
    edges = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")).agg(F.sum("l_quantity").alias("score"))
    return joins.greedy_match(edges, "part", "supp", "score")


@query("""WITH g AS (SELECT user_id, event_type, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1, 2 HAVING count(DISTINCT CAST(ts AS DATE)) >= 13)
SELECT user_id, min(event_type) AS genre, max(days) AS days FROM g GROUP BY 1 HAVING count(*) = 1""")
def artist_consensus(spark, d):
    return votes.consensus(table(spark, d, "events"), "user_id", "event_type", day("ts"), 13).withColumnsRenamed({"event_type": "genre", "units": "days"})


@query("SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= 2 AND count(DISTINCT (l_orderkey, CAST(l_shipdate AS DATE))) >= 2")
def two_source_admission(spark, d):
    return votes.admitted(table(spark, d, "lineitem"), "l_partkey", "l_suppkey", F.struct("l_orderkey", day("l_shipdate")))


@query("SELECT l_partkey, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'ambiguous' WHEN count(DISTINCT l_suppkey) >= 2 THEN 'resolved' ELSE 'review' END AS verdict FROM lineitem GROUP BY 1")
def provider_vote(spark, d):
    return votes.verdict(table(spark, d, "lineitem"), "l_partkey", "l_returnflag", "l_suppkey").select("l_partkey", "verdict")


@query("SELECT event_type, strftime(ts, '%Y-%m') AS month, count(*) AS n FROM events GROUP BY 1, 2")
def facet_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, count(*) AS n, CAST(grouping(year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS BIGINT) AS level FROM orders GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate), day(o_orderdate))")
def year_month_day_rollup(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"), F.day("o_orderdate").cast("long").alias("d"))
    return o.rollup("y", "m", "d").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@query("SELECT o_custkey, max_by(o_orderkey, struct_pack(r := o_orderstatus = 'F', t := o_orderdate, k := o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def preferred_row(spark, d):
    return votes.preferred(table(spark, d, "orders"), "o_custkey", "o_orderkey", F.col("o_orderstatus") == "F", F.col("o_orderdate"), F.col("o_orderkey"))


@query("SELECT l_orderkey, min(l_linenumber) AS first_line, bool_and(l_returnflag = 'R') AS sold_out, count(*) AS sessions FROM lineitem GROUP BY 1")
def session_collapse(spark, d):
    return votes.collapsed(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber", F.col("l_returnflag") == "R").withColumnRenamed("first", "first_line")


@query("SELECT source, max_by(doc_id, struct_pack(n := n_chars, i := -doc_id)) AS hero FROM documents JOIN labels USING (doc_id) WHERE quality = 1 GROUP BY 1")
def article_hero_pick(spark, d):
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return votes.preferred(table(spark, d, "documents").join(good, "doc_id"), "source", "doc_id", F.col("n_chars"), -F.col("doc_id")).withColumnRenamed("doc_id", "hero")


@query("SELECT lang, round(100.0 * count(quality) / count(*), 2) AS percent FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def coverage_percentage(spark, d):
    j = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.groupBy("lang").agg(F.round(100.0 * F.count("quality") / F.count("*"), 2).alias("percent"))


@query("SELECT event_type, event_id, CAST(rank AS INTEGER) AS rank FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank FROM events WHERE value IS NOT NULL) WHERE rank <= 100")
def group_cap_rank(spark, d):
    w = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").where("value is not null").select("event_type", "event_id", F.row_number().over(w).alias("rank")).where("rank <= 100")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS day, lower(c_name) AS artist FROM orders JOIN customer ON o_custkey = c_custkey WHERE CAST(o_orderdate AS DATE) >= DATE '1997-01-01'")
def upcoming_sorted_export(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), day("o_orderdate").alias("day")).where("day >= date'1997-01-01'")
    return o.join(table(spark, d, "customer").select("c_custkey", F.lower("c_name").alias("artist")), "c_custkey").select("o_orderkey", F.col("day").cast("string").alias("day"), "artist").orderBy("day", "artist", "o_orderkey")


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_quantity > 30")
def id_set_difference(spark, d):
    return table(spark, d, "orders").select("o_orderkey").subtract(table(spark, d, "lineitem").where("l_quantity > 30").select("l_orderkey"))


@query("""WITH e AS (SELECT 's' || s_suppkey AS child, 'n' || s_nationkey AS parent FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
ns AS (SELECT child FROM e UNION SELECT parent FROM e), s1 AS (SELECT e.child, e.parent AS ancestor FROM e)
SELECT child, child AS ancestor, 0 AS depth FROM ns UNION ALL SELECT child, ancestor, 1 FROM s1 UNION ALL SELECT a.child, b.parent, 2 FROM s1 a JOIN e b ON a.ancestor = b.child""")
def taxonomy_closure(spark, d):
    tag = lambda t, c: F.concat(F.lit(t), F.col(c)).cast("string")
    e = table(spark, d, "supplier").select(tag("s", "s_suppkey").alias("child"), tag("n", "s_nationkey").alias("parent"))
    e = e.union(table(spark, d, "nation").select(tag("n", "n_nationkey"), tag("r", "n_regionkey")))
    return graph.closure(e)


@query("""WITH RECURSIVE e AS (SELECT 'c' || o_custkey AS u, 'o' || o_orderkey AS v FROM orders UNION SELECT 'o' || l_orderkey, 's' || l_suppkey FROM lineitem),
c AS (SELECT 'c' || c_custkey AS node FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT 'o' || o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' UNION SELECT 's' || s_suppkey FROM supplier WHERE s_acctbal > 0),
w(source, target, depth) AS (SELECT DISTINCT u, u, 0 FROM e WHERE u LIKE 'c%' AND u NOT IN (SELECT node FROM c) UNION SELECT w.source, e.v, w.depth + 1 FROM w JOIN e ON w.target = e.u WHERE w.depth < 2 AND w.target NOT IN (SELECT node FROM c))
SELECT source, target, CAST(min(depth) AS INTEGER) AS depth FROM w WHERE target IN (SELECT node FROM c) GROUP BY 1, 2""")
def search_expansion_bfs(spark, d):
    """From customers over their orders to suppliers, by whole keys; covered nodes are rows of the tables."""
    tag = lambda t, c, name: F.concat(F.lit(t), F.col(c)).cast("string").alias(name)
    o, l, c = table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "customer")  # noqa: E741
    bought = o.select(tag("c", "o_custkey", "u"), tag("o", "o_orderkey", "v"))
    e = bought.union(l.select(tag("o", "l_orderkey", "u"), tag("s", "l_suppkey", "v"))).distinct()
    covered = c.where("c_mktsegment = 'BUILDING'").select(tag("c", "c_custkey", "node")).union(o.where("o_orderpriority = '1-URGENT'").select(tag("o", "o_orderkey", "node")))
    covered = covered.union(table(spark, d, "supplier").where("s_acctbal > 0").select(tag("s", "s_suppkey", "node"))).distinct()
    return graph.first_covered(bought.select(F.col("u").alias("node")).distinct(), e, covered, 2)


@query("""SELECT p_partkey, CASE WHEN p_size > 40 THEN '' WHEN contains(p_type, 'BRASS') THEN 'brass' WHEN n = 1 THEN 'single' WHEN p_brand = 'Brand#11' THEN 'brand' ELSE '' END AS genre,
CASE WHEN p_size > 40 THEN 'blank' WHEN contains(p_type, 'BRASS') THEN 'taxonomy' WHEN n = 1 THEN 'consensus' WHEN p_brand = 'Brand#11' THEN 'label' ELSE 'none' END AS method
FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1) ON p_partkey = l_partkey""")
def genre_cascade(spark, d):
    n = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_distinct("l_returnflag").alias("n"))
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_type", "p_brand").join(n, "p_partkey", "left")
    rung = lambda g, m: F.struct(F.lit(g).alias("genre"), F.lit(m).alias("method"))
    c = F.when(F.col("p_size") > 40, rung("", "blank")).when(F.contains("p_type", F.lit("BRASS")), rung("brass", "taxonomy")).when(F.col("n") == 1, rung("single", "consensus")).when(F.col("p_brand") == "Brand#11", rung("brand", "label")).otherwise(rung("", "none"))
    return p.select("p_partkey", c.alias("c")).select("p_partkey", "c.genre", "c.method")


@query("""SELECT p_partkey, score FROM (SELECT p_partkey, CASE WHEN lower(p_name) = 'part' THEN 0 WHEN starts_with(lower(p_name), 'part') THEN 20 WHEN contains(' ' || lower(p_name), ' part') THEN 40 WHEN contains(lower(p_name), 'a') THEN 50 END AS score FROM part) WHERE score IS NOT NULL""")
def search_score_ladder(spark, d):
    n = F.lower("p_name")
    score = F.when(n == "part", 0).when(F.startswith(n, F.lit("part")), 20).when(F.contains(F.concat(F.lit(" "), n), F.lit(" part")), 40).when(F.contains(n, F.lit("a")), 50)
    return table(spark, d, "part").select("p_partkey", score.alias("score")).where("score is not null")


@query("SELECT conv_id, turn, role, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) THEN 'headliner' WHEN role = 'user' THEN 'co_headliner' ELSE 'opener' END AS part FROM conversations")
def bill_role_explode(spark, d):
    return votes.roles(table(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", F.col("role") == "user")


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS missing, count(DISTINCT user_id) AS artists, round(avg(value), 2) AS mean FROM events GROUP BY 1")
def quality_report(spark, d):
    return votes.quality(table(spark, d, "events"), "event_type", "value", "user_id").withColumnRenamed("people", "artists")


@query("""WITH c AS (SELECT count(*) AS n, count(*) - count(DISTINCT o_orderkey) AS dup, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1996-01-01') AS prev FROM orders)
SELECT n, CAST(dup AS BIGINT) AS duplicates, n >= 100 AND dup = 0 AND n BETWEEN 0.6 * prev AND 2.5 * prev AS publish FROM c""")
def publication_gate(spark, d):
    c = table(spark, d, "orders").agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct("o_orderkey")).alias("duplicates"), F.count_if(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("prev"))
    return c.select("n", "duplicates", ((F.col("n") >= 100) & (F.col("duplicates") == 0) & F.col("n").between(0.6 * F.col("prev"), 2.5 * F.col("prev"))).alias("publish"))
