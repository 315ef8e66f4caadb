"""Reports by period, counters, audits, comparisons of releases, and the gates before publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import iso_week


def last_period(today: Column, frequency: str) -> tuple[Column, Column, Column]:
    """(identifier, first day, day after the last) of the last whole week (Monday first) or month before `today`."""
    if frequency not in ("weekly", "monthly"):
        raise ValueError(frequency)
    end = F.to_date(F.date_trunc("week" if frequency == "weekly" else "month", today))
    start = F.date_sub(end, 7) if frequency == "weekly" else F.to_date(F.add_months(end, -1))
    return (iso_week(start) if frequency == "weekly" else F.date_format(start, "yyyy-MM")), start, end


def publishes_today(today: Column, frequency: str) -> Column:
    return F.weekday(today) == 0 if frequency == "weekly" else F.dayofmonth(today) == 1


def discovered(df: DataFrame, first: Column, end: Column, published: Column, as_of: Column | None = None) -> DataFrame:
    """Listings first seen within [first, end) that still lie ahead of publication, once per public_id.

    df(public_id, first_seen, day, artist, venue). Epoch sentinels and null
    sightings are out; an identifier that is not 16 hex digits is an error.
    """
    if not df.where(~F.coalesce(F.col("public_id").rlike("^[0-9a-f]{16}$"), F.lit(False))).isEmpty():
        raise ValueError("a published identifier is not valid")
    seen = F.to_date("first_seen")
    cutoff = published if as_of is None else F.greatest(published, F.coalesce(as_of, published))
    hit = df.where((F.col("first_seen") >= F.lit("1970-01-02").cast("date")) & (seen >= first) & (seen < end) & (F.col("day") >= cutoff))
    once = F.row_number().over(Window.partitionBy("public_id").orderBy("day", "first_seen"))
    return hit.withColumn("_n", once).where("_n = 1").drop("_n").orderBy("day", F.lower("artist"), F.lower("venue"), "public_id")


def latest_edition(df: DataFrame) -> DataFrame:
    """The edition(frequency, end_exclusive, ...) that ended last; a weekly one beats a monthly one of the same day."""
    return df.orderBy(F.desc("end_exclusive"), (F.col("frequency") == "weekly").desc(), "identifier").limit(1)


def newest_by(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Manifest merge: the newest row of each key."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def counters(df: DataFrame, column: str) -> DataFrame:
    """(value, n, rank): counts in order of frequency, ties by value; missing values count as ''."""
    n = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")).agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "value")


def genre_outliers(df: DataFrame, key: str, genre: str, root: str, external: str, most_genres: int = 8, most_roots: int = 4) -> DataFrame:
    """(key, genres, roots, reason) of keys with eight genres or more, four roots or more, or a single external one."""
    g = df.groupBy(key).agg(F.count_distinct(genre).alias("genres"), F.count_distinct(root).alias("roots"), F.bool_and(external).alias("_x"))
    reason = F.when(F.col("genres") >= most_genres, "genres").when(F.col("roots") >= most_roots, "roots").when((F.col("genres") == 1) & F.col("_x"), "single external")
    return g.withColumn("reason", reason).where("reason is not null").drop("_x")


def visible_genres(closure: DataFrame, used: DataFrame) -> DataFrame:
    """(genre, own, total, visible): counts with all descendants; a genre shows if it or a descendant is used.

    closure(child, ancestor) includes each genre itself; used(genre, event).
    """
    own = used.groupBy("genre").agg(F.count_distinct("event").alias("own"))
    total = closure.join(used.select(F.col("genre").alias("child"), "event"), "child", "left").groupBy(F.col("ancestor").alias("genre")).agg(F.count_distinct("event").alias("total"))
    return total.join(own, "genre", "left").select("genre", F.coalesce("own", F.lit(0)).alias("own"), "total", (F.col("total") > 0).alias("visible"))


def venue_index(events: DataFrame, venues: DataFrame) -> DataFrame:
    """(venue_key, events, cities, city, provisional, conflict): every venue listed or described.

    A venue only listed is provisional; one listed in several cities is a conflict; its city is the described one, else the most listed.
    """
    by_city = events.groupBy("venue_key", "city").agg(F.count("*").alias("n"))
    g = by_city.groupBy("venue_key").agg(F.sum("n").alias("events"), F.count("city").alias("cities"), F.max_by("city", F.struct("n", "city")).alias("_city"))
    j = g.join(venues.select("venue_key", F.col("city").alias("_own"), F.lit(True).alias("_known")), "venue_key", "full")
    return j.select("venue_key", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("cities", F.lit(0)).alias("cities"), F.coalesce("_own", "_city").alias("city"), F.col("_known").isNull().alias("provisional"), (F.coalesce("cities", F.lit(0)) > 1).alias("conflict"))


def release_difference(base: DataFrame, candidate: DataFrame, key: str) -> DataFrame:
    """(kind, n): keys on both sides, only in the base, only in the candidate; each side's keys are unique."""
    b, c = base.select(key, F.lit(True).alias("_b")), candidate.select(key, F.lit(True).alias("_c"))
    kind = F.when(F.col("_c").isNull(), "baseline only").when(F.col("_b").isNull(), "candidate only").otherwise("same")
    return b.join(c, key, "full").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def row_faults(genres: list[str]) -> Column:
    """Array of what forbids a public row: genre not public, markup or address in a name, missing name or venue, bad date."""
    bad = lambda c: F.coalesce(F.col(c).rlike(r"<[^>]*>|https?://"), F.lit(False)) | (F.trim(F.coalesce(F.col(c), F.lit(""))) == "")
    tests = [("genre", F.coalesce(~F.col("genre").isin(*genres), F.lit(False))), ("headliner", bad("headliner")), ("venue", bad("venue")), ("date", F.try_to_date(F.col("day").cast("string")).isNull())]
    return F.array_compact(F.array(*(F.when(c, n) for n, c in tests)))


def gate(rows: DataFrame, previous: int, genres: list[str], least: int = 100, low: float = 0.6, high: float = 2.5, coverage: float = 0.1, collisions: DataFrame | None = None) -> DataFrame:
    """One row of counts and the array `refusals`; empty means that the rows may be published.

    Rows need at least `least`, 60 to 250 % of the previous count (if there was
    one), a genre on ten percent, unique public_ids, no faults, no two rows
    alike in (day, headliner, venue, time), and no bill inside another's:
    collisions(message), as `semantic_collisions` tells them; the least message
    stands in `collision`.
    """
    ids = rows.groupBy("public_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_ids"))
    twins = rows.groupBy("day", "headliner", "venue", "time").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("twins"))
    all_ = rows.agg(F.count("*").alias("n"), F.count_if(F.coalesce("genre", F.lit("")) != "").alias("with_genre"), F.count_if(F.size(row_faults(genres)) > 0).alias("faulty"))
    met = collisions.agg(F.count("*").alias("collisions"), F.min("message").alias("collision")) if collisions is not None else rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("collisions"), F.lit(None).cast("string").alias("collision"))
    one = all_.crossJoin(ids).crossJoin(twins).crossJoin(met)  # four single rows
    n = F.col("n")
    tests = [("too few", n < least), ("count", F.lit(previous > 0) & ~n.between(low * previous, high * previous)), ("genre coverage", F.col("with_genre") < coverage * n), ("repeated ids", F.col("repeated_ids") > 0), ("twins", F.col("twins") > 0), ("collisions", F.col("collisions") > 0), ("faults", F.col("faulty") > 0)]
    return one.withColumn("refusals", F.array_compact(F.array(*(F.when(c, m) for m, c in tests))))


#: Alerts of the release monitor (fixed values): code, least rows compared and least cases for "investigate", least share of the compared rows.
WATCHED = (("genre_loss", 100, 5, 0.01), ("billing_churn", 100, 10, 0.02))
QUEUES = (("flat_bill_review_queue", "flat_bill", 100), ("programme_title_review_queue", "programme_title", 50))


def release_monitor(base: DataFrame, candidate: DataFrame, key: str = "public_id") -> DataFrame:
    """(status, alerts, metrics) of a candidate release against the published one; it advises and refuses nothing.

    Both sides: key, genre, bill (a list), and on the candidate method, flat_bill
    and programme_title (suspicions). alerts: (code, severity, n) in order.
    All rows count, never examples; keys are unique on each side; a genre
    without a method is a provenance defect.
    """
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    b = base.select(key, F.col("genre").alias("_genre"), F.col("bill").alias("_bill"), F.lit(True).alias("_b"))
    j = b.join(candidate.withColumn("_c", F.lit(True)), key, "full")
    both = F.col("_b").isNotNull() & F.col("_c").isNotNull()
    new = F.col("_c").isNotNull()
    counts = {"events": new, "blank": new & ~some("genre"), "compared": both, "new_ids": new & F.col("_b").isNull(), "missing_ids": F.col("_c").isNull(), "genre_provenance": new & some("genre") & ~some("method"), "genre_loss": both & some("_genre") & ~some("genre"), "billing_churn": both & ~F.equal_null("bill", "_bill"), "flat_bill": F.coalesce("flat_bill", F.lit(False)), "programme_title": F.coalesce("programme_title", F.lit(False))}
    m = j.agg(*[F.count_if(test).alias(name) for name, test in counts.items()])
    alert = lambda code, severity, n: F.struct(F.lit(code).alias("code"), severity.alias("severity"), F.col(n).alias("n"))
    raised = [F.when(F.col("genre_provenance") > 0, alert("genre_provenance", F.lit("investigate"), "genre_provenance"))]
    for code, least, cases, share in WATCHED:
        grave = (F.col("compared") >= least) & (F.col(code) >= F.greatest(F.lit(cases), F.floor(F.col("compared") * share)))
        raised.append(F.when(F.col(code) > 0, alert(code, F.when(grave, "investigate").otherwise("review"), code)))
    raised += [F.when(F.col(n) >= least, alert(code, F.lit("review"), n)) for code, n, least in QUEUES]
    raised.append(F.when(F.col("blank") * 2 > F.col("events"), alert("low_genre_coverage", F.lit("investigate"), "blank")))
    m = m.withColumn("alerts", F.array_compact(F.array(*raised)))
    status = F.when(F.exists("alerts", lambda a: a["severity"] == "investigate"), "investigate").when(F.size("alerts") > 0, "review").otherwise("normal")
    return m.select(status.alias("status"), "alerts", F.struct(*counts).alias("metrics"))
