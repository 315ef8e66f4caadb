"""The listing merge: whole blocks against their connected parts, and one row for each engagement."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import listings, snapshots
from tallyfold.operators.programmes import kept_apart

SCHEMA = "row long, day string, venue_key string, title string, time string, source string, official boolean, ticket string, first_seen string, sold_out boolean, programme string, image string, genre string"
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def _table(spark, rows):
    return spark.createDataFrame([tuple({"row": i, "day": "d", "venue_key": "v", **r}.get(n) for n in NAMES) for i, r in enumerate(rows)], SCHEMA)


def _block(seed, n=160):
    rng = random.Random(seed)
    acts = [f"Act {i}" for i in range(25)]
    title = lambda: rng.choice([" + ", " & ", " x ", ", "]).join(rng.sample(acts, rng.choice([1, 1, 2, 3]))) + rng.choice(["", "", "", " tribute", " - Big Tour", " (live)", " early show", " + Guests"])
    return [{"title": rng.choice([title(), title(), None, ""]), "time": rng.choice([None, "19:00", "20h00", ""]), "source": rng.choice("abc"), "official": rng.choice([True, False, None]), "ticket": rng.choice([None, None, f"https://t.org/{rng.randrange(30)}?utm_source=x"])} for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_connected_parts_merge_like_whole_blocks(spark, seed, monkeypatch):
    rows = _block(seed)
    random.Random(seed).shuffle(rows)
    df = _table(spark, rows)
    whole = {r["row"]: r["group"] for r in listings.merge(df).collect()}
    monkeypatch.setattr(listings, "BLOCK_ROWS", 20)
    seen, real = [], listings.groups_of
    assert {r["row"]: r["group"] for r in listings.merge(df).collect()} == whole
    distinct = [{"row": i, **{k: r.get(k) for k in ("title", "time", "source", "official", "ticket")}} for i, r in enumerate(rows)]
    seen += [len(set(whole.values())), len(distinct), len(real([dict(x, official=bool(x["official"])) for x in distinct]))]
    assert seen[0] > 20 and seen[1] == seen[2] == len(rows)


def test_an_act_that_all_bills_share_ties_nothing(spark, monkeypatch):
    rows = [{"title": f"Act {i // 3}" + (" + Band" if i % 2 else ""), "time": [None, "19:00"][i % 2], "source": "abc"[i % 3]} for i in range(120)]
    df = _table(spark, rows)
    roots = {r["root"] for r in listings.components(listings.shared_keys(df)).collect()}
    assert len(roots) == 40
    whole = {r["row"]: r["group"] for r in listings.merge(df).collect()}
    monkeypatch.setattr(listings, "BLOCK_ROWS", 20)
    assert {r["row"]: r["group"] for r in listings.merge(df).collect()} == whole and len(set(whole.values())) == 40
    # without acts a row may meet others by a ticket; then single acts are keys
    odd = _table(spark, [{"title": "!!!", "ticket": "https://t.org/1", "source": "a"}, {"title": "Act 1", "ticket": "https://t.org/1", "source": "b"}, {"title": "Act 1 + Band", "source": "c"}, {"title": "Band + Act 2", "source": "b"}])
    parted = {r["row"]: r["group"] for r in listings.merge(odd).collect()}
    monkeypatch.setattr(listings, "BLOCK_ROWS", 1)
    assert {r["row"]: r["group"] for r in listings.merge(odd).collect()} == parted


def _only(spark, rows, **more):
    return [r.asDict() for r in listings.merged(_table(spark, rows), ["image", "genre", "ticket"], **more).orderBy("group").collect()]


def test_short_card_merges_into_the_full_bill(spark):
    one, = _only(spark, [{"title": "Tramhaus", "source": "Promoter"}, {"title": "Tramhaus & Leroy Se Meurt", "source": "Venue"}])
    assert (one["headliner"], one["co_headliners"], one["rows"]) == ("Tramhaus & Leroy Se Meurt", [], 2)


def test_conjunction_inside_a_name_is_no_bill(spark):
    assert len(_only(spark, [{"title": "The Devil", "source": "Promoter"}, {"title": "The Devil And The Almighty Blues", "source": "Venue"}])) == 2


def test_reordered_bills_merge(spark):
    assert len(_only(spark, [{"title": "In Flames x Trivium", "source": "Venue", "ticket": "https://a/1"}, {"title": "Trivium + In Flames", "source": "Promoter", "ticket": "https://b/2"}])) == 1


def test_complete_name_extends_to_the_richer_bill(spark):
    one, = _only(spark, [{"title": "The Devil And The Almighty Blues", "source": "Backstage"}, {"title": "The Devil And The Almighty Blues + Skyjoggers", "source": "Promoter"}])
    assert (one["headliner"], one["co_headliners"], one["sources"]) == ("The Devil And The Almighty Blues", ["Skyjoggers"], ["Backstage", "Promoter"])


def test_unnamed_guests_yield_to_a_named_bill(spark):
    one, = _only(spark, [{"title": "Bad Situation + Guests", "source": "Venue"}, {"title": "Bad Situation + Loud Ones", "source": "Promoter"}])
    assert "Guests" not in one["headliner"] and one["rows"] == 2


def test_survivor_is_the_richest_with_the_oldest_sighting(spark):
    rows = [{"title": "Artist A x Artist B", "source": "Aggregator", "first_seen": "2026-08-20", "ticket": "https://poor/1"}, {"title": "Artist A & Artist B", "source": "Venue", "official": True, "first_seen": "2026-08-21", "image": "i", "genre": "Rock", "sold_out": True}]
    for order in (rows, rows[::-1]):
        one, = _only(spark, order)
        assert (one["first_seen"], one["image"], one["genre"], one["ticket"], one["sold_out"]) == ("2026-08-20", "i", "Rock", "https://poor/1", True)


def test_equal_identities_merge_in_the_end_but_programmes_stay(spark):
    rows = [{"title": "In Flames x Trivium", "source": "a"}, {"title": "In Flames x Trivium", "source": "a", "ticket": "https://x/1"}, {"title": "In Flames x Trivium", "source": "b", "ticket": "https://x/2"}]
    assert len(_only(spark, rows)) == 1
    apart = [{"title": "Ana", "source": "a", "programme": "One", "time": "19:00"}, {"title": "Ana", "source": "b", "programme": "Two", "time": "21:00"}]
    assert len(_only(spark, apart)) == 2


def test_reviewed_titles_merge_unless_their_times_differ(spark):
    same = spark.createDataFrame([("d", "v", "le grand soir", "ana")], "day string, venue string, key string, same string")
    rows = [{"title": "Ana", "source": "a", "time": "19:00"}, {"title": "Le Grand Soir", "source": "b"}]
    one, = _only(spark, rows, reviewed=same)
    assert one["headliner"] == "Ana" and len(_only(spark, rows)) == 2
    assert len(_only(spark, [rows[0], rows[1] | {"time": "21:00"}], reviewed=same)) == 2


def test_rows_without_a_place_stay_alone_and_near_ones_are_told(spark):
    rows = [{"title": "Ana", "source": "a", "venue_key": None}, {"title": "Ana", "source": "b", "venue_key": None}, {"title": "Ana", "source": "a", "time": "16:00"}, {"title": "Ana", "source": "b", "time": "20:00"}]
    got = listings.merged(_table(spark, rows), ["image"])
    assert got.count() == 4
    told = kept_apart(got.selectExpr("day", "venue_key as venue", "headliner as key", "`group`")).collect()
    assert [(r["key"], r["groups"]) for r in told] == [("Ana", 2)]
    assert listings.merged(_table(spark, []), ["image"]).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_replay_merges_only_parts_that_ask(spark, seed, monkeypatch):
    """Fates equal those of a merge over all rows, but rows that no asking one can meet, or that meet no fresh one, stay out of it."""
    rng, day = random.Random(seed), dt.date(2026, 5, 1)
    rows = [{**r, "title": r["title"] and r["title"].replace("Act", f"Band {i % 40}"), "day": rng.choice([day, day, dt.date(2026, 4, 1), None]), "venue_key": rng.choice(["v", "v", "w", "", None]), "at": rng.choice([dt.datetime(2026, 4, 19), dt.datetime(2026, 4, 1)])} for i, r in enumerate(_block(seed, 400) + _block(seed + 9, 60))]
    rows += [{**r, "row": None} for r in rng.sample(rows, 40)]  # copies
    schema = "row int, day date, venue_key string, title string, time string, source string, official boolean, ticket string, last_success timestamp"
    table = spark.createDataFrame([(i, *[r[c] for c in ("day", "venue_key", "title", "time", "source", "official", "ticket", "at")]) for i, r in enumerate(rows)], schema)
    fresh, held = table.where("row % 3 > 0"), table.where("row % 3 = 0 or row % 7 = 0")
    judged = spark.createDataFrame([("a", "failed"), ("b", "ok"), ("c", "partial")], "source string, status string")
    now, today = F.lit(dt.datetime(2026, 4, 20)), F.lit(dt.date(2026, 4, 20))
    weak = held.where("source in ('a', 'c')")
    name = lambda d, n: d.withColumn("row", F.concat(F.lit(n), F.col("row").cast("string"))).drop("last_success")
    whole = {r["row"]: r["group"] for r in listings.merge(name(fresh, "fresh:").unionByName(name(weak, "held:"))).collect()}
    met = {g for r, g in whole.items() if r.startswith("fresh:")}
    fate = lambda r: "expired" if r["last_success"] < dt.datetime(2026, 4, 13) else "past" if r["day"] and r["day"] < dt.date(2026, 4, 20) else "suppressed" if whole[f"held:{r['row']}"] in met else "restored"
    wanted = {r["row"]: fate(r) for r in weak.collect()}
    given, real = [], listings.merge
    monkeypatch.setattr(listings, "merge", lambda d, **more: given.append({r["row"] for r in d.collect()}) or real(d, **more))
    got = snapshots.replay_equivalent(fresh, held, judged, now, today)
    assert {r["row"]: r["fate"] for r in got.collect()} == wanted and got.count() == len(wanted) and set(wanted.values()) == {"expired", "past", "suppressed", "restored"}
    assert len(given[0]) < len(whole) * 2 / 3
    assert {f"held:{r}" for r, f in wanted.items() if f == "suppressed"} <= given[0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source" not in plan and "hashpartitioning(_same" not in plan
    monkeypatch.setattr(snapshots, "BROADCAST_PARTS", 0)
    assert {r["row"]: r["fate"] for r in snapshots.replay_equivalent(fresh, held, judged, now, today).collect()} == wanted


@pytest.mark.parametrize("seed", [1, 5])
def test_groups_never_cross_parts(spark, seed):
    rows = _block(seed) + [{"title": f"Solo {i % 9}", "source": "abc"[i % 3]} for i in range(40)] + [{"title": "Solo 1", "venue_key": None}]
    df = listings.parted(_table(spark, rows))
    part = {r["row"]: r["part"] for r in df.collect()}
    whole = {r["row"]: r["group"] for r in listings.merge(df).collect()}
    assert all(part[r] == part[g] for r, g in whole.items()) and len(set(part.values())) > 9
    assert {r["row"]: r["group"] for r in listings.merge(df, part="part").collect()} == whole


def test_tasks_of_parts_follow_their_rows(spark, monkeypatch):
    monkeypatch.setattr(listings, "TASK_ROWS", 10)
    got = listings.merge(listings.parted(_table(spark, [{"title": f"Act {i}", "venue_key": str(i % 7)} for i in range(95)])), part="part")
    assert "10), REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 95
