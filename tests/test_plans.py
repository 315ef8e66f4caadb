"""Every registered listing query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from tallyfold import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def rows(frame):
    columns = sorted(frame.columns)
    norm = lambda v: None if v is None or str(v) in ("nan", "<NA>", "NaT") else str((int(v) if v.is_integer() else round(v, 6)) if isinstance(v, float) else v)
    return sorted([tuple(map(norm, r)) for r in frame[columns].astype(object).itertuples(index=False, name=None)], key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_equals_sql(spark, duck, name):
    ours = plans.queries()[name](spark, SF).toPandas()
    theirs = duck.sql(plans.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_runs(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0


@pytest.mark.parametrize("first", [0, 1, 3])
@pytest.mark.parametrize("most", [5_000_000, 0, 60])
def test_greedy_equals_sorted_loop(spark, most, first, monkeypatch):
    from tallyfold.operators import joins

    monkeypatch.setattr(joins, "MOST_EDGES", most)
    monkeypatch.setattr(joins, "FIRST_ROUNDS", first)
    edges = [(a, b, float((a * 7 + b * 13) % 11)) for a in range(12) for b in range(9) if (a + b) % 3] + [(a, b, 1.0) for a in range(20, 26) for b in range(20, 24)]
    rows_ = spark.createDataFrame([*edges, edges[0], (None, 1, 99.0), (1, None, 99.0)], "l int, r int, s double")
    got = {tuple(r) for r in joins.greedy_match(rows_, "l", "r", "s").collect()}
    assert joins.greedy_match(rows_.where("false"), "l", "r", "s").count() == 0
    left, right, want = set(), set(), set()
    for a, b, s in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if a not in left and b not in right:
            left.add(a)
            right.add(b)
            want.add((a, b, s))
    assert got == want


def test_closure_refuses_cycles(spark):
    from tallyfold.operators.graph import closure

    with pytest.raises(ValueError):
        closure(spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string"))


def test_untimed_row_is_no_bridge(spark):
    from tallyfold.operators.resolution import merge_blocks

    rows_ = [(1, "d", "19:00"), (2, "d", None), (3, "d", "21:00"), (4, "e", "19:00"), (5, "e", None)]
    got = {tuple(r) for r in merge_blocks(spark.createDataFrame(rows_, "id int, b string, t string"), ["b"], "id", "t").collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4)}


def test_search_expansion_bfs_by_brute_force(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()]
    orders, customers, suppliers = read("orders", "o_custkey", "o_orderkey", "o_orderpriority"), read("customer", "c_custkey", "c_mktsegment"), read("supplier", "s_suppkey", "s_acctbal")
    covered = {f"c{k}" for k, m in customers if m == "BUILDING"} | {f"o{k}" for _, k, p in orders if p == "1-URGENT"} | {f"s{k}" for k, b in suppliers if b > 0}
    out = {}
    for u, v in [(f"c{a}", f"o{b}") for a, b, _ in orders] + [(f"o{a}", f"s{b}") for a, b in read("lineitem", "l_orderkey", "l_suppkey")]:
        out.setdefault(u, set()).add(v)
    want = set()
    for source in {f"c{a}" for a, _, _ in orders} - covered:
        seen, front = {source}, {source}
        for depth in (1, 2):
            front = {v for u in front for v in out.get(u, ())} - seen
            seen |= front
            want |= {(source, v, depth) for v in front & covered}
            front -= covered
    got = [tuple(r) for r in plans.queries()["search_expansion_bfs"](spark, SF).select("source", "target", "depth").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {k for s, t, _ in want for k in (s, t)} - {f"{c}{n}" for c in "cos" for n in range(1000)}
