"""Artist index, collisions, genre index, paths and stored search against plain loops."""

import collections
import random
import re

import pyarrow as pa
import pytest

from tallyfold.functions.keys import fold_content
from tallyfold.operators import artists, collisions, genre_index, graph, search_index


def _slug(name):
    return re.sub("[^a-z0-9]+", "-", name.lower()).strip("-")


def test_artist_index_equals_a_sorted_loop(spark):
    rng = random.Random(3)
    words = ["Red", "RED", "red", "Blue Sky", "blue-sky", "Blue  sky", "Été", "été", "Ete", "Zed", "No One", "Alias A", "Alias B", "Alias C", "!!!"]
    labels = [(a, p, rng.choice(words), rng.random() < 0.8, rng.random() < 0.5) for a in range(40) for p in range(3)]
    reviewed, manual, blocked = ["BLUE SKY"], ["Zed Manual", "zed"], ["no one"]
    aliases = [("Alias A", "Alias B"), ("Alias B", "Red"), ("Ring 1", "Ring 2"), ("Ring 2", "Ring 1"), ("Alias C", "Nobody known")]
    more, excluded = [(0, "BLUE SKY"), (1, "Red")], [(2, "red"), (3, "ÉTÉ")]
    # the loop
    counts, first = collections.Counter(x[2] for x in labels), {}
    for a, p, label, _, _ in labels:
        first.setdefault(label, (a, p))
    names = {}
    for label in sorted(counts, key=lambda x: (-counts[x], first[x], x)):
        if fold_content(label) not in blocked:
            names.setdefault(fold_content(label), label)
    names |= {fold_content(r): r for r in reviewed}
    for m in sorted(manual):
        names.setdefault(fold_content(m), m)
    for alias in ("Alias B", "Alias A"):
        names[fold_content(alias)] = names["red"]
    links = {}
    for a, p, label, primary, direct in labels:
        name = names.get(fold_content(label))
        if primary and name and (a, fold_content(name)) not in {(x, fold_content(n)) for x, n in excluded}:
            old = links.get((a, name), (p, False))
            links[a, name] = (min(old[0], p), old[1] or direct)
    for a, n in more:
        links[a, n] = (links.get((a, n), (1 << 30, 0))[0], True)
    owners, lost = {}, set()
    for name in sorted({n for _, n in links}, key=lambda n: (fold_content(n), n)):
        if _slug(name.replace("É", "e").replace("é", "e")):
            owner = owners.setdefault(_slug(name.replace("É", "e").replace("é", "e")), name)
            if owner != name:
                lost.add((_slug(name.replace("É", "e").replace("é", "e")), owner, name))
    # the operator
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    one = lambda xs: make([(x,) for x in xs], "name string")
    table, al = make(labels, "article long, place int, label string, primary boolean, direct boolean"), make(aliases, "alias string, name string")
    got = artists.identities(table, one(reviewed), [one(manual)], al, one(blocked))
    assert {r["key"]: r["name"] for r in got.collect()} == names
    linked = artists.article_links(table, got, make(more, "article long, name string"), make(excluded, "article long, name string"))
    assert {(r["article"], r["name"]): (r["place"], r["direct"]) for r in linked.collect()} == links
    articles = make([(a, f"2026-01-{1 + a % 9:02d}", "concert_review" if a % 2 else "news", f"u{a}", f"i{a}" if a % 3 else None) for a in range(40)], "article long, day string, type string, url string, image string")
    records, rows, collided = artists.artist_index(linked, articles, table, got, al)
    assert {tuple(r) for r in collided.collect()} == lost and lost
    records = {r["slug"]: r for r in records.collect()}
    assert {s: r["name"] for s, r in records.items()} == owners
    for slug, name in owners.items():
        mine = {a: d for (a, n), (_, d) in links.items() if n == name}
        assert (records[slug]["articles"], records[slug]["direct"]) == (len(mine), sum(mine.values()))
        heroes = [(f"2026-01-{1 + a % 9:02d}", -a) for a in mine if a % 2 and a % 3]
        assert (records[slug]["hero"]["url"] if heroes else records[slug]["hero"]) == (f"u{-max(heroes)[1]}" if heroes else None)
        spelled = {label for _, _, label, primary, _ in labels if primary and names.get(fold_content(label)) == name and label != name} | {x for x, t in aliases if names.get(fold_content(t)) == name and x != name}
        assert records[slug]["aliases"] == sorted(spelled, key=lambda x: (fold_content(x), x))
    assert rows.count() == sum(n in owners.values() for _, n in links)
    assert {r["key"] for r in artists.lookup(artists.artist_index(linked, articles, table, got, al)[0]).collect()} >= {fold_content(n) for n in owners.values()}


def test_collisions_equal_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["d1", "d2", None]), rng.choice(["v", "w"]), rng.sample("abcdef", rng.choice([0, 1, 1, 2, 3])) + rng.choice([[], ["", None]]), rng.choice([None, "19:00", "19h", "20:00", ""]), rng.sample("xyz", rng.choice([0, 1, 1, 2])), rng.choice([None, None, "m"])) for i in range(90)]
    rows += [(100 + i, "d1", "v", ["a"], "19:00", ["x"], None) for i in range(5)]
    plain = lambda xs: tuple(sorted({x for x in xs if x}))
    clock = lambda t: {"19h": "19:00", "": None}.get(t, t)
    once = {}
    for i, d, p, n, t, s, m in rows:
        if plain(n) and d:
            once.setdefault((d, p, plain(n), clock(t), plain(s), m), i)
    want = set()
    for (d, p, n, t, s, m), i in once.items():
        for (e, q, o, u, z, k), j in once.items():
            inside = set(n) < set(o) or (n == o and i > j)
            if (d, p, m) == (e, q, k) and inside and not set(s) & set(z) and (not t or not u or t == u):
                want.add((i, j))
    got = collisions.semantic_collisions(spark.createDataFrame(rows, "row int, day string, place string, names array<string>, time string, sources array<string>, marker string")).collect()
    assert {(r["row"], r["other"]) for r in got} == want and len(got) == len(want) and want
    one = spark.createDataFrame([(1, "2027-03-24", "Le Grand Rex", ["angelique kidjo", "youssou ndour"], "20:00", ["Le Grand Rex"], None), (2, "2027-03-24", "Le Grand Rex", ["youssou ndour"], None, ["Alias Production"], None)], "row int, day string, place string, names array<string>, time string, sources array<string>, marker string")
    assert [r["message"] for r in collisions.semantic_collisions(one).collect()] == ["2027-03-24 Le Grand Rex: youssou ndour (Alias Production) lies in angelique kidjo + youssou ndour (Le Grand Rex)"]


def test_collisions_read_their_rows_once_and_find_large_bills(spark):
    rng, read = random.Random(6), spark.sparkContext.accumulator(0)
    bills = [rng.sample("abcdefghijklmnopqrstuvw", n) for n in [1, 2, 3, 4, 16, 17, 18, 23] * 6]
    rows = [(i, "d", "v", n, None, [f"s{i}"], None) for i, n in enumerate(bills)]

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "row int, day string, place string, names array<string>, time string, sources array<string>, marker string")
    got = collisions.semantic_collisions(df.mapInArrow(count, df.schema)).collect()
    want = {(i, j) for i, n in enumerate(bills) for j, m in enumerate(bills) if set(n) < set(m) or (set(n) == set(m) and i > j)}
    assert {(r["row"], r["other"]) for r in got} == want and len(got) == len(want)
    assert read.value == len(rows)


def _shuffled(spark):
    """Bytes of the session's shuffles so far."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    return sc.statusStore().executorSummary("driver").totalShuffleWrite()


def test_collisions_shuffle_their_rows_and_not_their_pairs(spark):
    rng, sent, told = random.Random(7), [], []
    bills = sorted({tuple(sorted(rng.sample("abcdefghijklmnop", rng.choice([1, 2, 3, 7, 8, 9, 10])))) for _ in range(4000)})
    rng.shuffle(bills)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (500, 2000):
            df = spark.createDataFrame([(i, "d", "v", list(b), None, [f"s{i}"], None) for i, b in enumerate(bills[:n])], "row int, day string, place string, names array<string>, time string, sources array<string>, marker string")
            before = _shuffled(spark)
            told.append(len(collisions.semantic_collisions(df).collect()))
            sent.append(_shuffled(spark) - before)
            assert told[-1] == sum(set(a) < set(b) for a in bills[:n] for b in bills[:n])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert told[1] > 10 * told[0] and sent[1] < 5 * sent[0] and sent[1] < 200 * 2000, (told, sent)


@pytest.mark.parametrize(("cell", "batch"), [(1, 10_000), (40, 7), (40, 10_000), (100_000, 5)])
def test_collisions_of_large_blocks_equal_all_pairs(spark, monkeypatch, cell, batch):
    rng = random.Random(cell)
    rows = [(f"r{i:03d}", rng.choice([1, 1, 2]), rng.choice(["v", "v", "w"]), rng.sample(["ab", "a", "b", "", None, "é", "x y", "c", "d"], rng.choice([1, 2, 3, 4, 6])), rng.choice([None, "19:00", "20:00"]), rng.sample("xyz", rng.choice([0, 1, 1, 2])), rng.choice([None, None, "", "m"])) for i in range(400)]
    rows += [(f"s{i:03d}", 3, f"p{i // 2}", ["a", "b"][: 1 + i % 2], None, [f"{i}"], None) for i in range(60)]
    once, want = {}, set()
    for i, d, p, n, t, s, m in rows:
        if kept := frozenset(x for x in n if x):
            once.setdefault((d, p, kept, t, frozenset(s), m), i)
    for (d, p, n, t, s, m), i in once.items():
        for (e, q, o, u, z, k), j in once.items():
            if (d, p, m) == (e, q, k) and (n < o or (n == o and i > j)) and not s & z and (not t or not u or t == u):
                want.add((i, j, f"{d} {p}: {' + '.join(sorted(n))} ({', '.join(sorted(s))}) lies in {' + '.join(sorted(o))} ({', '.join(sorted(z))})"))
    monkeypatch.setattr(collisions, "CELL_NAMES", cell)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = collisions.semantic_collisions(spark.createDataFrame(rows, "row string, day int, place string, names array<string>, time string, sources array<string>, marker string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r["row"], r["other"], r["message"]) for r in got} == want and len(got) == len(want) and {(r["day"], r["place"]) for r in got} >= {(1, "v"), (3, "p7")}


def test_collisions_of_a_cell_come_in_batches_of_bounded_size(monkeypatch):
    """Some cells at once, one that many ask, and pairs in more batches than one."""
    kinds = pa.schema([("cell", pa.string()), ("role", pa.int32()), ("row", pa.int64()), ("day", pa.string()), ("place", pa.string()), ("names", pa.list_(pa.string())), ("time", pa.string()), ("sources", pa.list_(pa.string())), ("text", pa.string()), ("says", pa.string())])
    row = lambda cell, role, i, names: (cell, role, i, "d", "v", list(names), None, [str(i)], names, "in ")
    rows = [row("c1", 1, 1, "a"), row("c1", 1, 2, "ab"), row("c2", 1, 3, "ab"), *[row("c3", 0, 10 + i, "abc") for i in range(6)], *[row("c3", 2, 100 + i, "abcx"[i % 4]) for i in range(40)], row("c4", 1, 4, "a"), row("c4", 1, 5, "xa")]
    batches = [pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in rows[k : k + 4]], kinds) for k in range(0, len(rows), 4)]
    want = {(1, 2), (4, 5)} | {(100 + i, 10 + j) for i in range(40) if i % 4 < 3 for j in range(6)}
    for cell, most in ((1000, 1 << 20), (10, 20)):
        monkeypatch.setattr(collisions, "CELL_NAMES", cell)
        monkeypatch.setattr(collisions, "TOLD_BYTES", most)
        out = list(collisions._met(iter(batches)))
        pairs = [(r["row"], r["other"]) for b in out for r in b.to_pylist() if not r["same"]]
        assert set(pairs) == want and len(pairs) == len(want)
    assert max(b.num_rows for b in out) <= 4


def test_genre_index_by_hand(spark):
    make = spark.createDataFrame
    taxonomy = make([("all", None), ("rock", "all"), ("punk", "rock"), ("jazz", "all"), ("bop", "jazz")], "genre string, parent string")
    layers = [("reviewed", make([("a", "punk"), ("b", "rock"), ("x", "unknown")], "artist string, genre string")), ("articles", make([("a", "punk"), ("c", "bop"), ("a", "jazz")], "artist string, genre string"))]
    g = genre_index.artist_genres(layers, make([("b", "punk"), ("a", "punk"), ("d", "bop")], "artist string, genre string"), make([("a", "jazz")], "artist string, genre string"))
    assert {(r["artist"], r["genre"]): (r["direct"], r["sources"]) for r in g.collect()}["a", "punk"] == (True, ["articles", "inherited", "reviewed"])
    got = genre_index.genre_index(taxonomy, g, make([("a", 1), ("b", 1), ("b", 2), ("c", 3)], "artist string, article int"), make([("a",)], "artist string"))
    assert {r["genre"]: tuple(r)[2:] for r in got.collect()} == {"all": (0, 0, 4, 3, True), "rock": (1, 0, 2, 2, True), "punk": (1, 1, 2, 2, True), "jazz": (0, 0, 2, 1, False), "bop": (1, 1, 2, 1, False)}


def test_paths_end_at_the_first_covered_node(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("b", "a"), ("c", "x"), ("x", "e")], "u string, v string")
    node = lambda *xs: spark.createDataFrame([(x,) for x in xs], "node string")
    got = graph.covered_paths(node("a", "x"), edges, node("x", "e"), 4)
    assert {tuple(map(str, r)) for r in got.collect()} == {("a", "x", "2", "['a', 'c', 'x']"), ("a", "e", "3", "['a', 'b', 'd', 'e']")}
    only = graph.covered_paths(node("a"), edges, node("x", "e"), 4, spark.createDataFrame([("a", "e")], "source string, target string"))
    assert {(r["target"], r["depth"]) for r in only.collect()} == {("e", 3)}
    names = spark.createDataFrame([("a", "Ana"), ("x", "Xen")], "node string, name string")
    assert {r["target"]: r["names"] for r in graph.named_paths(got, names).collect()} == {"x": ["Ana", "Xen"], "e": ["Ana"]}
    assert graph.first_covered(node("a"), edges, node("x"), 0).count() == 0
    plan = graph.closure(edges.select(edges.v.alias("child"), edges.u.alias("parent")).where("child not in ('a')"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # every level is read where it was written


def test_repeated_edges_give_the_least_path_without_being_dealt_twice(spark, monkeypatch):
    rng, plans, real = random.Random(4), [], graph.cut
    edges = [(rng.choice("abcdefg"), rng.choice("abcdefgxyz")) for _ in range(60)] * 2
    monkeypatch.setattr(graph, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    node = lambda xs: spark.createDataFrame([(x,) for x in xs], "node string")
    got = graph.covered_paths(node("abcb"), spark.createDataFrame(edges, "u string, v string"), node("xyzd"), 3)
    want = set()
    for source in "abc":
        seen, front = {source}, {source: [source]}
        for depth in (1, 2, 3):
            ways = {}
            for u, v in edges:
                if u in front and v not in seen:
                    ways[v] = min(ways.get(v, ["~"]), [*front[u], v])
            seen |= set(ways)
            want |= {(source, v, depth, tuple(w)) for v, w in ways.items() if v in "xyzd"}
            front = {v: w for v, w in ways.items() if v not in "xyzd"}
    rows = got.collect()
    assert {(r["source"], r["target"], r["depth"], tuple(r["path"])) for r in rows} == want and len(rows) == len(want)
    assert all(plan.count("Aggregate [") == 2 for plan in plans[1:])  # covered nodes, and the least ways


@pytest.mark.parametrize("files", [None, 3])
def test_stored_search_equals_the_plain_ladder(spark, tmp_path, files):
    rng = random.Random(9)
    words = ["red", "redder", "re", "blue", "sky", "a", "été", "skyblue"]
    terms = [(rng.choice(["artists", "venues", "concerts"]), i, f"n{i % 7}", " ".join(rng.sample(words, rng.choice([1, 2, 3]))), rng.random() < 0.3, rng.choice([0, 0, 1, 2])) for i in range(60)] + [("venues", 99, "n", "", False, 0), ("venues", 98, "n", None, None, None)]
    queries = ["red", "re", "r", "sky blue", "blue", "ed", "dde", "a", "kyb", "nothing", "", None, "été", "red sky a"]
    bills = [(1, 500, "c500", 1), (2, 500, "c500", 0), (3, 501, "c501", 4)] + [(i, 502, "c502", 0) for i in range(60)]

    def ladder(t, q, alias):
        if t == q:
            return 10 if alias else 0
        if t.startswith(q):
            return 30 if alias else 20
        if all(w in t.split(" ") for w in q.split(" ") if w):
            return 40
        return 50 if len(q) >= 3 and q in t else None

    want = []
    for q in {x for x in queries if x}:
        best = {}
        for g, i, n, t, al, role in terms:
            if t and (s := ladder(t, q, al)) is not None:
                best[g, i] = min(best.get((g, i), (n, 999)), (n, s + role), key=lambda x: x[1])
                if g == "artists":
                    for a, c, name, r in bills:
                        if a == i:
                            old = best.get(("concerts", c), (name, 999))
                            best["concerts", c] = (min(old[0], name), min(old[1], s + role + r))
        for g in ("artists", "venues", "concerts"):
            found = sorted((s, n, i) for (x, i), (n, s) in best.items() if x == g)[:8]
            want += [(q, g, i, n, s, k + 1) for k, (s, n, i) in enumerate(found)]
    path = str(tmp_path / "index")
    search_index.write_index(spark.createDataFrame(terms, "group string, id long, name string, term string, alias boolean, role int"), path, files)
    got = search_index.search_many(spark, path, spark.createDataFrame([(q,) for q in queries], "query string"), 8, spark.createDataFrame(bills, "artist long, id long, name string, role int"))
    assert sorted(map(tuple, got.select("query", "group", "id", "name", "score", "rank").collect())) == sorted(want)


@pytest.mark.parametrize("several", [False, True])
def test_terms_that_many_entries_share_have_postings_once(spark, tmp_path, several):
    rng = random.Random(11)
    called = lambda i: f"n{i % 9}" + (rng.choice("ab") if several and i % 3 else "")
    terms = [(g, i := rng.randrange(120), called(i), rng.choice(["red", "red sky", "sky", "redder"]), rng.random() < 0.3, rng.choice([0, 1, 4])) for g in ("artists", "concerts") for _ in range(400)]
    bills = [(rng.randrange(120), i := rng.randrange(120), called(i), rng.choice([0, 1, 2])) for _ in range(400)]
    path = str(tmp_path / "index")
    search_index.write_index(spark.createDataFrame(terms, "group string, id long, name string, term string, alias boolean, role int"), path)
    assert spark.read.parquet(f"{path}/postings").count() < 40
    best = {}
    for q in ("red", "sky"):
        for g, i, n, t, al, role in terms:
            s = (10 if al else 0) if t == q else (30 if al else 20) if t.startswith(q) else 40 if q in t.split() else None
            for x, c, name, r in [(g, i, n, role), *(("concerts", c, name, role + r) for a, c, name, r in bills if g == "artists" and a == i)] if s is not None else []:
                old = best.get((q, x, c), (name, 999))
                best[q, x, c] = (min(old[0], name), min(old[1], s + r))
    want = [(q, g, i, n, s, k + 1) for q in ("red", "sky") for g in ("artists", "concerts") for k, (s, n, i) in enumerate(sorted((s, n, i) for (p, x, i), (n, s) in best.items() if (p, x) == (q, g))[:5])]
    got = search_index.search_many(spark, path, spark.createDataFrame([("red",), ("sky",)], "query string"), 5, spark.createDataFrame(bills, "artist long, id long, name string, role int"))
    assert sorted(map(tuple, got.select("query", "group", "id", "name", "score", "rank").collect())) == sorted(want)


def test_each_wording_is_folded_once(spark, monkeypatch):
    folded, real = [], artists._keyed
    monkeypatch.setattr(artists, "_keyed", lambda d, *a: folded.append(d) or real(d, *a))
    labels = spark.createDataFrame([(i, i % 4, ["Red", "RED", "Blue", None][i % 4], True, i % 8 == 0) for i in range(200)] + [(0, 3, "Blue", True, True)], "article long, place int, label string, primary boolean, direct boolean")
    names = spark.createDataFrame([("red", "Red"), ("blue", "Blue")], "key string, name string")
    got = artists.article_links(labels, names, spark.createDataFrame([(9, "Red")], "article long, name string"), spark.createDataFrame([(4, "RED"), (9, "Red")], "article long, name string"))
    want = {(i, "Blue" if i % 4 == 2 else "Red", i % 4, i % 8 == 0) for i in range(200) if i % 4 < 3 and i not in (4, 9)} | {(0, "Blue", 3, True), (9, "Red", 1 << 30, True)}
    assert {tuple(r) for r in got.collect()} == want
    assert max(d.count() for d in folded) <= 4  # three wordings and null
