"""The corpus operators against brute force, on small tables with every odd case."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfold.llm.common import mix, prefix_hash, span_hash
from tallyfold.llm import ann, decontam, license_scan, line_dedup, minhash, packing, pii, sharding, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, spans string, node string, grade string, shard string"
LONG = " ".join(f"word{i % 977}" for i in range(6000))
BASE = " ".join(f"tok{i}" for i in range(120))
NEAR = BASE.replace("tok60 ", "other ")
PASSAGE = "the quick brown fox jumps over the lazy dog while nine more words follow here today and " * 3


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 12}" if (i or 0) % 7 else None, None, "k", "x", "y", "z", "w") for i, t in texts], SCHEMA)


ROWS = [(1, BASE), (2, NEAR), (3, BASE), (4, None), (5, ""), (6, "one two"), (7, "one two"), (8, LONG), (9, LONG + " tail"), (10, "A\x00\tb\nc"), (None, BASE), (11, PASSAGE), (12, "x " + PASSAGE), (13, "é" * 300), (14, "same\nline\n\nsame"), (3, BASE), (15, " \n "), (16, "aaaa" * 200)] + [(20 + i, f"shared line\nown {i}\nrare {i // 3}") for i in range(12)]


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sets_of(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize(("block", "shingles"), [(3000, 3_000_000), (2, 3_000_000), (3000, 150)])
def test_minhash(spark, docs, empty, block, shingles, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    got = minhash.near_duplicates(docs, shingle=4).collect()
    s = {i: sets_of(t, 4) for i, t in ROWS if i is not None}
    root = {i: i for i in s}
    for _ in s:
        for a in s:
            for b in s:
                c = len(s[a] & s[b])
                if c and 100 * c >= 80 * len(s[a] | s[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert len(got) == len(ROWS)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(s[r["doc_id"]]), root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
    assert minhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("block", "shingles"), [(3000, 3_000_000), (3, 3_000_000), (3000, 40)])
def test_minhash_links_at_the_very_threshold(spark, block, shingles, monkeypatch):
    """Sets of 80 and 100 shingles of which 80 are shared link; 79 of 99 or 80 of 101 do not; chains of links make one group."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    run = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    texts = {}
    for k in range(12):  # n words give n - 3 shingles of four
        texts[10 * k] = run(f"a{k}x", 103)
        texts[10 * k + 1] = run(f"a{k}x", 83)  # 80 of 100
        texts[10 * k + 2] = run(f"b{k}x", 104)
        texts[10 * k + 3] = run(f"b{k}x", 83)  # 80 of 101
        texts[10 * k + 4] = run(f"a{k}x", 67)  # 64 of 80 with the second, 64 of 100 with the first
    s = {i: sets_of(t, 4) for i, t in texts.items()}
    for i, r in ((r["doc_id"], r) for r in minhash.near_duplicates(_docs(spark, list(texts.items())), shingle=4).collect()):
        assert r["component_id"] == {0: i, 1: i - 1, 4: i - 4}.get(i % 10, i) and r["n_shingles"] == len(s[i])


@pytest.mark.parametrize("giant", [10_000, 1])
def test_suffix_dedup(docs, empty, giant, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GIANT", giant)
    monkeypatch.setattr(suffix_dedup, "MOST_HOT", 1000 if giant > 1 else 5)
    got = collections.Counter(tuple(r) for r in suffix_dedup.repeated_spans(docs).collect())
    raw = [(i, (t or "").encode()) for i, t in ROWS]
    seen = collections.Counter(t[k : k + 200] for _, t in raw for k in range(len(t) - 199))
    want = collections.Counter()
    for i, t in raw:
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want[(i, len(t), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())] += 1
    assert got == want
    assert suffix_dedup.repeated_spans(empty).count() == 0


@pytest.mark.parametrize(("inline", "broadcast"), [(50_000, 200_000), (0, 200_000), (0, 0)])
def test_line_dedup(docs, empty, inline, broadcast, monkeypatch):
    monkeypatch.setattr(line_dedup, "INLINE_KEYS", inline)
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", broadcast)
    docs = docs.withColumns({c: F.lit("x") for c in ("id", "_bad", "key", "line", "site", "__row0", "__kept0", "row", "n_lines")})
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.remove_boilerplate(docs, min_sites=8).collect()), key=str)
    sites = collections.defaultdict(set)
    for r in docs.collect():
        for x in (r["text"] or "").split("\n"):
            if x.strip(" ") and r["source"]:
                sites[x.strip(" ")].add(r["source"])
    bad = {x for x, s in sites.items() if len(s) >= 8}
    assert bad == {"shared line"}
    want = []
    for i, t in ROWS:
        parts = [] if t is None else t.split("\n")
        kept = [x for x in parts if x.strip(" ") not in bad]
        want.append((i, None if t is None else "\n".join(kept), len(parts), len(parts) - len(kept)))
    assert got == sorted(want, key=str)
    assert line_dedup.remove_boilerplate(docs).columns == [*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_removed"]
    assert line_dedup.remove_boilerplate(empty).count() == 0


def test_line_dedup_counts_sites_exactly_near_the_threshold(spark):
    """Lines on 1 to 30 sites, repeated within each: the sketch decides far from the threshold, exact counts near it."""
    rows = [(s * 100 + k, f"line {k}\n line {k} \nown {s} {k}", f"site{s}") for k in range(1, 31) for s in range(k) for _ in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for least in (2, 8, 20):
        for r in line_dedup.remove_boilerplate(docs, min_sites=least).collect():
            k = r["doc_id"] % 100
            assert r["n_lines"] == 3 and r["n_removed"] == (2 if k >= least else 0)
            assert r["text"] == (f"own {r['doc_id'] // 100} {k}" if k >= least else f"line {k}\n line {k} \nown {r['doc_id'] // 100} {k}")


@pytest.mark.parametrize("block", [8_000_000, 40])
def test_decontamination(spark, docs, empty, block, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    items = [("b", "brown fox jumps over the lazy dog while nine more words follow"), ("a", "ONE two"), ("c", None), ("d", "..."), ("e", "tok5 tok6 tok7 tok8 tok9 tok10 tok11 tok12 tok13 tok14"), (None, "same")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = sorted(map(tuple, decontam.contamination(docs, bench).collect()), key=str)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for i, t in ROWS:
        w, hit, own = words(t), set(), set()
        for name, text in items:
            q = words(text)
            for k in range(max(1, len(q) - 9) if q and name else 0):
                for j in range(len(w)):
                    if w[j : j + len(q[k : k + 10])] == q[k : k + 10]:
                        own.add(name)
                        hit |= set(range(j, j + len(q[k : k + 10])))
        want.append((i, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want, key=str)
    cleaned = decontam.decontaminate(docs, bench)
    assert cleaned.columns == docs.columns and cleaned.count() == len(ROWS)
    assert not any("fox jumps" in (r["text"] or "") for r in cleaned.collect())
    assert decontam.contamination(empty, bench).count() == 0


def test_decontamination_of_many_blocks_cuts_the_given_text(spark, monkeypatch):
    w = [f"w{i}" for i in range(40)]
    items = [("a", " ".join(w[5:15])), ("b", " ".join(w[10:20])), ("c", " ".join([*w[0:5], *w[20:25]]))]
    texts = [(1, " ".join(w)), (1, " ".join(w)), (None, "x " + " ".join(w[8:22]) + " y"), (2, None), (3, ""), (4, "none of it"), (5, " ".join([*w[:5], *w[20:]]))]
    docs, outs = _docs(spark, texts), []
    for order in (items, items[::-1]):
        bench = spark.createDataFrame(order, "item_id string, text string").coalesce(1)
        for block in (8_000_000, 60, 1):
            monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
            cleaned = decontam.decontaminate(docs, bench)
            assert cleaned.schema == docs.schema
            outs.append(sorted(map(tuple, cleaned.collect()), key=str))
    want = [(1, " ".join(w[:5]) + " \n " + " ".join(w[20:]))] * 2 + [(None, "x w8 w9 \n w20 w21 y"), (2, None), (3, ""), (4, "none of it"), (5, "\n " + " ".join(w[25:]))]
    assert sorted((r[:2] for r in outs[0]), key=str) == sorted(want, key=str)
    assert all(o == outs[0] for o in outs)


@pytest.mark.parametrize("ranked", [100_000, 2])
def test_packing(spark, empty, ranked, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "RANK_ROWS", ranked)
    texts = [*ROWS, (50, "Кино и 中文 <|endoftext|> हिन्दी 🙂 e\u0301 \u024f\u0250"), (51, "\u0301\ufffd\u200d"), (52, "x" * 5000)]
    t = Tokenizer.from_file(packing.vocabulary_path())
    rows = packing.pack_documents(_docs(spark, texts)).collect()
    want = collections.Counter()
    for i, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        at, n = 0, (len(ids) - 1) % 1024 + 1
        piece = 0
        while at < len(ids):
            want[(i, piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()))] += 1
            at, n, piece = at + n, 1024, piece + 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(empty).count() == 0


def test_packing_finds_added_tokens(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    texts = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "x<|ENDOFTEXT|>y", "<|endoftext", "\u4e2d <|endoftext|>"]))
    assert t.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pack_documents(_docs(spark, texts)).collect()}
    for i, text in texts:
        ids = [*t.encode(text, add_special_tokens=False).ids, packing.END_OF_TEXT]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


@pytest.mark.parametrize("seed", range(4))
def test_packing_histogram_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(k) for n, k in zip(rng.permutation(1024)[:300] + 1, rng.integers(1, 9, 300))}
    bins = packing.pack_histogram(counts, 1024)
    used = collections.Counter()
    for lengths, times in bins:
        assert sum(lengths) <= 1024
        for n in lengths:
            used[n] += times
    assert used == counts
    # no more bins than best fit, largest first
    gaps = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fit = min((g for g in gaps if g >= n), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((1024 if fit is None else fit) - n)
    assert sum(t for _, t in bins) <= len(gaps)


@pytest.mark.parametrize("chunk", [20_000, 37])
def test_ann(spark, chunk, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 16)).astype(np.float32)
    x[400:600] = x[400]
    rows = [(i, [float(c) for c in v], "n") for i, v in enumerate(x)] + [(900, None, "n"), (901, [0.0] * 16, "n"), (902, [float("nan")] * 16, "n"), (903, [1.0], "n"), (None, [1.0] * 16, "n"), (0, [float(c) for c in x[0]], "n")]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string"), "vec_id % 20 = 0").collect()
    found = collections.defaultdict(dict)
    for r in got:
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    d, hits, total = x.astype(np.float64), 0, 0
    assert set(found) == set(range(0, 800, 20))
    for q, ranks in found.items():
        s = (d * d[q]).sum(1)
        assert sorted(ranks) == list(range(1, 21))
        for k in range(1, len(ranks) + 1):
            v, score = ranks[k]
            assert v != q and abs(score - s[v]) < 1e-9
            if k > 1:
                assert (-ranks[k - 1][1], ranks[k - 1][0]) < (-score, v)
        best = [i for i in np.lexsort((np.arange(800), -s)) if i != q][:20]
        hits += len({v for v, _ in ranks.values()} & set(best))
        total += 20
        if 400 <= q < 600:  # 200 equal vectors: the ties go to the smallest ids, across chunks as well
            assert [ranks[k][0] for k in range(1, 21)] == best
    assert hits / total >= 0.9
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(none, "vec_id % 20 = 0").count() == 0
    assert [tuple(r)[:3] for r in ann.nearest(spark.createDataFrame([(20, [1.0]), (1, [2.0]), (2, [3.0])], "vec_id long, embedding array<double>"), "vec_id % 20 = 0").orderBy("rank").collect()] == [(20, 1, 2), (20, 2, 1)]


@pytest.mark.parametrize(("clustered", "most"), [(False, 64), (True, 64), (False, 8), (True, 8)])
def test_ann_answers_from_learned_partitions(spark, clustered, most, monkeypatch):
    """More rows than the sample holds, one level of routing and two: recall against brute force, and the share of rows searched."""
    for name, value in (("SAMPLE", 1500), ("ROWS", 150), ("MOST", most), ("INNER_SAMPLE", 600)):
        monkeypatch.setattr(ann, name, value)
    rng, n = np.random.default_rng(4), 6000
    x = rng.normal(size=(n, 16))
    if clustered:
        x = rng.normal(size=(60, 16))[rng.integers(0, 60, n)] + 0.3 * x
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    table = pa.table({"vec_id": pa.array(np.arange(n)), "embedding": pa.array(list(x), pa.list_(pa.float32()))})
    vectors = spark.createDataFrame(table)
    base = ann.materialize(ann.usable(vectors, "vec_id % 20 = 0", "vec_id", "embedding"))
    index, size = ann.train(base, n)
    assert (index.inner is not None) == (most == 8) and index.parts >= 32
    rows = ann.materialize(ann.routed(base, index, size))
    part, asks = rows.select("id", "part").toPandas().set_index("id").sort_index()["part"].to_numpy(), [i for i in range(n) if i % 20 == 0]
    probes = ann.asked(rows, index, size, 20).select("id", "probes").toPandas().set_index("id")["probes"]
    scanned = np.mean([np.isin(part, probes[i]).mean() for i in asks])
    assert scanned < (0.25 if clustered else 0.85)
    got = ann.nearest(vectors, "vec_id % 20 = 0").toPandas()
    found = got.groupby("query_id")["vec_id"].apply(set)
    score = x[asks].astype(float) @ x.T.astype(float)
    score[np.arange(len(asks)), asks] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :20]
    assert np.mean([len(found[i] & set(best[j].tolist())) / 20 for j, i in enumerate(asks)]) >= 0.9


def test_sharding(docs, empty):
    table = sharding.lookup_table(sharding.SHARDS)
    share = collections.Counter(table)
    assert len(share) == len(sharding.SHARDS) and max(share.values()) - min(share.values()) <= 1
    less = sharding.lookup_table(sharding.SHARDS[:-1])
    stays = sum(a == b for a, b in zip(table, less) if a != len(sharding.SHARDS) - 1) / sum(a != len(sharding.SHARDS) - 1 for a in table)
    assert stays > 0.85
    for r in sharding.place(docs).collect():
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.place(empty).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 10)


def test_licenses(spark, empty):
    texts = [(i, f"er on the ti\n{t}\nlicensed to drive a car") for i, ts in enumerate(license_scan.TEMPLATES.values()) for t in ts] + [(99, None), (98, ""), (97, "nothing")]
    got = license_scan.license_paragraphs(_docs(spark, texts)).collect()
    families = list(license_scan.TEMPLATES)
    for r in got:
        family, probability, similarity = license_scan.classify(r["text"])
        assert r["family"] == family and abs(r["probability"] - probability) < 1e-9 and abs(r["similarity"] - similarity) < 1e-9
        if r["paragraph"] == 1:
            assert r["confirmed"] and r["family"] == families[r["doc_id"]]
        else:
            assert not r["confirmed"]
    held = license_scan.examples(7, 20)
    weights, bias = license_scan.model()
    right = sum(int(np.argmax(np.array(bias) + sum((np.array(weights[g]) for g in grams if g in weights), np.zeros(len(bias))))) == k for grams, k in held)
    assert right / len(held) > 0.95
    assert license_scan.license_paragraphs(empty).count() == 0


def test_wrapped_licenses(spark):
    import textwrap

    kinds = [(f, t, width) for f, ts in license_scan.TEMPLATES.items() for t in ts for width in (1, 20, 45, 72, 400)]
    texts = [(i, "er on the ti\n * \n" + "\n".join(f" * {x}" for x in textwrap.wrap(t, width, break_long_words=False)) + "\n\nnothing here") for i, (_, t, width) in enumerate(kinds)]
    texts.append((900, "\n".join(t for ts in license_scan.TEMPLATES.values() for t in ts)))
    texts.append((901, "a\n" + "\n".join(textwrap.wrap(license_scan.TEMPLATES["mit"][1], 40)[1:]) + "\nb"))
    refused = ["This work is licensed under the GNU General Public License, version 2.", "GNU Lesser General Public License, version 3.", "This work is licensed under\nthe GNU Affero General\nPublic License, version 3.", "Licensed under the Eclipse Public License, Version 2.0.", "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY 3.0.", "Released under the BSD 2-Clause License."]
    texts += [(1000 + i, t) for i, t in enumerate(refused)]
    got = {}
    for r in license_scan.license_paragraphs(_docs(spark, texts)).collect():
        family, probability, similarity = license_scan.classify(r["text"])
        assert r["family"] == family and abs(r["probability"] - probability) < 1e-9 and abs(r["similarity"] - similarity) < 1e-9
        assert r["confirmed"] == (family != "unknown" and probability >= 0.5 and similarity >= 0.5 and license_scan.fits(family, license_scan.words_of(r["text"])))
        if r["confirmed"]:
            got.setdefault(r["doc_id"], []).append((r["paragraph"], r["family"], round(r["similarity"], 6)))
    assert {i: got.get(i) for i in range(len(kinds))} == {i: [(2, f, 1.0)] for i, (f, _, _) in enumerate(kinds)}
    assert sorted(got[900]) == [(i, f, 1.0) for i, f in enumerate(f for f, ts in license_scan.TEMPLATES.items() for _ in ts)]
    assert [x[:2] for x in got[901]] == [(1, "mit")]
    assert not {i: v for i, v in got.items() if i >= 1000}


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(1)
    clean = ["anan", "bela", "corin", "dosta", "elwin", "fanor", "gatel"]
    def text(bad):
        w = [clean[i] for i in rng.integers(0, 7, 60)]
        for k in range(bad):
            w[int(rng.integers(0, 60))] = ["vileword", "grossly", "hateful"][k % 3]
        return " ".join(w)
    bad = [int(rng.integers(1, 10)) if i % 4 == 0 else 0 for i in range(600)]
    texts = [text(b) for b in bad]
    model = toxicity.fit(texts[:400], np.array([float(b > 0) for b in bad[:400]]))
    assert (np.diff(model.cuts) > 0).all()
    scored = {r["doc_id"]: r for r in toxicity.score(_docs(spark, list(enumerate(texts[400:]))), model).collect()}
    right = sum(scored[i]["toxic"] == (b > 0) for i, b in enumerate(bad[400:]))
    assert right >= 198
    severe = [scored[i]["expected_severity"] for i, b in enumerate(bad[400:]) if b >= 7]
    mild = [scored[i]["expected_severity"] for i, b in enumerate(bad[400:]) if b == 1]
    assert np.mean(severe) > np.mean(mild) > 0.5
    assert toxicity.score(empty, model).count() == 0
    # every odd row by the formula itself: features named and counted the plain way
    place = {int(h): i for i, h in enumerate(model.known)}
    odd = [*ROWS, (60, "VileWord grossly"), (61, "vilewords,hateful-hateful " * 3), (62, "h\u00e4teful \u0130 x" * 40)]
    docs = _docs(spark, odd).withColumns({"toxic": F.lit("x"), "word": F.lit(1)})
    scored = collections.Counter((r["doc_id"], r["text"], r["grade"], round(r["expected_severity"], 9), r["toxic"]) for r in toxicity.score(docs, model).collect())
    want = collections.Counter()
    for i, t in odd:
        words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        seen = collections.Counter()
        for w in words:
            for n in (0, *range(toxicity.MIN_PREFIX, toxicity.MAX_PREFIX + 1)):
                if not n or len(w) > n:
                    h = span_hash(prefix_hash(np.frombuffer(w, np.uint8)), np.array([0]), np.array([n or len(w)]))
                    seen[int((mix(h + np.uint64(n)) if n else h)[0])] += 1
        z = sum(model.weights[place[h]] * np.log(1 + c) for h, c in seen.items() if h in place) + model.weights[len(place) + toxicity.size_class(np.array([len(words)]))[0]]
        at_most = [*(1 / (1 + np.exp(z - c)) for c in model.cuts), 1.0]
        p = np.diff([0.0, *at_most])
        want[(i, t, int(np.argmax(p)), round(float(sum(k * q for k, q in enumerate(p))), 9), bool(1 - p[0] >= toxicity.THRESHOLD))] += 1
    assert scored == want


def test_toxicity_fits_on_bounded_text(spark, monkeypatch):
    texts = [(i, ("vileword bad " if i % 3 == 0 else "fine day ") * (1 + i % 5)) for i in range(60)] + [(None, "x"), (3, "vileword")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (7, None), (900, 1)], "doc_id long, toxic int")
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda t, y: sizes.append((len(t), sum(len(x) for x in t.to_pylist()))) or "model")
    toxicity.train(_docs(spark, texts), labels)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 500)
    toxicity.train(_docs(spark, texts), labels)
    assert sizes[0][0] == 60 and 0 < sizes[1][0] < 60 and sizes[1][1] <= 500


def plain_spans(text):
    """The base patterns said again: every match of the plain expressions, failing ones dropped."""

    def luhn(d):
        return sum(sum(divmod(int(c) * (2 if k % 2 else 1), 10)) for k, c in enumerate(d[::-1])) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(k, *m.span()) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m)]


def test_pii_base_spans_equal_the_plain_patterns():
    rng = np.random.default_rng(12)
    parts = ["1", "25", "255", "256", "0", "007", ".", ".", "..", "@", "a", "b.c", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "x@y.z", "\n", "é", "%", "_", "²", "٣", "10.0.0.1", "+33 1 23 45 67 89"]
    found = collections.Counter()
    for _ in range(20_000):
        text = "".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
        found.update(k for k, *_ in pii.base_spans(text))
    assert min(found[k] for k in pii.KINDS) > 500


def test_pii_windows_hold_every_segment():
    """The field over its stretches equals the field over whole texts, whatever stands between the tokens."""
    rng = np.random.default_rng(5)
    parts = ["jo", "at", "AT", "aT", "site", "dot", "com", " ", " ", "\t", "\n", "[", "]", "(", ")", "_", ".", "h" * 70, " " * 90, "12", "345", "6789", "²", "+", "-", "/", "word " * 30, "look at the ", "token", "key", "=", '"', "a1b2c3d4e5f6a7b8c9d0e1", "f00", "é", "A1" * 120]
    field, seen = pii.model(), 0
    for _ in range(6000):
        text = "".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(3, 40)))
        got = sorted(field.decode(text))
        assert got == sorted(field.decode(text, [(0, len(text))])), text
        seen += len(got)
    assert seen > 300
    for text in ("jo at site dot com", "jo\tat\tsite dot com", "jo\nat\nsite dot com", "jo aT site dot com", f"jo at {'h' * 70} dot com"):
        assert [k for k, *_ in field.decode(f"please write to {text} today")] == ["email"], text


def test_pii_takes_linear_time_on_long_numbers(spark):
    import time

    texts = ["1" * 1_000_000, "1." * 20_000, "1 " * 20_000, "+1" * 20_000, "a@" * 100_000, "at " * 10_000, "(" * 100_000 + "1", "+1" + " " * 500_000]
    for text in texts:
        began = time.time()
        base, spans = pii.all_spans(text, pii.model())
        assert time.time() - began < 20
    assert pii.personal_data(_docs(spark, [(1, texts[0])])).first()["n_card"] == 0


def test_pii(docs, empty, spark):
    held, right, wrong, missed = pii.examples(300, 99), 0, 0, 0
    for text, gold in held:
        found, gold = set(pii.model().decode(text)), set(gold)
        right, wrong, missed = right + len(found & gold), wrong + len(found - gold), missed + len(gold - found)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9
    texts = [*ROWS, (101, "mail a.b@c.de, ip 10.0.0.256 or 10.0.0.25 card 4111 1111 1111 1111 and +33 1 23 45 67 89é"), (102, "jo (at) site dot com"), (104, "a@b@c.d 4111111111111112"), (105, "².².².²²² 1²3")]
    got = collections.defaultdict(list)
    for r in pii.personal_data(_docs(spark, texts)).collect():
        got[r["doc_id"]].append(r)
    assert [got[101][0][k] for k in ("n_email", "n_ip", "n_card", "n_phone")] == [1, 1, 1, 1]
    assert sum(map(len, got.values())) == len(texts)
    for i, t in texts:
        base = plain_spans(t or "")
        name = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        for r in got[i]:
            if (i, t) == (i, dict(texts)[i]):
                assert r["base_sha256"] == hashlib.sha256(name.encode()).hexdigest()
                assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
                assert set(name.split(",")) - {""} <= set(r["spans"].split(","))
    assert got[102][0]["spans"].startswith("email:")
    key = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    told = {1: f'the token = "{key}" of', 2: f"commit {key}", 3: f"PASSWORD: {key}", 4: f"mail a@b.c, token={key}", 5: "token = short1", 6: f"token = é{key}"}
    secrets = {r["doc_id"]: (r["n_secret"], r["n_spans"], r["spans"]) for r in pii.personal_data(_docs(spark, [*told.items()])).collect()}
    assert secrets == {1: (1, 1, "secret:13:53"), 2: (0, 0, ""), 3: (1, 1, "secret:10:50"), 4: (1, 2, "email:5:10,secret:18:58"), 5: (0, 0, ""), 6: (0, 0, "")}
    assert pii.personal_data(empty).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0.5 * n < docs.count() <= n
        n = docs.count()
    assert minhash.near_duplicates(docs.where(F.length("text") > 0)).where("not kept").count() <= 2
    assert decontam.contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").count() == 0
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == n


def test_pipeline_stages_on_odd_rows(spark, docs, empty):
    """Nulls in every column, repeated rows and ids, empty tables and clashing columns through every stage."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        got = collections.Counter((r["doc_id"], r["text"]) for r in out.collect()) if name != "packing" else None
        none = stage(spark, empty, sf)
        assert none.count() == 0
        if name == "packing":
            assert out.where("piece = 0").count() == len(ROWS)
            continue
        assert out.columns == none.columns == list(corpus_pipeline.COLUMNS)
        if name in ("toxicity", "decontamination"):
            assert got == collections.Counter(ROWS)
        elif name == "line_dedup":
            assert sum(got.values()) == len(ROWS) and got == collections.Counter((i, t and t.replace("shared line\n", "")) for i, t in ROWS)
        else:
            s = [sets_of(t, 5) for _, t in ROWS]
            root = list(range(len(ROWS)))
            for _ in ROWS:
                for a in range(len(s)):
                    for b in range(len(s)):
                        if s[a] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                            root[a] = root[b] = min(root[a], root[b])
            groups = collections.defaultdict(list)
            for k, (i, t) in enumerate(ROWS):
                groups[root[k]].append((i is None, i or 0, t))
            firsts = collections.Counter(min(i for n, i, _ in g if not n) if not all(n for n, _, _ in g) else None for g in groups.values())
            assert sum(got.values()) == len(groups) and collections.Counter(i for i, _ in got) == firsts
    assert corpus_pipeline.drop_near_duplicates(spark, docs.where("doc_id > 12"), sf).count() == docs.where("doc_id > 12").count()


def test_queries_equal_their_sql(spark):
    import duckdb

    from tallyfold.llm import queries

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        told, ours = con.execute(sql), queries.queries()[name](spark, sf)
        columns, at = sorted(ours.columns), {d[0]: i for i, d in enumerate(told.description)}
        assert columns == sorted(at), name
        assert sorted(str([r[at[c]] for c in columns]) for r in told.fetchall()) == sorted(str([r[c] for c in columns]) for r in ours.collect()), name


@pytest.mark.parametrize("n", [2, 12, 25, 60])
def test_ann_small_tables_give_all_answers(spark, n):
    rng = np.random.default_rng(n)
    vectors = spark.createDataFrame([(20 * i, [float(x) for x in rng.normal(size=64)]) for i in range(n)], "vec_id long, embedding array<float>")
    got = collections.Counter(r["query_id"] for r in ann.nearest(vectors, "vec_id % 20 = 0").collect())
    assert got == {20 * i: min(20, n - 1) for i in range(n)}


def test_ann_one_part_holds_nearly_all(spark):
    rng = np.random.default_rng(0)
    rows = [(20 * i, [float(x) for x in rng.normal(size=8)]) for i in range(40)] + [(1000 + i, [1.0, *[0.0] * 7]) for i in range(800)]
    got = collections.Counter(r["query_id"] for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id < 800").collect())
    assert got == {20 * i: 20 for i in range(40)}


def test_minhash_many_texts_of_one_id(spark):
    words = [f"w{i}" for i in range(300)]
    texts = [(7, " ".join(f"v{k}" if i == k % 300 else w for i, w in enumerate(words))) for k in range(600)]
    got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(got) == 600 and {r["component_id"] for r in got} == {7}


def test_license_scan_of_a_text_of_many_lines(spark):
    notice = license_scan.TEMPLATES["mpl-2.0"][-1]
    lines = [f"line {i} of the program" for i in range(40_000)]
    for at in (0, 20_000, 39_999):
        lines[at] = notice
    got = license_scan.license_paragraphs(spark.createDataFrame([(1, "\n".join(lines)), (2, notice)], "doc_id long, text string")).where("confirmed").collect()
    assert sorted((r["doc_id"], r["paragraph"], r["family"]) for r in got) == [(1, 0, "mpl-2.0"), (1, 20_000, "mpl-2.0"), (1, 39_999, "mpl-2.0"), (2, 0, "mpl-2.0")]


def test_packing_deals_rows_alike_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    pieces = packing.materialize(spark.createDataFrame([(None, 0, 0, 7)] * 1000, "doc_id long, piece int, start long, length long").repartition(4))
    got = packing.pack(pieces, 100).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 1000 and len({r["sequence_id"] for r in got}) == 72
    from pyspark.sql import functions as F
    buckets = pieces.select(F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id", "piece", "start"), F.lit(20)).alias("b")).groupBy("b").count().collect()
    assert len(buckets) == 20 and max(r["count"] for r in buckets) < 100


def test_decontaminate_keeps_columns_of_any_name(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 40)
    phrase = " ".join(f"secret{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"before {phrase} after", 7, "h", "w"), (2, "clean", 8, "i", "x")], "doc_id long, text string, _decontam_row long, _decontam_hits string, __row0 string")
    bench = spark.createDataFrame([(1, phrase), (2, "other words stand here in this one item too now ok")], "item_id long, text string")
    got = decontam.decontaminate(docs, bench)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert "secret3" not in rows[1][1] and rows[1][2:] == (7, "h", "w") and rows[2] == (2, "clean", 8, "i", "x")
