"""Operators 11 to 13 against plain loops, on small tables with every odd case."""

import base64
import collections
import gzip
import hashlib
import io

import numpy as np
import pytest

from tallyfold.llm import alignment, centroids, warc

DOCS = "doc_id long, text string, block string, pair string, place string"
TEXTS = [(1, "Hello world, this is  a test.\n\nNew paragraph"), (2, "Hello world, this is  a test.\n\nNew paragraph"), (3, None), (4, ""), (5, "été 中文 ① ﬁn"), (6, "a ▁ piece of the other kind"), (7, "<s> plain <|endoftext|> text <unk></s>"), (None, "Hello"), (1, " two  spaces"), (8, "x" * 3000), (9, "the same words again and again " * 400), (10, "\x00\t\r\n"), (11, " ")]


def _plain(texts):
    """Every pair of tokens compared, and counts over all documents."""
    tok = alignment._pair(None, None)
    held, docs = collections.Counter(), []
    for text in texts:
        links, groups, a, b = [], [], [], []
        if got := tok.tokens(text):
            a, b = got[0].tolist(), got[1].tolist()
            ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((tok.bytes_a, a), (tok.bytes_b, b))]
            j0 = 0
            for i, end in enumerate(ends[0]):
                start = ends[0][i - 1] if i else 0
                j = j0
                while j < len(b) and (ends[1][j - 1] if j else 0) < end:
                    if ends[1][j] > start:
                        links.append((a[i], b[j]))
                    j += 1
                j0 = max(0, j - 1)
            at = [0, 0]
            for cut in sorted(set(ends[0]) & set(ends[1])):
                to = [e.index(cut) + 1 for e in ends]
                groups.append(f"{','.join(map(str, a[at[0] : to[0]]))}|{','.join(map(str, b[at[1] : to[1]]))}")
                at = to
            held.update(set(links))
        docs.append((len(a), len(b), groups, links))
    top = collections.defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return [(n_a, n_b, len(g), len(x), sum(held[p] == top[p[0]] for p in x), sum(held[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "") for n_a, n_b, g, x in docs]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block", [4_000_000, 50])
def test_alignment(spark, block, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    got = alignment.link_statistics(spark.createDataFrame([(*x, "b", "p", "q") for x in TEXTS], DOCS)).collect()
    want = [(i, *x) for (i, _), x in zip(TEXTS, _plain([t for _, t in TEXTS]), strict=True)]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], *[r[c] for c in NAMES])) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[6]["n_a"] == 0 and by_id[6]["groups_sha256"] == ""  # the sign that stands for a space does not come back
    assert by_id[7]["n_a"] and by_id[5]["n_links"] and by_id[10]["n_b"]


def test_alignment_of_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in alignment.link_statistics(docs).collect()}
    assert got == {r["doc_id"]: x for r, x in zip(rows, _plain([r["text"] for r in rows]), strict=True)}


def test_token_groups(spark):
    got = alignment.token_groups(spark.createDataFrame([(*x, "b", "p", "q") for x in TEXTS], DOCS)).collect()
    tok = alignment._pair(None, None)
    for r in got:
        at = [0, 0]
        for to in zip(r["a_ends"], r["b_ends"], strict=True):
            a, b = (b"".join(t[i] for i in ids[f:e]) for t, ids, f, e in zip((tok.bytes_a, tok.bytes_b), (r["a"], r["b"]), at, to, strict=True))
            assert a == b and a
            at = to
        assert [*at] == [len(r["a"]), len(r["b"])]


def test_alignment_of_nothing(spark):
    assert alignment.link_statistics(spark.createDataFrame([], DOCS)).count() == 0
    only = alignment.link_statistics(spark.createDataFrame([(1, None, "", "", ""), (2, "", "", "", "")], DOCS)).collect()
    assert [tuple(r[c] for c in NAMES) for r in only] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_bits_rank_and_select():
    rng = np.random.default_rng(5)
    places = np.unique(rng.integers(0, 1000, 200))
    bits = alignment.Bits.at(places, 1000)
    assert bits.select().tolist() == places.tolist()
    assert bits.rank(np.arange(1000)).tolist() == [int((places < p).sum()) for p in range(1000)]


VECTORS = "vec_id long, embedding array<float>, v string, cluster string, n int"


def _clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    cents = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        to = assign()
        for j in range(len(cents)):
            own = [v for (_, v), (_, x) in zip(kept, to, strict=True) if x == j]
            if own:
                cents[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    to = assign()
    own = collections.Counter()
    for d, j in to:
        own[j] += d
    return [(i, j, d, own[j], sum(own.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, to, strict=True)]


@pytest.mark.parametrize("n", [0, 1, 5, 90])
def test_centroids(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(i), [float(x) for x in rng.normal(size=64)]) for i in range(n)]
    if n == 90:
        same = [0.25] * 64
        rows += [(500 + i, same) for i in range(40)] + [(3, rows[3][1]), (None, rows[4][1]), (None, same), (600, None), (601, []), (602, [1.0] * 63), (603, [None] + [1.0] * 63), (604, [float("nan")] * 64), (605, [float("inf")] + [0.0] * 63), (606, [-0.0001] * 64), (607, [60000.0] * 64)]
    got = centroids.cluster(spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], VECTORS)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _clusters(rows, 8, 10, 64)))


def test_centroids_beyond_the_range(spark):
    with pytest.raises(Exception, match="a component lies beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 64, "x", "y", 1)], VECTORS)).collect()


def test_partial_distances_equal_whole_ones():
    rng = np.random.default_rng(1)
    v, c = rng.integers(-50, 50, (500, 64)), rng.integers(-50, 50, (8, 64))
    c[5] = c[2]  # ties go to the smaller number
    full = ((v[:, None, :] - c[None]) ** 2).sum(2)
    at, dist = centroids.nearest_centroid(v, c, np.argsort(-v.var(0)))
    assert at.tolist() == full.argmin(1).tolist() and dist.tolist() == full.min(1).tolist()


PAGES = "page_id long, url string, html string, key string, digest string, chunk int"
LONG = "".join(f"line {i}\r\n\r\n" for i in range(3000)) + "é"
ROWS = [(1, "http://a/", "same"), (2, "http://b/ x\r\nWARC-Type: x", "same"), (3, None, None), (4, "http://c/é", ""), (5, "u", LONG), (6, "u", LONG), (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (8, "u", "\r\n\r\n"), (-9, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n")]


def _facts(rows, least=0):
    first = {}
    for k, (i, _, h) in enumerate(rows):
        me = (i is None, i or 0, k)
        first[h or ""] = min(first.get(h or "", me), me)
    out = []
    for k, (i, _, h) in enumerate(rows):
        raw = (h or "").encode()
        again = len(raw) >= least and first[h or ""][2] != k
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", (None if first[h or ""][0] else first[h or ""][1]) if again else None))
    return out


@pytest.mark.parametrize(("chunk", "file_bytes"), [(warc.CHUNK, warc.FILE_BYTES), (7, 200)])
@pytest.mark.parametrize("extra", [[], [(1, "u", "same"), (None, "u", "alone"), (None, "u", "alone"), (None, "u", "same")]])
def test_archives_round_trip(spark, tmp_path, chunk, file_bytes, extra):
    rows = ROWS + extra
    pages = spark.createDataFrame([(*r, "k", "d", 1) for r in rows], PAGES).coalesce(1)
    manifest = warc.archived(pages, str(tmp_path / "arc"), chunk=chunk, file_bytes=file_bytes)
    got = warc.page_records(manifest, chunk).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _facts(rows)))
    table = warc.read_archives(manifest, chunk).collect()
    whole = collections.defaultdict(bytes)
    for r in sorted(table, key=lambda r: (r["record_id"], r["chunk"])):
        assert len(r["data"]) <= chunk
        whole[r["record_id"]] += bytes(r["data"])
        if r["record_type"] == "response":
            assert r["n_bytes"] == len(whole[r["record_id"]]) and r["digest"] == base64.b32encode(hashlib.sha1(whole[r["record_id"]]).digest()).decode()
    responses = sorted((h or "").encode() for (_, _, h), f in zip(rows, _facts(rows), strict=True) if f[3] == "response")
    assert sorted(whole[r["record_id"]] for r in table if r["record_type"] == "response" and r["last"]) == responses
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(rows)


def test_short_payloads_are_never_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "k", "d", 1) for r in ROWS], PAGES)
    got = warc.page_records(warc.archived(pages, str(tmp_path), least=5)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _facts(ROWS, 5)))


def test_no_pages_give_no_archives(spark, tmp_path):
    assert warc.page_records(warc.archived(spark.createDataFrame([], PAGES), str(tmp_path))).count() == 0


def test_plain_archives_of_others_and_broken_ones():
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x:0>\r\nContent-Type: application/warc-fields\r\nContent-Length: 12\r\n\r\nsoftware: x\n\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Type: text/plain\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for data in (one + two, gzip.compress(one) + gzip.compress(two), gzip.compress(one + two)):
        got = list(warc.record_chunks(io.BytesIO(data), 5))
        assert [(r[0], bytes(r[5]), r[8]) for r in got] == [("urn:x:0", b"softw", False), ("urn:x:0", b"are: ", False), ("urn:x:0", b"x\n", True), ("urn:x:1", b"", True)]
    for data in (one[:-8], gzip.compress(one)[:-9], one.replace(b": 12", b": 11"), b"WARC/1.0\r\nWARC-Type"):
        with pytest.raises((ValueError, EOFError)):
            list(warc.record_chunks(io.BytesIO(data), 5))
    head, http = warc._head({"record_id": "urn:x:2", "record_type": "response", "target_uri": "u", "refers_to": None, "n_bytes": 3, "digest": "A" * 32}, "d")
    with pytest.raises(ValueError, match="has digest"):
        list(warc.record_chunks(io.BytesIO(head + http + b"abc\r\n\r\n")))
