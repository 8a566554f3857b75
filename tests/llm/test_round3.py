"""Repeated passages, the prefix trie and hard negatives against brute force, on odd rows too."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqforge.llm import hard_negatives as H, prefix_trie as P, suffix_dedup as S

SF = "/root/testdata/sf0.001"


# -- repeated passages ------------------------------------------------------------------------------

def _brute_repeats(rows, length):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, S.NO_ID), S.NO_ID if i is None else i)
    out = []
    for i, t in rows:
        b, key = (t or "").encode(), S.NO_ID if i is None else i
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < key:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _repeats(docs, **kw):
    return sorted((tuple(r) for r in S.repeats(docs, **kw).drop("spans").collect()), key=str)


@pytest.fixture(scope="module")
def passages(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdé\0 ") for _ in range(rnd.randint(2, 9)))
    shared = [" ".join(word() for _ in range(rnd.randint(5, 40))) for _ in range(6)]
    rows = [(i * 3 - 20, " ".join(rnd.choice([word(), word(), rnd.choice(shared)]) for _ in range(rnd.randint(0, 30)))) for i in range(60)]
    rows += [(5000 + i, shared[0] + rows[7][1]) for i in range(30)]  # a group of copies of a third of the rows
    rows += [(1, None), (2, ""), (None, shared[1]), (None, shared[1]), (7, "x" * 49), (8, "x" * 50), (9, "x" * 400), (10, "y" + "x" * 49), (11, "x" * 50_000),
             (8, "x" * 50), (40, shared[2]), (40, shared[2] + "z"), (41, rows[3][1] * 3), (S.NO_ID - 1, "日本語のテキスト" * 20)]
    return rows


@pytest.mark.parametrize("kw", [{}, {"slice_bytes": 4000}, {"slice_bytes": 9000, "hot_slices": 1}, {"index_bytes": 700}])
def test_repeats_equal_brute_force(spark, passages, kw):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in passages], "doc_id long, text string, slice string, share int").repartition(5)
    assert _repeats(docs, **kw) == _brute_repeats(passages, 50)


def test_repeats_of_frequent_names(spark, passages):
    docs = spark.createDataFrame(passages, "doc_id long, text string").repartition(3)
    for length, index_bytes in ((5, 300), (23, 300), (90, 2000)):
        assert _repeats(docs, length=length, slice_bytes=9000, hot_slices=1, index_bytes=index_bytes) == _brute_repeats(passages, length)


def test_frequent_names_take_little_more_text():
    rnd = random.Random(2)
    docs = [bytes(rnd.choice(b"abcdefgh ") for _ in range(3000)) for _ in range(30)]
    texts = S._blob_table([(0, S._packed(ids=np.arange(30), counts=np.ones(30, np.int64), sizes=np.full(30, 3000), text=b"".join(docs)))], "slice")
    runs = S.named_runs(np.frombuffer(b"".join(docs), np.uint8), np.arange(31) * 3000, 50)
    names = np.unique(np.concatenate([r[0] for r in runs]))
    sent, windows = [], []
    for frequent in (0, 1):
        known = S._blob_table([(0, S._planes(names << np.uint64(1) | np.uint64(frequent)))], "slice")
        parts = [S._unpacked(b) for b in S._pieces(50, 4)(texts, known).column("blob").to_pylist()]
        sent.append(sum(int(p["sizes"].sum(dtype=np.int64)) for p in parts))
        windows.append(sorted((d, s + k) for p in parts for n, d, s in zip(np.repeat(p["sizes"], p["places"]).tolist(), p["rows"].tolist(), p["starts"].tolist()) for k in range(n - 49)))
    assert windows[0] == windows[1] == [(d, s) for d in range(30) for s in range(2951)]
    assert sent[1] < 2.5 * sent[0]


def test_a_name_with_much_text_takes_few_indexes(monkeypatch):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    texts = list(dict.fromkeys([word(30) + "x" * 20 + word(30) for _ in range(150)] * 2 + ["a" * 25 + "x" * 25 + word(10) for _ in range(40)]))
    indexed, index = [], S.RunIndex
    monkeypatch.setattr(S, "RunIndex", lambda pieces, *a: indexed.append(sum(map(len, pieces))) or index(pieces, *a))
    n, ids = len(texts), np.arange(len(texts))
    blob = S._packed(names=np.full(n, 7), sizes=np.array([len(t) for t in texts], np.uint16), text="".join(texts).encode(), places=np.ones(n, np.int64), ids=ids, rows=ids, starts=np.zeros(n, np.int64), slice=np.zeros(1, np.int64))
    got = [S._unpacked(b) for b in S._marked(50, 3000)(S._blob_table([(0, blob)], "share")).column("blob").to_pylist()]
    assert sum(indexed) < 4 * sum(map(len, texts))
    want = {(int(i), k) for i, t in enumerate(texts) for p in range(len(t) - 49) if any(t[p:p + 50] in x for x in texts[:i]) for k in range(p, p + 50)}
    assert {(d, k) for p in got for d, a, b in zip(p["rows"].tolist(), p["starts"].tolist(), p["stops"].tolist()) for k in range(a, b)} == want and want


def test_slices_grow_with_the_corpus():
    assert [S._slices(int(gb * 2**30), 8 << 20) for gb in (0, 0.5, 1, 4, 10)] == [1, 64, 128, 256, 640]


def test_repeats_other_lengths_and_names(spark, passages):
    docs = spark.createDataFrame(passages, "blob long, ids string")
    for length in (5, 23, 90):
        assert _repeats(docs, id_col="blob", text_col="ids", length=length) == _brute_repeats(passages, length)
    assert S.repeats(docs.limit(0), "blob", "ids").count() == 0
    with pytest.raises(ValueError):
        S.repeats(docs, "blob", "ids", length=2)


def test_spans_and_texts(spark):
    a = "".join(chr(97 + i % 26) for i in range(60))
    docs = spark.createDataFrame([(1, a), (2, "start " + a + " end"), (3, a + "!")], "doc_id long, text string")
    got = {r.doc_id: r for r in S.repeats(docs, with_text=True).collect()}
    assert [tuple(s) for s in got[2].spans] == [(6, 66)] and bytes(got[2].kept) == b"start  end" and got[1].spans == []
    assert {r.doc_id: r.text for r in S.drop_repeats(docs).collect()} == {1: a, 2: "start  end", 3: "!"}


def test_matching_statistics():
    rnd = random.Random(1)
    text = lambda n: bytes(rnd.choice(b"ab\0c") for _ in range(n))
    pieces = sorted({text(rnd.randint(8, 40)) for _ in range(80)}, key=lambda t: -len(t))
    owners = np.array([rnd.randint(0, 50) for _ in pieces])
    index = S.RunIndex(pieces, owners, 8)
    assert len(index.starts) < len(index.text)
    patterns = sorted([bytes(rnd.choice(b"ab\0cd") for _ in range(30)) for _ in range(60)] + pieces, key=lambda t: -len(t))
    for back, m, size, owner in index.stream(patterns):
        for k in range(m):
            s = patterns[k][len(patterns[k]) - back:]
            want = max(n for n in range(len(s) + 1) if any(s[:n] in p for p in pieces))
            assert size[k] == want
            if want >= 8:
                assert owner[k] == min(o for p, o in zip(pieces, owners) if s[:8] in p)


# -- prefix trie ------------------------------------------------------------------------------------

def _brute_trie(rows):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    members, ends = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        turns = (own.get(c - int(math.fmod(c, 5)), [])[:h]) + own[c][h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children.get(n, [])) if n in children else 1
        saved[n] = sum(saved[k] for k in children.get(n, [])) + ((len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0)
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items()), key=str)


def _trie(df):
    return sorted((tuple(r) for r in P.trie(*P.forked(P.ordered_turns(df))).collect()), key=str)


def test_trie_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "é", "", None, "long text"])) for c in range(0, 60) for t in range(rnd.randint(1, 12))]
    rows += [(61, None, "user", "a"), (61, None, "user", "a"), (61, 3, "x", "y"), (61, 3, "x", "y"), (None, 1, "user", "lost"), (-7, 0, "user", "a")]
    rows += [(70, t, "user", "deep") for t in range(400)] + [(75, t, "user", "deep") for t in range(150)]  # a third of all rows, many bands deep
    rows += [(100 + 5 * c, t, "user", "same") for c in range(40) for t in range(3)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, depth int, lead string")
    assert _trie(df) == _brute_trie(rows)


def test_trie_of_nothing(spark):
    assert _trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")) == []


# -- hard negatives ---------------------------------------------------------------------------------

def _brute_negatives(rows, every=4):
    part = []
    for i, label, x in rows:
        if label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            part.append((i, label, [math.floor(256 * c) for c in x]))
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    late = lambda i: (i is None, i or 0)
    out = []
    for k, (i, label, v) in enumerate(part):
        if i is None or i % every:
            continue
        same = sorted(((-dot(v, w), late(j), j) for m, (j, other, w) in enumerate(part) if other == label and m != k))[:5]
        for s, _, j in same:
            fit = sorted((-dot(v, w), late(n), n) for n, other, w in part if other != label and 30 * -s <= 100 * dot(v, w) <= 90 * -s)[:10]
            out += [(i, j, rank, n, -s, -t) for rank, (t, _, n) in enumerate(fit, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("at_once", [16_384, 7])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(H, "ANCHORS_AT_ONCE", at_once)
    monkeypatch.setattr(H, "SEED_ROWS", 40)
    rnd = random.Random(4)
    vec = lambda n=6: [rnd.uniform(-1, 1) for _ in range(n)]
    hot = vec()
    rows = [(i, rnd.randint(0, 3), vec()) for i in range(150)] + [(200 + i, rnd.randint(0, 2), hot) for i in range(90)]
    rows += [(300, None, vec()), (301, 1, None), (302, 1, [1.0, None]), (303, 1, [math.nan] * 6), (304, 1, [math.inf] * 6), (None, 1, hot), (None, 2, vec()),
             (305, 2, []), (306, 2, [0.0] * 6), (307, 2, vec(3)), (308, 9, vec()), (200, 1, hot), (200, 1, hot), (-4, 0, vec())]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, label int, embedding array<double>, slot int, score string").repartition(4)
    got = H.hard_negatives(H.whole_vectors(df), F.col("id") % 4 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == _brute_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert H.hard_negatives(H.whole_vectors(df), F.col("id") % 100 == 0).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(0)
    v, x = rng.integers(-200, 200, (60, 8)).astype(float), rng.integers(-200, 200, (300, 8)).astype(float)
    v[0] = x[0] = 0
    a = H._Anchors(np.arange(60), np.arange(60), np.zeros(60, int), v)
    bound = a.bounds(x)
    for c, m in enumerate(a.members):
        assert (v[m] @ x.T <= bound[c][None, :] * a.norms[m][:, None] + 1e-6).all()
