"""Scores, languages and base secrets of a whole table against plain loops."""

import hashlib
import math
import re
import zlib
from bisect import bisect_right

import pytest

from dqforge.llm import langid, quality, toxicity
from dqforge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def sigmoid(z):
    return 1 / (1 + math.exp(-min(max(z, -50), 50)))


def bucket(gram):
    h = len(gram)
    for c in gram:
        h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 % 2**64
        h ^= h >> 29
    return (h >> 20) % toxicity.BUCKETS


def worst_window(model, text):
    """The mean over the words of the worst window of the mean over a word's n-grams."""
    shares = []
    for w in (text or "").split():
        w = re.sub(r"^[\W_]+|[\W_]+$", "", w.lower())
        grams = [f"<{w}>"[i:i + n] for n in toxicity.SIZES for i in range(len(w) + 3 - n)] if w else []
        if grams:
            shares.append(sum(model.weight[bucket(g)] for g in grams) / len(grams))
    k = toxicity.WINDOW
    windows = [shares[i:i + k] for i in range(0, len(shares), k)]
    if windows and len(windows[-1]) < k:
        windows[-1] = shares[-k:]
    return model.bias + max((sum(w) / len(w) for w in windows), default=0)


def test_toxicity_is_a_mean_of_subword_means(spark, docs, texts, labels):
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in toxicity.score(docs, model).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        want = sigmoid(model.scale * worst_window(model, t) + model.shift)
        assert got[d][1] == pytest.approx(want, abs=1e-9) and got[d][0] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert got[d][2] == (got[d][1] >= 0.3)


def test_quality_is_a_sum_of_table_entries(spark, docs, texts, labels):
    model = quality.fit(docs, labels)
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in quality.score(docs, model).collect()}
    assert got.keys() == texts.keys() and model.prior is None and model.pairs
    for d, t in texts.items():
        x = quality.features(t)
        z = model.bias + sum(table[bisect_right(list(e), v)] for e, table, v in zip(model.edges, model.tables, x))
        for (j, k), table in zip(model.pairs, model.pair_tables):
            z += table[bisect_right(list(model.pair_edges[j]), x[j]), bisect_right(list(model.pair_edges[k]), x[k])]
        assert got[d][1] == pytest.approx(sigmoid(z), abs=1e-9) and got[d][0] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert got[d][2] == (got[d][1] >= 0.3)


def test_quality_features_by_hand():
    got = dict(zip(quality.FEATURES, quality.features("Ab ab ab 12!\n\nAb ab ab 12!\nXY \u00e9.")))
    n = len("Ab ab ab 12!\n\nAb ab ab 12!\nXY \u00e9.".encode())
    want = {"log_chars": math.log(1 + n), "upper": 4 / n, "digits": 4 / n, "symbols": 0 / n, "stops": 3 / n, "spaces": 10 / n, "non_ascii": 2 / n, "word_length": 25 / 10,
            "distinct_words": 5 / 10, "top_word": 4 / 10, "repeated_lines": 1 - 2 / 3, "upper_words": 1 / 10, "line_words": 10 / 3, "short_words": 7 / 10}
    for k in ("log_chars", "upper", "digits", "non_ascii", "distinct_words", "top_word", "repeated_lines", "upper_words", "line_words", "short_words"):
        assert got[k] == pytest.approx(want[k]), k


def parsed(word, learned):
    """Phrases of a word by plain substring search."""
    n = 0
    while word:
        k = 1
        while k < len(word) and word[:k + 1] in learned:
            k += 1
        word, n = word[k:], n + 1
    return n


def test_language_by_substring_search(spark, texts):
    full = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(full)
    some = dict(sorted(texts.items(), key=lambda x: (len(x[1] or ""), x[0]))[:120])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(full.select("doc_id", "text"), model).collect()}
    assert got.keys() == texts.keys()
    size = {k: math.log(max(len(v), langid.FLOOR_CHARS)) for k, v in model.texts.items()}
    for d, t in some.items():
        words = [w for w in (re.sub(r"^[\W\d_]+|[\W\d_]+$", "", w.lower()) for w in (t or "").split()) if w]
        length = sum(len(w) + 1 for w in words)
        if not length or not any(c.isalpha() for c in t):
            assert got[d] == ("und", 0.0)
            continue
        rate = {k: sum(parsed(f" {w} ", v) for w in words) / length * size[k] / max(size.values()) for k, v in model.texts.items()}
        best = min(sorted(rate), key=rate.get)
        assert got[d][0] == best and got[d][1] == pytest.approx(1 / sum(math.exp(-min((r - rate[best]) * 40, 50)) for r in rate.values()))


def test_base_secrets_by_plain_patterns(spark, texts):
    """The three base kinds as the contract states them, over every text of the table."""
    kinds = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16)]
    got = {r.doc_id: r for r in QUERIES["op7_secret_scan"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        spans = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, t or "") if ok(m)]
        line = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
        r = got[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
