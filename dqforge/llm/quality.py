"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic gradient boosting visits one feature (then one pair) at a time and adds a shallow tree on
that feature alone; a feature's trees sum up to one lookup table over its bins, a pair's to one
two-dimensional table.  Scoring is a bin lookup and an addition per table, vectorised over rows.
Features are plain statistics of the whole text (shares of character kinds, word lengths, repeated
lines, words and word pairs, ...).

Defined results: null and empty texts have the features of an empty text (all zero) and get a score;
without labels of both classes every score is the prior; one row in, one row out; repeated rows score
alike; other columns are ignored (``keep_good`` carries them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import give_back, id_bucket, labelled_sample, release, slices, stored

FEATURES = ("log_chars", "upper", "digits", "symbols", "stops", "spaces", "non_ascii", "word_length", "distinct_words",
            "top_word", "repeated_lines", "symbol_words", "upper_words", "repeated_pairs", "line_words", "short_words")
N_BINS, N_PAIR_BINS = 32, 8
_KIND = np.zeros(256, np.uint8)  # of a byte: 1 upper, 2 digit, 3 sentence punctuation, 4 other ASCII symbol, 5 white space, 6 non-ASCII, 0 lower
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (6 if _b > 127 else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c in ".,;:'\"-()" else 5 if _c.isspace() or _b < 32
                 else 0 if _c.islower() else 4)


def features(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    count = max(1, len(words))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    return [
        float(np.log1p(n)), kinds[1] / n, kinds[2] / n, kinds[4] / n, kinds[3] / n, kinds[5] / n, kinds[6] / n,
        sum(map(len, words)) / count, len(seen) / count, max(seen.values(), default=0) / count,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:" for w in words) / count,
        sum(w.isupper() and len(w) > 1 for w in words) / count,
        1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        count / max(1, len(lines)), sum(len(w) < 3 for w in words) / count,
    ]


class AdditiveModel:
    """Bias, a table per feature and a table per chosen pair."""

    def __init__(self, edges, tables, pair_edges, pairs, pair_tables, bias, prior=None):
        self.edges, self.tables, self.pair_edges, self.pairs, self.pair_tables = edges, tables, pair_edges, pairs, pair_tables
        self.bias, self.prior = bias, prior

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, j], side="right")]
        for (j, k), t in zip(self.pairs, self.pair_tables):
            z += t[np.searchsorted(self.pair_edges[j], x[:, j], side="right"), np.searchsorted(self.pair_edges[k], x[:, k], side="right")]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -50, 50)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow regression tree over ordered bins: the value of each bin (Newton step per leaf)."""
    total_g, total_h = g.sum(), h.sum()
    if depth and len(g) > 1:
        cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(cg, ch) + _gain(total_g - cg, total_h - ch)
        k = int(np.argmax(gain))
        if gain[k] > _gain(total_g, total_h) + 1e-9:
            return np.concatenate([_tree(g[:k + 1], h[:k + 1], depth - 1), _tree(g[k + 1:], h[k + 1:], depth - 1)])
    return np.full(len(g), -total_g / (total_h + 1.0))


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut on each axis: the four quadrants' values, and the gain of the best cuts."""
    best, at = -1.0, None
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for a in range(g.shape[0] - 1):
        top_g, top_h, all_g, all_h = cg[a], ch[a], cg[-1], ch[-1]
        parts = ((top_g[:-1], top_h[:-1]), (top_g[-1] - top_g[:-1], top_h[-1] - top_h[:-1]),
                 (all_g[:-1] - top_g[:-1], all_h[:-1] - top_h[:-1]),
                 (all_g[-1] - top_g[-1] - all_g[:-1] + top_g[:-1], all_h[-1] - top_h[-1] - all_h[:-1] + top_h[:-1]))
        gain = sum(_gain(x, y) for x, y in parts)
        if len(gain) and gain.max() > best:
            best, at = float(gain.max()), (a, int(np.argmax(gain)))
    out = np.zeros_like(g)
    if at is None:
        return out, 0.0
    a, b = at
    for i in (slice(0, a + 1), slice(a + 1, None)):
        for j in (slice(0, b + 1), slice(b + 1, None)):
            out[i, j] = -g[i, j].sum() / (h[i, j].sum() + 1.0)
    return out, best


def train(x: np.ndarray, y: np.ndarray, positives: float, rounds: int = 120, n_pairs: int = 6, rate: float = 0.1) -> AdditiveModel:
    """Fit on a bounded sample; classes are weighted to ``positives``, their share among all labels."""
    share = float(np.clip(positives, 0.0, 1.0))
    if len(set(y.tolist())) < 2:
        return AdditiveModel([], [], [], [], [], 0.0, prior=share)
    share = float(np.clip(share, 0.01, 0.99))
    w = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum()) * len(y)
    edges, pair_edges = [_edges(x[:, j], N_BINS) for j in range(x.shape[1])], [_edges(x[:, j], N_PAIR_BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    bias = float(np.log(share / (1 - share)))
    z = np.full(len(y), bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return w * (p - y), np.maximum(w * p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j, b in enumerate(bins):
            g, h = slopes()
            step = rate * _tree(np.bincount(b, g, len(tables[j])), np.bincount(b, h, len(tables[j])))
            tables[j] += step
            z += step[b]
    # the pairs that explain most of what the single features left
    g, h = slopes()
    grid = lambda j, k, v: np.bincount(coarse[j] * (len(pair_edges[k]) + 1) + coarse[k], v, (len(pair_edges[j]) + 1) * (len(pair_edges[k]) + 1)).reshape(len(pair_edges[j]) + 1, -1)
    ranked = sorted(((_pair_tree(grid(j, k, g), grid(j, k, h))[1], j, k) for j in range(x.shape[1]) for k in range(j)), reverse=True)
    pairs = [(j, k) for _, j, k in ranked[:n_pairs]]
    pair_tables = [np.zeros((len(pair_edges[j]) + 1, len(pair_edges[k]) + 1)) for j, k in pairs]
    for _ in range(rounds // 3):
        for t, (j, k) in zip(pair_tables, pairs):
            g, h = slopes()
            step = rate * _pair_tree(grid(j, k, g), grid(j, k, h))[0]
            t += step
            z += step[coarse[j], coarse[k]]
    return AdditiveModel(edges, tables, pair_edges, pairs, pair_tables, bias)


def _matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


def _scores(model: AdditiveModel, texts) -> np.ndarray:
    """Scores of a batch's texts, a bounded number of characters at a time."""
    return np.concatenate([np.zeros(0), *(model.score(_matrix(part)) for part in slices(texts))])


def fit(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, per_class: int = 3000) -> AdditiveModel:
    """Learn from at most ``2 * per_class`` labelled documents (a documented bound).  Features are
    computed where the texts are; only they reach the driver."""
    rows, counts = labelled_sample(docs, labels, "quality", mod, held, per_class)

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        release()
        return pd.Series([features(t) for t in texts])

    got = sorted((r["_id"], r["y"], r["x"]) for r in rows.select("_id", "y", measured(F.col("text")).alias("x")).collect())
    total = sum(counts.values())
    x = np.array([r[2] for r in got], float).reshape(-1, len(FEATURES))
    return train(x, np.array([r[1] for r in got], int), counts.get(1, 0) / total if total else 0.0)


def scored(docs: DataFrame, model: AdditiveModel, name: str = "score") -> DataFrame:
    """``docs`` with the score of each text in column ``name``."""
    @F.pandas_udf("double")
    def quality(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        for s in texts:
            yield pd.Series(_scores(model, s))
        give_back()

    return docs.withColumn(name, quality(F.col("text")))


def score(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3, mod: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", (id_bucket("doc_id", mod) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with all their columns."""
    # written here, where the batches of whole texts in a Python worker are bounded
    return stored(scored(docs, model, "_quality_score").where(F.col("_quality_score") >= threshold).drop("_quality_score"), "quality-kept")
