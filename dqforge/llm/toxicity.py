"""Toxicity: subword-bag embeddings, averaged, under a linear softmax; all trained jointly in numpy.

A word is the bag of its character n-grams (hashed buckets, with word-boundary marks), its vector
the mean of their embeddings, a window's vector the mean of its words' vectors; a softmax layer
scores windows of ``window`` words and a document scores as its worst window.  Misspellings share
most n-grams with the word they stand for, so words never seen in training score near it.  Embeddings
and softmax are trained together by plain gradient steps, first on whole documents, then on each
document's worst window; one embedding dimension starts at the buckets' smoothed log-odds.

At scoring time the layer is linear, so a word's share in a window's logit is one number; a task
memoises it per word (bounded memo) and a document is a few vector operations over its words.

Defined results: null and empty texts score as a text without words (the model's bias); an input
without usable labels of both classes gives the prior as every score; texts are scored whole, one
row in, one row out; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Memo, id_bucket, labelled_sample, slices

BUCKETS = 1 << 18
SIZES = (3, 4, 5)
WINDOW = 4
#: Documents that a bucket is taken to have been seen in beforehand; the first step size of the embeddings.
SMOOTH, RATE = 1.0, 10.0
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words, and each n-gram's place of its word in ``words``, by word.

    Words count in lower case without outer punctuation; one that is all punctuation has no n-gram."""
    text = "\0".join(f"<{c}>" if c else "" for c in (_EDGE.sub("", w.lower()).replace("\0", " ") for w in words))
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.cumsum(code == 0)
    found = []
    for n in SIZES:
        if len(code) < n:
            continue
        m = len(code) - n + 1
        inside = (word[:m] == word[n - 1:]) & (code[:m] != 0)
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h ^ code[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        found.append(((h[inside] >> np.uint64(20)) & np.uint64(BUCKETS - 1), word[:m][inside]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    bucket, of = (np.concatenate(x).astype(int) for x in zip(*found))
    order = np.argsort(of, kind="stable")
    return bucket[order], of[order]


class SubwordModel:
    """The trained model: what each bucket adds, the bias, the calibration."""

    def __init__(self, weight: np.ndarray, bias: float, scale: float = 1.0, shift: float = 0.0, prior: float | None = None):
        self.weight, self.bias, self.scale, self.shift, self.prior = weight, bias, scale, shift, prior
        self.memo: Memo | None = None

    def __getstate__(self):
        return {**self.__dict__, "memo": None}

    def shares(self, words: list[str]) -> np.ndarray:
        """What each word adds to a window's mean; nan for no word."""
        bucket, of = grams(words)
        n = np.bincount(of, minlength=len(words))
        with np.errstate(invalid="ignore"):
            return np.bincount(of, self.weight[bucket], len(words)) / n

    def logits(self, texts: list[str]) -> np.ndarray:
        if self.memo is None:
            self.memo = Memo(lambda words: self.shares(words).tolist())
        lists = [t.split() for t in texts]
        share = self.memo.lookup(lists)
        out = np.full(len(texts), self.bias)
        for i, words in enumerate(lists):
            x = np.array(list(map(share, words)), float)
            x = x[~np.isnan(x)]
            if not len(x):
                continue
            sums = np.add.reduceat(x, np.arange(0, len(x), WINDOW))
            size = np.full(len(sums), float(WINDOW))
            if len(x) % WINDOW:  # a short last window borrows the words before it
                last = x[-WINDOW:]
                sums[-1], size[-1] = last.sum(), len(last)
            out[i] += (sums / size).max()
        return out

    def scores(self, texts) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        z = [self.logits(part) for part in slices(texts)]
        return 1 / (1 + np.exp(-np.clip(self.scale * np.concatenate(z or [np.zeros(0)]) + self.shift, -50, 50)))


def train(texts: list[str], labels: list[int], positives: float, dim: int = 4, steps: int = 30, seed: int = 7) -> SubwordModel:
    """Fit on a bounded sample; ``positives`` is the share of label 1 among all labelled rows."""
    y = np.asarray(labels, int)
    if len(set(y.tolist())) < 2:
        return SubwordModel(np.zeros(BUCKETS), 0.0, prior=float(np.clip(positives, 0.0, 1.0)))
    lists = [[w for w in (_EDGE.sub("", w.lower()) for w in t.split()) if w] for t in texts]
    vocab = {w: i for i, w in enumerate(dict.fromkeys(w for x in lists for w in x))}
    if not vocab:
        return SubwordModel(np.zeros(BUCKETS), 0.0, prior=float(positives))
    tok = np.array([vocab[w] for x in lists for w in x], int)
    sizes = [[min(WINDOW, len(x) - k) for k in range(0, len(x), WINDOW)] or [0] for x in lists]
    lengths = np.array([n for x in sizes for n in x], float)
    win_doc = np.repeat(np.arange(len(texts)), [len(x) for x in sizes])
    flat, word_at = grams(list(vocab))
    per_word = np.bincount(word_at, minlength=len(vocab))
    starts = np.searchsorted(word_at, np.arange(len(vocab)))
    win_of = np.repeat(np.arange(len(win_doc)), lengths.astype(int))
    n_win, n_doc, n_voc = len(win_doc), len(texts), len(vocab)
    rng = np.random.default_rng(seed)
    fit_doc = rng.random(n_doc) >= 0.2  # the rest calibrates
    if len(set(y[fit_doc].tolist())) < 2 or len(set(y[~fit_doc].tolist())) < 2:
        fit_doc[:] = True
    # start: every bucket's smoothed log-odds over the documents that have it, along one direction
    doc_word = np.unique(win_doc[win_of] * n_voc + tok)
    d_of, w_of = doc_word // n_voc, doc_word % n_voc
    use = fit_doc[d_of]
    reach = [np.bincount(flat, np.repeat(np.bincount(w_of[use & (y[d_of] == c)], minlength=n_voc), per_word), BUCKETS) for c in (0, 1)]
    total = [max(1, (y[fit_doc] == c).sum()) for c in (0, 1)]
    odds = np.log((reach[1] + SMOOTH * total[1] / sum(total)) / total[1]) - np.log((reach[0] + SMOOTH * total[0] / sum(total)) / total[0])
    out = rng.normal(0, 0.1, (2, dim))
    out[:, 0] = -1, 1
    emb, bias = rng.normal(0, 0.01, (BUCKETS, dim)), np.zeros(2)
    emb[:, 0] += odds
    doc_len = np.maximum(np.bincount(win_doc, lengths, n_doc), 1)
    first_win = np.searchsorted(win_doc, np.arange(n_doc))
    w_doc = np.where(fit_doc, np.where(y == 1, 0.5 / total[1], 0.5 / total[0]), 0.0)
    rate, last = np.array([RATE, 0.05, 0.5]), np.inf
    for step in range(1, steps + 1):
        words = np.add.reduceat(emb[flat], starts, axis=0) / per_word[:, None]
        share = words @ (out[1] - out[0])
        win_sum = np.bincount(win_of, share[tok], n_win)
        if step <= steps // 3:  # whole documents
            z = np.bincount(win_doc, win_sum, n_doc) / doc_len
            active, weight = np.ones(n_win, bool), 1 / doc_len[win_doc]
        else:  # each document's worst window
            mean = win_sum / np.maximum(lengths, 1)
            z = np.maximum.reduceat(mean, first_win)
            active = mean == z[win_doc]
            weight = 1 / np.maximum(lengths, 1)
        z = z + bias[1] - bias[0]
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss = float((w_doc * np.logaddexp(0, np.where(y == 1, -z, z))).sum())
        rate *= 1.1 if loss <= last else 0.7
        last = loss if step != steps // 3 else np.inf
        g_doc = (p - y) * w_doc
        g_win = np.where(active, g_doc[win_doc] * weight, 0.0)
        g_diff = np.bincount(tok, g_win[win_of], n_voc)
        g_words = (g_diff / per_word)[:, None] * (out[1] - out[0])
        g_emb = np.stack([np.bincount(flat, g_words[word_at, k], BUCKETS) for k in range(dim)], 1)
        g_out = g_diff @ words
        # plain steps: a rare bucket moves as little as its evidence, unlike under per-weight scaling
        emb -= rate[0] * g_emb
        out -= rate[1] * np.stack([-g_out, g_out])
        bias -= rate[2] * np.array([-g_doc.sum(), g_doc.sum()])
    model = SubwordModel(emb @ (out[1] - out[0]), float(bias[1] - bias[0]))
    held = ~fit_doc if (~fit_doc).any() else fit_doc
    z = np.concatenate([model.logits(part) for part in slices([t for t, h in zip(texts, held) if h])])
    model.scale, model.shift = calibrate(z, y[held], positives)
    return model


def calibrate(z: np.ndarray, y: np.ndarray, positives: float) -> tuple[float, float]:
    """Scale and shift of the logit, by logistic regression with the classes weighted to their share."""
    share = float(np.clip(positives, 0.01, 0.99))
    w = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    sd = z.std() + 1e-6
    x = np.stack([(z - z.mean()) / sd, np.ones_like(z)], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps with a ridge, so separable classes stay finite
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        grad = x.T @ (w * (p - y)) + np.array([1e-4, 0]) * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag([1e-4, 1e-6])
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -1, 1)
    beta[0] = max(beta[0], 0.05)  # a higher logit never means a lower score
    return float(beta[0] / sd), float(beta[1] - beta[0] * z.mean() / sd)


def fit(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2, per_class: int = 1000) -> SubwordModel:
    """Learn from at most ``2 * per_class`` labelled documents (a documented bound)."""
    rows, counts = labelled_sample(docs, labels, "toxic", mod, held, per_class)
    got = sorted((r["_id"], r["text"], r["y"]) for r in rows.collect())
    total = sum(counts.values())
    return train([t for _, t, _ in got], [y for _, _, y in got], counts.get(1, 0) / total if total else 0.0)


def score(docs: DataFrame, model: SubwordModel, threshold: float = 0.3, mod: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    @F.pandas_udf("double")
    def toxic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(model.scores(s), dtype=float)

    rows = docs.select("doc_id", (id_bucket("doc_id", mod) == held).alias("held_out"), toxic(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
