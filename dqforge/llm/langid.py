"""Language identification by cross-parsing: the language whose text explains a document in the
fewest phrases wins.

For each language a suffix automaton of labelled text gives the longest match at any place.  A word
(with a space on either side, lower case) is parsed greedily: the longest string that occurs in the
language's text is one phrase, then the parse goes on behind it.  A document's phrases are the sum
over its words, so a task memoises them per word.  Phrases are normalised by the length parsed, and by
the logarithm of the length learned (a match grows with it), so a language with little text neither
cuts what the others learn nor loses to them for its shortness; see ``FLOOR_CHARS``.

Defined results: ``und`` with score 0 for a null text, a text without a letter (a character of
Unicode's letter categories), or when no labelled
text exists; ties go to the language first in alphabetical order; one row in, one row out; texts are
parsed whole; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Memo, id_bucket, slices

#: Characters per language that the automata are built from.
LEARN_CHARS = 60_000
#: Long documents are learned in pieces of this many characters, the first pieces of all before the second ones.
PIECE_CHARS = 6_000
#: The length of learned text below which the phrase rate isn't corrected further: so little text says
#: nothing of other words, and a full correction would give every document to its language.
FLOOR_CHARS = 1_000
_OUTER = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_WORDLIKE = re.compile(r"[^\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether a character of ``text`` is a letter; superscripts, fractions and number signs aren't."""
    return any(map(str.isalpha, (c for m in _WORDLIKE.finditer(text) for c in m.group())))


def automaton(text: str) -> list[dict[str, int]]:
    """The transitions of the suffix automaton of ``text``: a walk from state 0 exists exactly for the
    strings that occur in it."""
    step, link, size, last = [{}], [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def phrases(word: str, step: list[dict[str, int]]) -> int:
    """Greedy longest-match phrases of a word; a character that the text lacks is a phrase."""
    n, i = 0, 0
    end = len(word)
    while i < end:
        state, j = 0, i
        while j < end and (to := step[state].get(word[j])) is not None:
            state, j = to, j + 1
        n += 1
        i = max(j, i + 1)
    return n


def words_of(text: str) -> str:
    """Text as the automata see it: lower-case words, a space on either side."""
    words = (_OUTER.sub("", w) for w in text.lower().split())
    return " ".join(["", *[w for w in words if w], ""])


class CrossParser:
    """Text by language; automata and the memo of phrase counts are built where they are used."""

    def __init__(self, texts: dict[str, str]):
        self.texts, self.langs, self.memo = texts, sorted(texts), None
        known = np.log([max(len(texts[k]), FLOOR_CHARS) for k in self.langs])
        self.weight = known / known.max(initial=1)

    def __getstate__(self):
        return {**self.__dict__, "memo": None}

    def _counter(self):
        steps = [automaton(self.texts[k]) for k in self.langs]

        def counts(words: list[str]) -> list[int]:
            """Of each word: the length parsed and the phrases by language, in 32-bit fields of one number."""
            out = []
            for word in words:
                w, v = _OUTER.sub("", word.lower()), 0
                if w:
                    w, v = f" {w} ", len(w) + 1
                    for k, s in enumerate(steps, 1):
                        v |= phrases(w, s) << (32 * k)
                out.append(v)
            return out

        return counts

    def predict(self, texts) -> list[tuple[str, float]]:
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        if self.memo is None:
            self.memo = Memo(self._counter())
        return [x for part in slices(texts) for x in self._slice(part)]

    def _slice(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        lists = [t.split() for t in texts]
        count = self.memo.lookup(lists)
        for text, words in zip(texts, lists):
            total = sum(map(count, words))
            length = total & 0xFFFFFFFF
            if not length or not has_letter(text):
                yield "und", 0.0
                continue
            rate = np.array([total >> (32 * k) & 0xFFFFFFFF for k in range(1, len(self.langs) + 1)]) / length * self.weight  # phrases a character
            best = int(np.argmin(rate))
            yield self.langs[best], float(1 / np.exp(-np.minimum((rate - rate[best]) * 40, 50)).sum())


def fit(docs: DataFrame, mod: int = 4, held: int = 2, per_lang: int = 120) -> CrossParser:
    """Learn from some ``2 * per_lang`` documents a language by the hash of their ids, in pieces (of a document
    longer than ``LEARN_CHARS`` a slice of that many characters), up to ``LEARN_CHARS`` characters a
    language (documented bounds)."""
    rows = (docs.select("doc_id", "lang", "text").where("lang IS NOT NULL AND length(text) > 0 AND doc_id IS NOT NULL")
            .where(id_bucket("doc_id", mod) != held))
    share = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # a row per language
    mine = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id"), F.col("n")) < 2 * per_lang)
    h = F.xxhash64("doc_id", F.lit(1))
    start = F.pmod(h, F.greatest(F.length("text") - (LEARN_CHARS - 1), F.lit(1))) + 1
    picked = mine.select("lang", h.alias("h"), "doc_id", F.substring("text", start.cast("int"), F.lit(LEARN_CHARS)).alias("text")).collect()
    pieces = sorted((r.lang, at, r.h, r.doc_id, r.text[at:at + PIECE_CHARS]) for r in picked for at in range(0, len(r.text), PIECE_CHARS))
    out: dict[str, str] = {}
    for lang, _, _, _, text in pieces:
        if len(out.get(lang, "")) < LEARN_CHARS:
            out[lang] = (out.get(lang, "") + words_of(text))[:LEARN_CHARS]
    return CrossParser({k: v for k, v in out.items() if v.strip()})


def identify(docs: DataFrame, model: CrossParser, mod: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    @F.pandas_udf("lang string, score double")
    def parsed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame(model.predict(s), columns=["lang", "score"])

    return (docs.select("doc_id", (id_bucket("doc_id", mod) == held).alias("held_out"), parsed(F.col("text")).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))
