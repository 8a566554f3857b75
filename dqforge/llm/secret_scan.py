"""Secret scans: fixed key patterns, and a token-efficiency test for random strings.

Text that people write costs a tokenizer few tokens; random strings cost one token for every one or
two characters.  Each long run of key characters with a letter, or what spans of the fixed kinds leave
of it, is encoded under a public tiktoken vocabulary; a run with fewer than ``ratio`` characters a token
is a secret of kind ``random``, unless it is a known digest (hex of a usual digest length), a UUID or an
identifier (readable words and numbers joined by ``_``, ``-``, ``.`` or ``/``).  Of a run that passes as
a whole, the stretches between its readable parts are tested in the same way.

Defined results: null and empty texts have no spans; texts are scanned whole; one row in, one row
out; spans are in code points, end exclusive; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import vocabulary

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_SEPARATOR = re.compile(r"[:=]")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # shorter runs fail anyway
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_DIGEST = re.compile(r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128})")
_SPLIT = re.compile(r"[^_./=+-]+")
_PART = re.compile(r"[A-Za-z]{2,}|[0-9]{1,10}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds, in order."""
    out = []
    if _SEPARATOR.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


class TokenTest:
    """Characters per token under a tiktoken vocabulary file."""

    def __init__(self, vocab: str, ratio: float):
        self.vocab, self.ratio, self.encoding = vocab, ratio, None

    def __getstate__(self):
        return {**self.__dict__, "encoding": None}

    def per_token(self, run: str) -> float:
        if self.encoding is None:
            import public_tokenizers
            import tiktoken

            with open(vocabulary(self.vocab), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return len(run) / max(1, len(self.encoding.encode_ordinary(run)))

    def readable(self, parts: list[str]) -> bool:
        """Words and numbers.  Letters, 16 or more in all, are words if the vocabulary knows them as they
        are or in lower case."""
        if not all(map(_PART.fullmatch, parts)):
            return False
        letters = [p for p in parts if p[0].isalpha()]
        n = sum(map(len, letters))
        if n < 16:
            return True
        return any(n >= self.ratio * sum(len(w) / self.per_token(w) for w in words) for words in (letters, [w.lower() for w in letters]))

    def secret(self, run: str) -> bool:
        core = run.strip("=.-_/+")
        if len(core) < 16 or not any(c.isalpha() for c in core):
            return False
        if _UUID.fullmatch(core) or _DIGEST.fullmatch(core) or self.readable(_SPLIT.findall(core)):
            return False
        return self.per_token(run) < self.ratio

    def secrets(self, run: str) -> Iterator[tuple[int, int]]:
        """Where secrets stand in a run: all of it, or stretches between its readable parts."""
        if self.secret(run):
            yield 0, len(run)
            return
        core = run.strip("=.-_/+")
        if len(core) < 16 or _UUID.fullmatch(core) or _DIGEST.fullmatch(core):
            return
        stretch: list[re.Match] = []
        for m in [*_SPLIT.finditer(run), None]:
            if m and not (_PART.fullmatch(m[0]) and self.readable([m[0]])) and (stretch or len(m[0]) > 3):
                stretch.append(m)
            elif stretch:
                a, b = stretch[0].start(), stretch[-1].end()
                if b - a < len(run) and self.secret(run[a:b]):
                    yield a, b
                else:
                    yield from ((x.start(), x.end()) for x in stretch if len(stretch) > 1 and self.secret(x[0]))
                stretch = []


def spans(text: str | None, test: TokenTest) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind, end), by start and then kind."""
    if not text:
        return []
    found = base_spans(text)
    starts, reach = [a for a, _, _ in found], list(accumulate((e for _, _, e in found), max))
    for m in _RUN.finditer(text):
        a, b = m.span()
        rest, k = [], max(0, bisect_right(reach, a))  # fixed spans that end behind the run's start
        while k < len(starts) and starts[k] < b:
            if starts[k] > a:
                rest.append((a, starts[k]))
            a, k = max(a, reach[k]), k + 1
        if a < b:
            rest.append((a, b))
        found += [(x + i, 3, x + j) for x, y in rest if y - x >= 16 for i, j in test.secrets(text[x:y])]
    return sorted(found)


def scan(docs: DataFrame, vocab: str = "byte_bpe_50k.tiktoken", ratio: float = 2.2) -> DataFrame:
    """doc_id and ``spans``: an array of (kind, start, end) of every document."""
    test = TokenTest(vocab, ratio)

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t, test)] for t in s], dtype=object)

    return docs.select("doc_id", found(F.col("text")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest columns of ``scan``'s rows."""
    base = F.filter("spans", lambda x: x["kind"] != "random")
    line = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
