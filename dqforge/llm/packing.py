"""Packing of tokenized documents into fixed windows: bounded-space online best fit.

Each task keeps at most ``OPEN`` open windows.  A document's full windows are emitted as they are; the
rest goes into the open window that it fills best.  When none fits, the fullest window is topped up
with a cut of the piece and emitted, and what remains opens a window.  At the end of a task its open
windows are merged into full ones, and the one that may be left over goes to a merge of leftovers:
``FAN_IN`` tasks' leftovers at a time, as many rounds as it takes, until one is left in all.

A piece is a row (document, start, length, sequence, offset); tokens are moved only if asked for.
White space ends every token of this vocabulary, so a task encodes each distinct run of other
characters once (bounded memo) and a document is a concatenation.

Defined results: a null text counts as empty; an empty text is the end token alone; every row of the
table is packed, repeated rows too; a null doc_id stays null; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import Memo, per_process, slices, stored, tidy, vocabulary

WINDOW, OPEN, FAN_IN = 2048, 64, 512
#: Plain runs whose ids a task remembers.
MARKED = 200_000
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "task", "ids"]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, task long, ids binary"


#: Lines of letters with a mark at most, or any other line.
_LINES = re.compile(r"^([A-Za-z]+)([.,]?)$|^(.*)$", re.M)


def plain(run: str) -> tuple[str, str]:
    """A run without its case and without one full stop or comma behind a letter, where that can't
    change the tokens; and that mark."""
    if "<|" in run:  # control strings count as written
        return run, ""
    mark = run[-1:] if len(run) > 1 and run[-1] in ".," and run[-2].isalpha() and run[-2] != "\u0130" else ""
    core = run[:-1] if mark else run
    return (core.lower() if core.isascii() or (max(core) < "\u0250" and "\u0130" not in core) else core), mark


def plain_runs(runs: list[str]) -> list[tuple[str, str]]:
    """:func:`plain` of many runs (which have no line break), those of ASCII letters told by one search over all."""
    return [(letters.lower(), mark) if letters else plain(other) for letters, mark, other in _LINES.findall("\n".join(runs))] if runs else []


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocab: str, end: int):
        self.vocab, self.end, self.memo = vocab, np.uint32(end).tobytes(), None

    def _load(self) -> Memo:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        tokenizer = Tokenizer.from_file(vocabulary(self.vocab))
        # of letters in lower case below U+0250 normalizing changes nothing and a run is one word, which
        # ends at a token with the end mark: many runs go through one call
        letters = Tokenizer.from_file(vocabulary(self.vocab))
        letters.normalizer = normalizers.Sequence([])
        letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        names = tokenizer.get_vocab()
        closes = np.zeros(max(names.values()) + 1, bool)
        closes[[i for t, i in names.items() if t.endswith("</w>")]] = True
        values: dict[str, bytes] = {}

        def words(cores: list[str]) -> None:
            for k in range(0, len(cores), 4096):
                part = cores[k:k + 4096]
                ids = np.array(letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")  # without offsets
                ends = ((np.flatnonzero(closes[ids]) + 1) * 4).tolist()
                raw = ids.tobytes()
                values.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends)], strict=True))

        def others(cores: list[str]) -> None:
            values.update(zip(cores, (np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch_fast(cores, add_special_tokens=False))))

        marks = {m: np.array(tokenizer.encode(m, add_special_tokens=False).ids, "<u4").tobytes() for m in (".", ",", "")}

        def ids(runs: list[str]) -> list[bytes]:
            """Ids of runs.  The vocabulary is lower case and cuts between a letter and a mark, so case and
            one mark at the end are taken off first: such runs share one call."""
            parts = plain_runs(runs)
            if len(values) > MARKED:
                values.clear()
            new = {c for c, _ in parts}.difference(values)
            simple = [c for c in new if c.isalpha() and c.islower() and (c.isascii() or max(c) < "\u0250")]
            words(simple)
            others(list(new.difference(simple)))
            return [values[c] + marks[m] if m else values[c] for c, m in parts]

        return Memo(ids, 200_000)

    def encode(self, texts) -> Iterator[bytes]:
        if self.memo is None:
            self.memo = per_process(("ids", self.vocab), self._load)
        for part in slices(texts, 1 << 22):
            # only these three: other white space stays inside a run, where the tokenizer deals with it
            lists = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in part]
            self.memo.lookup(lists)
            values = self.memo.values
            for runs in lists:  # all runs of a text are fetched by one call
                yield (b"".join(itemgetter(*runs)(values)) if len(runs) > 1 else values[runs[0]]) + self.end


class Packer:
    """Bounded-space best fit over pieces; emits finished windows as lists of pieces."""

    def __init__(self):
        self.open: list[list] = []  # [used, pieces]

    @staticmethod
    def cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
        doc, start, length, total, ids = piece
        return (doc, start, at, total, ids[:4 * at]), (doc, start + at, length - at, total, ids[4 * at:])

    def add(self, piece: tuple) -> Iterator[list]:
        while piece[2] > WINDOW:
            full, piece = self.cut(piece, WINDOW)
            yield [full]
        size = piece[2]
        if size == WINDOW:
            yield [piece]
            return
        fits = [w for w in self.open if w[0] + size <= WINDOW]
        if fits:
            best = max(fits, key=lambda w: w[0])
        elif len(self.open) < OPEN:
            best = [0, []]
            self.open.append(best)
        else:
            fullest = max(self.open, key=lambda w: w[0])
            head, piece = self.cut(piece, WINDOW - fullest[0])
            fullest[1].append(head)
            self.open.remove(fullest)
            yield fullest[1]
            best = [0, []]
            self.open.append(best)
        best[0] += piece[2]
        best[1].append(piece)
        if best[0] == WINDOW:
            self.open.remove(best)
            yield best[1]

    def merge(self) -> Iterator[list]:
        """Full windows out of the open ones: the fullest keep their pieces, the least full are poured into them."""
        left = sorted(self.open, key=lambda w: -w[0])
        self.open = []
        while len(left) > 1:
            into, last = left[0], left[-1]
            piece = last[1].pop()
            room = WINDOW - into[0]
            if piece[2] > room:
                head, piece = self.cut(piece, room)
                last[1].append(piece)
            else:
                head = piece
            last[0] -= head[2]
            into[0] += head[2]
            into[1].append(head)
            if into[0] == WINDOW:
                yield into[1]
                left.pop(0)
            if left and left[-1] is last and not last[1]:
                left.pop()
        self.open = left


def _rows(window: list, sequence: int | None, task: int, with_ids: bool) -> Iterator[tuple]:
    at = 0
    for doc, start, length, total, ids in window:
        yield (doc, start, length, zlib.crc32(ids), total, sequence, at, task, ids if with_ids or sequence is None else None)
        at += length


def _frames(windows: Iterator[tuple[list, int | None]], task: int, with_ids: bool) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    for window, sequence in windows:
        rows.extend(_rows(window, sequence, task, with_ids))
        if len(rows) >= 4000:
            yield _frame(rows)
            rows = []
    yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=COLUMNS)
    return out.astype({"doc_id": "Int64", "sequence_id": "Int64"})


def _pack(pieces: Iterator[tuple], base: int) -> Iterator[tuple[list, int | None]]:
    packer, n = Packer(), 0
    for piece in pieces:
        for window in packer.add(piece):
            yield window, base + n
            n += 1
    for window in packer.merge():
        yield window, base + n
        n += 1
    for _, window in packer.open:
        yield window, None  # left over


def _merging(level: int, last: bool, with_ids: bool):
    """The merge of one group of leftovers; the last one keeps its own leftover as a sequence."""
    def run(key, pdf):
        group = int(key[0])
        pdf = pdf.sort_values(["task", "offset"])
        pieces = ((None if pd.isna(d) else int(d), int(s), int(n), int(t), bytes(i))
                  for d, s, n, t, i in zip(pdf["doc_id"], pdf["start"], pdf["length"], pdf["doc_tokens"], pdf["ids"]))
        base = (level << 56) + (group << 32)
        windows = ((w, base + (1 << 31) if q is None and last else q) for w, q in _pack(pieces, base))
        return pd.concat(list(_frames(windows, group, with_ids)))

    return run


def pack(docs: DataFrame, vocab: str = "word_bpe_49k.json", end: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    encoder = Encoder(vocab, end)

    def first(batches):
        task = TaskContext.get().partitionId()

        def pieces():
            for pdf in batches:
                for doc, null, ids in zip(pdf["doc_id"], pdf["doc_id"].isna(), encoder.encode(pdf["text"])):
                    yield None if null else int(doc), 0, len(ids) // 4, len(ids) // 4, ids

        yield from _frames(_pack(pieces(), task << 32), task, with_ids)

    done = stored(docs.select("doc_id", "text").mapInPandas(tidy(first), SCHEMA), "packed")
    parts = [done.where("sequence_id IS NOT NULL")]
    level = 1
    while True:
        left = done.where("sequence_id IS NULL")
        tasks = left.agg(F.max("task").alias("m")).first()["m"]
        if tasks is None:
            break
        groups = int(tasks) // FAN_IN + 1

        # at most FAN_IN leftovers of less than a window each meet in a group
        done = stored(left.groupBy((F.col("task") / FAN_IN).cast("long").alias("g")).applyInPandas(_merging(level, groups == 1, with_ids), SCHEMA), "packed-left")
        parts.append(done.where("sequence_id IS NOT NULL"))
        if groups == 1:
            break
        level += 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("task") if with_ids else out.drop("task", "ids")
