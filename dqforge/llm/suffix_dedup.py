"""Repeated passages across documents, found with run-length compressed suffix indexes.

Every byte of a document that a ``length``-byte string covers which also starts in a document with a
smaller id is a repeat.  Three steps, none of which holds more than a slice of the texts in a task:

1. *Anchors.*  The smallest hash of the ``ANCHOR``-byte strings inside a ``length``-byte window names the
   window, so equal windows have equal names.  Names that occur only once in the corpus are left out.
2. *Index.*  Windows with a shared name, joined to pieces of up to ``2 * length - ANCHOR`` bytes, are dealt
   by that name; a name found very often is first split by longer anchors, which deal its windows by more of what
   stands around them.  Each share is indexed: suffix order, run-length Burrows-Wheeler transform, suffix array
   samples at both ends of every run, and the first document of each group of suffixes that agree on
   ``length`` bytes.  All pieces are streamed through the index at once, from right to left; where the
   transform doesn't continue with a piece's next byte, the nearer of the two neighbouring run ends with
   that byte (the longer common extension) is taken.  A match of ``length`` bytes looks up its first document.
3. *Documents.*  Windows whose first document is smaller than their own are put together per document.

Defined results: a null text counts as empty; a null id sorts after every id (such documents never make
others lose bytes, and lose what any document with an id has); rows with the same id and text have the same
result and are all returned; documents with one id don't make each other lose bytes; a text shorter than
``length`` bytes keeps everything.  Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored

#: Bytes whose hash names a window; bits of that hash that are dealt out (a chance equality costs work only).
ANCHOR, NAME_BITS = 20, 42
#: Text of a slice of documents, of a scan's parcels, of a block of windows and of one index, in bytes.
SLICE_BYTES, PARCEL_BYTES, BLOCK, INDEX_BYTES = 8 << 20, 24 << 20, 1 << 16, 400_000
#: Runs of frequent names that are split at once.
SPLIT = 1 << 14
#: Up to so much times ``SLICE_BYTES`` (from ``GROWING`` bytes of text on): there is a value for each slice and share.
SLICE_GROWTH, GROWING = 2, 1 << 30
#: Names found in more slices than this, counted in each task's list, are split by longer anchors before they are dealt.
HOT_SLICES = 1 << 16
#: Sorts after every id.
NO_ID = np.iinfo(np.int64).max

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# -- windows and their names ------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def _string_hashes(a: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each ``k``-byte string of ``a``, by doubling."""
    with np.errstate(over="ignore"):
        part, size, power = a.astype(np.uint64) + np.uint64(1), 1, _ODD
        out, done = None, 0
        while True:
            if k & size:
                if out is None:
                    out, done = part, size
                else:
                    n = len(a) - done - size + 1
                    out, done = out[:n] * power + part[done:done + n], done + size
            if done == k:
                return _mix(out)
            n = len(part) - size
            part = part[:n] * power + part[size:size + n]
            size, power = size * 2, power * power


def _smallest(h: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every ``w`` consecutive values."""
    size = 1
    n = len(h) - w + 1
    while size * 2 <= w:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:n], h[w - size:w - size + n])


def _longer(anchor: int, length: int) -> int:
    """The anchor that splits the windows of one with ``anchor`` bytes: half of what it leaves of a window is added."""
    return anchor + (length - anchor + 1) // 2


def named_runs(a: np.ndarray, bounds: np.ndarray, length: int, anchor: int = ANCHOR):
    """Blocks of runs of windows with one name: name, first window, number of windows (of the bytes ``a`` of
    texts that begin and end at ``bounds``).  No window crosses a text's end; runs are cut at ``length -
    anchor + 1`` windows."""
    k = min(anchor, length)
    w = length - k + 1
    for lo in range(0, len(a) - length + 1, BLOCK):
        part = a[lo:lo + BLOCK + length - 1]
        low = _mix(_smallest(_string_hashes(part, k), w) ^ _ODD) >> np.uint64(64 - NAME_BITS)  # smallest values are all low: mixed again
        near = bounds[np.searchsorted(bounds, lo, "right"):np.searchsorted(bounds, lo + len(part), "right")] - lo
        ok = np.ones(len(low), bool)
        for e in near.tolist():
            ok[max(e - length + 1, 0):e] = False
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | ~ok[:-1]
        first = np.flatnonzero(ok & new)
        if not len(first):
            continue
        stop = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True)) + 1
        size = stop - first
        if (size > w).any():
            parts = -(-size // w)
            at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            first, stop = np.repeat(first, parts) + at * w, np.repeat(stop, parts)
            size = np.minimum(stop - first, w)
        yield low[first], first + lo, size


# -- parcels of documents ---------------------------------------------------------------------------

def _packed(**arrays) -> bytes:
    """Arrays of numbers or bytes as one compressed value."""
    head, parts = [], []
    for name, x in arrays.items():
        raw = x if isinstance(x, bytes) else x.tobytes()
        head.append(f"{name}:{'S' if isinstance(x, bytes) else x.dtype.str}:{len(raw)}")
        parts.append(raw)
    top = ",".join(head).encode()
    body = len(top).to_bytes(4, "little") + top + b"".join(parts)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _unpacked(blob: bytes) -> dict:
    body = memoryview(pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd"))
    top = int.from_bytes(body[:4], "little")
    at, out = 4 + top, {}
    for field in bytes(body[4:at]).decode().split(","):
        name, kind, n = field.split(":")
        out[name] = body[at:at + int(n)] if kind == "S" else np.frombuffer(body[at:at + int(n)], np.dtype(kind))
        at += int(n)
    return out


def _documents(batch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Slices, ids and texts of a batch's rows."""
    slices = batch.column("slice").to_numpy(zero_copy_only=False)
    ids = batch.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    return slices, ids, batch.column("text").cast(pa.large_binary()).to_pylist()


def _parcels(batches):
    """Rows (slice, parcel): the documents of a task, put together by slice; equal rows are counted."""
    kept, size = {}, 0

    def flush():
        by_slice: dict[int, list] = {}
        for (s, i, t), n in kept.items():
            by_slice.setdefault(s, []).append((i, n, t))
        rows = []
        for s, docs in by_slice.items():
            ids, counts, texts = zip(*docs)
            rows.append((s, _packed(ids=np.array(ids, np.int64), counts=np.array(counts, np.int64),
                                    sizes=np.array([len(t) for t in texts], np.int64), text=b"".join(texts))))
        return _blob_batch(rows, "slice")

    for batch in batches:
        for s, i, t in zip(*(x if isinstance(x, list) else x.tolist() for x in _documents(batch))):
            if (s, i, t) not in kept:
                size += len(t) + 100
            kept[s, i, t] = kept.get((s, i, t), 0) + 1
            if size > PARCEL_BYTES:
                yield flush()
                kept, size = {}, 0
    if kept:
        yield flush()


def _blob_batch(rows: list[tuple[int, bytes]], key: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=[key, "blob"])


def _blob_table(rows: list[tuple[int, bytes]], key: str) -> pa.Table:
    return pa.Table.from_batches([_blob_batch(rows, key)])


def _slice_documents(table: pa.Table) -> list[tuple[int, bytes, int]]:
    """(id, text, rows) of a slice, each pair of id and text once, in the same order on every call."""
    found: dict[tuple[int, bytes], int] = {}
    for blob in table.column("blob").to_pylist():
        p = _unpacked(blob)
        at = 0
        for i, n, size in zip(p["ids"].tolist(), p["counts"].tolist(), p["sizes"].tolist()):
            doc = i, bytes(p["text"][at:at + size])
            found[doc] = found.get(doc, 0) + n
            at += size
    return [(i, t, found[i, t]) for i, t in sorted(found)]


# -- names that occur more than once ----------------------------------------------------------------

#: A name's place in a task's list: the name, a slice's number (21 bits) and whether several texts of the slice have it.
_SLICE_BITS = 21


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)  # np.unique hashes integers, which is slower
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _planes(x: np.ndarray) -> bytes:
    """Differences of ascending numbers, byte planes one after another: most are zero."""
    d = np.diff(x, prepend=np.uint64(0))
    return _packed(d=np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).reshape(-1))


def _unplanes(blob: bytes) -> np.ndarray:
    d = _unpacked(blob)["d"].reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(d.T).reshape(-1).view(np.uint64), dtype=np.uint64)


def _name_lists(length: int, shares: int):
    """mapInArrow function: rows (share, list of the names in a task's documents)."""
    def lists(batches):
        names, docs, slices, size = [], [], [], 0

        def flush():
            if not names:
                return
            place = np.array(slices, np.int64)
            order = np.argsort(place, kind="stable")
            rank = np.empty(len(order), np.uint64)
            rank[order] = np.arange(len(order), dtype=np.uint64)
            x = _distinct(np.concatenate(names) << np.uint64(64 - NAME_BITS) | rank[np.concatenate(docs)])
            name, own = x >> np.uint64(64 - NAME_BITS), place[order][(x & np.uint64((1 << 64 - NAME_BITS) - 1)).astype(np.int64)]
            new = np.ones(len(x), bool)
            new[1:] = (name[1:] != name[:-1]) | (own[1:] != own[:-1])
            at = np.flatnonzero(new)
            several = np.diff(np.append(at, len(x))) > 1
            entries = name[at] << np.uint64(_SLICE_BITS + 1) | own[at].astype(np.uint64) << np.uint64(1) | several.astype(np.uint64)
            cuts = np.searchsorted(name[at], np.array([-(-(i << NAME_BITS) // shares) for i in range(shares + 1)], np.uint64))
            yield _blob_batch([(i, _planes(entries[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a], "share")

        for batch in batches:
            own, _, texts = _documents(batch)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            for name, first, _ in named_runs(np.frombuffer(b"".join(texts), np.uint8), bounds, length):
                names.append(name)
                docs.append(np.searchsorted(bounds, first, "right") - 1 + len(slices))
                size += len(name)
            slices.extend(own.tolist())
            if size > 2_000_000 or len(slices) > 1 << 20:
                yield from flush()
                names, docs, slices, size = [], [], [], 0
        yield from flush()
    return lists


def _shared_names(hot: int):
    """applyInArrow function on a share: rows (slice, names that another text has as well, and which are frequent)."""
    def shared(table):
        x = np.sort(np.concatenate([_unplanes(b) for b in table.column("blob").to_pylist()]))
        name = x >> np.uint64(_SLICE_BITS + 1)
        at = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        size = np.diff(np.append(at, len(x)))
        keep = np.repeat((size > 1) | np.bitwise_or.reduceat(x & np.uint64(1), at).astype(bool), size)
        frequent = np.repeat(size > hot, size)[keep].astype(np.uint64)
        x, name = x[keep], name[keep]
        own = x >> np.uint64(1) & np.uint64((1 << _SLICE_BITS) - 1)
        y = _distinct(own << np.uint64(NAME_BITS + 1) | name << np.uint64(1) | frequent)
        own = y >> np.uint64(NAME_BITS + 1)
        cuts = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(y)) if len(y) else np.zeros(1, int)
        low = y & np.uint64((1 << NAME_BITS + 1) - 1)
        return _blob_table([(int(own[a]), _planes(low[a:b])) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], "slice")
    return shared


# -- pieces -----------------------------------------------------------------------------------------

def _laid_out(first: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of strings that begin at ``first``, one after another, and where each begins and ends there."""
    ends = np.append(0, np.cumsum(width))
    return np.repeat(first - ends[:-1], width) + np.arange(ends[-1]), ends


def _pieces(length: int, shares: int):
    """cogroup function on a slice's documents and its shared names: rows (share, pieces).  Equal pieces of a slice are one."""
    def pieces(texts, names):
        docs = _slice_documents(texts)
        if not docs or not names.num_rows:
            return _blob_table([], "share")
        known = np.sort(np.concatenate([_unplanes(b) for b in names.column("blob").to_pylist()]))
        known, frequent = known >> np.uint64(1), (known & np.uint64(1)).astype(bool)
        raw = b"".join(t for _, t, _ in docs)
        a, bounds = np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum([len(t) for _, t, _ in docs])]).astype(np.int64)
        runs = []
        for name, first, size in named_runs(a, bounds, length):
            at = np.minimum(np.searchsorted(known, name), len(known) - 1)
            keep = np.flatnonzero(known[at] == name)
            runs.append((name[keep].astype(np.int64), first[keep], size[keep], frequent[at[keep]]))
        if not sum(len(r[0]) for r in runs):
            return _blob_table([], "share")
        name, first, size, often = (np.concatenate(x) for x in zip(*runs))
        if often.any():
            split, of = [(name[~often], first[~often], size[~often])], np.flatnonzero(often)
            for lo in range(0, len(of), SPLIT):
                own = of[lo:lo + SPLIT]
                at, ends = _laid_out(first[own], size[own] + length - 1)
                split.extend((n.astype(np.int64), at[f], k) for n, f, k in named_runs(a[at], ends, length, _longer(min(ANCHOR, length), length)))
            name, first, size = (np.concatenate(x) for x in zip(*split))
        # equal pieces, looked for among those with one name only
        order = np.argsort(name, kind="stable")
        name, first, size = name[order], first[order], size[order] + length - 1
        alike = np.append(False, name[1:] == name[:-1])
        piece = np.arange(len(name))
        known_text: dict[tuple[int, bytes], int] = {}
        for i in np.flatnonzero(alike | np.append(alike[1:], False)).tolist():
            piece[i] = known_text.setdefault((int(name[i]), raw[first[i]:first[i] + size[i]]), i)
        order = np.argsort(piece, kind="stable")
        name, first, size, piece = name[order], first[order], size[order], piece[order]
        doc = np.searchsorted(bounds, first, "right") - 1
        ids, starts = np.array([i for i, _, _ in docs], np.int64)[doc], first - bounds[doc]
        lead = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        places = np.diff(np.append(lead, len(piece)))
        share = name[lead] * shares >> NAME_BITS
        own, rows = np.array([texts.column("slice")[0].as_py()], np.int64), []
        cuts = np.append(np.flatnonzero(np.append(True, share[1:] != share[:-1])), len(lead))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            k, one = lead[lo:hi], slice(int(lead[lo]), int(lead[hi]) if hi < len(lead) else len(piece))
            width = size[k]
            text = a[_laid_out(first[k], width)[0]]
            rows.append((int(share[lo]), _packed(names=name[k], sizes=width.astype(np.uint16), text=text.tobytes(), places=places[lo:hi],
                                                 ids=ids[one], rows=doc[one], starts=starts[one], slice=own)))
        return _blob_table(rows, "share")
    return pieces


# -- the index --------------------------------------------------------------------------------------

def _bytes(pieces: list[bytes]) -> np.ndarray:
    """The bytes of all pieces; 255, which UTF-8 doesn't have, in place of 0."""
    t = np.frombuffer(b"".join(pieces), np.uint8).copy()
    t[t == 0] = 255
    return t


class RunIndex:
    """A run-length compressed Burrows-Wheeler index of pieces of text, each ended by a mark of its own.

    ``owners`` (one number a piece) gives ``first_owner``: the smallest owner among all suffixes that agree
    with a matched one on ``length`` bytes."""

    #: Bits of a text position, and bytes ordered by the first sort.
    BITS, FIRST = 21, 5

    def __init__(self, pieces: list[bytes], owners: np.ndarray, length: int):
        t = np.insert(_bytes(pieces), np.cumsum([len(p) for p in pieces]), 0)
        n = len(t)
        if n >= 1 << self.BITS:
            raise ValueError("too much text for one index")
        self.text, self.length = t, length
        order, same = self._suffix_order(t, length)
        before = t[order - 1]
        starts = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.starts, self.heads = starts, before[starts].astype(np.int64)
        self.ends = np.append(starts[1:], n) - 1
        sizes = self.ends - starts + 1
        self.run_of = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
        self.by_head = np.argsort(self.heads, kind="stable")  # runs by their byte: the columns of the first column of the matrix
        self.keys = self.heads[self.by_head] * len(starts) + self.by_head
        to = np.empty(len(starts), np.int64)
        to[self.by_head] = np.cumsum(sizes[self.by_head]) - sizes[self.by_head]
        self.shift = to - starts
        self.first_sample, self.last_sample = order[starts], order[self.ends]
        owner = np.repeat(owners, np.diff(np.flatnonzero(np.append(0, t) == 0)))[order]
        groups = np.flatnonzero(~np.append(False, same))
        self.owner_of = np.repeat(np.minimum.reduceat(owner, groups), np.diff(np.append(groups, n)))
        self.words = self._words(t, "<u8").astype(np.uint64)

    @staticmethod
    def _words(t: np.ndarray, kind: str) -> np.ndarray:
        """The eight bytes from each place on, as one number (zeros after the end)."""
        return np.ndarray(len(t), kind, np.append(t, np.zeros(8, np.uint8)), strides=(1,))

    def _suffix_order(self, t: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes in order (end marks by their place), and which agree with the one before on ``length`` bytes."""
        n, bits = len(t), self.BITS
        mask = np.int64((1 << bits) - 1)
        key = (self._words(t, ">u8") >> np.uint64(64 - 8 * self.FIRST)).astype(np.int64)
        marks, alive = np.flatnonzero(t == 0), np.ones(n, bool)
        for i in range(self.FIRST):  # what follows an end mark doesn't count
            at = marks[marks >= i] - i
            key[at] &= ~((1 << 8 * (self.FIRST - i)) - 1)
            alive[at] = False
        key <<= bits
        key |= np.arange(n)
        key.sort()
        order = key & mask
        key >>= bits
        new = np.append(True, (key[1:] != key[:-1]) | ~alive[order[1:]])
        rank = np.zeros(n + length, np.int64)  # where the suffixes begin that agree with a suffix on `known` bytes
        first = np.flatnonzero(new)
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        known, of_length = self.FIRST, None
        while True:
            open_ = ~new
            open_[:-1] |= open_[1:]
            places = np.flatnonzero(open_)
            if of_length is None and (known * 2 > length or not len(places)):
                of_length, reach = rank[:n].copy(), min(known, length)
            if not len(places):
                break
            at = np.zeros(n, bool)
            at[order[places]] = True
            at = np.flatnonzero(at)
            x = rank[at] << 2 * bits
            x |= rank[np.minimum(at + known, n)] << bits
            x |= at
            x.sort()
            order[places] = at = x & mask
            x >>= bits
            apart = np.append(True, x[1:] != x[:-1])
            new[places] = apart
            first = np.flatnonzero(apart)
            rank[at] = np.repeat(places[first], np.diff(np.append(first, len(at))))
            known *= 2
        tail = np.append(of_length[length - reach:], np.full(min(length - reach, n), -1))
        same = (of_length[order[1:]] == of_length[order[:-1]]) & (tail[order[1:]] == tail[order[:-1]])
        return order, same

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the text at ``a`` and at ``b``, ``most`` at most."""
        out = np.zeros(len(a), np.int64)
        open_ = np.flatnonzero(most > 0)
        n = len(self.text)
        while len(open_):
            at = out[open_]
            d = self.words[np.minimum(a[open_] + at, n - 1)] ^ self.words[np.minimum(b[open_] + at, n - 1)]
            low = d & (~d + np.uint64(1))
            equal = np.where(d == 0, 8, (np.log2(low.astype(np.float64) + (d == 0)) / 8).astype(np.int64))
            out[open_] = np.minimum(at + equal, most[open_])
            open_ = open_[(equal == 8) & (out[open_] < most[open_])]
        return out

    def stream(self, pieces: list[bytes]):
        """Matching statistics of all pieces at once, right to left: for each byte from the last, which pieces have it (the
        first of those given, longest first), how long the match is that begins there, and its first owner (``NO_ID`` where no
        match can have ``length`` bytes)."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        if (np.diff(sizes) > 0).any():
            raise ValueError("pieces must come longest first")
        ends = np.cumsum(sizes)
        chars = _bytes(pieces).astype(np.int64)
        runs = len(self.starts)
        q, pos, size = np.zeros(len(pieces), np.int64), np.full(len(pieces), self.first_sample[0]), np.zeros(len(pieces), np.int64)
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            m = int(np.searchsorted(-sizes, -back, "right"))
            c = chars[ends[:m] - back]
            j = self.run_of[q[:m]].astype(np.int64)
            miss = np.flatnonzero(self.heads[j] != c)
            if len(miss):
                cm, jm = c[miss], j[miss]
                p = np.searchsorted(self.keys, cm * runs + jm)
                down, up = self.by_head[np.minimum(p, runs - 1)], self.by_head[np.maximum(p - 1, 0)]
                here, most = pos[miss], size[miss]
                is_down, is_up = (self.heads[down] == cm) & (p < runs), (self.heads[up] == cm) & (p > 0)
                by_down = self._common(here, self.first_sample[down], np.where(is_down, most, 0))
                by_up = self._common(here, self.last_sample[up], np.where(is_up, most, 0))
                take_up = is_up & (~is_down | (by_up > by_down))
                none = ~is_up & ~is_down
                j[miss] = np.where(take_up, up, down)
                q[miss] = np.where(take_up, self.ends[up], self.starts[down])
                pos[miss] = np.where(take_up, self.last_sample[up], self.first_sample[down])
                size[miss] = np.where(take_up, by_up, by_down)
                q[:m] += self.shift[j]
                pos[:m] -= 1
                size[:m] += 1
                lost = miss[none]
                q[lost], pos[lost], size[lost] = 0, self.first_sample[0], 0
            else:
                q[:m] += self.shift[j]
                pos[:m] -= 1
                size[:m] += 1
            yield back, m, size[:m], self.owner_of[q[:m]] if back >= self.length else np.full(m, NO_ID)


def _first_owners(pieces: list[bytes], owners: np.ndarray, length: int) -> np.ndarray:
    """The smallest owner of a piece with each window of each piece (longest first), by matching statistics: a column a piece,
    its last window first; ``NO_ID`` where nothing else is known."""
    index = RunIndex(pieces, owners, length)
    out = np.full((len(pieces[0]) - length + 1, len(pieces)), NO_ID)
    for back, m, size, owner in index.stream(pieces):
        if back >= length:
            out[back - length, :m] = np.where(size >= length, owner, NO_ID)
    return out


def _marked(length: int, index_bytes: int):
    """applyInArrow function on a share's pieces: rows (slice, removed byte ranges of its documents)."""
    def marked(table):
        names, sizes, places, texts = [], [], [], []
        for blob in table.column("blob").to_pylist():
            p = _unpacked(blob)
            names.append(p["names"])
            sizes.append(p["sizes"])
            texts.append(p["text"])
            places.append((p["places"], p["ids"], p["rows"], p["starts"], np.full(len(p["ids"]), p["slice"][0])))
        if not names:
            return _blob_table([], "slice")
        of, name, pieces = _each_once(np.concatenate(names), b"".join(texts), np.concatenate(sizes).astype(np.int64))
        count, ids, rows, starts, own = (np.concatenate(x) for x in zip(*places))
        del places, texts
        of = np.repeat(of, count)
        owners = np.full(len(pieces), NO_ID)
        np.minimum.at(owners, of, ids)
        low, high, at, firsts = _firsts(name, pieces, owners, length, index_bytes)
        width = np.array([len(t) for t in pieces], np.int64)[of]
        whole = np.flatnonzero(ids > high[of])
        found = [(own[whole], rows[whole], starts[whole], starts[whole] + width[whole])]
        part = np.flatnonzero((ids > low[of]) & (ids <= high[of]))
        for lo in range(0, len(part), SPLIT):  # runs of windows that a document with a smaller id has
            i = part[lo:lo + SPLIT]
            at_, ends = _laid_out(at[of[i]], width[i] - length + 1)
            of_ = np.repeat(np.arange(len(i)), np.diff(ends))
            gone = firsts[at_] < ids[i][of_]
            new, last = gone.copy(), gone.copy()
            new[1:] &= ~gone[:-1] | (of_[1:] != of_[:-1])
            last[:-1] &= ~gone[1:] | (of_[1:] != of_[:-1])
            new, last = np.flatnonzero(new), np.flatnonzero(last)
            k = of_[new]
            found.append((own[i][k], rows[i][k], starts[i][k] + new - ends[k], starts[i][k] + last - ends[k] + length))
        own, rows, starts, stops = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(own, kind="stable")
        own, rows, starts, stops = own[order], rows[order], starts[order], stops[order]
        cuts = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(own)) if len(own) else np.zeros(1, int)
        return _blob_table([(int(own[a]), _packed(rows=rows[a:b], starts=starts[a:b], stops=stops[a:b])) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], "slice")
    return marked


def _each_once(names: np.ndarray, text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Which of the different pieces each piece is, their names and texts (equal texts have equal names)."""
    ends = np.append(0, np.cumsum(sizes))
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(text)]).dictionary_encode()
    of = found.indices.to_numpy().astype(np.int64)
    name = np.empty(len(found.dictionary), np.int64)
    name[of] = names
    return of, name, found.dictionary.to_pylist()


def _firsts(names: np.ndarray, pieces: list[bytes], owners: np.ndarray, length: int, index_bytes: int, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The least and the largest first owner of the windows of each piece; where they differ, the place of the first owners of
    its windows in the last array.  Pieces of one name (of ``anchor`` bytes) share an index; names are put together to about
    ``index_bytes``, and a name with more text than that is split by a longer anchor."""
    low, high, place, firsts, end = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [], 0
    sizes = np.array([len(t) for t in pieces], np.int64)
    order = np.argsort(names, kind="stable")
    cuts = np.append(np.flatnonzero(np.append(True, names[order][1:] != names[order][:-1])), len(order))
    ends = np.append(0, np.cumsum(sizes[order] + 1))[cuts]

    def keep(of: np.ndarray, first: np.ndarray, widths: np.ndarray):  # first owners, one piece after another
        nonlocal end
        at = np.append(0, np.cumsum(widths))
        low[of], high[of] = np.minimum.reduceat(first, at[:-1]), np.maximum.reduceat(first, at[:-1])
        apart = np.flatnonzero(low[of] < high[of])
        firsts.append(first[_laid_out(at[apart], widths[apart])[0]])
        place[of[apart]] = end + np.cumsum(widths[apart]) - widths[apart]
        end += len(firsts[-1])

    def index(of: np.ndarray):
        of = of[np.argsort(-sizes[of], kind="stable")]
        widths = sizes[of] - length + 1
        first = _first_owners([pieces[i] for i in of.tolist()], owners[of], length)
        keep(of, first.T[:, ::-1][np.arange(len(first))[::-1] < widths[:, None]], widths)

    lo = 0
    while lo < len(cuts) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + index_bytes, "right")) - 1)
        of = order[cuts[lo]:cuts[hi]]
        if ends[hi] - ends[lo] > index_bytes and anchor < length:
            keep(of, _split_firsts([pieces[i] for i in of.tolist()], owners[of], length, index_bytes, _longer(anchor, length)), sizes[of] - length + 1)
        else:
            index(of)
        lo = hi
    return low, high, place, np.concatenate([*firsts, np.zeros(0, np.int64)])


def _split_firsts(pieces: list[bytes], owners: np.ndarray, length: int, index_bytes: int, anchor: int) -> np.ndarray:
    """The first owners of the windows of each piece, found among windows with the same name of ``anchor`` bytes."""
    raw, bounds = b"".join(pieces), np.append(0, np.cumsum([len(p) for p in pieces]))
    a = np.frombuffer(raw, np.uint8)
    name, first, size = (np.concatenate(x) for x in zip(*named_runs(a, bounds, length, anchor)))
    of, name, texts = _each_once(name.astype(np.int64), a[_laid_out(first, size + length - 1)[0]].tobytes(), size + length - 1)
    least = np.full(len(texts), NO_ID)
    np.minimum.at(least, of, owners[np.searchsorted(bounds, first, "right") - 1])
    low, high, place, firsts = _firsts(name, texts, least, length, index_bytes, anchor)
    out = np.repeat(low[of], size)  # runs come in the order of their windows, of which each is in one run
    apart = (low < high)[of]
    out[np.repeat(apart, size)] = firsts[_laid_out(place[of[apart]], size[apart])[0]]
    return out


# -- documents --------------------------------------------------------------------------------------

_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, stop: long>>, kept_sha256 string"


def _cut(with_text: bool):
    """cogroup function on a slice's documents and their removed ranges: a row per document."""
    def cut(texts, marks):
        docs = _slice_documents(texts)
        spans: list[tuple[list, list]] = [([], [])] * len(docs)
        if marks.num_rows:
            parts = [_unpacked(b) for b in marks.column("blob").to_pylist()]
            rows, starts, stops = (np.concatenate([p[x] for p in parts]) for x in ("rows", "starts", "stops"))
            order = np.lexsort((starts, rows))
            rows, starts, stops = rows[order], starts[order], stops[order]
            cuts = np.append(np.flatnonzero(np.append(True, rows[1:] != rows[:-1])), len(rows))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                reach = np.maximum.accumulate(stops[a:b])
                new = np.flatnonzero(np.append(True, starts[a + 1:b] > reach[:-1]))
                spans[int(rows[a])] = starts[a:b][new].tolist(), np.append(reach[new[1:] - 1], reach[-1]).tolist()
        out: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept")}
        for (i, text, count), (starts, stops) in zip(docs, spans):
            kept = b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)]))
            row = (None if i == NO_ID else i, len(text), len(text) - len(kept), len(starts), [{"start": a, "stop": b} for a, b in zip(starts, stops)],
                   hashlib.sha256(kept).hexdigest(), kept)
            for column, v in zip(out.values(), row):
                column.extend([v] * count)
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        kinds = [pa.int64()] * 4 + [span, pa.string(), pa.binary()]
        table = pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))
        return table if with_text else table.drop_columns(["kept"])
    return cut


def _slices(total: int, slice_bytes: int) -> int:
    """How many slices ``total`` bytes of text are dealt to, and as many shares."""
    grown = slice_bytes * min(max(math.sqrt(total / GROWING), 1), SLICE_GROWTH)
    return max(1, min(math.ceil(total / grown), 1 << _SLICE_BITS))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, with_text: bool = False,
            slice_bytes: int = SLICE_BYTES, hot_slices: int = HOT_SLICES, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """A row per document: ``doc_id, n_bytes, n_removed, n_spans, spans`` (byte ranges, end exclusive), ``kept_sha256``
    and, with ``with_text``, ``kept`` (the bytes that stay, which may cut a character)."""
    if not 5 <= length <= 1024:
        raise ValueError("length must be 5 to 1024 bytes")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = _slices(total, slice_bytes)
    rows = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(shares)).alias("slice"), "id", "text")
    parcels = rows.mapInArrow(_parcels, "slice long, blob binary").repartition(shares, "slice").groupBy("slice")

    lists = rows.mapInArrow(_name_lists(length, shares), "share long, blob binary")
    names = stored(lists.repartition(shares, "share").groupBy("share").applyInArrow(_shared_names(hot_slices), "slice long, blob binary"), "shared-names")
    pieces = parcels.cogroup(names.repartition(shares, "slice").groupBy("slice")).applyInArrow(_pieces(length, shares), "share long, blob binary")
    marks = stored(pieces.repartition(shares, "share").groupBy("share").applyInArrow(_marked(length, index_bytes), "slice long, blob binary"), "repeat-marks")
    return parcels.cogroup(marks.repartition(shares, "slice").groupBy("slice")).applyInArrow(_cut(with_text), _RESULT + ", kept binary" * with_text)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``doc_id`` and ``text`` of every document without the bytes that repeat an earlier one; a character whose bytes are
    cut becomes U+FFFD."""
    cut = repeats(docs, id_col, text_col, length, with_text=True)
    return cut.select(F.col("doc_id").alias(id_col), F.make_valid_utf8(F.col("kept").cast("string")).alias(text_col))
