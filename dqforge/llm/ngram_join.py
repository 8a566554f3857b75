"""N-gram Jaccard join with set-relation skipping, exact, as components of linked documents.

A document's set is its distinct five-word shingles (64-bit hashes); equal sets are one node, known by
a 64-bit digest.  Sets link when ``100 * |A & B| >= percent * |A | B|``.

Index.  Sets are ordered by one global order of shingles (frequent ones last, rarest of those first) and
indexed by their prefix: linked sets share a shingle within their prefixes, whatever the order is.

Answer-level skipping.  In long lists every set is first compared with a few *pivots* of its lists, over
some rounds; sets linked to a pivot take over its answers: they are in its component, and no pair inside
a component is looked at again.  For the pairs that are left, the overlaps with a common pivot bound the
overlap of the pair; only pairs that the bounds leave open are compared.

Index-level skipping.  The lists are cut into blocks by component, with the ranges of their sizes and
positions; a block pair is skipped when its components are equal or when the ranges rule out a link.
Inside, pairs are ruled out by sizes, positions, 256-bit parity bitmaps (differing bits bound differing
shingles from below) and the count of common prefix shingles.

``link_counts`` and ``all_links`` give every linked pair, those inside components too: only the pivots'
bounds skip there, refusing or accepting pairs, and the pairs left open are compared.

All skipping is lossless: links inside a component don't change it, and every pair across components
that isn't ruled out exactly is compared by its whole sets.

Defined results: null texts and texts without words have an empty set and link with nothing; a text of
fewer words is one shingle; repeated rows (and equal texts) have one set; a null id counts as no id when
the smallest is taken; an empty table gives an empty result; other columns are ignored
(``keep_one`` carries them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import matching, row_key, slices, stored, tidy
from .components import components

WORDS, PERCENT = 5, 75
#: Shingles counted as frequent, at least this often; the most frequent ones are sent to all tasks (8 MB).
FREQUENT, MOST_FREQUENT = 64, 1 << 20
#: Lists of more sets than this go through pivots; rounds of pivots; lists and pivots of a set in a
#: round; pairs of a set that are compared before the others, and how often.
LONG_LIST, ROUNDS, LISTS, PIVOTS, LIKELY, LIKELY_ROUNDS = 12, 2, 24, 4, 4, 1
BITS = ["b0", "b1", "b2", "b3"]
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MUL, _INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


class Shingler:
    """Distinct shingle hashes of texts (sorted int64)."""

    def __init__(self):
        self.power = self.inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, 1 << 16)
            self.power = np.cumprod(np.append(np.uint64(1), np.full(size - 1, _MUL, np.uint64)))
            self.inverse = np.cumprod(np.append(np.uint64(1), np.full(size - 1, _INV, np.uint64)))

    def word_hashes(self, raw: bytes) -> np.ndarray:
        """A polynomial hash of each word of at most about a MB of text."""
        x = np.frombuffer(raw, np.uint8)
        edge = np.diff(np.concatenate([[0], (~_IS_SPACE[x]).view(np.int8), [0]]))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self._grow(len(x) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * self.power[:len(x)])])
        h = (total[end] - total[start]) * self.inverse[start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def hashes(self, text: str) -> np.ndarray:
        raw = text.encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z only
        parts, at = [], 0
        while at < len(raw):
            end = len(raw)
            if end - at > 1 << 20:
                cut = _SPACE.search(raw, at + (1 << 20))
                end = cut.start() if cut else end
            parts.append(self.word_hashes(raw[at:end]))
            at = end
        w = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(w):
            return np.zeros(0, np.int64)
        n = min(WORDS, len(w))
        m = len(w) - n + 1
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h ^ w[k:k + m]) * np.uint64(0xA0761D6478BD642F)
            h ^= h >> np.uint64(31)
        return np.unique(h.view(np.int64))


def need(percent: int, n) -> int:
    """Smallest overlap that a set of ``n`` shingles has with any linked set."""
    return -(-percent * n // 100)


def parity(toks: np.ndarray) -> list[int]:
    """256 bits, each the parity of how many shingles fall on it: two sets differ in at least as many
    shingles as these differ in bits."""
    odd = np.bincount((toks >> 20) & 255, minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per document (row, doc_id, n, set) and per shingle that this task saw several times (null, null, count, shingle)."""
    shingler, seen, held, size = Shingler(), set(), [], 0

    def frequent():
        token, count = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        many = count > 1
        none = pd.array([None] * int(many.sum()), "Int64")
        return pd.DataFrame({"row": none, "doc_id": none, "n": count[many], "key": token[many], **dict.fromkeys(BITS, none)})

    for pdf in batches:
        ns, keys, bits = [], [], []
        for part in slices(pdf["text"]):
            for text in part:
                toks = shingler.hashes(text)
                key = int.from_bytes(hashlib.md5(toks.tobytes()).digest()[:8], "little", signed=True)
                ns.append(len(toks))
                keys.append(key)
                bits.append(parity(toks))
                if key not in seen:
                    seen.add(key)
                    held.append(toks)
                    size += len(toks)
            if size > 1_000_000:
                yield frequent()
                held, size = [], 0
        out = pd.DataFrame({"row": pdf["row"].astype("Int64"), "doc_id": pdf["doc_id"].astype("Int64"), "n": np.array(ns, np.int64), "key": np.array(keys, np.int64)})
        yield out.assign(**dict(zip(BITS, np.array(bits, np.int64).reshape(-1, 4).T)))
    yield frequent()


def _postings(tokens: np.ndarray, counts: np.ndarray, percent: int):
    """Prefix postings of each distinct set of a task: token, set, n, position, whether frequent."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(), set()
        for pdf in batches:
            for part in slices(pdf["text"]):
                cols: list[list[np.ndarray]] = [[], [], [], [], []]
                for text in part:
                    toks = shingler.hashes(text)
                    key = int.from_bytes(hashlib.md5(toks.tobytes()).digest()[:8], "little", signed=True)
                    n = len(toks)
                    if not n or key in seen:
                        continue
                    seen.add(key)
                    hot = np.zeros(n, bool)
                    if len(tokens):
                        place = np.minimum(np.searchsorted(tokens, toks), len(tokens) - 1)
                        hot = tokens[place] == toks
                    size = n - need(percent, n) + 1
                    prefix = toks[~hot][:size]
                    cold = len(prefix)
                    if cold < size:
                        last = toks[hot]
                        prefix = np.concatenate([prefix, last[np.argsort(counts[place[hot]], kind="stable")][:size - cold]])
                    for c, v in zip(cols, (prefix, np.full(len(prefix), key), np.full(len(prefix), n), np.arange(len(prefix)), np.arange(len(prefix)) >= cold)):
                        c.append(v)
                if cols[0]:
                    yield pd.DataFrame(dict(zip(("token", "id", "n", "pos", "hot"), map(np.concatenate, cols))))

    return run


def _overlaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole-set overlap of the two texts of each row."""
    shingler, last, mine = Shingler(), None, np.zeros(0, np.int64)
    for pdf in batches:
        out = []
        for a, ta, tb in zip(pdf["a"], pdf["ta"], pdf["tb"]):
            if a != last:
                last, mine = a, shingler.hashes(ta)
            other = shingler.hashes(tb)
            out.append((len(np.intersect1d(mine, other, assume_unique=True)), len(mine), len(other)))
        o, n, m = zip(*out) if out else ((), (), ())
        yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "o": np.array(o, np.int64), "na": np.array(n, np.int64), "nb": np.array(m, np.int64)})


class _Join:
    def __init__(self, docs: DataFrame, percent: int):
        self.percent = percent
        text = F.coalesce("text", F.lit(""))
        self.docs = docs.select(row_key("doc_id", text).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        scan = stored(self.docs.mapInPandas(tidy(_scan), "row long, doc_id long, n long, key long, b0 long, b1 long, b2 long, b3 long"), "ngram-sets")
        self.info = scan.where("row IS NOT NULL").select("row", "doc_id", "n", F.col("key").alias("id"))
        often = (scan.where("row IS NULL").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
                 .orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).toPandas())  # at most MOST_FREQUENT rows
        often = often.sort_values("key")
        self.often = often["key"].to_numpy(np.int64), often["n"].to_numpy(np.int64)
        sets = scan.where("row IS NOT NULL").groupBy(F.col("key").alias("id"))
        self.rows = sets.agg(F.min("row").alias("row"))  # a row to read a set from
        self.bits = sets.agg(*[F.max(b).alias(b) for b in BITS])

    def linked(self, o, n, m):
        return 100 * o >= self.percent * (n + m - o)

    def index(self) -> DataFrame:
        """Postings of the shingles that several sets have in their prefixes."""
        found = self.docs.mapInPandas(tidy(_postings(*self.often, self.percent)), "token long, id long, n long, pos long, hot boolean")
        found = found.select("token", "id", F.col("n").cast("int"), F.col("pos").cast("int"), "hot")
        # frequent shingles are in many sets anyway; the others' lists are short
        of = Window.partitionBy("token", "hot_part")
        found = found.withColumn("hot_part", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(1024))).otherwise(-1))
        found = found.withColumn("least", F.min("id").over(of)).withColumn("most", F.max("id").over(of))
        return stored(found.where("hot OR least < most").select("token", "id", "n", "pos").dropDuplicates(["token", "id"]), "ngram-index")

    def overlaps(self, pairs: DataFrame) -> DataFrame:
        """a, b, o, na, nb: overlap and sizes of each pair of sets, from their whole texts."""
        pairs = stored(pairs.select("a", "b"), "ngram-pairs")
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        ids = stored(ids.join(self.rows, "id").select("id", "row"), "ngram-ids")
        texts = matching(self.docs.select("row", "text"), ids.select("row").distinct(), "row").join(ids, "row")
        texts = stored(texts.dropDuplicates(["id"]).select("id", "text"), "ngram-texts")
        got = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
               .join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a"))
        return stored(got.select("a", "b", "ta", "tb").mapInPandas(tidy(_overlaps), "a long, b long, o long, na long, nb long"), "ngram-overlaps")

    def linking(self, overlaps: DataFrame) -> DataFrame:
        return overlaps.where(self.linked(F.col("o"), F.col("na"), F.col("nb"))).select("a", "b")

    def links(self) -> DataFrame:
        """Edges (a, b) between sets that give the components of all links."""
        index = self.index()
        edges, tested = self.pivots(index)
        comp = components(self.union(edges)) if edges else None
        pairs = stored(self.candidates(index, comp), "ngram-candidates")
        if tested:
            pairs, sure = self.derived(pairs, self.union(tested))
            edges.append(sure)
        # the likeliest pairs of each set first: a link makes other pairs of its components needless
        for _ in range(LIKELY_ROUNDS):
            first = pairs.select(F.col("a").alias("x"), "c", "a", "b").unionByName(pairs.select(F.col("b").alias("x"), "c", "a", "b"))
            first = first.withColumn("nth", F.row_number().over(Window.partitionBy("x").orderBy(F.desc("c"), "a", "b")))
            first = self.overlaps(first.where(F.col("nth") <= LIKELY).select("a", "b").distinct())
            edges.append(self.linking(first))
            comp = components(self.union(edges))
            rest = pairs.select("a", "b", "c").join(first.select("a", "b"), ["a", "b"], "left_anti")
            for end in ("a", "b"):
                rest = rest.join(comp.select(F.col("id").alias(end), F.col("comp").alias(f"c{end}")), end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
            pairs = stored(rest.where("ca <> cb").select("a", "b", "c"), "ngram-rest")
        if pairs.take(1):
            edges.append(self.linking(self.overlaps(pairs)))
        return self.union(edges)

    def all_links(self) -> DataFrame:
        """All linked pairs (a, b) of sets, each once; as many rows as there are links."""
        index = self.index()
        _, tested = self.pivots(index)
        pairs, sure = stored(self.candidates(index, None), "ngram-candidates"), []
        if tested:
            pairs, proved = self.derived(pairs, self.union(tested))
            sure.append(proved)
        return stored(self.union([*sure, self.linking(self.overlaps(pairs))]), "ngram-all-links")

    def counts(self) -> DataFrame:
        """doc_id, n_shingles, n_links, row of every document row."""
        copies = stored(self.info.where("n > 0").groupBy("id").agg(F.count(F.lit(1)).alias("copies")), "ngram-copies")
        links = self.all_links()
        ends = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
        others = ends.join(copies.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.sum("copies").alias("others"))
        sets = stored(copies.join(others, "id", "left").select("id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "ngram-link-counts")
        return (self.info.withColumn("id", F.when(F.col("n") > 0, F.col("id"))).join(sets, "id", "left")
                .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "row"))

    def pivots(self, index: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
        """Links with pivots, round by round, and all overlaps with pivots."""
        size = index.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > LONG_LIST)
        long = stored(index.join(size, "token").select("token", "id", "n", F.xxhash64("token").alias("h")), "ngram-long")
        # of two linked sets of one size, the larger part of each prefix is in common: sets with less in
        # long lists are left to the comparison of lists
        strong = long.groupBy("id", "n").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") * 1000 >= F.col("n") * (100 - self.percent) * 4).select("id")
        few = Window.partitionBy("id").orderBy("h", "token")
        long = (long.join(strong, "id", "left_semi").withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= LISTS).select("token", "id"))
        long = stored(long, "ngram-long")
        edges, tested, comp = [], [], None
        for turn in range(ROUNDS):
            now = self.placed(long, comp)
            # one pivot a list, another one in each round, from the component with the most sets in it;
            # lists within one component are done
            part = now.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"), F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("id"))
            pick = part.groupBy("token").agg(F.max_by(F.struct("id", "comp"), F.struct("k", F.xxhash64("id", F.lit(turn)))).alias("p"), F.min("comp").alias("c1"), F.max("comp").alias("c2"))
            pick = stored(pick.where("c1 < c2").select("token", F.col("p.id").alias("pivot"), F.col("p.comp").alias("pivot_comp")), "ngram-pivots")
            pairs = now.join(pick, "token").where("comp <> pivot_comp").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("lists"))
            best = Window.partitionBy("id").orderBy(F.desc("lists"), "pivot")
            pairs = pairs.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= PIVOTS).select(F.col("pivot").alias("a"), F.col("id").alias("b"))
            for t in tested:
                pairs = pairs.join(t.select("a", "b"), ["a", "b"], "left_anti")
            pairs = stored(pairs, "ngram-pivot-pairs")
            if not pairs.take(1):
                break
            tested.append(self.overlaps(pairs))
            edges.append(self.linking(tested[-1]))
            comp = stored(components(self.union(edges)), "ngram-components")
        return edges, tested

    @staticmethod
    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @staticmethod
    def placed(postings: DataFrame, comp: DataFrame | None) -> DataFrame:
        if comp is None:
            return postings.withColumn("comp", F.col("id"))
        return postings.join(comp.withColumnRenamed("comp", "known"), "id", "left").withColumn("comp", F.coalesce("known", "id")).drop("known")

    def candidates(self, index: DataFrame, comp: DataFrame | None) -> DataFrame:
        """Pairs across components (a, b, na, nb, common prefix shingles c) that sizes, positions, counts
        and bitmaps don't rule out.

        A linked pair has a shingle in common that is in the first ``index`` places of the smaller set and
        in the prefix of the larger one, so blocks of all postings meet blocks of those few."""
        p = self.percent
        least = lambda n, m: F.floor((p * (n + m) + 99 + p) / (100 + p)).cast("int")  # noqa: E731  smallest overlap of linked sets
        first = lambda n: n - least(n, n) + 1
        prefix = lambda n: n - F.floor((p * n + 99) / 100) + 1
        now = self.placed(index, comp).join(self.bits, "id")
        part = F.pmod(F.xxhash64("id"), F.lit(16)).alias("part")
        blocks = stored(now.groupBy("token", "comp", part).agg(
            F.collect_list(F.struct("id", "n", "pos", *BITS)).alias("sets"), F.min("n").alias("n1"), F.max("n").alias("n2"),
            F.min("pos").alias("p1"), F.max("pos").alias("p2")), "ngram-blocks")
        several = blocks.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 < c2").select("token")
        blocks = blocks.join(several, "token", "left_semi")
        early = F.filter("sets", lambda t: t["pos"] < first(t["n"]))
        few = blocks.withColumn("sets", early).where(F.size("sets") > 0)
        x, y = blocks.alias("x"), few.alias("y")
        # blocks apart in component, size or position can't hold a linked pair
        apart = F.greatest(F.col("x.p1") - F.col("y.p2"), F.col("y.p1") - F.col("x.p2"))
        can = (F.col("x.comp") != F.col("y.comp")) & (F.col("x.n2") >= F.col("y.n1")) & (100 * F.col("y.n2") >= p * F.col("x.n1")) & (
            apart * (100 + p) <= (100 - p) * (F.col("x.n2") + F.col("y.n2")))
        both = x.join(y, (F.col("x.token") == F.col("y.token")) & can).select(F.explode("x.sets").alias("s"), F.col("y.sets").alias("others"))

        def open_pair(t):
            n, m, i, j = F.col("s.n"), t["n"], F.col("s.pos"), t["pos"]
            differ = sum((F.bit_count(F.col(f"s.{b}").bitwiseXOR(t[b])) for b in BITS), F.lit(0))
            larger = (n > m) | ((n == m) & (F.col("s.id") > t["id"]))
            return (larger & (100 * m >= p * n) & (F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1) >= least(n, m))
                    & (differ <= n + m - 2 * least(n, m)))

        both = both.select("s", F.explode(F.filter("others", open_pair)).alias("t"))
        pairs = (both.select(F.col("s.id").alias("a"), F.col("t.id").alias("b"), F.col("s.n").alias("na"), F.col("t.n").alias("nb"))
                 .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c")))
        n, m = F.col("na"), F.col("nb")
        return pairs.where(F.col("c") >= F.least(first(m) - (m - least(n, m)), prefix(n) - (n - least(n, m))))

    def derived(self, pairs: DataFrame, tested: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs that the overlaps with common pivots leave open, and pairs that they prove linked."""
        # each set's most similar pivot; of the other set any overlap with that pivot
        of = stored(tested.select(F.col("b").alias("id"), F.col("a").alias("pivot"), "o", F.col("na").alias("np"), F.col("nb").alias("n")), "ngram-pivot-overlaps")
        near = of.groupBy("id").agg(F.max_by(F.struct("pivot", "o", "np"), F.struct(F.col("o") / (F.col("n") + F.col("np") - F.col("o")), "pivot")).alias("p"))
        ends = pairs.join(near.select(F.col("id").alias("a"), "p.pivot", F.col("p.o").alias("oa"), F.col("p.np").alias("np")), "a")
        ends = ends.join(of.select(F.col("id").alias("b"), "pivot", F.col("o").alias("ob")).dropDuplicates(["b", "pivot"]), ["b", "pivot"])
        most = F.least(F.col("ob") + F.col("na") - F.col("oa"), F.col("oa") + F.col("nb") - F.col("ob"))
        known = ends.groupBy("a", "b").agg(F.min(most).alias("most"), F.max(F.col("oa") + F.col("ob") - F.col("np")).alias("least"))
        rows = stored(pairs.join(known, ["a", "b"], "left"), "ngram-derived")
        n, m = F.col("na"), F.col("nb")
        sure = F.col("least").isNotNull() & self.linked(F.col("least"), n, m)
        never = F.col("most").isNotNull() & ~self.linked(F.col("most"), n, m)
        return rows.where(~sure & ~never).drop("most", "least"), rows.where(sure).select("a", "b")

    def classes(self) -> DataFrame:
        """doc_id, n_shingles, component_id, row, class of every document row."""
        comp = stored(components(self.links()), "ngram-components")
        sets = stored(self.info.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("least")).join(comp, "id", "left"), "ngram-set-classes")
        whole = sets.where("comp IS NOT NULL").groupBy("comp").agg(F.min("least").alias("whole"))
        sets = stored(sets.join(stored(whole, "ngram-comp-classes"), "comp", "left").select("id", F.coalesce("whole", "least").alias("component_id"), F.coalesce("comp", "id").alias("class")), "ngram-classes")
        return (self.info.withColumn("id", F.when(F.col("n") > 0, F.col("id"))).join(sets, "id", "left")
                .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "row", "class"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and ``row``, the 64-bit key of its row."""
    return _Join(docs, percent).classes().drop("class")


def link_counts(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, n_links (the other document rows that it links with,
    copies of its text among them), and ``row``, the 64-bit key of its row."""
    return _Join(docs, percent).counts()


def all_links(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every linked pair of documents with different sets, in either order: row, other (keys of their rows)."""
    join = _Join(docs, percent)
    links, ids = join.all_links(), join.info.where("n > 0").select("id", "row")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (both.join(ids.select(F.col("id").alias("a"), "row"), "a").join(ids.select(F.col("id").alias("b"), F.col("row").alias("other")), "b").select("row", "other"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``docs``, with all its columns; rows without a shingle stay.

    The row with the smallest id stays (a null id only where no row of the component has one); of several
    texts under that id, the one with the smallest row key; of rows repeated under it, the first by their
    columns as JSON text."""
    found = stored(_Join(docs, percent).classes(), "ngram-documents").where("class IS NOT NULL")
    first, columns = found.where("doc_id <=> component_id"), [F.col(f"`{c}`") for c in docs.columns]  # one row a class, but for repeated or null ids
    several = stored(first.groupBy("class").agg(F.min("row").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "ngram-several")
    gone = found.where("NOT doc_id <=> component_id").select("row").unionByName(first.join(several, "class").where("row <> least").select("row"))
    keyed = docs.withColumn("_row_key", row_key("doc_id", F.col("text")))
    left = matching(keyed, stored(gone.select(F.col("row").alias("_row_key")).distinct(), "ngram-gone"), "_row_key", "left_anti")
    if several.take(1):  # rows repeated under the id and text that stay: the first of them
        keys = stored(several.select(F.col("least").alias("_row_key")).distinct(), "ngram-repeated")
        row = F.struct(*columns)
        once = matching(left, keys, "_row_key").groupBy("_row_key").agg(F.min_by(row, F.to_json(row)).alias("one"))
        left = matching(left, keys, "_row_key", "left_anti").select(*columns).unionByName(once.select(*[F.col("one").getField(c).alias(c) for c in docs.columns]))
    return left.select(*columns)
