"""The trie of conversation prefixes, with subtree totals rolled up in bands of depth.

A node is a distinct sequence of first turns; conversations that begin with it are its members.  A turn is
known by a 128-bit digest of its role and text, a prefix by the XOR of its turns' digests with their places,
so prefixes are running totals that no task needs a whole conversation for.

Subtree totals: with bands of ``BAND`` levels, a node adds its weight to its ancestors inside its own band only
(at most ``BAND`` rows a node).  What the topmost nodes of bands hold then is a tree ``BAND`` times less deep,
which is rolled up the same way, and the completed totals go from each band's top to its ancestors in the band
above.  A trie of depth D takes 2 * log D / log BAND rounds, whatever its shape.

Defined results: a null role or text is empty text; turns come by ``turn`` (null first), then role and text, so
repeated turns and ties have one order; rows with a null conversation id take no part; a conversation without
turns ends in the root; empty input has no node.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.running import running_totals
from .common import stored

#: Levels of a band, and ids in a chunk of a node's list.
BAND, CHUNK = 8, 1024


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 0), the digest ``d1, d2`` of role and text, and the text's ``n_bytes``."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = running_totals(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], {"n": (F.lit(1), "sum")})
    digest = [F.xxhash64(F.lit(seed), "role", F.lit("\n"), "text").alias(f"d{seed}") for seed in (1, 2)]
    return placed.select("conv_id", (F.col("n") - 1).alias("place"), *digest, F.octet_length("text").cast("long").alias("n_bytes"))


def forked(turns: DataFrame, family: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings, made of :func:`ordered_turns`: conversation c gets the first h turns of
    c - c % ``family``, then its own turns after its first h, with h = crc32 of its decimal id % ``modulus``.  Returns
    the turns and the conversations, even those without turns."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = stored(sizes.withColumn("base", F.expr(f"conv_id - conv_id % {family}")).join(base, "base", "left")
                   .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus)
                   .select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("given")), "forks")
    own = turns.join(convs.select("conv_id", "h", "given"), "conv_id").where("place >= h")
    heads = turns.where(F.col("place") < modulus - 1).withColumnRenamed("conv_id", "base")
    given = heads.join(convs.select("conv_id", "base", "h"), "base").where("place < h")
    cols = ["d1", "d2", "n_bytes"]
    return (own.select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("place"), *cols)
            .unionByName(given.select("conv_id", "place", *cols))), convs.select("conv_id")


def _id_hashes(batches):
    """mapInArrow function over chunks sorted by node: each node's hash of its whole list, whatever its length."""
    node, state, rows = None, None, []

    def done():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["depth", "k1", "k2", "ends_sha256"])

    for b in batches:
        for d, k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("depth", "k1", "k2", "ids"))):
            if (d, k1, k2) != node:
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = (d, k1, k2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(rows) > 10_000:
            yield done()
            rows = []
    if node is not None:
        rows.append((*node, state.hexdigest()))
    if rows:
        yield done()


def _ends(last: DataFrame) -> DataFrame:
    """The hash of the ascending, comma-joined ids of the conversations that end at each node (conv_id, depth, k1, k2)."""
    chunks = last.groupBy("depth", "k1", "k2", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))).alias("ids"))  # CHUNK ids at most
    by = ["depth", "k1", "k2"]
    return chunks.repartition(*by).sortWithinPartitions(*by, "chunk").mapInArrow(_id_hashes, "depth long, k1 long, k2 long, ends_sha256 string")


def _ancestors(paths: DataFrame, step: int, above: bool) -> DataFrame:
    """Pairs of a node and one of its ancestors (itself included) in its band of ``BAND * step`` depths; with ``above``,
    of a band's topmost node and its ancestors in the band over it.  ``paths`` has each conversation's nodes by depth."""
    width = BAND * step
    level = paths.where(F.col("depth") % step == 0)
    band = F.floor(F.col("depth") / width)
    node = F.struct("depth", "k1", "k2")
    bands = level.groupBy("conv_id", band.alias("band")).agg(F.collect_list(node).alias("over"))  # BAND nodes at most
    own = level.where("leads" + f" AND depth > 0 AND depth % {width} = 0" * above).select("conv_id", (band - int(above)).alias("band"), node.alias("node"))
    pairs = own.join(bands, ["conv_id", "band"]).select("node", F.explode("over").alias("over"))
    return pairs.where(F.col("over.depth") <= F.col("node.depth")).select("node.*", F.col("over").alias("over"))


def _rolled_up(paths: DataFrame, weights: DataFrame, names: list[str], deepest: int, step: int = 1) -> DataFrame:
    """For each node at a multiple of ``step`` the sums of ``names`` over its subtree; ``weights`` has what is between those depths."""
    keys = ["depth", "k1", "k2"]

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("over").agg(*[F.sum(n).alias(n) for n in names]).select("over.*", *names)

    inside = stored(summed(_ancestors(paths, step, False).join(weights, keys)), "trie-band")
    width = BAND * step
    if deepest < width:
        return inside
    tops = _rolled_up(paths, inside.where(F.col("depth") % width == 0), names, deepest, width)
    passed = summed(_ancestors(paths, step, True).join(tops, keys))
    both = inside.unionByName(passed).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])
    return stored(both, "trie-total")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per node of the conversations ``convs`` (conv_id) with ``turns`` (conv_id, place, d1, d2, n_bytes): ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes of
    last texts that members after the first repeat, over the subtree) and ``ends_sha256``."""
    keys = ["depth", "k1", "k2"]
    bound = {f"k{i}": (F.xxhash64(F.lit(i), "place", f"d{i}"), "xor") for i in (1, 2)}
    walked = running_totals(turns, ["conv_id"], [F.col("place")], bound)
    rows = walked.select("conv_id", (F.col("place") + 1).alias("depth"), *keys[1:], *[F.col(k).bitwiseXOR(c).alias(f"p{k[1]}") for k, (c, _) in bound.items()], "n_bytes")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "p1", "p2", "n_bytes")])
    rows = stored(rows.unionByName(root), "trie-rows")

    nodes = stored(rows.groupBy(*keys).agg(F.min("conv_id").alias("lead"), F.count(F.lit(1)).alias("n_convs"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
                                           F.first("n_bytes").alias("n_bytes")), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = stored(nodes.join(children, keys, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                     .withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("n_bytes")), "trie-counted")
    deepest = counted.agg(F.max("depth")).first()[0] or 0
    paths = stored(rows.select("conv_id", *keys).join(counted.select(*keys, "lead"), keys).select("conv_id", *keys, (F.col("conv_id") == F.col("lead")).alias("leads")), "trie-paths")
    totals = _rolled_up(paths, counted.select(*keys, "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], deepest)

    # a conversation's last node is the one at the depth of its number of turns
    sizes = rows.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = _ends(rows.join(sizes, ["conv_id", "depth"]).select("conv_id", *keys))
    parents = counted.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("lead").alias("parent_conv_id"))
    return (counted.drop("n_leaves", "saved_tokens").join(parents, ["depth", "p1", "p2"], "left").join(totals, keys).join(ends, keys, "left")
            .select(F.col("lead").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
