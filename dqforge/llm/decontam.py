"""Benchmark decontamination: SimHash over item-sized windows, in DataFrame operations only.

1. Anchors.  A window that ends up similar enough to an item shares word shingles with it at known
   offsets, so only windows that an item's shingle anchors are fingerprinted.  Shingles of a document
   are taken at every ``stride``-th word; the stride is the largest at which no window of the wanted
   similarity can slip through (see ``safe_stride``).
2. Fingerprints.  Each anchored window of an item's size (and the windows shifted by up to the number
   of shingles that may differ) gets a 64-bit SimHash of its words.
3. Multi-index.  The 64 bits are cut into ``BLOCKS``, each with a number of bits that may differ; these
   numbers are chosen so that fingerprints within ``radius`` bits keep to that of one block at least.  All
   values that near to an item's block are indexed and joined with the windows' blocks by equality, then
   the whole distance is checked: no pair within the radius is missed, and no other pair goes on.  Similar
   windows outside the radius are missed: of 1,800 items of 16 to 59 words cut to the limit of similarity,
   the farthest lay 18 bits off (8 on average), so that recall at the radius of 23 is near 1, not proven 1.
4. Verification.  The shingle bags of window and item are compared exactly: the weighted Jaccard
   similarity, sum of smaller counts over sum of larger counts, is at least ``similarity``.

Words are runs of letters and digits, lower case; shingles have five words, a shorter item is one
shingle, anchored at every place of a document that has its words.  A document shorter than an item is one window of its own size.

Defined results: null and empty texts and items without a word match nothing; equal items are
compared once and all reported; repeated rows match alike; a null id is kept as null; an empty table
gives an empty result; other columns are ignored (``clean`` carries them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import matching, row_key, stored

WORDS, SIMILARITY, RADIUS, BLOCKS = 5, 0.75, 23, 5
#: Distinct benchmark shingles sent to every executor at once; more of them are shuffled instead.
BROADCAST_SHINGLES = 500_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle(ws: Column, at: Column, size: int = WORDS) -> Column:
    """64-bit hash of the ``size`` words from 1-based ``at``."""
    return F.xxhash64(*[F.get(ws, at + (k - 1)) for k in range(size)])


def starts(n_words: Column, stride: int = 1) -> Column:
    """1-based places of the shingles of ``n_words`` words; a shorter text has one."""
    last = F.greatest(n_words - (WORDS - 1), F.lit(1))
    return F.when(n_words > 0, F.sequence(F.lit(1), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))


def lost(n: int, similarity: float) -> int:
    """Of a window's ``n`` shingles, how many at most an item of the wanted similarity lacks."""
    return n - -int(-(2 * similarity / (1 + similarity) * n) // 1)


def safe_stride(least: int, similarity: float) -> int:
    """The largest stride at which every window of ``least`` shingles or more has an anchor left."""
    for s in (5, 4, 3, 2):
        if all(n // s > lost(n, similarity) for n in range(least, least + 400)):
            return s
    return 1


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``bits``: the 64-bit SimHash of the words (column ``word``) of each key."""
    h = F.xxhash64("word")
    signs = rows.select(*keys, h.alias("h"))
    sums = signs.groupBy(*keys).agg(*[F.sum(F.getbit("h", F.lit(b)).cast("int") * 2 - 1).alias(f"s{b}") for b in range(64)])
    bits = F.lit(0).cast("long")
    for b in range(64):
        bits = bits.bitwiseOR(F.when(F.col(f"s{b}") > 0, F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, bits.alias("bits"))


def blocks(radius: int) -> list[tuple[int, int, int]]:
    """First bit, width and bits that may differ (-1: none needed) of each block: values within ``radius``
    keep to the number of some block, as one more than it in each block adds up to ``radius + 1``."""
    width, more = divmod(64, BLOCKS)
    least, rest = divmod(radius + 1, BLOCKS)
    return [(b * width + min(b, more), width + (b < more), least - 1 + (b < rest)) for b in range(BLOCKS)]


def block(bits: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def within(prints: DataFrame, item_prints: DataFrame, radius: int) -> DataFrame:
    """Pairs of ``prints`` (n, bits and others) and ``item_prints`` (item, n, bits) of one ``n`` whose bits
    differ in at most ``radius``: the columns of ``prints`` and ``item``, once a pair for distinct rows."""
    def forms(first: int, width: int, flips: int) -> Column:
        masks = F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda m: F.bit_count(m) <= flips)
        return F.transform(masks, lambda m: block(F.col("item_bits"), first, width).bitwiseXOR(m.cast("long")))

    cuts = [(b, *cut) for b, cut in enumerate(blocks(radius))]
    at = lambda b, values: F.transform(values, lambda v: F.struct(F.lit(b).alias("b"), v.alias("v")))
    near = item_prints.select("item", "n", F.col("bits").alias("item_bits"))
    near = near.select("item", "n", "item_bits", F.explode(F.concat(*[at(b, forms(*cut)) for b, *cut in cuts])).alias("p")).select("item", "n", "item_bits", "p.*")
    probes = prints.select("*", F.explode(F.concat(*[at(b, F.array(block(F.col("bits"), first, width))) for b, first, width, _ in cuts])).alias("p"))
    probes = probes.select(*prints.columns, "p.*")
    found = probes.join(near, ["b", "v", "n"]).where(F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits"))) <= radius)
    return found.select(*prints.columns, "item").distinct()


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct items by their words: key, words, sizes."""
    got = benchmark.select(words(F.col("text")).alias("ws")).where(F.size("ws") > 0).distinct()
    return got.select(F.xxhash64(F.concat_ws(" ", "ws")).alias("item"), "ws", F.size("ws").alias("n"))


def bag(ws: Column) -> Column:
    """The shingles of words as a set of strings: the k-th occurrence of one is an element of its own,
    so that set intersection counts the smaller multiplicities."""
    plain = F.transform(starts(F.size(ws)), lambda i: F.array_join(F.slice(ws, i, WORDS), " "))
    number = lambda s: F.transform(s, lambda x, i: F.concat(x, F.lit("\t"), (i - F.array_position(s, x)).cast("string")))
    return F.get(F.transform(F.array(F.sort_array(plain)), number), F.lit(0))  # sorted once, not for each element


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row per document and item: doc_id, item_id, similarity, word_start, n_words of the most similar
    window (the first of equals), and ``row``, the 64-bit key of the document row."""
    items = stored(_items(benchmark), "decontam-items")
    facts = items.agg(F.count(F.lit(1)).alias("items"), F.min(F.when(F.col("n") >= WORDS, F.col("n"))).alias("least"), F.max("n").alias("most"),
                      F.array_sort(F.collect_set(F.when(F.col("n") < WORDS, F.col("n")))).alias("short")).first()
    n_shingles = lambda n: max(1, n - WORDS + 1)
    least = max(1, -int(-(similarity * n_shingles(facts["least"] or WORDS)) // 1))
    stride = safe_stride(least, similarity)

    # 1. anchors: (shingle, offset, size of the item)
    at = F.explode(starts(F.col("n"))).alias("i")
    offsets = stored(items.select("item", "ws", "n", at).select(shingle(F.col("ws"), F.col("i")).alias("sh"), (F.col("i") - 1).alias("off"), "n").distinct(), "decontam-anchors")
    keys = offsets.select("sh").distinct()
    small = keys.count() <= BROADCAST_SHINGLES
    docs_w = docs.select("doc_id", row_key("doc_id", F.col("text")).alias("row"), words(F.col("text")).alias("ws"))
    hashed = lambda places, size: F.transform(places, lambda i: F.struct(i.alias("i"), shingle(F.col("ws"), i, size).alias("sh")))
    # shorter items: all runs of as many words (of each length there is)
    runs = lambda size: F.when(F.size("ws") >= size, F.sequence(F.lit(1), F.size("ws") - (size - 1))).otherwise(F.array().cast("array<int>"))
    at = F.explode(F.concat(hashed(starts(F.size("ws"), stride), WORDS), *[hashed(runs(size), size) for size in facts["short"]])).alias("a")
    seen = docs_w.select("row", F.size("ws").alias("size"), at).select("row", "size", F.col("a.i").alias("i"), F.col("a.sh").alias("sh"))
    hits = seen.join(F.broadcast(keys) if small else keys, "sh", "left_semi")
    hits = hits.join(F.broadcast(offsets) if small else offsets, "sh")
    # windows: where the item would start, and up to `lost` shingles to either side
    per = F.greatest(F.col("n") - WORDS + 1, F.lit(1))
    shift = (per - F.ceil(per * (2 * similarity / (1 + similarity)) - 1e-9)).cast("int")
    length = F.least("n", "size")
    place = F.greatest(F.lit(1), F.least(F.col("i") - F.col("off") + F.col("d"), F.col("size") - length + 1))
    windows = (hits.select("row", "size", "i", "off", "n", F.explode(F.sequence(-shift, shift)).alias("d"))
               .select("row", place.cast("int").alias("at"), length.alias("len"), F.col("n")).distinct())
    windows = stored(windows, "decontam-windows")

    # 2. fingerprints
    mine = matching(docs_w, windows.select("row").distinct(), "row").dropDuplicates(["row"]).select("row", "ws")
    texts = stored(windows.select("row", "at", "len").distinct().join(mine, "row")
                   .select("row", "at", "len", F.slice("ws", F.col("at"), F.col("len")).alias("ws")), "decontam-texts")
    # few bytes, much work: dealt by window to as many tasks as a shuffle has, which the sums keep to
    dealt = texts.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row", "at", "len")
    prints = simhash(dealt.select("row", "at", "len", F.explode("ws").alias("word")), ["row", "at", "len"])
    prints = stored(windows.join(prints, ["row", "at", "len"]), "decontam-prints")
    item_prints = simhash(items.select("item", "n", F.explode("ws").alias("word")), ["item", "n"])

    # 3. multi-index: blocks of the items in all their near forms, joined with blocks of the windows
    found = within(prints, item_prints, radius).select("row", "at", "len", "item").distinct()

    # 4. exact weighted-shingle similarity
    both = F.size(F.array_intersect("w_bag", "i_bag"))
    found = stored(found, "decontam-pairs")
    pairs = found.join(texts, ["row", "at", "len"]).select("row", "at", "len", "item", bag(F.col("ws")).alias("w_bag"))
    sure = (pairs.join(items.select("item", bag(F.col("ws")).alias("i_bag")), "item")
            .select("row", "at", "len", "item", (both / (F.size("w_bag") + F.size("i_bag") - both)).alias("similarity"))
            .where(F.col("similarity") >= similarity))
    best = sure.groupBy("row", "item").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "at", "len")).alias("best"))
    names = benchmark.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0).select("item_id", F.xxhash64(F.concat_ws(" ", "ws")).alias("item"))
    best = stored(best.join(names, "item").select("row", "item_id", (-F.col("best.s")).alias("similarity"), F.col("best.at").alias("word_start"), F.col("best.len").alias("n_words")), "decontam-found")
    who = matching(docs.select("doc_id", row_key("doc_id", F.col("text")).alias("row")), best.select("row").distinct(), "row")
    return who.join(best, "row").select("doc_id", "item_id", "similarity", "word_start", "n_words", "row")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without a benchmark item in them, with all their columns."""
    rows = contaminated(docs, benchmark, similarity, radius).select(F.col("row").alias("_row_key")).distinct()
    return matching(docs.withColumn("_row_key", row_key("doc_id", F.col("text"))), stored(rows, "decontam-rows"), "_row_key", "left_anti").drop("_row_key")
