"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

1. Texts and items are words (ASCII lower case, punctuation cut off) and their 5-word shingles.
   A window that is similar to an item holds some of its shingles at its head and at its tail, so
   windows are laid at all places that fit the shingles that items and texts share (a join of
   all shingles): as many words as the item has, or the whole text if that is shorter.
2. Every window and every item gets a SimHash of ``BITS`` bits over its shingles, each counted
   as often as it occurs.
3. The fingerprint is cut into ``RADIUS`` + 1 blocks. Two fingerprints that differ in at most
   ``RADIUS`` bits agree on one block at least, so a join on (item size, block, its bits) finds
   all of them; the Hamming distance is checked in the join, at the first block they agree on.
4. What remains is verified: weighted Jaccard of the shingles, weighed by their number of
   occurrences, of at least ``SIMILAR``. At that limit the expected distance is 7 bits of 48 with a
   deviation of 2.5, so ``RADIUS`` lies three deviations beyond the weakest leak, and every leak
   has several windows.

Built-in expressions only. Memory depends neither on the number of texts nor on their length: words
are looked at in parts of ``PART``, of texts with hits only the keys may be broadcast, and their
parts meet their windows in a shuffle.

Defined cases: an item with fewer than five words is one shingle of all its words; an item
without words matches nothing; a null text has no words; a null id is reported as null; rows
equal in id and text are one; equal item ids are judged together, a null item id is one; empty
tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.llm.common import row_key, size_checked, words_of
from lodgemart.llm.components import written

SHINGLE = 5
SIMILAR = 0.8
BITS = 48
RADIUS = 15
#: Words that a row holds at a time; the parts of a longer text overlap.
PART = 4_096
#: Rows of the item side, and keys of texts with hits, that may be sent to all tasks.
BROADCAST_SHINGLES = 500_000
BROADCAST_BLOCKS = 200_000
BROADCAST_TEXTS = 300_000


def word_hashes(text: Column) -> Column:
    """One hash for each word of a text, so that a word is read once and not for each shingle."""
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def shingles(words: Column, size: int) -> Column:
    """Hashes of all windows of ``size`` word hashes."""
    n = F.size(words) - size

    def at(i: Column) -> Column:
        return F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)])

    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), at)).otherwise(F.array().cast("array<bigint>"))


def by_size(size: Column, sizes: list[int], make) -> Column:
    """``make`` for the shingle size that a row has."""
    return F.coalesce(*[F.when(size == k, make(k)) for k in sizes])


def simhash(grams: Column, longest: int) -> Column:
    """The fingerprint of a list of at most ``longest`` shingle hashes.

    The counts of several bits stand in lanes of one number, so a few sums count all bits.
    The list is named once in the expression: where it is itself an expression, Spark would
    work it out anew for every mention.
    """
    width = max(longest, 1).bit_length()
    lanes = 63 // width
    sums = -(-BITS // lanes)
    mask = F.lit(sum(1 << (width * k) for k in range(lanes))).cast("long")
    names = [f"c{j}" for j in range(sums)]
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in [*names, "n"]])

    def add(acc: Column, h: Column) -> Column:
        added = [
            (acc[c] + F.shiftrightunsigned(h, j).bitwiseAND(mask)).alias(c) for j, c in enumerate(names)
        ]
        return F.struct(*added, (acc["n"] + 1).alias("n"))

    def finish(acc: Column) -> Column:
        low = F.lit((1 << width) - 1).cast("long")
        bits = [
            F.when(
                F.shiftrightunsigned(acc[f"c{b % sums}"], width * (b // sums)).bitwiseAND(low) * 2 > acc["n"],
                F.lit(1 << b).cast("long"),
            ).otherwise(F.lit(0).cast("long"))
            for b in range(BITS)
        ]
        return reduce(lambda x, y: x.bitwiseOR(y), bits)

    # Never null, and said so: else a join would have it worked out twice, to filter nulls.
    return F.coalesce(F.aggregate(grams, zero, add, finish), F.lit(0).cast("long"))


def block_masks(radius: int) -> list[int]:
    """Masks of radius + 1 blocks of nearly equal width."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def blocked(df: DataFrame, radius: int) -> DataFrame:
    """One row per block of the fingerprint ``fp``."""
    blocks = [
        F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits"))
        for k, m in enumerate(block_masks(radius))
    ]
    return df.select("*", F.inline(F.array(*blocks)))


def occurrences(grams: Column) -> Column:
    """The list as a set: each shingle with the number of its occurrence."""
    return F.transform(
        grams, lambda g, i: F.xxhash64(g, F.size(F.filter(F.slice(grams, 1, i + 1), lambda x: x == g)))
    )


def common_weight(a: Column, b: Column) -> Column:
    """Shingles that two lists share, each as often as it occurs in both."""
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    repeated = F.size(F.array_intersect(occurrences(a), occurrences(b)))
    return F.when(once, F.size(F.array_intersect(a, b))).otherwise(repeated)


def item_table(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, list[int]]:
    """(item, m, k, grams) of the items with words, and the shingle sizes that occur (five at most)."""
    worded = items.select(F.col(item_id).alias("item"), word_hashes(F.col(text)).alias("words"))
    worded = worded.where(F.size("words") > 0).select(
        "item", "words", F.size("words").alias("m"), F.least(F.size("words"), F.lit(SHINGLE)).alias("k")
    )
    sizes = sorted(r["k"] for r in worded.select("k").distinct().collect())
    if not sizes:
        return worded.select("item", "m", "k", F.array().cast("array<bigint>").alias("grams")), sizes
    grams = by_size(F.col("k"), sizes, lambda k: shingles(F.col("words"), k))
    return worded.select("item", "m", "k", grams.alias("grams")), sizes


def in_parts(worded: DataFrame, more: int) -> DataFrame:
    """The rows of ``worded`` with n, the number of their words, and instead of these a row for each ``part``.

    A part has ``PART`` words and ``more`` of those that follow.
    """
    kept = [c for c in worded.columns if c != "words"]
    counted = worded.select(*kept, F.size("words").alias("n"), "words")
    begins = F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(PART))
    parts = F.transform(begins, lambda at: F.slice("words", at + 1, PART + more))
    return counted.select(*kept, "n", F.posexplode(parts).alias("part", "words"))


def shared_places(worded: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """(k1, k2, n, m, k, at): places of texts with a shingle that an item of m words holds too."""
    known = items.select("m", "k", F.explode(F.array_distinct("grams")).alias("h")).distinct()
    known = size_checked(known, BROADCAST_SHINGLES)
    # Of the columns only the list that is exploded mentions the words: another one would copy them into every row.
    found = [
        in_parts(worded, k - 1).select(
            "k1", "k2", "n", "part", F.posexplode(shingles(F.col("words"), k)).alias("place", "h")
        )
        for k in sizes
    ]
    at = (F.col("part") * PART + F.col("place")).alias("at")
    return reduce(DataFrame.union, found).join(known, "h").select("k1", "k2", "n", "m", "k", at)


def possible_windows(places: DataFrame, similar: float) -> DataFrame:
    """(k1, k2, m, k, start) of the windows that can be similar to an item of m words.

    At most a share of 1 - similar of such a window's shingles is not the item's, so a shared
    one stands among that many and one more at its head, and as well at its tail.
    """
    last = F.greatest(F.col("n") - F.col("m"), F.lit(0))
    held = F.least("m", "n") - F.col("k") + 1
    foreign = F.floor(held * (1 - similar) + 1e-9).cast("int")

    def starts(lowest: Column, highest: Column) -> Column:
        low, high = F.greatest(lowest, F.lit(0)), F.least(highest, last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    head = starts(F.col("at") - foreign, F.col("at"))
    tail = starts(F.col("at") - held + 1, F.col("at") - held + 1 + foreign)
    key = ["k1", "k2", "m", "k", "start"]
    laid = [
        places.select(*key[:-1], F.explode(s).alias("start"), F.lit(side).alias("side"))
        for side, s in enumerate((head, tail))
    ]
    return (
        laid[0].union(laid[1]).groupBy(*key).agg(F.min("side").alias("a"), F.max("side").alias("b"))
        .where("a < b").select(*key)
    )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similar: float = SIMILAR,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per text and item it holds: k1, k2 (the text's key), id, item, similarity, first_word, n_words."""
    item_rows, sizes = item_table(items, item_id, item_text)
    item_rows = written(item_rows, "leak-items")
    longest = item_rows.agg(F.max("m")).first()[0]
    if not sizes:
        schema = f"k1 long, k2 long, id {dict(docs.dtypes)[id_col]}, item {dict(items.dtypes)[item_id]}"
        empty = docs.sparkSession.createDataFrame([], schema + ", similarity double, first_word int, n_words int")
        return empty
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), *row_key(id_col, text))
    worded = keyed.select("k1", "k2", word_hashes(F.col("text")).alias("words"))
    places = written(shared_places(worded, item_rows, sizes), "leak-places")
    key = ["k1", "k2", "part"]
    around = (
        possible_windows(places, similar)
        .groupBy("k1", "k2", F.floor(F.col("start") / PART).cast("int").alias("part"))
        .agg(F.collect_list(F.struct("m", "k", "start")).alias("windows"))
    )
    around = written(around, "leak-windows")
    hit = size_checked(around.select("k1", "k2").distinct(), BROADCAST_TEXTS)
    texts = keyed.join(hit, ["k1", "k2"], "left_semi")
    texts = in_parts(texts.select("k1", "k2", "id", word_hashes(F.col("text")).alias("words")), longest)
    # Rows equal in id and text are one, so that no key has many rows to join.
    texts = texts.dropDuplicates(key).join(around.hint("merge"), key)
    texts = texts.select(*key, "id", "n", "windows", *[shingles(F.col("words"), k).alias(f"grams{k}") for k in sizes])
    laid = texts.select(*key, "id", "n", *[f"grams{k}" for k in sizes], F.inline("windows"))
    cut = F.least("m", "n") - F.col("k") + 1
    place = F.col("start") - F.col("part") * PART
    grams = by_size(F.col("k"), sizes, lambda k: F.slice(f"grams{k}", place + 1, cut))
    windows = laid.select("k1", "k2", "id", "m", "start", F.least("m", "n").alias("n_words"), grams.alias("grams"))
    windows = windows.select("*", simhash(F.col("grams"), longest).alias("fp"))
    searched = item_rows.select("item", "m", F.col("grams").alias("item_grams"), simhash(F.col("grams"), longest).alias("fp"))
    index = size_checked(blocked(searched, radius).withColumnRenamed("fp", "item_fp"), BROADCAST_BLOCKS)
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, k) for k, m in enumerate(block_masks(radius))])
    near = (
        blocked(windows, radius)
        .join(index, ["m", "block", "bits"])
        .where((F.bit_count(apart) <= radius) & (first == F.col("block")))
        .select("k1", "k2", "id", "item", "start", "n_words", "grams", "item_grams")
    )
    both = near.withColumn("common", common_weight(F.col("grams"), F.col("item_grams")))
    union = F.size("grams") + F.size("item_grams") - F.col("common")
    exact = both.select(
        "k1", "k2", "id", "item", "start", "n_words", (F.col("common") / union).alias("similarity")
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words"))
    return (
        exact.where(F.col("similarity") >= similar)
        .groupBy("k1", "k2", "id", "item")
        .agg(best.alias("best"))
        .select(
            "k1", "k2", "id", "item", "best.similarity",
            (-F.col("best.back")).alias("first_word"), "best.n_words",
        )
    )


def leaked_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """One row per document id and item: ids, ``similarity``, ``first_word`` and ``n_words`` of the best window."""
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("back"), "n_words"))
    return (
        leaks(docs, items, id_col, item_id=item_id)
        .groupBy("id", "item")
        .agg(best.alias("best"))
        .select(
            F.col("id").alias(id_col),
            F.col("item").alias(item_id),
            "best.similarity",
            (-F.col("best.back")).alias("first_word"),
            "best.n_words",
        )
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, columns unchanged."""
    found = leaks(docs, items, id_col, text).select(F.col("k1").alias("leak1"), F.col("k2").alias("leak2"))
    found = size_checked(written(found.distinct(), "leaked"), BROADCAST_TEXTS)
    key1, key2 = row_key(id_col, text)
    return docs.join(found, (key1 == found["leak1"]) & (key2 == found["leak2"]), "left_anti")
