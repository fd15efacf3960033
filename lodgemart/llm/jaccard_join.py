"""N-gram Jaccard join: size-aware, small sets by subsets, large sets by inverted lists.

A document's set is that of its distinct 5-word shingles (of the whole word sequence if it
has fewer words). Documents link when 100 * |A and B| >= 80 * |A or B|; the result is the
connected component of each document.

1. Equal sets become one class: their documents link without any join.
2. All sets are put in one global order, rare shingles first. With n shingles, a set shares at
   least ceil(0.8 n) of them with any set it links to, so two linked sets share a shingle among
   the first n - ceil(0.8 n) + 1 of each, and k shingles among the first n - ceil(0.8 n) + k.
   The order counts shingles whose hash lies in a zone (a third of all) by the number of rows
   that hold them; the others come last, by hash, and are only sent for sets that need them.
   A shingle that no other set holds joins nothing, so most sets send nothing further.
3. Small sets (n up to a boundary) meet on subsets of ``SUBSET`` shingles of their prefix; large
   sets, and small ones that could link to a large one, meet in the inverted lists of single
   shingles. The boundary is the one of least cost: subsets to be written against entries of
   the lists to be scanned, summed over all sets by size.
   Both kinds are kept apart by size, as sets that link differ by a quarter at most.
4. Sets that met are tied to the first of their list, and the ties' components are clusters: a
   linear number of edges that loses no link. Within a cluster the links are verified on the
   whole sets, each sent once; a cluster of more than ``BLOCK_SHINGLES`` is dealt to blocks, and
   every pair of blocks is a task. A task returns a spanning forest of its links.

A set is named by a 64-bit hash, and shingles are compared by 64-bit hashes.

Defined cases: a text without words, or null, links with nothing and is its own component; a
null id joins its component but never names it unless all ids are null; repeated rows are
copies; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.llm import text as X
from lodgemart.llm.common import row_key, size_checked
from lodgemart.llm.components import components, written

SHINGLE = 5
PERCENT = 80
SUBSET = 2
ZONE_SHARE = 3  # one shingle in so many lies in the counted zone
LARGEST_BOUNDARY = 64
BLOCK_SHINGLES = 1_500_000
#: Names of clustered sets that may be sent to all tasks; more are joined by shuffling.
BROADCAST_SETS = 1_000_000

IN_ZONE, OUT_OF_ZONE, EXTENSION = 0, 1, 2


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf, offsets = X.flat(column)
    low = X.LOWER[buf]
    starts, ends, first = X.word_spans(low, offsets)
    hashes = X.word_hashes(low, starts, ends)
    keys, at = X.windows(hashes, first, SHINGLE)
    bounds = np.searchsorted(at, first)
    out = []
    for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        own = keys[a:b]
        words = hashes[first[row] : first[row + 1]]
        if not len(own) and len(words):
            own, _ = X.windows(words, np.array([0, len(words)]), len(words))
        out.append(np.unique(own))
    return out


def set_name(keys: np.ndarray) -> int:
    """A 64-bit hash of a whole set."""
    if not len(keys):
        return 0
    total = np.bitwise_xor.reduce(X.mix(keys + np.uint64(7)), keepdims=True)
    total += keys.sum(keepdims=True) + np.uint64(len(keys))
    return int(X.mix(total).view(np.int64)[0])


def least_common(n: int, percent: int) -> int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in X.slices(batch, "text"):
            sets = shingle_sets(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_name(s) for s in sets], pa.int64()),
                ],
                ["id", "n", "c"],
            )


def postings(keys: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles to send for one set, and for each n << 32 | zone size << 2 | kind."""
    n = len(keys)
    inside = keys < np.uint64(2**64 // ZONE_SHARE)
    z = int(inside.sum())
    prefix = n - least_common(n, percent) + 1
    out = keys[~inside][: max(0, prefix + SUBSET - 1 - z)]
    kinds = np.full(z + len(out), IN_ZONE, np.int64)
    kinds[z : z + max(0, prefix - z)] = OUT_OF_ZONE
    kinds[z + max(0, prefix - z) :] = EXTENSION
    return np.concatenate([keys[inside], out]), (n << 32) | (z << 2) | kinds


def _posted(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # copies within a task are sent once
        for batch in batches:
            for piece in X.slices(batch, "text"):
                columns = []
                for keys in shingle_sets(piece.column("text")):
                    name = set_name(keys)
                    if len(keys) and name not in sent:
                        sent.add(name)
                        h, meta = postings(keys, percent)
                        columns.append((h, np.full(len(h), name, np.int64), meta))
                if columns:
                    h, c, meta = (np.concatenate(x) for x in zip(*columns, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(c), pa.array(meta)], ["h", "c", "meta"]
                    )

    return run


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent: set[int] = set()
    for batch in batches:
        for piece in X.slices(batch, "text"):
            sets = {set_name(s): s for s in shingle_sets(piece.column("text"))}
            sets = {c: s for c, s in sets.items() if c not in sent}
            sent.update(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sets), pa.int64()), pa.array([s.tobytes() for s in sets.values()], pa.binary())],
                ["c", "shingles"],
            )


def prefixes(texts: DataFrame, percent: int) -> DataFrame:
    """(c, n, base, keys): the shingles (kind, f, h) of each set's prefix that other rows hold too.

    The first ``base`` of them lie in the prefix proper, the others in its extension for subsets.
    """
    sent = texts.select("text").mapInArrow(_posted(percent), "h long, c long, meta long")
    held = sent.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    meta = F.col("meta")
    shared = sent.join(held, "h").select(
        "c",
        F.shiftright(meta, 32).alias("n"),
        (F.shiftright(meta, 2).bitwiseAND(F.lit((1 << 30) - 1))).alias("z"),
        meta.bitwiseAND(F.lit(3)).alias("kind"),
        "f",
        "h",
    )
    # The kind comes first: shingles of the zone stand before all others, extensions last.
    keys = F.array_sort(F.collect_set(F.struct("kind", "f", "h")))
    sets = shared.groupBy("c", "n", "z").agg(keys.alias("all"))

    def of_kind(kind: int) -> Column:
        return F.size(F.filter("all", lambda k: k["kind"] == kind))

    sets = sets.withColumns({"inside": of_kind(IN_ZONE), "outside": of_kind(OUT_OF_ZONE)})
    # Places of the prefix left after the zone's shingles that no other row holds.
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    sets = sets.withColumn("room", (prefix - F.col("z") + F.col("inside")).cast("int"))
    base = F.when(F.col("room") <= F.col("inside"), F.greatest("room", F.lit(0))).otherwise(
        F.col("inside") + F.col("outside")
    )
    longer = F.col("room") + (SUBSET - 1)
    taken = F.when(longer <= F.col("inside"), F.greatest(longer, F.lit(0))).otherwise(F.size("all"))
    return sets.withColumns({"base": base, "taken": taken}).where("taken > 0").select(
        "c", "n", "base", F.slice("all", F.lit(1), F.col("taken")).alias("keys")
    )


def cheapest_boundary(prefix: DataFrame) -> int:
    """The size up to which subsets cost less than inverted lists, over all sets; at most 64 rows are read."""
    m = F.size("keys").cast("long")
    lists = F.aggregate(F.slice("keys", F.lit(1), F.col("base")), F.lit(0).cast("long"), lambda s, k: s + k["f"])
    costs = (
        prefix.where(F.col("n") <= LARGEST_BOUNDARY)
        .groupBy("n")
        .agg(F.sum(m * (m - 1) / 2).alias("subsets"), F.sum(lists).alias("lists"))
        .collect()
    )
    saved, best, boundary = 0.0, 0.0, 0
    for row in sorted(costs, key=lambda r: r["n"]):
        saved += float(row["lists"] - row["subsets"])
        if saved > best:
            best, boundary = saved, int(row["n"])
    return boundary


def size_step(n: Column, percent: int) -> Column:
    """The step of a size on a scale on which linked sizes are one apart at most."""
    if percent == 100:
        return n * 2
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(100 / percent))).cast("long")


def meetings(prefix: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Edges (a, b) that tie each set to the first of every list or subset it is in.

    Lists are kept by size as well: sets that link differ by one step of the size scale at
    most, so each set stands in the lists of its own step and of the next.
    """
    prefix = prefix.withColumn("step", F.explode(F.array(size_step(F.col("n"), percent), size_step(F.col("n"), percent) + 1)))
    single = prefix.where((F.col("base") > 0) & (F.col("n") * 100 >= (boundary + 1) * percent)).select(
        "c", "step", F.explode(F.slice("keys", F.lit(1), F.col("base"))).alias("k")
    )
    lists = single.select("c", F.xxhash64(F.lit(1), "step", F.col("k.h")).alias("key"))

    def pairs(i: Column) -> Column:
        return F.transform(
            F.slice("keys", i + 2, F.size("keys")),
            lambda k: F.xxhash64(
                F.lit(2), F.col("step"), F.least(k["h"], F.get("keys", i)["h"]), F.greatest(k["h"], F.get("keys", i)["h"])
            ),
        )

    small = prefix.where((F.col("n") <= boundary) & (F.size("keys") > 1))
    subsets = small.select(
        "c",
        F.explode(F.flatten(F.transform(F.sequence(F.lit(0), F.size("keys") - 2), pairs))).alias("key"),
    )
    met = lists.union(subsets)
    heads = met.groupBy("key").agg(F.min("c").alias("head"), F.max("c").alias("other")).where("head < other")
    return met.join(heads, "key").where("c <> head").select(F.col("c").alias("a"), F.col("head").alias("b")).distinct()


def links_within(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``left``, or between ``left`` and ``right``, by place.

    Inverted lists of the shingles that several sets hold are scanned set by set.
    """
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    members, ends = owner[order], np.cumsum(held)
    begins = ends - held
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    label = np.arange(len(sets))
    forest = []
    for a in range(len(left)):
        mine = column[bounds[a] : bounds[a + 1]]
        mine = mine[held[mine] > 1]
        spans = held[mine]
        if not len(spans):
            continue
        at = np.repeat(begins[mine] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
        common = np.bincount(members[at], minlength=len(sets))
        hit = 100 * common >= percent * (sizes + sizes[a] - common)
        hit[: a + 1 if right is None else len(left)] = False
        for b in np.flatnonzero(hit):
            if label[a] != label[b]:
                forest.append((a, int(b)))
                label[label == label[b]] = label[a]
    return forest


def _verified(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["c", "side", "shingles"]).to_pylist()
        rows.sort(key=lambda r: (r["side"], r["c"]))
        sides: list[list[np.ndarray]] = [[], []]
        seen: set[tuple[int, int]] = set()
        names = []
        for r in rows:
            if (r["side"], r["c"]) not in seen:
                seen.add((r["side"], r["c"]))
                names.append(r["c"])
                sides[r["side"]].append(np.frombuffer(r["shingles"], np.uint64))
        found = links_within(sides[0], sides[1] or None, percent) if sides[0] else []
        a, b = [names[x] for x, _ in found], [names[y] for _, y in found]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def verified_links(texts: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sets that span each component; ``clusters`` is (c, cluster, n)."""
    blocks = clusters.groupBy("cluster").agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks")
    )
    dealt = clusters.join(blocks, "cluster").select(
        "c", "cluster", "blocks", F.pmod(F.xxhash64("c", F.lit(3)), "blocks").cast("int").alias("mine")
    )
    sets = texts.select("text").mapInArrow(_whole_sets, "c long, shingles binary")
    sent = sets.join(size_checked(dealt, BROADCAST_SETS), "c")
    # Block i meets block j in the task (min, max) of them; itself in the task (i, i).
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"),
        "c",
        "shingles",
    )
    return sent.groupBy("cluster", "i", "j").applyInArrow(_verified(percent), "a long, b long")


def _component_rows(docs: DataFrame, id_col: str, text: str, percent: int) -> DataFrame:
    """One row per row: id, n, c, ``root`` (the component's least set name), ``component_id``."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = written(
        texts.mapInArrow(_named, f"id {dict(texts.dtypes)['id']}, n long, c long"), "jaccard-rows"
    )
    prefix = written(prefixes(texts, percent), "jaccard-prefixes")
    ties = components(meetings(prefix, cheapest_boundary(prefix), percent), "jaccard-clusters")
    roots = ties.select(F.col("root").alias("c")).distinct().select("c", F.col("c").alias("cluster"))
    clusters = ties.select(F.col("node").alias("c"), F.col("root").alias("cluster")).union(roots)
    clusters = written(clusters.join(prefix.select("c", "n"), "c"), "jaccard-clusters")
    root = components(verified_links(texts, clusters, percent), "jaccard-links")
    classes = rows.where("n > 0").groupBy("c").agg(F.min("id").alias("least"))
    classes = classes.join(root.withColumnRenamed("node", "c"), "c", "left").withColumn(
        "root", F.coalesce("root", "c")
    )
    named = classes.groupBy("root").agg(F.min("least").alias("component"))
    by_set = classes.join(named, "root").select("c", "root", "component")
    linked = rows.join(by_set, "c", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return linked.select("id", "n", "c", "root", component.alias("component_id"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per row: id, ``n_shingles``, ``component_id`` (the smallest id reachable by links)."""
    found = _component_rows(docs, id_col, text, percent)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id names their component, columns unchanged.

    Rows without id are kept. Rows that share an id are told apart by their texts: each component
    keeps one row, texts without words one of each text.
    """
    found = _component_rows(docs, id_col, text, percent)
    dropped = found.where("component_id <> id").select(F.col("id").alias("gone")).distinct()
    repeated = docs.groupBy(F.col(id_col).alias("gone")).count().where("count > 1 and gone is not null")
    repeated = written(repeated.select("gone"), "jaccard-repeated")
    again = not repeated.isEmpty()
    dropped = written(dropped.union(repeated).distinct() if again else dropped, "jaccard-dropped")
    dropped = size_checked(dropped, BROADCAST_SETS)
    kept = docs.join(dropped, docs[id_col] == dropped["gone"], "left_anti")
    if not again:
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.join(repeated, docs[id_col] == repeated["gone"], "left_semi")
    named = own.select(
        F.struct(F.col(id_col).alias("id"), *row_key(id_col, text)).alias("id"), F.col(text).alias("text")
    )
    named = named.mapInArrow(_named, f"id {dict(named.dtypes)['id']}, n long, c long").select("id.*", "n", "c")
    least = found.where("component_id = id").select("id", "c", "root").distinct()
    keys = (
        named.distinct()
        .join(least, ["id", "c"])
        .groupBy("id", "root", F.when(F.col("n") == 0, F.struct("k1", "k2")).alias("empty"))
        .agg(F.min(F.struct("k1", "k2")).alias("k"))
        .select("k.*")
    )
    one = own.select(*row_key(id_col, text), row).join(keys, ["k1", "k2"])
    return kept.union(one.groupBy("k1", "k2").agg(F.any_value("row").alias("row")).select("row.*"))
