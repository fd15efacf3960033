"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks. Block j of a source with weight w is released
at slot floor(j / w) and due before slot ceil((j + 1) / w); in every slot the released block
with the earliest deadline goes out. On one line of slots with weights summing to 1 that
order misses no deadline, so at any slot t a source has sent w * t blocks, give or take less
than one. The weights are taken as the exact fractions they are; the slots are worked out one
after the other in a stream, a block of rows each, and blocks meet their slots by source and
chunk of ``CHUNK`` blocks. When a source has no blocks left, a new phase starts with the weights
of those that remain.

With a ``period``, weights are first rounded to multiples of 1 / period, and a schedule of one
period is repeated: the bound then holds for the rounded weights only.

Defined cases: a null source is a source of its own; a null id is an id; equal (source, id)
rows each get a place of their own; sources without a weight given take none away from the others and
follow after all weighted ones, in equal shares; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import reduce
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from lodgemart.llm.components import written
from lodgemart.schemas import comparable

BLOCK_ROWS = 64
PERIOD = 1_000
CHUNK = 1_024
BUCKET_ROWS = 4_096
PLACES = 10_000  # places listed in one cell
#: Rows of a repeated schedule, and blocks of a whole one, that may be sent to all tasks; a longer one is
#: joined by shuffling.
BROADCAST_ROWS = 20_000
BROADCAST_BLOCKS = 1_000_000

PHASES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("is_null", T.BooleanType()),
        T.StructField("first_block", T.LongType()),
        T.StructField("end_block", T.LongType()),
        T.StructField("share", T.LongType()),
        T.StructField("period", T.LongType()),
        T.StructField("base", T.LongType()),
        T.StructField("places", T.ArrayType(T.LongType())),
    ]
)


SLOTS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("is_null", T.BooleanType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("slots", T.ArrayType(T.LongType())),
    ]
)


def whole_parts(weights: Mapping) -> dict:
    """Weights as whole numbers in exactly their proportions."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(f.denominator for f in exact.values()))
    return {s: int(f * scale) for s, f in exact.items()}


def block_sources(blocks: Mapping, weights: Mapping) -> Iterator:
    """The source whose next block goes out, slot by slot: earliest deadline first by the exact weights."""
    left = {s: n for s, n in blocks.items() if n > 0}
    while left:
        active = {s: weights.get(s) or 0 for s in left}
        if not any(w > 0 for w in active.values()):
            active = dict.fromkeys(left, 1)
        parts = whole_parts({s: w for s, w in active.items() if w > 0})
        total = sum(parts.values())
        names = sorted(parts, key=lambda s: (s is not None, str(s)))
        sizes = [parts[s] for s in names]
        sent = [0] * len(names)
        waiting, ready = [(0, rank) for rank in range(len(names))], []
        t = 0
        while True:
            while waiting and waiting[0][0] <= t:
                _, rank = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(sent[rank] + 1) * total // sizes[rank]), rank))
            _, rank = heapq.heappop(ready)
            yield names[rank]
            t += 1
            sent[rank] += 1
            if sent[rank] == left[names[rank]]:
                break
            heapq.heappush(waiting, (sent[rank] * total // sizes[rank], rank))
        for s, n in zip(names, sent, strict=True):
            left[s] -= n
        left = {s: n for s, n in left.items() if n}


def _slot_rows(blocks: Mapping, weights: Mapping):
    """The slots of each source's blocks, ``CHUNK`` blocks to a row, as they are worked out."""

    def batch(rows: list) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        kinds = pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], SLOTS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sum(b.num_rows for b in batches):
            return
        open_: dict = {}
        chunks: dict = {}
        rows = []
        for slot, s in enumerate(block_sources(blocks, weights)):
            mine = open_.setdefault(s, array("q"))
            mine.append(slot)
            if len(mine) == CHUNK:
                chunks[s] = chunks.get(s, 0) + 1
                rows.append((s or "", s is None, chunks[s] - 1, np.frombuffer(open_.pop(s), np.int64)))
                if len(rows) == 64:
                    yield batch(rows)
                    rows = []
        rows += [(s or "", s is None, chunks.get(s, 0), np.frombuffer(mine, np.int64)) for s, mine in open_.items()]
        for at in range(0, len(rows), 4_096):
            yield batch(rows[at : at + 4_096])

    return run


def slot_frame(spark: SparkSession, counts: Mapping, weights: Mapping, block_rows: int) -> DataFrame:
    """The slots of all blocks as a frame, marked for broadcast if it is short."""
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    one = spark.range(0, 1, 1, 1)  # each slot depends on those before it
    frame = written(one.mapInArrow(_slot_rows(blocks, dict(weights)), SLOTS), "mix-slots")
    return F.broadcast(frame) if sum(blocks.values()) <= BROADCAST_BLOCKS else frame


def shares(weights: Mapping, period: int) -> dict:
    """Weights as whole shares of the period, by largest remainder, one at least for each."""
    period = max(period, 2 * len(weights))
    total = float(sum(weights.values()))
    exact = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s is not None, str(s)))
    for s in rest[: period - sum(out.values())]:
        out[s] += 1
    return out


def one_period(parts: Mapping) -> dict:
    """The slots of each source's blocks within a period, earliest deadline first."""
    period = sum(parts.values())
    names = sorted(parts, key=lambda s: (s is not None, str(s)))
    release: list[list] = [[] for _ in range(period)]
    for rank, s in enumerate(names):
        for j in range(parts[s]):
            release[j * period // parts[s]].append((-(-(j + 1) * period // parts[s]), rank))
    slots: dict = {s: [] for s in names}
    ready: list = []
    for t in range(period):
        for block in release[t]:
            heapq.heappush(ready, block)
        _, rank = heapq.heappop(ready)
        slots[names[rank]].append(t)
    return slots


def plan_phases(blocks: Mapping, weights: Mapping, period: int = PERIOD) -> list[tuple]:
    """Rows (source, first block, end block, share, period, first slot, places) of a repeated schedule."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    base, rows = 0, []
    while left:
        active = {s: float(weights.get(s) or 0) for s in left}
        if not any(w > 0 for w in active.values()):
            active = dict.fromkeys(left, 1.0)
        parts = shares({s: w for s, w in active.items() if w > 0}, period)
        places = one_period(parts)
        size = sum(parts.values())
        end = min((left[s] - 1) // k * size + places[s][(left[s] - 1) % k] + 1 for s, k in parts.items())
        for s, k in parts.items():
            sent = end // size * k + int(np.searchsorted(places[s], end % size))
            if sent:
                rows.append((s, done[s], done[s] + sent, k, size, base, places[s]))
            done[s] += sent
            left[s] -= sent
        left = {s: n for s, n in left.items() if n}
        base += end
    return rows


def tempered(counts: Mapping, power: float) -> dict:
    """Target weights: each source's number of rows to a power."""
    return {s: n**power for s, n in counts.items()}


def source_counts(df: DataFrame, source: str) -> dict:
    """Rows by source: one row for each source reaches the driver."""
    rows = df.groupBy(F.col(source).cast("string").alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["s"]: r["n"] for r in rows}


def schedule_frame(
    spark: SparkSession, counts: Mapping, weights: Mapping, block_rows: int, period: int | None = None
) -> DataFrame:
    """The schedule as a frame, marked for broadcast if it is short."""
    if period is None:
        return slot_frame(spark, counts, weights, block_rows)
    rows = plan_phases({s: -(-n // block_rows) for s, n in counts.items()}, weights, period)
    packed = [(s or "", s is None, *map(int, rest), [int(x) for x in places]) for s, *rest, places in rows]
    frame = spark.createDataFrame(packed, PHASES)
    return F.broadcast(frame) if len(rows) <= BROADCAST_ROWS else frame


def ranks(df: DataFrame, id_col: str, source: str, total: int) -> DataFrame:
    """(s, id, n, start): the n rows of an id take places start, start + 1, ... of their source.

    Ids are dealt to buckets by hash, so a source with most of the rows is ranked by many tasks.
    """
    buckets = max(1, -(-total // BUCKET_ROWS))
    ids = df.groupBy(F.col(source).cast("string").alias("s"), F.col(id_col).alias("id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ids = ids.withColumn("k", F.xxhash64("id")).withColumn("b", F.pmod(F.col("k"), F.lit(buckets)))
    sizes = ids.groupBy("s", "b").agg(F.sum("n").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("s").orderBy("b")) - F.col("rows")
    sizes = sizes.select(F.col("s").alias("s2"), F.col("b").alias("b2"), before.alias("before"))
    inside = F.sum("n").over(Window.partitionBy("s", "b").orderBy("k", "id")) - F.col("n")
    return (
        ids.withColumn("inside", inside)
        .join(sizes, F.col("s").eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2")))
        .select("s", "id", "n", (F.col("before") + F.col("inside")).alias("start"))
    )


def placed(ranked: DataFrame, schedule: DataFrame, block_rows: int) -> DataFrame:
    """Adds block, slot and position to rows with a source ``s`` and a rank in it."""
    block = F.floor(F.col("rank") / F.lit(block_rows)).cast("long")
    mine = (F.coalesce(F.col("s"), F.lit("")) == F.col("key")) & (F.col("s").isNull() == F.col("is_null"))
    if "chunk" in schedule.columns:
        mine &= F.floor(F.col("block") / F.lit(CHUNK)).cast("long") == F.col("chunk")
        slot: Column = F.element_at("slots", (F.col("block") % F.lit(CHUNK) + 1).cast("int"))
    else:
        mine &= (F.col("block") >= F.col("first_block")) & (F.col("block") < F.col("end_block"))
        nth = F.col("block") - F.col("first_block")
        inside: Column = F.element_at("places", (nth % F.col("share") + 1).cast("int"))
        slot = F.col("base") + F.floor(nth / F.col("share")).cast("long") * F.col("period") + inside
    joined = ranked.withColumn("block", block).join(schedule, mine).withColumn("slot", slot)
    return joined.withColumn(
        "position", F.col("slot") * block_rows + F.col("rank") % F.lit(block_rows)
    ).drop(*schedule.columns)


def mix_ids(
    df: DataFrame,
    weights: Mapping | None = None,
    id_col: str = "doc_id",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
    period: int | None = None,
    power: float = 0.5,
) -> DataFrame:
    """One row per row of ``df``: id, source, ``block`` of the source, ``slot``, ``position``.

    ``weights`` by source; None takes the sources' row counts to ``power``. A ``period`` rounds them.
    """
    counts = source_counts(df, source)
    schedule = schedule_frame(df.sparkSession, counts, weights or tempered(counts, power), block_rows, period)
    ranked = ranks(df, id_col, source, sum(counts.values()))
    return placed(_each_place(ranked), schedule, block_rows).select(
        F.col("id").alias(id_col), F.col("s").alias(source), "block", "slot", "position"
    )


def _content(df: DataFrame) -> list[Column]:
    """128 bits that rows with equal values share."""
    held = [F.col(f"`{f.name}`") for f in df.schema if comparable(f.dataType)]
    return [F.xxhash64(*held).alias("k1"), F.xxhash64(F.lit(3), *reversed(held)).alias("k2")]


def _same(left: str, right: str, *names: str) -> Column:
    pairs = [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    return reduce(Column.__and__, pairs)


def _each_place(rows: DataFrame) -> DataFrame:
    """A row for each of the ``n`` places from ``start`` on, listed in pieces of bounded length."""
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(PLACES))))
    low = F.col("start") + F.col("piece") * PLACES
    high = F.least(low + PLACES, F.col("start") + F.col("n")) - 1
    return rows.withColumn("piece", piece).withColumn("rank", F.explode(F.sequence(low, high))).drop("piece", "n", "start")


def _repeated(rows: DataFrame, ranked: DataFrame) -> DataFrame:
    """(s, id, row, rank) of the rows whose id is repeated, each with a place of its own.

    An id's rows are ordered by their content, in buckets, so that an id with most of the rows is
    ranked by many tasks. Rows that are equal in all columns are one row with a number of places.
    """
    many = ranked.where("n > 1")
    units = rows.groupBy("s", "id", "k1", "k2").agg(F.count(F.lit(1)).alias("m")).alias("u")
    units = units.join(many.alias("r"), _same("u", "r", "s", "id")).select(
        "u.*", "start", F.pmod("k1", F.ceil(F.col("n") / BUCKET_ROWS)).alias("b")
    )
    sizes = units.groupBy("s", "id", "b").agg(F.sum("m").alias("size"))
    before = F.sum("size").over(Window.partitionBy("s", "id").orderBy("b")) - F.col("size")
    sizes = sizes.withColumn("before", before).alias("z")
    inside = F.sum("m").over(Window.partitionBy("s", "id", "b").orderBy("k1", "k2")) - F.col("m")
    units = units.withColumn("inside", inside).alias("u")
    units = units.join(sizes, _same("u", "z", "s", "id", "b")).select(
        "u.s", "u.id", "k1", "k2", F.col("m").alias("n"), (F.col("start") + F.col("before") + F.col("inside")).alias("start")
    )
    one = rows.groupBy("s", "id", "k1", "k2").agg(F.first("row").alias("row")).alias("o")
    met = one.join(units.alias("u"), _same("o", "u", "s", "id", "k1", "k2"))
    return _each_place(met.select("u.s", "u.id", "row", "n", "start"))


def mix_rows(
    df: DataFrame,
    weights: Mapping | None = None,
    id_col: str = "doc_id",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
    period: int | None = None,
    power: float = 0.5,
) -> DataFrame:
    """The rows of ``df`` in mixed order, columns unchanged.

    Every row has a place of its own, rows of a repeated (source, id) too, so the bound of less
    than one block holds for all of them. It follows from the row's values alone.
    """
    counts = source_counts(df, source)
    schedule = schedule_frame(df.sparkSession, counts, weights or tempered(counts, power), block_rows, period)
    ranked = ranks(df, id_col, source, sum(counts.values()))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(source).cast("string").alias("s"),
        F.col(id_col).alias("id"),
        *_content(df),
    )
    once = rows.alias("w").join(ranked.alias("r"), _same("w", "r", "s", "id")).where("n = 1")
    found = once.select("w.s", "w.id", "row", F.col("start").alias("rank"))
    if ranked.where("n > 1").limit(1).count():
        found = found.unionByName(_repeated(rows, ranked))
    return placed(found, schedule, block_rows).orderBy("position").select("row.*")
