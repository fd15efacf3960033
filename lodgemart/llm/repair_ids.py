"""Token-id output with Re-Pair grammar compression.

Documents are put in order by range partitioning; each partition is a shard. A shard's ids
are cut at document ends into blocks of about ``BLOCK_IDS`` ids. In a block, the most
frequent pairs of neighbouring ids are replaced by new symbols, again and again, until no
pair occurs twice or the symbols of 16 bits are used up (of a larger vocabulary 65,536 beyond it);
the pairs of one round go in order of their counts, and where two overlap the more frequent one
is taken. A block's size bounds the memory of a task, and with it what one grammar covers. A block stores
its rules, the length of each rule's expansion, and its symbols, so a reader can find the
symbol that covers any place and expand no more than it needs.

File format: Parquet, one row per block, written by Spark's committer, so a lost task leaves
nothing behind. Columns: ``shard``, ``block`` (order within the shard), ``first_id`` (ids of
the shard before the block), ``n_ids``, ``base`` (number of plain ids; symbol base + r is
rule r), ``width`` (bytes of a symbol), ``rules`` (pairs of uint32), ``lengths`` (uint32 per
rule), ``symbols``, ``doc_ids``, ``doc_ends`` (ids of the block up to each document's end).
All binary columns are little-endian.

Defined cases: documents without id come first; equal ids are ordered by a hash of the text,
then by their row number in the scan; a null text is empty and stores the end id alone; a
document longer than a block has a block of its own; an empty table writes an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lodgemart.llm import pieces as P
from lodgemart.llm import text as X

BLOCK_IDS = 1 << 20
MIN_COUNT = 2
PAIRS_A_ROUND = 3_000
END_ID = 0

BLOCK_SCHEMA = (
    "shard int, block int, first_id long, n_ids long, base int, width int, rules binary, lengths binary, "
    "symbols binary, doc_ids array<{kind}>, doc_ends binary"
)


def pair_keys(seq: np.ndarray, half: int) -> np.ndarray:
    """Each pair of neighbours as one number, the left one in the upper half."""
    keys = seq[:-1].astype(np.uint32 if half == 16 else np.uint64)
    keys <<= keys.dtype.type(half)
    keys |= seq[1:]
    return keys


def best_pairs(keys: np.ndarray, room: int, min_count: int) -> np.ndarray:
    """The most frequent pairs, most frequent first."""
    keys = np.sort(keys)
    edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(edges, len(keys)))
    often = np.flatnonzero(counts >= min_count)
    take = min(room, PAIRS_A_ROUND)
    if len(often) > take:
        often = often[np.argpartition(-counts[often], take - 1)[:take]]
    often = often[np.lexsort((often, -counts[often]))]
    return keys[edges[often]]


def ranks_of(keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """For each place the rank of the pair that starts there, or the number of pairs."""
    bits = max(10, int(len(pairs)).bit_length() + 5)
    wide = keys.dtype == np.uint64
    factor = keys.dtype.type(0x9E3779B97F4A7C15 if wide else 0x9E3779B1)
    shift = keys.dtype.type((64 if wide else 32) - bits)

    def slot(x):
        return ((x * factor) >> shift).astype(np.int64)

    owner = np.full(1 << bits, len(pairs), np.int32)
    # Free slots hold a pair that no key in them can be equal to, as its own slot is another one.
    held = np.full(1 << bits, pairs[0])
    place = slot(pairs)[::-1]  # of pairs in one slot the most frequent one stays
    owner[place] = np.arange(len(pairs) - 1, -1, -1)
    held[place] = pairs[::-1]
    place = slot(keys)
    rank = owner.take(place)
    rank[held.take(place) != keys] = len(pairs)
    return rank


def chosen(rank: np.ndarray, none: int) -> np.ndarray:
    """Places of pairs that overlap no pair of a smaller rank; in a run of one rank every second place."""
    take = rank < none
    take[:-1] &= rank[:-1] <= rank[1:]
    follows = np.flatnonzero(rank[1:] == rank[:-1]) + 1
    take[1:] &= rank[1:] < rank[:-1]
    follows = follows[rank[follows] < none]
    if len(follows):
        at = np.arange(len(follows))
        begins = np.append(True, follows[1:] != follows[:-1] + 1)
        offset = at - np.maximum.accumulate(np.where(begins, at, 0)) + 1
        even = follows[offset % 2 == 0]
        after = np.append(rank, none)[even + 1]
        take[even[rank[even] <= after]] = True
    return np.flatnonzero(take)


def compress(
    ids: np.ndarray, base: int, min_count: int = MIN_COUNT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (rows of two symbols) and lengths of their expansions."""
    seq = ids.astype(np.uint32)
    rules, lengths = [], []
    half = 16 if base < 1 << 16 else 32
    limit = 1 << 16 if half == 16 else base + (1 << 16)
    next_symbol = base
    size_of = np.ones(limit, np.uint32)
    while len(seq) > 1 and next_symbol < limit:
        keys = pair_keys(seq, half)
        pairs = best_pairs(keys, limit - next_symbol, min_count)
        if not len(pairs):
            break
        rank = ranks_of(keys, pairs)
        take = chosen(rank, len(pairs))
        if not len(take):
            break
        seen = np.bincount(rank[take], minlength=len(pairs)) > 0
        code = np.cumsum(seen) - 1
        pair = pairs[seen]
        low = pair.dtype.type((1 << half) - 1)
        pair = np.stack([pair >> pair.dtype.type(half), pair & low], 1).astype(np.uint32)
        size_of[next_symbol : next_symbol + len(pair)] = size_of[pair[:, 0]] + size_of[pair[:, 1]]
        rules.append(pair)
        lengths.append(size_of[next_symbol : next_symbol + len(pair)].copy())
        seq[take] = next_symbol + code[rank[take]]
        keep = np.ones(len(seq), bool)
        keep[take + 1] = False
        seq = seq[keep]
        next_symbol += len(pair)
    none = np.zeros((0, 2), np.uint32)
    return seq, np.concatenate([none, *rules]), np.concatenate([none[:, 0], *lengths])


def expansions(rules: np.ndarray, lengths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rules in a row, and where each begins; whole rounds of rules at a time."""
    starts = P.upto(lengths)
    flat = np.zeros(starts[-1], np.uint32)
    done = 0
    while done < len(rules):
        part = rules[done:]
        bad = np.flatnonzero((part >= base + done).any(1))  # rules that need others not yet expanded
        to = done + (int(bad[0]) if len(bad) else len(part))
        for side in (0, 1):
            symbol = rules[done:to, side].astype(np.int64)
            plain = symbol < base
            size = np.ones(len(symbol), np.int64)
            size[~plain] = lengths[symbol[~plain] - base]
            at = starts[done:to] if side == 0 else starts[done + 1 : to + 1] - size
            flat[at[plain]] = symbol[plain]
            rule = symbol[~plain] - base
            spot = np.repeat(at[~plain] - P.upto(size[~plain])[:-1], size[~plain]) + np.arange(size[~plain].sum())
            flat[spot] = P.gather(flat, starts[rule], size[~plain])
        done = to
    return flat, starts


class Block:
    """A stored block, decoded in parts or whole."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], "<u2" if row["width"] == 2 else "<u4").astype(np.int64)
        flat, starts = expansions(self.rules, self.lengths, self.base)
        # Of every symbol, plain or rule: its ids in the pool, and how many they are.
        self.pool = np.concatenate([np.arange(self.base, dtype=np.uint32), flat])
        self.starts = np.concatenate([np.arange(self.base), starts[:-1] + self.base])
        self.lasting = np.concatenate([np.ones(self.base, np.int64), self.lengths])
        self.sizes = self.lasting.take(self.symbols)
        self.ends = np.cumsum(self.sizes)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from place ``start`` up to ``end``; expands the symbols that cover them only."""
        if end <= start:
            return np.zeros(0, np.uint32)
        lo = int(np.searchsorted(self.ends, start, "right"))
        hi = int(np.searchsorted(self.ends, end, "left")) + 1
        before = int(self.ends[lo] - self.sizes[lo])
        found = P.gather(self.pool, self.starts.take(self.symbols[lo:hi]), self.sizes[lo:hi])
        return found[start - before : end - before]


def block_rows(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema, end_id: int):
    """Encodes a shard's documents in order and yields its blocks."""
    table = P.table_of(path)
    shard, block, first_id = TaskContext.get().partitionId(), 0, 0
    base = max(table.tok.get_vocab_size(with_added_tokens=True), end_id + 1)
    held: list[np.ndarray] = []
    docs: list = []
    ends: list[int] = []
    size = 0

    def flush() -> pa.RecordBatch:
        symbols, rules, lengths = compress(np.concatenate(held), base)
        width = 2 if not len(symbols) or symbols.max() < 1 << 16 else 4
        row = {
            "shard": shard,
            "block": block,
            "first_id": first_id,
            "n_ids": size,
            "base": base,
            "width": width,
            "rules": rules.astype("<u4").tobytes(),
            "lengths": lengths.astype("<u4").tobytes(),
            "symbols": symbols.astype(f"<u{width}").tobytes(),
            "doc_ids": docs,
            "doc_ends": np.array(ends, "<i8").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema)

    for batch in batches:
        for piece in X.slices(batch, "text"):
            ids, bounds = table.run(piece.column("text"))
            for doc, a, b in zip(piece.column("id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                if size and size + b - a + 1 > BLOCK_IDS:
                    yield flush()
                    block, first_id = block + 1, first_id + size
                    held, docs, ends, size = [], [], [], 0
                held += [ids[a:b], np.array([end_id], np.uint32)]
                docs.append(doc)
                size += int(b - a) + 1
                ends.append(size)
    if docs:
        yield flush()


def write_ids(
    docs: DataFrame,
    out: str,
    path: str,
    id_col: str = "doc_id",
    text: str = "text",
    order: Sequence[Column] | None = None,
    end_id: int = END_ID,
) -> None:
    """Writes the documents' ids to the folder ``out`` in ascending id order, or in ``order``."""
    keys = [f"o{k}" for k in range(len(order or [0]))]
    rows = docs.select(
        *[c.alias(k) for c, k in zip(order or [F.col(id_col)], keys, strict=True)],
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("tie", F.xxhash64("text"))
    kind = dict(rows.dtypes)["id"]
    shards = rows.repartitionByRange(*keys, "tie", "row").sortWithinPartitions(*keys, "tie", "row")
    schema = BLOCK_SCHEMA.format(kind=kind)
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)
    blocks = shards.select("id", "text").mapInArrow(
        lambda batches: block_rows(batches, path, arrow, end_id), schema
    )
    blocks.write.mode("overwrite").parquet(out)


def decoded(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            ends = np.frombuffer(row["doc_ends"], "<i8")
            starts = np.append(0, ends[:-1])
            ids = block.ids(0, row["n_ids"])
            parts = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            columns = {
                "shard": pa.array([row["shard"]] * len(ends), pa.int32()),
                "id": pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                "at": pa.array(starts + row["first_id"], pa.int64()),
                "n_tokens": pa.array(ends - starts, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))
            else:
                columns["ids_crc32"] = pa.array([zlib.crc32(p.astype("<u4", copy=False)) for p in parts], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def read_ids(spark: SparkSession, out: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Documents back from the files: id, ``start`` (ids of all documents before), ``n_tokens``, and
    the ``ids`` themselves or their ``ids_crc32``."""
    blocks = spark.read.parquet(out)
    kind = dict(blocks.dtypes)["doc_ids"][len("array<") : -1]
    last = "ids array<int>" if with_ids else "ids_crc32 long"
    docs = blocks.mapInArrow(
        lambda batches: decoded(batches, with_ids), f"shard int, id {kind}, at long, n_tokens long, {last}"
    )
    # One row per shard meets in one task: their number is that of the writing tasks.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard")) - F.col("n")
    sizes = sizes.select("shard", before.alias("before"))
    return docs.join(sizes, "shard").select(
        F.col("id").alias(id_col), (F.col("before") + F.col("at")).alias("start"), "n_tokens", last.split()[0]
    )
