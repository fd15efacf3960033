"""Ranked lexical search: the best documents for each query by a sum of term weights.

The documents are cut once into postings of the queries' terms, which are written to the shared
folder. Their counts give the weights. Each task then lays out the postings of a run of
documents as one list per term, with a sparse table that tells the position of the largest
impact in any range of a list. For one query, an interval of documents can score at most the sum
of its lists' range maxima. Intervals are taken best first, many at a time: each is split at its
document of largest single impact, which is scored in full, and both rest intervals are kept
only while their bound reaches the floor, the score of the last of the k best so far. The
best of all runs are ranked together.

A first pass over a sixteenth of the documents (by a hash of the row) finds k scores for each
query that exist; the last of them is a floor that no result can fall below, so the full pass
over all documents starts with it. The floor changes the work, not the result.

Queries come in blocks of bounded size, each searched in all documents.

Defined cases: a null text has no terms, and such a document or query has no place in any
result; null ids stand before all others among equal scores; rows equal in id and text are
documents, or queries, of their own; an empty table gives an empty result, and so does a table
without any term; other columns are ignored, whatever their names. A text is held whole by its task; a
posting is 20 bytes. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgemart.llm import text as X
from lodgemart.llm.components import written

TOP = 50
#: Pairs of a query and one of its terms that are searched at a time.
BLOCK_PAIRS = 200_000
#: Postings of a run of documents; a single longer document is a run of its own.
RUN_POSTINGS = 750_000
#: Intervals split at a time.
WIDTH = 192
#: One of so many documents sets the floor.
FLOOR_PART = 16
#: Documents that a task of that pass searches, about.
FLOOR_DOCS = 8_192

# Bytes of a term: ASCII digits and letters, and all bytes of other characters.
_TERM = np.zeros(256, dtype=bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of all texts in a row, and the bounds of each text in them."""
    buf, offsets = X.flat(column)
    inside = np.zeros(len(buf) + 2, dtype=bool)
    inside[1:-1] = _TERM[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    hashes = X.stretch_hashes(X.LOWER[buf[inside[1:-1]]], bounds)
    return hashes, np.searchsorted(starts, offsets)


@dataclass(frozen=True)
class Queries:
    """A block of queries: sorted hashes of their terms, and each query's terms by number."""

    terms: np.ndarray
    numbers: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None]) -> Queries:
        hashes, bounds = term_hashes(pa.array(texts, pa.string()))
        terms, number = np.unique(hashes, return_inverse=True)
        return cls(terms, [np.unique(number[a:b]) for a, b in zip(bounds[:-1], bounds[1:])])


def _blocks(items: DataFrame, id_col: str, text: str) -> Iterator[list]:
    """The queries as lists of (id, text, copies), bounded by their characters as a bound of their terms."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).where("text is not null")
    rows = rows.groupBy("id", "text").agg(F.count(F.lit(1)).alias("copies"))
    size = rows.agg(F.sum(F.length("text") + 1)).first()[0]
    n = 1 + (size or 0) // (4 * BLOCK_PAIRS)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    for k in range(n):
        yield rows.where(block == k).collect()


def postings(docs: DataFrame, terms: np.ndarray, id_col: str, text: str) -> DataFrame:
    """Each row's ``doc``, ``n`` terms, numbers of the ``terms`` it holds, how often, and a ``part`` by hash."""

    def run(batches):
        for batch in batches:
            for piece in X.slices(batch, "text"):
                hashes, bounds = term_hashes(piece.column("text"))
                place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                known = terms[place] == hashes
                row = np.repeat(np.arange(piece.num_rows), np.diff(bounds))
                keys, times = np.unique(row[known] * len(terms) + place[known], return_counts=True)
                edges = pa.array(np.searchsorted(keys, np.arange(piece.num_rows + 1) * len(terms)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc"),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.ListArray.from_arrays(edges, pa.array((keys % len(terms)).astype(np.int32))),
                        pa.ListArray.from_arrays(edges, pa.array(times.astype(np.int32))),
                        piece.column("part"),
                    ],
                    ["doc", "n", "term", "tf", "part"],
                )

    part = F.pmod(F.xxhash64(F.lit(13), F.col(id_col), F.col(text)), F.lit(FLOOR_PART)).cast("int")
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text).cast("string").alias("text"), part.alias("part"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, n long, term array<int>, tf array<int>, part int").where("n > 0")


@dataclass(frozen=True)
class Weights:
    """What a score needs of the whole table."""

    n_docs: int
    n_terms: int
    weight: np.ndarray

    @classmethod
    def of(cls, index: DataFrame, n_queried: int) -> Weights:
        n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(n_queried, np.int64)
        # One row for each term of the block of queries, which is bounded.
        for term, count in index.select(F.explode("term").alias("term")).groupBy("term").count().collect():
            df[term] = count
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
        return cls(n_docs, n_terms or 0, np.array(weight, np.int64))

    def impact(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 50 + (50 * n * self.n_docs) // max(self.n_terms, 1)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Run:
    """Posting lists of some documents, one after another, with a sparse table of range maxima."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int) -> None:
        order = np.lexsort((doc, term))
        self.n_docs = n_docs
        self.doc, self.impact = doc[order].astype(np.int64), impact[order]
        self.key = term[order].astype(np.int64) * n_docs + self.doc
        self.edge = np.searchsorted(self.key, np.arange(n_terms + 1) * n_docs)
        longest = int(np.diff(self.edge).max(initial=1))
        # table[j][i]: place of the largest impact, the first of equal ones, in i .. i + 2**j - 1.
        self.table = [np.arange(len(order), dtype=np.int32)]
        for j in range(longest.bit_length() - 1):
            left = self.table[-1][: len(self.table[-1]) - (1 << j)]
            right = self.table[-1][1 << j :]
            self.table.append(np.where(self.impact[right] > self.impact[left], right, left))

    def best(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the largest impact in each range a .. b - 1, none of them empty."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int32)
        for j in np.unique(level):
            at = np.flatnonzero(level == j)
            left, right = self.table[j][a[at]], self.table[j][b[at] - (1 << int(j))]
            out[at] = np.where(self.impact[right] > self.impact[left], right, left)
        return out


class Search:
    """Best-first search of one run for one query.

    Each open interval has the pieces ``a .. b - 1`` of posting lists that hold a document of it,
    and for each piece the place of its largest impact; pieces are sorted by interval.
    """

    def __init__(self, run: Run, terms: np.ndarray, k: int, floor: int) -> None:
        self.run, self.k, self.floor = run, k, max(floor, 1)
        self.docs, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.scored = 0
        a, b = run.edge[terms], run.edge[terms + 1]
        some = b > a
        a, b = a[some], b[some]
        self._open(np.zeros(len(a), np.int64), (terms[some], a, b, run.best(a, b)), 1)

    def _open(self, owner: np.ndarray, pieces: tuple, n: int) -> None:
        """Intervals 0 .. n - 1 with their pieces: those that can still hold a result stay open."""
        edge = np.searchsorted(owner, np.arange(n + 1))
        bound = X.sums_by_text(self.run.impact[pieces[3]], edge)
        self.pieces, self.edge = pieces, edge
        self.left = np.flatnonzero(bound >= self.floor)
        self.bound = bound[self.left]

    def _of(self, chosen: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The pieces of the chosen intervals and which of the chosen each belongs to."""
        sizes = self.edge[chosen + 1] - self.edge[chosen]
        owner = np.repeat(np.arange(len(chosen)), sizes)
        at = np.arange(len(owner)) + (self.edge[chosen] - np.cumsum(sizes) + sizes)[owner]
        return owner, tuple(x[at] for x in self.pieces)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best, scores at least the floor."""
        while len(self.left):
            if len(self.left) > WIDTH:
                order = np.argpartition(-self.bound, WIDTH)
                self._split(self.left[order[:WIDTH]], self.left[order[WIDTH:]])
            else:
                self._split(self.left, self.left[:0])
        return self.docs, self.scores

    def _split(self, now: np.ndarray, later: np.ndarray) -> None:
        """Scores a document of each of these intervals and keeps what is left of them, and the others."""
        run, n = self.run, len(now)
        owner, (term, a, b, place) = self._of(now)
        largest, first = run.impact[place], np.searchsorted(owner, np.arange(n))
        # The piece with the largest impact of each interval, the first of equal ones.
        head = np.flatnonzero(largest == np.maximum.reduceat(largest, first)[owner])
        head = head[np.unique(owner[head], return_index=True)[1]]
        split = run.doc[place[head]]
        # Where that document stands in each list, or would.
        at = np.clip(np.searchsorted(run.key, term * run.n_docs + split[owner]), a, b)
        held = at < b
        held[held] = run.doc[at[held]] == split[owner[held]]
        gain = np.zeros(len(owner), np.int64)
        gain[held] = run.impact[at[held]]
        self._score(split, np.add.reduceat(gain, first))

        others, rest = self._of(later)
        after = at + held
        left, right = np.flatnonzero(at > a), np.flatnonzero(after < b)
        lows, highs = np.append(a[left], after[right]), np.append(at[left], b[right])
        fresh = np.append(term[left], term[right]), lows, highs, run.best(lows, highs)
        owners = np.concatenate((owner[left], owner[right] + n, others + 2 * n))
        self._open(owners, tuple(np.append(x, y) for x, y in zip(fresh, rest)), 2 * n + len(later))

    def _score(self, docs: np.ndarray, scores: np.ndarray) -> None:
        self.scored += len(docs)
        some = scores >= self.floor
        docs, scores = np.append(self.docs, docs[some]), np.append(self.scores, scores[some])
        order = np.lexsort((docs, -scores))[: self.k]
        self.docs, self.scores = docs[order], scores[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of documents in the order of their ids: ids, terms of each, postings."""
    held, size = [], 0
    for batch in batches:
        at, edges = 0, np.cumsum(np.append(0, np.diff(np.asarray(batch.column("term").offsets))))
        while at < batch.num_rows:
            to = int(np.searchsorted(edges, edges[at] + max(RUN_POSTINGS - size, 0), "right")) - 1
            if to <= at:
                if held:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                    continue
                to = at + 1
            held.append(batch.slice(at, to - at))
            size += int(edges[to] - edges[at])
            at = to
    if held:
        yield pa.Table.from_batches(held)


def search(index: DataFrame, queries: Queries, weights: Weights, floors: np.ndarray, top: int) -> DataFrame:
    """(query, doc, score): the best documents of each run of documents that reach the query's floor."""

    def run(batches):
        for table in _runs(batches):
            # Ties go to smaller ids, so documents are numbered in their order, null first.
            ids = table.column("doc").combine_chunks()
            order = pc.sort_indices(pa.table({"d": ids}), [("d", "ascending")], null_placement="at_start")
            ids, table = ids.take(order), table.take(order)
            term = table.column("term").combine_chunks()
            tf = table.column("tf").combine_chunks()
            sizes = np.diff(np.asarray(term.offsets))
            doc = np.repeat(np.arange(len(ids)), sizes)
            n = np.asarray(table.column("n").combine_chunks())[doc]
            term, tf = np.asarray(term.flatten()), np.asarray(tf.flatten()).astype(np.int64)
            lists = Run(doc, term, weights.impact(term, tf, n), len(ids), len(queries.terms))
            for q, numbers in enumerate(queries.numbers):
                docs, scores = Search(lists, numbers, top, int(floors[q])).result()
                if len(docs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(docs), q, np.int32)), ids.take(pa.array(docs)), pa.array(scores)],
                        ["query", "doc", "score"],
                    )

    kind = index.schema["doc"].dataType.simpleString()
    return index.select("doc", "n", "term", "tf").mapInArrow(run, f"query int, doc {kind}, score long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of all runs with their ``rank``."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _floors(index: DataFrame, queries: Queries, weights: Weights, top: int) -> np.ndarray:
    """For each query a score that at least ``top`` documents reach, 0 where too few are known."""
    none = np.zeros(len(queries.numbers), np.int64)
    parts = 1 + weights.n_docs // (FLOOR_PART * FLOOR_DOCS)
    some = index.where("part = 0").repartition(parts, F.xxhash64("doc", "n"))
    # One row for each query of the block.
    for q, score in ranked(search(some, queries, weights, none, top), top).where(F.col("rank") == top).select(
        "query", "score"
    ).collect():
        none[q] = score
    return none


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """(item, rank, document, score) of the ``top`` best documents with a score above 0 of each item."""
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item {kinds[1]}, rank int, doc {kinds[0]}, score long")
    for block in _blocks(items, item_id, item_text):
        queries = Queries.of([r["text"] for r in block])
        if not len(queries.terms):
            continue
        index = written(postings(docs, queries.terms, id_col, text), "postings")
        weights = Weights.of(index, len(queries.terms))
        floors = _floors(index, queries, weights, top)
        found = ranked(search(index, queries, weights, floors, top), top)
        names = [(k, r["id"], r["copies"]) for k, r in enumerate(block)]
        names = spark.createDataFrame(names, f"query int, item {kinds[1]}, copies long")
        # One row for each query of the block, which is bounded.
        named = found.join(F.broadcast(names), "query")
        copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
        out = out.unionByName(named.withColumn("copy", copies).select("item", "rank", "doc", "score"))
    return out.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(id_col), "score")


# The same rows in DuckDB SQL, from every pair of an item's term and a document that holds it.
SEARCH_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
lens AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
tot AS (SELECT count(*) AS N, sum(n)::BIGINT AS L FROM lens),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
q AS (
  SELECT k, item_id, unnest(list_distinct(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS t
  FROM (SELECT row_number() OVER () AS k, item_id, text FROM benchmark)),
w AS (
  SELECT t, floor(1000 * ln((2 * tot.N + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM p GROUP BY t), tot),
s AS (
  SELECT q.k, q.item_id, p.r,
         sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * lens.n * tot.N) // tot.L))))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t) JOIN lens ON lens.r = p.r, tot
  GROUP BY q.k, q.item_id, p.r),
o AS (
  SELECT s.k, s.item_id, lens.doc_id, s.score,
         row_number() OVER (PARTITION BY s.k ORDER BY s.score DESC, lens.doc_id NULLS FIRST) AS rank
  FROM s JOIN lens ON lens.r = s.r WHERE s.score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 50
"""
