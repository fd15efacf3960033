"""Quality rules: repetition and length rules, then a calibrated n-gram classifier.

The rules are counts over whole texts. The classifier is a logistic regression on hashed
word and character n-grams, trained in numpy on a bounded sample of labelled documents
(``train_rows`` of each label at most, those with the smallest id hash), its output put
through Platt scaling on a part of the sample it was not trained on. Texts are scored in
Arrow batches, all rows of a batch at once; a document is kept if it fails no rule and its
calibrated probability is at least ``keep_at``.

Defined cases: a null text has no words and fails; a null id is carried through; rows are
judged one by one, so repeated rows get equal verdicts; label rows without id or label are
ignored, an id labelled twice takes the mean; with only one label known, the rules alone
decide; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgemart.llm import text as X

BUCKETS = 1 << 16
CHAR_SIZES = (1, 3)
TRAIN_ROWS = 1_500
KEEP_AT = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, quality_p double"
)


@dataclass(frozen=True)
class Model:
    """Weights by bucket, bias, and the two numbers of the calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))


def feature_keys(buf, offsets, starts, ends, first, hashes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: buckets in text order, and the bounds of each text in them."""
    top = np.uint64(64 - BUCKETS.bit_length() + 1)
    wide = buf.astype(np.uint64)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for size in CHAR_SIZES:
        n = max(len(buf) - size + 1, 0)
        keys = np.full(n, size, np.uint64)
        for k in range(size):
            keys = keys * np.uint64(0x100000001B3) + wide[k : k + n]
        inside = np.flatnonzero(text[:n] == text[size - 1 :]) if size > 1 else np.arange(n)
        keys = (X.mix(keys[inside]) >> top).astype(np.int32)
        yield keys, np.searchsorted(inside, offsets)
    for size in (1, 2):
        keys, at = X.windows(hashes, first, size)
        yield ((keys + np.uint64(size)) >> top).astype(np.int32), np.searchsorted(at, first)


def parsed(column: pa.Array):
    buf, offsets = X.flat(column)
    starts, ends, first = X.word_spans(buf, offsets)
    return buf, offsets, starts, ends, first, X.word_hashes(buf, starts, ends)


def raw_scores(model: Model, parts) -> np.ndarray:
    """Weights of each text's n-grams, averaged within each kind of n-gram."""
    total = np.full(len(parts[1]) - 1, model.bias)
    for keys, bounds in feature_keys(*parts):
        total += X.sums_by_text(model.weights[keys], bounds) / np.maximum(np.diff(bounds), 1)
    return total


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse rows of the training texts."""
    for batch in batches:
        for piece in X.slices(batch, "text"):
            parts = parsed(piece.column("text"))
            all_keys: list[list] = [[] for _ in range(piece.num_rows)]
            all_values: list[list] = [[] for _ in range(piece.num_rows)]
            for keys, bounds in feature_keys(*parts):
                for row in range(piece.num_rows):
                    own = keys[bounds[row] : bounds[row + 1]]
                    found, n = np.unique(own, return_counts=True)
                    all_keys[row].append(found.astype(np.uint16))
                    all_values[row].append((n / max(len(own), 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    piece.column("label"),
                    pa.array([np.concatenate(k).tobytes() for k in all_keys], pa.binary()),
                    pa.array([np.concatenate(v).tobytes() for v in all_values], pa.binary()),
                ],
                ["id", "label", "keys", "values"],
            )


def fit(rows: list, rounds: int = 300) -> Model:
    """Logistic regression by Adam on four fifths of the rows, Platt scaling on the rest."""
    rows = sorted(rows, key=lambda r: str(r["id"]))
    y = np.array([r["label"] for r in rows], float)
    if len(set(y)) < 2:
        return Model(np.zeros(BUCKETS), 0.0, 1.0, 30.0)
    held = np.arange(len(rows)) % 5 == 4
    if len(set(y[held])) < 2:
        held = np.ones(len(rows), bool)
    sizes = np.array([len(r["keys"]) // 2 for r in rows])
    keys = np.frombuffer(b"".join(r["keys"] for r in rows), np.uint16)
    values = np.frombuffer(b"".join(r["values"] for r in rows), np.float32)
    used, local = np.unique(keys, return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    learn = ~held if not held.all() else held
    balance = np.where(y > 0, 1 / max(1, (y[learn] > 0).sum()), 1 / max(1, (y[learn] == 0).sum())) / 2 * learn
    w, b = np.zeros(len(used)), 0.0
    m1, m2 = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(owner, values * w[local], len(rows)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * balance
        grad = np.append(np.bincount(local, values * err[owner], len(used)) + 1e-6 * w, err.sum())
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        move = 0.2 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-7)
        w, b = w - move[:-1], b - move[-1]
    z = np.bincount(owner, values * w[local], len(rows)) + b
    slope, shift = platt(z[held], y[held])
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Model(weights, float(b), slope, shift)


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (z, y), targets smoothed, by Newton steps."""
    up, down = (y > 0).sum(), (y == 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    spread = z.std() or 1.0
    x = np.stack([z / spread, np.ones_like(z)], 1)
    a = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        hess = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        a = a + np.clip(np.linalg.solve(hess, x.T @ (target - p)), -2, 2)
    return float(a[0] / spread), float(a[1])


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, limit: int) -> DataFrame:
    """(id, label, text) of at most ``limit`` documents of each label, smallest id hashes first."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("label"))
    )
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(limit)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return (
        texts.join(F.broadcast(chosen), "id")  # 2 * limit rows at most
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """The classifier, from sparse features of a bounded sample."""
    sample = labelled(docs, labels, id_col, text, label, train_rows)
    kind = dict(sample.dtypes)["id"]
    rows = sample.mapInArrow(features, f"id {kind}, label int, keys binary, values binary")
    return fit(rows.collect())


def repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a 3-word window found at least twice in it."""
    keys, at = X.windows(hashes, first, 3)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(keys):
        keys = X.mix(keys + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(hashes), bool)
    for k in range(3):
        hit[at[twice] + k] = True
    return X.sums_by_text(hit, first)


def duplicate_lines(buf: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Lines with a word that equal an earlier line of their text."""
    data, out = buf.tobytes(), []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        lines = [x for x in data[a:b].split(b"\n") if x.strip()]
        out.append(len(lines) - len(set(lines)))
    return out


def judge(model: Model, keep_at: float, column: pa.Array) -> list[pa.Array]:
    """The result columns for one column of texts."""
    parts = parsed(column)
    buf, offsets, starts, ends, first, hashes = parts
    n_words = np.diff(first)
    inside = X.IS_WORD[buf] & ((buf & 0xC0) != 0x80)
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    repeats = repeated_words(hashes, first)
    failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    p = model.probability(raw_scores(model, parts))
    longs = [n_words, X.sums_by_text(inside, offsets), X.sums_by_text(symbol[buf], offsets)]
    longs += [duplicate_lines(buf, offsets), repeats]
    return [
        *(pa.array(np.asarray(x, np.int64)) for x in longs),
        pa.array(failed),
        pa.array(~failed & (p >= keep_at)),
        pa.array(p),
    ]


def apply_rules(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", keep_at: float = KEEP_AT
) -> DataFrame:
    """The id and the verdict columns of every row."""

    def run(batches):
        for batch in batches:
            for piece in X.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), *judge(model, keep_at, piece.column("text"))], names
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    names = ["id", *(x.split()[0] for x in RESULT.split(", "))]
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, {RESULT}").withColumnRenamed("id", id_col)


def keep_rows(
    docs: DataFrame, model: Model, text: str = "text", keep_at: float = KEEP_AT
) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged."""

    def run(batches):
        for batch in batches:
            for piece in X.slices(batch, text):
                column = piece.column(piece.schema.get_field_index(text))
                yield piece.filter(judge(model, keep_at, column)[6])

    return docs.mapInArrow(run, docs.schema)
