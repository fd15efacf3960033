"""Quality classifier: gated attention over passages, learned from document labels.

Multiple-instance learning: a document is a bag of passages of ``PASSAGE`` bytes. Every
passage is encoded (hashed 1- and 3-byte n-grams, square roots of their shares, a trained
dense layer), a gate weighs it, and the weighted sum of the encodings is scored. Only
documents carry labels; encoder, gate and score are trained together in numpy by Adam on a
bounded sample of them (``train_rows`` of each label at most, smallest id hashes first).
Whole texts are scored, in Arrow batches, a bounded number of passages at a time.

The fold of a row is crc32(id as text) mod 3; rows of fold 1 never lend their label. Inputs
of the score are the bytes of the text alone.

Defined cases: a null text is empty, an empty text is one empty passage; a null id is in no
held-out fold; label rows without id or label are ignored, an id labelled twice takes the
mean; with only one label known every score is that label; repeated rows get equal scores;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.llm import text as X
from lodgemart.llm.quality_rules import labelled

PASSAGE = 512
BUCKETS = 512
GRAMS = (1, 3)
WIDTH, GATE = 16, 8
TRAIN_ROWS = 600
ROUNDS = 120
CHUNK = 2_048
FOLDS, HELD_OUT = 3, 1


@dataclass
class Model:
    """Encoder (w, b), gate (v, u, a), score (c, d)."""

    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.w, self.b, self.v, self.u, self.a, self.c, self.d]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Encodings of passages, both sides of the gate, and the attention logits."""
        h = np.tanh(x @ self.w + self.b)
        t, s = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        return h, t, s, (t * s) @ self.a


def attend(logits: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Softmax of the logits within each bag; ``first`` holds the bags' first passages."""
    sizes = np.diff(np.append(first, len(logits)))
    e = np.exp(logits - np.repeat(np.maximum.reduceat(logits, first), sizes))
    return e / np.repeat(np.add.reduceat(e, first), sizes)


def passages(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all passages, one at least for each text, and each text's first passage."""
    sizes = np.diff(offsets)
    n = np.maximum(-(-sizes // PASSAGE), 1)
    first = np.cumsum(n) - n
    inner = np.arange(n.sum()) - np.repeat(first, n)
    return np.append(np.repeat(offsets[:-1], n) + inner * PASSAGE, offsets[-1]), first


def encoded_rows(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The input row of each passage: square roots of the shares of its n-grams."""
    n = len(bounds) - 1
    out = np.zeros((n, len(GRAMS) * BUCKETS), np.float32)
    for k, size in enumerate(GRAMS):
        keys, at = X.char_grams(buf, bounds, size, BUCKETS)
        cell = np.repeat(np.arange(n) * BUCKETS, np.diff(at)) + keys
        counts = np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS)
        shares = counts / np.maximum(np.diff(at), 1)[:, None]
        out[:, k * BUCKETS : (k + 1) * BUCKETS] = np.sqrt(shares)
    return out


def chunks(buf: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    for lo in range(0, len(bounds) - 1, CHUNK):
        own = bounds[lo : lo + CHUNK + 1]
        yield encoded_rows(buf[own[0] : own[-1]], own - own[0])


def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training documents as packed input rows."""
    for batch in batches:
        for piece in X.slices(batch, "text"):
            buf, offsets = X.flat(piece.column("text"))
            bounds, first = passages(offsets)
            rows = np.concatenate([x.astype(np.float16) for x in chunks(buf, bounds)])
            parts = np.split(rows, first[1:])
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("label"), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["id", "label", "rows"],
            )


def fit(rows: list, rounds: int = ROUNDS, seed: int = 7) -> Model:
    """Adam on all sampled bags, both labels of equal weight."""
    rng = np.random.default_rng(seed)
    width = len(GRAMS) * BUCKETS
    m = Model(
        *(rng.normal(0, s, shape).astype(np.float32) for s, shape in (
            (0.1, (width, WIDTH)), (0.0, WIDTH), (0.3, (WIDTH, GATE)), (0.3, (WIDTH, GATE)),
            (0.3, GATE), (0.3, WIDTH), (0.0, 1)))
    )
    rows = sorted(rows, key=lambda r: str(r["id"]))
    y = np.array([r["label"] for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        m.c[:] = 0
        m.d[:] = 0.0 if not len(y) else (20.0 if y[0] else -20.0)
        return m
    x = np.frombuffer(b"".join(r["rows"] for r in rows), np.float16).reshape(-1, width).astype(np.float32)
    sizes = np.array([len(r["rows"]) // (2 * width) for r in rows])
    first = np.cumsum(sizes) - sizes
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum()).astype(np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in m.parts()]
    for step in range(1, rounds + 1):
        h, t, s, logits = m.encode(x)
        att = attend(logits, first)
        z = np.add.reduceat(att[:, None] * h, first)
        p = 1 / (1 + np.exp(-np.clip(z @ m.c + m.d, -30, 30)))
        err = (p - y) * weight
        dz = np.repeat(err[:, None] * m.c, sizes, 0)
        da = (dz * h).sum(1)
        dl = att * (da - np.repeat(np.add.reduceat(att * da, first), sizes))
        dg = dl[:, None] * m.a
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (att[:, None] * dz + dt @ m.v.T + ds @ m.u.T) * (1 - h * h)
        grads = [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ dl, z.T @ err, err.sum()[None]]
        for part, grad, (m1, m2) in zip(m.parts(), grads, moments, strict=True):
            m1 += 0.1 * (grad - m1)
            m2 += 0.01 * (grad * grad - m2)
            part -= 0.02 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-6)
    return m


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def held_out(id_col: Column) -> Column:
    return F.coalesce(fold(id_col) == HELD_OUT, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """The model, from the labels outside the held-out fold."""
    sample = labelled(docs, labels.where(~held_out(F.col(id_col))), id_col, text, label, train_rows)
    rows = sample.mapInArrow(bags, f"id {dict(sample.dtypes)['id']}, label int, rows binary")
    return fit(rows.collect())


def scores(model: Model, column: pa.Array) -> np.ndarray:
    """The probability of label 1 for each text."""
    buf, offsets = X.flat(column)
    bounds, first = passages(offsets)
    found = [model.encode(x) for x in chunks(buf, bounds)]
    h, logits = np.concatenate([f[0] for f in found]), np.concatenate([f[3] for f in found])
    z = np.add.reduceat(attend(logits, first)[:, None] * h, first)
    return 1 / (1 + np.exp(-np.clip(z @ model.c + model.d, -30, 30)))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, ``held_out``, ``score`` and ``predicted`` of every row."""

    def run(batches):
        for batch in batches:
            for piece in X.slices(batch, "text"):
                p = scores(model, piece.column("text")).astype(np.float64)
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(p)], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    scored = rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
