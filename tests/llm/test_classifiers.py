import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import empty, odd, odd_rows, sf, texts, words  # noqa: F401
from pyspark.sql import functions as F

from lodgemart.llm import passage_attention, quality_rules
from lodgemart.llm.queries import llm_queries

LABELS = "doc_id long, quality int, toxic int"


def base_of(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


@pytest.fixture(scope="module")
def judged(spark, sf):
    return {r["doc_id"]: r for r in llm_queries()["op3_quality_rules"](spark, sf).collect()}


def test_rules_equal_brute_force(judged, texts):
    assert len(judged) == len(texts)
    for doc, text in texts:
        r = judged[doc]
        found = tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert found == base_of(text)
        assert not (r["base_failed"] and r["kept"])


def test_labels_outside_the_sample_are_met(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_rules.train(docs, labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1").join(quality_rules.apply_rules(docs, model), "doc_id")
    held = held.where("not base_failed").select("quality", "kept").collect()
    assert np.mean([(r[0] == 1) == r[1] for r in held]) > 0.97


def test_features_match_between_training_and_scoring():
    column = pa.array(["a b c a b c", None, "", "été naïve"])
    rng = np.random.default_rng(0)
    model = quality_rules.Model(rng.normal(size=quality_rules.BUCKETS), 0.5, 1.0, 0.0)
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array([0] * 4), column], ["id", "label", "text"])
    (out,) = quality_rules.features(iter([batch]))
    for k, row in enumerate(out.to_pylist()):
        keys = np.frombuffer(row["keys"], np.uint16)
        raw = model.bias + (model.weights[keys] * np.frombuffer(row["values"], np.float32)).sum()
        assert raw == pytest.approx(quality_rules.raw_scores(model, quality_rules.parsed(column))[k], abs=1e-5)


def test_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, 1, 0), (5, None, 0), (1, 1, 1)], LABELS)
    model = quality_rules.train(odd, labels)
    found = quality_rules.apply_rules(odd, model).collect()
    assert len(found) == len(odd_rows)
    assert Counter(tuple(r)[1:7] for r in found) == Counter(base_of(r[1]) for r in odd_rows)
    kept = quality_rules.keep_rows(odd, model)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in found if r["kept"])
    alone = quality_rules.train(odd, labels.where("quality = 1"))
    assert all(r["kept"] != r["base_failed"] for r in quality_rules.apply_rules(odd, alone).collect())
    none = quality_rules.train(empty, labels)
    assert quality_rules.apply_rules(empty, none).count() == 0
    scored = passage_attention.score_documents(odd, passage_attention.train(odd, labels)).collect()
    assert len(scored) == len(odd_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored)
    assert passage_attention.score_documents(empty, passage_attention.train(empty, labels)).count() == 0


def test_attention_learns_and_holds_out(spark):
    sf = "/root/testdata/sf0.01"
    found = llm_queries()["op9_quality_classifier"](spark, sf)
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.97


def test_held_out_labels_do_not_count(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(passage_attention.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = (passage_attention.train(docs, x, train_rows=50) for x in (labels, turned))
    assert all((x == y).all() for x, y in zip(a.parts(), b.parts(), strict=True))


def test_attention_gradient():
    """A step along the gradient lowers the loss on two bags of passages."""
    rng = np.random.default_rng(1)
    width = len(passage_attention.GRAMS) * passage_attention.BUCKETS
    bags = [rng.random((n, width)).astype(np.float16) for n in (3, 1, 4, 2)]
    rows = [{"id": k, "label": k % 2, "rows": x.tobytes()} for k, x in enumerate(bags)]
    m = passage_attention.fit(rows, rounds=200)
    for k, x in enumerate(bags):
        h, _, _, logits = m.encode(x.astype(np.float32))
        z = (passage_attention.attend(logits, np.array([0]))[:, None] * h).sum(0)
        assert ((z @ m.c + m.d) > 0) == bool(k % 2)
