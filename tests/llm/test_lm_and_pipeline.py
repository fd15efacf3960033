import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_cases import SCHEMA, empty, low, odd, odd_rows, sf, texts, words  # noqa: F401

from lodgemart.llm import attention_lm as L
from lodgemart.llm import components, decontaminate, jaccard_join, pfair_mix, quality_rules
from lodgemart.llm.queries import TOKENIZER, llm_queries


def brute_base(data):
    """(id, held out, tokens, known tokens, N, base score) of each (id, text)."""
    tokens = [(doc, [*words(low(text)), None]) for doc, text in data]
    held = [doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1 for doc, _ in tokens]
    counts = Counter(t for (_, ts), h in zip(tokens, held, strict=True) if not h for t in ts)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (doc, ts), h in zip(tokens, held, strict=True):
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        out.append((doc, h, len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 6)))
    return Counter(out)


def base_of(found):
    keys = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return Counter((*(r[k] for k in keys), round(r["base_score"], 6)) for r in found)


def test_lm_query_has_exact_base(spark, sf, texts):
    found = llm_queries()["op2_lm_scoring"](spark, sf).collect()
    assert base_of(found) == brute_base(texts)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_lm_of_odd_rows(spark, odd, odd_rows, empty):
    found = L.score_texts(odd, TOKENIZER, rounds=1).collect()
    assert base_of(found) == brute_base([r[:2] for r in odd_rows])
    assert all(math.isfinite(r["score"]) for r in found)
    assert L.score_texts(empty, TOKENIZER).count() == 0
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1]
    alone = spark.createDataFrame([(i, "only held out") for i in held], "doc_id long, text string")
    found = L.score_texts(alone, TOKENIZER).collect()
    assert base_of(found) == brute_base([(i, "only held out") for i in held])
    assert all(math.isfinite(r["score"]) for r in found)


def a_model(seed=0):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 1_000, 300).astype(float)
    class_of, share = L.classes_of(counts, np.arange(300) % 3 == 0)
    start = L.Weights.start(rng.normal(size=L.CLASSES), seed)
    return L.Model(1, 1, 1, 299, class_of, share, L.Weights(*[3 * x for x in start.parts()]))


def naive_scores(model, ids):
    """Token by token: the window a token is scored in, its softmax over classes, its share."""
    w, total = model.weights, 0.0
    given = [model.class_of[model.end_id], *(model.class_of[i] for i in ids[:-1])]
    for t, i in enumerate(ids):
        start = 0 if t < L.STRIDE else (t // L.STRIDE - 1) * L.STRIDE
        x = np.array([w.e[c] + w.p[k] for k, c in enumerate(given[start : t + 1])], float)
        s = (x[-1] @ w.q) @ (x @ w.k).T * L.WIDTH**-0.5
        a = np.exp(s - s.max())
        z = (x[-1] + a / a.sum() @ (x @ w.v)) @ w.o + w.b
        total += z[model.class_of[i]] - z.max() - np.log(np.exp(z - z.max()).sum()) + model.share[i]
    return total / np.log(10)


def test_windows_score_each_token_once():
    model, rng = a_model(), np.random.default_rng(3)
    parts = [rng.integers(0, 300, n) for n in (1, 15, 16, 17, 31, 32, 33, 48, 49, 200)]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    found = L.Scorer(model).scores(np.concatenate(parts), bounds)
    assert found == pytest.approx([naive_scores(model, p) for p in parts], rel=1e-4)


def test_gradients_are_those_of_the_loss():
    w = L.Weights(*[x.astype(float) for x in L.Weights.start(np.zeros(L.CLASSES)).parts()])
    rows = np.random.default_rng(0).integers(0, L.CLASSES, (3, L.WINDOW + 1))
    _, grads = L.gradients(w, rows)
    for x, g in zip(w.parts(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        x[at] += 1e-5
        up = L.gradients(w, rows)[0]
        x[at] -= 2e-5
        down = L.gradients(w, rows)[0]
        x[at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(g[at], rel=1e-4)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(0)
    data = (np.arange(L.WINDOW + 1) + rng.integers(0, 64, (3_000, 1))) % L.CLASSES
    start = L.Weights.start(np.zeros(L.CLASSES))
    after = L.trained(start, data[:-500], 0.02)
    assert L.gradients(after, data[-500:])[0] < 0.8 * L.gradients(start, data[-500:])[0]


def test_shares_and_classes_are_distributions():
    model = a_model()
    sums = np.bincount(model.class_of, np.exp(model.share), L.CLASSES)
    assert sums[np.unique(model.class_of)] == pytest.approx(1)


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "source_mixing", "token_ids"]
    labels, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    for name, stage in C.STAGES:
        out = C.written(stage(spark, docs, sf), "stage-test")
        before, after = rows(docs), rows(out)
        if name != "token_ids":
            assert out.columns == docs.columns
            assert set(after) <= set(before)
        if name == "quality_rules":
            judged = quality_rules.apply_rules(docs, quality_rules.train(docs, labels)).where("kept")
            assert rows(out, "doc_id") == rows(judged, "doc_id")
        if name == "jaccard_join":
            found = jaccard_join.jaccard_components(docs).where("doc_id = component_id")
            assert rows(out, "doc_id") == rows(found, "doc_id")
            assert len(after) < len(before)
        if name == "decontamination":
            leaked = {r["doc_id"] for r in decontaminate.leaked_items(docs, items).collect()}
            assert leaked and {r[0] for r in after} == {r[0] for r in before} - leaked
        if name == "source_mixing":
            assert after == before
            order = out.orderBy("_metadata.file_name", "_metadata.row_index").select("doc_id").collect()
            mixed = pfair_mix.mix_ids(docs).orderBy("position").select("doc_id").collect()
            assert order == mixed
        if name == "token_ids":
            assert [r["doc_id"] for r in out.orderBy("start").collect()] == [r["doc_id"] for r in order]
        docs = out
    assert rows(C.run(spark, sf)) == rows(docs)


def test_pipeline_of_odd_tables(spark, tmp_path, odd_rows):
    import corpus_pipeline as C

    sf_dir = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"{sf_dir}/labels.parquet"
    )
    spark.createDataFrame([(1, None), (2, "one two")], "item_id long, text string").write.parquet(
        f"{sf_dir}/benchmark.parquet"
    )
    for k, data in enumerate((odd_rows, [])):
        spark.createDataFrame(data, SCHEMA).write.mode("overwrite").parquet(f"{sf_dir}/documents.parquet")
        found = C.run(spark, sf_dir)
        assert (found.count() > 0) == (k == 0)


def test_training_windows_cover_every_token():
    rng, end = np.random.default_rng(1), 7
    lines = [rng.integers(0, L.CLASSES, n).astype(np.uint8) for n in (0, 1, 31, 32, 33, 400, 0, 5_000, 64)]
    batch = L.pa.RecordBatch.from_arrays([L.pa.array([x.tobytes() for x in lines], L.pa.binary())], ["classes"])
    found = []
    for part in (batch, batch.slice(3, 4), batch.slice(0, 0)):
        for rows, classes, bounds in L.sequences(part):
            assert rows.num_rows == len(bounds) - 1
            found += [pack for pack in L.laid(classes, bounds, end)]
    expected = []
    for line in [*lines, *lines[3:7]]:
        line = [end, *line, end]
        for k in range(0, len(line) - 1, L.WINDOW):
            row = line[k : k + L.WINDOW + 1]
            expected.append([*row, *[L.PAD] * (L.WINDOW + 1 - len(row))])
    assert sorted(np.concatenate(found).tolist()) == sorted(np.array(expected, np.uint8).tolist())


def test_slices_of_lines(monkeypatch):
    monkeypatch.setattr(L, "SLICE_TOKENS", 10)
    lines = [b"x" * n for n in (4, 4, 4, 30, 0, 0, 9)]
    batch = L.pa.RecordBatch.from_arrays([L.pa.array(lines, L.pa.binary())], ["classes"])
    found = list(L.sequences(batch))
    assert [r.num_rows for r, _, _ in found] == [2, 1, 1, 3]
    assert sum(len(c) for _, c, _ in found) == 51


def test_gradients_in_used_arrays():
    m, rng, room = L.Weights.start(np.zeros(L.CLASSES)), np.random.default_rng(0), L.Room()
    for n in (8, 8, 3, 8):
        rows = rng.integers(0, L.CLASSES, (n, L.WINDOW + 1))
        for one, other in zip(L.gradients(m, rows, room)[1], L.gradients(m, rows)[1], strict=True):
            assert np.array_equal(one, other)


def test_short_texts_teach(spark):
    rows = np.full((1, L.WINDOW + 1), L.PAD, int)
    rows[0, :4] = 9, 1, 2, 9
    texts = spark.createDataFrame([(bytearray([1, 2]),)] * 3, "classes binary")
    start = L.Weights.start(np.zeros(L.CLASSES))
    after = L.fit(texts, start, 9)
    assert L.gradients(after, rows)[0] < L.gradients(start, rows)[0]
    assert L.gradients(start, rows)[0] == pytest.approx(L.gradients(start, rows[:, :4])[0], rel=1e-5)


def test_stages_between_are_written_small(spark, texts, monkeypatch):
    """The words, their ids and the lines of classes are most of what the operator keeps on disk."""
    own, found = components.written, {}

    def kept(df, purpose, *codec):
        out = own(df, purpose, *codec)
        found[purpose] = out.inputFiles()
        return out

    monkeypatch.setattr(L, "written", kept)
    L.score_texts(spark.createDataFrame([(i, t) for i, t in texts[:50]], "doc_id long, text string"), TOKENIZER).count()
    assert {"lm-sent", "lm-words", "lm-lines"} <= found.keys()
    files = [f for purpose in ("lm-sent", "lm-words", "lm-lines") for f in found[purpose]]
    assert files and all(".zstd." in f for f in files)
