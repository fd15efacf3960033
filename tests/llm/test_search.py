import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import empty, odd, odd_rows, plain_words, sf, texts  # noqa: F401

pytest.importorskip("public_tokenizers")

from lodgemart.llm import ranked_search as R  # noqa: E402
from lodgemart.llm.queries import llm_queries  # noqa: E402

ITEMS = "item_id long, text string, score string, rank string"


def brute(docs, items, top=50):
    """(item, rank, doc, score) of the best documents, from all pairs."""
    held = [(doc, Counter(plain_words(text))) for doc, text in docs]
    held = [(doc, c) for doc, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 50 + 50 * sum(c.values()) * n // total
            s = 0
            for t in set(plain_words(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                s += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if s > 0:
                scores.append((-s, doc is not None, doc))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def test_query_equals_brute_force(spark, sf, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    found = llm_queries()["op13_ranked_search"](spark, sf)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == brute(texts, items)


def random_run(rng, n_docs, n_terms, values):
    places = [(d, t) for d in range(n_docs) for t in range(n_terms) if rng.random() < 1.5 / (1 + t % 9)]
    doc, term = np.array(places, np.int64).reshape(-1, 2).T
    impact = np.array([rng.choice(values) for _ in places], np.int64)
    return doc, term, impact


@pytest.mark.parametrize("width", [1, 3, 192])
def test_search_of_a_run_is_exact_and_leaves_documents_out(monkeypatch, width):
    monkeypatch.setattr(R, "WIDTH", width)
    rng, scored, all_pairs = random.Random(width), 0, 0
    for trial in range(30):
        n_docs, n_terms = rng.choice([1, 7, 120]), 12
        values = [1, 2, 3] if trial % 2 else [int(1000 * rng.paretovariate(0.7)) for _ in range(500)]
        doc, term, impact = random_run(rng, n_docs, n_terms, values)
        run = R.Run(doc, term, impact, n_docs, n_terms)
        terms = np.array(sorted(rng.sample(range(n_terms), 5)))
        total = np.zeros(n_docs, np.int64)
        np.add.at(total, doc[np.isin(term, terms)], impact[np.isin(term, terms)])
        best = sorted((-s, d) for d, s in enumerate(total.tolist()) if s > 0)[:10]
        for floor in (0, -best[-1][0] if best else 0):
            search = R.Search(run, terms, 10, floor)
            docs, scores = search.result()
            assert list(zip((-scores).tolist(), docs.tolist())) == best
            scored, all_pairs = scored + search.scored, all_pairs + int((total > 0).sum())
    if width == 1:
        assert scored < 0.7 * all_pairs


def test_range_maxima():
    rng = random.Random(2)
    doc, term, impact = random_run(rng, 200, 3, range(20))
    run = R.Run(doc, term, impact, 200, 3)
    a, b = run.edge[:-1].repeat(40), run.edge[1:].repeat(40)
    a = np.array([rng.randrange(x, y) for x, y in zip(a, b)])
    b = np.array([rng.randrange(x + 1, y + 1) for x, y in zip(a, b)])
    for x, y, place in zip(a, b, run.best(a, b)):
        assert place == x + int(np.argmax(run.impact[x:y]))


def test_runs_hold_all_rows_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(R, "RUN_POSTINGS", 10)
    sizes = [3, 3, 3, 3, 25, 0, 1, 9, 4, 10, 10]
    lists = pa.array([list(range(s)) for s in sizes], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), lists], ["doc", "term"])
    tables = list(R._runs(iter([batch.slice(0, 4), batch.slice(4, 2), batch.slice(6)])))
    assert [d for t in tables for d in t.column("doc").to_pylist()] == list(range(len(sizes)))
    held = [sum(len(x) for x in t.column("term").to_pylist()) for t in tables]
    assert all(h <= 10 or t.num_rows == 1 or h == 25 for h, t in zip(held, tables)) and sum(held) == sum(sizes)


def test_odd_tables_in_one_block_and_in_many(spark, monkeypatch, odd, odd_rows, empty):
    asked = [(1, "W3X3 été tail", "a", "b"), (1, "W3X3 été tail", "a", "b"), (2, None, "a", "b"), (3, "", "a", "b"),
             (None, "one two text of", "a", "b"), (4, "unknown", "a", "b"), (5, "日本語 s", "a", "b")]
    items = spark.createDataFrame(asked, ITEMS)
    docs = [(r[0], r[1]) for r in odd_rows]
    expected = brute(docs, [(i, t) for i, t, _, _ in asked])
    for pairs in (R.BLOCK_PAIRS, 5):
        monkeypatch.setattr(R, "BLOCK_PAIRS", pairs)
        assert Counter(map(tuple, R.best_documents(odd, items).collect())) == expected
    assert R.best_documents(empty, items).count() == 0
    assert R.best_documents(odd, items.where("item_id > 5")).count() == 0


def test_more_documents_than_results(spark):
    rng = random.Random(8)
    bodies = [" ".join(f"t{min(int(rng.paretovariate(0.8)), 80)}" for _ in range(rng.randrange(1, 60))) for _ in range(700)]
    docs = [(rng.randrange(400), b) for b in bodies] + [(7, bodies[0])] * 90
    asked = [(k, " ".join(f"T{rng.randrange(1, 90)}" for _ in range(6))) for k in range(15)]
    found = R.best_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(asked, "item_id long, text string"),
        top=20,
    )
    assert Counter(map(tuple, found.collect())) == brute(docs, asked, 20)
