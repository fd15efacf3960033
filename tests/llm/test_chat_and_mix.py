import itertools
from collections import Counter
from fractions import Fraction

import pytest
from conftest import rows
from llm_cases import empty, odd, odd_rows, sf  # noqa: F401
from pyspark.sql import functions as F

from lodgemart.llm import chat_collapse, pfair_mix
from lodgemart.llm.queries import llm_oracles, llm_queries

TURNS = "conv_id long, turn long, role string, text string"


def chats(spark, data):
    return spark.createDataFrame(data, TURNS)


def test_chat_query_equals_sql(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    name = "op8_chat_formatting"
    mine = llm_queries()[name](spark, sf)
    answer = db.sql(llm_oracles()[name])
    assert mine.columns == answer.columns
    assert rows(mine) == sorted(answer.fetchall())


def test_snapshots_collapse_like_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    data = []
    for conv, n in ((1, 1), (2, 2), (3, 3), (4, 3), (5, 2)):
        data += [(conv, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(n)]
    data += [(6, 0, "user", "t0"), (6, 1, "assistant", "other")]
    data += [(7, None, None, None), (None, 0, "user", "<|im_end|>"), (None, 0, "user", "tie"), (8, 0, "user", "tie")]
    df = chats(spark, data)
    path = str(tmp_path / "chats")
    df.write.parquet(path)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    found = rows(chat_collapse.collapse_and_render(df.withColumn("key", F.lit(1)).withColumn("at", F.lit(2))))
    expected = db.sql(chat_collapse.COLLAPSE_SQL).fetchall()
    assert found == sorted(expected, key=lambda r: [(v is not None, v) for v in r])
    assert {r[0] for r in found} == {3, 6, 7, None, 8}
    assert [r[2] for r in found if r[0] == 3] == [2]


def test_chat_empty(spark):
    assert chat_collapse.collapse_and_render(chats(spark, [])).count() == 0


def brute_schedule(blocks, parts):
    """Earliest deadline first, slot by slot, until a source is out."""
    period, sent, t, out = sum(parts.values()), Counter(), 0, []
    names = sorted(parts, key=lambda s: (s is not None, str(s)))
    while all(sent[s] < blocks[s] for s in names):
        ready = [
            (-(-(sent[s] + 1) * period // parts[s]), k, s)
            for k, s in enumerate(names)
            if sent[s] * period // parts[s] <= t
        ]
        _, _, s = min(ready)
        out.append((s, sent[s], t))
        sent[s] += 1
        t += 1
    return out


def test_schedule_is_that_of_edf_and_within_a_block():
    blocks = {"a": 700, "b": 90, None: 333}
    weights = {"a": 5.0, "b": 1.0, None: 2.2}
    found = {}
    for s, lo, hi, share, period, base, places in pfair_mix.plan_phases(blocks, weights, 100):
        for j in range(hi - lo):
            found[base + j // share * period + places[j % share]] = (s, lo + j)
    assert sorted(found) == list(range(sum(blocks.values())))
    parts = pfair_mix.shares(weights, 100)
    for s, j, t in brute_schedule(blocks, parts):
        assert found[t] == (s, j)
    sent = Counter()
    for t in range(500):
        sent[found[t][0]] += 1
        if min(blocks[s] - sent[s] for s in blocks) <= 0:
            break
        assert all(abs(sent[s] - parts[s] / 100 * (t + 1)) < 1 for s in parts)


def test_mix_keeps_every_row(spark, odd, odd_rows, empty):
    found = pfair_mix.mix_ids(odd, block_rows=2, period=10).collect()
    assert Counter((r[0], r[1]) for r in found) == Counter((r[0], r[3]) for r in odd_rows)
    assert len({r["position"] for r in found}) == len(found)
    mixed = pfair_mix.mix_rows(odd, {"a": 3, "b": 1}, block_rows=2, period=10)
    assert mixed.columns == odd.columns
    assert rows(mixed) == rows(odd)
    assert pfair_mix.mix_ids(empty).count() == 0
    assert pfair_mix.mix_rows(empty).count() == 0


def test_unweighted_sources_follow(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(40)], "doc_id long, source string")
    found = pfair_mix.mix_ids(df, {"a": 1.0}, block_rows=4).orderBy("position").collect()
    assert [r["source"] for r in found] == ["a"] * 20 + ["b"] * 20


def test_exact_weights_hold_within_a_block(spark):
    weights = {**{f"s{k:02}": 0.1 + 0.013 * k for k in range(8)}, "half": 1.2, "rare": 1e-5, None: 0.3}
    total = sum(map(Fraction, weights.values()))
    sent = Counter()
    for t, s in enumerate(itertools.islice(pfair_mix.block_sources(dict.fromkeys(weights, 10**9), weights), 100_000)):
        sent[s] += 1
        if t % 97 == 0 or t > 99_900:
            assert all(abs(sent[k] - Fraction(w) / total * (t + 1)) < 1 for k, w in weights.items())
    assert sent["rare"] <= 1
    parts = {"a": 5, "b": 1, None: 2}
    mine = list(pfair_mix.block_sources({"a": 40, "b": 30, None: 60}, parts))
    brute = brute_schedule({"a": 40, "b": 30, None: 60}, parts)
    assert [s for s, _, _ in brute] == mine[: len(brute)]
    assert Counter(mine) == {"a": 40, "b": 30, None: 60}


def test_mix_holds_the_given_weights(spark, monkeypatch):
    sizes, weights = {"a": 3_500, "b": 900, None: 500, "late": 7}, {"a": 5.0, "b": 1.0, None: 0.51}
    data = [(i, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "doc_id long, source string")
    for limit in (pfair_mix.BROADCAST_BLOCKS, 0):
        monkeypatch.setattr(pfair_mix, "BROADCAST_BLOCKS", limit)
        found = pfair_mix.mix_ids(df, weights, block_rows=1).orderBy("position").collect()
        order = [r["source"] for r in found]
        assert order == list(pfair_mix.block_sources(sizes, weights))
        assert [r["position"] for r in found] == list(range(len(data)))
        assert len({(r["doc_id"], r["source"]) for r in found}) == len(data)
        sent = Counter()
        for t, s in enumerate(order, 1):
            sent[s] += 1
            assert all(abs(sent[k] - w / 6.51 * t) < 1 + 1e-9 for k, w in weights.items())
            if any(sent[k] == sizes[k] for k in weights):
                break
        assert t > 3_000


def test_rows_of_repeated_ids_keep_the_weights(spark, monkeypatch):
    """One id on a third of the rows, one row on a tenth: each row has its place, within a block of the target."""
    monkeypatch.setattr(pfair_mix, "PLACES", 7)
    sizes, weights = {"a": 9_000, "b": 6_000, None: 5_000}, {"a": 3.0, "b": 2.0, None: 1.0}
    data = []
    for s, n in sizes.items():
        data += [(1 if k % 3 == 0 else k, s, "same" if k % 10 == 0 else f"t{k}") for k in range(n)]
        data += [(1, s, "same")] * (n // 10)
    df = spark.createDataFrame(data, "doc_id long, source string, text string").repartition(5)
    found = [tuple(r) for r in pfair_mix.mix_rows(df, weights, block_rows=8).collect()]
    assert Counter(found) == Counter(data)
    left, sent = Counter(s for _, s, _ in data), Counter()
    for t, (_, s, _) in enumerate(found, 1):
        sent[s] += 1
        assert all(abs(sent[k] - w / 6 * t) <= 8 for k, w in weights.items())
        if any(sent[k] == left[k] for k in weights):
            break
    assert t > 10_000
    again = [tuple(r) for r in pfair_mix.mix_rows(df.repartition(3, "text"), weights, block_rows=8).collect()]
    assert again == found
    placed = pfair_mix.mix_ids(df, weights, block_rows=8).select("position").collect()
    assert len({r[0] for r in placed}) == len(data)
