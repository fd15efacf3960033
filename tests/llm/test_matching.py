import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import empty, low, odd, odd_rows, plain_words, sf, texts, words  # noqa: F401

from lodgemart.llm import components, decontaminate, jaccard_join, license_scan
from lodgemart.llm.queries import llm_queries

ITEMS = "item_id long, text string"


def brute_components(rows):
    """(set size, smallest id reachable) of each (id, text)."""
    sets = []
    for _, text in rows:
        w = words(low(text))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else []))
    held = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            held[x].append(k)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for k, s in enumerate(sets):
        common = Counter(j for x in s for j in held[x] if j > k)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(j)] = find(k)
    least = defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        least[find(k)].append(doc)
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [i for i in least[find(k)] if i is not None]
        out.append((doc, len(sets[k]), (min(ids) if ids else None) if sets[k] else doc))
    return Counter(out)


def test_join_equals_brute_force(spark, sf, texts):
    found = llm_queries()["op6_jaccard_join"](spark, sf)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, found.collect())) == brute_components(texts)


def edited(rng, body, edits):
    out = list(body)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("block", [None, 400])
def test_groups_of_near_copies_and_common_passages(spark, monkeypatch, block):
    """Chains of links, small sets around the boundary, one passage in all texts, blocks of clusters."""
    if block:
        monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(12)]
    rows = []
    for size in (5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 150):
        body = [f"b{size}x{i}" for i in range(size)] + (passage if size > 10 else [])
        for _ in range(14):
            rows.append((len(rows), edited(rng, body, rng.randrange(1 + max(1, size // 12)))))
    rows += [(1_000 + i, f"q{i} " + " ".join(passage)) for i in range(20)]
    rows += [(2_000, rows[3][1].upper()), (2_001, rows[3][1].replace(" ", "\n"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.jaccard_components(df)
    assert Counter(map(tuple, found.collect())) == brute_components(rows)
    kept = jaccard_join.one_of_each(df).collect()
    assert {r["doc_id"] for r in kept} == {r[2] for r in brute_components(rows)}


@pytest.mark.parametrize("boundary", [0, 6, 20, 64])
def test_every_boundary_gives_the_same_links(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "cheapest_boundary", lambda prefix: boundary)
    rng = random.Random(boundary)
    rows = []
    for size in range(5, 45, 3):
        body = [f"b{size}x{i}" for i in range(size)]
        rows += [(len(rows) + k, edited(rng, body, rng.randrange(3))) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard_join.jaccard_components(df).collect())) == brute_components(rows)


def test_join_of_odd_rows(spark, odd, odd_rows, empty):
    found = jaccard_join.jaccard_components(odd)
    assert Counter(map(tuple, found.collect())) == brute_components([r[:2] for r in odd_rows])
    assert jaccard_join.jaccard_components(empty).count() == 0
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 3, 4, 5, 5, 8, 9, 10]
    assert jaccard_join.one_of_each(empty).count() == 0


def test_repeated_ids_lose_only_their_copies(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    data = [(5, a), (5, b), (3, a + " end"), (8, b + " end"), (7, c), (7, c + " end"), (7, c), (9, ""), (9, None), (9, "")]
    df = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, more string")
    kept = [tuple(r) for r in jaccard_join.one_of_each(df).collect()]
    assert sorted(r[0] for r in kept) == [3, 5, 7, 9, 9]
    assert (5, b, "x") in kept and (3, a + " end", "x") in kept


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100), (7, 7)]
    found = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100}


def brute_leaks(rows, items):
    """Best window of each text and item at 0.8 or more, over all windows."""
    out = {}
    for item, text in items:
        wanted = plain_words(text)
        if not wanted:
            continue
        k, m = min(5, len(wanted)), len(wanted)
        b = Counter(tuple(wanted[i : i + k]) for i in range(m - k + 1))
        for doc, text in rows:
            w = plain_words(text)
            grams = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            if not any(g in b for g in grams):
                continue
            for at in range(max(len(w) - m, 0) + 1):
                a = Counter(grams[at : at + m - k + 1])
                found = sum((a & b).values()) / sum((a | b).values())
                if found >= 0.8 and (found, -at) > out.get((doc, item), (0, 0)):
                    out[doc, item] = (found, -at)
    return {k: (round(v[0], 9), -v[1]) for k, v in out.items()}


def as_dict(found):
    return {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["first_word"]) for r in found.collect()}


def test_leaks_equal_brute_force(spark, sf, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert as_dict(llm_queries()["op1_decontamination"](spark, sf)) == brute_leaks(texts, items)


def test_edited_leaks_and_short_items(spark, sf, texts):
    rng = random.Random(2)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(12).collect()]
    items += [(900, "Only, three words!"), (901, "solo"), (902, None), (903, ""), (None, "a null id is an item as well")]
    rows = []
    for item, text in items:
        for edits in range(4):
            body = edited(rng, words(text) or ["none"], edits if item != 901 else 0)
            before, after = (words(texts[rng.randrange(len(texts))][1])[:40] for _ in range(2))
            rows.append((len(rows), " ".join([*before, body, *after])))
        rows.append((len(rows), text and text.upper()))
        rows.append((len(rows), text and " ".join(words(text)[1:])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, ITEMS)
    expected = brute_leaks(rows, items)
    assert as_dict(decontaminate.leaked_items(df, bench)) == expected
    kept = {r["doc_id"] for r in decontaminate.without_leaks(df, bench).collect()}
    assert kept == {r[0] for r in rows} - {doc for doc, _ in expected}


def test_leaks_of_odd_rows(spark, odd, odd_rows, empty):
    bench = spark.createDataFrame([(1, odd_rows[0][1][40:300]), (2, "one two")], ITEMS)
    expected = brute_leaks([r[:2] for r in odd_rows], [(1, odd_rows[0][1][40:300]), (2, "one two")])
    assert as_dict(decontaminate.leaked_items(odd, bench)) == expected
    kept = decontaminate.without_leaks(odd, bench)
    assert kept.columns == odd.columns
    items = [(1, odd_rows[0][1][40:300]), (2, "one two")]
    assert kept.count() == sum(not brute_leaks([r[:2]], items) for r in odd_rows)
    assert decontaminate.leaked_items(odd, spark.createDataFrame([], ITEMS)).count() == 0
    assert decontaminate.leaked_items(empty, bench).count() == 0
    assert decontaminate.without_leaks(odd, spark.createDataFrame([], ITEMS)).count() == len(odd_rows)


@pytest.mark.parametrize("part", [1, 7, 64])
def test_leaks_across_parts_of_long_texts(spark, monkeypatch, part):
    monkeypatch.setattr(decontaminate, "PART", part)
    rng = random.Random(4)
    items = [(k, " ".join(f"w{rng.randrange(40)}" for _ in range(size))) for k, size in enumerate((2, 4, 9, 23, 60))]
    rows = [(0, None), (1, ""), (2, "w1"), (None, items[2][1]), (None, items[2][1])]
    for k in range(12):
        held = [edited(rng, words(text), k % 3) for _, text in rng.sample(items, 3)]
        gaps = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(50))) for _ in range(4)]
        rows += [(10 + k, " ".join(x for pair in zip(gaps, [*held, ""], strict=True) for x in pair))] * (1 + k % 2)
    expected = brute_leaks(rows, items)
    assert len(expected) > 12
    found = decontaminate.leaked_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert as_dict(found) == expected


def test_only_keys_of_texts_are_broadcast_and_no_words_copied(spark, monkeypatch):
    """Windows and words of texts grow with the input: they are neither sent to all tasks nor copied into exploded rows."""
    checked, wrote, real = [], {}, decontaminate.written

    def written(df, purpose, *rest):
        wrote[purpose] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, purpose, *rest)

    monkeypatch.setattr(decontaminate, "written", written)
    monkeypatch.setattr(decontaminate, "size_checked", lambda df, n: checked.append(df) or df)
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    found = decontaminate.leaked_items(docs, spark.createDataFrame([(5, "b c d e f g")], ITEMS))
    of_texts = [df.columns for df in checked if "k1" in df.columns]
    assert of_texts == [["k1", "k2"]]
    lines = [x for x in wrote["leak-places"].splitlines() if "Generate posexplode" in x]
    kept = [x.rpartition(", false, [")[0].rpartition("[")[2] for x in lines]
    assert kept and not any("words" in x for x in kept), kept
    assert "strategy=merge" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r)[:2] for r in found.collect()] == [(1, 5)]


def test_hamming_blocks_guarantee_the_radius():
    masks = decontaminate.block_masks(decontaminate.RADIUS)
    assert len(masks) == decontaminate.RADIUS + 1
    assert sum(masks) == (1 << decontaminate.BITS) - 1
    rng = random.Random(0)
    for _ in range(500):
        a = rng.getrandbits(decontaminate.BITS)
        b = a
        for k in rng.sample(range(decontaminate.BITS), decontaminate.RADIUS):
            b ^= 1 << k
        assert any((a ^ b) & m == 0 for m in masks)


def phrase_rows(rows):
    out = Counter()
    for doc, text in rows:
        w = plain_words(text)
        places = [
            (i, label)
            for phrase, label in license_scan.PHRASES.items()
            for i in range(len(w))
            if w[i : i + len(phrase.split())] == phrase.split()
        ]
        at = [i for i, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        out[doc, len(w), len(places), min(at, default=None), max(at, default=None), labels] += 1
    return out


def base_of(found):
    return Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found)


def test_license_query_equals_brute_force(spark, sf, texts):
    found = llm_queries()["op7_license_scan"](spark, sf).collect()
    assert base_of(found) == phrase_rows(texts)
    for r in found:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_license_spans_survive_edits(spark, odd, odd_rows, empty):
    notice = license_scan.TEMPLATES["bsd"][0]
    w = notice.split()
    rows = [
        (1, f"x y z {notice} and more"),
        (2, " ".join([*w[:8], "INSERTED", *w[8:]])),
        (3, " ".join(w[: len(w) // 2])),
        (4, f"MIT License, MIT license; {notice} / {notice}"),
        (5, "the general  public-license"),
        (6, "license mit license license"),
        (7, "Licensed under CC BY-NC 4.0."),
        (None, notice),
        (8, " ".join(reversed(w))),
    ]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert base_of(found) == phrase_rows(rows)
    labels = {r["doc_id"]: r["labels"] for r in found}
    assert labels == {1: "bsd", 2: "bsd", 3: "", 4: "bsd,mit", 5: "gpl", 6: "mit", 7: "cc-by-nc", None: "bsd", 8: ""}
    assert base_of(license_scan.scan(odd).collect()) == phrase_rows([r[:2] for r in odd_rows])
    assert license_scan.scan(empty).count() == 0


def test_links_within_blocks():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 30, 25).astype(np.uint64)) for _ in range(30)]

    def linked(a, b):
        return 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))

    found = jaccard_join.links_within(sets[:12], sets[12:], 80)
    assert all(a < 12 <= b and linked(sets[a], sets[b]) for a, b in found)
    pairs = [(a, b) for a in range(12) for b in range(12, 30) if linked(sets[a], sets[b])]
    assert bool(found) == bool(pairs) and len({x for p in pairs for x in p}) == len({x for p in found for x in p})
