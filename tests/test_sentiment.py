import math
import re

import pytest

from conftest import rows
from lodgemart.functions import sentiment as S
from lodgemart.plans import sentiment as P
from lodgemart.plans.sentiment import enrich_sentiment, sentiment_by_customer, score_by_table, score_reviews

LEXICON = {
    "good": 3, "great": 3, "bad": -3, "awful": -3, "ok": 1, "not good": -2, "can't stand": -3,
    "self-deluded": -2, "stand": 0.5, "cool": 1, "cool stuff": 3, "Naïve": -2, "the": -1,
}

TEXTS = [
    None,
    "",
    "ok",
    "OK OK",
    "Good, GREAT!",
    "bad",
    "goodness badly okay",
    "not good; not  bad",
    "not\n good",
    "I can't stand it, can't standing",
    "self-deluded self deluded",
    "cool cool stuff cool-stuff coolstuff",
    "naïve NAÏVE naive",
    "good_bad good1 1good good-bad",
    "thé the\tthe",
    "it's good's",
    "good " * 5000,
]


def brute(text):
    """Longest entry first at every word boundary, left to right."""
    if text is None:
        return 0.0
    entries = {" ".join(k.lower().split()): v for k, v in LEXICON.items()}
    longest_first = sorted(entries, key=len, reverse=True)
    found = re.findall(r"\b(?:" + "|".join(map(re.escape, longest_first)) + r")\b", " ".join(text.lower().split()))
    return float(sum(entries[f] for f in found))


def reviews(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, review_text string")


def test_scores_match_a_plain_reading(spark):
    out = rows(score_reviews(reviews(spark), LEXICON), "id", "sentiment_score")
    assert out == [(i, brute(t)) for i, t in enumerate(TEXTS)]
    assert {brute(t) for t in TEXTS} >= {0.0, 1.0, 6.0, -3.0, 15000.0}


def test_no_python_worker_and_no_shuffle(spark):
    plan = score_reviews(reviews(spark), LEXICON)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_lexicons(spark):
    empty = spark.createDataFrame([], "word string, valence double")
    for lexicon in ({}, {" ": 1.0}, empty):
        assert set(rows(score_reviews(reviews(spark), lexicon), "sentiment_score")) == {(0.0,)}


def test_labels_at_the_band(spark):
    df = spark.createDataFrame([(v,) for v in (-1.01, -1.0, 0.0, 1.0, 1.01)], "s double")
    labels = [r[0] for r in df.select(S.sentiment_label("s")).collect()]
    assert labels == ["negative", "neutral", "neutral", "neutral", "positive"]


TRICKY = {
    **LEXICON, " Good ": 4, "GOOD": 2, "not  bad\n": 2, "well-known": 3, "by-": -7, "cool stuff x": 9, "-deluded": 8,
}
TRICKY_TEXTS = [
    *TEXTS, "not bad at all", "well-known good place", "Good", "by-x by- by-", "cool stuff xx cool stuff x",
    "self -deluded self-deluded", "not not good", "a\u00a0good", "good" * 3 + " good",
]


def table(spark, lexicon):
    return spark.createDataFrame([(w, float(v)) for w, v in lexicon.items()], "word string, valence double")


@pytest.mark.parametrize("splits", [1, 3])
def test_table_form_equals_native_form(spark, splits):
    df = spark.createDataFrame(list(enumerate(TRICKY_TEXTS)) + [(0, TRICKY_TEXTS[0])], "id int, review_text string")
    joined = score_by_table(df, table(spark, TRICKY), splits=splits)
    native = score_reviews(df, TRICKY)
    assert joined.columns == native.columns
    assert rows(joined) == rows(native)
    found = dict(rows(native, "review_text", "sentiment_score"))
    assert (found["not bad at all"], found["well-known good place"], found["Good"]) == (2.0, 7.0, 4.0)


def by_regex(entries, text):
    found = re.findall(r"\b(?:" + "|".join(sorted(map(re.escape, entries), key=len, reverse=True)) + r")\b", text)
    return float(sum(entries[f] for f in found))


@pytest.mark.parametrize("sent", [True, False])
def test_large_lexicons_are_joined(spark, monkeypatch, sent):
    """20,600 entries, sent to all tasks or met by a shuffle, as a mapping or a table."""
    if not sent:
        monkeypatch.setattr(P, "BROADCAST_ENTRIES", 10)
    large = {f"w{i}": float(i % 3 - 1) for i in range(20_500)} | {f"w{i} w{i + 1}": 5.0 for i in range(0, 300, 3)}
    texts = [(k, " ".join(f"w{(k * 37 + i) % 21_000}" for i in range(40))) for k in range(20)]
    df = spark.createDataFrame(texts, "id int, review_text string")
    expected = [(k, by_regex(large, t)) for k, t in texts]
    for lexicon in (large, table(spark, large)):
        assert rows(score_reviews(df, lexicon), "id", "sentiment_score") == expected
    with pytest.raises(ValueError, match="table"):
        S.sentiment_score("review_text", large)


@pytest.mark.parametrize("splits", [1, 3])
def test_shuffled_index_equals_native_form(spark, monkeypatch, splits):
    monkeypatch.setattr(P, "BROADCAST_ENTRIES", 3)
    df = spark.createDataFrame(list(enumerate(TRICKY_TEXTS)), "id int, review_text string")
    joined = score_by_table(df, table(spark, TRICKY), splits=splits)
    assert rows(joined) == rows(score_reviews(df, TRICKY))


def test_entries_stand_under_their_rarest_token(spark):
    lexicon = table(spark, {"not good": 1, "not bad": 2, "not": 3, "bad-tempered": 4, "good": 5, "not so very good": 6})
    found = rows(P.anchored(P.lexicon_entries(lexicon)), "entry", "anchor", "offset", "size")
    assert found == [
        ("bad-tempered", "tempered", 2, 3), ("good", "good", 0, 1), ("not", "not", 0, 1), ("not bad", "bad", 1, 2),
        ("not good", "good", 1, 2), ("not so very good", "very", 2, 4),
    ]


def test_only_places_of_anchors_are_shuffled(spark):
    df = spark.createDataFrame([(1, "plain words and a very good one")], "id int, review_text string")
    scored = score_by_table(df, table(spark, LEXICON))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan
    # A lexicon that fits is checked and becomes part of the plan.
    plan = score_reviews(df, table(spark, LEXICON))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_table_skips_nulls_and_takes_the_largest_repeat(spark):
    lexicon = spark.createDataFrame(
        [("good", 3), (None, 1), ("bad", None), ("GOOD", 5), ("good ", 4)], "word string, valence int"
    )
    df = spark.createDataFrame([(1, "good bad", {"k": 1})], "id int, review_text string, extra map<string,int>")
    assert rows(score_by_table(df, lexicon), "sentiment_score") == [(5.0,)]


def test_enriched_customers(spark):
    value = spark.createDataFrame([("c1", 2), ("c2", 1), (None, 1)], "customer_id string, bookings_count int")
    scored = score_reviews(
        spark.createDataFrame(
            [("c1", "good"), ("c1", None), ("c9", "bad"), (None, "bad")],
            "customer_id string, review_text string",
        ),
        LEXICON,
    )
    assert rows(enrich_sentiment(value, scored)) == [(None, 1, 0.0), ("c1", 2, 1.5), ("c2", 1, 0.0)]


def test_means_do_not_depend_on_the_order_of_rows(spark):
    values = [0.1, 1e-7, 3.3, -2.2, 1e9, 0.7, -1e9, 1 / 3] * 40
    scored = spark.createDataFrame([(f"c{i % 3}", v) for i, v in enumerate(values)], "customer_id string, sentiment_score double")
    found = [rows(sentiment_by_customer(scored.repartition(n, "sentiment_score"))) for n in (1, 7, 211)]
    assert found[0] == found[1] == found[2]
    for customer, mean in found[0]:
        mine = [v for i, v in enumerate(values) if f"c{i % 3}" == customer]
        assert mean == pytest.approx(math.fsum(mine) / len(mine), abs=1e-9)
    far = spark.createDataFrame([("c", 1e30), ("c", None), ("d", None)], scored.schema)
    assert rows(sentiment_by_customer(far)) == [("c", 1e30), ("d", None)]
