from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from lodgemart.operators.dedup import keep_any, keep_latest
from lodgemart.plans.cleaning import clean_customers, clean_rooms

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_latest_wins_and_ties_are_settled(spark):
    df = spark.createDataFrame(
        [("a", T1, "x"), ("a", T2, "y"), ("a", T2, "z"), ("b", None, "q"), ("b", T1, "p"),
         (None, T1, "m"), (None, T1, "n")],
        "k string, ts timestamp, v string",
    )
    assert rows(keep_latest(df, ["k"], "ts"), "k", "v") == [(None, "n"), ("a", "z"), ("b", "p")]


def test_given_tie_break(spark):
    df = spark.createDataFrame([("a", T1, 1, "z"), ("a", T1, 2, "b")], "k string, ts timestamp, n int, v string")
    assert rows(keep_latest(df, ["k"], "ts", ["n"]), "n", "v") == [(2, "b")]


def test_rank_filter_runs_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", T1, 1)], "k string, ts timestamp, n int")
    plan = keep_latest(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_keep_any(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, v int")
    assert rows(keep_any(df, ["k"]), "k") == [(None,), ("a",)]
    assert rows(keep_any(df, ["k"], deterministic=True)) == [(None, 3), ("a", 2)]
    assert rows(keep_any(df.select("k"), ["k"], deterministic=True)) == [(None,), ("a",)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.integers(0, 3)), min_size=1))
def test_one_row_per_key_and_it_is_the_newest(spark, values):
    df = spark.createDataFrame(values, "k int, ts int, v int")
    best = {}
    for k, ts, v in values:
        best[k] = max(best.get(k, (-1, -1)), (ts, v))
    expected = sorted(((k, *b) for k, b in best.items()), key=lambda r: [(x is not None, x) for x in r])
    assert rows(keep_latest(df, ["k"], "ts")) == expected


def test_customers_with_and_without_load_time(spark):
    df = spark.createDataFrame(
        [("c1", " ", T1), ("c1", "a@b", T1), ("c2", "null", T2)],
        "customer_id string, email string, ingestion_date timestamp",
    )
    expected = [("c1", "a@b"), ("c2", None)]
    assert rows(clean_customers(df), "customer_id", "email") == expected
    assert rows(clean_customers(df.drop("ingestion_date"))) == expected


def test_rooms(spark):
    df = spark.createDataFrame([("r1", "h"), ("r1", "h"), ("r2", "h")], "room_id string, hotel_id string")
    assert rows(clean_rooms(df)) == [("r1", "h"), ("r2", "h")]


def test_maps_take_no_part_in_the_order(spark):
    df = spark.sql("select * from values ('a', map('x', 1), 1), ('a', map('x', 2), 2) as t(k, m, n)")
    assert rows(keep_any(df, ["k"], deterministic=True), "k", "n") == [("a", 2)]
