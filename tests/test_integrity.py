from decimal import Decimal

import pytest

from conftest import rows
from lodgemart.operators.integrity import flag_orphans, flag_over, one_row_per_key
from lodgemart.operators.skew import left_lookup
from lodgemart.plans.cleaning import clean_payments

PAYMENTS = "payment_id string, booking_id string, amount decimal(12,2), currency string"


def dec(text):
    return None if text is None else Decimal(text)


def payments(spark, *cases):
    return spark.createDataFrame([(p, b, dec(a), c) for p, b, a, c in cases], PAYMENTS)


def bookings(spark, *cases):
    return spark.createDataFrame(
        [(b, dec(t)) for b, t in cases], "booking_id string, total_amount decimal(12,2)"
    )


@pytest.mark.parametrize("splits", [1, 2, 7])
def test_payment_flags(spark, splits):
    child = payments(
        spark,
        ("match", "b1", "10.00", "EUR"),
        ("equal", "b1", "100.00", "USD"),
        ("over", "b1", "100.01", "EUR"),
        ("orphan", "b9", "5.00", "GBP"),
        ("nokey", None, "5.00", "ZZZ"),
        ("nototal", "b2", "5.00", None),
        ("noamount", "b1", None, "EUR"),
        ("repeated", "b3", "50.00", "EUR"),
    )
    parent = bookings(
        spark, ("b1", "100.00"), ("b2", None), ("b3", "40.00"), ("b3", "60.00"), (None, "1.00")
    )
    out = clean_payments(child, parent, splits=splits)
    assert out.columns == [
        "payment_id", "booking_id", "amount", "currency", "bk_total_amount",
        "dq_orphan_payment", "dq_over_amount", "dq_invalid_currency",
    ]
    marks = rows(out, "payment_id", "bk_total_amount", *out.columns[5:])
    assert marks == [
        ("equal", dec("100.00"), False, False, False),
        ("match", dec("100.00"), False, False, False),
        ("noamount", dec("100.00"), False, False, False),
        ("nokey", None, True, False, True),
        ("nototal", None, False, False, False),
        ("orphan", None, True, False, False),
        ("over", dec("100.00"), False, True, False),
        ("repeated", dec("60.00"), False, False, False),
    ]
    assert rows(out, "payment_id", "currency")[3] == ("nokey", None)


def test_one_row_per_key_keeps_one_repeat_whole(spark):
    parent = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "b"), ("b", 3, None), (None, 4, "z")], "k string, n int, s string"
    )
    out = one_row_per_key(parent, "k", {"n": "m", "s": "t"})
    assert rows(out) == [("a", 2, "b"), ("b", 3, None)]
    assert rows(one_row_per_key(parent, "k", {})) == [("a",), ("b",)]


def test_flag_orphans_without_carried_columns(spark):
    child = spark.createDataFrame([(1, "a"), (2, "q")], "i int, k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k2 string")
    assert rows(flag_orphans(child, parent, "k", "k2", {}, "gone")) == [(1, "a", False), (2, "q", True)]


def test_flag_over_needs_a_parent(spark):
    df = spark.createDataFrame([(5, 1, True), (5, 1, False), (5, 5, False)], "a int, l int, o boolean")
    assert rows(flag_over(df, "a", "l", "o", "over"), "a", "l", "o", "over") == [
        (5, 1, False, True),
        (5, 1, True, False),
        (5, 5, False, False),
    ]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without a key, copies included."""
    child = spark.range(0, 3000, 1, 6).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id) end as k",
        "cast(id % 7 as int) as v",
    )
    parent = spark.range(0, 3000, 1, 3).selectExpr(
        "case when id = 0 then 'hot' else concat('k', id) end as pk", "id as w"
    )
    return child, parent


@pytest.mark.parametrize("splits", [1, 5])
def test_left_lookup_equals_a_left_join(spark, skewed, splits):
    child, parent = skewed
    plain = child.join(parent, child.k == parent.pk, "left")
    assert rows(left_lookup(child, parent, "k", "pk", splits)) == rows(plain)


def _sizes(spark, child, parent, splits, **conf):
    """Rows in each task of the joined table."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"} | conf
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = left_lookup(child, parent, "k", "pk", splits)
        return [n for _, n in joined.groupBy(_task()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_splits_spread_hot_and_keyless_rows(spark, skewed):
    child, parent = skewed
    child = child.withColumn("v", child.v * 1000 + spark_id())
    sizes = _sizes(spark, child, parent, 32, **{"spark.sql.adaptive.enabled": "false"})
    assert sum(sizes) == 3000 and max(sizes) < 600


def test_adaptive_execution_splits_a_hot_key(spark, skewed):
    """The join stands right on its own shuffles, so a hot key's rows go to several tasks."""
    child, parent = skewed
    child = child.withColumn("v", child.v * 1000 + spark_id())
    unique = one_row_per_key(parent, "pk", {"w": "w"}).withColumnRenamed("_parent_key", "pk")
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    sizes = _sizes(spark, child, unique, 1, **small)
    assert sum(sizes) == 3000 and max(sizes) < 600


def test_one_read_of_each_side(spark, tmp_path, skewed):
    for name, table in zip(("child", "parent"), skewed):
        table.write.parquet(str(tmp_path / name))
    child, parent = (spark.read.parquet(str(tmp_path / name)) for name in ("child", "parent"))
    out = flag_orphans(child, parent, "k", "pk", {"w": "pw"}, "orphan")
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def spark_id():
    from pyspark.sql import functions as F

    return F.monotonically_increasing_id() % 997


def _task():
    from pyspark.sql import functions as F

    return F.spark_partition_id().alias("task")
