from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from conftest import rows
from lodgemart.schemas import (
    MONEY,
    PAYMENTS,
    column_type,
    comparable,
    find_column,
    sum_type,
    table_schema,
)
from lodgemart.sources.ingest import TableSpec, audit_frame, ingest, stamp, write_counted, write_verified
from lodgemart.sources.layers import PathLayer, TableLayer, require_distinct
from lodgemart.sources.readers import read_csv
from lodgemart.sources.scratch import scratch_path

CSV = 'payment_id,booking_id,amount,transaction_date\np1,b1,10.50,2024-01-02\np2,,abc,never\np3,"",7,2024-01-03\n'


@pytest.fixture
def payments_csv(tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text(CSV)
    return str(path)


def test_typed_csv(spark, payments_csv):
    df = read_csv(spark, payments_csv, PAYMENTS)
    assert dict(df.dtypes) == {
        "payment_id": "string", "booking_id": "string", "amount": "decimal(12,2)", "transaction_date": "date",
    }
    assert rows(df, "payment_id", "amount", "transaction_date") == [
        ("p1", Decimal("10.50"), date(2024, 1, 2)),
        ("p2", None, None),
        ("p3", Decimal("7.00"), date(2024, 1, 3)),
    ]
    assert rows(df, "payment_id", "booking_id")[1] == ("p2", None)


def test_typed_csv_follows_the_header_not_the_declared_order(spark, tmp_path):
    (tmp_path / "t.csv").write_text("extra,N,id\nx,1,a\n")
    df = read_csv(spark, str(tmp_path / "t.csv"), table_schema(("id", T.StringType()), ("n", T.IntegerType())))
    assert df.dtypes == [("extra", "string"), ("N", "int"), ("id", "string")]
    assert rows(df) == [("x", 1, "a")]


def test_files_with_another_header_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\na,1\n")
    (tmp_path / "b.csv").write_text("n,id\n2,b\n")
    df = read_csv(spark, str(tmp_path), table_schema(("id", T.StringType()), ("n", T.IntegerType())))
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()


def test_string_and_inferred_csv(spark, payments_csv):
    assert {t for _, t in read_csv(spark, payments_csv).dtypes} == {"string"}
    inferred = dict(read_csv(spark, payments_csv, infer=True).dtypes)
    assert inferred["amount"] == "string" and inferred["transaction_date"] == "string"


def test_stamp(spark):
    df = spark.range(3)
    when = datetime(2024, 5, 1, 12)
    assert {r.ingestion_date for r in stamp(df, when).collect()} == {when}
    assert stamp(df, name="at").select("at").distinct().count() == 1


def test_ingest_counts_while_writing(spark, payments_csv, tmp_path):
    layer = PathLayer(spark, str(tmp_path / "bronze"))
    specs = {"payments": TableSpec("payments.csv", PAYMENTS)}
    counts = ingest(spark, str(tmp_path), layer, specs, datetime(2024, 1, 1))
    assert counts == {"payments": 3}
    table = layer.read("payments")
    assert table.columns[-1] == "ingestion_date" and table.count() == 3
    assert rows(audit_frame(spark, counts)) == [("payments", 3)]
    again = ingest(spark, str(tmp_path), layer, specs, infer=True)
    assert again == {"payments": 3} and layer.read("payments").count() == 3


def test_path_layer_overwrites(spark, tmp_path):
    layer = PathLayer(spark, str(tmp_path / "x") + "/")
    layer.write(spark.range(5), "t")
    assert write_counted(spark.range(2), layer, "t") == 2
    assert layer.read("t").count() == 2


def test_table_layer_replaces_schema_and_buckets(spark, tmp_path):
    place = str(tmp_path / "s")
    layer = TableLayer(spark, "layer_a", "spark_catalog", location=place, bucket_by=(("t", "id"),), buckets=4)
    layer.prepare()
    layer.prepare()
    layer.write(spark.range(5).withColumnRenamed("id", "other"), "u")
    layer.write(spark.range(3), "u")
    assert layer.read("u").columns == ["id"]
    layer.write(spark.range(100), "t")
    layer.write(spark.range(100), "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = layer.read("t").join(layer.read("t"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    layer.use()
    try:
        assert spark.catalog.currentDatabase() == "layer_a"
        assert spark.table("u").count() == 3
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_layers_must_not_overlap(spark):
    a, inside, b = (PathLayer(spark, p) for p in ("/x/a", "/x/a/b/", "/x/ab"))
    require_distinct([a, b])
    with pytest.raises(ValueError):
        require_distinct([a, b, inside])
    with pytest.raises(ValueError):
        require_distinct([TableLayer(spark, "s"), TableLayer(spark, "s")])


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert one.startswith(shared + "/t-") and one != two


class _Conf:
    def __init__(self, **values):
        self.values = values
        self.conf = self

    def get(self, key, default):
        return self.values.get(key.replace(".", "_"), default)


def test_scratch_without_shared_folder(tmp_path):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_Conf(spark_master="yarn"), "t")
    assert "lodgemart-" in scratch_path(_Conf(spark_master="local[2]"), "t")


def test_schema_helpers(spark):
    df = spark.createDataFrame([], "Id string, Amount decimal(12,2)")
    assert find_column(df, "amount") == "Amount" and find_column(df, "x") is None
    assert column_type(df, "AMOUNT") == MONEY
    assert sum_type(MONEY) == T.DecimalType(22, 2)
    assert sum_type(T.DecimalType(38, 2)) == T.DecimalType(38, 2)
    assert sum_type(T.FloatType()) == T.DoubleType() and sum_type(T.IntegerType()) == T.LongType()
    assert comparable(T.ArrayType(T.StringType())) and not comparable(T.VariantType())
    nested = T.ArrayType(table_schema(("m", T.MapType(T.StringType(), T.IntegerType()))))
    assert not comparable(nested)


def test_writes_are_verified_by_content(spark, payments_csv, tmp_path, monkeypatch):
    layer = PathLayer(spark, str(tmp_path / "bronze"))
    specs = {"payments": TableSpec("payments.csv", PAYMENTS)}
    assert ingest(spark, str(tmp_path), layer, specs, verify=True) == {"payments": 3}
    assert write_verified(spark.range(0), layer, "none").matches
    nested = spark.sql("SELECT 1 AS i, map('a', 1) AS m, array(1.5D) AS l UNION ALL SELECT 1, map('a', 2), array(1.5D)")
    found = write_verified(nested, layer, "nested")
    assert (found.rows, found.matches) == (2, True)
    audit = audit_frame(spark, {"nested": found})
    assert rows(audit) == [("nested", 2, True)]
    # A value that changes on its way is noticed, though the number of rows is the same.
    read = PathLayer.read
    monkeypatch.setattr(PathLayer, "read", lambda self, n: read(self, n).replace("p2", "p9"))
    with pytest.raises(ValueError, match="payments does not hold the 3 rows"):
        ingest(spark, str(tmp_path), layer, specs, verify=True)


def test_scratch_needs_executors_of_this_process(tmp_path):
    for master in ("local-cluster[2,1,1024]", "localhost:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(_Conf(spark_master=master), "t")
    assert "lodgemart-" in scratch_path(_Conf(spark_master="local"), "t")
