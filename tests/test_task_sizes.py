"""Shuffles of a run are read in small tasks, and the session's settings come back."""

import pytest
from pyspark.sql import functions as F

from booking_files import write_files
from lodgemart.plans import stages
from lodgemart.sources import task_sizes
from lodgemart.sources.layers import PathLayer
from lodgemart.sources.task_sizes import ADVISORY, PARTS, listed_bytes, small_tasks


def settings(spark):
    return [spark.conf.get(k, None) for k in (ADVISORY, PARTS)]


@pytest.fixture(autouse=True)
def unset(spark):
    """Other tests put the defaults back as settings of the session, which would be kept."""
    before = dict(zip((ADVISORY, PARTS), settings(spark), strict=True))
    for key in before:
        spark.conf.unset(key)
    yield
    for key, value in before.items():
        if value is not None:
            spark.conf.set(key, value)


def test_stages_run_with_small_tasks(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_files(str(raw))
    before, seen, own = settings(spark), [], stages.run_gold
    monkeypatch.setattr(task_sizes, "TASK_BYTES", 1_000)
    monkeypatch.setattr(stages, "run_gold", lambda *a: (seen.append(settings(spark)), own(*a)))
    job = stages.Job(str(raw), *[PathLayer(spark, str(tmp_path / n)) for n in ("bronze", "silver", "gold", "report")])
    stages.run_all(spark, job, {"great": 3})
    stored = sum(f.stat().st_size for f in raw.iterdir() if f.name != "reviews.csv" and f.suffix == ".csv")
    assert job.raw_bytes(spark) == stored
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen == [["1000", str(max(least, -(-stored // 1_000)))]]
    assert settings(spark) == before


def test_parts_grow_with_the_input_and_settings_come_back(spark, monkeypatch):
    before = settings(spark)
    monkeypatch.setattr(task_sizes, "TASK_BYTES", 100_000)
    rows = spark.range(200_000).selectExpr("uuid() as k", "id")
    with pytest.raises(ZeroDivisionError), small_tasks(spark, 20_000_000):
        assert int(spark.conf.get(PARTS)) == 200
        # The session's own 4 parts could not be read in more tasks; AQE keeps tasks of 1 MB at least.
        counted = rows.groupBy("k").count().groupBy(F.spark_partition_id()).count()
        assert counted.count() > 4
        raise ZeroDivisionError
    assert settings(spark) == before


def test_what_the_session_sets_is_kept(spark):
    spark.conf.set(ADVISORY, "32m")
    try:
        with small_tasks(spark, 1 << 40):
            assert spark.conf.get(ADVISORY) == "32m"
            assert int(spark.conf.get(PARTS)) == task_sizes.MOST_PARTS
        assert spark.conf.get(ADVISORY) == "32m"
    finally:
        spark.conf.unset(ADVISORY)


def test_listed_bytes_of_nothing(spark, tmp_path):
    assert listed_bytes(spark, []) == 0
    assert listed_bytes(spark, [str(tmp_path)]) == 0
