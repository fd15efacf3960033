from datetime import date, datetime, timedelta
from random import Random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from lodgemart.operators import intervals as I
from lodgemart.operators.intervals import Rung, choose_rungs, overlaps
from lodgemart.plans.kpi import overbooking_alerts

DAY0 = date(2024, 1, 1)
DATES = "room string, id string, lo date, hi date"
TIMES = "room string, id string, lo timestamp_ntz, hi timestamp_ntz"


def day(n):
    return None if n is None else DAY0 + timedelta(days=n)


def brute(stays, null_bounds="drop"):
    """Every pair of rows, compared one by one."""
    def known(pick, a, b):
        values = [v for v in (a, b) if v is not None]
        return pick(values) if values else None

    found = []
    for i, (room_a, id_a, lo_a, hi_a) in enumerate(stays):
        for room_b, id_b, lo_b, hi_b in stays[i + 1 :]:
            if room_a is None or room_a != room_b or None in (id_a, id_b) or id_a == id_b:
                continue
            if null_bounds == "drop" and None in (lo_a, hi_a, lo_b, hi_b):
                continue
            start, end = known(max, lo_a, lo_b), known(min, hi_a, hi_b)
            if start is not None and end is not None and start < end:
                found.append((room_a, min(id_a, id_b), max(id_a, id_b), start, end))
    return sorted(found)


def spark_pairs(spark, stays, schema=DATES, **options):
    return rows(overlaps(spark.createDataFrame(stays, schema), "room", "id", "lo", "hi", **options))


FIXTURE = [
    ("r1", "touch1", day(0), day(2)),
    ("r1", "touch2", day(2), day(4)),
    ("r1", "long", day(-30), day(40)),
    ("r1", "nested", day(1), day(3)),
    ("r1", "zero", day(1), day(1)),
    ("r1", "inverted", day(3), day(0)),
    ("r2", "same1", day(0), day(5)),
    ("r2", "same2", day(0), day(5)),
    ("r2", "repeat", day(1), day(2)),
    ("r2", "repeat", day(1), day(2)),
    ("r2", "repeat", day(1), day(9)),
    ("r3", "forever", day(0), date(9999, 12, 31)),
    ("r3", "late", date(8000, 1, 1), date(8000, 1, 2)),
    (None, "noroom1", day(0), day(5)),
    (None, "noroom2", day(0), day(5)),
    ("r2", None, day(0), day(5)),
]

LOOSE = [
    ("r1", "none", None, None),
    ("r1", "none2", None, None),
    ("r1", "nolo", None, day(2)),
    ("r1", "nohi", day(1), None),
    ("r1", "none", None, None),
    ("r1", "nohi2", day(0), None),
    ("r2", "nolo2", None, day(1)),
]


@pytest.mark.parametrize("bucket_days", [1, 8, 16, 1000])
def test_fixture(spark, bucket_days):
    got = spark_pairs(spark, FIXTURE, bucket_days=bucket_days)
    assert got == brute(FIXTURE)
    assert ("r1", "touch1", "touch2") not in {p[:3] for p in got}


@pytest.mark.parametrize("bucket_days", [1, 16])
def test_missing_bounds(spark, bucket_days):
    stays = FIXTURE + LOOSE
    assert spark_pairs(spark, stays, bucket_days=bucket_days) == brute(FIXTURE)
    opened = spark_pairs(spark, stays, bucket_days=bucket_days, null_bounds="open")
    assert opened == brute(stays, "open")
    assert len(opened) > len(brute(FIXTURE))


def test_unknown_null_bounds(spark):
    with pytest.raises(ValueError, match="null_bounds"):
        spark_pairs(spark, FIXTURE, null_bounds="keep")


def _random_dates(seed, n):
    rng = Random(seed)
    for i in range(n):
        lo = rng.randrange(200)
        yield (f"r{max(0, rng.randrange(-6, 4))}", f"b{i % (n - 3):03}", day(lo), day(lo + rng.choice([0, 1, 2, 7, 30, 300])))


@pytest.mark.parametrize("bucket_days", [1, 16])
def test_random_stays_with_one_crowded_room(spark, bucket_days):
    stays = list(_random_dates(7, 250))
    assert spark_pairs(spark, stays, bucket_days=bucket_days) == brute(stays)


@pytest.mark.parametrize("schema", [TIMES, TIMES.replace("timestamp_ntz", "timestamp")])
@pytest.mark.parametrize("bucket_days", [1 / 24, 16])
def test_random_times(spark, schema, bucket_days):
    rng = Random(3)
    stays = []
    for i in range(150):
        lo = datetime(1969, 12, 30) + timedelta(seconds=rng.randrange(400_000), microseconds=rng.choice([0, 1, 999_999]))
        length = rng.choice([0, 0.000001, 1, 59, 3600, 86_400, 900_000])
        stays.append((f"r{rng.randrange(2)}", f"b{i:03}", lo, lo + timedelta(seconds=length)))
    assert spark_pairs(spark, stays, schema, bucket_days=bucket_days) == brute(stays)


def test_a_third_of_the_rows_are_copies(spark):
    stays = [("r", "copy", day(0), day(3))] * 60 + [("r", f"b{i}", day(i), day(i + 2)) for i in range(8)]
    assert spark_pairs(spark, stays) == brute(stays)


stay = st.tuples(
    st.sampled_from(["r1", "r2"]), st.sampled_from("abcdefgh"), st.integers(0, 40), st.integers(0, 40)
).map(lambda s: (s[0], s[1], day(s[2]), day(s[3])))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(stays=st.lists(stay, min_size=1, max_size=30))
def test_any_width_gives_the_same_pairs(spark, stays):
    assert spark_pairs(spark, stays, bucket_days=1) == spark_pairs(spark, stays) == brute(stays)


def test_alerts_may_leave_out_a_status(spark):
    df = spark.createDataFrame(
        [("b1", "r", day(0), day(3), "confirmed"), ("b2", "r", day(1), day(4), "cancelled"),
         ("b3", "r", day(2), day(5), None)],
        "booking_id string, room_id string, checkin_date date, checkout_date date, status string",
    )
    ids = ("booking_id_1", "booking_id_2")
    assert rows(overbooking_alerts(df), *ids) == [("b1", "b2"), ("b1", "b3"), ("b2", "b3")]
    assert rows(overbooking_alerts(df, exclude_status=["cancelled"]), *ids) == [("b1", "b3")]
    assert overbooking_alerts(df).columns == ["room_id", *ids, "overlap_start", "overlap_end"]


def _reads_and_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan"), plan


def test_two_reads_and_no_limit(spark, tmp_path):
    path = str(tmp_path / "stays")
    spark.createDataFrame(FIXTURE, DATES).write.parquet(path)
    df = overlaps(spark.read.parquet(path), "room", "id", "lo", "hi")
    reads, plan = _reads_and_plan(df)
    assert reads == 2 and "Limit" not in plan and "Subquery" not in plan


def test_many_crowded_rooms_are_shared_out(spark):
    """More crowded rooms than any list would hold: no task has much more than its share."""
    from pyspark.sql import functions as F

    stays = spark.range(0, 60_000, 1, 8).selectExpr(
        "concat('r', id % 600) as room", "id", "date_add(date'2024-01-01', cast((id * 7919) % 400 as int)) as lo"
    )
    stays = stays.withColumn("hi", F.date_add("lo", 2))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = overlaps(stays, "room", "id", "lo", "hi")
        sizes = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def _counted(durations):
    held = {}
    for d in durations:
        n, units = held.get(d.bit_length() - 1, (0, 0))
        held[d.bit_length() - 1] = n + 1, units + d
    return [(p, n, units) for p, (n, units) in held.items()]


def _spent(rungs, durations):
    """Rows and candidates of a choice of rungs, where every unit has as many starts."""
    width = [next(r.width for r in rungs if d <= r.longest) for d in durations]
    rows = len(durations) * len(rungs) + sum(1 + (d - 1) / w for d, w in zip(durations, width))
    return rows, sum(d + w for d, w in zip(durations, width)) / sum(durations)


def test_rungs_follow_the_durations():
    nights = list(range(1, 31)) * 100
    rungs = choose_rungs(_counted(nights), len(nights))
    rows, candidates = _spent(rungs, nights)
    assert len(rungs) == 1 and rows < 5 * len(nights) and candidates < 2
    assert choose_rungs([], 0) == [Rung(1, 1)]
    assert choose_rungs([(0, 5, 5)], 5, narrowest=16)[0].width == 16


def test_short_and_long_stays_get_rungs_of_their_own():
    """Hours and years together: neither compared with too much nor cut into too many cells."""
    durations = [3_600] * 5_000 + [86_400 * d for d in range(1, 20)] * 200 + [86_400 * 365 * 20] * 40
    rungs = choose_rungs(_counted(durations), len(durations))
    rows, candidates = _spent(rungs, durations)
    assert 1 < len(rungs) < 6 and rows < 12 * len(durations) and candidates < 2
    assert sorted(rungs, key=lambda r: r.longest) == rungs == sorted(rungs, key=lambda r: r.width)


def test_no_choice_of_one_width_is_cheaper():
    rng = Random(5)
    for _ in range(20):
        durations = [1 + int(rng.paretovariate(0.6)) % 100_000 for _ in range(300)]
        rungs = choose_rungs(_counted(durations), 300)

        def cost(chosen):
            rows, candidates = _spent(chosen, durations)
            return rows + 2.0 * 300 * (candidates - 1)

        assert all(cost(rungs) <= cost([Rung(1 << k, 10**9)]) + 1e-6 for k in range(18))


def test_candidates_stay_near_the_pairs(spark, monkeypatch):
    """Join rows before the overlap test, counted on stays of very different lengths."""
    from pyspark.sql import functions as F

    rng = Random(11)
    stays = []
    for i in range(4_000):
        lo = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(200 * 24 * 60))
        length = rng.choice([timedelta(hours=1), timedelta(hours=20), timedelta(days=6), timedelta(days=90)])
        stays.append((f"r{i % 5}", i, lo, lo + length))
    df = spark.createDataFrame(stays, "room string, id long, lo timestamp_ntz, hi timestamp_ntz")
    met, count = [], I._start_inside
    pairs = overlaps(df, "room", "id", "lo", "hi").count()
    monkeypatch.setattr(I, "_start_inside", lambda: met.append(count()) or F.lit(True))
    candidates = overlaps(df, "room", "id", "lo", "hi").count()
    a, b = df.alias("a"), df.alias("b")
    plain = a.join(b, F.expr("a.room = b.room and a.id < b.id and a.lo < b.hi and b.lo < a.hi"))
    assert met and pairs == plain.count()
    assert candidates < 2 * pairs + len(stays)  # every stay meets its own start
