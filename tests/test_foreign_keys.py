import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodgemart.operators import foreign_keys as K
from lodgemart.operators.foreign_keys import ForeignKey, check_keys, in_order

KEYS = (
    ForeignKey("bookings", "hotel", "hotels", "hotel", "no_hotel"),
    ForeignKey("bookings", "room", "rooms", "room", "no_room"),
    ForeignKey("rooms", "hotel", "hotels", "hotel", "no_hotel", null_passes=True),
    ForeignKey("payments", "booking", "bookings", "booking", "no_booking"),
)


def brute(tables, closed):
    """Marks and losses by looking every row's parents up, one by one."""
    lost = {"hotels": [h in closed for h, in tables["hotels"]]}
    good = {h for (h,), gone in zip(tables["hotels"], lost["hotels"]) if not gone}
    there = {h for h, in tables["hotels"]}
    out = {"rooms": [], "bookings": [], "payments": []}
    for room, hotel in tables["rooms"]:
        absent = hotel is not None and hotel not in there
        out["rooms"].append((room, hotel, absent, hotel is not None and hotel not in good))
    good_rooms = {r for r, _, _, gone in out["rooms"] if not gone and r is not None}
    rooms = {r for r, _ in tables["rooms"] if r is not None}
    for booking, hotel, room in tables["bookings"]:
        marks = hotel is None or hotel not in there, room is None or room not in rooms
        gone = hotel is None or hotel not in good or room is None or room not in good_rooms
        out["bookings"].append((booking, hotel, room, *marks, gone))
    held = {b[0] for b in out["bookings"] if not b[-1] and b[0] is not None}
    known = {b[0] for b in tables["bookings"] if b[0] is not None}
    for payment, booking in tables["payments"]:
        out["payments"].append((payment, booking, booking is None or booking not in known, booking is None or booking not in held))
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(2)
    some = lambda n: rng.choice([None, *range(n)])
    return {
        "hotels": [(h,) for h in range(8)] + [(3,), (None,)],
        "rooms": [(some(25), some(10)) for _ in range(40)],
        "bookings": [(some(200), rng.choice([1, some(10)]), some(25)) for _ in range(300)],
        "payments": [(p, rng.choice([7, some(220)])) for p in range(600)],
    }


def frames(spark, tables):
    columns = {"hotels": "hotel", "rooms": "room hotel", "bookings": "booking hotel room", "payments": "payment booking"}
    return {
        name: spark.createDataFrame(rows_, ", ".join(f"{c} long" for c in columns[name].split())).repartition(3)
        for name, rows_ in tables.items()
    }


@pytest.mark.parametrize("few", [True, False])
def test_marks_and_losses_equal_brute_force(spark, monkeypatch, tables, few):
    if not few:
        monkeypatch.setattr(K, "BROADCAST_KEYS", 0)
    found = check_keys(frames(spark, tables), KEYS, {"hotels": F.col("hotel") == 5})
    expected = brute(tables, {5})
    order = {
        "rooms": ["room", "hotel", "no_hotel", "dq_cascade"],
        "bookings": ["booking", "hotel", "room", "no_hotel", "no_room", "dq_cascade"],
        "payments": ["payment", "booking", "no_booking", "dq_cascade"],
    }
    for name, columns in order.items():
        key = lambda r: [(v is not None, v) for v in r]
        assert rows(found[name], *columns) == sorted(expected[name], key=key), name
    assert found["hotels"].columns == ["hotel"]


def test_children_are_not_shuffled_for_few_failed_keys(spark, tables):
    found = check_keys(frames(spark, tables), KEYS)["payments"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_order_and_circles():
    order = in_order(KEYS)
    assert order.index("hotels") < order.index("rooms") < order.index("bookings") < order.index("payments")
    with pytest.raises(ValueError, match="circle"):
        in_order([*KEYS, ForeignKey("hotels", "best", "rooms", "room", "m")])


def test_empty_tables(spark, tables):
    empty = {name: df.limit(0) for name, df in frames(spark, tables).items()}
    assert [df.count() for df in check_keys(empty, KEYS).values()] == [0, 0, 0, 0]
    childless = frames(spark, tables) | {"hotels": empty["hotels"]}
    found = check_keys(childless, KEYS)["bookings"]
    assert found.where("no_hotel and dq_cascade").count() == 300
