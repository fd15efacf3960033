"""Overlap self-join of half-open intervals ``[lo, hi)`` within a key.

Two intervals overlap exactly when the later start lies inside the other interval. So
one side of the join is the starts and the other side is the intervals, one row per time
cell they touch. A pair can only meet in the cell of that later start, hence once, and no
distinct is needed.

Cells come in rungs of different widths. An interval uses the rung for its duration, a start is
sent to every rung in use, so rungs are laid out where durations call for them: a first look
counts durations by their powers of two, a few dozen rows, and the rungs with the fewest rows
and candidates together are chosen from these counts. Wide cells bring candidates that don't
overlap, narrow ones more rows for an interval, each rung one more row for every start. What
has no bound goes to one cell for all time, if there is any. A cell that is still large is
split by adaptive execution, both sides of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgemart.schemas import column_type

#: What a candidate weighs against a shuffled row, were there as many pairs as intervals.
CANDIDATE_WEIGHT = 2.0


OWN = ("_id", "_lo", "_hi")


@dataclass(frozen=True)
class Rung:
    """Cells of one width, in units, for intervals of at most ``longest`` units."""

    width: int
    longest: int


def choose_rungs(counts: Sequence[tuple[int, int, int]], starts: int, narrowest: int = 1) -> list[Rung]:
    """The cheapest rungs for intervals counted as (power, intervals, sum of their units).

    ``power`` p holds the durations from 2**p to 2**(p + 1) - 1. Cost: a row for every start and
    rung, a row for every cell of an interval, and the candidates that cells bring: intervals
    of d units on cells of w units meet the starts of d + w units.
    """
    counts = sorted(counts)
    total = sum(units for _, _, units in counts)
    weight = CANDIDATE_WEIGHT * max(starts, 1) / max(total, 1)
    ladder = [narrowest << k for k in range(max((p for p, _, _ in counts), default=0) + 2)]
    # best[k]: the cost of the k shortest powers, and their rungs.
    best: list[tuple[float, list[Rung]]] = [(0.0, [])]
    for k in range(1, len(counts) + 1):
        options = []
        for first in range(k):
            n = sum(c for _, c, _ in counts[first:k])
            units = sum(u for _, _, u in counts[first:k])
            cost, width = min((n + (units - n) / w + weight * w * n, w) for w in ladder)
            options.append((best[first][0] + starts + cost, best[first][1], width))
        cost, before, width = min(options, key=lambda x: x[0])
        best.append((cost, [*before, Rung(width, (1 << (counts[k - 1][0] + 1)) - 1)]))
    return best[-1][1] or [Rung(narrowest, 1)]


@dataclass(frozen=True)
class _Clock:
    """Positions in time as whole units: days for dates, seconds for timestamps."""

    kind: T.DataType

    def units(self, days: float) -> int:
        return max(1, round(days * (1 if isinstance(self.kind, T.DateType) else 86_400)))

    def unit(self, moment: Column) -> Column:
        if isinstance(self.kind, T.DateType):
            return F.unix_date(moment).cast("bigint")
        if isinstance(self.kind, T.TimestampType):
            return F.unix_seconds(moment)
        # From the first moment there is, so that cutting to seconds rounds down.
        since = moment - F.lit("0001-01-01").cast("timestamp_ntz")
        return since.cast("interval second").cast("bigint")

    def last_unit(self, hi: Column) -> Column:
        """The last unit an interval touches; ``hi`` itself is outside."""
        if isinstance(self.kind, T.DateType):
            return self.unit(hi) - 1
        return self.unit(hi - F.expr("INTERVAL '0.000001' SECOND"))


def _cell(unit: Column, rung: Rung) -> Column:
    return F.floor(unit / rung.width)


def _covers(stays: DataFrame, rungs: Sequence[Rung], unbounded: bool) -> DataFrame:
    """One row for each cell that an interval touches on its rung."""
    units, none = F.col("_last") - F.col("_first"), F.lit(0).cast("bigint")
    rung, lowest, highest = (F.when(F.lit(False), x) for x in (F.lit(0), none, none))
    for k, r in enumerate(rungs):
        own = units < r.longest if k + 1 < len(rungs) else units.isNotNull()
        rung = rung.when(own, k)
        lowest = lowest.when(own, _cell(F.col("_first"), r))
        highest = highest.when(own, _cell(F.col("_last"), r))
    if unbounded:
        rung, lowest, highest = rung.otherwise(len(rungs)), lowest.otherwise(none), highest.otherwise(none)
    names = [F.col(c).alias(f"{c}_a") for c in OWN]
    return stays.select("_key", *names, rung.alias("_rung"), F.explode(F.sequence(lowest, highest)).alias("_cell"))


def _starts(stays: DataFrame, rungs: Sequence[Rung], unbounded: bool) -> DataFrame:
    """One row for each rung in use, with the cell that an interval starts in."""
    cells = [_cell(F.col("_first"), r) for r in rungs] + [F.lit(0).cast("bigint")] * unbounded
    names = [F.col(c).alias(f"{c}_b") for c in OWN]
    begun = stays.filter(F.col("_lo").isNotNull())
    if len(cells) == 1:
        return begun.select("_key", *names, F.lit(0).alias("_rung"), cells[0].alias("_cell"))
    return begun.select("_key", *names, F.posexplode(F.array(*cells)).alias("_rung", "_cell"))


def _durations(stays: DataFrame) -> tuple[list[tuple[int, int, int]], int, bool]:
    """Intervals by the power of two of their units, the number of starts, whether any has no bound."""
    units = F.col("_last") - F.col("_first") + 1
    power = F.floor(F.log2(units))
    rows = stays.groupBy(power.alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(units).alias("units"), F.count("_lo").alias("starts")
    )
    found = rows.collect()  # one row for each power
    counts = [(r["p"], r["n"], r["units"]) for r in found if r["p"] is not None]
    return counts, sum(r["starts"] for r in found), any(r["p"] is None for r in found)


def _start_inside() -> Column:
    """The b side starts inside the a side; on equal starts the lower id is a."""
    earlier = F.col("_lo_a").isNull() | (F.col("_lo_a") < F.col("_lo_b"))
    tied = (F.col("_lo_a") == F.col("_lo_b")) & (F.col("_id_a") < F.col("_id_b"))
    inside = F.col("_hi_a").isNull() | (F.col("_lo_b") < F.col("_hi_a"))
    bounded = F.col("_hi_a").isNotNull() | F.col("_hi_b").isNotNull()
    return inside & bounded & (F.col("_id_a") != F.col("_id_b")) & (earlier | F.coalesce(tied, F.lit(False)))


def overlaps(
    df: DataFrame,
    key: str,
    id: str,
    lo: str,
    hi: str,
    bucket_days: float | None = None,
    null_bounds: str = "drop",
) -> DataFrame:
    """All pairs of rows with one key, different ids and overlapping intervals.

    Result: ``key, <id>_1, <id>_2, overlap_start, overlap_end`` with ``<id>_1 < <id>_2``.
    Touching and zero-length intervals do not overlap. ``lo`` and ``hi`` are dates or
    timestamps.

    ``null_bounds="drop"`` leaves out rows without both bounds; ``"open"`` takes a
    missing bound as unlimited, and a pair counts if the overlap itself has two bounds.

    ``bucket_days`` is the narrowest cell width, by default a unit: a day for dates, a second for
    timestamps. The lengths of the intervals are counted when this is called, as they choose
    the cells.
    """
    if null_bounds not in ("drop", "open"):
        raise ValueError(f"null_bounds is 'drop' or 'open', not {null_bounds!r}")
    clock = _Clock(column_type(df, lo))
    stays = df.select(
        F.col(key).alias("_key"),
        F.col(id).alias("_id"),
        F.col(lo).alias("_lo"),
        F.col(hi).alias("_hi"),
    ).filter(F.col("_key").isNotNull() & F.col("_id").isNotNull())
    ordered = F.col("_lo") < F.col("_hi")
    if null_bounds == "open":
        ordered = ordered | F.col("_lo").isNull() | F.col("_hi").isNull()
    stays = stays.filter(ordered)
    stays = stays.withColumns({"_first": clock.unit(F.col("_lo")), "_last": clock.last_unit(F.col("_hi"))})
    counts, n_starts, unbounded = _durations(stays)
    rungs = choose_rungs(counts, n_starts, clock.units(bucket_days) if bucket_days else 1)
    covers, starts = _covers(stays, rungs, unbounded), _starts(stays, rungs, unbounded)
    # The pairs may far outnumber the rows: shuffled, they are made by all tasks.
    met = covers.hint("merge").join(starts, ["_key", "_rung", "_cell"]).filter(_start_inside())
    return met.select(
        F.col("_key").alias(key),
        F.least("_id_a", "_id_b").alias(f"{id}_1"),
        F.greatest("_id_a", "_id_b").alias(f"{id}_2"),
        F.greatest("_lo_a", "_lo_b").alias("overlap_start"),
        F.least("_hi_a", "_hi_b").alias("overlap_end"),
    )
