"""Raw files to the first layer, stamped and counted in one job per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgemart import schemas as S
from lodgemart.sources.layers import Layer, require_distinct
from lodgemart.sources.readers import read_csv
from lodgemart.sources.together import side_by_side


@dataclass(frozen=True)
class TableSpec:
    file: str
    schema: T.StructType | None = None
    options: Mapping[str, str] | None = None


BOOKING_TABLES: dict[str, TableSpec] = {
    "hotels": TableSpec("hotels.csv", S.HOTELS),
    "rooms": TableSpec("rooms.csv", S.ROOMS),
    "customers": TableSpec("customers.csv", S.CUSTOMERS),
    "bookings": TableSpec("bookings.csv", S.BOOKINGS),
    "payments": TableSpec("payments.csv", S.PAYMENTS),
}


def stamp(
    df: DataFrame, run_ts: datetime | Column | None = None, name: str = "ingestion_date"
) -> DataFrame:
    """Add the load time; pass ``run_ts``, in UTC unless it has a zone, to replay a load."""
    if run_ts is None:
        run_ts = F.current_timestamp()
    elif isinstance(run_ts, datetime):
        run_ts = F.lit(run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc))
    return df.withColumn(name, run_ts)


# Values of these types are loaded from CSV as text; the cleaning rules parse and mark them.
PARSED_LATER = (T.DateType, T.TimestampType, T.DecimalType)


# The column of a table of rejects.
REJECTED = "rejected_record"


def write_counted(df: DataFrame, layer: Layer, name: str) -> int:
    """Write one table and return its row count, counted while writing.

    A separate count would read the input a second time.
    """
    seen = Observation()
    layer.write(df, name, seen, F.count(F.lit(1)).alias("rows"))
    return seen.get["rows"]


def content_checks(df: DataFrame) -> list[Column]:
    """Row count and two checksums of a frame's rows, whatever their order; repeated rows count.

    Columns that can't be compared, such as maps, are left out.
    """
    held = [F.col(f"`{f.name}`") for f in df.schema if S.comparable(f.dataType)]
    row, again = F.xxhash64(*held), F.xxhash64(F.lit(7), *reversed(held))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(row).alias("xor"),
        # Half of each hash, so that the sum can't overflow.
        F.sum(F.shiftright(again, 32)).alias("sum"),
    ]


@dataclass(frozen=True)
class Written:
    """What went into a table, and whether the table holds it."""

    rows: int
    matches: bool


def write_verified(df: DataFrame, layer: Layer, name: str) -> Written:
    """Write one table, read it back, and compare count and checksums with those observed while writing."""
    seen = Observation()
    layer.write(df, name, seen, *content_checks(df))
    sent = seen.get
    held = layer.read(name).select(*[F.col(f"`{c}`") for c in df.columns])
    found = held.agg(*content_checks(held)).first().asDict()
    # No row, no checksum.
    return Written(sent["rows"], all((sent[k] or 0) == (found[k] or 0) for k in found))


def write_marked(df: DataFrame, layer: Layer, name: str, marks: Sequence[str]) -> dict[str, int]:
    """Write one table and return how many rows carry each of the marks it has."""
    held = [m for m in marks if m in df.columns]
    if not held:
        layer.write(df, name)
        return {}
    seen = Observation()
    layer.write(df, name, seen, *[F.count_if(F.col(m)).alias(m) for m in held])
    return dict(seen.get)


def audit_frame(spark: SparkSession, counts: Mapping[str, int | Written]) -> DataFrame:
    """One row per table: its count and, where it was verified, whether the table holds what was sent."""
    rows = [(n, c.rows, c.matches) if isinstance(c, Written) else (n, c, None) for n, c in counts.items()]
    audit = spark.createDataFrame(rows, "table_name string, row_count bigint, content_matches boolean")
    return audit if any(isinstance(c, Written) for c in counts.values()) else audit.drop("content_matches")


def load_tables(
    frames: Mapping[str, DataFrame],
    layer: Layer,
    run_ts: datetime | None = None,
    parallel: int = 1,
    verify: bool = False,
) -> dict[str, int]:
    """Stamp and write each table; returns the rows per table.

    ``verify`` reads each table back and fails if it does not hold what was sent.
    """
    layer.prepare()

    def load(name: str, df: DataFrame) -> int:
        if not verify:
            return write_counted(df, layer, name)
        written = write_verified(df, layer, name)
        if not written.matches:
            raise ValueError(f"{name} does not hold the {written.rows} rows that were written")
        return written.rows

    loads = [partial(load, name, stamp(df, run_ts)) for name, df in frames.items()]
    return dict(zip(frames, side_by_side(loads, parallel)))


def ingest(
    spark: SparkSession,
    source: str | Layer,
    layer: Layer,
    specs: Mapping[str, TableSpec] = BOOKING_TABLES,
    run_ts: datetime | None = None,
    infer: bool = False,
    parallel: int = 1,
    rejects: bool = False,
    verify: bool = False,
) -> dict[str, int]:
    """Load every table of ``specs`` into ``layer``, one job per table.

    ``source`` is a folder of CSV files, or a layer that already holds raw tables of the
    same names. It must not be ``layer`` itself: a write replaces its target. Dates and
    amounts of a declared schema are loaded as text, so that what is malformed is still there
    for the rules to mark.

    With ``rejects`` every table of a declared schema gets a table ``<name>_rejects`` of the
    records that did not fit it, what could be read of them and the record as it stands in the
    file. Their rows are loaded all the same,
    with nulls for what did not parse. ``verify``: see ``load_tables``.
    """
    if not isinstance(source, str):
        require_distinct([source, layer])
        frames = {name: source.read(name) for name in specs}
        return load_tables(frames, layer, run_ts, parallel, verify)
    files = {name: f"{source.rstrip('/')}/{spec.file}" for name, spec in specs.items()}
    require_distinct([layer], files.values())
    marked = {name: REJECTED if rejects and spec.schema and not infer else None for name, spec in specs.items()}
    frames = {
        name: read_csv(
            spark, files[name], None if infer else spec.schema, infer, PARSED_LATER, spec.options, marked[name]
        )
        for name, spec in specs.items()
    }
    counts = load_tables({n: f.drop(REJECTED) if marked[n] else f for n, f in frames.items()}, layer, run_ts, parallel, verify)
    kept = {f"{n}_rejects": f.filter(F.col(REJECTED).isNotNull()) for n, f in frames.items() if marked[n]}
    return counts | load_tables(kept, layer, run_ts, parallel, verify)
