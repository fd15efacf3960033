"""Raw files to report, stage by stage in one Spark application.

Each stage reads the tables the stage before has written. The written tables cut the
lineage: a lost executor repeats tasks of one stage, never the whole chain. Nothing is
cached; every job reads only the columns it needs.

A run may keep a ledger of the tables it has committed. ``run_all(resume=True)`` then redoes
only what is missing, what a failed run left undone, and what depends on something that has
changed since: raw files, options, the lexicon or a table of the stage before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields
from datetime import datetime
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgemart.operators.foreign_keys import ForeignKey, check_keys
from lodgemart.plans import cleaning, kpi
from lodgemart.plans.sentiment import enrich_sentiment, score_reviews
from lodgemart.plans.top_lists import write_report
from lodgemart.schemas import VALID_CURRENCIES, Names
from lodgemart.sources.ingest import BOOKING_TABLES, TableSpec, ingest, write_marked
from lodgemart.sources.layers import Layer, input_places, require_distinct
from lodgemart.sources.ledger import Ledger, NoLedger
from lodgemart.sources.readers import read_csv
from lodgemart.sources.staging import listed_version
from lodgemart.sources.task_sizes import listed_bytes, small_tasks
from lodgemart.sources.together import side_by_side

BOOKING_MARKS = (*cleaning.BAD_DATES, cleaning.BAD_TOTAL, "dq_swapped_dates", "dq_negative_total", "dq_invalid_currency")
PAYMENT_MARKS = (cleaning.BAD_AMOUNT, "dq_orphan_payment", "dq_over_amount", "dq_invalid_currency")


KEY_MARKS = ("dq_orphan_customer", "dq_orphan_hotel", "dq_orphan_room", "dq_cascade")


def booking_keys(names: Names) -> tuple[ForeignKey, ...]:
    """The foreign keys that the booking system declares, but for payments, which are always checked."""
    b, r = names.bookings, names.rooms
    return (
        ForeignKey("rooms", r.hotel, "hotels", names.hotels.hotel, "dq_orphan_hotel"),
        ForeignKey("bookings", b.customer, "customers", names.customers.customer, "dq_orphan_customer"),
        ForeignKey("bookings", b.hotel, "hotels", names.hotels.hotel, "dq_orphan_hotel"),
        ForeignKey("bookings", b.room, "rooms", r.room, "dq_orphan_room"),
    )


@dataclass(frozen=True)
class Job:
    """Where the data lies, how it is named, and the choices its operators offer.

    ``source`` is a folder of CSV files or a layer of raw tables. ``reviews`` names the
    reviews in it, a file or a table; None leaves the sentiment stage out. ``review_options`` are
    the CSV reader's for that file, whose texts may hold line breaks. ``rejects`` and ``verify``: see ``ingest``. ``parallel``
    tables of a stage are written at the same time.

    ``infer`` infers CSV types instead of taking the declared ones. ``bad_date_flags``,
    ``bad_total_flag`` and ``bad_amount_flag`` name the marks of malformed values, None for
    no mark. ``status_in`` narrows the payments that count, ``exclude_status`` the bookings
    that raise alerts, ``confirmed_only`` the customer figures. ``null_bounds``,
    ``bucket_days``: see ``overlaps``; ``splits``: see ``left_lookup``.

    ``foreign_keys`` checks bookings and rooms against the tables they refer to: "mark" adds the
    marks of ``booking_keys`` to the silver tables, "drop" also keeps lost bookings, those of a
    dropped hotel for instance, out of the key figures; "off" does neither.

    ``ledger`` is a folder for the entries of committed tables, outside the layers; without one
    no run can be resumed.
    """

    source: str | Layer
    bronze: Layer
    silver: Layer
    gold: Layer
    report: Layer
    names: Names = Names()
    specs: Mapping[str, TableSpec] = field(default_factory=lambda: BOOKING_TABLES)
    reviews: str | None = "reviews.csv"
    review_options: tuple[tuple[str, str], ...] = (("multiLine", "true"),)
    rejects: bool = False
    verify: bool = False
    strict: bool = False
    parallel: int = 4
    infer: bool = False
    currencies: Sequence[str] = VALID_CURRENCIES
    bad_date_flags: tuple[str | None, str | None] = cleaning.BAD_DATES
    bad_total_flag: str | None = cleaning.BAD_TOTAL
    bad_amount_flag: str | None = cleaning.BAD_AMOUNT
    status_in: Sequence[str] | None = None
    exclude_status: Sequence[str] = ()
    confirmed_only: bool = False
    null_bounds: str = "drop"
    bucket_days: float | None = None
    splits: int = 1
    foreign_keys: str = "off"
    ledger: str | None = None

    def __post_init__(self) -> None:
        if self.foreign_keys not in ("off", "mark", "drop"):
            raise ValueError(f"foreign_keys is 'off', 'mark' or 'drop', not {self.foreign_keys!r}")
        layers = [self.bronze, self.silver, self.gold, self.report]
        if not isinstance(self.source, str):
            require_distinct([self.source, *layers])
            return
        files = [spec.file for spec in self.specs.values()] + ([self.reviews] if self.reviews else [])
        require_distinct(layers, [f"{self.source.rstrip('/')}/{f}" for f in files])


    def options(self) -> str:
        """All choices that shape results."""
        places = ("source", "bronze", "silver", "gold", "report", "parallel", "ledger")
        return repr([(f.name, getattr(self, f.name)) for f in fields(self) if f.name not in places])

    def raw_version(self, spark: SparkSession, name: str) -> str | None:
        """An identity of a raw file or table."""
        if isinstance(self.source, str):
            return listed_version(spark, [f"{self.source.rstrip('/')}/{name}"])
        return self.source.version(name)

    def raw_bytes(self, spark: SparkSession) -> int:
        """The stored size of the raw files or tables."""
        if isinstance(self.source, str):
            return listed_bytes(spark, [f"{self.source.rstrip('/')}/{spec.file}" for spec in self.specs.values()])
        return listed_bytes(spark, sorted({p for name in self.specs for p in input_places(self.source.read(name))}))


Steps = Ledger | NoLedger


def run_bronze(
    spark: SparkSession, job: Job, run_ts: datetime | None = None, steps: Steps = NoLedger()
) -> dict[str, int]:
    job.bronze.prepare()

    def load(name: str, spec: TableSpec) -> dict[str, int]:
        raw = name if not isinstance(job.source, str) else spec.file
        inputs = () if isinstance(steps, NoLedger) else (job.options(), repr(run_ts), job.raw_version(spark, raw))
        one = partial(ingest, spark, job.source, job.bronze, {name: spec}, run_ts, job.infer, 1, job.rejects, job.verify)
        return steps.step("bronze", name, inputs, partial(job.bronze.version, name), one)

    loads = [partial(load, name, spec) for name, spec in job.specs.items()]
    found = side_by_side(loads, job.parallel)
    return {table: rows for counts in found for table, rows in counts.items()}


def _inputs(job: Job, steps: Steps, *tables: tuple[Layer, str]) -> list[str | None]:
    """Options and versions of the tables that a step reads; without a ledger nobody asks."""
    return [] if isinstance(steps, NoLedger) else [job.options(), *(layer.version(name) for layer, name in tables)]


def run_silver(job: Job, steps: Steps = NoLedger()) -> dict[str, dict[str, int]]:
    """Clean all tables; returns the number of rows per mark of bookings and payments.

    Payments come last: they are checked against the written bookings.
    """
    bronze, out, names, strict = job.bronze, job.silver, job.names, job.strict
    out.prepare()
    own = tuple(f for f in (*job.bad_date_flags, job.bad_total_flag, job.bad_amount_flag) if f)

    rules = {"customers": cleaning.clean_customers, "rooms": cleaning.clean_rooms, "hotels": cleaning.clean_hotels}

    @lru_cache(maxsize=1)
    def clean() -> dict[str, DataFrame]:
        """The clean tables but payments; made by the first step that needs one."""
        found = {n: rule(bronze.read(n), getattr(names, n), strict) for n, rule in rules.items()}
        found["bookings"] = cleaning.clean_bookings(
            bronze.read("bookings"), names.bookings, strict, job.currencies, job.bad_date_flags, job.bad_total_flag
        )
        return found if job.foreign_keys == "off" else check_keys(found, booking_keys(names))

    def bookings() -> dict[str, int]:
        marks = tuple(dict.fromkeys((*own, *BOOKING_MARKS, *KEY_MARKS)))
        return write_marked(clean()["bookings"], out, "bookings", marks)

    def payments() -> dict[str, int]:
        clean = cleaning.clean_payments(
            bronze.read("payments"), out.read("bookings"), names.payments, strict, job.currencies, job.splits,
            names.bookings, job.bad_amount_flag,
        )
        return write_marked(clean, out, "payments", tuple(dict.fromkeys((*own, *PAYMENT_MARKS))))

    def plain(name: str) -> None:
        out.write(clean()[name], name)

    def step(name: str, write: Callable, *more: tuple[Layer, str]):
        inputs = _inputs(job, steps, (bronze, name), *more)
        return steps.step("silver", name, inputs, partial(out.version, name), write)

    parents = [] if job.foreign_keys == "off" else [(bronze, n) for n in rules]
    if parents:
        clean()  # once, before several steps ask for it
    writes = [partial(step, name, partial(plain, name), *parents) for name in rules]
    found = side_by_side([partial(step, "bookings", bookings, *parents), *writes], job.parallel)
    return {"bookings": found[0], "payments": step("payments", payments, (out, "bookings"))}


def run_gold(job: Job, steps: Steps = NoLedger()) -> None:
    silver, gold, names = job.silver, job.gold, job.names
    cols = names.bookings

    def booked() -> DataFrame:
        found = silver.read("bookings")
        return found.where("not dq_cascade") if job.foreign_keys == "drop" else found

    def rate() -> DataFrame:
        return kpi.collection_rate(booked(), silver.read("payments"), cols, job.status_in, names.payments)

    bookings, payments = (silver, "bookings"), (silver, "payments")
    figures: dict[str, tuple[Callable[[], DataFrame], tuple]] = {
        "overbooking_alerts": (
            lambda: kpi.overbooking_alerts(booked(), cols, job.exclude_status, job.bucket_days, job.null_bounds),
            (bookings,),
        ),
        "collection_rate": (rate, (bookings, payments)),
        "customer_value": (lambda: kpi.customer_value(booked(), cols, job.confirmed_only), (bookings,)),
        "daily_revenue": (lambda: kpi.daily_revenue(booked(), cols), (bookings,)),
        "cancellation_rate_by_source": (lambda: kpi.cancellation_rate(booked(), cols), (bookings,)),
    }

    def step(name: str) -> None:
        figure, read = figures[name]
        write = lambda: gold.write(figure(), name)
        steps.step("gold", name, _inputs(job, steps, *read), partial(gold.version, name), write)

    gold.prepare()
    side_by_side([partial(step, name) for name in figures], job.parallel)


def _lexicon_version(lexicon: Mapping[str, float] | DataFrame) -> str:
    """An identity of a lexicon's entries, in whatever order they come."""
    if not isinstance(lexicon, DataFrame):
        return repr(sorted(lexicon.items()))
    rows = F.xxhash64(*lexicon.columns), F.xxhash64(F.lit(1), *lexicon.columns)
    found = lexicon.agg(F.count(F.lit(1)), *[F.sum(F.shiftright(r, 24)) for r in rows], *[F.bit_xor(r) for r in rows]).first()
    return repr((lexicon.dtypes, tuple(found)))


def run_sentiment(
    spark: SparkSession, job: Job, lexicon: Mapping[str, float] | DataFrame, steps: Steps = NoLedger()
) -> None:
    """Score the reviews and enrich the customers from the scores just written."""
    gold, names = job.gold, job.names
    gold.prepare()
    recorded = not isinstance(steps, NoLedger)

    def scores() -> None:
        if isinstance(job.source, str):
            reviews = read_csv(spark, f"{job.source.rstrip('/')}/{job.reviews}", options=dict(job.review_options))
        else:
            reviews = job.source.read(job.reviews)
        gold.write(score_reviews(reviews, lexicon, names.reviews), "reviews_sentiment")

    def enriched() -> None:
        gold.write(
            enrich_sentiment(
                gold.read("customer_value"), gold.read("reviews_sentiment"), names.reviews, names.bookings
            ),
            "customer_value_enriched",
        )

    inputs = [job.options(), job.raw_version(spark, job.reviews), _lexicon_version(lexicon)] if recorded else []
    steps.step("sentiment", "reviews_sentiment", inputs, partial(gold.version, "reviews_sentiment"), scores)
    inputs = _inputs(job, steps, (gold, "customer_value"), (gold, "reviews_sentiment"))
    steps.step("sentiment", "customer_value_enriched", inputs, partial(gold.version, "customer_value_enriched"), enriched)


def run_all(
    spark: SparkSession,
    job: Job,
    lexicon: Mapping[str, float] | DataFrame,
    run_ts: datetime | None = None,
    resume: bool = False,
) -> tuple[dict[str, int], dict[str, str]]:
    """All stages in order; returns the loaded rows per table and the skipped sections.

    Dates and times mean UTC while it runs, and shuffles are read in small tasks; the session's own
    settings are put back afterwards.
    ``resume`` goes on from what the job's ledger has as committed and unchanged.
    """
    if resume and not job.ledger:
        raise ValueError("a job without a ledger can't be resumed")
    steps = Ledger(spark, job.ledger, resume) if job.ledger else NoLedger()
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        with small_tasks(spark, job.raw_bytes(spark)):
            counts = run_bronze(spark, job, run_ts, steps)
            run_silver(job, steps)
            run_gold(job, steps)
            if job.reviews:
                run_sentiment(spark, job, lexicon, steps)
            around = None
            if job.ledger:
                def around(section: str, table: str, write: Callable[[], None]) -> None:
                    inputs = _inputs(job, steps, (job.gold, table))
                    steps.step("report", section, inputs, partial(job.report.version, section), write)

            return counts, write_report(job.gold, job.report, job.names.bookings, around)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
