"""One Spark query per operator, over the driver's whole tables.

Decimals leave as doubles so that both engines hand over the same type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import tables as B
from lodgemart.operators.dedup import keep_any, keep_latest
from lodgemart.operators.foreign_keys import ForeignKey, check_keys
from lodgemart.operators.integrity import flag_orphans, flag_over
from lodgemart.operators.rules import (
    blank_to_null,
    check_domain,
    drop_sentinel,
    null_negative,
    parse_date,
    swap_inverted,
)
from lodgemart.plans import cleaning, kpi
from lodgemart.plans.top_lists import top_by
from lodgemart.plans.sentiment import (
    enrich_sentiment,
    score_by_table,
    score_reviews,
    sentiment_by_customer,
)
from lodgemart.plans.stages import Job, run_all
from lodgemart.schemas import MONEY, ReviewColumns, table_schema
from lodgemart.sources.ingest import TableSpec, audit_frame, ingest, stamp, write_counted, write_verified
from lodgemart.sources.layers import PathLayer, TableLayer
from lodgemart.sources.ledger import Ledger
from lodgemart.sources.readers import read_csv
from lodgemart.sources.scratch import scratch_path
from lodgemart.sources.staging import listed_version
from lodgemart.sources.task_sizes import listed_bytes, small_tasks

Query = Callable[[SparkSession, str], DataFrame]
KEY = T.LongType()


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("double")
            for f in df.schema
            if isinstance(f.dataType, T.DecimalType)
        }
    )


# Sources and sinks


def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = PathLayer(spark, scratch_path(spark, "layer"))
    layer.write(B.load(spark, sf_dir, "orders"), "orders")
    return layer.read("orders")


def _customer_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "csv")
    customers = B.load(spark, sf_dir, "customer").withColumn("c_acctbal", B.money("c_acctbal"))
    customers.write.option("header", True).csv(path)
    return path


def src_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table_schema(
        ("c_custkey", T.LongType()),
        ("c_name", T.StringType()),
        ("c_nationkey", T.IntegerType()),
        ("c_acctbal", MONEY),
        ("c_mktsegment", T.StringType()),
    )
    return plain_numbers(read_csv(spark, _customer_csv(spark, sf_dir), schema))


def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_csv(spark, _customer_csv(spark, sf_dir), infer=True)
    return table.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def src_csv_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, _customer_csv(spark, sf_dir))


def src_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that don't fit their declared types, and the rows that are loaded from them.

    Every seventh customer has nights that are no number, every eleventh a value too few, every
    thirteenth one too many.
    """
    base, n = scratch_path(spark, "rejects"), F.col("c_custkey")
    nights = F.when(n % 7 == 0, "two").otherwise(F.col("c_nationkey").cast("string"))
    customers = B.load(spark, sf_dir, "customer")
    short = F.concat_ws(",", n.cast("string"), nights)
    line = F.when(n % 11 == 0, short).otherwise(F.concat_ws(",", short, "c_name"))
    line = F.when((n % 13 == 0) & (n % 11 != 0), F.concat(line, F.lit(",more"))).otherwise(line)
    lines = customers.select(line.alias("customer_id,nights,name"))
    # One column, whose commas are no separators while it is written.
    lines.write.option("header", True).option("sep", "\u0001").csv(f"{base}/raw/stays")
    schema = table_schema(("customer_id", KEY), ("nights", T.IntegerType()), ("name", T.StringType()))
    layer = PathLayer(spark, f"{base}/bronze")
    ingest(spark, f"{base}/raw", layer, {"stays": TableSpec("stays", schema)}, rejects=True)
    rejected = layer.read("stays_rejects").select(F.lit("rejected").alias("what"), F.col("rejected_record").alias("record"))
    loaded = layer.read("stays").select(
        F.when(F.col("nights").isNull(), "loaded without nights").otherwise("loaded").alias("what"),
        F.concat_ws(",", "customer_id", "nights", "name").alias("record"),
    )
    return rejected.unionByName(loaded)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a table, overwrite it with another schema, read it back by name."""
    place = scratch_path(spark, "schema")
    name = f"layer_{place[-12:]}"
    layer = TableLayer(spark, name, catalog="spark_catalog", location=place)
    layer.prepare()
    layer.write(B.load(spark, sf_dir, "supplier").select("s_suppkey"), "suppliers")
    layer.write(B.load(spark, sf_dir, "supplier"), "suppliers")
    return layer.read("suppliers")


def table_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables bucketed by booking, joined on it without a shuffle."""
    place = scratch_path(spark, "schema")
    name = f"layer_{place[-12:]}"
    by = (("bookings", "booking_id"), ("payments", "booking_id"))
    layer = TableLayer(spark, name, location=place, bucket_by=by, buckets=8)
    layer.prepare()
    layer.write(B.all_bookings(spark, sf_dir), "bookings")
    layer.write(B.raw_payments(spark, sf_dir), "payments")
    paid = layer.read("payments").groupBy("booking_id").agg(F.sum("amount").alias("paid"))
    return plain_numbers(layer.read("bookings").join(paid, "booking_id"))


def ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    run_ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return stamp(B.load(spark, sf_dir, "orders"), run_ts)


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = PathLayer(spark, scratch_path(spark, "audit"))
    names = ("customer", "orders", "lineitem", "events")
    counts = {n: write_counted(B.load(spark, sf_dir, n), layer, n) for n in names}
    return audit_frame(spark, counts)


def ingest_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded, and whether the tables hold what was sent, by checksums."""
    layer = PathLayer(spark, scratch_path(spark, "verified"))
    names = ("customer", "orders", "lineitem", "documents", "embeddings")
    counts = {n: write_verified(B.load(spark, sf_dir, n), layer, n) for n in names}
    return audit_frame(spark, counts)


# Quality rules


def dq_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = B.load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = B.load(spark, sf_dir, "supplier")
    named = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return drop_sentinel(named, "n_name", "NATION_0").drop("n_nationkey")


def dq_blank_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = B.load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return blank_to_null(customers, "c_mktsegment", ("MACHINERY",))


def dq_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text; the open orders carry theirs day first, which is malformed."""
    day_first = F.col("o_orderstatus") == B.NO_PARENT_STATUS
    text = F.when(day_first, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    orders = B.load(spark, sf_dir, "orders").select("o_orderkey", text.alias("order_date"))
    return parse_date(orders, "order_date", "dq_bad_date")


def dq_swap_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = B.load(spark, sf_dir, "lineitem"), B.load(spark, sf_dir, "orders")
    dated = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        B.line_id().alias("booking_id"), "o_orderdate", "l_shipdate"
    )
    return swap_inverted(dated, "o_orderdate", "l_shipdate", "dq_swapped_dates")


def dq_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = B.load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return null_negative(customers, "c_acctbal", "dq_negative_total")


def dq_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = B.load(spark, sf_dir, "lineitem").select(
        B.line_id().alias("payment_id"), F.col("l_returnflag").alias("currency")
    )
    return check_domain(lines, "currency", B.CURRENCIES, "dq_invalid_currency")


def dq_bookings_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    bookings = B.raw_bookings(spark, sf_dir)
    return plain_numbers(cleaning.clean_bookings(bookings, strict=True, currencies=B.CURRENCIES))


def _orphans(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return flag_orphans(
        B.raw_payments(spark, sf_dir),
        B.parent_bookings(spark, sf_dir),
        "booking_id",
        "booking_id",
        {"total_amount": cleaning.PARENT_TOTAL},
        "dq_orphan_payment",
        **options,
    )


def dq_orphan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(_orphans(spark, sf_dir).drop("currency", "amount"))


def dq_orphan_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dq_orphan`` with the lines of every order dealt over four places."""
    return plain_numbers(_orphans(spark, sf_dir, splits=4).drop("currency", "amount"))


def dq_over_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = flag_over(
        _orphans(spark, sf_dir), "amount", cleaning.PARENT_TOTAL, "dq_orphan_payment", "dq_over_amount"
    )
    return plain_numbers(marked.drop("currency"))


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_payments(
        B.raw_payments(spark, sf_dir),
        B.parent_bookings(spark, sf_dir),
        strict=True,
        currencies=B.CURRENCIES,
    )


def dq_payments_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(_payments(spark, sf_dir))


def payments_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(kpi.valid_payments(_payments(spark, sf_dir)))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(B.load(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])


def dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return keep_any(B.load(spark, sf_dir, "lineitem"), keys).select(*keys)


def dedup_any_total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic variant, whose survivors SQL can name."""
    lines = B.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    return keep_any(lines, ["l_orderkey", "l_linenumber"], deterministic=True)


# Key figures


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(kpi.daily_revenue(B.order_bookings(spark, sf_dir), confirmed=B.CONFIRMED))


def cancellation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.cancellation_rate(B.order_bookings(spark, sf_dir), cancelled=B.CANCELLED)


def collection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    bookings = B.hotel_bookings(spark, sf_dir)
    return plain_numbers(kpi.collection_rate(bookings, _payments(spark, sf_dir)))


def overlap_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.overbooking_alerts(B.room_stays(spark, sf_dir))


def overlap_alerts_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``overlap_alerts`` on 64-day cells."""
    return kpi.overbooking_alerts(B.room_stays(spark, sf_dir), bucket_days=64)


def overlap_alerts_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``overlap_alerts`` on one-day cells, so that longer stays use the wider ones."""
    return kpi.overbooking_alerts(B.room_stays(spark, sf_dir), bucket_days=1)


def customer_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(kpi.customer_value(B.order_bookings(spark, sf_dir)))


def customer_value_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bookings = B.order_bookings(spark, sf_dir)
    return plain_numbers(kpi.customer_value(bookings, confirmed_only=True, confirmed=B.CONFIRMED))


# Sentiment

DOCUMENTS = ReviewColumns(text="text")


def sentiment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = B.load(spark, sf_dir, "documents").select("doc_id", "text")
    return score_reviews(documents, B.LEXICON, DOCUMENTS).select("doc_id", "sentiment_score")


def _lexicon_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(B.LEXICON.items()), "word string, valence double")


def sentiment_score_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sentiment_score`` with the lexicon as a table, which is small enough for the plan."""
    documents = B.load(spark, sf_dir, "documents").select("doc_id", "text")
    return score_reviews(documents, _lexicon_table(spark), DOCUMENTS).select("doc_id", "sentiment_score")


def sentiment_score_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the rows of every word dealt over four places."""
    documents = B.load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_by_table(documents, _lexicon_table(spark), DOCUMENTS, splits=4)
    return scored.select("doc_id", "sentiment_score")


def sentiment_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = B.load(spark, sf_dir, "documents").select("doc_id", "text")
    return score_reviews(documents, B.LEXICON, DOCUMENTS).drop("text")


def _scored_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_reviews(B.turn_reviews(spark, sf_dir), B.LEXICON)


def sentiment_by_customer_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_by_customer(_scored_turns(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = kpi.customer_value(B.order_bookings(spark, sf_dir))
    return enrich_sentiment(value, _scored_turns(spark, sf_dir))


def customer_value_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(_enriched(spark, sf_dir))


# Report


def top_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_by(collection_rate(spark, sf_dir), "collection_rate", "hotel_id")


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_numbers(top_by(_enriched(spark, sf_dir), "revenue_sum", "customer_id"))


# All layers

STAGE_SPECS = {
    "hotels": TableSpec("hotels", table_schema(("hotel_id", KEY), ("country", T.StringType()))),
    "rooms": TableSpec("rooms", table_schema(("room_id", KEY), ("hotel_id", KEY))),
    "customers": TableSpec("customers", table_schema(("customer_id", KEY), ("email", T.StringType()))),
    "bookings": TableSpec(
        "bookings",
        table_schema(
            ("booking_id", KEY),
            ("customer_id", KEY),
            ("hotel_id", KEY),
            ("room_id", KEY),
            ("checkin_date", T.DateType()),
            ("checkout_date", T.DateType()),
            ("currency", T.StringType()),
            ("total_amount", MONEY),
            ("status", T.StringType()),
            ("source", T.StringType()),
        ),
    ),
    "payments": TableSpec(
        "payments",
        table_schema(
            ("payment_id", KEY), ("booking_id", KEY), ("amount", MONEY), ("currency", T.StringType())
        ),
    ),
}


def _raw_files(spark: SparkSession, sf_dir: str, target: str) -> None:
    """The driver's tables as the five raw CSV tables."""
    nations = B.load(spark, sf_dir, "nation")
    parts = B.load(spark, sf_dir, "part")
    customers = B.load(spark, sf_dir, "customer")
    orders = B.load(spark, sf_dir, "orders")
    orders_by = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    raw = {
        "hotels": nations.select(
            F.col("n_nationkey").alias("hotel_id"), F.col("n_name").alias("country")
        ),
        "rooms": parts.select(F.col("p_partkey").alias("room_id"), F.col("p_size").alias("hotel_id")),
        "customers": customers.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("email")
        ),
        "bookings": orders_by.select(
            F.col("o_orderkey").alias("booking_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("hotel_id"),
            F.col("o_custkey").alias("room_id"),
            F.to_date("o_orderdate").alias("checkin_date"),
            F.date_add("o_orderdate", 3).alias("checkout_date"),
            F.lit("EUR").alias("currency"),
            B.money("o_totalprice").alias("total_amount"),
            F.when(F.col("o_orderstatus") == B.CONFIRMED, "confirmed")
            .otherwise("cancelled")
            .alias("status"),
            F.col("o_orderpriority").alias("source"),
        ),
        "payments": B.raw_payments(spark, sf_dir).withColumn(
            "currency",
            F.when(F.col("currency").isin(*B.CURRENCIES), "USD").when(
                F.col("currency").isNotNull(), "ZZZ"
            ),
        ),
    }
    raw["reviews.csv"] = B.turn_reviews(spark, sf_dir).select("customer_id", "review_text")
    for name, table in raw.items():
        table.write.mode("overwrite").option("header", True).csv(f"{target}/{name}")


# Where the stages of a session's tables lie; what is done there is the ledger's to say.
_LAKES: dict[tuple[str, str], str] = {}
RAW_TABLES = ("nation", "part", "customer", "orders", "lineitem", "conversations")


def _whole_run(spark: SparkSession, sf_dir: str) -> Job:
    """All stages: raw files to bronze, silver, gold and report, but for tables that are up to date."""
    key = (spark.sparkContext.applicationId, sf_dir)
    base = _LAKES.setdefault(key, scratch_path(spark, "layers"))
    ledger = Ledger(spark, f"{base}/raw-ledger", resume=True)
    paths = [f"{sf_dir}/{name}.parquet" for name in RAW_TABLES]
    inputs = [listed_version(spark, [path]) for path in paths]
    version = lambda: listed_version(spark, [f"{base}/raw"])

    def write() -> None:
        with small_tasks(spark, listed_bytes(spark, paths)):
            _raw_files(spark, sf_dir, f"{base}/raw")

    ledger.step("raw", "files", inputs, version, write)
    layers = [PathLayer(spark, f"{base}/{name}") for name in ("bronze", "silver", "gold", "report")]
    job = Job(f"{base}/raw", *layers, specs=STAGE_SPECS, ledger=f"{base}/ledger")
    _, skipped = run_all(spark, job, B.LEXICON, resume=True)
    if skipped:
        raise RuntimeError(f"report sections were skipped: {skipped}")
    return job


def _gold(table: str) -> Query:
    return lambda spark, sf_dir: plain_numbers(_whole_run(spark, sf_dir).gold.read(table))


def _report(section: str) -> Query:
    return lambda spark, sf_dir: plain_numbers(_whole_run(spark, sf_dir).report.read(section))


layers_collection_rate = _gold("collection_rate")


def layers_reviews_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _whole_run(spark, sf_dir).gold.read("reviews_sentiment").drop("review_text")
    return scored.withColumn("customer_id", F.col("customer_id").cast("bigint"))


# Options and malformed values


def dq_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings from a CSV file: open orders have day-first dates, those of the first customers
    totals beyond the type; loaded, cleaned, and every loss marked."""
    orders, base = B.load(spark, sf_dir, "orders"), scratch_path(spark, "bad-values")
    day_first = F.col("o_orderstatus") == B.NO_PARENT_STATUS
    too_large = F.col("o_custkey") % 10 == 0
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders.select(
        F.col("o_orderkey").alias("booking_id"),
        F.when(day_first, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(text).alias("checkin_date"),
        F.date_format(F.date_add("o_orderdate", 3), "yyyy-MM-dd").alias("checkout_date"),
        F.when(too_large, F.lit("99999999999.00"))
        .otherwise(B.money("o_totalprice").cast("string"))
        .alias("total_amount"),
    ).write.option("header", True).csv(f"{base}/raw/bookings")
    spec = TableSpec(
        "bookings",
        table_schema(
            ("booking_id", KEY), ("checkin_date", T.DateType()), ("checkout_date", T.DateType()), ("total_amount", MONEY)
        ),
    )
    bronze = PathLayer(spark, f"{base}/bronze")
    ingest(spark, f"{base}/raw", bronze, {"bookings": spec})
    clean = cleaning.clean_bookings(
        bronze.read("bookings").drop("ingestion_date"),
        bad_date_flags=cleaning.BAD_DATES,
        bad_total_flag=cleaning.BAD_TOTAL,
    )
    return plain_numbers(clean)


def dq_rules_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain over a table without check-out and currency: their rules are passed over."""
    return plain_numbers(cleaning.clean_bookings(B.raw_bookings(spark, sf_dir).drop("checkout_date", "currency")))


def payments_status_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = cleaning.clean_payments(
        B.status_payments(spark, sf_dir), B.parent_bookings(spark, sf_dir), strict=True, currencies=B.CURRENCIES
    )
    return plain_numbers(kpi.valid_payments(checked, status_in=["O"]).select("payment_id", "amount", "status"))


TPCH_KEYS = (
    ForeignKey("nation", "n_regionkey", "region", "r_regionkey", "dq_orphan_region"),
    ForeignKey("customer", "c_nationkey", "nation", "n_nationkey", "dq_orphan_nation"),
    ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey", "dq_orphan_nation"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey", "dq_orphan_customer"),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey", "dq_orphan_order"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey", "dq_orphan_supplier"),
)


def dq_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line: is its order or supplier missing, or lost with its customer, nation or region?

    Region 1 and the open orders are left out; every tenth customer counts as lost.
    """
    tables = {name: B.load(spark, sf_dir, name) for name in ("region", "nation", "customer", "supplier", "orders", "lineitem")}
    tables["region"] = tables["region"].where("r_regionkey <> 1")
    tables["orders"] = tables["orders"].where(F.col("o_orderstatus") != B.NO_PARENT_STATUS)
    checked = check_keys(tables, TPCH_KEYS, {"customer": F.col("c_custkey") % 10 == 0})
    return checked["lineitem"].select(
        B.line_id().alias("payment_id"), "dq_orphan_order", "dq_orphan_supplier", "dq_cascade"
    )


def overlap_alerts_exclude_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.overbooking_alerts(B.loose_stays(spark, sf_dir), exclude_status=["R"])


def overlap_alerts_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays without a start or an end reach without limit."""
    return kpi.overbooking_alerts(B.loose_stays(spark, sf_dir), null_bounds="open")


def all_queries() -> dict[str, Query]:
    return {
        "src_parquet": src_parquet,
        "src_csv_typed": src_csv_typed,
        "src_csv_inferred": src_csv_inferred,
        "src_csv_string": src_csv_string,
        "src_csv_rejects": src_csv_rejects,
        "table_roundtrip": table_roundtrip,
        "table_bucketed": table_bucketed,
        "ingest_stamp": ingest_stamp,
        "ingest_audit": ingest_audit,
        "ingest_verified": ingest_verified,
        "dq_sentinel": dq_sentinel,
        "dq_blank_null": dq_blank_null,
        "dq_parse_date": dq_parse_date,
        "dq_swap_dates": dq_swap_dates,
        "dq_negative": dq_negative,
        "dq_domain": dq_domain,
        "dq_bookings_full": dq_bookings_full,
        "dq_orphan": dq_orphan,
        "dq_orphan_spread": dq_orphan_spread,
        "dq_cascade": dq_cascade,
        "dq_over_amount": dq_over_amount,
        "dq_payments_full": dq_payments_full,
        "payments_valid": payments_valid,
        "dedup_latest": dedup_latest,
        "dedup_any": dedup_any,
        "dedup_any_total_order": dedup_any_total_order,
        "daily_revenue": daily_revenue,
        "cancellation_rate": cancellation_rate,
        "collection_rate": collection_rate,
        "overlap_alerts": overlap_alerts,
        "overlap_alerts_bucketed": overlap_alerts_bucketed,
        "overlap_alerts_levels": overlap_alerts_levels,
        "customer_value": customer_value,
        "customer_value_confirmed": customer_value_confirmed,
        "sentiment_score": sentiment_score,
        "sentiment_score_joined": sentiment_score_joined,
        "sentiment_score_spread": sentiment_score_spread,
        "sentiment_label": sentiment_label,
        "sentiment_by_customer": sentiment_by_customer_,
        "customer_value_enriched": customer_value_enriched,
        "top_collection": top_collection,
        "top_customers": top_customers,
        "dq_bad_values": dq_bad_values,
        "dq_rules_skipped": dq_rules_skipped,
        "payments_status_in": payments_status_in,
        "overlap_alerts_exclude_status": overlap_alerts_exclude_status,
        "overlap_alerts_open": overlap_alerts_open,
        "layers_collection_rate": layers_collection_rate,
        "layers_daily_revenue": _gold("daily_revenue"),
        "layers_cancellation_rate": _gold("cancellation_rate_by_source"),
        "layers_overbooking_alerts": _gold("overbooking_alerts"),
        "layers_customer_value": _gold("customer_value"),
        "layers_customer_value_enriched": _gold("customer_value_enriched"),
        "layers_reviews_sentiment": layers_reviews_sentiment,
        "report_daily_revenue": _report("daily_revenue"),
        "report_cancellation_rate": _report("cancellation_rate"),
        "report_top_collection": _report("top_collection"),
        "report_top_customers": _report("top_customers"),
    }
