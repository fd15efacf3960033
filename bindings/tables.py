"""Booking-shaped views of the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgemart.schemas import MONEY

# The roles the driver's codes play.
CURRENCIES = ("A", "N")
CONFIRMED = "F"
CANCELLED = "F"
NO_PARENT_STATUS = "P"
LEXICON = {
    "the": -1.0,
    "of": 1.0,
    "and": 1.0,
    "to": -2.0,
    "a": 2.0,
    "in": 1.0,
    "is": -3.0,
    "that": 1.0,
    # a repeat in other letter case, phrases, padding, a hyphen
    " The ": -1.5,
    "That": 0.25,
    "of the": 0.5,
    "in  the": -0.5,
    "is and": 2.5,
    "BY-nc": 4.0,
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(col: str) -> Column:
    return F.col(col).cast(MONEY)


def line_id() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One booking per order line; dates out of order in about half of them."""
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    customers = load(spark, sf_dir, "customer")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            line_id().alias("booking_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("checkin_date"),
            F.col("l_shipdate").cast("date").alias("checkout_date"),
            F.col("l_returnflag").alias("currency"),
            money("c_acctbal").alias("total_amount"),
        )
    )


def parent_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bookings; those still open are left out so that their lines are orphans."""
    orders = load(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != NO_PARENT_STATUS)
    return orders.select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("total_amount"),
    )


def status_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_payments`` with the line's status as the payment's."""
    return _payment_lines(load(spark, sf_dir, "lineitem"), F.col("l_linestatus").alias("status"))


def all_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a booking."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("total_amount"),
    )


def hotel_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``all_bookings`` with the customer's nation as the hotel."""
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("hotel_id")
    )
    return all_bookings(spark, sf_dir).join(customers, "customer_id")


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as payments of their order."""
    return _payment_lines(load(spark, sf_dir, "lineitem"))


def _payment_lines(lines: DataFrame, *more: Column) -> DataFrame:
    return lines.select(
        line_id().alias("payment_id"),
        F.col("l_orderkey").alias("booking_id"),
        money("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("currency"),
        *more,
    )


def order_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as clean bookings."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("checkin_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("source"),
        money("o_totalprice").alias("total_amount"),
    )


def room_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stays: the part is the room, the quantity the number of nights."""
    return _stays(load(spark, sf_dir, "lineitem"))


def _stays(lines: DataFrame, *more: Column) -> DataFrame:
    nights = F.make_dt_interval(F.col("l_quantity").cast("int"))
    return lines.select(
        line_id().alias("booking_id"),
        F.col("l_partkey").alias("room_id"),
        F.col("l_shipdate").alias("checkin_date"),
        (F.col("l_shipdate") + nights).alias("checkout_date"),
        *more,
    )


def loose_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``room_stays`` with the return flag as status; sixth lines lack a start, seventh ones an end."""
    number = F.col("booking_id") % 8
    return _stays(load(spark, sf_dir, "lineitem"), F.col("l_returnflag").alias("status")).withColumns(
        {
            "checkin_date": F.when(number != 6, F.col("checkin_date")),
            "checkout_date": F.when(number != 7, F.col("checkout_date")),
        }
    )


def turn_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as reviews by the customer with the conversation's number."""
    return load(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("customer_id"), "turn", F.col("text").alias("review_text")
    )
