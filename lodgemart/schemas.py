"""Declared table schemas, the column map and the fixed value sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# They must be equal to the booking system's own lists.
VALID_CURRENCIES = ("EUR", "USD", "GBP")
BLANK_TOKENS = ("", "null", "NULL")
SENTINEL_COUNTRY = "XX"
STATUS_CONFIRMED = "confirmed"
STATUS_CANCELLED = "cancelled"

MONEY = T.DecimalType(12, 2)


def table_schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


HOTELS = table_schema(
    ("hotel_id", T.StringType()),
    ("hotel_name", T.StringType()),
    ("stars", T.IntegerType()),
    ("country", T.StringType()),
)
ROOMS = table_schema(
    ("room_id", T.StringType()),
    ("hotel_id", T.StringType()),
    ("room_type_code", T.StringType()),
    ("room_type_desc", T.StringType()),
    ("max_occupancy", T.IntegerType()),
)
CUSTOMERS = table_schema(
    ("customer_id", T.StringType()),
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("email", T.StringType()),
    ("country", T.StringType()),
    ("gdpr_optin", T.ByteType()),
)
BOOKINGS = table_schema(
    ("booking_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("hotel_id", T.StringType()),
    ("room_id", T.StringType()),
    ("created_at", T.DateType()),
    ("checkin_date", T.DateType()),
    ("checkout_date", T.DateType()),
    ("nights", T.IntegerType()),
    ("currency", T.StringType()),
    ("total_amount", MONEY),
    ("status", T.StringType()),
    ("source", T.StringType()),
)
PAYMENTS = table_schema(
    ("payment_id", T.StringType()),
    ("booking_id", T.StringType()),
    ("provider", T.StringType()),
    ("status", T.StringType()),
    ("amount", MONEY),
    ("currency", T.StringType()),
    ("transaction_date", T.DateType()),
)


# The physical names of the booking system's columns. One map per table, each
# with the columns that the rules and figures of this table need.


@dataclass(frozen=True)
class HotelColumns:
    country: str = "country"
    hotel: str = "hotel_id"


@dataclass(frozen=True)
class RoomColumns:
    room: str = "room_id"
    hotel: str = "hotel_id"


@dataclass(frozen=True)
class CustomerColumns:
    customer: str = "customer_id"
    email: str = "email"
    loaded: str = "ingestion_date"


@dataclass(frozen=True)
class BookingColumns:
    booking: str = "booking_id"
    customer: str = "customer_id"
    hotel: str = "hotel_id"
    room: str = "room_id"
    checkin: str = "checkin_date"
    checkout: str = "checkout_date"
    total: str = "total_amount"
    currency: str = "currency"
    status: str = "status"
    source: str = "source"


@dataclass(frozen=True)
class PaymentColumns:
    booking: str = "booking_id"
    amount: str = "amount"
    currency: str = "currency"
    status: str = "status"


@dataclass(frozen=True)
class ReviewColumns:
    customer: str = "customer_id"
    text: str = "review_text"


@dataclass(frozen=True)
class Names:
    """The column maps of all tables."""

    hotels: HotelColumns = HotelColumns()
    rooms: RoomColumns = RoomColumns()
    customers: CustomerColumns = CustomerColumns()
    bookings: BookingColumns = BookingColumns()
    payments: PaymentColumns = PaymentColumns()
    reviews: ReviewColumns = ReviewColumns()


def find_column(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of ``name``, compared the way the session compares names."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return name if name in df.columns else None
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[find_column(df, name)].dataType


def sum_type(kind: T.DataType) -> T.DataType:
    """The type ``sum`` gives for a column, so that sums of sums can return to it."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    return T.DoubleType() if isinstance(kind, (T.FloatType, T.DoubleType)) else T.LongType()


def comparable(kind: T.DataType) -> bool:
    """Whether Spark can hash and order values of this type; maps and variants it can not."""
    if isinstance(kind, T.StructType):
        return all(comparable(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return comparable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))
