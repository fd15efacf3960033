"""Cleaning chains of the five booking tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame

from lodgemart.operators.dedup import keep_any, keep_latest
from lodgemart.operators.integrity import flag_orphans, flag_over
from lodgemart.operators.rules import (
    MissingColumnsError,
    Rule,
    apply_rules,
    blank_to_null,
    check_domain,
    drop_sentinel,
    null_negative,
    parse_amount,
    parse_date,
    swap_inverted,
)
from lodgemart.schemas import (
    MONEY,
    SENTINEL_COUNTRY,
    VALID_CURRENCIES,
    BookingColumns,
    CustomerColumns,
    HotelColumns,
    PaymentColumns,
    RoomColumns,
    find_column,
)

PARENT_TOTAL = "bk_total_amount"

# Marks of values that were present but malformed; a chain adds them when asked to.
BAD_DATES = ("dq_bad_checkin", "dq_bad_checkout")
BAD_TOTAL = "dq_bad_total"
BAD_AMOUNT = "dq_bad_amount"


def _currency_rule(col: str, valid: Sequence[str]) -> Rule:
    return Rule("valid currency", (col,), partial(check_domain, col=col, valid=valid, flag="dq_invalid_currency"))


def clean_hotels(df: DataFrame, cols: HotelColumns = HotelColumns(), strict: bool = False) -> DataFrame:
    known = partial(drop_sentinel, col=cols.country, value=SENTINEL_COUNTRY)
    return apply_rules(df, [Rule("known country", (cols.country,), known)], strict)


def clean_customers(
    df: DataFrame, cols: CustomerColumns = CustomerColumns(), strict: bool = False
) -> DataFrame:
    """Blank e-mail to null, then one row per customer: the last one loaded."""
    def one_each(table: DataFrame) -> DataFrame:
        if find_column(table, cols.loaded) is None:
            return keep_any(table, [cols.customer], deterministic=True)
        return keep_latest(table, [cols.customer], cols.loaded)

    rules = [
        Rule("blank e-mail", (cols.email,), partial(blank_to_null, col=cols.email)),
        Rule("one row per customer", (cols.customer,), one_each),
    ]
    return apply_rules(df, rules, strict)


def clean_rooms(df: DataFrame, cols: RoomColumns = RoomColumns(), strict: bool = False) -> DataFrame:
    one_each = partial(keep_any, keys=[cols.room], deterministic=True)
    return apply_rules(df, [Rule("one row per room", (cols.room,), one_each)], strict)


def booking_rules(
    cols: BookingColumns,
    currencies: Sequence[str] = VALID_CURRENCIES,
    bad_date_flags: tuple[str | None, str | None] = (None, None),
    bad_total_flag: str | None = None,
) -> list[Rule]:
    lo, hi = cols.checkin, cols.checkout
    amount = partial(parse_amount, col=cols.total, kind=MONEY, flag=bad_total_flag)
    return [
        Rule("check-in date", (lo,), partial(parse_date, col=lo, flag=bad_date_flags[0])),
        Rule("check-out date", (hi,), partial(parse_date, col=hi, flag=bad_date_flags[1])),
        Rule("date order", (lo, hi), partial(swap_inverted, lo=lo, hi=hi, flag="dq_swapped_dates")),
        Rule("total", (cols.total,), amount),
        Rule(
            "total sign",
            (cols.total,),
            partial(null_negative, col=cols.total, flag="dq_negative_total"),
        ),
        _currency_rule(cols.currency, currencies),
    ]


def clean_bookings(
    df: DataFrame,
    cols: BookingColumns = BookingColumns(),
    strict: bool = False,
    currencies: Sequence[str] = VALID_CURRENCIES,
    bad_date_flags: tuple[str | None, str | None] = (None, None),
    bad_total_flag: str | None = None,
) -> DataFrame:
    """Parse and order the dates, parse the total, null negative totals and unknown currencies, mark each.

    One narrow pass. A malformed date or total becomes null; ``bad_date_flags`` and
    ``bad_total_flag`` name optional marks for them.
    """
    return apply_rules(df, booking_rules(cols, currencies, bad_date_flags, bad_total_flag), strict)


def clean_payments(
    df: DataFrame,
    bookings: DataFrame,
    cols: PaymentColumns = PaymentColumns(),
    strict: bool = False,
    currencies: Sequence[str] = VALID_CURRENCIES,
    splits: int = 1,
    parents: BookingColumns = BookingColumns(),
    bad_amount_flag: str | None = None,
) -> DataFrame:
    """Mark payments without a booking, above its total, or in an unknown currency.

    ``bookings`` must be clean already: a total nulled there can not be exceeded.
    """
    absent = [c for c in (parents.booking, parents.total) if find_column(bookings, c) is None]
    if absent and strict:
        raise MissingColumnsError(f"bookings: no column {', '.join(absent)}")
    match = partial(
        flag_orphans,
        parent=bookings,
        child_key=cols.booking,
        parent_key=parents.booking,
        carry={parents.total: PARENT_TOTAL},
        flag="dq_orphan_payment",
        splits=splits,
    )
    compare = partial(
        flag_over,
        amount=cols.amount,
        limit=PARENT_TOTAL,
        orphan="dq_orphan_payment",
        flag="dq_over_amount",
    )
    amount = partial(parse_amount, col=cols.amount, kind=MONEY, flag=bad_amount_flag)
    linked = [
        Rule("booking exists", (cols.booking,), match),
        Rule("within total", (cols.amount, PARENT_TOTAL), compare),
    ]
    rules = [Rule("amount", (cols.amount,), amount), *([] if absent else linked)]
    return apply_rules(df, [*rules, _currency_rule(cols.currency, currencies)], strict)
