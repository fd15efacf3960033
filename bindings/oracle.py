"""The queries of ``bindings.queries`` in SQL, for DuckDB.

Money is counted in whole cents, so sums are exact; ratios and means are rounded half up
in integer arithmetic, as Spark rounds decimals.
"""

from __future__ import annotations

ID = "l_orderkey * 8 + l_linenumber"
CENTS = "CAST(ROUND({} * 100) AS BIGINT)"
TOTAL_CENTS = CENTS.format("o_totalprice")
AMOUNT_CENTS = CENTS.format("l_extendedprice")


def dollars(cents: str) -> str:
    return f"CAST(({cents}) AS DOUBLE) / 100"


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """numerator / denominator rounded to 1 / scale; both non-negative integers."""
    doubled = f"(2 * ({numerator}) * {scale} + ({denominator}))"
    return f"CAST({doubled} // (2 * ({denominator})) AS DOUBLE) / {scale}"


PAYMENTS = f"""
SELECT {ID} AS payment_id, l_orderkey AS booking_id, {AMOUNT_CENTS} AS amount_cents,
       CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS currency,
       o_total AS total_cents,
       o_orderkey IS NULL AS dq_orphan_payment,
       COALESCE({AMOUNT_CENTS} > o_total, false) AS dq_over_amount,
       COALESCE(l_returnflag NOT IN ('A', 'N'), false) AS dq_invalid_currency
FROM lineitem LEFT JOIN (
    SELECT o_orderkey, MAX({TOTAL_CENTS}) AS o_total
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderkey
) ON l_orderkey = o_orderkey
"""

VALID = (
    "amount_cents IS NOT NULL "
    "AND NOT dq_orphan_payment AND NOT dq_over_amount AND NOT dq_invalid_currency"
)


def payments(columns: str, where: str = "true") -> str:
    return f"SELECT {columns} FROM ({PAYMENTS}) AS p WHERE {where}"


ORPHAN_COLUMNS = (
    f"payment_id, booking_id, {dollars('total_cents')} AS bk_total_amount, dq_orphan_payment"
)
AMOUNT = f"{dollars('amount_cents')} AS amount"


def collection(hotels: str) -> str:
    """Collection rate over ``hotels`` (booking_id, hotel_id, cents) and the valid payments."""
    return f"""
WITH booked AS ({hotels}),
paid AS (
    SELECT hotel_id, SUM(amount_cents) AS paid
    FROM ({payments('booking_id, amount_cents', VALID)}) AS v JOIN booked USING (booking_id)
    GROUP BY hotel_id
),
totals AS (SELECT hotel_id, SUM(cents) AS total FROM booked GROUP BY hotel_id)
SELECT hotel_id, {dollars('total')} AS total_bookings_value,
       {dollars('COALESCE(paid, 0)')} AS total_payments_value,
       CASE WHEN total > 0 THEN {half_up('COALESCE(paid, 0)', 'total', 10000)} END
           AS collection_rate
FROM totals LEFT JOIN paid USING (hotel_id)
"""


HOTELS = f"""
SELECT o_orderkey AS booking_id, c_nationkey AS hotel_id, {TOTAL_CENTS} AS cents
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice IS NOT NULL
"""

COLLECTION = collection(HOTELS)

CUSTOMER_VALUE = f"""
SELECT o_custkey AS customer_id, COUNT(DISTINCT o_orderkey) AS bookings_count,
       {dollars(f'SUM({TOTAL_CENTS})')} AS revenue_sum,
       {half_up(f'SUM({TOTAL_CENTS})', 'COUNT(*)', 1)} / 100 AS avg_ticket
FROM orders WHERE o_totalprice IS NOT NULL {{and_also}} GROUP BY o_custkey
"""

# The entries of the queries' lexicon as they count: lower case, single spaces, the largest of repeats.
ENTRIES = {
    "the": -1.0, "of": 1.0, "and": 1.0, "to": -2.0, "a": 2.0, "in": 1.0, "is": -3.0, "that": 1.0,
    "of the": 0.5, "in the": -0.5, "is and": 2.5, "by-nc": 4.0,
}
WORD_VALUE = "CASE w " + " ".join(f"WHEN '{w}' THEN {v}" for w, v in ENTRIES.items()) + " ELSE 0.0 END"
PHRASES = "|".join(w.replace(" ", r"\s+") for w in sorted(ENTRIES, reverse=True) if not w.isalpha())
# A phrase takes the character behind it along, as the pattern can't look ahead.
UNIT = rf"(?:{PHRASES})(?:[^\p{{L}}\p{{N}}_]|$)|[\p{{L}}\p{{N}}_]+"


def score(text: str) -> str:
    units = rf"regexp_extract_all(lower({text}), '{UNIT}')"
    trimmed = rf"regexp_replace(regexp_replace(u, '[^\p{{L}}\p{{N}}_]$', ''), '\s+', ' ', 'g')"
    words = f"list_transform({units}, lambda u: {trimmed})"
    return f"CAST(COALESCE(list_sum(list_transform({words}, lambda w: {WORD_VALUE})), 0) AS DOUBLE)"


LABEL = (
    "CASE WHEN sentiment_score > 1 THEN 'positive' WHEN sentiment_score < -1 THEN 'negative' "
    "ELSE 'neutral' END AS predicted_sentiment"
)
SCORES = f"SELECT doc_id, {score('text')} AS sentiment_score FROM documents"
TURNS = f"""
SELECT conv_id AS customer_id, AVG({score('text')}) AS avg_sentiment_score
FROM conversations GROUP BY conv_id
"""
ENRICHED = f"""
SELECT v.*, COALESCE(avg_sentiment_score, 0.0) AS avg_sentiment_score
FROM ({CUSTOMER_VALUE.format(and_also='')}) AS v LEFT JOIN ({TURNS}) AS t USING (customer_id)
"""

OVERLAPS = f"""
WITH stays AS (
    SELECT l_partkey AS room_id, {ID} AS id, l_shipdate AS lo,
           l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS hi
    FROM lineitem
)
SELECT a.room_id, a.id AS booking_id_1, b.id AS booking_id_2,
       GREATEST(a.lo, b.lo) AS overlap_start, LEAST(a.hi, b.hi) AS overlap_end
FROM stays AS a JOIN stays AS b
  ON a.room_id = b.room_id AND a.id < b.id AND GREATEST(a.lo, b.lo) < LEAST(a.hi, b.hi)
"""

LOOSE = f"""
SELECT l_partkey AS room_id, {ID} AS id, l_returnflag AS status,
       CASE WHEN ({ID}) % 8 <> 6 THEN l_shipdate END AS lo,
       CASE WHEN ({ID}) % 8 <> 7 THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER)) END AS hi
FROM lineitem
"""


def loose_pairs(bounds: str, status: str = "true") -> str:
    return f"""
WITH stays AS (SELECT * FROM ({LOOSE}) AS s WHERE {status})
SELECT a.room_id, a.id AS booking_id_1, b.id AS booking_id_2,
       GREATEST(a.lo, b.lo) AS overlap_start, LEAST(a.hi, b.hi) AS overlap_end
FROM stays AS a JOIN stays AS b ON a.room_id = b.room_id AND a.id < b.id
WHERE GREATEST(a.lo, b.lo) < LEAST(a.hi, b.hi)
  AND COALESCE(a.lo < a.hi, true) AND COALESCE(b.lo < b.hi, true) AND {bounds}
"""


LAYER_BOOKINGS = f"""
SELECT o_orderkey AS id, o_custkey AS room_id, CAST(o_orderdate AS DATE) AS lo,
       CAST(o_orderdate AS DATE) + 3 AS hi, o_orderpriority AS source, o_orderstatus AS status,
       {TOTAL_CENTS} AS cents
FROM orders JOIN customer ON o_custkey = c_custkey
"""
LAYER_COLLECTION = COLLECTION.replace(
    "WHERE o_orderstatus <> 'P' GROUP BY o_orderkey", "GROUP BY o_orderkey"
)
LAYER_REVENUE = f"""
SELECT lo AS date, {dollars('SUM(cents)')} AS gross_revenue, COUNT(DISTINCT id) AS bookings_count
FROM ({LAYER_BOOKINGS}) AS b WHERE status = 'F' AND cents IS NOT NULL GROUP BY lo
"""
LAYER_CANCELLED = f"""
SELECT source, total_bookings, cancelled,
       {half_up('cancelled * 100', 'total_bookings', 100)} AS cancellation_rate_pct
FROM (SELECT source, COUNT(*) AS total_bookings,
             COUNT(*) FILTER (WHERE COALESCE(status <> 'F', true)) AS cancelled
      FROM ({LAYER_BOOKINGS}) AS b GROUP BY source)
"""
LAYER_VALUE = CUSTOMER_VALUE.format(and_also="").replace(
    "FROM orders WHERE", "FROM orders JOIN customer ON o_custkey = c_custkey WHERE"
)
LAYER_ENRICHED = f"""
SELECT v.*, COALESCE(avg_sentiment_score, 0.0) AS avg_sentiment_score
FROM ({LAYER_VALUE}) AS v LEFT JOIN ({TURNS}) AS t USING (customer_id)
"""

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

SUPPLIER = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"


CASCADE = f"""
WITH nations AS (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_regionkey <> 1)),
customers AS (
  SELECT c_custkey FROM customer
  WHERE c_nationkey IN (SELECT n_nationkey FROM nations) AND c_custkey % 10 <> 0),
suppliers AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nations)),
kept AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
held AS (SELECT o_orderkey FROM kept WHERE o_custkey IN (SELECT c_custkey FROM customers))
SELECT {ID} AS payment_id,
       NOT EXISTS (SELECT 1 FROM kept WHERE o_orderkey = l_orderkey) AS dq_orphan_order,
       NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey) AS dq_orphan_supplier,
       NOT EXISTS (SELECT 1 FROM held WHERE o_orderkey = l_orderkey)
         OR NOT EXISTS (SELECT 1 FROM suppliers WHERE s_suppkey = l_suppkey) AS dq_cascade
FROM lineitem
"""

REJECTS = """
WITH stays AS (
  SELECT c_custkey AS n, c_nationkey AS nights, c_name AS name,
         c_custkey || ',' || CASE WHEN c_custkey % 7 = 0 THEN 'two' ELSE c_nationkey::VARCHAR END
           || CASE WHEN c_custkey % 11 = 0 THEN '' ELSE ',' || c_name END
           || CASE WHEN c_custkey % 13 = 0 AND c_custkey % 11 <> 0 THEN ',more' ELSE '' END AS record
  FROM customer)
SELECT 'rejected' AS what, record FROM stays WHERE n % 7 = 0 OR n % 11 = 0 OR n % 13 = 0
UNION ALL
SELECT CASE WHEN n % 7 = 0 THEN 'loaded without nights' ELSE 'loaded' END,
       concat_ws(',', n, CASE WHEN n % 7 <> 0 THEN nights END, CASE WHEN n % 11 <> 0 THEN name END)
FROM stays
"""


def all_oracles() -> dict[str, str]:
    return {
        "src_parquet": "SELECT * FROM orders",
        "src_csv_typed": CUSTOMER,
        "src_csv_inferred": CUSTOMER,
        "src_csv_string": """
            SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
                   CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                   CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment
            FROM customer""",
        "dq_cascade": CASCADE,
        "src_csv_rejects": REJECTS,
        "table_roundtrip": SUPPLIER,
        "table_bucketed": f"""
            SELECT o_orderkey AS booking_id, o_custkey AS customer_id,
                   {dollars(TOTAL_CENTS)} AS total_amount, {dollars('paid')} AS paid
            FROM orders JOIN (
                SELECT l_orderkey, SUM({AMOUNT_CENTS}) AS paid FROM lineitem GROUP BY l_orderkey
            ) ON o_orderkey = l_orderkey""",
        "ingest_stamp": "SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS ingestion_date FROM orders",
        "ingest_audit": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
            for t in ("customer", "orders", "lineitem", "events")
        ),
        "ingest_verified": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, true AS content_matches FROM {t}"
            for t in ("customer", "orders", "lineitem", "documents", "embeddings")
        ),
        "dq_sentinel": """
            SELECT supplier.*, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
            WHERE n_name <> 'NATION_0'""",
        "dq_blank_null": """
            SELECT c_custkey, CASE WHEN trim(c_mktsegment) IN ('MACHINERY') THEN NULL
                                   ELSE c_mktsegment END AS c_mktsegment
            FROM customer""",
        "dq_parse_date": """
            SELECT o_orderkey, try_cast(t AS DATE) AS order_date,
                   t IS NOT NULL AND try_cast(t AS DATE) IS NULL AS dq_bad_date
            FROM (SELECT o_orderkey,
                         CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t
                  FROM orders)""",
        "dq_swap_dates": f"""
            SELECT {ID} AS booking_id,
                   COALESCE(o_orderdate > l_shipdate, false) AS dq_swapped_dates,
                   LEAST(o_orderdate, l_shipdate) AS o_orderdate,
                   GREATEST(o_orderdate, l_shipdate) AS l_shipdate
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "dq_negative": """
            SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
                   COALESCE(c_acctbal < 0, false) AS dq_negative_total
            FROM customer""",
        "dq_domain": f"""
            SELECT {ID} AS payment_id,
                   CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS currency,
                   COALESCE(l_returnflag NOT IN ('A', 'N'), false) AS dq_invalid_currency
            FROM lineitem""",
        "dq_bookings_full": f"""
            SELECT {ID} AS booking_id,
                   COALESCE(CAST(o_orderdate AS DATE) > CAST(l_shipdate AS DATE), false)
                       AS dq_swapped_dates,
                   LEAST(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS checkin_date,
                   GREATEST(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS checkout_date,
                   COALESCE(c_acctbal < 0, false) AS dq_negative_total,
                   CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS total_amount,
                   COALESCE(l_returnflag NOT IN ('A', 'N'), false) AS dq_invalid_currency,
                   CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS currency
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                          JOIN customer ON o_custkey = c_custkey""",
        "dq_orphan": payments(ORPHAN_COLUMNS),
        "dq_orphan_spread": payments(ORPHAN_COLUMNS),
        "dq_over_amount": payments(f"{ORPHAN_COLUMNS}, {AMOUNT}, dq_over_amount"),
        "dq_payments_full": payments(
            f"{ORPHAN_COLUMNS}, {AMOUNT}, dq_over_amount, currency, dq_invalid_currency"
        ),
        "payments_valid": payments(
            f"{ORPHAN_COLUMNS}, {AMOUNT}, dq_over_amount, currency, dq_invalid_currency", VALID
        ),
        "dedup_latest": """
            SELECT * FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "dedup_any": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
        "dedup_any_total_order": """
            SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM lineitem
            QUALIFY row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
        "daily_revenue": f"""
            SELECT CAST(o_orderdate AS DATE) AS date,
                   {dollars(f'SUM({TOTAL_CENTS})')} AS gross_revenue,
                   COUNT(DISTINCT o_orderkey) AS bookings_count
            FROM orders WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL GROUP BY 1""",
        "cancellation_rate": f"""
            SELECT source, total_bookings, cancelled,
                   {half_up('cancelled * 100', 'total_bookings', 100)} AS cancellation_rate_pct
            FROM (SELECT o_orderpriority AS source, COUNT(*) AS total_bookings,
                         COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS cancelled
                  FROM orders GROUP BY o_orderpriority)""",
        "collection_rate": COLLECTION,
        "overlap_alerts": OVERLAPS,
        "overlap_alerts_bucketed": OVERLAPS,
        "overlap_alerts_levels": OVERLAPS,
        "customer_value": CUSTOMER_VALUE.format(and_also=""),
        "customer_value_confirmed": CUSTOMER_VALUE.format(and_also="AND o_orderstatus = 'F'"),
        "sentiment_score": SCORES,
        "sentiment_score_joined": SCORES,
        "sentiment_score_spread": SCORES,
        "sentiment_label": f"SELECT *, {LABEL} FROM ({SCORES})",
        "sentiment_by_customer": TURNS,
        "customer_value_enriched": ENRICHED,
        "top_collection": f"""
            SELECT * FROM ({COLLECTION})
            ORDER BY collection_rate DESC NULLS LAST, hotel_id LIMIT 20""",
        "top_customers": f"""
            SELECT * FROM ({ENRICHED}) ORDER BY revenue_sum DESC NULLS LAST, customer_id LIMIT 20""",
        "dq_bad_values": f"""
            SELECT o_orderkey AS booking_id, o_orderstatus = 'P' AS dq_bad_checkin, false AS dq_bad_checkout,
                   false AS dq_swapped_dates,
                   CAST(o_orderdate AS DATE) + CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 0 END AS checkin_date,
                   CAST(o_orderdate AS DATE) + 3 AS checkout_date,
                   o_custkey % 10 = 0 AS dq_bad_total, false AS dq_negative_total,
                   CASE WHEN o_custkey % 10 <> 0 THEN {dollars(TOTAL_CENTS)} END AS total_amount
            FROM orders""",
        "dq_rules_skipped": f"""
            SELECT {ID} AS booking_id, CAST(o_orderdate AS DATE) AS checkin_date,
                   COALESCE(c_acctbal < 0, false) AS dq_negative_total,
                   CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS total_amount
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                          JOIN customer ON o_custkey = c_custkey""",
        "payments_status_in": f"""
            SELECT payment_id, {AMOUNT}, l_linestatus AS status
            FROM ({PAYMENTS.replace(' AS payment_id,', ' AS payment_id, l_linestatus,', 1)}) AS p
            WHERE {VALID} AND l_linestatus = 'O'""",
        "overlap_alerts_exclude_status": loose_pairs(
            "a.lo IS NOT NULL AND a.hi IS NOT NULL AND b.lo IS NOT NULL AND b.hi IS NOT NULL",
            "status IS DISTINCT FROM 'R'",
        ),
        "overlap_alerts_open": loose_pairs("true"),
        "layers_collection_rate": LAYER_COLLECTION,
        "layers_daily_revenue": LAYER_REVENUE,
        "layers_cancellation_rate": LAYER_CANCELLED,
        "layers_overbooking_alerts": f"""
            WITH stays AS ({LAYER_BOOKINGS})
            SELECT a.room_id, a.id AS booking_id_1, b.id AS booking_id_2,
                   GREATEST(a.lo, b.lo) AS overlap_start, LEAST(a.hi, b.hi) AS overlap_end
            FROM stays AS a JOIN stays AS b
              ON a.room_id = b.room_id AND a.id < b.id AND GREATEST(a.lo, b.lo) < LEAST(a.hi, b.hi)""",
        "layers_customer_value": LAYER_VALUE,
        "layers_customer_value_enriched": LAYER_ENRICHED,
        "layers_reviews_sentiment": f"""
            SELECT *, {LABEL} FROM (
                SELECT conv_id AS customer_id, {score('text')} AS sentiment_score FROM conversations)""",
        "report_daily_revenue": LAYER_REVENUE,
        "report_cancellation_rate": LAYER_CANCELLED,
        "report_top_collection": f"""
            SELECT * FROM ({LAYER_COLLECTION})
            ORDER BY collection_rate DESC NULLS LAST, hotel_id LIMIT 20""",
        "report_top_customers": f"""
            SELECT * FROM ({LAYER_ENRICHED}) ORDER BY revenue_sum DESC NULLS LAST, customer_id LIMIT 20""",
    }
