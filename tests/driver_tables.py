"""The driver's smallest tables, as they are or with hot keys, copies and nulls."""

from __future__ import annotations

import glob
import os

SF_DIR = "/root/testdata/sf0.001"

# A third of the rows on one key, a third of some values missing.
CHANGES = {
    "lineitem": {
        "l_orderkey": "CASE WHEN n % 3 = 0 THEN 1 ELSE l_orderkey END",
        "l_partkey": "CASE WHEN n % 3 = 0 THEN 1 ELSE l_partkey END",
        "l_linenumber": "CASE WHEN n % 6 = 0 THEN 3 ELSE l_linenumber END",
        "l_returnflag": "CASE WHEN n % 5 = 0 THEN NULL ELSE l_returnflag END",
    },
    "orders": {
        "o_custkey": "CASE WHEN n % 3 = 0 THEN 5 ELSE o_custkey END",
        "o_orderpriority": "CASE WHEN n % 3 = 1 THEN 'x' ELSE o_orderpriority END",
        "o_orderdate": "CASE WHEN n % 3 = 2 THEN TIMESTAMP '1997-01-01' ELSE o_orderdate END",
        "o_totalprice": "CASE WHEN n % 4 = 0 THEN NULL ELSE o_totalprice END",
    },
    "customer": {
        "c_acctbal": "CASE WHEN n % 3 = 0 THEN NULL ELSE c_acctbal END",
        "c_mktsegment": "CASE WHEN n % 3 = 1 THEN NULL ELSE c_mktsegment END",
    },
    "events": {"user_id": "CASE WHEN n % 3 = 0 THEN 1 ELSE user_id END"},
    "conversations": {"conv_id": "CASE WHEN n % 3 = 0 THEN 1 ELSE conv_id END"},
    "documents": {
        "text": "CASE WHEN n % 3 = 0 THEN 'The the of a is' WHEN n % 5 = 0 THEN NULL ELSE text END"
    },
}


def table_paths(folder: str) -> dict[str, str]:
    found = glob.glob(f"{folder}/*.parquet")
    return {os.path.basename(path).removesuffix(".parquet"): path for path in found}


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for name, path in table_paths(folder).items():
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def write_skewed(target: str) -> None:
    db = connect(SF_DIR)
    for name in table_paths(SF_DIR):
        changed = ", ".join(f"{e} AS {c}" for c, e in CHANGES.get(name, {}).items())
        replace = f"REPLACE ({changed})" if changed else ""
        db.sql(
            f"COPY (SELECT * EXCLUDE (n) {replace} FROM "
            f"(SELECT *, row_number() OVER () AS n FROM {name})) "
            f"TO '{target}/{name}.parquet' (FORMAT parquet)"
        )
