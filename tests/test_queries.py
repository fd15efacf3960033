"""The registered queries against their SQL twins, on plain and on skewed tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as registry
from bindings.oracle import all_oracles
from bindings.queries import all_queries
from driver_tables import SF_DIR, connect, write_skewed

QUERIES, ORACLES = all_queries(), all_oracles()

pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")


@pytest.fixture(scope="module", params=["plain", "skewed"])
def tables(request, tmp_path_factory):
    folder = SF_DIR
    if request.param == "skewed":
        folder = str(tmp_path_factory.mktemp("skewed"))
        write_skewed(folder)
    return folder, connect(folder)


def in_order(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in found)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    folder, db = tables
    df, answer = QUERIES[name](spark, folder), db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(answer.columns)
    mine = in_order(df.columns, [tuple(r) for r in df.collect()])
    assert mine == in_order(answer.columns, answer.fetchall())
    assert mine


def test_registry_holds_them():
    assert set(QUERIES) <= set(registry.queries())
    assert set(ORACLES) <= set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_stages_follow_their_tables(spark, tmp_path):
    """Tables rewritten under the same path give new results, from the stages that they touch."""
    write_skewed(str(tmp_path))
    names = ("layers_daily_revenue", "layers_reviews_sentiment")

    def check():
        db = connect(str(tmp_path))
        for name in names:
            df, answer = QUERIES[name](spark, str(tmp_path)), db.sql(ORACLES[name])
            found = in_order(df.columns, [tuple(r) for r in df.collect()])
            assert found == in_order(answer.columns, answer.fetchall())
        return found

    before = check()
    half = spark.read.parquet(f"{tmp_path}/orders.parquet").where("o_orderkey % 2 = 0").toPandas()
    half.to_parquet(f"{tmp_path}/orders.parquet", coerce_timestamps="us", index=False)
    assert check() == before


@pytest.mark.parametrize("hidden", ["public_tokenizers", "lodgemart.llm", "corpus_pipeline"])
def test_queries_without_optional_parts(hidden):
    """In a process that can't import a part, the others are all there."""
    code = (
        "import sys\n"
        f"sys.modules['{hidden}'] = None\n"
        "import __spark_entry__ as entry\n"
        "print(sorted(entry.queries()), sorted(entry.oracle_sql()))"
    )
    root = os.path.dirname(os.path.abspath(registry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert all(f"'{name}'" in out.stdout for name in QUERIES)
    assert "'pipeline'" not in out.stdout and ("'op1_" in out.stdout) == (hidden == "corpus_pipeline" and registry.LLM is not None)
