"""Connected components of an edge table, without collecting anything.

Alternating large-star and small-star steps: each step replaces edges by edges to a smaller
neighbour and keeps the components; a few steps leave every node tied to the smallest of its
component. Steps are aggregations and joins; each result is written to the shared folder, which
cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgemart.operators.skew import left_lookup
from lodgemart.sources.scratch import scratch_path

#: Tasks, at most, that the edges of one node are dealt over.
HUB_PLACES = 16


def written(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder, compressed by the session's codec or a given one, and read back."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def smallest(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with the smallest neighbour ``m`` of their ``a``; a hub's edges are dealt over many tasks."""
    return left_lookup(edges, least.withColumnRenamed("a", "_hub"), "a", "_hub", HUB_PLACES)


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (a, b) that isn't its own root; the root is the smallest."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), purpose)
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = smallest(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = smallest(large, lower).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(lower.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, purpose)
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
