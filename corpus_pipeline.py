"""From documents to training files: filter, deduplicate, decontaminate, mix, write token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the next stage's docs. The last stage reports the documents read back from its files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgemart.llm import decontaminate, jaccard_join, pfair_mix, quality_rules, repair_ids
from lodgemart.llm.components import written
from lodgemart.llm.queries import TOKENIZER, load
from lodgemart.sources.scratch import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    model = quality_rules.train(docs, load(spark, sf_dir, "labels"))
    return quality_rules.keep_rows(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return jaccard_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes their sources to the target weights."""
    return pfair_mix.mix_rows(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files in the order of the documents' files; the documents as read back from them."""
    out = scratch_path(spark, "training-ids")
    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:  # rows that don't come from files have no order of their own
        order = None
    repair_ids.write_ids(docs, out, TOKENIZER, order=order)
    return repair_ids.read_ids(spark, out, with_ids=False)


STAGES = [
    ("quality_rules", keep_quality),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("source_mixing", mix_sources),
    ("token_ids", write_token_ids),
]

# Trained weights and connected components have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
