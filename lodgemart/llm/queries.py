"""The registered queries of this subpackage over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodgemart.llm import (
    attention_lm,
    chat_collapse,
    decontaminate,
    jaccard_join,
    license_scan,
    passage_attention,
    pfair_mix,
    pii_spans,
    quality_rules,
    ranked_search,
    repair_ids,
    token_prefix,
    turn_repair,
)
from lodgemart.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(load(spark, sf_dir, "documents"), TOKENIZER)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality_rules.train(docs, load(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, model)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefix.count_tokens(load(spark, sf_dir, "documents"), TOKENIZER)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix.mix_ids(load(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(load(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.collapse_and_render(load(spark, sf_dir, "conversations"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = passage_attention.train(docs, load(spark, sf_dir, "labels"))
    return passage_attention.score_documents(docs, model)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-ids")
    repair_ids.write_ids(load(spark, sf_dir, "documents"), out, TOKENIZER)
    return repair_ids.read_ids(spark, out, with_ids=False)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digest(load(spark, sf_dir, "conversations"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans.digest(pii_spans.find_spans(load(spark, sf_dir, "documents")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.best_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_quality_rules": op3_quality_rules,
        "op4_token_counts": op4_token_counts,
        "op5_source_mixing": op5_source_mixing,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_license_scan": op7_license_scan,
        "op8_chat_formatting": op8_chat_formatting,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_token_ids": op10_token_ids,
        "op11_turn_repair": op11_turn_repair,
        "op12_pii": op12_pii,
        "op13_ranked_search": op13_ranked_search,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op8_chat_formatting": chat_collapse.COLLAPSE_SQL,
        "op11_turn_repair": turn_repair.REPAIR_SQL,
        "op13_ranked_search": ranked_search.SEARCH_SQL,
    }
