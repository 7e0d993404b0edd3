"""Registered queries of this folder, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (collocations, hard_negatives, kn_quality, lang_id, line_rules, orc_tokens, sentencepiece_codec,
                            simhash_gray, source_mix, spot_signatures, suffix_dedup, token_counts, winnowing)
from ledgerflow.llm.common import read_documents


def op1_kn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kn_quality.classify(read_documents(spark, sf_dir), kn_quality.read_labels(spark, sf_dir))
    return found.drop("tie")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_documents(spark, sf_dir))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean_lines(read_documents(spark, sf_dir), with_text=False)


def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.compare_with_edited(read_documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes, with the text that is left, so that what went can be seen; beside them what passages of 250
    bytes (about 50 words) that repeat cover, and the text without these."""
    shape = suffix_dedup.Shape(window=160, shorter=250)
    return suffix_dedup.dedup(read_documents(spark, sf_dir), with_text=True, shape=shape).drop("tie")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.learn_and_identify(read_documents(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_decode(read_documents(spark, sf_dir)).drop("n_corrected")


def op8_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.round_trip(read_documents(spark, sf_dir))


def op9_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles and four bits, as its contract says."""
    return simhash_gray.documents_by_component(read_documents(spark, sf_dir), words=4, bits=4)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(read_documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.shifted_labels(hard_negatives.prepare(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return hard_negatives.mine(rows, F.col("id") % hard_negatives.ANCHOR_EVERY == 0)


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_kn_quality, op2_token_counts, op3_line_rules, op4_spot_signatures, op5_suffix_dedup, op6_language_id, op7_sentencepiece, op8_orc_token_ids,
                            op9_simhash_gray, op10_source_mix, op11_hard_negatives, op12_winnowing, op13_collocations)}

ORACLES = {"op3_line_rules": line_rules.LINE_RULES_SQL, "op11_hard_negatives": hard_negatives.HARD_NEGATIVES_SQL,
           "op12_winnowing": winnowing.WINNOWING_SQL, "op13_collocations": collocations.COLLOCATIONS_SQL}
