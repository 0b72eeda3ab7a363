"""The registered queries of the text operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kiln.llm import divergence as terms
from kiln.llm import filter_audit as filters
from kiln.llm.common import table
from kiln.llm.decontamination import contaminated
from kiln.llm.html_extract import extract
from kiln.llm.language_id import identify
from kiln.llm.packing import pack
from kiln.llm.pii import personal_data
from kiln.llm.quality import quality
from kiln.llm.simhash import near_duplicates
from kiln.llm.suffix_dedup import remove_repeats
from kiln.llm.token_counts import token_counts
from kiln.llm.toxicity import toxicity
from kiln.llm.transducer import byte_bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.divergence(table(spark, sf_dir, "documents"))


@query
def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents"), RANKS)


ORACLE["op11_source_divergence"] = terms.ORACLE
ORACLE["op12_filter_interaction"] = filters.ORACLE
