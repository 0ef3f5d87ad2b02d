"""Registered queries of the training-data operators: ``opN_<name> -> (spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import group
    return group(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge
    return judge(table(spark, sf_dir, "pages"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import neighbours
    return neighbours(table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import encode_table
    return encode_table(table(spark, sf_dir, "documents"), ids=False, digests=True)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify
    return identify(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip
    return round_trip(table(spark, sf_dir, "pages"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import compare
    return compare(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import rate
    return rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import report
    return report(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import report
    return report(table(spark, sf_dir, "conversations"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import report
    return report(table(spark, sf_dir, "conversations"))


def all_queries() -> dict[str, QueryFn]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def all_sql() -> dict[str, str]:
    from . import oracle
    return {k: v for k, v in vars(oracle).items() if k in all_queries()}
