"""The corpus operators' queries: each reads its whole table under ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import best_fit, conversations, language, licenses, pii, repetition, toxicity
from .common import table
from .decontaminate import contamination
from .oracle import oracle_sql
from .packing import pack
from .simhash import near_duplicates
from .spotsigs import fingerprints
from .token_counts import count_tokens
from .warc import archive_round_trip


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents")).drop("signatures")


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(damaged, present_col="present")


def op13_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.collapse(repetition.plant_repetitions(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_licenses, op2_toxicity, op3_language, op4_simhash, op5_pii, op6_token_counts, op7_warc,
             op8_decontamination, op9_packing, op10_spotsigs, op11_best_fit, op12_conversations, op13_repetition)
    return {f.__name__: f for f in every}


__all__ = ["oracle_sql", "queries"]
