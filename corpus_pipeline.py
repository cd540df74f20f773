"""From raw documents to packed token sequences.

Each stage takes what its predecessor kept, written as Parquet and read again:
toxic documents go, one document of each group of near-duplicates stays,
documents that hold benchmark passages go, personal data is replaced, and the
texts are cut and packed into token sequences. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import pii, toxicity
from tollgate.llm.common import table, written
from tollgate.llm.decontaminate import decontaminate
from tollgate.llm.packing import pack
from tollgate.llm.simhash import deduplicate
from tollgate.session import bound_batches, release_scratch, scratch_folders, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the model is fitted on the labelled ones among ``docs``.
    Null, empty and very long texts are scored like others; each of several equal rows
    is judged by itself; columns stay as they are, with any name; an empty table, or
    one without labels, loses nothing."""
    bound_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that SimHash links join, the document with the smallest id stays,
    of several rows with that id one. Null and empty texts have fingerprint zero and are
    a group; long texts are read whole; a null id is the last to stay; columns stay as
    they are, with any name; an empty table stays empty."""
    ship_package(spark)
    bound_batches(spark)
    return deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go: a word is hit, and at least one in 20.
    Null and empty texts have no words and stay; long texts are scanned whole; equal rows
    go or stay together; columns stay as they are, with any name; an empty table, or
    benchmark, loses nothing."""
    bound_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans are replaced by their kind, and n_chars follows the text. Null texts stay
    null (and keep their n_chars), empty ones empty; long texts are searched whole; equal
    rows stay equal; other columns stay as they are, with any name; an empty table stays
    empty."""
    ship_package(spark)
    bound_batches(spark)
    redacted = pii.redact(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        redacted = redacted.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return redacted


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and offset. Null and empty
    texts are a piece of one token; long texts are cut; each of several equal rows is a
    document; other columns, with any name, are left out; an empty table gives no rows."""
    ship_package(spark)
    bound_batches(spark)
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("packing", pack_sequences),
]

#: Boosted trees and token ids have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the
    shared folder and read again. Once it is written, what its stage and the one
    before left in that folder goes."""
    docs, before = table(spark, sf_dir, "documents"), scratch_folders()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "pipeline-" + name.lower().replace(" ", "-"))
            release_scratch(spark, [p for p in scratch_folders() if p not in before][:-1])
    return docs
