"""A corpus pipeline over ``documents``: quality, language, near-duplicates, secrets, packing.

Each stage gets what the one before kept, as Parquet, and its decision takes effect: the first three
drop rows, the fourth masks secrets in the texts, the last cuts the texts into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import language, packing, quality, secrets, setsketch
from loadlens.llm.scratch import stored
from loadlens.llm.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose calibrated quality score is below the threshold.

    Null and empty texts are scored like others; without labels of both kinds all stay; no rows give no rows.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels")).select(COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null and empty texts too), and those unlike every learnt language: below the bar
    that held-out texts of that language and length set. Without any language to learn, texts with a letter stay."""
    return language.keep_known(docs).select(COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near-duplicates.

    A copy without an id goes if its group has an id; null, empty and blank texts are in no group; of repeated rows one stays.
    """
    return setsketch.keep_first(docs).select(COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; every document stays, ``n_chars`` follows the new text; null texts stay null."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens, balanced by attention cost; a null or empty text is its closing
    token alone, repeated rows are packed each."""
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Trained scores, sketches and byte-pair encoding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` of ``sf_dir``, each on what the one before kept, written and read again.

    Columns beside those of ``documents`` are dropped by the first stage; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
