"""A corpus pipeline: language, exact copies, near copies, mix, tokens.

Each stage reads what the one before it wrote.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelens.llm import exact_dedup, language_id, mixing, pieces, simhash
from tapelens.llm.common import shared_folder
from tapelens.llm.queries import MODEL

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fit no learned language go, by their code length, and so do texts without a letter.

    Learns from all rows with a language, under the operator's bound. Where no row has one, nothing is known against a
    text with a letter, and it stays. Null texts go.
    """
    return language_id.drop_unknown(docs, language_id.train(docs, F.lit(True)))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space; null texts count as empty ones."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies by five-word shingles; texts without words, and null ones, are one group."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Texts without words, and null ones, are never taken; null sources are one source."""
    return mixing.copies(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of ids and decoded text; a null text is empty."""
    return pieces.round_trip(docs, MODEL, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("simhash_near_dedup", drop_near),
    ("mixing", mix_sources),
    ("sentencepiece", tokens),
]

#: Trained models, fingerprints and random rounding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each is written as Parquet and read again."""
    folder = posixpath.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = posixpath.join(folder, f"{number}_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
