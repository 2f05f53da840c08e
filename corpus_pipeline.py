"""A corpus from raw documents: language, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir), works on every row and returns a DataFrame, which
is written as Parquet and read again as the next stage's documents. All but the last return
the columns of the documents, extra ones included; the last returns one row per packed piece.

Defined results, stage by stage: a NULL text, an empty one and one without letters has no
language and goes in the first stage. Long texts are read whole everywhere. Of equal texts,
repeated rows included, and of texts with near fingerprints the smallest id stays, a NULL id
being below all others among equal texts; near copies without id all stay. Ties in length go
by id when packing. NULL in any other column changes nothing. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowtally.llm import exact_dedup, language, packing, simhash
from flowtally.session import staged

#: A language must have this many times the likelihood share of chance; texts without a letter have none.
LEAST_LIFT = 1.1


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is identified."""
    return language.keep_identified(docs, language.fit(docs), lift=LEAST_LIFT)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near fingerprints."""
    return simhash.without_near_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents, by words, into bins without conflicts."""
    return packing.pack(packing.word_lengths(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # language scores and XXH64 have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each reading what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
