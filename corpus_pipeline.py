"""The corpus pipeline: documents to packed training sequences.

Each stage is one operator over all that the stage before kept, written as
Parquet and read again.  All stages but the last return the columns of
``documents``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake.llm import jaccard, line_dedup, mixing, packing, toxicity
from nutrilake.llm.common import written
from nutrilake.llm.queries import tokenizer_path
from nutrilake.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents predicted toxic go."""
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return model.score(docs).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: lines that three or more documents share stay in one of them."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of near copies stays."""
    return jaccard.one_per_component(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents repeated to their source's target."""
    return mixing.mix_documents(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every copy of every document packed into sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("near_duplicates", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

# SQL has neither the classifier nor the tokenizer; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
