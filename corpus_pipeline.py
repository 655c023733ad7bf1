"""From raw documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns what it keeps with the
columns of ``documents``; the last returns the pieces of the packed sequences. ``run`` writes each stage's rows to the
shared folder and reads them back for the next, so a lost executor costs a stage's tasks, not the stages before.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm.langid import keep_known, train
from pagemart.llm.linededup import dedup_lines
from pagemart.llm.nearcopies import one_of_each
from pagemart.llm.packing import pack_documents
from pagemart.llm.quality import keep_good
from pagemart.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are too short, or repeat themselves too much, go."""
    return keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language that was learned, go. Learned from the rows themselves."""
    return keep_known(docs, train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in one of them; the length is that of the new text."""
    kept = dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 or more of their five-word shingles, directly or over others, one stays. Found by SimHash anchors."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: Language models, 64-bit text hashes and tokenizers have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
