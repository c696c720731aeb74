"""From raw documents to encoded ones: language, quality, near-duplicates, benchmark passages, pieces.

Each stage takes the documents its predecessor kept and drops those its operator rejects; the last encodes them.
Stages but the last give the columns of ``documents``. Rows without a ``doc_id`` pass the near-duplicate stage as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontam, langid, minhash, pieces, quality
from weftline.llm.common import table
from weftline.settings import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the model knows."""
    return langid.accepted(docs, langid.model_of(docs))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the quality classifier accepts."""
    return quality.accepted(docs, quality.model_of(docs))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document with the least doc_id."""
    dropped = minhash.classes(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that share no window of words with a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document."""
    return pieces.encoded(docs, pieces.pieces_of(spark))


STAGES = [("language", language), ("quality", good), ("near-duplicates", distinct), ("decontamination", uncontaminated), ("pieces", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
