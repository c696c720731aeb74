"""The queries of the operators over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import attribution, decontam, idfiles, langid, minhash, neighbours, ngram, phrases, pieces, preference, quality, repair, warc
from weftline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.by_line(table(spark, sf_dir, "documents"), attribution.encoder_of(spark))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), pieces.pieces_of(spark))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op7_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.scores(table(spark, sf_dir, "documents"))


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return preference.segments(turns, preference.neighbours(turns))


def op8_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.examples(preference.segments(*preference.retold(table(spark, sf_dir, "conversations"))))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages")))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repairs(table(spark, sf_dir, "conversations"))


def op12_idfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.digests(idfiles.write(table(spark, sf_dir, "documents"), idfiles.encoder_of(spark)))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    first = (op1_attribution, op2_pieces, op3_langid, op4_neighbours, op5_decontam, op6_minhash, op7_ngram, op8_preference, op8_examples, op9_quality)
    return {f.__name__: f for f in (*first, op10_warc, op11_repair, op12_idfiles, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op4_neighbours": neighbours.SQL, "op5_decontam": decontam.SQL, "op8_preference": preference.SQL, "op10_warc": warc.SQL, "op13_phrases": phrases.SQL}
