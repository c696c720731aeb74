"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` under ``folder`` cut to ``columns``, so that the scan reads only those."""
    frame = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def day_number(stamp: str):
    """Days since 1970-01-01 of a zone-less timestamp column."""
    return F.unix_date(F.col(stamp).cast("date")).cast("bigint")
