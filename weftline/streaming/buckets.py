"""State of a stream as a table in hash buckets, of which a trigger reads and rewrites only those it needs.

Each trigger writes new versions of the buckets it changes under a folder of its own, and a list of the newest version of every
bucket. A repeated trigger starts from the list of the one before and overwrites what it wrote, so it gives the same result, and losing an
executor or the driver loses nothing. Old versions stay until the owner of the folder clears them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BucketTable:
    """Rows of ``schema`` under ``place``, dealt to ``buckets`` by ``keys``."""

    place: str
    schema: str
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def hit(self, *frames: DataFrame) -> list[int]:
        """Buckets of the frames' keys: at most all of them, however many rows."""
        found: set[int] = set()
        for frame in frames:
            found |= {r[0] for r in frame.select(self.bucket()).distinct().collect()}
        return sorted(found)

    def _versions(self, spark: SparkSession, trigger: int) -> dict[int, int]:
        if trigger == 0:
            return {}
        rows = spark.read.schema("bucket int, version long").parquet(f"{self.place}/newest/trigger={trigger - 1}").collect()
        return {r.bucket: r.version for r in rows}

    def read(self, spark: SparkSession, trigger: int, hit: list[int]) -> DataFrame:
        """Rows of the buckets as the trigger before left them."""
        versions = self._versions(spark, trigger)
        places = [f"{self.place}/version={versions[b]}/bucket={b}" for b in hit if b in versions]
        return spark.read.schema(self.schema).parquet(*places) if places else spark.createDataFrame([], self.schema)

    def write(self, trigger: int, rows: DataFrame, hit: list[int]) -> None:
        """``rows`` are from now on what the buckets ``hit`` hold."""
        spark, mine = rows.sparkSession, f"{self.place}/version={trigger}"
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(mine)
        filled = {r[0] for r in spark.read.schema(f"{self.schema}, bucket int").parquet(mine).select("bucket").distinct().collect()}
        versions = {b: v for b, v in self._versions(spark, trigger).items() if b not in hit} | dict.fromkeys(sorted(filled), trigger)
        newest = spark.createDataFrame(sorted(versions.items()), "bucket int, version long").coalesce(1)
        newest.write.mode("overwrite").parquet(f"{self.place}/newest/trigger={trigger}")
