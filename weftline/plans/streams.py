"""Queries over micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import paths
from weftline.operators import harvest
from weftline.plans import standin_sql as q
from weftline.settings import shared_dir
from weftline.sources import standins
from weftline.sources.tables import day_number, table
from weftline.streaming import log_stream, progress, suppress

TRIGGERS = 30
COLUMNS = ["query_id", "batch_id", "direction", "qualified_name"]


def stream_suppress(spark: SparkSession, folder: str) -> DataFrame:
    return suppress.suppress(standins.stream_edges(spark, folder).distinct()).select(*COLUMNS)


STREAM_SUPPRESS = (
    q.with_(q.STREAM_EDGES)
    + """, first_seen AS (SELECT query_id, direction, qualified_name, min(batch_id) AS batch_id FROM stream_edges GROUP BY 1, 2, 3)
SELECT DISTINCT query_id, batch_id, direction, qualified_name FROM stream_edges e WHERE EXISTS (
  SELECT 1 FROM first_seen f WHERE f.query_id = e.query_id AND f.batch_id = e.batch_id)"""
)


def stream_suppress_live(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming form over the whole event table, in files by the order of days, a trigger each, run to its end."""
    place = f"{shared_dir(spark)}/suppress-{uuid.uuid4()}"
    events, day = table(spark, folder, "events"), day_number("ts")
    low, high = events.agg(F.min(day), F.max(day)).first()
    width = -(-(high - low + 1) // TRIGGERS)
    for first in range(low, high + 1, width):  # one after the other: a file source takes the oldest files first
        events.where(day.between(first, first + width - 1)).coalesce(1).write.mode("append").parquet(f"{place}/events")
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{place}/events")
    edges = standins.stream_edges_of(raw)
    suppress.start(edges, f"{place}/state", f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{place}/out").select(*COLUMNS)


def progress_join(spark: SparkSession, folder: str) -> DataFrame:
    """Progress records with the execution of their micro-batch; two thirds have one."""
    number = F.col("event_id")
    executions = table(spark, folder, "events", "event_id", "user_id").where("event_id % 3 <> 2").select(
        standins.text("app-<n>", n=F.col("user_id") % 20).alias("app_id"),
        standins.text("q<n>", n=F.col("user_id")).alias("query_id"),
        number.alias("batch_id"),
        (number + 7).alias("execution_id"),
        (number + 7).alias("root_execution_id"),
    )
    joined = progress.with_executions(standins.progress(spark, folder), executions)
    return joined.select("app_id", "query_id", "batch_id", "execution_id")


PROGRESS_JOIN = """SELECT 'app-' || (user_id % 20) AS app_id, 'q' || user_id AS query_id, event_id AS batch_id,
  event_id + 7 AS execution_id FROM events WHERE event_id % 3 <> 2"""


def kafka_batch_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Topics each micro-batch really read, under the cluster its query's consumer names."""
    clusters = table(spark, folder, "events", "user_id").distinct().where("user_id % 2 = 0").select(
        standins.text("q<n>", n=F.col("user_id")).alias("query_id"), standins.text("C<n>", n=F.col("user_id") % 5).alias("cluster")
    )
    topics = progress.kafka_topics(standins.progress(spark, folder))
    return progress.kafka_edges(topics, clusters).select("app_id", "query_id", "batch_id", "type_name", "qualified_name")


KAFKA_BATCH_TOPICS = """SELECT 'app-' || (user_id % 20) AS app_id, 'q' || user_id AS query_id, event_id AS batch_id,
  'kafka_topic' AS type_name, t || '@' || CASE WHEN user_id % 2 = 0 THEN 'C' || (user_id % 5) ELSE 'primary' END AS qualified_name
FROM (SELECT event_id, user_id, event_type AS t FROM events WHERE event_id % 3 > 0 OR event_id % 5 = 0
  UNION ALL SELECT event_id, user_id, 'quiet' FROM events WHERE event_id % 5 = 0)"""


def sink_path(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of file sinks; console and other sinks give none."""
    rows = standins.progress(spark, folder).withColumn("path", harvest.sink_path(F.col("sink_description")))
    uri, plain = F.col("path"), F.col("plain")
    return paths.with_plain(rows.where("path is not null"), "path").select(
        "query_id",
        "batch_id",
        paths.path_type(uri).alias("type_name"),
        paths.path_qualified_name(uri, plain).alias("qualified_name"),
        paths.path_name(uri, plain).alias("name"),
    )


SINK_PATH = """SELECT 'q' || user_id AS query_id, event_id AS batch_id, 'hdfs_path' AS type_name,
  'hdfs://nn:8020/Out/' || user_id AS qualified_name, '/out/' || user_id AS name FROM events WHERE event_id % 3 = 0"""


def stream_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Lineage of streaming queries over a log whose lines come in files of any order, so that most plans and records meet triggers later."""
    place = f"{shared_dir(spark)}/lineage-{uuid.uuid4()}"
    lines = standins.log_lines(spark, folder).select("app_id", "run", "kind", "value")
    wanted = lines.where("kind in ('app_start', 'environment', 'progress') or value like '%runId%'")
    wanted.repartition(12, F.xxhash64("value")).write.parquet(f"{place}/lines")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", "4").parquet(f"{place}/lines")
    log_stream.start(stream, log_stream.LineageSink(f"{place}/state", f"{place}/out", buckets=8), f"{place}/checkpoint").awaitTermination()
    found = spark.read.option("basePath", f"{place}/out").parquet(f"{place}/out")
    return found.select("app_id", *COLUMNS[:3], "type_name", "qualified_name")


STREAM_LINEAGE = (
    q.with_(q.STATEMENTS)
    + """, batches AS (SELECT *, 'q' || (c % 90) AS query_id, CASE WHEN remote_hms THEN 'hive_table' ELSE 'spark_table' END AS table_type,
  CASE WHEN remote_hms THEN '' ELSE app_id || '.' END AS pre, CASE WHEN remote_hms THEN '@primary' ELSE '' END AS post
  FROM statements WHERE kind = 14 AND finished)
SELECT app_id, query_id, k AS batch_id, 'input' AS direction, table_type AS type_name, pre || 'db' || (c % 5) || '.src' || (c % 40) || post AS qualified_name FROM batches
UNION ALL SELECT app_id, query_id, k, 'input', 'hdfs_path', 'hdfs://nn:8020/Raw/' || (c % 100) FROM batches WHERE shape = 0
UNION ALL SELECT app_id, query_id, k, 'input', 'aws_s3_object', 's3://lake/in/' || (c % 7) FROM batches WHERE shape = 0
UNION ALL SELECT app_id, query_id, k, 'input', table_type, pre || 'db' || (c % 5) || '.h' || (c % 30) || post FROM batches WHERE shape = 1
UNION ALL SELECT app_id, query_id, k, 'output', 'hdfs_path', 'hdfs://nn:8020/Stream/' || (c % 90) FROM batches"""
)


QUERIES = {
    "stream_lineage": (stream_lineage, STREAM_LINEAGE),
    "stream_suppress": (stream_suppress, STREAM_SUPPRESS),
    "stream_suppress_live": (stream_suppress_live, STREAM_SUPPRESS),
    "progress_join": (progress_join, PROGRESS_JOIN),
    "kafka_batch_topics": (kafka_batch_topics, KAFKA_BATCH_TOPICS),
    "sink_path": (sink_path, SINK_PATH),
}
