"""Micro-batches: their execution, the Kafka topics they read, and where they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import names
from weftline.settings import JobSettings


def with_executions(progress: DataFrame, executions: DataFrame) -> DataFrame:
    """Progress records with the top execution of their micro-batch; a record without one is dropped."""
    top = executions.where("query_id is not null and execution_id = root_execution_id")
    found = top.groupBy("app_id", "query_id", "batch_id").agg(F.max("execution_id").alias("execution_id"))
    return progress.join(found, ["app_id", "query_id", "batch_id"])


def kafka_topics(progress: DataFrame, unique: bool = True) -> DataFrame:
    """Topics a micro-batch really read: those with a partition whose offset moved.

    ``sources`` is an array of structs with ``description, startOffset, endOffset``; offsets are JSON
    ``{"topic":{"partition":offset}}``.
    """
    offsets = "map<string,map<string,bigint>>"
    source = progress.select("app_id", "query_id", "batch_id", F.explode("sources").alias("s"))
    parsed = source.where(F.col("s.description").startswith("Kafka")).select(
        "app_id",
        "query_id",
        "batch_id",
        F.from_json("s.startOffset", offsets).alias("start"),
        F.from_json("s.endOffset", offsets).alias("end"),
    )
    moved = F.map_filter(
        "end",
        lambda topic, parts: F.exists(
            F.map_entries(parts),
            lambda p: p["value"] > F.coalesce(F.col("start")[topic][p["key"]], F.lit(0)),
        ),
    )
    topics = parsed.select("app_id", "query_id", "batch_id", F.explode(F.map_keys(moved)).alias("topic"))
    # Two sources of one query may share a topic. On a stream the caller removes the copies.
    return topics.distinct() if unique else topics


def kafka_edges(topics: DataFrame, clusters: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Input edges of topics; ``clusters(query_id, cluster)`` holds what a query's consumer settings name."""
    cluster = F.coalesce("cluster", F.lit(settings.cluster))
    return topics.join(clusters, "query_id", "left").select(
        "app_id",
        "query_id",
        "batch_id",
        F.lit("input").alias("direction"),
        F.lit(names.KAFKA_TOPIC).alias("type_name"),
        names.kafka_name(F.col("topic"), cluster).alias("qualified_name"),
    )
