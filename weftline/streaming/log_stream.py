"""Lineage of streaming queries as a stream over their event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.operators import harvest
from weftline.sources import event_log
from weftline.settings import JobSettings
from weftline.streaming import progress as micro
from weftline.streaming.buckets import BucketTable


def stream_edges(
    lines: DataFrame,
    applications: DataFrame,
    clusters: DataFrame | None = None,
    settings: JobSettings = JobSettings(),
    late: str = "1 hour",
) -> DataFrame:
    """Edges of micro-batches from a stream of log lines; ``LineageSink`` is the form that loses nothing by lateness.

    A micro-batch's plan and its progress record are met in a stream-stream join; the join forgets
    executions that are ``late`` older than the newest ones, so its state stays bounded.
    ``applications`` is a table read from the logs beforehand.
    """
    started = event_log.started_executions(lines).where("query_id is not null and execution_id = root_execution_id")
    plans = harvest.facts(started, "event_time").withWatermark("event_time", late)
    done = event_log.query_progress(lines, with_time=True).withWatermark("progress_time", late)
    renamed = done.select(
        F.col("app_id").alias("p_app_id"),
        F.col("query_id").alias("p_query_id"),
        F.col("batch_id").alias("p_batch_id"),
        "sources",
        "sink_description",
        "progress_time",
    )
    same = (
        (F.col("app_id") == F.col("p_app_id"))
        & (F.col("query_id") == F.col("p_query_id"))
        & (F.col("batch_id") == F.col("p_batch_id"))
        & (F.col("progress_time") >= F.col("event_time") - F.expr(f"interval {late}"))
        & (F.col("progress_time") <= F.col("event_time") + F.expr(f"interval {late}"))
    )
    met = plans.join(renamed, same)
    return _edges(met, applications, clusters, None, settings)


BATCH = ["app_id", "query_id", "batch_id"]


def _edges(met: DataFrame, applications: DataFrame, clusters: DataFrame | None, sinks: DataFrame | None, settings: JobSettings) -> DataFrame:
    """Edges of micro-batches whose plan (``leaves``) and progress (``sources, sink_description``) are in one row."""
    leaf = met.select(*BATCH, F.inline_outer("leaves")).where("targets is not null")
    reads = leaf.select(*BATCH, F.lit("input").alias("direction"), F.inline("targets"))
    writes = met.select(
        *BATCH,
        F.lit("output").alias("direction"),
        F.lit(None).cast("string").alias("db"),
        F.lit(None).cast("string").alias("table"),
        harvest.sink_path(F.col("sink_description")).alias("path"),
    ).where("path is not null")
    columns = [*BATCH, "direction", "type_name", "qualified_name"]
    edges = harvest.identify(applications, reads.unionByName(writes), settings).select(*columns)
    if clusters is not None:
        topics = micro.kafka_topics(met.select(*BATCH, "sources"), unique=False)
        edges = edges.unionByName(micro.kafka_edges(topics, clusters, settings).select(*columns))
    if sinks is not None:
        named = met.select(*BATCH).join(sinks, "query_id").withColumn("direction", F.lit("output"))
        edges = edges.unionByName(named.select(*columns))
    return edges


class LineageSink:
    """``foreachBatch`` writer: edges of micro-batches from a stream of log lines, whatever order the lines come in.

    A plan waits for its progress record, a record for its plan, and both for the settings of their application, at any
    delay: what has not met is kept in tables in hash buckets under ``state``, of which a trigger reads those its keys are in. Each trigger
    writes the edges of what has met in it under ``out``. ``clusters(query_id, cluster)`` and ``sinks(query_id, type_name,
    qualified_name)`` hold what logs do not show: the cluster a consumer names, and Kafka topics and tables written.
    A plan that comes again after its batch has met stays in the table."""

    _PLANS = "app_id string, query_id string, batch_id long, leaves array<struct<targets:array<struct<db:string,table:string,path:string>>>>"
    _DONE = "app_id string, query_id string, batch_id long, sources array<struct<description:string,startOffset:string,endOffset:string>>, sink_description string"
    _PAIRS = f"{_DONE}, leaves array<struct<targets:array<struct<db:string,table:string,path:string>>>>"
    _LINES = "app_id string, kind string, value string"

    def __init__(self, state: str, out: str, clusters: DataFrame | None = None, sinks: DataFrame | None = None, settings: JobSettings = JobSettings(), buckets: int = 64):
        self.state, self.out, self.clusters, self.sinks, self.settings = state.rstrip("/"), out.rstrip("/"), clusters, sinks, settings
        self.plans = BucketTable(f"{self.state}/plans", self._PLANS, tuple(BATCH), buckets)
        self.done = BucketTable(f"{self.state}/progress", self._DONE, tuple(BATCH), buckets)
        self.waiting = BucketTable(f"{self.state}/waiting", self._PAIRS, ("app_id",), buckets)
        self.applications = BucketTable(f"{self.state}/applications", self._LINES, ("app_id",), buckets)

    def __call__(self, lines: DataFrame, trigger: int) -> None:
        spark = lines.sparkSession

        def kept(frame: DataFrame, name: str) -> DataFrame:
            place = f"{self.state}/trigger={trigger}/{name}"
            frame.write.mode("overwrite").parquet(place)
            return spark.read.schema(frame.schema).parquet(place)

        started = event_log.started_executions(lines).where("query_id is not null and execution_id = root_execution_id")
        known = harvest.facts(started).select(*BATCH, F.transform("leaves", lambda x: F.struct(x["targets"].alias("targets"))).alias("leaves"))
        plans = kept(known.to(_schema(spark, self._PLANS)), "plans")
        done = kept(event_log.query_progress(lines).to(_schema(spark, self._DONE)), "progress")
        told = kept(lines.where("kind in ('app_start', 'environment')").select("app_id", "kind", "value").distinct(), "told")

        hit = self.plans.hit(plans, done)
        plans = plans.unionByName(self.plans.read(spark, trigger, hit))
        done = done.unionByName(self.done.read(spark, trigger, hit))
        pairs = kept(done.join(plans, BATCH), "pairs")
        met = pairs.select(*BATCH).distinct()
        self.plans.write(trigger, plans.join(met, BATCH, "left_anti"), hit)
        self.done.write(trigger, done.join(met, BATCH, "left_anti"), hit)

        fresh, hit = self.applications.hit(told), self.applications.hit(told, pairs)
        told = told.unionByName(self.applications.read(spark, trigger, hit)).distinct()
        named = event_log.applications(told).join(told.where("kind = 'environment'").select("app_id").distinct(), "app_id", "left_semi")
        named = kept(named, "named")
        self.applications.write(trigger, told.where(self.applications.bucket().isin(fresh)), fresh)
        pairs = pairs.unionByName(self.waiting.read(spark, trigger, hit).select(*pairs.columns))
        self.waiting.write(trigger, pairs.join(named, "app_id", "left_anti"), hit)
        ready = pairs.join(named.select("app_id"), "app_id", "left_semi")
        edges = _edges(ready, named, self.clusters, self.sinks, self.settings).distinct()
        edges.write.mode("overwrite").parquet(f"{self.out}/trigger={trigger}")


def _schema(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema


def start(lines: DataFrame, sink: LineageSink, checkpoint: str, **trigger):
    """Run the sink on a stream of log lines; ``trigger`` as for ``DataStreamWriter.trigger``."""
    writer = lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
