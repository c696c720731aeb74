"""Streaming lineage over lines in any order: what is late is met, what is repeated changes nothing."""

import json

from pyspark.sql import functions as F

from weftline.sources import event_log
from weftline.streaming.buckets import BucketTable
from weftline.streaming.log_stream import LineageSink

PLAN = """== Physical Plan ==
* Project (2)
+- Scan parquet (1)


(1) Scan parquet
Location: InMemoryFileIndex [file:/in%d]

(2) Project
Output [1]: [x#1]

"""
LINES = "app_id string, run int, kind string, value string"


def plan(batch):
    said = f"\nid = q\nrunId = r\nbatch = {batch}"
    return ("app", 1, "sql_start", json.dumps({"Event": event_log.SQL_START, "executionId": batch, "description": said, "physicalPlanDescription": PLAN % batch, "time": 1}))


def progress(batch):
    source = {"description": "KafkaV2[Subscribe[t]]", "startOffset": json.dumps({"t": {"0": batch}, "still": {"0": 5}}), "endOffset": json.dumps({"t": {"0": batch + 1}, "still": {"0": 5}})}
    record = {"id": "q", "batchId": batch, "timestamp": "2026-01-01T00:00:00Z", "sources": [source], "sink": {"description": "FileSink[file:/out]"}}
    return ("app", 1, "progress", json.dumps({"Event": event_log.QUERY_PROGRESS, "progress": record}))


APP = [("app", 1, "app_start", json.dumps({"Event": event_log.APP_START, "App Name": "n", "App ID": "app", "User": "u"})), ("app", 1, "environment", json.dumps({"Event": event_log.ENVIRONMENT, "Spark Properties": {}, "Hadoop Properties": {}}))]


def edges_of(batch):
    return {(batch, "input", "file:/in%d" % batch), (batch, "output", "file:/out"), (batch, "input", "t@C"), (batch, "output", "sent@primary")}


def test_late_lines_are_met(spark, tmp_path):
    """Records before plans, plans before records, the application's own lines last, and a trigger that runs twice."""
    clusters = spark.createDataFrame([("q", "C")], "query_id string, cluster string")
    sinks = spark.createDataFrame([("q", "kafka_topic", "sent@primary")], "query_id string, type_name string, qualified_name string")
    sink = LineageSink(f"file://{tmp_path}/state", f"file://{tmp_path}/out", clusters, sinks, buckets=4)

    def run(trigger, rows):
        sink(spark.createDataFrame(rows, LINES), trigger)
        found = spark.read.schema("batch_id long, direction string, qualified_name string").parquet(f"file://{tmp_path}/out/trigger={trigger}")
        return {tuple(r) for r in found.collect()}

    assert run(0, [plan(1), plan(2), progress(3)]) == set()
    assert run(1, [progress(1)]) == set()  # met, but of an unknown application
    assert run(2, [*APP, plan(3)]) == edges_of(1) | edges_of(3)
    last = [progress(2), plan(4), progress(4)]
    assert run(3, last) == edges_of(2) | edges_of(4)
    assert run(3, last) == edges_of(2) | edges_of(4)
    left = sink.plans.read(spark, 4, list(range(4))).count() + sink.done.read(spark, 4, list(range(4))).count() + sink.waiting.read(spark, 4, list(range(4))).count()
    assert left == 0


def test_a_trigger_reads_only_the_buckets_it_needs(spark, tmp_path):
    state = BucketTable(f"file://{tmp_path}/t", "k long, v string", ("k",), 16)
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    state.write(0, rows, list(range(16)))
    hit = state.hit(rows.where("k = 7"))
    assert len(hit) == 1
    own = state.read(spark, 1, hit)
    assert 0 < own.count() < 60 and len(own.inputFiles()) == 1
    state.write(1, own.where("k <> 7"), hit)
    assert state.read(spark, 2, list(range(16))).count() == 199
    assert state.read(spark, 1, list(range(16))).count() == 200
    state.write(1, own.limit(0), hit)  # the trigger again, with another end
    assert state.read(spark, 2, hit).count() == 0
