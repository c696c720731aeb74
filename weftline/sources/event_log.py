"""Spark event logs as tables.

A log line is one JSON event. ``read_lines`` keeps only the kinds used here, by a prefix test that
runs before any JSON parsing. ``stage`` writes the events once as typed Parquet tables; jobs over a
large fleet read those, so that they scan only the kinds and columns they need.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import names
from weftline.functions.values import once

# Event names as Spark writes them.
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
QUERY_PROGRESS = "org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent"
APP_START = "SparkListenerApplicationStart"
ENVIRONMENT = "SparkListenerEnvironmentUpdate"
CATALOG_PACKAGE = "org.apache.spark.sql.catalyst.catalog."
ML_PACKAGE = "org.apache.spark.ml."

_START = """Event string, executionId bigint, rootExecutionId bigint, description string,
    physicalPlanDescription string, time bigint"""
_END = "executionId bigint, errorMessage string, time bigint"
_CATALOG = "Event string, database string, name string, newName string, kind string"
_ML = "Event string, uid string, directory string, datasetExecutionId bigint"
_APP = "`App Name` string, `App ID` string, `User` string"
_PROGRESS = """progress struct<id:string, batchId:bigint, timestamp:string,
    sources:array<struct<description:string, startOffset:string, endOffset:string>>,
    sink:struct<description:string>>"""
_ENVIRONMENT = "`Spark Properties` map<string,string>, `Hadoop Properties` map<string,string>"
# The file lists of a plan's scans, whole where the producer lets them be (the printed plan never shows more than one).
_LOCATIONS = r'"Location"\s*:\s*"(\w+\(\d+ paths?\)\[[^"]*\])"'


_KINDS = {SQL_START: "sql_start", SQL_END: "sql_end", QUERY_PROGRESS: "progress", APP_START: "app_start", ENVIRONMENT: "environment"}
LEADING = 200
_UNREAD = "_unread"


def kind_of(line: Column) -> Column:
    """Kind of a log line by its leading event name, null for kinds not used.

    The name is looked for in the line's first characters, and by JSON only where it is not whole there."""
    leading = F.regexp_extract(F.substring(line, 1, LEADING), r'^\s*\{\s*"Event"\s*:\s*"([^"]+)"', 1)
    exact = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])

    def kind(event: Column) -> Column:
        grouped = F.when(event.startswith(CATALOG_PACKAGE), "catalog").when(event.startswith(ML_PACKAGE), "ml")
        return F.coalesce(F.try_element_at(exact, event), grouped)

    event = once(leading, lambda x: F.when(x != "", x).otherwise(F.get_json_object(line, "$.Event")))
    # Most lines of the kinds used end at the first look, which is compiled; the second is not.
    return F.when(line.isNotNull(), F.coalesce(F.try_element_at(exact, leading), once(event, kind)))


# An application that is started again counts its executions from 0 again. Its runs are told apart by what they add to
# execution ids: nothing in the first run, this in the second, and so on.
RUN_SPAN = 1 << 40


def in_run(execution_id: Column, run: Column) -> Column:
    """The id of an execution among all runs of its application."""
    return execution_id + (run - 1) * RUN_SPAN


def run_of(execution_id: Column) -> tuple[Column, Column]:
    """The run of an execution, and its id in that run."""
    return (F.floor(execution_id / RUN_SPAN) + 1).cast("int"), F.pmod(execution_id, F.lit(RUN_SPAN))


def file_run(path: Column) -> Column:
    """The run whose log a file is: on YARN the attempt after the application's id, else the first."""
    attempt = F.regexp_extract(path, r"application_\d+_\d+_(\d+)(\.[a-z0-9.]+)?$", 1)
    return F.when(path.contains("application_"), F.coalesce(F.nullif(attempt, F.lit("")).cast("int"), F.lit(1))).otherwise(1)


def file_app_and_number(path: Column) -> tuple[Column, Column]:
    """Application and number of a log file. A rolled file is named ``events_<n>_<app>``, a single-file log by its
    application; on YARN an attempt follows the id, see ``file_run``; compaction and compression add endings."""
    # A pattern is tried only where it can match: this runs for every line.
    file_name = _file_name(path)
    rolled = file_name.startswith("events_")
    number = F.when(rolled, F.nullif(F.regexp_extract(file_name, r"^events_(\d+)_", 1), F.lit("")).cast("bigint"))
    whole = F.when(rolled, F.regexp_replace(file_name, r"^events_\d+_", "")).otherwise(file_name)
    bare = F.when(file_name.contains("."), F.regexp_replace(whole, r"(\.(compact|inprogress|lz4|lzf|zstd|snappy))+$", "")).otherwise(whole)
    app = F.when(file_name.contains("application_"), F.regexp_replace(bare, r"^(application_\d+_\d+)_\d+$", "$1")).otherwise(bare)
    return app, F.coalesce(number, F.lit(1).cast("bigint"))


def _file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _is_log(path: Column) -> Column:
    """Not the marker of an application's state, which lies beside its rolled files."""
    return ~_file_name(path).startswith("appstatus_")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``app_id, run, seq, kind, value`` of the logs under ``path`` (a folder or a glob).

    ``seq`` orders the lines of one application: run, file number, place of the split in its file
    (splits are far larger than a megabyte), row within the split.
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 28) - 1))
    split = F.shiftright(F.col("_metadata.file_block_start"), 20)
    return lines_of(raw.select(F.col("_metadata.file_path").alias("file"), (split * (1 << 28) + row).alias("place"), "value"))


def lines_of(raw: DataFrame) -> DataFrame:
    """``app_id, run, seq, kind, value`` of raw lines with their ``file`` and their ``place`` in it.

    ``seq`` leaves room for 63 runs, 65,535 rolled files of each, and 4 GB in a rolled file or 65 TB in a log's only one."""
    app, number = file_app_and_number(F.col("file"))
    run = file_run(F.col("file"))
    seq = run * F.lit(1 << 56) + number * F.lit(1 << 40) + F.col("place")
    return (
        raw.where(_is_log(F.col("file")))
        .select(app.alias("app_id"), run.alias("run"), seq.alias("seq"), kind_of(F.col("value")).alias("kind"), "value")
        .where("kind is not null")
    )


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """``app_id, run, kind, value`` as a stream. Spark rolls log files, so a finished file never changes."""
    reader = spark.readStream.option("maxFilesPerTrigger", str(files_per_trigger))
    raw = reader.option("recursiveFileLookup", "true").text(path)
    file = F.col("_metadata.file_path")
    app, _ = file_app_and_number(file)
    found = raw.where(_is_log(file)).select(app.alias("app_id"), file_run(file).alias("run"), kind_of(F.col("value")).alias("kind"), "value")
    return found.where("kind is not null")


def _of_kind(lines: DataFrame, kind: str, schema: str) -> DataFrame:
    # A malformed line parses to nulls; it then matches nothing and stops nothing. Staged lines have their event in a column of its kind.
    return lines.where(F.col("kind") == kind).withColumn("e", F.col(kind) if kind in lines.columns else F.from_json("value", schema))


def _locations() -> Column:
    return F.regexp_extract_all("value", F.lit(_LOCATIONS), F.lit(1)).alias("locations")


def _broken() -> Column:
    return F.get_json_object("value", "$.Event").isNull()


def _execution(lines: DataFrame, number: Column) -> Column:
    """The id among all runs of the application; lines without a run are of the first."""
    return in_run(number, F.col("run")) if "run" in lines.columns else number


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Lines of a known kind that are not JSON, for the bad-record table."""
    broken = lines.where("value is not null") if "locations" in lines.columns else lines.where(_broken())
    return broken.select("app_id", F.lit(None).cast("bigint").alias("execution_id"), F.lit("malformed event").alias("reason"), F.col("value").alias("detail"))


def applications(lines: DataFrame) -> DataFrame:
    """One row per application: name, user and the catalog settings its names depend on."""
    started = _of_kind(lines, "app_start", _APP).groupBy("app_id").agg(
        F.max("e.App Name").alias("app_name"), F.max("e.User").alias("user")
    )

    spark, hadoop = F.col("e.Spark Properties"), F.col("e.Hadoop Properties")

    def hadoop_entry(key: str) -> Column:
        # A Hadoop setting may be given through Spark's, under a prefix.
        return F.max(F.coalesce(F.try_element_at(hadoop, F.lit(key)), F.try_element_at(spark, F.lit(f"spark.hadoop.{key}"))))

    settings = _of_kind(lines, "environment", _ENVIRONMENT).groupBy("app_id").agg(
        F.max(F.try_element_at(spark, F.lit(names.CATALOG_IMPLEMENTATION))).alias("implementation"),
        hadoop_entry(names.METASTORE_URIS).alias("metastore_uris"),
        hadoop_entry(names.CONNECTION_DRIVER).alias("connection_driver"),
        hadoop_entry(names.CONNECTION_URL).alias("connection_url"),
    )
    joined = started.join(settings, "app_id", "left")
    prefix = names.catalog_prefix(
        F.col("app_id"),
        F.col("implementation"),
        F.col("metastore_uris"),
        F.col("connection_driver"),
        F.col("connection_url"),
    )
    remote = names.is_remote(F.col("implementation"), F.col("metastore_uris"))
    return joined.select("app_id", "app_name", "user", prefix.alias("prefix"), remote.alias("remote_hms"))


def started_executions(lines: DataFrame) -> DataFrame:
    """Every started execution, with the streaming query and batch its description names."""
    query = F.regexp_extract("e.description", r"(?m)^id = (\S+)$", 1)
    batch = F.regexp_extract("e.description", r"(?m)^batch = (\d+)$", 1)
    return _of_kind(lines, "sql_start", _START).select(
        "app_id",
        *(["seq"] if "seq" in lines.columns else []),
        _execution(lines, F.col("e.executionId")).alias("execution_id"),
        _execution(lines, F.coalesce("e.rootExecutionId", "e.executionId")).alias("root_execution_id"),
        F.when(F.length(query) > 0, query).alias("query_id"),
        F.when(F.length(batch) > 0, batch).cast("bigint").alias("batch_id"),
        F.timestamp_millis("e.time").alias("event_time"),
        F.col("e.description").alias("description"),
        F.col("e.physicalPlanDescription").alias("plan"),
        F.col("locations") if "locations" in lines.columns else _locations(),
    )


def ended_executions(lines: DataFrame) -> DataFrame:
    return _of_kind(lines, "sql_end", _END).select(
        "app_id",
        _execution(lines, F.col("e.executionId")).alias("execution_id"),
        (F.coalesce("e.errorMessage", F.lit("")) != "").alias("failed"),
        F.timestamp_millis("e.time").alias("end_time"),
    )


def statement_times(started: DataFrame, ended: DataFrame) -> DataFrame:
    """When executions began and ended, in milliseconds: ``app_id, execution_id, began, ended``."""
    began = started.select("app_id", "execution_id", F.unix_millis("event_time").alias("began"))
    over = ended.groupBy("app_id", "execution_id").agg(F.max(F.unix_millis("end_time")).alias("ended"))
    return began.join(over, ["app_id", "execution_id"])


def successful_executions(started: DataFrame, ended: DataFrame) -> DataFrame:
    """Executions that ended without an error and belong to a statement that did.

    A failed or unfinished statement leaves no lineage, even where a part of it succeeded. ``started`` is any
    table with the ids of executions. Give it the facts of plans, not their text, which would be shuffled.
    """
    ids = started.select("app_id", "execution_id", "root_execution_id")
    # Not made distinct: for semi joins it need not be, and it would be shuffled by one order of its keys more.
    good = ended.where("not failed").select("app_id", "execution_id")
    roots = good.withColumnRenamed("execution_id", "root_execution_id")
    # The number first: sorts look at the first key first, and few applications have many executions.
    kept = ids.join(good, ["execution_id", "app_id"], "left_semi").join(
        roots, ["root_execution_id", "app_id"], "left_semi"
    )
    met = started.join(kept.select("app_id", "execution_id"), ["execution_id", "app_id"], "left_semi")
    return met.select("app_id", "execution_id", *[x for x in started.columns if x not in ("app_id", "execution_id")])


def batch_executions(started: DataFrame, ended: DataFrame) -> DataFrame:
    """Successful executions that belong to no streaming query."""
    return successful_executions(started.where("query_id is null"), ended)


def catalog_events(lines: DataFrame) -> DataFrame:
    """Catalog events. ``seq`` orders the events of one application by place in its log."""
    event = F.replace(F.col("e.Event"), F.lit(CATALOG_PACKAGE), F.lit(""))
    return _of_kind(lines, "catalog", _CATALOG).select(
        "app_id",
        "seq",
        F.regexp_replace(event, "Event$", "").alias("event"),
        F.col("e.database").alias("db"),
        F.col("e.name").alias("name"),
        F.col("e.newName").alias("new_name"),
        F.col("e.kind").alias("kind"),
    )


def ml_events(lines: DataFrame) -> DataFrame:
    """Machine-learning events, where a producer logs them as JSON under their class name."""
    event = F.regexp_extract("e.Event", r"([A-Za-z]+)Event$", 1)
    return _of_kind(lines, "ml", _ML).select(
        "app_id",
        "seq",
        event.alias("event"),
        F.col("e.uid").alias("uid"),
        F.col("e.directory").alias("directory"),
        _execution(lines, F.col("e.datasetExecutionId")).alias("dataset_execution_id"),
    )


def query_progress(lines: DataFrame, with_time: bool = False) -> DataFrame:
    """One row per finished micro-batch with its sources and sink."""
    time = [F.col("e.progress.timestamp").cast("timestamp").alias("progress_time")] if with_time else []
    return _of_kind(lines, "progress", _PROGRESS).select(
        "app_id",
        F.col("e.progress.id").alias("query_id"),
        F.col("e.progress.batchId").alias("batch_id"),
        F.col("e.progress.sources").alias("sources"),
        F.col("e.progress.sink.description").alias("sink_description"),
        *time,
    )


@dataclass(frozen=True)
class EventLog:
    """The events of a set of logs, one table per kind."""

    started: DataFrame
    ended: DataFrame
    progress: DataFrame
    catalog: DataFrame
    ml: DataFrame
    applications: DataFrame
    malformed: DataFrame

    def executions(self) -> DataFrame:
        """All successful executions, batch and streaming."""
        return successful_executions(self.started, self.ended)


def from_lines(lines: DataFrame) -> EventLog:
    """The event tables computed from log lines each time they are read."""
    return EventLog(
        started_executions(lines),
        ended_executions(lines),
        query_progress(lines),
        catalog_events(lines),
        ml_events(lines),
        applications(lines),
        malformed_lines(lines),
    )


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Lines with their event in a column of its kind, null in lines of other kinds; the text stays in ``value`` where it is not JSON."""
    kinds = {"sql_start": _START, "sql_end": _END, "progress": _PROGRESS, "catalog": _CATALOG, "ml": _ML, "app_start": _APP, "environment": _ENVIRONMENT}

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    # Only a line that did not parse to its schema may be broken, so only such a line is read a second time to tell.
    events = [of(kind, F.from_json("value", f"{schema}, {_UNREAD} string", {"columnNameOfCorruptRecord": _UNREAD})).alias(kind) for kind, schema in kinds.items()]
    keys = [x for x in lines.columns if x != "value"]
    unread = F.coalesce(*[F.col(kind)[_UNREAD] for kind in kinds]).isNotNull()
    read = lines.select(*keys, "value", *events)
    plain = [F.col(kind).dropFields(_UNREAD).alias(kind) for kind in kinds]
    return read.select(*keys, *plain, of("sql_start", _locations()).alias("locations"), F.when(unread, F.when(_broken(), F.col("value"))).alias("value"))


def stage(lines: DataFrame, target: str) -> EventLog:
    """Write the event tables under ``target`` and return them as written.

    One pass parses each line and writes one table for all kinds, with columns of their own, so that the text is neither sorted by kind nor
    written and read again; a job reads the columns of the kind it uses.
    """
    spark = lines.sparkSession
    parsed_lines(lines).write.mode("overwrite").parquet(f"{target}/events")
    applications(spark.read.parquet(f"{target}/events")).write.mode("overwrite").parquet(f"{target}/applications")
    return read_staged(spark, target)


def read_staged(spark: SparkSession, target: str) -> EventLog:
    return replace(from_lines(spark.read.parquet(f"{target}/events")), applications=spark.read.parquet(f"{target}/applications"))
