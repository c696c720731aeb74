"""What differs between real logs: file names, settings, attempts, scans of several paths, odd lines."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from weftline.functions import plan_text as pt
from weftline.operators import harvest
from weftline.settings import shared_dir
from weftline.sources import event_log


def start(app, **more):
    return json.dumps({"Event": event_log.APP_START, "App Name": "n", "App ID": app, "User": "u"} | more)


def write(folder, files):
    for name, lines in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")


def test_files_of_all_managers_are_read(spark, tmp_path):
    yarn, alone = "application_1700000000000_0001", "app-20260101000000-0001"
    write(tmp_path, {
        "local-1": [start("local-1")],
        alone: [start(alone)],
        f"{yarn}_1": [start(yarn)],
        "application_1700000000000_0002.inprogress": [start("application_1700000000000_0002")],
        "eventlog_v2_application_1700000000000_0003_2/events_1_application_1700000000000_0003_2.compact": [start("application_1700000000000_0003")],
        "eventlog_v2_application_1700000000000_0003_2/appstatus_application_1700000000000_0003_2": ["x"],
        "spark-0f3c": [start("spark-0f3c")],
    })
    found = event_log.read_lines(spark, f"file://{tmp_path}")
    assert {r.app_id for r in found.collect()} == {"local-1", alone, yarn, "application_1700000000000_0002", "application_1700000000000_0003", "spark-0f3c"}
    rows = {r.app_id: r.app_name for r in event_log.applications(found).collect()}
    assert set(rows.values()) == {"n"} and len(rows) == 6


@pytest.mark.parametrize("given_to", ["hadoop", "spark"])
def test_settings_of_the_environment(spark, tmp_path, given_to):
    uri = {"hive.metastore.uris": "thrift://meta.test:9083"}
    spark_side = {"spark.sql.catalogImplementation": "hive"} | ({f"spark.hadoop.{k}": v for k, v in uri.items()} if given_to == "spark" else {})
    environment = {"Event": event_log.ENVIRONMENT, "JVM Information": {}, "Spark Properties": spark_side, "Hadoop Properties": uri if given_to == "hadoop" else {}}
    write(tmp_path, {"local-7": [start("local-7"), json.dumps(environment)]})
    row = event_log.applications(event_log.read_lines(spark, f"file://{tmp_path}")).first()
    assert (row.remote_hms, row.prefix) == (True, "thrift://meta.test:9083.")


def test_lines_of_odd_form_are_kept_whole(spark, tmp_path):
    later = json.dumps({"User": "u", "App ID": "a", "App Name": "late", "Event": event_log.APP_START})
    broken = '{"Event":"%s","executionId":1,"physicalPlanDescription":"%s' % (event_log.SQL_START, "x" * 2000)
    write(tmp_path, {"local-8": [later, broken, "not json", '{"Event":"SparkListenerTaskEnd"}', '{"Event":"%s"}' % ("x" * 500)]})
    lines = event_log.read_lines(spark, f"file://{tmp_path}")
    assert [r.kind for r in lines.orderBy("seq").collect()] == ["app_start", "sql_start"]
    assert event_log.malformed_lines(lines).first().detail == broken


LIST = "InMemoryFileIndex(3 paths)[file:/a, file:/b, file:/c]"
PLAN = """== Physical Plan ==
Execute InsertIntoHadoopFsRelationCommand (2)
+- Scan parquet (1)


(1) Scan parquet
Location: InMemoryFileIndex [file:/a, ... 2 entries]

(2) Execute InsertIntoHadoopFsRelationCommand
Arguments: file:/o, false, Parquet, [path=file:/o], Overwrite, [x]

"""


@pytest.mark.parametrize(
    "listed, inputs, shortened",
    [(LIST, {"file:/a", "file:/b", "file:/c"}, False), (LIST.replace("file:/c", "..."), {"file:/a"}, True), ("InMemoryFileIndex(3 paths)[file:/z, file:/b, file:/c]", {"file:/a"}, True), (None, {"file:/a"}, True)],
)
def test_scans_of_several_paths(spark, listed, inputs, shortened):
    graph = {"nodeName": "Execute", "children": [{"nodeName": "Scan parquet ", "children": [], "metadata": {"Location": listed} if listed else {}}], "metadata": {}}
    event = json.dumps({"Event": event_log.SQL_START, "executionId": 1, "physicalPlanDescription": PLAN, "sparkPlanInfo": graph, "time": 1})
    lines = spark.createDataFrame([("app", 1, "sql_start", event)], "app_id string, seq bigint, kind string, value string")
    known = harvest.facts(event_log.started_executions(lines))
    apps = spark.createDataFrame([("app", "app.", False)], "app_id string, prefix string, remote_hms boolean")
    edges = harvest.process_edges(known, apps).where("direction = 'input'").collect()
    assert {r.qualified_name for r in edges} == inputs
    chosen, leaves = harvest.statements(known)
    assert harvest.rejected(chosen, leaves).count() == shortened


TWO = """== Physical Plan ==
Execute InsertIntoHadoopFsRelationCommand (4)
+- Union (3)
   :- Scan parquet (1)
   +- Scan parquet (2)


(1) Scan parquet
Location: InMemoryFileIndex [file:/a, ... 1 entries]

(2) Scan parquet
Location: InMemoryFileIndex [file:/a, ... 1 entries]

(3) Union

(4) Execute InsertIntoHadoopFsRelationCommand
Arguments: file:/o, false, Parquet, [path=file:/o], Overwrite, [x]

"""
B, C = "InMemoryFileIndex(2 paths)[file:/a, file:/b]", "InMemoryFileIndex(2 paths)[file:/a, file:/c]"


@pytest.mark.parametrize(
    "lists, first, second",
    [([B, C], "ab", "ac"), ([C, B], "ac", "ab"), ([B], "a", "a"), ([B, C, C], "a", "a"), ([B, B, B], "ab", "ab"), ([B, C.replace("file:/c", "...")], "ab", "a"), ([], "a", "a"), (["InMemoryFileIndex(2 paths)[file:/x, file:/b]", B, C], "ab", "ac")],
)
def test_scans_that_begin_alike_keep_their_own_lists(spark, lists, first, second):
    graph = {"nodeName": "Execute", "children": [{"nodeName": "Scan parquet ", "children": [], "metadata": {"Location": x}} for x in lists], "metadata": {}}
    event = json.dumps({"Event": event_log.SQL_START, "executionId": 1, "physicalPlanDescription": TWO, "sparkPlanInfo": graph, "time": 1})
    lines = spark.createDataFrame([("app", 1, "sql_start", event)], "app_id string, seq bigint, kind string, value string")
    found = sorted(harvest.leaf_rows(harvest.facts(event_log.started_executions(lines))).collect(), key=lambda r: r.leaf_pos)
    assert [["".join(t.path[-1] for t in r.targets), r.shortened] for r in found] == [[first, len(first) == 1], [second, len(second) == 1]]


def test_runs_of_an_application_are_kept_apart(spark, tmp_path):
    """Two attempts whose executions have the same numbers, the first of which failed in part, and both read in order."""
    app = "application_1700000000000_0009"

    def execution(number, out, failed=False):
        plan = PLAN.replace("file:/a, ... 2 entries", f"file:/in{out}").replace("file:/o", f"file:/out{out}")
        end = {"Event": event_log.SQL_END, "executionId": number, "errorMessage": "boom" if failed else "", "time": 2}
        return [json.dumps({"Event": event_log.SQL_START, "executionId": number, "physicalPlanDescription": plan, "time": 1}), json.dumps(end)]

    write(tmp_path, {f"{app}_1": [*execution(0, 1), *execution(1, 2, failed=True)], f"eventlog_v2_{app}_2/events_1_{app}_2.zstd.inprogress": execution(0, 3) + execution(1, 4)})
    lines = event_log.read_lines(spark, f"file://{tmp_path}/{app}_1").unionByName(event_log.read_lines(spark, f"file://{tmp_path}/eventlog_v2_{app}_2"))
    log = event_log.from_lines(lines)
    apps = spark.createDataFrame([(app, "app.", False)], "app_id string, prefix string, remote_hms boolean")
    edges = harvest.process_edges(harvest.facts(log.executions()), apps)
    run, number = event_log.run_of(F.col("execution_id"))
    rows = edges.select("app_id", run.alias("run"), number.alias("number"), "direction", "qualified_name").collect()
    want = {(app, r, n, way, f"file:/{side}{x}") for r, n, x in ((1, 0, 1), (2, 0, 3), (2, 1, 4)) for way, side in (("input", "in"), ("output", "out"))}
    assert {tuple(r) for r in rows} == want
    seqs = [(r.run, r.seq) for r in lines.collect()]
    assert max(s for r, s in seqs if r == 1) < min(s for r, s in seqs if r == 2)


def test_a_real_scan_of_two_paths(spark, tmp_path):
    """A log that Spark itself writes, with room for the file list."""
    script = f"""
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}/log").config("spark.eventLog.compress", "false").config("spark.sql.maxMetadataStringLength", "100000").config("spark.hadoop.hive.metastore.uris", "thrift://meta.test:1").getOrCreate()
for name in "ab":
    s.range(3).write.parquet("file://{tmp_path}/" + name)
s.read.parquet("file://{tmp_path}/a", "file://{tmp_path}/b").write.parquet("file://{tmp_path}/out")
"""
    (tmp_path / "log").mkdir()
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True, timeout=300)
    lines = event_log.read_lines(spark, f"file://{tmp_path}/log")
    log = event_log.from_lines(lines)
    edges = harvest.process_edges(harvest.facts(log.executions()), log.applications).where("direction = 'input'")
    assert {r.qualified_name for r in edges.where(F.col("qualified_name").startswith("file:")).collect()} == {f"file:{tmp_path}/a", f"file:{tmp_path}/b"}


def test_long_node_titles_are_whole(spark):
    title = "Execute InsertIntoHadoopFsRelationCommand " + "x" * 500
    assert spark.range(1).select(pt.command_of(F.lit(title))).first()[0] == pt.INSERT_FS


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "yarn", "a"

    class Conf:
        @staticmethod
        def get(key, default):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)


def test_the_callers_settings_stay(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (before or shared_dir(spark)).rstrip("/")
    assert spark.conf.get("spark.checkpoint.dir", None) == before


def test_suppression_state_is_compacted(spark, tmp_path):
    """Nine triggers with a whole table every third give what one pass over all batches gives, repeated triggers too."""
    from weftline.streaming import suppress

    schema = "query_id string, batch_id bigint, direction string, type_name string, qualified_name string"
    batches = [[("q", t, "input", "k", f"o{(t * t) % 5}"), (f"p{t % 2}", t, "output", "k", f"o{t // 4}")] for t in range(9)]
    sink = suppress.SuppressionSink(f"file://{tmp_path}/state", f"file://{tmp_path}/out", compact=3)
    for t, rows in enumerate(batches):
        sink(spark.createDataFrame(rows, schema), t)
        if t in (2, 3):
            sink(spark.createDataFrame(rows, schema), t)
    columns = [c.split()[0] for c in schema.split(", ")]
    got = {tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/out").select(*columns).collect()}
    every = spark.createDataFrame([r for rows in batches for r in rows], schema)
    assert got == {tuple(r) for r in suppress.suppress(every).select(*columns).collect()}
