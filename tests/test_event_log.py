"""Real Spark statements, run with the event log on, then harvested; and printed plans of commands
that need a Hive metastore, as text."""

import subprocess
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weftline.functions import plan_text as pt
from weftline.operators import connectors, harvest, lineage
from weftline.settings import JobSettings
from weftline.sources import event_log
from weftline.streaming import log_stream, suppress


@pytest.fixture(scope="module")
def produced():
    place = tempfile.mkdtemp(prefix="produced-")
    Path(place, "log").mkdir()
    script = str(Path(__file__).with_name("produce_log.py"))
    result = subprocess.run([sys.executable, script, place], capture_output=True, text=True, timeout=600, check=True)
    app = next(line.split()[1] for line in result.stdout.splitlines() if line.startswith("APP"))
    return place, app


@pytest.fixture(scope="module")
def log(spark, produced):
    place, _ = produced
    return event_log.stage(event_log.read_lines(spark, f"file://{place}/log"), f"{place}/staged")


@pytest.fixture(scope="module")
def edges(log):
    return lineage.clean_cycles(harvest.process_edges(harvest.facts(log.executions()), log.applications, None, log.progress)).cache()


def test_application(log, produced):
    row = log.applications.first()
    assert (row.app_id, row.app_name, row.prefix, row.remote_hms) == (produced[1], "producer", produced[1] + ".", False)


def test_edges_of_real_statements(edges, produced):
    place, app = produced

    def short(name):
        return name.replace(f"{app}.", "").replace(place, "")

    rows = edges.where("query_id is null").collect()
    found = {}
    for r in rows:
        both = found.setdefault((r.execution_id, r.command_pos), (r.command, set(), set()))
        both[1 if r.direction == "input" else 2].add(short(r.qualified_name))
    got = sorted(((c, tuple(sorted(i)), tuple(sorted(o))) for c, i, o in found.values()), key=str)
    data = "file:/root/testdata/sf0.001/"
    expected = [
        (pt.INSERT_FS, (), ("db1.src",)),
        (pt.CTAS_SOURCE, ("db1.src",), ("db1.input1",)),
        (pt.CTAS_SOURCE, ("db1.src",), ("db1.input2",)),
        (pt.INSERT_FS, ("db1.input1", "db1.input2", "db1.src"), ("db1.big",)),
        (pt.INSERT_FS, ("db1.src",), ()),
        (pt.CREATE_VIEW, ("db1.src",), ("db1.v",)),
        (pt.CREATE_VIEW, (), ("db1.one",)),
        (pt.CTAS_SOURCE, ("db1.src",), ("db1.fromview",)),
        (pt.INSERT_FS, ("db1.input1", "db1.src"), ("db1.input2",)),
        (pt.INSERT_FS, ("db1.input1", "db1.src"), ("db1.big",)),
        (pt.INSERT_FS, (data + "lineitem.parquet", data + "orders.parquet"), ("file:/out/agg",)),
        (pt.CTAS_SOURCE, ("file:/out/agg",), ("db1.frompath",)),
        (pt.INSERT_SOURCE_DIR, ("db1.big",), ("file:/out/dir",)),
    ]
    assert got == sorted(expected, key=str)


def test_streaming_edges(edges, produced):
    place, _ = produced
    rows = edges.where("query_id is not null").collect()
    outputs = {r.qualified_name for r in rows if r.direction == "output"}
    assert outputs == {f"file:{place}/out/stream"}
    assert all(r.qualified_name.startswith(f"file:{place}/wh/db1.db/src/part-") for r in rows if r.direction == "input")
    assert {r.query_id for r in rows if r.direction == "input"} == {r.query_id for r in rows}


def test_stream_over_the_log_gives_the_same(spark, log, edges, produced):
    place, _ = produced
    lines = event_log.stream_lines(spark, f"file://{place}/log")
    live = log_stream.stream_edges(lines, log.applications)
    suppress.start(live, f"{place}/s/state", f"{place}/s/out", f"{place}/s/check").awaitTermination()
    columns = ["query_id", "batch_id", "direction", "qualified_name"]
    got = {tuple(r) for r in spark.read.parquet(f"{place}/s/out").select(*columns).collect()}
    expected = {tuple(r) for r in suppress.suppress(edges.where("query_id is not null")).select(*columns).collect()}
    assert got == expected and got


def test_failed_statement_is_absent(log):
    assert log.ended.where("failed").count() == 1
    bad = log.ended.where("failed").select("execution_id").first()[0]
    assert log.executions().where(F.col("execution_id") == bad).count() == 0


def test_catalog_events_are_in_order(log):
    rows = log.catalog.where("event not like '%Pre'").orderBy("seq").collect()
    events = [(r.event, r.name) for r in rows]
    assert events[0] == ("CreateDatabase", None)
    tail = [e for e in events if e[0] in ("RenameTable", "DropTable")]
    assert tail == [("RenameTable", "fromview"), ("DropTable", "renamed")]
    assert next(r for r in rows if r.event == "AlterTable" and r.name == "renamed").kind == "table"


def plan_of(head, *paragraphs):
    return "== Physical Plan ==\n" + head + "\n\n\n" + "\n\n".join(paragraphs) + "\n\n"


PLANS = {
    "hive insert": (
        plan_of(
            "Execute InsertIntoHiveTable (2)\n+- Scan hive db1.src (1)",
            "(1) Scan hive db1.src\nOutput [1]: [name#1]\nArguments: [name#1], HiveTableRelation [`spark_catalog`.`db1`.`src`, org.apache.Serde, Data Cols: [name#1]]",
            "(2) Execute InsertIntoHiveTable\nInput: []\nArguments: `spark_catalog`.`db1`.`Dst`, org.apache.Serde, false, false, [name]",
        ),
        {("input", "app.db1.src"), ("output", "app.db1.dst")},
    ),
    "load": (
        plan_of(
            "Execute LoadDataCommand (1)\n   +- LoadDataCommand (2)",
            "(1) Execute LoadDataCommand\nOutput: []",
            "(2) LoadDataCommand\nArguments: `db1`.`t`, hdfs://nn/in,put, false, false",
        ),
        {("input", "hdfs://nn/in,put"), ("output", "app.db1.t")},
    ),
    "hive directory": (
        plan_of(
            "AdaptiveSparkPlan (3)\n+- Execute InsertIntoHiveDirCommand (2)\n   +- Scan hive src (1)",
            "(1) Scan hive src\nOutput [1]: [name#1]",
            "(2) Execute InsertIntoHiveDirCommand\nInput: []\nArguments: false, Storage(Location: hdfs://nn/Dir, Serde Library: x), true, [name]",
            "(3) AdaptiveSparkPlan\nArguments: isFinalPlan=false",
        ),
        {("input", "app.default.src"), ("output", "hdfs://nn/Dir")},
    ),
    "hive directory without location": (
        plan_of(
            "Execute InsertIntoHiveDirCommand (2)\n+- Scan hive src (1)",
            "(1) Scan hive src\nOutput [1]: [name#1]",
            "(2) Execute InsertIntoHiveDirCommand\nInput: []\nArguments: false, Storage(), true, [name]",
        ),
        set(),
    ),
    "subquery inputs are not plan children": (
        plan_of(
            "Execute InsertIntoHadoopFsRelationCommand (2)\n+- Scan parquet db1.a (1)",
            "(1) Scan parquet db1.a\nLocation: InMemoryFileIndex [file:/a]",
            "(2) Execute InsertIntoHadoopFsRelationCommand\nArguments: s3a://b/k/o, false, Parquet, [path=s3a://b/k/o], Overwrite, [x]\n\n"
            "===== Subqueries =====\n\nSubquery:1 Hosting operator id = 1\nScan parquet db1.hidden (9)",
        ),
        {("input", "app.db1.a"), ("output", "s3://b/k/o")},
    ),
    "plain query": (plan_of("Scan parquet db1.a (1)", "(1) Scan parquet db1.a\nLocation: InMemoryFileIndex [file:/a]"), set()),
    "not a plan": ("garbage\n\n(1) x", set()),
}


def facts_of(spark, *plans):
    rows = [("app", i, i, None, None, p) for i, p in enumerate(plans)]
    return harvest.facts(spark.createDataFrame(rows, "app_id string, execution_id bigint, root_execution_id bigint, query_id string, batch_id bigint, plan string"))


def apps(spark, remote=False):
    return spark.createDataFrame([("app", "app.", remote)], "app_id string, prefix string, remote_hms boolean")


def test_printed_plans(spark):
    names = list(PLANS)
    edges = harvest.process_edges(facts_of(spark, *[PLANS[n][0] for n in names]), apps(spark)).collect()
    for number, name in enumerate(names):
        got = {(r.direction, r.qualified_name) for r in edges if r.execution_id == number}
        assert got == PLANS[name][1], name


def test_remote_metastore_gives_references(spark):
    edges = harvest.process_edges(facts_of(spark, PLANS["hive insert"][0]), apps(spark, True)).collect()
    assert {(r.type_name, r.qualified_name) for r in edges} == {("hive_table", "db1.src@primary"), ("hive_table", "db1.dst@primary")}


def test_bad_records(spark):
    shortened = plan_of(
        "Execute InsertIntoHadoopFsRelationCommand (2)\n+- Scan parquet (1)",
        "(1) Scan parquet\nLocation: InMemoryFileIndex [file:/a, ... 3 entries]",
        "(2) Execute InsertIntoHadoopFsRelationCommand\nArguments: file:/o, false, Parquet, [path=file:/o], Overwrite, [x]",
    )
    chosen, leaves = harvest.statements(facts_of(spark, PLANS["hive directory without location"][0], shortened))
    got = {(r.execution_id, r.reason) for r in harvest.rejected(chosen, leaves).collect()}
    assert got == {(0, "no location"), (1, "shortened file list")}


def test_malformed_line_stops_nothing(spark):
    start = '{"Event":"%s","executionId":1,"physicalPlanDescription":"x"' % event_log.SQL_START
    lines = spark.createDataFrame([("app", 1, "sql_start", start), ("app", 2, "sql_start", start + "}")], "app_id string, seq bigint, kind string, value string")
    good = event_log.started_executions(lines).where("execution_id is not null and plan is not null")
    assert good.count() >= 1
    assert event_log.malformed_lines(lines).count() == 1


VIEW = plan_of(
    "Execute CreateViewCommand (1)\n   +- CreateViewCommand (2)\n         +- Project (6)\n            +- Join (5)\n               :- LogicalRelation (3)\n               +- LogicalRelation (4)",
    "(1) Execute CreateViewCommand\nOutput: []",
    "(2) CreateViewCommand\nArguments: `spark_catalog`.`db1`.`v`, select 1, false, false, PersistedView, COMPENSATION, true",
    "(3) LogicalRelation\nArguments: parquet, [a#1], `spark_catalog`.`db1`.`a`, false",
    "(4) LogicalRelation\nArguments: parquet, [b#1], `spark_catalog`.`db1`.`b`, false",
    "(5) Join\nArguments: Inner",
    "(6) Project\nArguments: [a#1]",
)


@pytest.mark.parametrize("strict, inputs", [(False, {"app.db1.a", "app.db1.b"}), (True, set())])
def test_view_over_join(spark, strict, inputs):
    edges = harvest.process_edges(facts_of(spark, VIEW), apps(spark), settings=JobSettings(strict_view=strict)).collect()
    assert {r.qualified_name for r in edges if r.direction == "input"} == inputs
    assert {r.qualified_name for r in edges if r.direction == "output"} == {"app.db1.v"}


def test_each_branch_takes_the_options_of_its_own_connector(spark):
    plan = plan_of(
        "Union (7)\n:- Execute InsertIntoHadoopFsRelationCommand (3)\n:  +- Scan JDBCRelation(t) [numPartitions=1] (1)\n+- Execute InsertIntoHadoopFsRelationCommand (6)\n   +- Scan KafkaRelation(x) (4)",
        "(1) Scan JDBCRelation(t) [numPartitions=1]\nOutput: []",
        "(3) Execute InsertIntoHadoopFsRelationCommand\nArguments: file:/one, false, Parquet, [path=file:/one], Append, [x]",
        "(4) Scan KafkaRelation(x)\nOutput: []",
        "(6) Execute InsertIntoHadoopFsRelationCommand\nArguments: file:/two, false, Parquet, [path=file:/two], Append, [x]",
    )
    known = facts_of(spark, plan, plan)
    options = spark.createDataFrame(
        [("app", 0, "input", "jdbc", {"url": "jdbc:mysql://h/d", "dbtable": "t"}), ("app", 0, "input", "org.apache.spark.sql.kafka010.KafkaRelation", {"subscribe": "k"})],
        "app_id string, execution_id bigint, direction string, connector string, options map<string,string>",
    )
    edges = harvest.process_edges(known, apps(spark), options).where("execution_id = 0").collect()
    got = {(r.command_pos, r.direction, r.qualified_name) for r in edges}
    first, second = sorted({r.command_pos for r in edges})
    assert got == {(first, "input", "d.t"), (first, "output", "file:/one"), (second, "input", "k@primary"), (second, "output", "file:/two")}
    chosen, leaves = harvest.statements(known)
    nothing = spark.createDataFrame([], "app_id string, execution_id bigint, reason string, detail string")
    bad = harvest.bad_records(chosen, leaves, options, nothing).collect()
    assert {(r.execution_id, r.reason, r.detail) for r in bad} == {(1, "connector without options", "Scan JDBCRelation(t) [numPartitions=1]"), (1, "connector without options", "Scan KafkaRelation(x)")}


def test_writers_without_a_known_target_are_reported(spark):
    chosen = spark.createDataFrame(
        [("a", 1, 0, "SaveIntoDataSourceCommand", "org.x.P@1"), ("a", 2, 0, "WriteToDataSourceV2", "w"), ("a", 3, 0, "SaveIntoDataSourceCommand", "k"), ("a", 4, 1, "InsertIntoHiveTable", "t"), ("a", 5, 0, "WriteToDataSourceV2", None)],
        "app_id string, execution_id long, command_pos int, command string, arguments string",
    )
    options = spark.createDataFrame(
        [("a", 1, "output", "other", {"x": "y"}), ("a", 3, "output", "kafka", {"topic": "t"}), ("a", 2, "input", "kafka", {"subscribe": "t"})],
        "app_id string, execution_id long, direction string, connector string, options map<string,string>",
    )
    found = connectors.unmatched_writers(chosen, options).collect()
    assert {(r.execution_id, r.reason, r.detail) for r in found} == {(1, "unmatched writer", "SaveIntoDataSourceCommand org.x.P@1"), (2, "unmatched writer", "WriteToDataSourceV2 w"), (5, "unmatched writer", "WriteToDataSourceV2")}
