"""Rows that grow a hundredfold are dealt by their number, and log lines are written once."""

import re
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from weftline.functions import plan_text as pt
from weftline.functions.values import once
from weftline.operators import connectors, harvest
from weftline.plans import statements
from weftline.sources import event_log, standins


def test_rows_in_one_of_many_splits_are_dealt_out(spark):
    # As a file of one row group is read: many splits, of which one holds all rows.
    frame = spark.range(50_000).coalesce(1)
    for _ in range(16):
        frame = frame.union(spark.range(0))
    held = standins.spread(frame, "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) >= 8 and sum(r["count"] for r in held) == 50_000
    assert max(r["count"] for r in held) < 2 * standins.ROWS_A_TASK


def test_tasks_follow_the_rows(spark):
    frame = spark.range(20 * standins.ROWS_A_TASK)
    assert standins.spread(frame, "id").rdd.getNumPartitions() == 20


def test_no_filter_writes_the_lines_again(spark):
    lines = standins.log_lines(spark, "/root/testdata/sf0.001")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.split("\n") if re.match(r"[\s:+-]*Filter ", x)]
    assert filters and not any("StructsToJson" in x for x in filters)


def test_kind_of_odd_lines(spark):
    name = event_log.SQL_END
    lines = [f'{{"Event":"{name}"}}', " " * 300 + f'{{"Event":"{name}"}}', f'{{"a":"{"x" * 500}","Event":"{name}"}}', '{"Event":"other"}', "", None, '{"Event":"' + "y" * 300 + '"}',
             '{"Event":"org.apache.spark.sql.catalyst.catalog.DropTableEvent"}', '{"Event":"org.apache.spark.ml.Fit"}']
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, value string").select("i", event_log.kind_of(F.col("value")).alias("kind")).orderBy("i").collect()
    assert [r.kind for r in rows] == ["sql_end", "sql_end", "sql_end", None, None, None, None, "catalog", "ml"]


def test_once_keeps_nulls(spark):
    rows = spark.range(2).select(once(F.when(F.col("id") == 1, F.col("id")), lambda x: F.coalesce(x, F.lit(7))).alias("x")).collect()
    assert [r.x for r in rows] == [7, 1]


def test_staging_writes_the_text_of_broken_lines_only(spark, tmp_path):
    lines = standins.log_lines(spark, "/root/testdata/sf0.001")
    broken = ("app-0", 1, 1, "sql_start", '{"Event":"%s","executionId":1,"physicalPlanDescription":"x' % event_log.SQL_START)
    lines = lines.unionByName(spark.createDataFrame([broken], lines.schema))
    log = event_log.stage(lines, f"file://{tmp_path}")
    kept = [spark.read.parquet(f"file://{x}") for x in tmp_path.iterdir()]
    texts = [r.value for t in kept if "value" in t.columns for r in t.where("value is not null").select("value").collect()]
    assert texts == [broken[-1]] and [r.detail for r in log.malformed.collect()] == texts
    for name, told in vars(event_log.from_lines(lines)).items():
        got = getattr(log, name)
        assert got.columns == told.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, told.collect()))


def test_options_of_one_row_group_are_dealt_out(spark):
    # The table is one row group, so it is read by one task, and so would be the identities of its options.
    found = standins.statement_options(spark, "/root/testdata/sf0.1")
    held = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) >= 8 and max(r["count"] for r in held) < 2 * standins.ROWS_A_TASK


def test_no_filter_works_out_identities_again(spark):
    plan = connectors.datasets(standins.statement_options(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.split("\n") if re.match(r"[\s:+-]*Filter ", x)]
    assert filters and not any("jdbc" in x for x in filters)


def test_a_statement_s_commands_are_chosen_once(spark):
    plan = statements._edges(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "min(ordinal" in plan and "min(struct" not in plan


def test_process_rows_parse_no_plans(spark):
    statements._STAGED.clear()
    statements.process_rows(spark, "/root/testdata/sf0.001")
    place = urlparse(statements.stage(spark, "/root/testdata/sf0.001")).path
    assert sorted(x.name for x in Path(place).iterdir()) == ["applications", "events"]


def test_lines_that_do_not_fit_their_schema_but_are_json_are_not_malformed(spark):
    head = '{"Event":"%s",' % event_log.SQL_END
    texts = [head + x for x in ('"executionId":"x","time":1}', '"errorMessage":"a\tb"}', '"executionId":1} and more', '"executionId":1', "}", '"executionId":2,"time":3}')]
    lines = spark.createDataFrame([("app-1", 1, i, "sql_end", t) for i, t in enumerate(texts)], "app_id string, run int, seq bigint, kind string, value string")
    parsed = event_log.parsed_lines(lines)
    told, got = event_log.from_lines(lines), event_log.from_lines(parsed)
    for name in ("ended", "malformed"):
        assert sorted(map(repr, getattr(got, name).collect())) == sorted(map(repr, getattr(told, name).collect()))
    assert [r.detail for r in got.malformed.collect()] == [texts[3], texts[4]]


def test_the_first_look_at_a_line_is_compiled(spark):
    kind = spark.createDataFrame([("x",)], "value string").select(event_log.kind_of(F.col("value")))
    assert "try_element_at(map(" in kind._jdf.queryExecution().analyzed().toString().split("transform(")[0].lower()


def test_log_files_of_all_names(spark):
    names = ["hdfs://nn/l/app-1", "l/eventlog_v2_app-1/events_12_app-1.zstd", "l/application_1_2_3.inprogress", "l/events_x_app.a.compact", "l/events_2_application_1_2.lz4.compact", "application_1_2", ""]
    app, number = event_log.file_app_and_number(F.col("f"))
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "i int, f string").orderBy("i").select(app, number, event_log.file_run(F.col("f"))).collect()
    assert [tuple(r) for r in rows] == [("app-1", 1, 1), ("app-1", 12, 1), ("application_1_2", 1, 3), ("events_x_app.a", 1, 1), ("application_1_2", 2, 1), ("application_1_2", 1, 1), ("", 1, 1)]


def _rows_of_facts(spark, query, name):
    statements._STAGED.clear()
    statements.QUERIES[query][0](spark, "/root/testdata/sf0.001")
    place = statements.stage(spark, "/root/testdata/sf0.001")
    made = {x.name for x in Path(urlparse(place).path).iterdir()}
    return made, spark.read.parquet(f"{place}/{name}").count()


def test_a_query_for_one_command_parses_the_plans_that_name_it(spark):
    made, parsed = _rows_of_facts(spark, "harvest_dir", "naming-InsertIntoHiveDirCommand")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert "started_facts" not in made and parsed == orders.where("o_orderkey % 16 = 7").count()


def test_queries_for_writers_and_cut_lists_leave_other_plans_out(spark):
    for query, name in (("unmatched_writers", "naming-SaveIntoDataSourceCommand-WriteToDataSourceV2"), ("harvest_rejected", "naming-InsertIntoHiveDirCommand-InsertIntoDataSourceDirCommand-cut")):
        made, parsed = _rows_of_facts(spark, query, name)
        plans = statements._log(spark, "/root/testdata/sf0.001").started.count()
        assert "started_facts" not in made and 0 < parsed < plans / 2


def _plan(command):
    return f"== Physical Plan ==\nExecute {command} (2)\n+- Scan parquet c.d.t (1)\n\n\n(1) Scan parquet c.d.t\nLocation: X [file:/a]\n\n(2) Execute {command}\nArguments: `c`.`d`.`{command}`, x\n\n"


def test_a_statement_is_whole_where_any_of_its_executions_names_the_command(spark):
    load, insert, ctas, view = "LoadDataCommand", "InsertIntoHiveTable", "CreateDataSourceTableAsSelectCommand", "CreateViewCommand"
    other = "== Physical Plan ==\nScan parquet c.d.u (1)\n\n\n(1) Scan parquet c.d.u\nLocation: X [file:/b]\n\n"
    # By root and execution: a nested one outranks the root, the root alone has no command, two nested ones beside each other, unrelated ones.
    plans = [(1, 1, load), (1, 2, ctas), (3, 3, None), (3, 4, load), (5, 5, insert), (5, 6, load), (5, 7, None), (8, 8, view), (8, 9, None), (10, 10, load), (10, 11, None), (12, 12, insert)]
    rows = [("a", root, number, None, None, _plan(name) if name else other) for root, number, name in plans] + [("a", 13, 13, None, None, None)]
    started = spark.createDataFrame(rows, "app_id string, root_execution_id long, execution_id long, query_id string, batch_id long, plan string")

    def told(known):
        chosen, leaves = harvest.statements(known)
        chosen = chosen.where(F.col("command") == load)
        read = leaves.join(chosen.select("root_execution_id", "app_id"), ["root_execution_id", "app_id"], "left_semi")
        return sorted(map(repr, chosen.collect())), sorted(map(repr, read.select("execution_id", "leaf_pos", "node").collect()))

    named = pt.may_have(F.col("plan"), [load])
    first = harvest.facts(started.where(named))
    rest = harvest.facts(harvest.beside(started.where(~named), first, [load]))
    assert told(first.unionByName(rest)) == told(harvest.facts(started))
    assert sorted(r.execution_id for r in rest.collect()) == [2, 3, 5, 7, 11]


def test_the_success_test_groups_nothing_and_doubles_nothing(spark):
    started = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 3), ("a", 4, 3), ("b", 1, 1)], "app_id string, execution_id long, root_execution_id long")
    ended = spark.createDataFrame([("a", 1, False), ("a", 1, False), ("a", 2, False), ("a", 3, True), ("a", 4, False)], "app_id string, execution_id long, failed boolean")
    good = event_log.successful_executions(started, ended)
    assert "Aggregate" not in good._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.app_id, r.execution_id) for r in good.collect()) == [("a", 1), ("a", 2)]
