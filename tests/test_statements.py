"""What a catalog is told about statements."""

from weftline.operators import statements
from weftline.settings import JobSettings

EDGES = [
    ("a", 1, 0, "input", "spark_table", "a.db.t"), ("a", 1, 0, "input", "spark_table", "a.db.u"), ("a", 1, 0, "output", "aws_s3_object", "s3://b/x/y"),
    ("a", 1, 3, "output", "hive_table", "h.t@c"), ("a", 2, 0, "input", "kafka_topic", "k@c"),
]
SCHEMA = "app_id string, execution_id bigint, command_pos int, direction string, type_name string, qualified_name string"


def test_creates_come_with_what_they_need(spark):
    rows = statements.mutations(spark.createDataFrame(EDGES, SCHEMA)).collect()
    first = {(r.type_name, r.qualified_name): r.create_rank for r in rows if r.execution_id == 1}
    assert first == {
        ("spark_db", "a.db"): 0, ("spark_table", "a.db.t"): 1, ("spark_table", "a.db.u"): 1, ("spark_storagedesc", "a.db.t.storageFormat"): 0,
        ("spark_storagedesc", "a.db.u.storageFormat"): 0, ("aws_s3_bucket", "s3://b"): 0, ("aws_s3_pseudo_dir", "s3://b/x/"): 1,
        ("aws_s3_object", "s3://b/x/y"): 2, ("spark_process", "a"): 4,
    }
    assert len(rows) == len(first) + 2 and {r.op for r in rows} == {"create"}


def test_large_processes_come_in_parts(spark):
    edges = spark.createDataFrame([("a", 1, 0, "input", "spark_table", f"a.d.t{i}") for i in range(500)] + EDGES[2:4], SCHEMA)
    plans = spark.createDataFrame([("a", 1, None, None, "== Physical Plan ==\nX (1)\n\n\n(1) X\n\n")], "app_id string, execution_id bigint, query_id string, batch_id bigint, plan string")
    apps = spark.createDataFrame([("a", "job", None)], "app_id string, app_name string, user string")
    rows = statements.process_entities(edges, plans, apps, JobSettings(refs_per_message=50)).collect()
    parts = [r for r in rows if r.command_pos == 0]
    assert len(parts) > 5 and max(len(r.inputs) + len(r.outputs) for r in parts) < 150
    assert {x.qualified_name for r in parts for x in r.inputs} == {f"a.d.t{i}" for i in range(500)}
    other = next(r for r in rows if r.command_pos == 3)
    assert (other.deps, [x.qualified_name for x in other.outputs], other.name, other.curr_user, other.create_rank) == ([], ["h.t@c"], "job a", "spark", 4)
    assert other.details.startswith("== Physical Plan ==") and other.plan_description.startswith("X")
