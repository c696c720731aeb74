"""Edges, as-of lookups, suppression, catalog fold and machine-learning forms on small fixtures."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from weftline.operators import asof, catalog, entities, lineage, ml, mutations, select
from weftline.settings import JobSettings, shared_dir
from weftline.streaming import progress, suppress

EDGE = "app_id string, execution_id bigint, command_pos int, direction string, type_name string, qualified_name string, ordinal bigint"


def edge(execution, direction, name, ordinal=0, type_name="spark_table", pos=0, app="a"):
    return (app, execution, pos, direction, type_name, name, ordinal)


def test_cycle_drops_all_outputs(spark):
    rows = [
        edge(1, "input", "t"),
        edge(1, "output", "t"),
        edge(1, "output", "u"),
        edge(2, "input", "t"),
        edge(2, "output", "u"),
        edge(3, "input", "x", type_name="fs_path"),
        edge(3, "output", "x"),
        # Two commands of one plan: only the cyclic one loses its output.
        edge(4, "input", "p", pos=1),
        edge(4, "output", "p", pos=1),
        edge(4, "input", "p", pos=5),
        edge(4, "output", "q", pos=5),
    ]
    frame = spark.createDataFrame(rows, EDGE)
    got = {(r.execution_id, r.qualified_name) for r in lineage.clean_cycles(frame).where("direction='output'").collect()}
    assert got == {(2, "u"), (4, "q")}
    assert lineage.clean_cycles(frame).where("direction='input'").count() == 5
    assert {r.execution_id for r in lineage.cyclic_queries(frame).collect()} == {1, 3, 4}


def test_messages_are_bounded_and_whole(spark):
    rows = [edge(1, "input", f"t{i}", ordinal=i) for i in range(25)] + [edge(1, "output", "o")]
    sent = lineage.process_messages(spark.createDataFrame(rows, EDGE), JobSettings(refs_per_message=10)).collect()
    assert len(sent) == 3
    assert all(len(m.inputs) <= 10 for m in sent)
    assert {r.qualified_name for m in sent for r in m.inputs} == {f"t{i}" for i in range(25)}
    assert [r.qualified_name for m in sent for r in m.outputs] == ["o"]


@pytest.mark.parametrize("width", [1, 3, 50, 100000])
@pytest.mark.parametrize("strict", [False, True])
def test_carry_forward_equals_brute_force(spark, width, strict):
    rng = random.Random(width)
    # One key holds most rows; gaps leave whole spans without any value.
    rows = []
    for key in ("hot", "cold", "none"):
        for at in sorted(rng.sample(range(400), 120 if key == "hot" else 9)):
            value = rng.randrange(1000) if key != "none" and rng.random() < 0.2 else None
            rows.append((key, at, value))
    frame = spark.createDataFrame(rows, "k string, at bigint, v int")
    got = {(r.k, r.at): r.out for r in asof.carry_forward(frame, ["k"], "at", "v", "out", width, strict).collect()}
    for key, at, _ in rows:
        before = [(a, v) for k, a, v in rows if k == key and v is not None and (a < at if strict else a <= at)]
        assert got[key, at] == (max(before)[1] if before else None)
    assert len(got) == len(rows)


def test_lookup_takes_value_at_same_number(spark):
    values = spark.createDataFrame([("k", 5, "five"), ("k", 9, "nine")], "k string, since bigint, v string")
    probes = spark.createDataFrame([("k", 4), ("k", 5), ("k", 8), ("k", 9), ("z", 9)], "k string, seq bigint")
    found = asof.lookup(probes, values, ["k"], "seq", "since", ["v"], 4)
    got = {(r.k, r.seq): r.found and r.found.v for r in found.collect()}
    assert got == {("k", 4): None, ("k", 5): "five", ("k", 8): "five", ("k", 9): "nine", ("z", 9): None}


BATCHES = [
    (1, ["topic1"]),
    (2, ["topic1", "topic2"]),
    (3, ["topic2", "topic3"]),
    (4, ["topic1", "topic2"]),
    (5, ["topic1", "topic2", "topic3"]),
]
STREAM_EDGE = "query_id string, batch_id bigint, direction string, type_name string, qualified_name string"


def stream_rows(side):
    other = "output" if side == "input" else "input"
    rows = []
    for batch, topics in BATCHES:
        rows += [("q", batch, side, "kafka_topic", t) for t in topics]
        rows.append(("q", batch, other, "kafka_topic", "fixed"))
    return rows


@pytest.mark.parametrize("side", ["input", "output"])
def test_suppression_sequence(spark, side):
    frame = spark.createDataFrame(stream_rows(side), STREAM_EDGE)
    kept = suppress.suppress(frame)
    assert {r.batch_id for r in kept.collect()} == {1, 2, 3}
    # A batch that reports, reports everything it touches.
    assert kept.where("batch_id = 2").count() == 3


def test_first_batch_reports_even_when_empty(spark):
    none = spark.createDataFrame([], STREAM_EDGE)
    batches = spark.createDataFrame([("q", 7), ("q", 3)], "query_id string, batch_id bigint")
    assert [r.batch_id for r in suppress.reporting_batches(none, batches).collect()] == [3]


@pytest.mark.parametrize("side", ["input", "output"])
def test_streaming_form_equals_batch_form(spark, side):
    place = tempfile.mkdtemp(prefix="suppress-")
    rows = stream_rows(side)
    for batch, _ in BATCHES:
        part = spark.createDataFrame([r for r in rows if r[1] == batch], STREAM_EDGE)
        part.coalesce(1).write.mode("append").json(f"{place}/in")
        edges = spark.readStream.schema(STREAM_EDGE).json(f"{place}/in")
        suppress.start(edges, f"{place}/state", f"{place}/out", f"{place}/check").awaitTermination()
    live = {tuple(r) for r in spark.read.parquet(f"{place}/out").select("query_id", "batch_id", "direction", "qualified_name").collect()}
    whole = spark.createDataFrame(rows, STREAM_EDGE)
    batch_form = suppress.suppress(whole).select("query_id", "batch_id", "direction", "qualified_name")
    assert live == {tuple(r) for r in batch_form.collect()}


def test_repeated_trigger_changes_nothing(spark):
    place = tempfile.mkdtemp(prefix="repeat-")
    sink = suppress.SuppressionSink(f"{place}/state", f"{place}/out")
    frames = [spark.createDataFrame([r for r in stream_rows("input") if r[1] == b], STREAM_EDGE) for b, _ in BATCHES]
    for trigger, frame in enumerate(frames):
        sink(frame, trigger)
        sink(frame, trigger)
    out = spark.read.parquet(f"{place}/out")
    assert {r.batch_id for r in out.collect()} == {1, 2, 3}
    assert out.count() == out.select("query_id", "batch_id", "direction", "qualified_name").distinct().count()


APPS = "app_id string, app_name string, user string, prefix string, remote_hms boolean"
EVENTS = "app_id string, seq bigint, event string, db string, name string, new_name string, kind string"
DBS = "app_id string, db string, since bigint, description string, location string, parameters map<string,string>, owner string"
TABLES = """app_id string, db string, name string, since bigint, table_type string, provider string, schema_desc string,
owner string, create_time bigint, comment string, partition_columns array<string>, bucket_spec map<string,string>,
parameters map<string,string>, location string, input_format string, output_format string, serde string,
compressed boolean, storage_parameters map<string,string>, tracks_partitions boolean, unsupported_features array<string>"""


def table_row(name, since=0, comment=None):
    return ("a", "db1", name, since, "MANAGED", "parquet", "struct<ID:bigint>", "owner", 0, comment, [], None, {}, "file:/w", None, None, None, False, {}, False, [])


def fold(spark, events, remote=False):
    apps = spark.createDataFrame([("a", "job", "u", "a.", remote)], APPS)
    dbs = spark.createDataFrame([("a", "db1", 0, "d", "hdfs://nn/Wh/db1", {}, "o")], DBS)
    tables = spark.createDataFrame([table_row("tbl1"), table_row("tbl2", 3)], TABLES)
    frame = spark.createDataFrame([("a", i, *e) for i, e in enumerate(events)], EVENTS)
    return catalog.all_mutations(frame, tables, dbs, apps, JobSettings(asof_width=2))


def counts(frame):
    return {(r.op, r.type_name): r.n for r in mutations.counts(frame).collect()}


def test_catalog_sequence(spark):
    events = [
        ("CreateTablePre", "db1", "tbl1", None, None),
        ("CreateTable", "db1", "tbl1", None, None),
        ("RenameTablePre", "db1", "tbl1", "tbl2", None),
        ("RenameTable", "db1", "tbl1", "tbl2", None),
        ("AlterTable", "db1", "tbl2", None, "table"),
        ("AlterTable", "db1", "tbl2", None, "dataSchema"),
        ("AlterTable", "db1", "tbl2", None, "schema"),
        ("AlterTable", "db1", "tbl2", None, "stats"),
        ("DropTable", "db1", "tbl2", None, None),
        ("SomethingNew", "db1", "tbl2", None, None),
    ]
    found = fold(spark, events).cache()
    assert counts(found) == {
        ("create", "spark_db"): 1,
        ("create", "spark_table"): 2,
        ("create", "spark_storagedesc"): 1,
        ("update", "spark_table"): 1,
        ("update", "spark_storagedesc"): 1,
    }
    # What a dependency needs comes first.
    created = [r.type_name for r in mutations.ordered(found).where("seq = 1").collect()]
    assert created[-1] == "spark_table"
    renamed = found.where("op = 'update' and type_name = 'spark_table'").first()
    assert renamed.qualified_name == "a.db1.tbl1"
    assert renamed.attrs == {"qualifiedName": "a.db1.tbl2", "name": "tbl2"}


def test_database_drop(spark):
    gone = [("DropDatabase", "db1", None, None, None)]
    assert counts(fold(spark, gone)) == {("delete", "spark_db"): 1}
    announced = [("CreateDatabase", "db1", None, None, None), ("DropDatabasePre", "db1", None, None, None), *gone, *gone]
    assert counts(fold(spark, announced)) == {
        ("create", "spark_db"): 1,
        ("delete", "spark_db"): 2,
        ("delete", "hdfs_path"): 1,
    }
    # An announcement after the database is gone remembers nothing.
    late = [*gone, ("DropDatabasePre", "db1", None, None, None), *gone]
    assert counts(fold(spark, late)) == {("delete", "spark_db"): 2}


def test_remote_metastore_and_unknown_definitions(spark):
    events = [("CreateTable", "db1", "tbl1", None, None), ("CreateDatabase", "db1", None, None, None)]
    assert counts(fold(spark, events, remote=True)) == {}
    assert counts(fold(spark, [("CreateTable", "db1", "nowhere", None, None), ("CreateDatabase", "nodb", None, None, None)])) == {}


def test_definition_is_read_as_of_the_event(spark):
    # tbl2 is defined only from sequence number 3 on.
    early = [("AlterTable", "db1", "tbl2", None, "table")]
    assert counts(fold(spark, early)) == {}


ML = "app_id string, seq bigint, event string, uid string, directory string, dataset_execution_id bigint"


def ml_frame(spark, events):
    return spark.createDataFrame([("a", i, e, u, d, x) for i, (e, u, d, x) in enumerate(events)], ML)


FULL = [
    ("CreatePipeline", "pipeline_1", None, 77),
    ("CreateModel", "pipeline_1", None, None),
    ("SavePipeline", "pipeline_1", "hdfs://nn/tmp/pipeline", None),
    ("SaveModel", "pipeline_1", "hdfs://nn/tmp/model", None),
]


def test_fit_process(spark):
    training = spark.createDataFrame([edge(77, "input", "train"), edge(77, "output", "x")], EDGE)
    got = {(r.direction, r.qualified_name) for r in ml.fit_edges(ml_frame(spark, FULL), training).collect()}
    assert got == {
        ("input", "pipeline_1"),
        ("input", "train"),
        ("output", "model_1"),
        ("output", "hdfs://nn/tmp/model"),
        ("output", "hdfs://nn/tmp/pipeline"),
    }


def test_model_needs_saved_pipeline(spark):
    training = spark.createDataFrame([], EDGE)
    unsaved = ml_frame(spark, [FULL[0], FULL[1], FULL[3]])
    assert ml.fit_edges(unsaved, training).count() == 0
    assert ml.graph(unsaved).count() == 0
    # Without a created model there are the two directories, but no model and no process.
    partial = ml_frame(spark, [FULL[0], FULL[2], FULL[3]])
    assert "spark_ml_model" not in {r.type_name for r in ml.graph(partial).collect()}
    assert ml.fit_edges(partial, training).count() == 0


@pytest.mark.parametrize(
    "events, mode, names",
    [
        ([], "etl", {"i1", "i2", "o1", "o2"}),
        ([("LoadModel", "pipeline_1", "hdfs://nn/m", None), ("Transform", "pipeline_1", None, None)], "score", {"i1", "o1", "model_1", "hdfs://nn/m"}),
        ([*FULL, ("LoadModel", "pipeline_1", "hdfs://nn/m", None), ("Transform", "pipeline_1", None, None)], "fit", {"i1", "o1"}),
        ([("Transform", "pipeline_1", None, None)], "lost", set()),
    ],
)
def test_process_forms(spark, events, mode, names):
    rows = [edge(100, "input", "i2", 5), edge(100, "input", "i1", 1), edge(100, "output", "o1", 0), edge(100, "output", "o2", 1)]
    queries = spark.createDataFrame([("a", 100, 100)], "app_id string, execution_id bigint, seq bigint")
    frame = ml_frame(spark, events) if events else spark.createDataFrame([], ML)
    assert ml.modes(queries, frame).first().mode == mode
    got = ml.process_edges(spark.createDataFrame(rows, EDGE), queries, frame, JobSettings(asof_width=3))
    assert {r.qualified_name for r in got.collect()} == names


def test_exactly_one(spark):
    rows = spark.createDataFrame([("t", "a", {"k": "1"}), ("t", "b", {"k": "2"})], "type_name string, qualified_name string, attrs map<string,string>")
    assert select.exactly_one(select.with_attribute(rows, "t", "k", "2"), "t").first().qualified_name == "b"
    for bad in (select.of_type(rows, "t"), select.of_type(rows, "none")):
        with pytest.raises(Exception, match="expected one"):
            select.exactly_one(bad, "t").collect()


def test_references_are_never_created(spark):
    d = spark.createDataFrame([("a.", True, ("db1", "Tbl1", "o"))], "prefix string, remote_hms boolean, t struct<db:string,name:string,owner:string>")
    graph = d.select(F.inline(F.array(entities.hive_reference(F.col("t.db"), F.col("t.name"), JobSettings()))))
    assert graph.first().qualified_name == "db1.tbl1@primary"
    assert mutations.creations(graph).count() == 0


def test_kafka_topics_that_moved(spark):
    rows = [
        ("a", "q", 0, [("KafkaV2[Subscribe[x]]", None, '{"t1":{"0":4}}'), ("FileStreamSource[x]", None, '{"logOffset":0}')], "s"),
        ("a", "q", 1, [("KafkaV2[Subscribe[x]]", '{"t1":{"0":4,"1":9}}', '{"t1":{"0":4,"1":9},"t2":{"0":1}}')], "s"),
        ("a", "q", 2, [("KafkaV2[Subscribe[x]]", '{"t1":{"0":4}}', "broken")], "s"),
    ]
    schema = "app_id string, query_id string, batch_id bigint, sources array<struct<description:string,startOffset:string,endOffset:string>>, sink_description string"
    got = {(r.batch_id, r.topic) for r in progress.kafka_topics(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(0, "t1"), (1, "t2")}


def test_mutation_sinks(spark):
    found = fold(spark, [("CreateTable", "db1", "tbl1", None, None)])
    place = tempfile.mkdtemp(prefix="sink-")
    mutations.emit(found, mutations.to_parquet(f"{place}/m"))
    assert spark.read.parquet(f"{place}/m").count() == 3
    seen = []
    mutations.emit(found, lambda frame: seen.append(mutations.messages(frame).count()))
    assert seen == [3]


def test_shared_dir_follows_the_session(spark):
    place = shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == place


def test_ml_entities_link_to_their_directory(spark):
    uri, where = F.lit("hdfs://"), F.lit("tmp/model")
    rows = F.array(
        entities.ml_directory(uri, where),
        entities.ml_entity("spark_ml_model", F.lit("pipeline_9"), F.lit("spark_ml_directory"), F.lit("hdfs://.tmp/model")),
    )
    graph = spark.range(1).select(F.inline(rows))
    got = {r.type_name: r for r in graph.collect()}
    assert got["spark_ml_directory"].qualified_name == "hdfs://.tmp/model"
    assert got["spark_ml_directory"].attrs == {"uri": "hdfs://", "directory": "tmp/model"}
    assert got["spark_ml_model"].qualified_name == "model_9"
    links = entities.relationships(graph).collect()
    assert [(r.rel, r.to_type, r.to_qn) for r in links] == [("directory", "spark_ml_directory", "hdfs://.tmp/model")]
    assert entities.dependencies(graph).count() == 1


def test_as_of_with_log_sequence_numbers(spark):
    base = 3 * (1 << 48)
    rows = [("k", base + i, i if i % 10 == 0 else None) for i in range(45)]
    frame = spark.createDataFrame(rows, "k string, at bigint, v int")
    found = asof.carry_forward(frame, ["k"], "at", "v", "out", 7)
    assert all(r.out == (r.at - base) // 10 * 10 for r in found.collect())
