"""Intervals of definitions, and statements that meet them, against a walk through the events one by one."""

import random

import pytest

from weftline.functions import plan_text as pt
from weftline.operators import definitions, mutations
from weftline.operators.catalog import TABLE_FIELDS
from weftline.settings import JobSettings

TABLES = "app_id string, db string, name string, since long, comment string"
EVENTS = "app_id string, seq long, event string, db string, name string, new_name string, kind string"
REFS = "app_id string, execution_id long, command string, direction string, db string, name string, at long"
APPS = "app_id string, prefix string, remote_hms boolean, user string"
DBS = "app_id string, db string, since long, description string, location string, parameters map<string,string>, owner string"


def tables(spark, rows):
    frame = spark.createDataFrame(rows, TABLES)
    kinds = {"create_time": "bigint", "partition_columns": "array<string>", "unsupported_features": "array<string>", "compressed": "boolean", "tracks_partitions": "boolean"}
    rest = [f for f in TABLE_FIELDS if f not in frame.columns]
    return frame.selectExpr(*frame.columns, *(f"CAST(NULL AS {kinds.get(f, 'string')}) AS {f}" for f in rest))


def random_history(rng):
    """Definitions and events of two names of one database at increasing numbers, and what a walk finds at each number."""
    defined, events, held, states = [], [], {}, []
    for at in range(1, 60):
        kind, name = rng.choice(["define", "define", "drop", "rename", "rename", "rename", "nothing"]), rng.choice("abcd")
        if kind == "define":
            defined.append(("app", "d", name, at, f"c{at}"))
            held[name] = f"c{at}"
        elif kind == "drop":
            events.append(("app", at, "DropTable", "d", name, None, None))
            held.pop(name, None)
        elif kind == "rename":
            new = rng.choice([x for x in "abcd" if x != name])
            events.append(("app", at, "RenameTable", "d", name, new, None))
            held[new] = held.pop(name, None)
        states.append({n: held.get(n) for n in "abcd"})
    return defined, events, states


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals_equal_a_walk(spark, seed):
    defined, events, states = random_history(random.Random(seed))
    known = definitions.intervals(tables(spark, defined), spark.createDataFrame(events, EVENTS), JobSettings(asof_width=7)).collect()
    for at, state in enumerate(states, 1):
        for name, comment in state.items():
            here = [r for r in known if r.name == name and r.since <= at and (r.until is None or at < r.until)]
            assert len(here) <= 1
            assert (here[0].t.comment if here and here[0].t else None) == comment


def test_a_long_chain_of_renames(spark):
    """One table renamed forty times back and forth keeps its first definition."""
    events = [("app", 10 + i, "RenameTable", "d", "ab"[i % 2], "ba"[i % 2], None) for i in range(40)]
    known = definitions.intervals(tables(spark, [("app", "d", "a", 1, "first")]), spark.createDataFrame(events, EVENTS), JobSettings(asof_width=8)).collect()
    last = {r.name: r for r in known if r.until is None}
    assert last["a"].t.comment == "first" and last["a"].since == 49 and last["b"].t is None


def met(spark, defined, events, refs, dbs=None):
    apps = spark.createDataFrame([("app", "app.", False, "me"), ("far", "ms.", True, "me")], APPS)
    dbs = spark.createDataFrame(dbs or [("app", "d", 0, "text", "hdfs://h/d", None, "dba")], DBS)
    events = spark.createDataFrame(events, EVENTS)
    known = definitions.intervals(tables(spark, defined), events)
    return definitions.as_of(spark.createDataFrame(refs, REFS), known, dbs, events, apps)


def test_statements_meet_the_definition_of_their_time(spark):
    defined = [("app", "d", "x", 5, "old"), ("app", "d", "x", 15, "new"), ("app", "d", "made", 21, "made")]
    events = [("app", 30, "DropDatabase", "d", None, None, None)]
    refs = [
        ("app", 1, pt.INSERT_HIVE, "input", "d", "x", 4),
        ("app", 2, pt.INSERT_HIVE, "input", "d", "x", 5),
        ("app", 3, pt.INSERT_HIVE, "input", "d", "x", 20),
        ("app", 3, pt.CTAS_HIVE, "output", "d", "made", 22),
        ("app", 4, pt.CREATE_TABLE, "output", "d", "made", 25),
        ("app", 5, pt.INSERT_HIVE, "input", "d", "x", 31),
        ("app", 6, pt.INSERT_HIVE, "input", "nodb", "x", 20),
        ("far", 7, pt.INSERT_HIVE, "input", "d", "x", 20),
    ]
    found = met(spark, defined, events, refs)
    lost = {(r.execution_id, r.reason, r.detail) for r in definitions.unknown(found).collect()}
    assert lost == {(1, "unknown table", "d.x"), (5, "unknown database", "d.x"), (6, "unknown database", "nodb.x")}
    graph = definitions.graph(found)
    own = {(r.execution_id, r.qualified_name): r.attrs for r in graph.where("type_name = 'spark_table'").collect()}
    assert {k: v.get("comment") for k, v in own.items()} == {(2, "app.d.x"): "old", (3, "app.d.x"): "new", (3, "app.d.made"): "made", (4, "app.d.made"): "made"}
    assert own[3, "app.d.made"]["owner"] == "me" and "owner" not in own[4, "app.d.made"]
    assert [(r.type_name, r.qualified_name) for r in graph.where("is_reference").collect()] == [("hive_table", "d.x@primary")]
    sent = mutations.messages(definitions.creations(graph)).collect()
    assert sorted(r.key for r in sent if r.key.startswith("spark_table")) == ["spark_table|app.d.made"] * 2 + ["spark_table|app.d.x"] * 2
    assert all('"attrs":{' in r.value and '"seq":' in r.value for r in sent)


def test_a_renamed_table_goes_by_its_new_name(spark):
    found = met(spark, [("app", "d", "a", 1, "c")], [("app", 5, "RenameTable", "d", "a", "b", None)], [("app", 1, pt.INSERT_HIVE, "input", "d", "b", 6), ("app", 2, pt.INSERT_HIVE, "input", "d", "a", 6)])
    names = {r.qualified_name for r in definitions.graph(found).collect()}
    assert names == {"app.d", "app.d.b", "app.d.b.storageFormat"}
    assert [r.execution_id for r in definitions.unknown(found).collect()] == [2]


def test_nothing_to_meet(spark):
    empty = tables(spark, []), spark.createDataFrame([], EVENTS)
    assert definitions.intervals(*empty).collect() == []
    found = met(spark, [("app", "d", "a", 1, "c")], [], [("app", 1, pt.INSERT_HIVE, "input", "d", None, 6)])
    assert definitions.graph(found).collect() == [] and definitions.unknown(found).count() == 1
