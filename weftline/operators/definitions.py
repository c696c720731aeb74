"""Definitions of tables as intervals of validity, and the tables that statements name as they were then.

A name's definition holds from the catalog's change until the next point of that name: another definition, a drop, a rename
away, or a rename to it. A table that is renamed takes its definition along, over any chain of renames. The
place of a chain is found by halving what is left of it in each round, so a table that has been renamed a thousand times takes ten.

A statement's outputs are looked up where it ended (it may have made them), its inputs where it began. Order is any whole number that
definitions, catalog events and statements of an application share: a place in its log, or the time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import names
from weftline.functions import plan_text as pt
from weftline.operators import asof, entities, harvest
from weftline.operators.catalog import DB_FIELDS, TABLE_FIELDS
from weftline.settings import JobSettings, written

KEY = ["app_id", "db", "name"]


def _renamed(points: DataFrame, renames: DataFrame, settings: JobSettings) -> DataFrame:
    """What each rename brings to its new name: ``app_id, seq, t``; null where the old name had no definition."""
    here = renames.withColumn("before", F.col("seq") - 1)
    found = asof.lookup(here, points, KEY, "before", "since", ["t", "via"], settings.asof_width, "found")
    chains = written(found.select("app_id", "seq", F.col("found.t").alias("t"), F.col("found.via").alias("via")), "chains")
    while chains.where("via is not null").limit(1).count():
        # A definition that came by a rename is that rename's: look there, or where that one looks.
        source = chains.select("app_id", F.col("seq").alias("via"), F.col("t").alias("source_t"), F.col("via").alias("source_via"))
        moved = chains.where("via is not null").join(source, ["app_id", "via"], "left").select("app_id", "seq", F.col("source_t").alias("t"), F.col("source_via").alias("via"))
        chains = written(chains.where("via is null").unionByName(moved), "chains")
    return chains.select("app_id", "seq", "t")


def intervals(tables: DataFrame, events: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """``app_id, db, name, since, until, t``: the definition of each name from ``since`` up to, not with, ``until`` (null: still).

    ``t`` is null while the name has none. ``tables`` are the catalog's definitions with ``since``, ``events`` its events. At
    one number a definition counts before a rename, a rename before a drop. Names are as the catalog has them."""
    t = F.struct(*TABLE_FIELDS)
    kind = entities.plain_definitions(tables).select(t.alias("t")).schema["t"].dataType
    none, nowhere = F.lit(None).cast(kind), F.lit(None).cast("bigint")
    since = F.col("seq").alias("since")
    defined = entities.plain_definitions(tables).select(*KEY, "since", F.lit(2).alias("rank"), t.alias("t"), nowhere.alias("via"))
    renames = written(events.where("event = 'RenameTable'").select("app_id", "db", "name", "new_name", "seq"), "renames")
    gone = events.where("event in ('DropTable', 'RenameTable')").select(*KEY, since, F.lit(0).alias("rank"), none.alias("t"), nowhere.alias("via"))
    came = renames.select("app_id", "db", F.col("new_name").alias("name"), since, F.lit(1).alias("rank"), none.alias("t"), F.col("seq").alias("via"))

    def points(*parts: DataFrame) -> DataFrame:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        best = F.max_by(F.struct("t", "via"), F.col("rank")).alias("best")
        return rows.groupBy(*KEY, "since").agg(best).select(*KEY, "since", "best.*")

    brought = _renamed(written(points(defined, gone, came), "points"), renames, settings)
    came = came.drop("t").join(brought.withColumnRenamed("seq", "via"), ["app_id", "via"])
    rows = points(defined, gone, came).drop("via").withColumn("back", -F.col("since"))
    # Back to front, the last value before a point is the next point.
    return asof.carry_forward(rows, KEY, "back", "since", "until", settings.asof_width, strict=True).drop("back")


def references(chosen: DataFrame, leaves: DataFrame, times: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Tables that statements read, write or define: ``app_id, execution_id, command, direction, db, name, at``.

    ``times`` has ``app_id, execution_id, began, ended``."""
    read = harvest.input_targets(chosen, leaves, settings).where("table is not null").select("app_id", "execution_id", "command", "direction", "db", "table")
    made = harvest.defined_tables(chosen).withColumn("direction", F.lit("output"))
    every = read.unionByName(made)
    named = every.select("app_id", "execution_id", "command", "direction", names.database_identifier(F.col("db"), settings).alias("db"), names.identifier(F.col("table"), settings).alias("name")).distinct()
    at = F.when(F.col("direction") == "output", F.col("ended")).otherwise(F.col("began"))
    return named.join(times, ["app_id", "execution_id"]).withColumn("at", at).drop("began", "ended")


def as_of(refs: DataFrame, known: DataFrame, dbs: DataFrame, events: DataFrame, applications: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """``refs`` with ``prefix, remote_hms, user`` of their application and the definitions ``t`` and ``d`` that held ``at``; null where
    there was none. A table of a dropped database is gone. Tables of a remote metastore are not looked up."""
    refs = refs.join(applications.select("app_id", "prefix", "remote_hms", "user"), "app_id")
    values = known.select(*KEY, "since", F.col("since").alias("from"), "t")
    found = asof.lookup(refs.where("not remote_hms"), values, KEY, "at", "since", ["from", "t"], settings.asof_width, "found")
    fields = [f for f in DB_FIELDS if f != "db"]
    own_dbs = entities.plain_definitions(dbs).select("app_id", "db", "since", F.col("since").alias("from"), F.struct(F.col("db").alias("db_name"), *fields).alias("d"))
    drops = events.where("event = 'DropDatabase'").select("app_id", "db", F.col("seq").alias("since"), F.lit(None).cast("bigint").alias("from"), F.lit(None).cast(own_dbs.schema["d"].dataType).alias("d"), F.col("seq").alias("dropped"))
    # One line of a database's life: definitions and drops; the last drop is carried along with what holds now.
    life = own_dbs.withColumn("dropped", F.lit(None).cast("bigint")).unionByName(drops)
    life = life.groupBy("app_id", "db", "since").agg(F.max("d").alias("d"), F.max("dropped").alias("dropped"))
    life = asof.carry_forward(life, ["app_id", "db"], "since", "dropped", "last_drop", settings.asof_width)
    met = asof.lookup(found, life, ["app_id", "db"], "at", "since", ["d", "last_drop"], settings.asof_width, "db_found")
    lost = F.coalesce(F.col("db_found.last_drop") >= F.col("found.from"), F.lit(False))
    own = met.select(*refs.columns, F.when(~lost, F.col("found.t")).alias("t"), F.col("db_found.d").alias("d"))
    remote = refs.where("remote_hms")
    nothing = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("t", "d")]
    return own.unionByName(remote.select(*refs.columns, *nothing))


def unknown(met: DataFrame) -> DataFrame:
    """References without a definition, for the bad-record table."""
    reason = F.when(F.col("d").isNull(), "unknown database").otherwise("unknown table")
    lost = met.where("not remote_hms and (t is null or d is null)")
    return lost.select("app_id", "execution_id", reason.alias("reason"), F.concat("db", F.lit("."), "name").alias("detail")).distinct()


def _as_named(command: Column) -> Column:
    """The definition under the name it had then; a table made by a Hive CTAS belongs to who ran it."""
    t = F.col("t").withField("db", F.col("db")).withField("name", F.col("name"))
    mine = (command == pt.CTAS_HIVE) & (F.col("direction") == "output")
    return t.withField("owner", F.when(mine, F.col("user")).otherwise(F.col("t.owner")))


def graph(met: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Entities of the tables that statements name, whole as of the statement: database, storage and table, or a
    reference; ``app_id, execution_id, at`` and the columns of entity rows."""
    keep = ["app_id", "execution_id", "at"]
    rows = met.where("remote_hms or (t is not null and d is not null)").withColumn("t", _as_named(F.col("command")))
    prefix, t, d = F.col("prefix"), F.col("t"), F.col("d")
    own = F.array(
        entities.db_entity(prefix, F.col("db"), d, t["owner"], settings),
        entities.storage_entity(prefix, F.col("db"), F.col("name"), t),
        entities.table_entity(prefix, F.col("db"), F.col("name"), t),
    )
    away = F.array(entities.hive_reference(F.col("db"), F.col("name"), settings))
    return rows.select(*keep, F.inline(F.when(F.col("remote_hms"), away).otherwise(own)))


def creations(told: DataFrame) -> DataFrame:
    """Create mutations of ``graph`` rows, each form of an entity once, where it is first met: ``app_id, op, type_name, qualified_name, attrs, seq, create_rank``.

    An aggregate, so what is named by very many statements is combined before it shuffles."""
    e = F.struct("type_name", "qualified_name", "name", "attrs", "create_rank")
    form = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("attrs"))))
    rows = told.where("not is_reference").groupBy("app_id", "type_name", "qualified_name", form.alias("form")).agg(F.min_by(e, F.col("at")).alias("e"), F.min("at").alias("seq"))
    attrs = F.map_concat(F.map_filter(F.create_map(F.lit("name"), F.col("e.name")), lambda _, v: v.isNotNull()), F.col("e.attrs"))
    return rows.select("app_id", F.lit("create").alias("op"), "type_name", "qualified_name", attrs.alias("attrs"), "seq", F.col("e.create_rank").alias("create_rank"))
