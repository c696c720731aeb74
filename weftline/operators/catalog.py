"""Catalog events folded to mutations.

Definitions are read as of the event, not as they are now, so a table altered twice gives two
different create mutations whenever the job runs. ``catalog_tables`` and ``catalog_dbs`` therefore
carry ``since``, the sequence number from which a definition holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import names, paths
from weftline.operators import asof, entities, mutations
from weftline.settings import JobSettings

DB_FIELDS = ["db", "description", "location", "parameters", "owner"]
TABLE_FIELDS = [
    "db",
    "name",
    "table_type",
    "provider",
    "schema_desc",
    "owner",
    "create_time",
    "comment",
    "partition_columns",
    "bucket_spec",
    "parameters",
    "location",
    "input_format",
    "output_format",
    "serde",
    "compressed",
    "storage_parameters",
    "tracks_partitions",
    "unsupported_features",
]


def own_events(events: DataFrame, applications: DataFrame) -> DataFrame:
    """Events of applications with their own catalog; a remote metastore reports its own changes."""
    scope = applications.select("app_id", "prefix", "remote_hms")
    return events.join(scope, "app_id").where("not remote_hms").drop("remote_hms")


def with_definitions(
    events: DataFrame, tables: DataFrame, dbs: DataFrame, settings: JobSettings = JobSettings()
) -> DataFrame:
    """Add the structs ``t`` and ``d``: the table and database definitions valid at the event."""
    defs = entities.plain_definitions(tables).withColumn("table_db", F.col("db"))
    fields = [f for f in TABLE_FIELDS if f not in ("db", "name")]
    found = asof.lookup(
        events, defs, ["app_id", "db", "name"], "seq", "since", ["table_db", *fields], settings.asof_width, "t"
    )
    db_defs = entities.plain_definitions(dbs).withColumn("db_name", F.col("db"))
    db_fields = [f for f in DB_FIELDS if f != "db"]
    return asof.lookup(
        found, db_defs, ["app_id", "db"], "seq", "since", ["db_name", *db_fields], settings.asof_width, "d"
    )


def fold(
    events: DataFrame,
    tables: DataFrame,
    dbs: DataFrame,
    applications: DataFrame,
    settings: JobSettings = JobSettings(),
) -> DataFrame:
    """Mutations of all catalog events except database drops.

    An event whose definition is unknown gives nothing. Column changes, statistics, table drops and
    the announcements before an event give nothing by design.
    """
    wanted = own_events(events, applications).where(
        F.col("event").isin("CreateDatabase", "AlterDatabase", "CreateTable", "RenameTable")
        | ((F.col("event") == "AlterTable") & (F.col("kind") == "table"))
    )
    found = with_definitions(wanted, tables, dbs, settings)
    prefix, db, name = F.col("prefix"), F.col("db"), F.col("name")
    t, d = F.col("t"), F.col("d")
    event = F.col("event")

    database = mutations.create(entities.db_entity(prefix, db, d, F.lit(settings.user), settings))
    owner_db = mutations.create(entities.db_entity(prefix, db, d, t["owner"], settings))
    storage = mutations.create(entities.storage_entity(prefix, db, name, t))
    table = mutations.create(entities.table_entity(prefix, db, name, t))
    new = F.col("new_name")
    renamed_storage = mutations.update(
        names.SPARK_STORAGE,
        names.storage_name(prefix, db, name),
        entities.attributes(qualifiedName=names.storage_name(prefix, db, new)),
        0,
    )
    renamed_table = mutations.update(
        names.SPARK_TABLE,
        names.table_name(prefix, db, name),
        entities.attributes(qualifiedName=names.table_name(prefix, db, new), name=new),
        1,
    )
    known_db, known_table = d.isNotNull(), d.isNotNull() & t.isNotNull()
    rows = (
        F.when(event.isin("CreateDatabase", "AlterDatabase") & known_db, F.array(database))
        .when((event == "CreateTable") & known_table, F.array(owner_db, storage, table))
        .when((event == "AlterTable") & known_table, F.array(table))
        .when(event == "RenameTable", F.array(renamed_storage, renamed_table))
    )
    return found.select("app_id", "seq", F.inline(rows))


def database_drops(
    events: DataFrame, dbs: DataFrame, applications: DataFrame, settings: JobSettings = JobSettings()
) -> DataFrame:
    """Database drops: the database goes, and so does its location if the drop was announced in time.

    The announcement remembers the definition if the database still exists then. A drop uses up what
    was remembered.
    """
    steps = own_events(events, applications).where(F.col("event").isin("DropDatabasePre", "DropDatabase"))
    nothing = F.lit(None).cast("string")
    # Within one sequence number: definition, then announcement or drop.
    known = dbs.join(applications.where("not remote_hms").select("app_id", "prefix"), "app_id").select(
        "app_id", "db", "prefix", (F.col("since") * 2).alias("at"), F.lit("Definition").alias("event"), "location"
    )
    moves = steps.select("app_id", "db", "prefix", (F.col("seq") * 2 + 1).alias("at"), "event", nothing.alias("location"))
    line = known.unionByName(moves)
    width = 2 * settings.asof_width

    state = F.when(F.col("event") == "Definition", F.struct(F.lit(True).alias("there"), F.col("location")))
    gone = F.when(F.col("event") == "DropDatabase", F.struct(F.lit(False).alias("there"), nothing.alias("location")))
    line = line.withColumn("state", F.coalesce(state, gone))
    line = asof.carry_forward(line, ["app_id", "db"], "at", "state", "current", width, strict=True)

    heard = (F.col("event") == "DropDatabasePre") & F.coalesce(F.col("current.there"), F.lit(False))
    memory = F.when(heard, F.struct(F.lit(True).alias("held"), F.col("current.location").alias("location")))
    used = F.when(F.col("event") == "DropDatabase", F.struct(F.lit(False).alias("held"), nothing.alias("location")))
    line = line.where("event <> 'Definition'").withColumn("memory", F.coalesce(memory, used))
    line = asof.carry_forward(line, ["app_id", "db"], "at", "memory", "remembered", width, strict=True)

    drops = line.where("event = 'DropDatabase'").withColumn("uri", paths.resolve(F.col("remembered.location"), settings))
    drops = paths.with_plain(drops)
    uri = F.col("uri")
    drop_db = mutations.delete(F.lit(names.SPARK_DB), names.db_name(F.col("prefix"), F.col("db")), 0)
    drop_path = mutations.delete(paths.path_type(uri), paths.path_qualified_name(uri, F.col("plain")), 0)
    rows = F.when(F.coalesce(F.col("remembered.held"), F.lit(False)), F.array(drop_db, drop_path)).otherwise(
        F.array(drop_db)
    )
    return drops.select("app_id", ((F.col("at") - 1) / 2).cast("bigint").alias("seq"), F.inline(rows))


def all_mutations(
    events: DataFrame,
    tables: DataFrame,
    dbs: DataFrame,
    applications: DataFrame,
    settings: JobSettings = JobSettings(),
) -> DataFrame:
    return fold(events, tables, dbs, applications, settings).unionByName(
        database_drops(events, dbs, applications, settings)
    )
