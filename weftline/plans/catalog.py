"""Queries over catalog definitions and catalog events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import names
from weftline.operators import catalog, entities, mutations, select
from weftline.plans import standin_sql as q
from weftline.plans.lineage import OWN_TABLES, catalog_definitions
from weftline.settings import JobSettings
from weftline.sources import standins

SETTINGS = JobSettings()
# A narrow span, so that the as-of joins cross many spans on test data too.
FOLD = JobSettings(asof_width=1024)


def _attrs(frame: DataFrame, *keep: str) -> DataFrame:
    return entities.attribute_rows(frame, *keep)


def db_entities(spark: SparkSession, folder: str) -> DataFrame:
    dbs = entities.plain_definitions(standins.catalog_dbs(spark, folder))
    d = F.struct(*dbs.columns)
    rows = dbs.join(standins.applications(spark, folder), "app_id").select(
        F.inline(F.array(entities.db_entity(F.col("prefix"), F.col("db"), d, F.col("user"), SETTINGS)))
    )
    return _attrs(rows, "name")


DB_ENTITIES = q.with_(q.APPLICATIONS, q.CATALOG_DBS) + (
    "SELECT name, 'spark_db' AS type_name, qualified_name, s.attr AS attr, s.value AS value FROM ("
    "SELECT d.db AS name, prefix || d.db AS qualified_name, unnest("
    + q.attribute_list({**q.DB_ATTRS, "owner": "usr"})
    + ") AS s FROM dbs d JOIN applications a ON d.app_id = a.app_id) WHERE s.value IS NOT NULL"
)


def storage_entities(spark: SparkSession, folder: str) -> DataFrame:
    graph = catalog_definitions(spark, folder).where("not remote_hms")
    rows = graph.select(
        "since",
        F.inline(F.array(entities.storage_entity(F.col("prefix"), F.col("t.db"), F.col("t.name"), F.col("t")))),
    )
    return _attrs(rows, "since")


def _own_attrs(type_name: str, suffix: str, attrs: dict[str, str], keep: str) -> str:
    return (
        f"SELECT {keep}, '{type_name}' AS type_name, qualified_name, s.attr AS attr, s.value AS value FROM ("
        f"SELECT {keep}, prefix || db || '.' || name || '{suffix}' AS qualified_name, unnest("
        + q.attribute_list(attrs)
        + ") AS s FROM own_tables) WHERE s.value IS NOT NULL"
    )


_TABLES = q.with_(q.APPLICATIONS, q.CATALOG_TABLES, OWN_TABLES)
STORAGE_ENTITIES = _TABLES + _own_attrs(
    "spark_storagedesc", ".storageFormat", q.STORAGE_ATTRS, "CAST(since AS BIGINT) AS since"
)


def table_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes of own tables, from the whole graph of their definitions."""
    graph = entities.table_graph(catalog_definitions(spark, folder))
    return _attrs(select.of_type(graph, names.SPARK_TABLE))


TABLE_ENTITIES = _TABLES + (
    "SELECT 'spark_table' AS type_name, qualified_name, s.attr AS attr, s.value AS value FROM ("
    "SELECT prefix || db || '.' || name AS qualified_name, unnest("
    + q.attribute_list(q.TABLE_ATTRS)
    + ") AS s FROM own_tables) WHERE s.value IS NOT NULL"
)


def table_relationships(spark: SparkSession, folder: str) -> DataFrame:
    return entities.relationships(entities.table_graph(catalog_definitions(spark, folder))).distinct()


TABLE_RELATIONSHIPS = (
    _TABLES
    + """SELECT DISTINCT * FROM (
  SELECT 'spark_table' AS from_type, prefix || db || '.' || name AS from_qn, 'db' AS rel, 'spark_db' AS to_type,
    prefix || db AS to_qn FROM own_tables
  UNION ALL SELECT 'spark_table', prefix || db || '.' || name, 'sd', 'spark_storagedesc',
    prefix || db || '.' || name || '.storageFormat' FROM own_tables)"""
)


def table_entities_alter(spark: SparkSession, folder: str) -> DataFrame:
    """The alter form: the catalog's newer definition if there is one, and no dependencies."""
    every = catalog_definitions(spark, folder)
    carried = every.where("since = 0")
    newer = every.where("since > 0").select("app_id", F.col("t.name").alias("name"), F.col("t").alias("newer"))
    both = carried.withColumn("name", F.col("t.name")).join(newer, ["app_id", "name"], "left")
    fresh = both.withColumn("t", entities.refreshed(F.col("t"), F.col("newer")))
    graph = entities.table_graph(fresh, with_deps=False).where("not is_reference")
    return graph.select(
        "qualified_name",
        F.col("attrs")["comment"].alias("comment"),
        F.size("deps").alias("n_deps"),
        F.size("rels").alias("n_rels"),
    )


TABLE_ENTITIES_ALTER = (
    _TABLES
    + "SELECT prefix || db || '.' || name AS qualified_name, comment, 0 AS n_deps, 2 AS n_rels "
    "FROM own_tables WHERE until = 9000000000000"
)


def hive_references(spark: SparkSession, folder: str) -> DataFrame:
    graph = entities.table_graph(catalog_definitions(spark, folder)).where("is_reference")
    return graph.select("type_name", "qualified_name", "is_reference").distinct()


HIVE_REFERENCES = (
    q.with_(q.APPLICATIONS, q.CATALOG_TABLES)
    + """SELECT DISTINCT 'hive_table' AS type_name, db || '.' || name || '@primary' AS qualified_name, true AS is_reference
    FROM tables t JOIN applications a ON t.app_id = a.app_id WHERE remote_hms"""
)


def entity_select(spark: SparkSession, folder: str) -> DataFrame:
    """Tables stored as ORC with their database, reached along the link, and a typed attribute."""
    graph = entities.table_graph(catalog_definitions(spark, folder))
    found = select.with_attribute(graph, names.SPARK_TABLE, "provider", "orc")
    joined = select.linked(found, entities.relationships(graph).distinct(), "db")
    return joined.select(
        "qualified_name",
        select.attribute("createTime", "date").cast("string").alias("created"),
        select.attribute("partitionProvider").alias("partition_provider"),
        F.col("to_qn").alias("database"),
    )


ENTITY_SELECT = (
    _TABLES
    + "SELECT prefix || db || '.' || name AS qualified_name, substr(create_time, 1, 10) AS created, partition_provider, "
    "prefix || db AS database FROM own_tables WHERE provider = 'orc'"
)


def entity_single(spark: SparkSession, folder: str) -> DataFrame:
    """The only storage entity with a given attribute; the query fails unless there is exactly one."""
    graph = entities.table_graph(catalog_definitions(spark, folder))
    found = select.with_attribute(graph, names.SPARK_STORAGE, "parameters", '{"path":"/p7"}')
    return select.exactly_one(found, "storage").select("type_name", "qualified_name")


ENTITY_SINGLE = (
    _TABLES
    + "SELECT 'spark_storagedesc' AS type_name, prefix || db || '.' || name || '.storageFormat' AS qualified_name "
    "FROM own_tables WHERE name = 't7'"
)


def _all(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.all_mutations(
        standins.catalog_events(spark, folder),
        standins.catalog_tables(spark, folder),
        standins.catalog_dbs(spark, folder),
        standins.applications(spark, folder),
        FOLD,
    )


def catalog_mutations(spark: SparkSession, folder: str) -> DataFrame:
    return _all(spark, folder).select("app_id", "seq", "op", "type_name", "qualified_name", "create_rank")


_DB_AT = "e.app_id = d.app_id AND e.db = d.db AND d.since <= e.seq"
_TABLE_AT = "e.app_id = t.app_id AND e.db = t.db AND e.name = t.name AND t.since <= e.seq AND t.until > e.seq"
# What a drop remembers: the last announcement since the previous drop that found the database defined.
_FOLD = q.with_(
    q.APPLICATIONS,
    q.CATALOG_DBS,
    q.CATALOG_TABLES,
    q.CATALOG_EVENTS,
    q.OWN_EVENTS,
    """heard AS (
  SELECT e.app_id, e.db, e.seq, d.location FROM own_events e JOIN dbs d ON e.app_id = d.app_id AND e.db = d.db
  WHERE e.event = 'DropDatabasePre' AND d.since <= e.seq AND NOT EXISTS (
    SELECT 1 FROM own_events x WHERE x.event = 'DropDatabase' AND x.app_id = e.app_id AND x.db = e.db
    AND x.seq < e.seq AND x.seq >= d.since))""",
    """drops AS (
  SELECT e.app_id, e.db, e.seq, e.prefix, (SELECT max_by(h.location, h.seq) FROM heard h
    WHERE h.app_id = e.app_id AND h.db = e.db AND h.seq < e.seq AND NOT EXISTS (
      SELECT 1 FROM own_events x WHERE x.event = 'DropDatabase' AND x.app_id = h.app_id AND x.db = h.db
      AND x.seq > h.seq AND x.seq < e.seq)) AS location
  FROM own_events e WHERE e.event = 'DropDatabase')""",
    f"""muts AS (
  SELECT e.app_id, e.seq, 'create' AS op, 'spark_db' AS type_name, prefix || e.db AS qualified_name, 0 AS create_rank
  FROM own_events e JOIN dbs d ON {_DB_AT} WHERE e.event IN ('CreateDatabase', 'AlterDatabase')
  UNION ALL
  SELECT e.app_id, e.seq, 'create', u.a, prefix || e.db || u.b, u.c
  FROM own_events e JOIN dbs d ON {_DB_AT} JOIN tables t ON {_TABLE_AT},
    LATERAL (SELECT 'spark_db' AS a, '' AS b, 0 AS c UNION ALL SELECT 'spark_table', '.' || e.name, 1
      UNION ALL SELECT 'spark_storagedesc', '.' || e.name || '.storageFormat', 0) u
  WHERE e.event = 'CreateTable' OR (e.event = 'AlterTable' AND e.kind = 'table' AND u.a = 'spark_table')
  UNION ALL
  SELECT app_id, seq, 'update', 'spark_table', prefix || db || '.' || name, 1 FROM own_events WHERE event = 'RenameTable'
  UNION ALL
  SELECT app_id, seq, 'update', 'spark_storagedesc', prefix || db || '.' || name || '.storageFormat', 0
  FROM own_events WHERE event = 'RenameTable'
  UNION ALL
  SELECT app_id, seq, 'delete', 'spark_db', prefix || db, 0 FROM drops
  UNION ALL
  SELECT app_id, seq, 'delete', {q.directory_type("location")}, {q.directory_name("location")}, 0 FROM drops
  WHERE location IS NOT NULL)""",
)
CATALOG_MUTATIONS = _FOLD + "SELECT * FROM muts"


def catalog_mutation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return mutations.counts(_all(spark, folder))


CATALOG_MUTATION_COUNTS = _FOLD + "SELECT op, type_name, count(*) AS n FROM muts GROUP BY op, type_name"


def drop_db_path(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.database_drops(
        standins.catalog_events(spark, folder),
        standins.catalog_dbs(spark, folder),
        standins.applications(spark, folder),
        FOLD,
    ).select("app_id", "seq", "op", "type_name", "qualified_name")


DROP_DB_PATH = _FOLD + "SELECT app_id, seq, op, type_name, qualified_name FROM muts WHERE op = 'delete'"


def rename_updates(spark: SparkSession, folder: str) -> DataFrame:
    updates = _all(spark, folder).where("op = 'update'")
    return updates.select(
        "seq",
        "type_name",
        "qualified_name",
        F.col("attrs")["qualifiedName"].alias("new_qualified_name"),
        F.col("attrs")["name"].alias("new_name"),
    )


RENAME_UPDATES = (
    _FOLD
    + """SELECT seq, 'spark_table' AS type_name, prefix || db || '.' || name AS qualified_name,
    prefix || db || '.' || new_name AS new_qualified_name, new_name FROM own_events WHERE event = 'RenameTable'
  UNION ALL SELECT seq, 'spark_storagedesc', prefix || db || '.' || name || '.storageFormat',
    prefix || db || '.' || new_name || '.storageFormat', NULL FROM own_events WHERE event = 'RenameTable'"""
)


def definitions_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The comment a table had at each of its events, and its database's description."""
    events = catalog.own_events(standins.catalog_events(spark, folder), standins.applications(spark, folder))
    found = catalog.with_definitions(
        events.where("name is not null"),
        standins.catalog_tables(spark, folder),
        standins.catalog_dbs(spark, folder),
        FOLD,
    )
    return found.select("seq", "event", F.col("t.comment").alias("comment"), F.col("d.description").alias("description"))


DEFINITIONS_AS_OF = (
    _FOLD
    + f"""SELECT e.seq, e.event, t.comment, d.description FROM own_events e
    LEFT JOIN tables t ON {_TABLE_AT} LEFT JOIN dbs d ON {_DB_AT}
    WHERE e.event IN ('CreateTable', 'RenameTable', 'AlterTable', 'DropTable', 'CreateTablePre')"""
)


def mutation_log(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON messages of all catalog mutations, read back field by field."""
    sent = mutations.messages(_all(spark, folder))
    return sent.select(
        "key",
        F.get_json_object("value", "$.op").alias("op"),
        F.get_json_object("value", "$.seq").cast("bigint").alias("seq"),
        F.get_json_object("value", "$.create_rank").cast("int").alias("create_rank"),
        F.get_json_object("value", "$.attrs.name").alias("name"),
    )


MUTATION_LOG = (
    _FOLD
    + """SELECT m.type_name || '|' || m.qualified_name AS key, m.op, m.seq, m.create_rank,
    CASE WHEN m.op = 'create' AND m.type_name = 'spark_db' THEN e.db
         WHEN m.op = 'create' AND m.type_name = 'spark_table' THEN e.name
         WHEN m.op = 'update' AND m.type_name = 'spark_table' THEN e.new_name END AS name
    FROM muts m JOIN own_events e ON m.seq = e.seq"""
)


QUERIES = {
    "db_entities": (db_entities, DB_ENTITIES),
    "storage_entities": (storage_entities, STORAGE_ENTITIES),
    "table_entities": (table_entities, TABLE_ENTITIES),
    "table_relationships": (table_relationships, TABLE_RELATIONSHIPS),
    "table_entities_alter": (table_entities_alter, TABLE_ENTITIES_ALTER),
    "hive_references": (hive_references, HIVE_REFERENCES),
    "entity_select": (entity_select, ENTITY_SELECT),
    "entity_single": (entity_single, ENTITY_SINGLE),
    "catalog_mutations": (catalog_mutations, CATALOG_MUTATIONS),
    "catalog_mutation_counts": (catalog_mutation_counts, CATALOG_MUTATION_COUNTS),
    "drop_db_path": (drop_db_path, DROP_DB_PATH),
    "rename_updates": (rename_updates, RENAME_UPDATES),
    "definitions_as_of": (definitions_as_of, DEFINITIONS_AS_OF),
    "mutation_log": (mutation_log, MUTATION_LOG),
}
