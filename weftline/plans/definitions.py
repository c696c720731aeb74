"""Queries over the definitions of tables that statements name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import definitions, harvest, mutations
from weftline.plans import standin_sql as q
from weftline.plans.statements import commands_and_leaves, staged
from weftline.settings import JobSettings, written
from weftline.sources import event_log, standins

# A narrow span, so that lookups cross many spans on test data too.
SETTINGS = JobSettings(asof_width=1 << 19)


def definition_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """From when to when each table name had which definition, over drops and chains of renames."""
    tables, _, events = standins.statement_catalog(spark, folder)
    known = definitions.intervals(tables, events, SETTINGS)
    return known.select("app_id", "db", "name", "since", "until", F.col("t.name").alias("defined_as"), F.col("t.comment").alias("comment"))


_DEFS = """listed AS (SELECT DISTINCT o_custkey % 40 AS s FROM orders),
defs AS (
  SELECT s, 'src' || s AS name, 0 AS since, 'src' || s AS defined_as, 'first' AS comment FROM listed
  UNION ALL SELECT s, 'out' || s, 0, 'out' || s, 'first' FROM listed
  UNION ALL SELECT s, 'out' || s, 2000000, 'out' || s, 'altered' FROM listed WHERE s % 3 = 0
  UNION ALL SELECT s, 'old' || s, 0, 'old' || s, 'renamed' FROM listed WHERE s % 2 = 0
  UNION ALL SELECT s, 'old' || s, 1000000 + s, NULL, NULL FROM listed WHERE s % 2 = 0
  UNION ALL SELECT s, 'mid' || s, 1000000 + s, 'old' || s, 'renamed' FROM listed WHERE s % 2 = 0
  UNION ALL SELECT s, 'mid' || s, 2500000 + s, NULL, NULL FROM listed WHERE s % 2 = 0
  UNION ALL SELECT s, 'left' || s, 2500000 + s, 'old' || s, 'renamed' FROM listed WHERE s % 2 = 0
  UNION ALL SELECT s, 'left' || s, 0, 'left' || s, 'first' FROM listed WHERE s % 2 = 1
  UNION ALL SELECT s, 'right' || s, 0, 'right' || s, 'first' FROM listed
  UNION ALL SELECT s, 'right' || s, 3000000 + s, NULL, NULL FROM listed WHERE s % 4 = 1
  UNION ALL SELECT s, 'load' || s, 1500000, 'load' || s, 'late' FROM listed
  UNION ALL SELECT s, 'multi' || s, 0, 'multi' || s, 'first' FROM listed WHERE s % 5 <> 0
  UNION ALL SELECT o_custkey % 40, made || o_orderkey, o_orderkey * 1000 + 200, made || o_orderkey, 'made' FROM (
    SELECT *, CASE o_orderkey % 16 WHEN 2 THEN 'ctas' WHEN 13 THEN 'hctas' WHEN 5 THEN 'new' WHEN 15 THEN 'hnew'
      WHEN 3 THEN CASE WHEN o_custkey % 2 = 0 THEN 'view' END END AS made FROM orders) WHERE made IS NOT NULL),
spans AS (SELECT 'app-' || (s % 20) AS app_id, 'db' || (s % 5) AS db, name, CAST(since AS BIGINT) AS since,
  CAST(lead(since) OVER (PARTITION BY s, name ORDER BY since) AS BIGINT) AS until, defined_as, comment, 'owner' || (s % 6) AS owner FROM defs)"""
DEFINITION_INTERVALS = q.with_(_DEFS) + "SELECT app_id, db, name, since, until, defined_as, comment FROM spans"

_MET: dict[tuple[str, str], DataFrame] = {}


def _met(spark: SparkSession, folder: str) -> DataFrame:
    """References of statements with the definitions that held, written once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MET:
        log, _ = staged(spark, folder)
        tables, dbs, events = standins.statement_catalog(spark, folder)
        chosen, leaves = commands_and_leaves(spark, folder)
        refs = definitions.references(chosen, leaves, event_log.statement_times(log.started, log.ended), SETTINGS)
        spans = definitions.intervals(tables, events, SETTINGS)
        _MET[key] = written(definitions.as_of(refs, spans, dbs, events, log.applications, SETTINGS), "met")
    return _MET[key]


def statement_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Tables that statements name, with database and storage and their attributes as of the statement."""
    told = definitions.graph(_met(spark, folder), SETTINGS)
    attr = lambda name: F.try_element_at("attrs", F.lit(name)).alias(name)
    return told.select("app_id", "execution_id", "at", "type_name", "qualified_name", "is_reference", *map(attr, ("owner", "comment", "location", "description")), F.size("deps").alias("n_deps"))


# What statements name: tables read are looked up where the statement began, tables written or made where it ended.
_REFS = """edge_tables AS (
  SELECT DISTINCT app_id, k, 'input' AS direction, remote_hms, c, 'src' || (c % 40) AS name FROM querying
  UNION SELECT app_id, k, 'input', remote_hms, c, 'h' || (c % 30) FROM querying WHERE shape = 1
  UNION SELECT app_id, k, 'input', remote_hms, c, 'src' || (c % 40) FROM named WHERE kind = 7
  UNION SELECT app_id, k, 'input', remote_hms, c, 'h' || (c % 30) FROM named WHERE kind = 7 AND shape = 1
  UNION SELECT app_id, k, 'input', remote_hms, c, side || (c % 40) FROM named, (SELECT unnest(['left', 'right']) AS side) WHERE kind = 10
  UNION SELECT app_id, k, 'output', remote_hms, c, CASE kind
      WHEN 0 THEN CASE WHEN c % 8 = 0 THEN 'src' || (c % 40) ELSE 'out' || (c % 40) END WHEN 2 THEN 'ctas' || k
      WHEN 3 THEN 'view' || k WHEN 5 THEN 'new' || k WHEN 6 THEN 'load' || (c % 40) WHEN 10 THEN 'multi' || (c % 40)
      WHEN 12 THEN 'hive' || (c % 40) WHEN 13 THEN 'hctas' || k ELSE 'hnew' || k END
    FROM named WHERE kind IN (0, 2, 3, 5, 6, 10, 12, 13, 15)),
refs AS (SELECT *, 'db' || (c % 5) AS db, k * 1000 + CASE direction WHEN 'output' THEN 500 ELSE 0 END AS moment FROM edge_tables),
met AS (
  SELECT r.*, a.prefix, a.usr, x.since AS from_, x.defined_as, x.comment, x.owner AS t_owner,
    CASE WHEN r.app_id = 'app-4' AND r.moment >= 4000001 THEN NULL
         WHEN CAST(substr(r.app_id, 5) AS INTEGER) % 7 = 3 AND r.moment < 2000000 THEN NULL ELSE 'database ' || (c % 5) END AS d,
    CASE WHEN r.app_id = 'app-4' AND r.moment >= 4000001 AND x.since <= 4000001 THEN NULL ELSE x.defined_as END AS t
  FROM refs r JOIN applications a ON r.app_id = a.app_id
  LEFT JOIN spans x ON x.app_id = r.app_id AND x.db = r.db AND x.name = r.name AND x.since <= r.moment AND (x.until IS NULL OR x.until > r.moment)),
good_met AS (SELECT *, prefix || db AS dbn, prefix || db || '.' || name AS tn, CASE WHEN name LIKE 'hctas%' AND direction = 'output' THEN usr ELSE t_owner END AS owner
  FROM met WHERE NOT remote_hms AND t IS NOT NULL AND d IS NOT NULL)"""
_ALL = q.with_(q.STATEMENTS, q.APPLICATIONS, _DEFS, _REFS)
STATEMENT_ENTITIES = (
    _ALL
    + """SELECT app_id, k AS execution_id, moment AS "at", 'spark_db' AS type_name, dbn AS qualified_name, false AS is_reference, owner,
  CAST(NULL AS VARCHAR) AS comment, 'hdfs://nn:8020/Wh/' || db AS location, d AS description, 0 AS n_deps FROM good_met
UNION ALL SELECT app_id, k, moment, 'spark_storagedesc', tn || '.storageFormat', false, NULL, NULL, 'hdfs://nn:8020/Wh/' || t, NULL, 0 FROM good_met
UNION ALL SELECT app_id, k, moment, 'spark_table', tn, false, owner, comment, NULL, NULL, 2 FROM good_met
UNION ALL SELECT app_id, k, moment, 'hive_table', db || '.' || name || '@primary', true, NULL, NULL, NULL, NULL, 0 FROM met WHERE remote_hms"""
)


def unknown_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables that statements name and the catalog did not have then."""
    return definitions.unknown(_met(spark, folder))


UNKNOWN_TABLES = (
    _ALL
    + """SELECT DISTINCT app_id, k AS execution_id, CASE WHEN d IS NULL THEN 'unknown database' ELSE 'unknown table' END AS reason, db || '.' || name AS detail
  FROM met WHERE NOT remote_hms AND (t IS NULL OR d IS NULL)"""
)


def statement_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that create what statements name: each form of an entity once, read back from the JSON that is sent."""
    rows = definitions.creations(definitions.graph(_met(spark, folder), SETTINGS))
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return mutations.messages(rows).select("key", field("op").alias("op"), field("seq").cast("bigint").alias("seq"), field("create_rank").cast("int").alias("create_rank"), *(field(f"attrs.{a}").alias(a) for a in ("name", "owner", "comment")))


STATEMENT_MESSAGES = (
    _ALL
    + """SELECT 'spark_db|' || dbn AS key, 'create' AS op, CAST(min(moment) AS BIGINT) AS seq, 0 AS create_rank, db AS name, owner, CAST(NULL AS VARCHAR) AS comment FROM good_met GROUP BY app_id, dbn, db, owner
UNION ALL SELECT 'spark_storagedesc|' || tn || '.storageFormat', 'create', min(moment), 0, NULL, NULL, NULL FROM good_met GROUP BY app_id, tn, t
UNION ALL SELECT 'spark_table|' || tn, 'create', min(moment), 1, name, owner, comment FROM good_met GROUP BY app_id, tn, name, owner, comment"""
)


QUERIES = {
    "definition_intervals": (definition_intervals, DEFINITION_INTERVALS),
    "statement_entities": (statement_entities, STATEMENT_ENTITIES),
    "unknown_tables": (unknown_tables, UNKNOWN_TABLES),
    "statement_messages": (statement_messages, STATEMENT_MESSAGES),
}
