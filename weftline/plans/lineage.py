"""Queries over process edges and entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import names
from weftline.operators import entities, levels, lineage
from weftline.plans import standin_sql as q
from weftline.settings import written
from weftline.sources import standins
from weftline.sources.tables import table

EDGE_COLUMNS = ["app_id", "execution_id", "direction", "qualified_name"]


def cycle_clean(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.clean_cycles(standins.edges(spark, folder)).select(*EDGE_COLUMNS, "ordinal")


CYCLE_CLEAN = q.with_(q.EDGES, q.CYCLIC, q.CLEAN) + "SELECT * FROM clean"


def cyclic_queries(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.cyclic_queries(standins.edges(spark, folder)).select("app_id", "execution_id")


CYCLIC_QUERIES = (
    q.with_(q.EDGES, q.CYCLIC) + "SELECT 'app-' || (execution_id % 20) AS app_id, execution_id FROM cyclic"
)


def app_process(spark: SparkSession, folder: str) -> DataFrame:
    """The one process of each application with the edges of all its queries."""
    found = lineage.application_edges(lineage.clean_cycles(standins.edges(spark, folder)))
    return found.join(standins.applications(spark, folder), "app_id").select(
        F.col("app_id").alias("process"),
        names.process_name(F.col("app_name"), F.col("app_id")).alias("name"),
        F.col("user").alias("curr_user"),
        "direction",
        "type_name",
        "qualified_name",
    )


APP_PROCESS = (
    q.with_(q.EDGES, q.CYCLIC, q.CLEAN, q.APPLICATIONS)
    + """SELECT DISTINCT c.app_id AS process,
    CASE WHEN app_name = 'Spark shell' THEN 'Spark Job + ' || c.app_id ELSE app_name || ' ' || c.app_id END AS name,
    usr AS curr_user, direction, 'spark_table' AS type_name, qualified_name
    FROM clean c JOIN applications a ON c.app_id = a.app_id"""
)


def query_process(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.query_edges(lineage.clean_cycles(standins.edges(spark, folder))).select(*EDGE_COLUMNS)


QUERY_PROCESS = (
    q.with_(q.EDGES, q.CYCLIC, q.CLEAN) + "SELECT DISTINCT app_id, execution_id, direction, qualified_name FROM clean"
)


def process_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Process updates with their references, as a message bus gets them."""
    sent = lineage.process_messages(lineage.clean_cycles(standins.edges(spark, folder)))
    joined = [F.array_join(F.transform(c, lambda r: r["qualified_name"]), ",").alias(c) for c in ("inputs", "outputs")]
    return sent.select("app_id", "execution_id", *joined)


PROCESS_MESSAGES = (
    q.with_(q.EDGES, q.CYCLIC, q.CLEAN)
    + """SELECT app_id, execution_id,
    coalesce(string_agg(DISTINCT qualified_name, ',' ORDER BY qualified_name) FILTER (WHERE direction = 'input'), '') AS inputs,
    coalesce(string_agg(DISTINCT qualified_name, ',' ORDER BY qualified_name) FILTER (WHERE direction = 'output'), '') AS outputs
    FROM clean GROUP BY app_id, execution_id"""
)


def entity_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each dataset once, as first seen, out of one sighting per line item."""
    items = table(spark, folder, "lineitem", "l_orderkey", "l_partkey")
    sightings = items.select(
        F.lit("spark_table").alias("type_name"),
        standins.text("db<d>.t<n>", d=F.col("l_partkey") % 3, n=F.col("l_partkey") % 700).alias("qualified_name"),
        F.col("l_orderkey").alias("seq"),
        standins.text("seen by <o>", o=F.col("l_orderkey")).alias("comment"),
    )
    return entities.first_of_each(sightings, "seq")


ENTITY_DEDUP = """SELECT 'spark_table' AS type_name, 'db' || (l_partkey % 3) || '.t' || (l_partkey % 700) AS qualified_name,
  min(l_orderkey) AS seq, 'seen by ' || min(l_orderkey) AS comment
FROM lineitem GROUP BY 2"""


def create_order(spark: SparkSession, folder: str) -> DataFrame:
    """Every dependency with both ranks: what must exist first always has the lower one."""
    graph = entities.path_graph(standins.paths(spark, folder), "path").unionByName(
        entities.table_graph(catalog_definitions(spark, folder))
    )
    deps = entities.dependencies(graph).distinct()
    return deps.select(
        "*",
        entities.create_rank(F.col("type_name")).alias("create_rank"),
        entities.create_rank(F.col("dep_type_name")).alias("dep_create_rank"),
    )


def catalog_definitions(spark: SparkSession, folder: str) -> DataFrame:
    """Table definitions with their database's definition and their application's catalog."""
    tables = entities.plain_definitions(standins.catalog_tables(spark, folder))
    dbs = entities.plain_definitions(standins.catalog_dbs(spark, folder))
    apps = standins.applications(spark, folder).select("app_id", "prefix", "remote_hms")
    t = tables.select("app_id", "db", "since", F.struct(*tables.columns).alias("t"))
    d = dbs.select("app_id", "db", F.struct(*dbs.columns).alias("d"))
    return t.join(d, ["app_id", "db"]).join(apps, "app_id")


OWN_TABLES = """own_tables AS (SELECT t.*, a.prefix FROM tables t JOIN applications a ON t.app_id = a.app_id
  WHERE NOT a.remote_hms)"""

CREATE_ORDER = (
    q.with_(q.PATHS, q.path_parts("uri", "paths", "page_id"), q.APPLICATIONS, q.CATALOG_TABLES, OWN_TABLES)
    + """SELECT DISTINCT * FROM (
  SELECT 'aws_s3_object' AS type_name, qualified_name, 'aws_s3_pseudo_dir' AS dep_type_name,
    's3://' || authority || dir AS dep_qualified_name, 2 AS create_rank, 1 AS dep_create_rank FROM parts WHERE is_s3
  UNION ALL SELECT 'aws_s3_pseudo_dir', 's3://' || authority || dir, 'aws_s3_bucket', 's3://' || authority, 1, 0
    FROM parts WHERE is_s3
  UNION ALL SELECT 'spark_table', prefix || db || '.' || name, 'spark_db', prefix || db, 1, 0 FROM own_tables
  UNION ALL SELECT 'spark_table', prefix || db || '.' || name, 'spark_storagedesc',
    prefix || db || '.' || name || '.storageFormat', 1, 0 FROM own_tables)"""
)


def create_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The level each entity can be created at, from its own dependencies; none on a cycle or behind it."""
    needs = written(standins.entity_dependencies(spark, folder), "needs")
    every = needs.select(*levels.NAME).unionByName(needs.select(*levels.DEP).toDF(*levels.NAME))
    return levels.create_levels(every, needs)


CREATE_LEVELS = """SELECT DISTINCT * FROM (
  SELECT 'spark_process' AS type_name, 'app-' || (o_custkey % 20) AS qualified_name, 3 AS level FROM orders
  UNION ALL SELECT 'aws_s3_object', 's3://lake/d' || (o_custkey % 50) || '/f' || o_orderkey, 2 FROM orders
  UNION ALL SELECT 'aws_s3_pseudo_dir', 's3://lake/d' || (o_custkey % 50) || '/', 1 FROM orders
  UNION ALL SELECT 'aws_s3_bucket', 's3://lake', 0 FROM orders
  UNION ALL SELECT 'spark_table', 'app-' || (o_custkey % 20) || '.db' || (o_custkey % 5) || '.t' || (o_custkey % 40), 1 FROM orders
  UNION ALL SELECT 'spark_db', 'app-' || (o_custkey % 20) || '.db' || (o_custkey % 5), 0 FROM orders
  UNION ALL SELECT 'spark_storagedesc', 'app-' || (o_custkey % 20) || '.db' || (o_custkey % 5) || '.t' || (o_custkey % 40) || '.storageFormat', 0 FROM orders
  UNION ALL SELECT 'view', 'v' || n_nationkey, NULL FROM nation WHERE n_nationkey < 6)"""


QUERIES = {
    "create_levels": (create_levels, CREATE_LEVELS),
    "cycle_clean": (cycle_clean, CYCLE_CLEAN),
    "cyclic_queries": (cyclic_queries, CYCLIC_QUERIES),
    "app_process": (app_process, APP_PROCESS),
    "query_process": (query_process, QUERY_PROCESS),
    "process_messages": (process_messages, PROCESS_MESSAGES),
    "entity_dedup": (entity_dedup, ENTITY_DEDUP),
    "create_order": (create_order, CREATE_ORDER),
}
