"""Queries over identities: paths, connectors, catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import names, paths, pushed
from weftline.operators import connectors, cover, entities
from weftline.plans import standin_sql as q
from weftline.settings import JobSettings
from weftline.sources import standins

HDFS = JobSettings(default_fs="hdfs://nn:8020", working_dir="/user/spark")


def path_identity(spark: SparkSession, folder: str) -> DataFrame:
    uri, plain = F.col("path"), F.col("plain")
    return paths.with_plain(standins.paths(spark, folder), "path").select(
        "page_id",
        paths.path_type(uri).alias("type_name"),
        paths.path_qualified_name(uri, plain).alias("qualified_name"),
        paths.path_name(uri, plain).alias("name"),
        paths.path_attr(uri, plain).alias("path"),
        paths.path_cluster(uri).alias("cluster"),
    )


PATH_IDENTITY = (
    q.with_(q.PATHS, q.path_parts("uri", "paths", "page_id"))
    + """SELECT page_id, type_name, qualified_name, CASE WHEN is_s3 THEN obj ELSE lower(plain) END AS name,
    CASE WHEN is_s3 THEN plain ELSE lower(plain) END AS path, CASE WHEN scheme = 'hdfs' THEN authority END AS cluster
    FROM parts"""
)


def path_resolve(spark: SparkSession, folder: str) -> DataFrame:
    bare = standins.bare_paths(spark, folder)
    return bare.select(
        "page_id",
        paths.resolve(F.col("path"), HDFS).alias("on_hdfs"),
        paths.resolve(F.col("path")).alias("on_local"),
    )


PATH_RESOLVE = """WITH bare AS (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN regexp_replace(rest, '^/', '') ELSE rest END AS path
  FROM (SELECT page_id, regexp_replace(url, '^https?://[^/]*', '') AS rest FROM pages)),
tidy AS (
  SELECT page_id, regexp_replace(CASE WHEN starts_with(path, '/') THEN path ELSE '/user/spark/' || path END, '(.)/$', '\\1') AS h,
         regexp_replace(CASE WHEN starts_with(path, '/') THEN path ELSE '/' || path END, '(.)/$', '\\1') AS l FROM bare)
SELECT page_id,
  'hdfs://nn:8020' || replace(replace(replace(h, '%', '%25'), '#', '%23'), '?', '%3F') AS on_hdfs,
  'file:' || replace(replace(replace(l, '%', '%25'), '#', '%23'), '?', '%3F') AS on_local
FROM tidy"""


def s3_chain(spark: SparkSession, folder: str) -> DataFrame:
    s3 = paths.with_plain(standins.paths(spark, folder).where(paths.is_s3(F.col("path"))), "path")
    graph = s3.select("page_id", F.inline(entities.path_entities(F.col("path"), F.col("plain"))))
    return graph.select(
        "page_id",
        "type_name",
        "qualified_name",
        "name",
        "create_rank",
        F.try_element_at("deps", F.lit(1))["qualified_name"].alias("depends_on"),
        F.try_element_at("rels", F.lit(1))["rel"].alias("rel"),
    )


S3_CHAIN = (
    q.with_(q.PATHS, q.path_parts("uri", "paths", "page_id"))
    + """SELECT page_id, 'aws_s3_object' AS type_name, qualified_name, obj AS name, 2 AS create_rank,
    's3://' || authority || dir AS depends_on, 'pseudoDirectory' AS rel FROM parts WHERE is_s3
    UNION ALL SELECT page_id, 'aws_s3_pseudo_dir', 's3://' || authority || dir, dir, 1, 's3://' || authority, 'bucket'
    FROM parts WHERE is_s3
    UNION ALL SELECT page_id, 'aws_s3_bucket', 's3://' || authority, authority, 0, NULL, NULL FROM parts WHERE is_s3"""
)


def _identity(frame: DataFrame) -> DataFrame:
    return frame.select("execution_id", "type_name", "qualified_name", "name", "cluster", "uri")


def jdbc_identity(spark: SparkSession, folder: str) -> DataFrame:
    found = connectors.datasets(standins.jdbc_options(spark, folder))
    return found.select("execution_id", "type_name", "qualified_name", "name")


JDBC_IDENTITY = """SELECT c_custkey AS execution_id, 'rdbms_table' AS type_name,
  CASE WHEN c_custkey % 9 = 8 THEN '' ELSE 'db' || c_nationkey END || '.' || lower(c_name) AS qualified_name, c_name AS name
FROM customer"""


def kafka_read_topics(spark: SparkSession, folder: str) -> DataFrame:
    return _identity(connectors.datasets(standins.kafka_read_options(spark, folder)))


_CLUSTER = "CASE WHEN user_id % 3 = 0 THEN 'Cluster' || (user_id % 5) ELSE 'primary' END"
KAFKA_READ_TOPICS = f"""WITH t AS (
  SELECT event_id, {_CLUSTER} AS cluster, unnest(CASE event_id % 4
    WHEN 0 THEN [event_type, 'second' || (user_id % 7)] WHEN 1 THEN [event_type, 'third' || (user_id % 5)]
    ELSE [] END) AS topic FROM events)
SELECT event_id AS execution_id, 'kafka_topic' AS type_name, topic || '@' || cluster AS qualified_name, topic AS name,
  cluster, topic AS uri FROM t"""


def kafka_write_topic(spark: SparkSession, folder: str) -> DataFrame:
    return _identity(connectors.datasets(standins.kafka_write_options(spark, folder)))


KAFKA_WRITE_TOPIC = f"""SELECT event_id AS execution_id, 'kafka_topic' AS type_name,
  event_type || '@' || {_CLUSTER} AS qualified_name, event_type AS name, {_CLUSTER} AS cluster, event_type AS uri
FROM events WHERE event_id % 5 <> 0"""


def hbase_identity(spark: SparkSession, folder: str) -> DataFrame:
    return _identity(connectors.datasets(standins.hbase_options(spark, folder)))


HBASE_IDENTITY = """WITH h AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'C' || c_nationkey ELSE 'primary' END AS cluster,
    CASE WHEN c_custkey % 4 = 1 THEN 'default' ELSE 'ns' || c_nationkey END AS ns,
    CASE WHEN c_custkey % 4 = 2 THEN 'ns' || c_nationkey || ':' ELSE '' END || 'tab' || c_custkey AS name
  FROM customer WHERE c_custkey % 4 <> 3)
SELECT k AS execution_id, 'hbase_table' AS type_name, ns || ':tab' || k || '@' || cluster AS qualified_name, name, cluster,
  ns || ':' || name AS uri FROM h"""


def hwc_identity(spark: SparkSession, folder: str) -> DataFrame:
    found = connectors.datasets(standins.hwc_options(spark, folder))
    return found.select("execution_id", "direction", "type_name", "qualified_name")


HWC_IDENTITY = """WITH h AS (
  SELECT p_partkey AS k, p_partkey % 6 AS shape, CASE WHEN p_partkey % 5 = 0 THEN 'home' ELSE 'default' END AS home,
    'tab' || p_size AS tab FROM part)
SELECT k AS execution_id, CASE WHEN shape = 4 THEN 'output' ELSE 'input' END AS direction, 'hive_table' AS type_name,
  CASE WHEN shape IN (1, 3) THEN 'db' || (k % 9) WHEN shape = 4 THEN 'field' || (k % 9) ELSE home END || '.' || tab
    || '@primary' AS qualified_name
FROM h WHERE shape <> 2 AND NOT (shape = 5 AND k % 4 = 3)"""


def rejected_options(spark: SparkSession, folder: str) -> DataFrame:
    every = standins.hwc_options(spark, folder).unionByName(standins.kafka_read_options(spark, folder))
    return connectors.rejected(every).select("app_id", "execution_id", "reason")


REJECTED_OPTIONS = """SELECT 'app-' || (p_partkey % 20) AS app_id, p_partkey AS execution_id,
  'unreadable options of hwc' AS reason FROM part WHERE p_partkey % 6 = 2
UNION ALL SELECT 'app-' || (user_id % 20), event_id, 'unreadable options of kafka' FROM events WHERE event_id % 4 = 3"""


def external_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Entities of everything outside the catalog, as attribute rows."""
    graph = entities.path_graph(standins.paths(spark, folder), "path")
    for rows in (standins.hbase_options, standins.kafka_write_options, standins.jdbc_options):
        graph = graph.unionByName(entities.connector_graph(connectors.datasets(rows(spark, folder))))
    return entities.attribute_rows(graph).distinct()


EXTERNAL_ENTITIES = (
    q.with_(
        q.PATHS,
        q.path_parts("uri", "paths", "page_id"),
        f"hb AS ({HBASE_IDENTITY})",
        f"kw AS ({KAFKA_WRITE_TOPIC})",
    )
    + """SELECT DISTINCT * FROM (
  SELECT 'aws_s3_object' AS type_name, qualified_name, 'path' AS attr, plain AS value FROM parts WHERE is_s3
  UNION ALL SELECT 'aws_s3_pseudo_dir', 's3://' || authority || dir, 'objectPrefix', 's3://' || authority || dir
    FROM parts WHERE is_s3
  UNION ALL SELECT type_name, qualified_name, 'path', lower(plain) FROM parts WHERE NOT is_s3
  UNION ALL SELECT type_name, qualified_name, 'clusterName', authority FROM parts WHERE scheme = 'hdfs'
  UNION ALL SELECT type_name, qualified_name, 'clusterName', cluster FROM hb
  UNION ALL SELECT type_name, qualified_name, 'uri', uri FROM hb
  UNION ALL SELECT type_name, qualified_name, 'clusterName', cluster FROM kw
  UNION ALL SELECT type_name, qualified_name, 'uri', uri FROM kw
  UNION ALL SELECT type_name, qualified_name, 'topic', uri FROM kw)"""
)


def catalog_prefix(spark: SparkSession, folder: str) -> DataFrame:
    prefix = names.catalog_prefix(
        F.col("app_id"), F.col("implementation"), F.col("metastore_uris"), F.col("connection_driver"), F.col("connection_url")
    )
    db = names.database_identifier(F.col("db"))
    table = names.identifier(F.col("table"))
    remote = names.is_remote(F.col("implementation"), F.col("metastore_uris"))
    rows = standins.catalogs(spark, folder).withColumn("prefix", prefix)
    return rows.select(
        "app_id",
        remote.alias("remote_hms"),
        "prefix",
        names.db_name(F.col("prefix"), db).alias("db_name"),
        names.table_name(F.col("prefix"), db, table).alias("table_name"),
        names.storage_name(F.col("prefix"), db, table).alias("storage_name"),
        names.hive_name(F.col("db"), F.col("table"), F.lit("primary")).alias("hive_name"),
    )


CATALOG_PREFIX = """WITH c AS (
  SELECT 'app-' || c_custkey AS app_id, c_custkey % 5 = 2 AS remote_hms,
    CASE c_custkey % 5 WHEN 2 THEN 'thrift://ms' || c_nationkey || ':9083' WHEN 4 THEN 'jdbc:mysql://h/hive' || c_nationkey
      ELSE 'app-' || c_custkey END || '.' AS prefix,
    CASE WHEN c_custkey % 7 <> 0 THEN 'db' || c_nationkey END AS db, 'tab' || c_custkey AS tab FROM customer)
SELECT app_id, remote_hms, prefix, prefix || coalesce(db, 'default') AS db_name,
  prefix || coalesce(db, 'default') || '.' || tab AS table_name,
  prefix || coalesce(db, 'default') || '.' || tab || '.storageFormat' AS storage_name,
  db || '.' || tab || '@primary' AS hive_name
FROM c"""


def connector_detection(spark: SparkSession, folder: str) -> DataFrame:
    """Datasets of options whose connector is named by a class."""
    found = connectors.datasets(standins.class_options(spark, folder))
    return found.select("app_id", "execution_id", "connector", "qualified_name")


CONNECTOR_DETECTION = """SELECT 'app-' || (c_custkey % 20) AS app_id, c_custkey AS execution_id,
  ['jdbc', 'hbase', 'kafka', 'hwc'][c_custkey % 5 + 1] AS connector,
  ['db' || c_nationkey || '.' || lower(c_name), 'default:tab' || c_custkey || '@primary', 'top' || c_nationkey || '@primary',
   'default.tab' || c_nationkey || '@primary'][c_custkey % 5 + 1] AS qualified_name
FROM customer WHERE c_custkey % 5 < 4"""


COVERED, COVER = 97, 40


def scan_cover(spark: SparkSession, folder: str) -> DataFrame:
    scans = standins.paths(spark, folder).select((F.col("page_id") % COVERED).alias("scan"), "path")
    return cover.directory_cover(scans, ["scan"], most=COVER)


SCAN_COVER = (
    q.with_(q.PATHS)
    + f""", e AS (SELECT DISTINCT page_id % {COVERED} AS scan, regexp_extract(uri, '^[A-Za-z0-9]+://[^/]*') AS root,
    list_filter(string_split(regexp_replace(uri, '^[A-Za-z0-9]+://[^/]*', ''), '/'), lambda x: x <> '') AS names FROM paths),
  d AS (SELECT scan, unnest(range(0, m + 1)) AS depth FROM (SELECT scan, max(len(names)) AS m FROM e GROUP BY scan)),
  c AS (SELECT scan, depth, count(DISTINCT array_to_string([root] || names[1:depth], '/')) AS n FROM e JOIN d USING (scan) GROUP BY scan, depth),
  t AS (SELECT scan, coalesce(max(depth) FILTER (n <= {COVER}), 0) AS depth FROM c GROUP BY scan),
  p AS (SELECT scan, array_to_string([root] || names[1:depth], '/') AS node, array_to_string([root] || names, '/') AS whole FROM e JOIN t USING (scan)),
  nodes AS (SELECT DISTINCT scan, node FROM p),
  tops AS (SELECT a.scan, a.node, min_by(b.node, length(b.node)) AS top FROM nodes a JOIN nodes b ON a.scan = b.scan AND (a.node = b.node OR starts_with(a.node, b.node || '/')) GROUP BY a.scan, a.node)
SELECT scan, CASE WHEN count(*) = 1 THEN min(whole) ELSE top END AS node, CAST(count(*) AS BIGINT) AS n_paths FROM p JOIN tops USING (scan, node) GROUP BY scan, top"""
)


def pushed_tables(spark: SparkSession, folder: str) -> DataFrame:
    asked = standins.pushed_queries(spark, folder)
    return asked.select("o_orderkey", F.array_join(pushed.tables(F.col("query")), " ").alias("tables"))


PUSHED_TABLES = """SELECT o_orderkey, CASE o_orderkey % 6
  WHEN 0 THEN 'sales.t' || o_custkey WHEN 1 THEN 't' || o_custkey WHEN 2 THEN 'src' || o_custkey || ' dim'
  WHEN 3 THEN 'left.a' || o_custkey || ' right.b' WHEN 4 THEN 'deep.t' || o_custkey ELSE '' END AS tables FROM orders"""


QUERIES = {
    "scan_cover": (scan_cover, SCAN_COVER),
    "pushed_tables": (pushed_tables, PUSHED_TABLES),
    "connector_detection": (connector_detection, CONNECTOR_DETECTION),
    "path_identity": (path_identity, PATH_IDENTITY),
    "path_resolve": (path_resolve, PATH_RESOLVE),
    "s3_chain": (s3_chain, S3_CHAIN),
    "jdbc_identity": (jdbc_identity, JDBC_IDENTITY),
    "kafka_read_topics": (kafka_read_topics, KAFKA_READ_TOPICS),
    "kafka_write_topic": (kafka_write_topic, KAFKA_WRITE_TOPIC),
    "hbase_identity": (hbase_identity, HBASE_IDENTITY),
    "hwc_identity": (hwc_identity, HWC_IDENTITY),
    "rejected_options": (rejected_options, REJECTED_OPTIONS),
    "external_entities": (external_entities, EXTERNAL_ENTITIES),
    "catalog_prefix": (catalog_prefix, CATALOG_PREFIX),
}
