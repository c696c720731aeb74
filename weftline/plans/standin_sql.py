"""The stand-in projections of ``sources/standins.py`` in SQL, as common table expressions."""

from __future__ import annotations


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


EDGES = """edges AS (
  SELECT 'app-' || (l_orderkey % 20) AS app_id, l_orderkey AS execution_id, 'input' AS direction,
         't' || (l_partkey % 40) AS qualified_name, CAST(l_linenumber AS BIGINT) AS ordinal FROM lineitem
  UNION ALL
  SELECT 'app-' || (l_orderkey % 20), l_orderkey, 'output', 't' || (l_suppkey % 40), CAST(l_linenumber AS BIGINT)
  FROM lineitem)"""

CYCLIC = """cyclic AS (
  SELECT DISTINCT o.execution_id FROM edges o
  JOIN edges i ON o.execution_id = i.execution_id AND o.qualified_name = i.qualified_name
  WHERE o.direction = 'output' AND i.direction = 'input')"""

CLEAN = """clean AS (
  SELECT e.* FROM edges e WHERE direction = 'input' OR NOT EXISTS (SELECT 1 FROM cyclic c WHERE c.execution_id = e.execution_id))"""

STREAM_EDGES = """stream_edges AS (
  SELECT 'q' || user_id AS query_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id,
         CASE WHEN event_id % 4 = 0 THEN 'output' ELSE 'input' END AS direction,
         event_type || '@primary' AS qualified_name
  FROM events)"""

PATHS = """paths AS (
  SELECT page_id, ['s3', 's3a', 'hdfs', 'file', 's3n'][CAST(page_id % 5 AS INTEGER) + 1] || '://'
         || regexp_replace(url, '^https?://', '') AS uri
  FROM pages)"""


def path_parts(uri: str, source: str, keep: str) -> str:
    """Common table expression ``parts``: the pieces of the column ``uri`` of ``source``."""
    return f"""raw_parts AS (
  SELECT {keep}, {uri} AS uri, regexp_extract({uri}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme,
         regexp_extract({uri}, '^[^:/?#]+://([^/?#]*)', 1) AS authority,
         regexp_extract({uri}, '^[^:/?#]+:(//[^/?#]*)?([^?#]*)', 2) AS raw FROM {source}),
plain_parts AS (
  SELECT *, CASE WHEN length(raw) > 1 THEN regexp_replace(raw, '/$', '') ELSE raw END AS plain FROM raw_parts),
parts AS (
  SELECT *, scheme IN ('s3', 's3a', 's3n') AS is_s3, regexp_replace(plain, '[^/]*$', '') AS dir,
         regexp_replace(plain, '^.*/', '') AS obj,
         CASE WHEN scheme = 'hdfs' THEN 'hdfs_path' WHEN scheme IN ('s3', 's3a', 's3n') THEN 'aws_s3_object'
              ELSE 'fs_path' END AS type_name,
         CASE WHEN scheme IN ('s3', 's3a', 's3n')
              THEN 's3://' || authority || regexp_replace(plain, '[^/]*$', '') || regexp_replace(plain, '^.*/', '')
              ELSE uri END AS qualified_name
  FROM plain_parts)"""


APPLICATIONS = """applications AS (
  SELECT 'app-' || n AS app_id, CASE WHEN n = 0 THEN 'Spark shell' ELSE 'job' || n END AS app_name,
         'user' || (n % 3) AS usr, CASE WHEN n >= 18 THEN 'thrift://ms:9083.' ELSE 'app-' || n || '.' END AS prefix,
         n >= 18 AS remote_hms
  FROM (SELECT DISTINCT o_custkey % 20 AS n FROM orders))"""

CATALOG_DBS = """dbs AS (
  SELECT DISTINCT 'app-' || (k % 20) AS app_id, 'db' || (k % 25) AS db,
         CAST(CASE WHEN k % 3 = 0 THEN 3000 ELSE 0 END AS BIGINT) AS since,
         CASE WHEN k % 4 <> 0 THEN 'database ' || k END AS description,
         ['hdfs://nn:8020', 's3a://lake', 'file:'][CAST(k % 3 AS INTEGER) + 1] || '/Wh/db' || (k % 25) AS location,
         '{"k":"' || k || '"}' AS parameters, 'owner' || (k % 6) AS owner
  FROM (SELECT c_custkey % 100 AS k FROM customer))"""

CATALOG_TABLES = """tables AS (
  SELECT 'app-' || (k % 20) AS app_id, 'db' || (k % 25) AS db, 't' || k AS name, since,
         CASE WHEN since = 0 AND k % 3 = 0 THEN 5000 ELSE 9000000000000 END AS until,
         ['MANAGED', 'EXTERNAL', 'VIEW'][CAST(k % 3 AS INTEGER) + 1] AS table_type,
         CASE WHEN k % 4 <> 0 THEN ['parquet', 'orc'][CAST(k % 2 AS INTEGER) + 1] ELSE '' END AS provider,
         'struct<id:bigint,c' || n || ':string>' AS schema_desc, 'owner' || (k % 6) AS owner,
         strftime(make_timestamp(k * 86400000000), '%Y-%m-%d %H:%M:%S') AS create_time,
         CASE WHEN since > 0 THEN 'altered' WHEN k % 2 = 0 THEN lower(seg) END AS comment,
         CASE WHEN k % 2 = 0 THEN '["p"]' ELSE '[]' END AS partition_columns,
         CASE WHEN k % 5 = 0 THEN '{"numBuckets":"' || (n + 1) || '"}' END AS bucket_spec,
         '{"n":"' || n || '"}' AS parameters, CASE WHEN k % 3 <> 2 THEN 'hdfs://nn:8020/Wh/t' || k END AS location,
         CASE WHEN k % 4 = 1 THEN 'in.Format' END AS input_format,
         CASE WHEN k % 4 = 1 THEN 'out.Format' END AS output_format,
         CASE WHEN k % 4 = 2 THEN 'a.Serde' END AS serde,
         CASE WHEN k % 7 = 0 THEN 'true' ELSE 'false' END AS compressed,
         '{"path":"/p' || k || '"}' AS storage_parameters,
         CASE WHEN k % 2 = 0 THEN 'Catalog' END AS partition_provider
  FROM (SELECT c_custkey AS k, c_nationkey AS n, c_mktsegment AS seg, 0 AS since FROM customer
        UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment, 5000 FROM customer WHERE c_custkey % 3 = 0))"""

CATALOG_EVENTS = """catalog_events AS (
  SELECT 'app-' || (o_custkey % 20) AS app_id, 'db' || (o_custkey % 25) AS db, o_orderkey AS seq,
         ['CreateDatabase', 'AlterDatabase', 'CreateTable', 'RenameTable', 'AlterTable', 'AlterTable', 'DropTable',
          'DropDatabasePre', 'DropDatabase', 'CreateTablePre'][CAST(o_orderkey % 10 AS INTEGER) + 1] AS event,
         't' || o_custkey AS name, 'r' || o_custkey AS new_name,
         CASE WHEN o_orderkey % 10 = 4 THEN 'table' ELSE 'schema' END AS kind
  FROM orders)"""

OWN_EVENTS = """own_events AS (
  SELECT e.*, a.prefix FROM catalog_events e JOIN applications a ON e.app_id = a.app_id WHERE NOT a.remote_hms)"""


def attribute_list(pairs: dict[str, str]) -> str:
    """List of ``{attr, value}`` structs to unnest."""
    return "[" + ", ".join(f"{{'attr': '{k}', 'value': CAST({v} AS VARCHAR)}}" for k, v in pairs.items()) + "]"


DB_ATTRS = {
    "clusterName": "'primary'",
    "description": "description",
    "location": "location",
    "parameters": "parameters",
    "ownerType": "'USER'",
}
STORAGE_ATTRS = {
    "location": "location",
    "inputFormat": "input_format",
    "outputFormat": "output_format",
    "serde": "serde",
    "compressed": "compressed",
    "parameters": "storage_parameters",
}
TABLE_ATTRS = {
    "tableType": "table_type",
    "schemaDesc": "schema_desc",
    "provider": "provider",
    "partitionProvider": "partition_provider",
    "partitionColumnNames": "partition_columns",
    "bucketSpec": "bucket_spec",
    "owner": "owner",
    "ownerType": "'USER'",
    "createTime": "create_time",
    "parameters": "parameters",
    "comment": "comment",
    "unsupportedFeatures": "'[]'",
}

ML_EVENTS = """ml_events AS (
  SELECT 'app-' || (doc_id % 20) AS app_id, doc_id AS seq,
         ['CreatePipeline', 'CreateModel', 'SavePipeline', 'SaveModel', 'LoadModel', 'Transform',
          'Other'][CAST((doc_id // 20) % 7 AS INTEGER) + 1] AS event,
         'pipeline_' || lang AS uid,
         ['hdfs://nn:8020/Ml', 's3a://models/ml', 'file:/Ml'][CAST(doc_id % 3 AS INTEGER) + 1] || '/' || lang || '/'
           || doc_id AS directory
  FROM documents)"""


def directory_type(uri: str) -> str:
    return (
        f"CASE WHEN {uri} LIKE 'hdfs:%' THEN 'hdfs_path' WHEN {uri} LIKE 's3a:%' THEN 'aws_s3_object' ELSE 'fs_path' END"
    )


def directory_name(uri: str) -> str:
    return f"CASE WHEN {uri} LIKE 's3a:%' THEN 's3:' || substr({uri}, 5) ELSE {uri} END"


ML_SAVES = """pipeline_saves AS (
  SELECT s.app_id, s.seq, s.uid, s.directory AS pipeline_uri FROM ml_events s
  WHERE s.event = 'SavePipeline' AND EXISTS (
    SELECT 1 FROM ml_events c WHERE c.event = 'CreatePipeline' AND c.app_id = s.app_id AND c.uid = s.uid AND c.seq < s.seq)),
model_saves AS (
  SELECT s.app_id, s.seq, s.uid, s.directory AS model_uri,
         (SELECT max_by(p.pipeline_uri, p.seq) FROM pipeline_saves p
          WHERE p.app_id = s.app_id AND p.uid = s.uid AND p.seq <= s.seq) AS pipeline_uri,
         (SELECT max(c.seq) FROM ml_events c WHERE c.event = 'CreatePipeline' AND c.app_id = s.app_id
          AND c.uid = s.uid AND c.seq <= s.seq) AS dataset_execution_id,
         EXISTS (SELECT 1 FROM ml_events c WHERE c.event = 'CreateModel' AND c.app_id = s.app_id
          AND c.uid = s.uid AND c.seq < s.seq) AS has_model
  FROM ml_events s
  WHERE s.event = 'SaveModel' AND EXISTS (
    SELECT 1 FROM pipeline_saves p WHERE p.app_id = s.app_id AND p.uid = s.uid AND p.seq <= s.seq))"""

# Statements: one per order. What each reads and writes, straight from the order, without any plan text.
STATEMENTS = """statements AS (
  SELECT o_orderkey AS k, o_custkey AS c, 'app-' || (o_custkey % 20) AS app_id, o_custkey % 20 >= 18 AS remote_hms,
         CAST(o_orderkey % 16 AS INTEGER) AS kind, CAST(o_custkey % 4 AS INTEGER) AS shape,
         o_orderpriority = '5-LOW' AS failed,
         NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS finished
  FROM orders),
good AS (SELECT * FROM statements WHERE finished AND NOT failed),
named AS (
  SELECT *, CASE kind WHEN 0 THEN 'InsertIntoHadoopFsRelationCommand' WHEN 1 THEN 'InsertIntoHadoopFsRelationCommand'
    WHEN 2 THEN 'CreateDataSourceTableAsSelectCommand' WHEN 3 THEN 'CreateViewCommand'
    WHEN 5 THEN 'CreateDataSourceTableCommand' WHEN 6 THEN 'LoadDataCommand' WHEN 7 THEN 'InsertIntoHiveDirCommand'
    WHEN 9 THEN 'SaveIntoDataSourceCommand' WHEN 10 THEN 'InsertIntoHadoopFsRelationCommand'
    WHEN 11 THEN 'WriteToDataSourceV2' WHEN 12 THEN 'InsertIntoHiveTable' WHEN 13 THEN 'CreateHiveTableAsSelectCommand'
    WHEN 14 THEN 'StreamSink' WHEN 15 THEN 'CreateTableCommand' END AS command,
    CASE WHEN remote_hms THEN 'hive_table' ELSE 'spark_table' END AS table_type,
    CASE WHEN remote_hms THEN '' ELSE app_id || '.' END AS pre,
    CASE WHEN remote_hms THEN '@primary' ELSE '' END AS post,
    CASE WHEN kind IN (0, 1, 7, 12) THEN 1 WHEN kind = 10 THEN 1 WHEN kind = 14 THEN -1 ELSE 0 END AS command_pos
  FROM good),
querying AS (
  SELECT * FROM named WHERE kind IN (0, 1, 2, 3, 9, 11, 12, 13, 14) OR (kind = 7 AND c % 10 <> 0)),
statement_edges AS (
  SELECT app_id, k, kind, command, command_pos, 'input' AS direction, table_type AS type_name,
         pre || 'db' || (c % 5) || '.src' || (c % 40) || post AS qualified_name FROM querying
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'input', 'hdfs_path', 'hdfs://nn:8020/Raw/' || (c % 100) FROM querying
  WHERE shape = 0 AND kind <> 3
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'input', 'aws_s3_object', 's3://lake/in/' || (c % 7) FROM querying
  WHERE shape = 0 AND kind <> 3
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'input', table_type, pre || 'db' || (c % 5) || '.h' || (c % 30) || post
  FROM querying WHERE shape = 1
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'input', 'rdbms_table', 'src.tab' || (c % 20) FROM querying WHERE shape = 3
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'output', table_type, pre || 'db' || (c % 5) || '.'
         || CASE kind WHEN 0 THEN CASE WHEN c % 8 = 0 THEN 'src' || (c % 40) ELSE 'out' || (c % 40) END
            WHEN 2 THEN 'ctas' || k WHEN 3 THEN 'view' || k WHEN 12 THEN 'hive' || (c % 40) WHEN 13 THEN 'hctas' || k END
         || post
  FROM querying WHERE kind IN (0, 2, 3, 12, 13)
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'output', 'aws_s3_object', 's3://lake/d' || (c % 50) || '/f' || k
  FROM querying WHERE kind = 1
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'output', 'hdfs_path', 'hdfs://nn:8020/Dir/' || k FROM querying WHERE kind = 7
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'output', 'hdfs_path', 'hdfs://nn:8020/Stream/' || (c % 90)
  FROM querying WHERE kind = 14
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'output',
         ['rdbms_table', 'hbase_table', 'kafka_topic'][shape + 1],
         ['dst.out' || (c % 20), 'default:out' || (c % 20) || '@primary', 'out' || (c % 20) || '@primary'][shape + 1]
  FROM querying WHERE kind = 9 AND shape < 3
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'output', CASE WHEN c % 2 = 0 THEN 'kafka_topic' ELSE 'hive_table' END,
         CASE WHEN c % 2 = 0 THEN 'v2' || (c % 20) || '@primary' ELSE 'w.v2' || (c % 20) || '@primary' END
  FROM querying WHERE kind = 11
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'input', 'hdfs_path', 'hdfs://nn:8020/Load/' || k FROM named WHERE kind = 6
  UNION ALL
  SELECT app_id, k, kind, command, command_pos, 'output', table_type, pre || 'db' || (c % 5) || '.load' || (c % 40) || post
  FROM named WHERE kind = 6
  UNION ALL
  SELECT app_id, k, kind, command, 1, 'input', table_type, pre || 'db' || (c % 5) || '.left' || (c % 40) || post
  FROM named WHERE kind = 10
  UNION ALL
  SELECT app_id, k, kind, command, 1, 'output', table_type, pre || 'db' || (c % 5) || '.multi' || (c % 40) || post
  FROM named WHERE kind = 10
  UNION ALL
  SELECT app_id, k, kind, command, 5, 'input', table_type, pre || 'db' || (c % 5) || '.right' || (c % 40) || post
  FROM named WHERE kind = 10
  UNION ALL
  SELECT app_id, k, kind, command, 5, 'output', 'fs_path', 'file:/wh/' || k FROM named WHERE kind = 10)"""
