"""Queries over machine-learning events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import lineage, ml
from weftline.plans import standin_sql as q
from weftline.settings import JobSettings
from weftline.sources import standins
from weftline.sources.tables import table

SETTINGS = JobSettings(asof_width=64)


def ml_entities(spark: SparkSession, folder: str) -> DataFrame:
    graph = ml.graph(standins.ml_events(spark, folder), SETTINGS)
    wanted = graph.where(F.col("type_name").isin("spark_ml_pipeline", "spark_ml_model", "fs_path", "hdfs_path", "aws_s3_object"))
    return wanted.select(
        "app_id",
        "seq",
        "type_name",
        "qualified_name",
        F.try_element_at("rels", F.lit(1))["qualified_name"].alias("linked_to"),
    )


def _thing(kind: str, name: str, link: str, source: str, uri: str) -> str:
    return f"SELECT app_id, seq, {kind} AS type_name, {name} AS qualified_name, {link} AS linked_to FROM {source}"


def _dir_link(uri: str) -> str:
    # An S3 object links to its pseudo directory, other paths link to nothing.
    return f"CASE WHEN {uri} LIKE 's3a:%' THEN regexp_replace({q.directory_name(uri)}, '[^/]*$', '') END"


def _directory(uri: str, source: str) -> str:
    return _thing(q.directory_type(uri), q.directory_name(uri), _dir_link(uri), source, uri)


ML_ENTITIES = q.with_(q.ML_EVENTS, q.ML_SAVES) + " UNION ALL ".join(
    [
        _directory("pipeline_uri", "pipeline_saves"),
        _thing("'spark_ml_pipeline'", "uid", q.directory_name("pipeline_uri"), "pipeline_saves", ""),
        _directory("pipeline_uri", "model_saves"),
        _directory("model_uri", "model_saves"),
        _thing("'spark_ml_model'", "replace(uid, 'pipeline', 'model')", q.directory_name("model_uri"), "model_saves WHERE has_model", ""),
    ]
)


def ml_fit_process(spark: SparkSession, folder: str) -> DataFrame:
    found = ml.fit_edges(standins.ml_events(spark, folder), standins.training_edges(spark, folder), SETTINGS)
    return found.select("app_id", "seq", "plan_description", "direction", "type_name", "qualified_name")


ML_FIT_PROCESS = (
    q.with_(
        q.ML_EVENTS,
        q.ML_SAVES,
        "fits AS (SELECT *, 'Spark ML training model with pipeline uid: ' || uid AS pd FROM model_saves WHERE has_model)",
    )
    + f"""SELECT app_id, seq, pd AS plan_description, 'input' AS direction, 'spark_ml_pipeline' AS type_name, uid AS qualified_name FROM fits
    UNION ALL SELECT app_id, seq, pd, 'output', 'spark_ml_model', replace(uid, 'pipeline', 'model') FROM fits
    UNION ALL SELECT app_id, seq, pd, 'output', {q.directory_type("model_uri")}, {q.directory_name("model_uri")} FROM fits
    UNION ALL SELECT app_id, seq, pd, 'output', {q.directory_type("pipeline_uri")}, {q.directory_name("pipeline_uri")} FROM fits
    UNION ALL SELECT app_id, seq, pd, 'input', 'spark_table', 'train.q' || quality || 't' || toxic
      FROM fits JOIN labels ON dataset_execution_id = doc_id"""
)


def ml_score_process(spark: SparkSession, folder: str) -> DataFrame:
    """All query processes, those that ran after a model was applied in machine-learning form."""
    edges = lineage.clean_cycles(standins.edges(spark, folder))
    order = F.col("l_orderkey")
    queries = table(spark, folder, "lineitem", "l_orderkey").distinct().select(
        standins.text("app-<n>", n=order % 20).alias("app_id"), order.alias("execution_id"), order.alias("seq")
    )
    found = ml.process_edges(edges, queries, standins.ml_events(spark, folder), SETTINGS)
    return found.select("app_id", "execution_id", "mode", "direction", "type_name", "qualified_name")


ML_SCORE_PROCESS = (
    q.with_(
        q.EDGES,
        q.CYCLIC,
        q.CLEAN,
        q.ML_EVENTS,
        q.ML_SAVES,
        """applied AS (
  SELECT k.app_id, k.execution_id, (SELECT max_by(m.uid, m.seq) FROM ml_events m WHERE m.event = 'Transform'
    AND m.app_id = k.app_id AND m.seq <= k.execution_id) AS uid
  FROM (SELECT DISTINCT app_id, execution_id FROM edges) k)""",
        """loaded AS (
  SELECT a.*, (SELECT max_by(m.directory, m.seq) FROM ml_events m WHERE m.event = 'LoadModel' AND m.app_id = a.app_id
    AND m.uid = a.uid AND m.seq <= a.execution_id) AS model_uri,
    EXISTS (SELECT 1 FROM model_saves s WHERE s.has_model AND s.app_id = a.app_id AND s.seq < a.execution_id) AS fitted
  FROM applied a)""",
        """moded AS (
  SELECT *, CASE WHEN uid IS NULL THEN 'etl' WHEN model_uri IS NULL THEN 'lost' WHEN fitted THEN 'fit' ELSE 'score' END AS mode
  FROM loaded)""",
        """ranked AS (
  SELECT c.*, m.mode, m.uid, m.model_uri, row_number() OVER (
    PARTITION BY c.execution_id, c.direction ORDER BY c.ordinal, c.qualified_name) AS rn
  FROM clean c JOIN moded m ON c.execution_id = m.execution_id AND c.app_id = m.app_id)""",
        """firsts AS (
  SELECT * FROM ranked WHERE rn = 1 AND mode IN ('fit', 'score') AND execution_id IN (
    SELECT execution_id FROM clean WHERE direction = 'output'))""",
    )
    + f"""SELECT app_id, execution_id, mode, direction, 'spark_table' AS type_name, qualified_name FROM ranked WHERE mode = 'etl'
    UNION ALL SELECT app_id, execution_id, mode, direction, 'spark_table', qualified_name FROM firsts
    UNION ALL SELECT app_id, execution_id, mode, 'input', 'spark_ml_model', replace(uid, 'pipeline', 'model')
      FROM firsts WHERE mode = 'score' AND direction = 'input'
    UNION ALL SELECT app_id, execution_id, mode, 'input', {q.directory_type("model_uri")}, {q.directory_name("model_uri")}
      FROM firsts WHERE mode = 'score' AND direction = 'input'"""
)


QUERIES = {
    "ml_entities": (ml_entities, ML_ENTITIES),
    "ml_fit_process": (ml_fit_process, ML_FIT_PROCESS),
    "ml_score_process": (ml_score_process, ML_SCORE_PROCESS),
}
