"""What a catalog is told about executed statements: the datasets they touch, then the process itself.

Both work from cleaned edges, which are short rows; plan text is joined only by ``process_entities``, on the key of its
statement. Datasets a statement reads or writes are created before the process that depends on them, in rank order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import names, paths
from weftline.operators import entities, lineage
from weftline.settings import JobSettings

STATEMENT = ["app_id", "execution_id"]


def _entity(type_name: str, qualified_name: Column) -> Column:
    return F.struct(F.lit(type_name).alias("type_name"), qualified_name.alias("qualified_name"))


def _needed() -> Column:
    """The dataset of an edge with what must exist before it; none for tables that are owned elsewhere."""
    kind, name = F.col("type_name"), F.col("qualified_name")
    folder = F.regexp_replace(name, "[^/]*$", "")
    bucket = F.regexp_extract(name, "^(s3://[^/]+)", 1)
    s3 = F.array(_entity(paths.S3_BUCKET, bucket), _entity(paths.S3_PSEUDO_DIR, folder), _entity(paths.S3_OBJECT, name))
    db = F.regexp_replace(name, r"\.[^.]+$", "")
    table = F.array(_entity(names.SPARK_DB, db), _entity(names.SPARK_STORAGE, F.concat(name, F.lit(".storageFormat"))), _entity(names.SPARK_TABLE, name))
    alone = F.array(F.struct("type_name", "qualified_name"))
    return F.when(kind == paths.S3_OBJECT, s3).when(kind == names.SPARK_TABLE, table).when(kind != names.HIVE_TABLE, alone)


def mutations(edges: DataFrame) -> DataFrame:
    """Create mutations of each statement: ``app_id, execution_id, op, type_name, qualified_name, create_rank``.

    ``edges`` are cleaned. A dataset that several edges of a statement name is created once. Tables of a
    remote metastore are references: their process names them, but they are not created."""
    # The outer form, because for the inner one Spark infers a filter on the array and would work it out again in it.
    datasets = edges.select(*STATEMENT, F.inline_outer(_needed())).where("type_name is not null")
    process = edges.select(*STATEMENT, F.lit(names.SPARK_PROCESS).alias("type_name"), F.col("app_id").alias("qualified_name"))
    every = datasets.unionByName(process).distinct()
    return every.select(*STATEMENT, F.lit("create").alias("op"), "type_name", "qualified_name", entities.create_rank(F.col("type_name")).alias("create_rank"))


def _in_parts(edges: DataFrame, settings: JobSettings) -> DataFrame:
    """The references of each command of a statement as arrays, dealt to parts by their names where they are many."""
    keys = [*STATEMENT, "command_pos"]
    sizes = edges.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / settings.refs_per_message).alias("parts"))
    part = F.pmod(F.xxhash64("type_name", "qualified_name"), F.col("parts")).alias("part")
    ref = F.struct("type_name", "qualified_name")
    side = lambda way: F.sort_array(F.collect_set(F.when(F.col("direction") == way, ref))).alias(f"{way}s")
    return edges.join(sizes, keys).groupBy(*keys, part).agg(side("input"), side("output"))


def process_entities(edges: DataFrame, executions: DataFrame, applications: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Process rows of statements with edges: all attributes, the references, and what must exist first.

    A process with very many edges comes in parts of about ``refs_per_message`` references, which the catalog adds up.
    References to tables of a remote metastore are no dependencies: they exist elsewhere."""
    sent = _in_parts(edges, settings)
    rows = lineage.processes(executions, applications, settings)
    created = lambda refs: F.filter(refs, lambda r: r["type_name"] != names.HIVE_TABLE)
    return rows.join(sent, STATEMENT[::-1]).select(
        *STATEMENT, F.lit(names.SPARK_PROCESS).alias("type_name"), "qualified_name", "name", "query_id", "batch_id", "curr_user", "remote_user",
        "details", "plan_description", "command_pos", "part", "inputs", "outputs",
        F.array_union(created(F.col("inputs")), created(F.col("outputs"))).alias("deps"),
        F.lit(entities.CREATE_RANK[names.SPARK_PROCESS]).alias("create_rank"),
    )
