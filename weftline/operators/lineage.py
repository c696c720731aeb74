"""Assembly of process edges: cycle cleaning, accumulation per application, process rows and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import names
from weftline.functions import plan_text as pt
from weftline.settings import JobSettings

EDGE_KEY = ["app_id", "execution_id", "command_pos"]


def clean_cycles(edges: DataFrame, keys: list[str] = EDGE_KEY) -> DataFrame:
    """Drop all outputs of a query that reads one of its outputs; its inputs stay.

    Only names are compared, not types. Finding the cyclic queries groups by query and name, so one
    query with very many edges is still spread out.
    """
    sides = edges.groupBy(*keys, "qualified_name").agg(
        F.max(F.col("direction") == "input").alias("read"), F.max(F.col("direction") == "output").alias("written")
    )
    cyclic = sides.where("read and written").select(*keys).distinct().alias("cyclic")
    here = edges.alias("here")
    same = F.col("here.direction") == "output"
    # The application last: it tells least apart, and sorts look at the first key first.
    for key in sorted(keys, key="app_id".__eq__):
        same = same & (F.col(f"here.{key}") == F.col(f"cyclic.{key}"))
    return here.join(cyclic, same, "left_anti")


def cyclic_queries(edges: DataFrame, keys: list[str] = EDGE_KEY) -> DataFrame:
    """Queries whose outputs ``clean_cycles`` drops."""
    inputs = edges.where("direction = 'input'").select(*keys, "qualified_name").distinct()
    outputs = edges.where("direction = 'output'").select(*keys, "qualified_name").distinct()
    return outputs.join(inputs, [*keys, "qualified_name"], "left_semi").select(*keys).distinct()


def application_edges(edges: DataFrame) -> DataFrame:
    """Edges of the one process an application is: the union over all its queries."""
    return edges.select("app_id", "direction", "type_name", "qualified_name").distinct()


def query_edges(edges: DataFrame) -> DataFrame:
    """Edges per query, for readers who want one process per query."""
    return edges.select("app_id", "execution_id", "direction", "type_name", "qualified_name").distinct()


def processes(executions: DataFrame, applications: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """One process row per execution, all of an application under the application's name."""
    user = F.coalesce("user", F.lit(settings.user))
    return executions.join(applications.select("app_id", "app_name", "user"), "app_id").select(
        "app_id",
        "execution_id",
        "query_id",
        "batch_id",
        F.col("app_id").alias("qualified_name"),
        names.process_name(F.col("app_name"), F.col("app_id")).alias("name"),
        user.alias("curr_user"),
        user.alias("remote_user"),
        F.col("plan").alias("details"),
        pt.header(F.col("plan")).alias("plan_description"),
    )


def process_messages(edges: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Process updates with their references as arrays.

    The receiving catalog adds references to what it has, so a query with many edges is sent as
    several messages of at most ``refs_per_message`` references per leaf and direction.
    """
    part = F.floor(F.col("ordinal") / F.lit(settings.refs_per_message)).alias("part")
    ref = F.struct("type_name", "qualified_name")
    return edges.groupBy("app_id", "execution_id", "command_pos", part).agg(
        F.sort_array(F.collect_set(F.when(F.col("direction") == "input", ref))).alias("inputs"),
        F.sort_array(F.collect_set(F.when(F.col("direction") == "output", ref))).alias("outputs"),
    )
