"""Mutation rows ``op, type_name, qualified_name, attrs, seq, create_rank`` and where they go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = """struct<op:string,type_name:string,qualified_name:string,attrs:map<string,string>,create_rank:int>"""


def create(e: Column) -> Column:
    """Create mutation of an entity struct."""
    return F.struct(
        F.lit("create").alias("op"),
        e["type_name"].alias("type_name"),
        e["qualified_name"].alias("qualified_name"),
        F.map_concat(
            F.map_filter(F.create_map(F.lit("name"), e["name"]), lambda _, v: v.isNotNull()), e["attrs"]
        ).alias("attrs"),
        e["create_rank"].alias("create_rank"),
    )


def update(type_name: str, qualified_name: Column, attrs: Column, rank: int) -> Column:
    return F.struct(
        F.lit("update").alias("op"),
        F.lit(type_name).alias("type_name"),
        qualified_name.alias("qualified_name"),
        attrs.alias("attrs"),
        F.lit(rank).alias("create_rank"),
    )


def delete(type_name: Column, qualified_name: Column, rank: int) -> Column:
    return F.struct(
        F.lit("delete").alias("op"),
        type_name.alias("type_name"),
        qualified_name.alias("qualified_name"),
        F.create_map().cast("map<string,string>").alias("attrs"),
        F.lit(rank).alias("create_rank"),
    )


def creations(graph: DataFrame, *keep: str) -> DataFrame:
    """Create mutations of entity rows; references are owned elsewhere and never created."""
    e = F.struct("type_name", "qualified_name", "name", "attrs", "create_rank")
    return graph.where("not is_reference").select(*keep, create(e).alias("m")).select(*keep, "m.*")


def ordered(mutations: DataFrame) -> DataFrame:
    """Dependencies before dependants within each event. A range sort, so no task holds everything."""
    return mutations.orderBy("seq", "create_rank", "type_name", "qualified_name")


def counts(mutations: DataFrame) -> DataFrame:
    return mutations.groupBy("op", "type_name").agg(F.count(F.lit(1)).alias("n"))


def messages(mutations: DataFrame) -> DataFrame:
    """``key, value`` rows for a message bus, the value as JSON. The key keeps one entity's changes in order."""
    body = F.to_json(F.struct("op", "type_name", "qualified_name", "attrs", "seq", "create_rank"))
    key = F.concat("type_name", F.lit("|"), "qualified_name")
    return mutations.select(key.alias("key"), body.alias("value"))


def to_parquet(path: str) -> Callable[[DataFrame], None]:
    """Sink that writes the mutation table, split by operation."""
    return lambda mutations: mutations.write.mode("overwrite").partitionBy("op").parquet(path)


def to_kafka(servers: str, topic: str) -> Callable[[DataFrame], None]:
    """Sink that sends the JSON messages; needs the Kafka data source on the class path."""

    def send(mutations: DataFrame) -> None:
        writer = messages(mutations).write.format("kafka")
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return send


def emit(mutations: DataFrame, sink: Callable[[DataFrame], None]) -> None:
    """Hand mutations to a sink: any callable that takes the DataFrame."""
    sink(mutations)
