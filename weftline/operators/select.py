"""Reading entity tables: by type, exactly one, by attribute, and along links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def of_type(entities: DataFrame, type_name: str) -> DataFrame:
    return entities.where(F.col("type_name") == type_name)


def with_attribute(entities: DataFrame, type_name: str, key: str, value: str) -> DataFrame:
    return of_type(entities, type_name).where(F.col("attrs")[key] == value)


def exactly_one(entities: DataFrame, what: str) -> DataFrame:
    """The only row of ``entities``; the job fails when there are none or several."""
    columns = entities.columns
    counted = entities.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*columns)).alias("row"))
    message = F.concat(F.lit(f"expected one {what}, found "), F.col("n").cast("string"))
    checked = F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(message).cast(counted.schema["row"].dataType))
    return counted.select(checked.alias("row")).select("row.*")


def attribute(key: str, kind: str = "string") -> Column:
    """Attribute read as a type, null when not set or not readable."""
    return F.col("attrs")[key].try_cast(kind)


def linked(entities: DataFrame, relationships: DataFrame, rel: str) -> DataFrame:
    """Entities with the object a link of theirs points to."""
    links = relationships.where(F.col("rel") == rel).select(
        F.col("from_type").alias("type_name"), F.col("from_qn").alias("qualified_name"), "to_type", "to_qn"
    )
    return entities.join(links, ["type_name", "qualified_name"])
