"""The order in which entities can be created, from what they really depend on.

An entity's level is 0 if it needs nothing that is to be created, else one more than the highest level of what it needs. Levels
come round by round: what was placed in the last round is taken off the remaining dependencies, and what has none left is
placed next. There are as many rounds as levels, however many entities, and a round joins only dependencies that are left. Entities on a cycle,
and those that need one, are never placed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.settings import written

NAME = ["type_name", "qualified_name"]
DEP = ["dep_type_name", "dep_qualified_name"]


def create_levels(entities: DataFrame, dependencies: DataFrame) -> DataFrame:
    """``type_name, qualified_name, level`` of each entity; ``level`` is null on or behind a cycle.

    ``dependencies`` are rows of ``entities.dependencies``. One on something that is not in ``entities`` exists elsewhere and holds
    nothing up. Rows may repeat. An entity that needs itself is a cycle."""
    every = written(entities.select(*NAME).distinct(), "entities")
    there = every.toDF(*DEP)
    left = dependencies.select(*NAME, *DEP).distinct().join(every, NAME, "left_semi").join(there, DEP, "left_semi")
    left = written(left.select(*NAME, *DEP), "left")
    placed = last = written(every.join(left, NAME, "left_anti"), "level").withColumn("level", F.lit(0))
    level = 0
    while last.limit(1).count():
        level += 1
        gone = last.select(*NAME).toDF(*DEP)
        # Freed: what loses a dependency in this round and has no other.
        freed = left.join(gone, DEP, "left_semi").select(*NAME).distinct()
        left = written(left.join(gone, DEP, "left_anti").select(*NAME, *DEP), "left")
        last = written(freed.join(left, NAME, "left_anti"), "level").withColumn("level", F.lit(level))
        placed = placed.unionByName(last)
    return every.join(placed, NAME, "left").select(*NAME, "level")


def unplaced(levels: DataFrame) -> DataFrame:
    """Entities on a cycle or behind one, for the bad-record table."""
    return levels.where("level is null").select(*NAME, F.lit("dependency cycle").alias("reason"))
