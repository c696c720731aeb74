"""A value that an expression uses several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it.

    A column is a formula: named five times, it is worked out five times where Spark finds no common part, as inside
    lambdas and branches. The code of a step with it is cut into small methods; one method for a whole step can
    become too large for the JVM to compile, and then runs many times slower."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
