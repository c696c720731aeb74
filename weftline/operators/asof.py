"""As-of lookup: the latest value of a key at or before a point in its sequence.

A window over a whole key would put a very busy key into one task. Here the sequence is cut into
spans: a window runs inside each (key, span), the closing row of each span carries its last value forward
over the spans of the key, and the two meet on (key, span). What the windows found is written to the shared
folder, so that rows which come from a lookup themselves are worked out once, however many lookups follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.settings import written


def carry_forward(
    rows: DataFrame, keys: list[str], order: str, value: str, out: str, width: int, strict: bool = False
) -> DataFrame:
    """Add ``out``: the last non-null ``value`` of the key up to this row (before it, if ``strict``).

    ``order`` is a whole number, unique per key; ``width`` is the span held by one group. Null keys
    never match.
    """
    # Whole-number arithmetic: sequence numbers of logs are too large for exact doubles.
    spanned = rows.withColumn("span_no", F.col(order) - F.pmod(F.col(order), F.lit(width)))
    groups = [*keys, "span_no"]
    span = Window.partitionBy(*groups).orderBy(order)
    upto = span.rowsBetween(Window.unboundedPreceding, 0)
    local = spanned.withColumn("span_last", F.last(value, ignorenulls=True).over(upto))
    local = local.withColumn("local_last", F.lag("span_last").over(span) if strict else F.col("span_last"))
    local = written(local.withColumn("closes", F.lead(order).over(span).isNull()), "asof")
    before = Window.partitionBy(*keys).orderBy("span_no").rowsBetween(Window.unboundedPreceding, -1)
    closing = local.where("closes").select(*groups, F.last("span_last", ignorenulls=True).over(before).alias("carried"))
    return (
        local.join(closing.where("carried is not null"), groups, "left")
        .withColumn(out, F.coalesce("local_last", "carried"))
        .drop("span_no", "span_last", "local_last", "closes", "carried")
    )


def lookup(
    probes: DataFrame,
    values: DataFrame,
    keys: list[str],
    order: str,
    since: str,
    payload: list[str],
    width: int,
    out: str = "found",
) -> DataFrame:
    """Add to each probe the struct ``out`` of ``payload`` valid at ``order``; null when there is none.

    ``values`` has one row per (keys, since). At equal sequence numbers the value comes first.
    """
    # Doubling the sequence makes room for "value before probe" at the same number.
    columns = probes.columns
    as_probe = probes.select(
        *keys,
        (F.col(order) * 2 + 1).alias("asof_at"),
        F.lit(None).cast(values.select(F.struct(*payload).alias("p")).schema["p"].dataType).alias("asof_value"),
        F.struct(*columns).alias("asof_row"),
    )
    as_value = values.select(
        *keys,
        (F.col(since) * 2).alias("asof_at"),
        F.struct(*payload).alias("asof_value"),
        F.lit(None).cast(as_probe.schema["asof_row"].dataType).alias("asof_row"),
    )
    merged = as_probe.unionByName(as_value)
    carried = carry_forward(merged, keys, "asof_at", "asof_value", out, 2 * width)
    return carried.where("asof_row is not null").select("asof_row.*", out)
