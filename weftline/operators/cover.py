"""Directories in place of long lists of paths.

A set of paths is cut to its first directories, at the greatest depth at which no more than ``most`` names remain. All depths are counted in
one aggregate over the paths' prefixes, so a set of any size is spread over many tasks; per set, a row a depth is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ROOT = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/]*)?"


def directory_cover(paths: DataFrame, keys: list[str], path: str = "path", most: int = 100) -> DataFrame:
    """``keys, node, n_paths``: nodes that cover the distinct paths of each set, and how many each covers.

    Each path is under exactly one node. A node that covers one path is that path; paths shorter than the depth stay as they are. Roots
    (scheme and host) are never put together, so more roots than ``most`` give a node each. Repeated slashes and a last one do not count;
    rows without a path are left out."""
    root = F.regexp_extract(path, _ROOT, 0)
    names = F.filter(F.split(F.substring(path, F.length(root) + 1, F.length(path)), "/"), lambda x: x != "")
    each = paths.where(F.col(path).isNotNull()).select(*keys, root.alias("root"), names.alias("names")).distinct()
    prefix = lambda d: F.concat_ws("/", F.concat(F.array("root"), F.slice("names", F.lit(1), d)))
    deep = F.size("names")

    # Names at a depth: the prefixes of that length, and all paths that are shorter.
    levels = each.select(*keys, F.explode(F.transform(F.sequence(F.lit(0), deep), lambda d: F.struct(d.alias("depth"), prefix(d).alias("prefix"), (d == deep).cast("long").alias("whole")))).alias("p"))
    levels = levels.groupBy(*keys, "p.depth", "p.prefix").agg(F.sum("p.whole").alias("whole")).groupBy(*keys, "depth").agg(F.count("*").alias("n"), F.sum("whole").alias("whole"))
    shorter = F.coalesce(F.sum("whole").over(Window.partitionBy(*keys).orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = levels.withColumn("n", F.col("n") + shorter).groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("n") <= most, F.col("depth"))), F.lit(0)).alias("depth"))

    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    cut = each.alias("e").join(chosen.alias("c"), same).select(*[f"e.{k}" for k in keys], prefix(F.least("depth", deep)).alias("node"), prefix(deep).alias("whole"), F.transform(F.sequence(F.lit(0), F.least("depth", deep)), prefix).alias("above"))
    nodes = cut.groupBy(*keys, "node").agg(F.count("*").alias("n_paths"), F.min("whole").alias("only"), F.first("above").alias("above"))
    # A path that is another one's directory covers that one too.
    named = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    up = nodes.select(*keys, "node", F.explode("above").alias("up")).alias("a").join(nodes.select(*keys, F.col("node").alias("up")).alias("b"), [*named, F.col("a.up") == F.col("b.up")])
    up = up.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.node").alias("node")).agg(F.min_by("b.up", F.length("b.up")).alias("top"))
    met = [F.col(f"n.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys]
    whole = nodes.alias("n").join(up.alias("u"), [*met, F.col("n.node") == F.col("u.node")])
    out = whole.groupBy(*[F.col(f"n.{k}").alias(k) for k in keys], F.col("u.top").alias("node")).agg(F.sum("n_paths").alias("n_paths"), F.min("only").alias("only"))
    return out.select(*keys, F.when(F.col("n_paths") == 1, F.col("only")).otherwise(F.col("node")).alias("node"), "n_paths")
