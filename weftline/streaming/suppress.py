"""Streaming suppression: a micro-batch reports only if it touches something its query has not touched.

The rule in sets: an object is new in the first batch that has it; a batch with a new object reports
all its edges. Both forms below find the first batch per object with an aggregate, so a query with
very many batches or objects is spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OBJECT = ["query_id", "direction", "type_name", "qualified_name"]


def first_batches(edges: DataFrame) -> DataFrame:
    return edges.groupBy(*OBJECT).agg(F.min("batch_id").alias("batch_id"))


def reporting_batches(edges: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """``query_id, batch_id`` of batches that report. ``batches`` adds ones without edges: the first
    batch of a query always reports."""
    found = first_batches(edges).select("query_id", "batch_id")
    if batches is not None:
        first = batches.groupBy("query_id").agg(F.min("batch_id").alias("batch_id"))
        found = found.unionByName(first.select("query_id", "batch_id"))
    return found.distinct()


def suppress(edges: DataFrame) -> DataFrame:
    """Edges of the batches that report."""
    return edges.join(reporting_batches(edges), ["query_id", "batch_id"], "left_semi")


class SuppressionSink:
    """``foreachBatch`` writer of the streaming form.

    What each query has touched is a table under ``state``: every ``compact`` triggers all of it, and since
    then one folder for each trigger. A trigger reads the last whole table and the folders since, and overwrites
    its own, so a repeated trigger gives the same result, and losing an executor or the driver loses nothing.
    """

    def __init__(self, state: str, out: str, compact: int = 16):
        self.state = state.rstrip("/")
        self.out = out.rstrip("/")
        self.compact = compact

    def known(self, batch: DataFrame, trigger: int) -> DataFrame | None:
        """Objects of all triggers before this one."""
        whole = trigger // self.compact * self.compact - 1
        places = [f"{self.state}/upto={whole}"] if whole >= 0 else []
        places += [f"{self.state}/trigger={t}" for t in range(whole + 1, trigger)]
        if not places:
            return None
        return batch.sparkSession.read.schema(batch.select(*OBJECT).schema).parquet(*places)

    def __call__(self, batch: DataFrame, trigger: int) -> None:
        edges = batch.select(*OBJECT, "batch_id").distinct().persist()
        first = first_batches(edges)
        known = self.known(batch, trigger)
        fresh = first if known is None else first.join(known, OBJECT, "left_anti")
        # The trigger's new objects are written once and read back, so the edges below follow from
        # the very rows that become known.
        mine = f"{self.state}/trigger={trigger}"
        fresh.write.mode("overwrite").parquet(mine)
        new = batch.sparkSession.read.schema(fresh.schema).parquet(mine)
        if (trigger + 1) % self.compact == 0:
            every = new.select(*OBJECT) if known is None else new.select(*OBJECT).unionByName(known.select(*OBJECT))
            every.write.mode("overwrite").parquet(f"{self.state}/upto={trigger}")
        reporting = new.select("query_id", "batch_id").distinct()
        reported = edges.join(reporting, ["query_id", "batch_id"], "left_semi")
        reported.write.mode("overwrite").parquet(f"{self.out}/trigger={trigger}")
        edges.unpersist()


def start(edges: DataFrame, state: str, out: str, checkpoint: str, **trigger):
    """Run suppression on a stream of edges; ``trigger`` as for ``DataStreamWriter.trigger``."""
    writer = edges.writeStream.foreachBatch(SuppressionSink(state, out)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
