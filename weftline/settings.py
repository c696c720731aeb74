"""Job parameters shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JobSettings:
    """Values a job needs that the event tables do not carry.

    ``asof_width`` is the span of sequence numbers held by one task in an as-of join; it bounds
    the rows of a (key, span) group, so one very busy application is spread over many tasks.
    ``refs_per_message`` bounds how many dataset references one process message carries.
    """

    cluster: str = "primary"
    default_fs: str = "file:///"
    working_dir: str = "/"
    current_db: str = "default"
    case_sensitive: bool = False
    user: str = "spark"
    strict_view: bool = False
    asof_width: int = 65536
    refs_per_message: int = 1000


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Where it is not set, a session in local mode gets a temporary folder of its own. On a cluster that folder would
    be another one on each machine, so there the setting is required."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="weftline-")
    return _OWN[context.applicationId]


_OWN: dict[str, str] = {}


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a table written to the shared folder: read more than once, worked out once, and
    still there when executors are lost."""
    place = f"{shared_dir(frame.sparkSession)}/{name}-{uuid.uuid4()}"
    frame.write.parquet(place)
    return frame.sparkSession.read.schema(frame.schema).parquet(place)
