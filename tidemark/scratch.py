"""Shared working folder: staged tables, landing zones, stream checkpoints.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a
local master may fall back to a folder of its own, since a machine-local folder
on a cluster is lost with the machine and unseen by the others.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created until Spark writes it."""
    return f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` and read it back (runs a job).

    Later plans start from files: work is not repeated, lost executors cost
    nothing but a reread, and the planner knows the exact size, so it broadcasts
    the table in a join when it is below ``autoBroadcastJoinThreshold`` and
    shuffles it when it is not.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
