"""Cutting lineage in a folder that every executor can reach.

Nothing here keeps the only copy of a result on an executor: a lost executor costs a
re-read of the shared folder, never a failed job.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (`spark.checkpoint.dir`).

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with the machine, so the setting is required there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="docflow-checkpoint-")
    if configured is not None and configured.rstrip("/") not in (current or ""):
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """Name of an unused folder below the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; for small or iterated tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Written once as Parquet and read back; for wide tables that several consumers prune."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
