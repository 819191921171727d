"""The event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import schemas
from docflow.functions.content import epoch_timestamp
from docflow.sources.json_files import read_array


# Times keep their microseconds in JSON.
_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_events(events: DataFrame, path: str, format: str = "parquet") -> None:
    """Writes events, one folder per run; a run written again replaces itself only.

    JSON is written as one object per line.
    """
    (
        events.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**_OPTIONS)
        .partitionBy("run_id")
        .format(format)
        .save(path)
    )


def read_events(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Events of all runs; filter on `run_id` reads that run's folder only."""
    return (
        spark.read.schema(schemas.EVENTS)
        .format(format)
        .options(**_OPTIONS)
        .load(path)
        .select(*schemas.EVENTS.fieldNames())
    )


def read_event_array(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Events from a JSON array file of either older form; an entry that can't be read raises."""
    rows, verdict = read_array(spark, path, schemas.LOG_ENTRY)
    if verdict.first()["is_corrupt"]:
        raise ValueError(f"corrupt event log: {path}")
    return rows.select(
        F.lit(run_id).alias("run_id"),
        epoch_timestamp(F.col("timestamp")).alias("timestamp"),
        F.coalesce("event_type", "stage").alias("event_type"),
        *schemas.EVENTS.fieldNames()[3:],
    )
