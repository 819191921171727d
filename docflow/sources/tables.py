"""Observation tables: pages, headers, attempts, bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflow import schemas


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in order; absent ones null, others dropped."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages with optional `status_code` and `error`; columns the files lack read as null."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_heads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HEADS).parquet(path)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ATTEMPTS).parquet(path)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BODIES).parquet(path)


def write_profiles(profiles: DataFrame, path: str) -> None:
    """Appends page profiles."""
    conform(profiles, schemas.PAGE_PROFILE).write.mode("append").parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGE_PROFILE).parquet(path)
