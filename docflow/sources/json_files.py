"""Pretty-printed JSON files, read in parallel.

Older manifests and logs are single JSON documents, a map or an array of flat objects,
indented by two blanks. Read line-wise with the entry's closing brace as separator such a
file can be split over many tasks, where a whole-file JSON reader would need one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType

_ENTRY_END = "\n  }"


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", _ENTRY_END)
        .text(path)
        .select(F.trim("value", F.lit(" \t\r\n")).alias("chunk"))
        .filter("chunk != ''")
    )


def _parsed(spark: SparkSession, path: str, schema, opener: str, closer: str) -> DataFrame:
    """Columns `entry` (null if malformed) and `is_end` per chunk.

    A chunk is one entry without its closing brace, preceded by a comma or the opening
    bracket; the last chunk is the closing bracket. A compact file is one chunk and whole.
    """
    chunk = F.col("chunk")
    body = F.regexp_replace(chunk, r"^(?:,|" + "\\" + opener + r")\s*", "")
    entry = F.concat(F.lit(opener), body, F.lit("}" + closer))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    whole = chunk.startswith(opener) & chunk.endswith(closer)
    return _chunks(spark, path).select(
        (chunk == closer).alias("is_end"),
        whole.alias("is_whole"),
        F.when(
            chunk != closer, F.from_json(F.when(whole, chunk).otherwise(entry), schema, options)
        ).alias("entry"),
    )


def read_map(spark: SparkSession, path: str, value: StructType) -> tuple[DataFrame, DataFrame]:
    """(key, value) rows of a JSON map of objects, and a one-row table `is_corrupt`."""
    parsed = _parsed(spark, path, MapType(StringType(), value), "{", "}")
    rows = parsed.filter(F.col("entry").isNotNull()).select(F.explode("entry"))
    return rows, _verdict(parsed, F.col("entry").isNull() | (F.size("entry") == 0))


def read_array(spark: SparkSession, path: str, element: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of a JSON array of objects, and a one-row table `is_corrupt`."""
    parsed = _parsed(spark, path, f"array<{element.simpleString()}>", "[", "]")
    rows = parsed.filter(F.col("entry").isNotNull()).select(F.inline("entry"))
    return rows, _verdict(parsed, F.col("entry").isNull() | (F.size("entry") == 0))


def _verdict(parsed: DataFrame, empty) -> DataFrame:
    """Corrupt: an entry that does not parse, or no closing bracket at all."""
    bad = ~F.col("is_end") & ~F.col("is_whole") & empty
    bad_whole = F.col("is_whole") & F.col("entry").isNull()
    ends = F.count_if(F.col("is_end") | F.col("is_whole"))
    return parsed.agg(
        ((F.count_if(bad | bad_whole) > 0) | ((ends == 0) & (F.count(F.lit(1)) > 0))).alias(
            "is_corrupt"
        )
    )
