"""Stored document bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.content import content_checksum
from docflow.functions.urls import document_filename
from docflow.operators.skew import latest_by
from docflow.schemas import DOCUMENTS


def stored_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name and length of the files in a folder; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.substring_index("path", "/", -1).alias("filename"), "length")
    )


def read_folder(spark: SparkSession, folder: str, max_length: int) -> DataFrame:
    """Files with content, not larger than `max_length`; larger ones are never opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .filter(F.col("length") <= max_length)
        .select(F.substring_index("path", "/", -1).alias("filename"), "length", "content")
    )


def select_stored(
    bodies: DataFrame, outcomes: DataFrame, keys: tuple[str, ...] = ("url",)
) -> DataFrame:
    """Bodies of URLs with success, with file name and checksum; a body without a URL has none.

    Where a URL has several bodies, the key `checksum` picks the one that the outcome is of.
    """
    keys = list(keys)
    if "checksum" in keys:
        bodies = bodies.withColumn("checksum", content_checksum(F.col("content")))
    stored = outcomes.filter(F.col("status") == "success").select(*keys)
    return bodies.join(stored, keys, "left_semi").select(
        document_filename(F.col("url")).alias("filename"),
        "url",
        content_checksum(F.col("content")).alias("checksum"),
        "content",
    )


def write_documents(documents: DataFrame, path: str, run_id: str) -> None:
    """Stores bodies as one folder per run; writing a run again replaces it."""
    documents.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def latest_documents(spark: SparkSession, path: str, runs: DataFrame | None = None) -> DataFrame:
    """Where the current body of each file name is: (filename, url, checksum, run_id).

    `runs` (run_id, seq: `ManifestStore.runs`) gives the order of runs and hides those that were
    never committed; without it runs follow each other by the text of their ids. Of several URLs
    with one file name in a run the last one counts. Content is not read.
    """
    rows = spark.read.schema(DOCUMENTS).parquet(path).select("filename", "url", "checksum", "run_id")
    if runs is None:
        return latest_by(rows, ["filename"], ["run_id", "url"])
    return latest_by(rows.join(runs, "run_id"), ["filename"], ["seq", "url"]).drop("seq")


def document_contents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Content for rows of `latest_documents`, read where it lies (`rows_at`)."""
    keys = ["filename", "url", "run_id"]
    where = located(spark.read.schema(DOCUMENTS).parquet(path).select(*keys)).alias("w")
    asked = wanted.select(*keys).distinct().alias("a")
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]  # a body without URL is found too
    chosen = where.join(asked, same[0] & same[1] & same[2], "left_semi").select(FILE, ROW)
    return rows_at(spark, path, DOCUMENTS, chosen).select(*keys, "checksum", "content")


# Where a row of a Parquet table lies: its file and its place there, from the reader's `_metadata`.
FILE, ROW = "_file", "_row"
BLOCK_ROWS = 4_000_000  # chosen places that one broadcast holds (an int and a long each)


def located(rows: DataFrame) -> DataFrame:
    """`rows` (straight from a Parquet reader) with their file and row number in it. No column is read
    for this beyond those selected."""
    return rows.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def rows_at(spark: SparkSession, path: str, schema, chosen: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of the Parquet table at `path` at the places (`FILE`, `ROW`) of `chosen`, read in place.

    Places are counted per file (one row per file reaches the driver, as in Spark's own listing). Files are
    put into blocks of at most `block_rows` chosen places; each block reads only its own files and keeps
    its rows by a join with its places, broadcast as (file number, row). No exchange carries the rows'
    other columns, so bodies never move before they are used. A file with more chosen places than a
    block holds is read by several blocks, each keeping a share of its places by a hash of the row.
    A place that is chosen twice gives its row once.
    """
    chosen = chosen.select(FILE, ROW).distinct()
    files = chosen.groupBy(FILE).count().orderBy(FILE).collect()
    numbers = spark.createDataFrame([(f[FILE], i) for i, f in enumerate(files)], f"{FILE} string, _n int")
    places = chosen.join(F.broadcast(numbers), FILE).select("_n", ROW)
    blocks: list[tuple[list[int], int, int]] = []  # (file numbers, slices, slice)
    group: list[int] = []
    held = 0
    for i, f in enumerate(files):
        if f["count"] > block_rows:
            slices = -(-f["count"] // block_rows)
            blocks += [([i], slices, j) for j in range(slices)]
            continue
        if held + f["count"] > block_rows and group:
            blocks.append((group, 1, 0))
            group, held = [], 0
        group.append(i)
        held += f["count"]
    if group:
        blocks.append((group, 1, 0))
    out = None
    for numbers_of, slices, share in blocks:
        kept = places.filter(F.col("_n").isin(numbers_of))
        if slices > 1:
            kept = kept.filter(F.pmod(F.xxhash64(ROW), F.lit(slices)) == share)
        read = spark.read.schema(schema).option("basePath", path).parquet(*[files[i][FILE] for i in numbers_of])
        here = located(read).join(F.broadcast(numbers), FILE).join(F.broadcast(kept), ["_n", ROW], "left_semi")
        part = here.drop(FILE, ROW, "_n")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    return out


def select_stored_at(spark: SparkSession, bodies_path: str, outcomes: DataFrame, schema) -> DataFrame:
    """`select_stored` for bodies in a Parquet table: keys and checksums are read and matched first,
    then the chosen bodies' content where it lies (`rows_at`). A body without a URL is never stored."""
    rows = spark.read.schema(schema).parquet(bodies_path)
    keyed = located(rows.select("url", content_checksum(F.col("content")).alias("checksum")))
    stored = outcomes.filter(F.col("status") == "success").select("url", "checksum")
    chosen = keyed.join(stored, ["url", "checksum"], "left_semi")
    bodies = rows_at(spark, bodies_path, schema, chosen)
    return bodies.select(
        document_filename(F.col("url")).alias("filename"),
        "url",
        content_checksum(F.col("content")).alias("checksum"),
        "content",
    )
