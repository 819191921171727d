"""The manifest: read from JSON, or kept as a log of Parquet runs."""

from __future__ import annotations

import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docflow import schemas
from docflow.operators.skew import latest_by
from docflow.sources.json_files import read_map

log = logging.getLogger(__name__)

_COMMITS = "run_id STRING, kind STRING, seq BIGINT"
CLAIM_ATTEMPTS = 20  # numbers a writer tries before it gives up
_LOGGED = StructType([*schemas.MANIFEST.fields, StructField("seq", LongType())])


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.MANIFEST)


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Manifest from its JSON map form; a missing or corrupt file gives an empty one."""
    try:
        entries, verdict = read_map(spark, path, schemas.MANIFEST_ENTRY)
        corrupt = verdict.first()["is_corrupt"]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        log.info("no manifest at %s, starting fresh", path)
        return empty_manifest(spark)
    if corrupt:
        log.warning("manifest at %s is corrupt, starting fresh", path)
        return empty_manifest(spark)
    return entries.select(
        F.col("key").alias("filename"),
        "value.url",
        "value.size",
        "value.checksum",
        "value.last_modified",
        _utc(F.col("value.downloaded_at")).alias("downloaded_at"),
        "value.local_path",
    )


def _utc(text: Column) -> Column:
    """Time of a text that means UTC unless it names a zone, whatever the session's zone is."""
    named = F.when(text.rlike(r"(Z|[+-]\d\d:\d\d)$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.coalesce(named.try_cast("timestamp"), text.try_cast("timestamp"))


class ManifestStore:
    """Manifest kept under one folder as a log of runs.

    Each run appends only the entries it changed. A run counts once its commit file is in `commits`,
    created (only if absent) after the data, so readers never see half a run, two writers never
    share a number, and a repeated run with the same id is recognised. Reading takes the latest entry per file name; `compact` rewrites
    the log as one snapshot so that it stays short.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def commits(self, run_id: str | None = None) -> tuple[list[Row], bool]:
        """Runs since the last snapshot, oldest first, and whether `run_id` is committed.

        One pass over one row per run; what is collected shrinks with every snapshot.
        """
        try:
            rows = self.spark.read.schema(_COMMITS).json(f"{self.path}/commits")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return [], False
        since = rows.filter("kind = 'snapshot'").agg(F.coalesce(F.max("seq"), F.lit(-1))).scalar()
        kept = rows.filter((F.col("seq") >= since) | (F.col("run_id") == F.lit(run_id)))
        found = kept.withColumn("current", F.col("seq") >= since).collect()
        current = sorted((r for r in found if r.current), key=lambda r: r.seq)
        return current, any(r.run_id == run_id for r in found)

    def runs(self) -> DataFrame:
        """(run_id, seq) of all committed runs; a row for each run."""
        try:
            rows = self.spark.read.schema(_COMMITS).json(f"{self.path}/commits")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], "run_id string, seq bigint")
        return rows.filter("kind = 'delta'").select("run_id", "seq")

    def has_run(self, run_id: str) -> bool:
        return self.commits(run_id)[1]

    def read(self) -> DataFrame:
        """The current manifest."""
        commits, _ = self.commits()
        if not commits:
            return empty_manifest(self.spark)
        folders = [f"{self.path}/runs/{c.seq}-{c.run_id}" for c in commits]
        rows = self.spark.read.schema(_LOGGED).parquet(*folders)
        if len(folders) == 1:
            return rows.drop("seq")
        return latest_by(rows, ["filename"], ["seq"]).drop("seq")

    def append(self, entries: DataFrame, run_id: str) -> None:
        """Adds a run's entries, unique by file name; a run already committed is left alone."""
        commits, known = self.commits(run_id)
        if not known:
            self._write(entries, run_id, "delta", commits)

    def compact(self, run_id: str) -> None:
        """Writes the current manifest as a snapshot from which reading starts anew."""
        commits, known = self.commits(run_id)
        if not known:
            self._write(self.read(), run_id, "snapshot", commits)

    def _write(self, entries: DataFrame, run_id: str, kind: str, commits: list[Row]) -> None:
        """Writes the run's rows, then claims the next number by creating its commit file if absent.

        Two writers that chose the same number both write their rows, each to a folder of its own run
        id; only one of them creates the commit file. The other removes its folder, reads the commits
        again and tries the next number (its rows are computed again, so a snapshot includes what the
        winner wrote). A run id that another writer committed meanwhile is left alone.
        """
        seq = commits[-1].seq + 1 if commits else 0
        for _ in range(CLAIM_ATTEMPTS):
            folder = f"{self.path}/runs/{seq}-{run_id}"
            entries.withColumn("seq", F.lit(seq).cast("bigint")).write.mode("overwrite").parquet(folder)
            if self._claim(seq, run_id, kind):
                return
            self._delete(folder)
            commits, known = self.commits(run_id)
            if known:
                return
            seq = commits[-1].seq + 1 if commits else seq + 1
        raise RuntimeError(f"run {run_id}: no commit number free after {CLAIM_ATTEMPTS} attempts")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path

    def _claim(self, seq: int, run_id: str, kind: str) -> bool:
        """Creates the commit file of `seq` if there is none; whether this writer created it."""
        fs, path = self._fs(f"{self.path}/commits/commit-{seq:020d}.json")
        line = json.dumps({"run_id": run_id, "kind": kind, "seq": seq}) + "\n"
        try:
            out = fs.create(path, False)
        except Exception as e:  # py4j hands over the JVM's FileAlreadyExistsException
            if "FileAlreadyExists" in str(e) or fs.exists(path):
                return False
            raise
        try:
            out.write(bytearray(line.encode()))
        finally:
            out.close()
        return True

    def _delete(self, folder: str) -> None:
        fs, path = self._fs(folder)
        fs.delete(path, True)
