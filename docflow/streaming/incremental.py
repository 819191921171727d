"""Incremental runs over a stream of observations; the manifest is the state."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docflow.functions import content
from docflow.operators import change, outcome
from docflow.operators.skew import latest_by
from docflow.reliable import saved
from docflow.schemas import FOLDED_ATTEMPTS
from docflow.sources import documents
from docflow.sources.events import write_events
from docflow.sources.manifests import ManifestStore


def distinct_observations(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drops repeats of (url, last_modified) that arrive within `delay` of each other."""
    return stream.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(
        ["url", "last_modified"]
    )


def process_batch(
    batch: DataFrame,
    store: ManifestStore,
    run_id: str,
    cap: int = content.SIZE_CAP,
    compact_every: int = 50,
    documents_path: str | None = None,
    events_path: str | None = None,
) -> None:
    """One run over a micro-batch. Repeating a committed run changes nothing.

    With `documents_path` or `events_path`, bodies and events are stored before the manifest
    entries, which commit the run.
    """
    if store.has_run(run_id):
        return
    # Several observations of a URL in one batch: the latest one counts. Content is
    # reduced to length, checksum and validity before anything is shuffled.
    inspected_at = outcome.inspect_bodies(
        batch.withColumn("url", F.struct("url", "observed_at"))
    ).select("url.*", "body_size", "checksum", "is_valid")
    seen = batch.select("url", "content_length", "last_modified", "error", "observed_at")
    latest = latest_by(seen, ["url"], ["observed_at"])
    inspected = latest_by(inspected_at, ["url"], ["observed_at"])
    manifest = store.read()
    # Every tracked file was stored by the run that tracked it.
    decided = change.change_decision(
        change.candidates(latest), manifest, manifest.select("filename"),
        change.head_observations(latest),
    )
    no_attempts = batch.sparkSession.createDataFrame([], FOLDED_ATTEMPTS)
    outcomes = saved(
        outcome.outcome_status(decided, no_attempts, inspected, cap).join(
            latest.select("url", "observed_at"), "url"
        ),
        "stream-outcomes",
    )
    if documents_path is not None:
        stored = documents.select_stored(batch, outcomes, ("url", "observed_at"))
        documents.write_documents(stored, documents_path, run_id)
    if events_path is not None:
        now = F.lit(datetime.now(timezone.utc))
        write_events(outcome.events_from_outcomes(outcomes, run_id, now), events_path)
    # File names with several URLs keep the last stored one, with its own time.
    rows = outcome.manifest_rows(outcomes, F.col("observed_at"), documents_path or store.path)
    store.append(rows, run_id)
    if len(store.commits()[0]) >= compact_every:
        store.compact(f"{run_id}-compact")


def incremental_stream(
    observations: DataFrame,
    store_path: str,
    checkpoint: str,
    run_prefix: str = "batch",
    cap: int = content.SIZE_CAP,
    trigger: dict | None = None,
    documents_path: str | None = None,
    events_path: str | None = None,
) -> StreamingQuery:
    """Runs every micro-batch against the manifest and appends what it stored.

    `foreachBatch` delivers at least once; the checkpoint's query id and the batch id name the
    run, and a run already in the manifest's commits is skipped, so each batch counts once. A
    stream with a new checkpoint has another query id, and its batches are runs of their own.
    """
    spark = observations.sparkSession
    store = ManifestStore(spark, store_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        query_id = spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        process_batch(
            batch, store, f"{run_prefix}-{query_id}-{batch_id}", cap, documents_path=documents_path,
            events_path=events_path,
        )

    return (
        observations.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
