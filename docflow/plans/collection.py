"""Complete runs composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import content
from docflow.operators import change, crawl, outcome, reports
from docflow.reliable import saved
from docflow.sources import documents as stored_bodies
from docflow.sources.events import write_events
from docflow.sources.manifests import ManifestStore


@dataclass
class Run:
    """Tables a run yields."""

    visited: DataFrame
    documents: DataFrame
    outcomes: DataFrame
    results: DataFrame
    events: DataFrame
    manifest: DataFrame
    new_entries: DataFrame
    summary: DataFrame
    run_id: str


def run_discovery(
    pages: DataFrame, root: str, run_id: str = "discovery", at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents sorted by URL, and the crawl's events; nothing is fetched."""
    found = crawl.discover(pages, root)
    documents = saved(found.documents, "documents")
    events = outcome.events_from_crawl(
        crawl.crawl_outcomes(found.visited, pages), documents, run_id,
        F.lit(datetime.now(timezone.utc)) if at is None else at,
    )
    return documents.orderBy("url"), events


def run_collection(
    pages: DataFrame,
    root: str,
    heads: DataFrame,
    attempts: DataFrame,
    bodies: DataFrame,
    manifest: DataFrame,
    stored: DataFrame,
    run_id: str,
    at: Column | None = None,
    mode: str = "incremental",
    cap: int = content.SIZE_CAP,
    only: DataFrame | None = None,
    validator: Column | None = None,
    output: str = "documents",
    duration_seconds: Column | None = None,
) -> Run:
    """Discovery, change decision, outcomes, manifest, events and summary of one run.

    `heads` are raw observations, `attempts` rows per attempt, `bodies` what was fetched.
    Mode "full" fetches everything and uses the older event names. Outcomes are written once
    and feed all further tables, and so is what was found in bodies: content is read once. The
    time `at` is that of the call, alike in all tables.
    """
    at = F.lit(datetime.now(timezone.utc)) if at is None else at
    found = crawl.discover(pages, root)
    documents = saved(found.documents, "documents")
    chosen, observed = change.candidates(documents, only), change.head_observations(heads)
    if mode == "full":
        decided = change.full_decision(chosen, observed)
    else:
        decided = change.change_decision(chosen, manifest, stored, observed)
    inspected = saved(outcome.inspect_bodies(bodies, validator), "inspected")
    outcomes = saved(
        outcome.outcome_status(
            decided,
            outcome.fold_attempts(attempts),
            inspected,
            cap,
            mode,
        ),
        "outcomes",
    )
    results = outcome.file_results(outcomes)
    new_entries = outcome.manifest_rows(outcomes, at, output)
    updated = outcome.upsert_manifest(manifest, new_entries)
    events = (
        outcome.events_from_crawl(
            crawl.crawl_outcomes(found.visited, pages), documents, run_id, at, mode
        )
        .unionByName(outcome.events_from_attempts(outcomes, attempts, run_id, at, mode))
        .unionByName(outcome.events_from_outcomes(outcomes, run_id, at, mode))
    )
    summary = reports.run_summary(
        found.visited,
        documents,
        results,
        updated,
        F.lit(0.0) if duration_seconds is None else duration_seconds,
        output,
        mode,
    )
    return Run(
        found.visited, documents, outcomes, results, events, updated, new_entries, summary, run_id
    )


def store_run(
    run: Run, bodies: DataFrame, store: ManifestStore, documents_path: str, events_path: str,
    compact_every: int = 50,
) -> None:
    """Writes what a run left: bodies, events, and last the manifest entries, which commit it.

    A run that failed on the way is made again from `store.read()` and replaces its bodies and
    events. One that is committed is left alone, for made again it would find nothing new. Once
    `compact_every` runs follow the last snapshot, the manifest is written as a new one.
    """
    if store.has_run(run.run_id):
        return
    stored_bodies.write_documents(
        stored_bodies.select_stored(bodies, run.outcomes, ("url", "checksum")), documents_path, run.run_id
    )
    write_events(run.events, events_path)
    store.append(run.new_entries, run.run_id)
    if len(store.commits()[0]) >= compact_every:
        store.compact(f"{run.run_id}-compact")
