"""Attempts, bodies, status per document, and the rows a run leaves behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import content
from docflow.operators import skew
from docflow.schemas import EVENTS


def first_attempts(
    attempts: DataFrame,
    keys: list[str],
    order: list[str],
    max_attempts: int = content.MAX_ATTEMPTS,
) -> DataFrame:
    """The attempts that take place, numbered: at most `max_attempts`, none after a success.

    The rank filter is applied on each task before the shuffle as well, so a key with very
    many rows sends only `max_attempts` of them per task.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    ranked = attempts.withColumn("attempt_no", F.row_number().over(by_key)).filter(
        F.col("attempt_no") <= max_attempts
    )
    earlier = Window.partitionBy(*keys).orderBy("attempt_no").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        ranked.withColumn("_done", F.coalesce(F.max("ok").over(earlier), F.lit(False)))
        .filter(~F.col("_done"))
        .drop("_done")
    )


def fold_attempts(
    attempts: DataFrame,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    max_attempts: int = content.MAX_ATTEMPTS,
) -> DataFrame:
    """Per key: whether an attempt succeeded, attempts made, failures, last error."""
    keys, order = keys or ["url"], order or ["attempt"]
    return (
        first_attempts(attempts, keys, order, max_attempts)
        .groupBy(*keys)
        .agg(
            F.bool_or("ok").alias("ok"),
            F.count(F.lit(1)).alias("attempts"),
            F.count_if(~F.col("ok")).alias("failures"),
            F.max_by("error", "attempt_no").alias("last_error"),
        )
    )


def inspect_bodies(bodies: DataFrame, validator: Column | None = None) -> DataFrame:
    """Length, checksum and validity per body. Content itself goes no further than its task.

    `validator` is a boolean Column over `content`, for instance a pandas UDF around a
    parser; the structural check is the default.
    """
    valid = content.pdf_check(F.col("content")) if validator is None else validator
    return bodies.filter(F.col("content").isNotNull()).select(
        "url",
        F.octet_length("content").cast("bigint").alias("body_size"),
        content.content_checksum(F.col("content")).alias("checksum"),
        F.coalesce(valid, F.lit(False)).alias("is_valid"),
    )


def one_body_per_url(inspected: DataFrame) -> DataFrame:
    """Of several bodies of a URL a valid one, of those the longest, then by checksum."""
    order = F.struct("is_valid", "body_size", "checksum")
    return inspected.groupBy("url").agg(F.max(order).alias("_")).select(
        "url", "_.body_size", "_.checksum", "_.is_valid"
    )


def outcome_status(
    decided: DataFrame,
    attempts: DataFrame,
    inspected: DataFrame,
    cap: int = content.SIZE_CAP,
    mode: str = "incremental",
    check_body_size: bool = False,
) -> DataFrame:
    """Status per URL.

    `decided` comes from `change_decision`, `attempts` from `fold_attempts` (by url),
    `inspected` from `inspect_bodies`, of which each URL counts once. Mode "full" ignores the skip decision. A body without
    attempt rows counts as fetched at once; neither body nor attempt is an error.

    URLs that share a file name are handled in URL order, each against the state the earlier
    ones left: once one of them has been stored, the file name's entry carries that URL, so
    every later URL differs from it. At most one URL per file name can look unchanged (the
    entry's own), hence one aggregate per file name finds the URLs to flip, without ranking.
    """
    joined = (
        decided.join(attempts, "url", "left")
        .join(one_body_per_url(inspected), "url", "left")
        .withColumn("fetched", F.coalesce("ok", F.col("body_size").isNotNull()))
    )
    too_large = content.over_size_cap(F.col("content_length"), cap)
    if check_body_size:
        too_large = too_large | F.coalesce(
            content.over_size_cap(F.col("body_size"), cap), F.lit(False)
        )
    # What happens to the URL if it is fetched at all.
    fetch_status = (
        F.when(F.col("head_error").isNotNull(), "error")
        .when(too_large, "too_large")
        .when(~F.col("fetched"), "error")
        .when(~F.coalesce("is_valid", F.lit(False)), "invalid_pdf")
        .otherwise("success")
    )
    rows = joined.withColumn("fetch_status", fetch_status)
    if mode == "full":
        rows = rows.withColumn("status", F.col("fetch_status"))
    else:
        unchanged = F.col("decision") == "skip"
        flipped = (
            rows.groupBy("filename")
            .agg(
                F.min(F.when(~unchanged & (F.col("fetch_status") == "success"), F.col("url")))
                .alias("first_stored"),
                F.max(F.when(unchanged, F.col("url"))).alias("url"),
            )
            .filter(F.col("first_stored") < F.col("url"))
            .select("url", F.lit(True).alias("flipped"))
        )
        rows = rows.join(flipped, "url", "left").withColumns({
            "status": F.when(unchanged & F.col("flipped").isNull(), "skipped_unchanged").otherwise(
                F.col("fetch_status")
            ),
            "decision": F.when(F.col("flipped"), "fetch").otherwise(F.col("decision")),
            "reason": F.when(F.col("flipped"), "url_changed").otherwise(F.col("reason")),
        })
    error = (
        F.when(F.col("head_error").isNotNull(), F.col("head_error"))
        .otherwise(F.coalesce("last_error", F.lit("no body")))
    )
    stored = F.col("status") == "success"
    return rows.select(
        "url",
        "filename",
        "decision",
        "reason",
        "status",
        "content_length",
        "last_modified",
        F.when(stored, F.col("body_size")).alias("body_size"),
        F.when(stored, F.col("checksum")).alias("checksum"),
        F.when(F.col("status") == "error", error).alias("error"),
        F.coalesce("failures", F.lit(0)).alias("failures"),
    )


def file_results(outcomes: DataFrame) -> DataFrame:
    """Status per file name: that of its last URL."""
    return outcomes.groupBy("filename").agg(
        F.max("url").alias("url"), F.max_by("status", "url").alias("status")
    )


def manifest_rows(outcomes: DataFrame, downloaded_at: Column, store: str) -> DataFrame:
    """Manifest entry per file name: that of its last stored URL."""
    stored = outcomes.filter(F.col("status") == "success").select(
        "filename",
        "url",
        F.col("body_size").alias("size"),
        "checksum",
        "last_modified",
        downloaded_at.cast("timestamp").alias("downloaded_at"),
        F.concat(F.lit(store.rstrip("/") + "/"), F.col("filename")).alias("local_path"),
    )
    return skew.latest_by(stored, ["filename"], ["url"])


def upsert_manifest(manifest: DataFrame, new: DataFrame) -> DataFrame:
    """Manifest with the entries of `new` in place of those with the same file name."""
    return manifest.join(new.select("filename"), "filename", "left_anti").unionByName(new)


def as_events(rows: DataFrame, run_id: str, at: Column) -> DataFrame:
    """Event rows in the fixed schema; columns that `rows` lacks become null."""
    given = {
        "run_id": F.lit(run_id),
        "timestamp": F.col("timestamp") if "timestamp" in rows.columns else at,
    }
    return rows.select(*[
        given.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in EVENTS
    ])


# Event names and messages, first by run mode.
STORED_EVENT = {"incremental": "download_success", "full": "upload_ok"}
FAILED_EVENT = {"incremental": "download_error", "full": "upload_error"}
ATTEMPT_EVENT = {"incremental": "download_retry", "full": "download_error"}
TOO_LARGE = "File too large"
INVALID = "Invalid PDF format"


def events_from_outcomes(
    outcomes: DataFrame, run_id: str, at: Column, mode: str = "incremental"
) -> DataFrame:
    """One event per processed URL; a skipped one leaves none."""
    status = F.col("status")
    full = mode == "full"
    rows = outcomes.filter(status != "skipped_unchanged").select(
        F.when(status == "success", STORED_EVENT[mode])
        .when(status == "too_large", "size_error")
        .when(status == "invalid_pdf", "validation_error")
        .otherwise(FAILED_EVENT[mode])
        .alias("event_type"),
        F.when(status.isin("success", "error") & F.lit(not full), F.col("url")).alias("url"),
        F.col("filename").alias("file"),
        F.when(status == "too_large", TOO_LARGE)
        .when(status == "invalid_pdf", INVALID)
        .when(status == "error", F.col("error"))
        .alias("error"),
        F.when(status == "too_large", F.col("content_length"))
        .when(status == "success", F.col("content_length") if full else F.col("body_size"))
        .alias("size"),
        F.when(status == "success", F.col("checksum")).alias("checksum"),
    )
    return as_events(rows, run_id, at)


def events_from_attempts(
    outcomes: DataFrame,
    attempts: DataFrame,
    run_id: str,
    at: Column,
    mode: str = "incremental",
    max_attempts: int = content.MAX_ATTEMPTS,
) -> DataFrame:
    """One event per failed attempt of the URLs that were fetched."""
    failed = first_attempts(attempts, ["url"], ["attempt"], max_attempts).filter(~F.col("ok"))
    tried = outcomes.filter(
        (F.col("decision") != "error") & ~F.col("status").isin("skipped_unchanged", "too_large")
    ).select("url", "filename")
    full = mode == "full"
    rows = failed.join(tried, "url").select(
        F.lit(ATTEMPT_EVENT[mode]).alias("event_type"),
        (F.lit(None).cast("string") if full else F.col("url")).alias("url"),
        F.col("filename").alias("file"),
        "error",
        (F.lit(0) if full else F.lit(None)).alias("retry_count"),
        F.coalesce(F.col("attempted_at"), at).alias("timestamp"),
    )
    return as_events(rows, run_id, at)


def events_from_crawl(
    crawled: DataFrame, documents: DataFrame, run_id: str, at: Column, mode: str = "incremental"
) -> DataFrame:
    """crawl_success or crawl_error per visited page, then one crawl_complete."""
    pages = crawled.select(
        F.when(F.col("error").isNull(), "crawl_success").otherwise("crawl_error").alias("event_type"),
        "url",
        "error",
        (F.lit(0) if mode == "full" else F.lit(None)).alias("retry_count"),
    )
    if mode == "full":
        pages = pages.filter("event_type = 'crawl_error'")
    complete = documents.agg(F.count(F.lit(1)).alias("pdf_count")).withColumn(
        "event_type", F.lit("crawl_complete")
    )
    return as_events(pages, run_id, at).unionByName(as_events(complete, run_id, at))
