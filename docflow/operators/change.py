"""New, changed or unchanged: candidates against manifest, stored files and headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions import urls
from docflow.operators import skew


def head_observations(raw: DataFrame) -> DataFrame:
    """Parsed header observations.

    A missing length counts as 0. A length that is no integer, like a failed request, makes
    `head_error` non-null. The modification date stays text: it is compared as text.
    """
    length = F.coalesce("content_length", F.lit("0")).try_cast("bigint")
    return raw.select(
        "url",
        length.alias("content_length"),
        "last_modified",
        F.coalesce(
            "error",
            F.when(length.isNull(), F.concat(F.lit("invalid content-length: "), "content_length")),
        ).alias("head_error"),
    )


def candidates(documents: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Distinct document URLs with file names, restricted to the URLs of `only` if given."""
    chosen = documents.select("url").distinct()
    if only is not None:
        chosen = chosen.join(only.select("url"), "url", "left_semi")
    return chosen.withColumn("filename", urls.document_filename(F.col("url")))


def one_head_per_url(heads: DataFrame) -> DataFrame:
    """Of repeated observations of a URL one without error, of those the greatest length and date."""
    order = F.struct(F.col("head_error").isNull(), "content_length", "last_modified", "head_error")
    return heads.groupBy("url").agg(F.max(order).alias("_")).select(
        "url", "_.content_length", "_.last_modified", "_.head_error"
    )


def tracked_state(names: DataFrame, manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per file name of `names`: its manifest entry and whether the file is on disk.

    All three are laid out by file name once. What the manifest and the store know of other
    names goes no further than that.
    """
    entries = manifest.select(
        "filename",
        F.lit(True).alias("tracked"),
        F.col("url").alias("known_url"),
        F.col("size").alias("known_size"),
        F.col("last_modified").alias("known_modified"),
    )
    files = stored.select("filename").distinct().withColumn("on_disk", F.lit(True))
    return (
        names.select("filename").distinct()
        .join(entries, "filename", "left")
        .join(files, "filename", "left")
    )


def observed(chosen: DataFrame, heads: DataFrame) -> DataFrame:
    """Candidates with their headers; without any, `head_error` says so."""
    return chosen.join(one_head_per_url(heads), "url", "left").withColumn(
        "head_error",
        F.when(F.col("content_length").isNull(), F.coalesce("head_error", F.lit("not observed")))
        .otherwise(F.col("head_error")),
    )


def full_decision(chosen: DataFrame, heads: DataFrame) -> DataFrame:
    """Every candidate is fetched, as in a run without memory; neither manifest nor files are read."""
    failed = F.col("head_error").isNotNull()
    return observed(chosen, heads).select(
        "url",
        "filename",
        "content_length",
        "last_modified",
        "head_error",
        F.when(failed, "error").otherwise("fetch").alias("decision"),
        F.when(failed, "head_error").otherwise("full_run").alias("reason"),
    )


def change_decision(
    chosen: DataFrame,
    manifest: DataFrame,
    stored: DataFrame,
    heads: DataFrame,
    hot_rows: int = skew.HOT_ROWS,
) -> DataFrame:
    """Decision and reason per candidate URL; the first rule that holds decides.

    `heads` are parsed observations; repeated ones count once. A URL whose headers could not be observed
    is an error before any rule applies. The size rule compares the manifest's body length
    with the announced length, the date rule compares text and holds only where the header
    is present and not empty.
    """
    joined = skew.lookup_join(
        observed(chosen, heads), tracked_state(chosen, manifest, stored), ["filename"], ["url"],
        "left", hot_rows, count_in=chosen,
    )
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    reason = (
        F.when(F.col("head_error").isNotNull(), "head_error")
        .when(F.col("on_disk").isNull(), "missing_file")
        .when(F.col("tracked").isNull(), "no_metadata")
        .when(differs("known_size", "content_length"), "size_changed")
        .when(differs("known_url", "url"), "url_changed")
        .when(
            (F.col("last_modified") != "") & differs("known_modified", "last_modified"),
            "last_modified_changed",
        )
        .otherwise("unchanged")
    )
    return joined.withColumn("reason", reason).select(
        "url",
        "filename",
        "content_length",
        "last_modified",
        "head_error",
        F.when(F.col("reason") == "head_error", "error")
        .when(F.col("reason") == "unchanged", "skip")
        .otherwise("fetch")
        .alias("decision"),
        "reason",
    )


def snapshot_diff(
    previous: DataFrame, current: DataFrame, keys: list[str], compare: list[str]
) -> DataFrame:
    """new, removed, changed or unchanged per key of two snapshots unique by `keys`."""
    old = previous.select(*keys, F.struct(*compare).alias("old"))
    new = current.select(*keys, F.struct(*compare).alias("new"))
    return old.join(new, keys, "full").select(
        *keys,
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old").eqNullSafe(F.col("new")), "unchanged")
        .otherwise("changed")
        .alias("change"),
    )


def filename_collisions(documents: DataFrame) -> DataFrame:
    """File names claimed by several URLs: how many, the first, and the one that wins.

    Documents are processed in URL order and later ones replace earlier ones, so the last
    URL wins. Single URLs are listed by `colliding_urls`, not gathered into one row.
    """
    return (
        documents.select("filename", "url")
        .distinct()
        .groupBy("filename")
        .agg(
            F.count(F.lit(1)).alias("n_urls"),
            F.min("url").alias("first_url"),
            F.max("url").alias("winning_url"),
        )
        .filter("n_urls > 1")
    )


def colliding_urls(documents: DataFrame, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Every URL of a shared file name, and whether it is the one that wins."""
    pairs = documents.select("filename", "url").distinct()
    return skew.lookup_join(
        pairs, filename_collisions(documents), ["filename"], ["url"], "inner", hot_rows
    ).select(
        "filename", "url", "n_urls", (F.col("url") == F.col("winning_url")).alias("is_winner")
    )
