"""Links of pages, reachability over them, and the documents they lead to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from docflow.functions import content, html, urls
from docflow.operators import skew
from docflow.reliable import checkpointed, saved

# Every so many steps the set of visited pages is rewritten as one table, so that plans of
# deep graphs stay short.
COMPACT_EVERY = 16


def fetch_error() -> Column:
    """Error of a page's fetch: its own message, or the status where that is one; else null."""
    status = F.when(
        F.col("status_code") >= 400, F.concat(F.lit("HTTP status "), F.col("status_code"))
    )
    return F.coalesce("error", status)


def split_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages fetched with success, and pages whose fetch failed."""
    error = fetch_error()
    return pages.filter(error.isNull()), pages.filter(error.isNotNull())


def extract_links(pages: DataFrame, distinct: bool = False) -> DataFrame:
    """One row (page_url, href) per anchor; `distinct` keeps each href once per page.

    Exploding happens on the page's own task, before any shuffle. The outer form with a
    null filter keeps the optimizer from running the extraction a second time in a filter
    that it would otherwise infer.
    """
    found = html.hrefs(F.col("html"))
    base = urls.base_parts(F.col("url"))
    return (
        pages.select(
            F.col("url").alias("page_url"),
            base.alias("base"),
            (F.array_distinct(found) if distinct else found).alias("hrefs"),
        )
        .select("page_url", "base", F.explode_outer("hrefs").alias("href"))
        .filter(F.col("href").isNotNull())
    )


def page_links(
    pages: DataFrame,
    root: str,
    suffix: str = urls.DOCUMENT_SUFFIX,
    strict: bool = False,
    distinct: bool = False,
    strip_fragment: bool = False,
) -> DataFrame:
    """Resolved links with the document and scope tests.

    A malformed href keeps its row with a null target, so nothing is lost silently.
    """
    links = urls.resolve_links(extract_links(pages, distinct), F.col("base")).drop("base")
    if strip_fragment:
        links = links.withColumn("target_url", F.regexp_replace("target_url", "#.*$", ""))
    return links.withColumns({
        "is_document": F.coalesce(urls.is_document(F.col("target_url"), suffix), F.lit(False)),
        "in_scope": F.coalesce(urls.in_scope(F.col("target_url"), root, strict), F.lit(False)),
    })


def reachable(
    links: DataFrame,
    root: str,
    max_depth: int | None = None,
    hot_rows: int = skew.HOT_ROWS,
    slices: int = skew.SLICES,
) -> DataFrame:
    """(url, depth) of every page reached from `root` over (page_url, target_url) links.

    One job per depth. The links are laid out and sorted by page once and cached that way, so
    a step moves only its frontier and never shuffles or sorts links again; a hub page's links
    are spread over several tasks. A lost cached block is rebuilt from the table behind `links`.
    """
    spark = links.sparkSession
    edges = links.select("page_url", "target_url")
    hot = checkpointed(skew.heavy_keys(edges, ["page_url"], hot_rows))
    keys = ["page_url"]
    if not hot.isEmpty():
        edges = skew.sliced(edges, hot, ["page_url"], ["target_url"], slices)
        keys.append("_slice")
    graph = (
        edges.repartition(*keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    )
    frontier = spark.createDataFrame([(root, 0)], "url string, depth int")
    visited = frontier
    depth = 0
    try:
        while max_depth is None or depth < max_depth:
            depth += 1
            here = frontier.select(F.col("url").alias("page_url"))
            if "_slice" in keys:
                here = skew.replicated(here, hot, ["page_url"], slices)
            found = (
                graph.join(here, keys, "left_semi")
                .select(F.col("target_url").alias("url"))
                .distinct()
            )
            frontier = checkpointed(
                found.join(visited.select("url"), "url", "left_anti").withColumn(
                    "depth", F.lit(depth)
                )
            )
            if frontier.isEmpty():
                break
            visited = visited.unionByName(frontier)
            if depth % COMPACT_EVERY == 0:
                visited = checkpointed(visited)
    finally:
        graph.unpersist()
    return visited


@dataclass
class Discovery:
    """What a crawl yields: visited pages, documents and all resolved links."""

    visited: DataFrame
    documents: DataFrame
    links: DataFrame


def discover(
    pages: DataFrame,
    root: str,
    suffix: str = urls.DOCUMENT_SUFFIX,
    strict: bool = False,
    max_depth: int | None = None,
    strip_fragment: bool = False,
    hot_rows: int = skew.HOT_ROWS,
) -> Discovery:
    """Walks the pages from `root` and collects the documents that visited pages link to.

    The document test comes before the scope test: documents elsewhere count, and a document
    is never walked as a page. Pages whose fetch failed are visited but contribute no links.
    HTML is parsed once; both the walk and the document pass read the saved links.
    """
    fetched, _ = split_pages(pages)
    links = saved(
        page_links(fetched, root, suffix, strict, distinct=True, strip_fragment=strip_fragment),
        "links",
    )
    visited = reachable(
        links.filter(F.col("in_scope") & ~F.col("is_document")), root, max_depth, hot_rows
    )
    visited = checkpointed(visited)
    documents = (
        skew.lookup_join(
            links.filter("is_document").select(F.col("page_url").alias("url"), "target_url"),
            visited.select("url"),
            ["url"],
            ["target_url"],
            "left_semi",
            hot_rows,
        )
        .select(F.col("target_url").alias("url"))
        .distinct()
        .withColumn("filename", urls.document_filename(F.col("url")))
    )
    return Discovery(visited, documents, links)


def page_profile(pages: DataFrame) -> DataFrame:
    """Status, size, title and the first characters of the text, one row per page."""
    profiled = html.with_title_and_text(pages.withColumn("_failed", fetch_error().isNotNull()))
    blank = F.when(F.col("_failed"), F.lit(""))
    return profiled.select(
        F.when(F.col("_failed"), "failure").otherwise("success").alias("status"),
        "url",
        F.when(~F.col("_failed"), F.coalesce("status_code", F.lit(200))).alias("status_code"),
        F.when(~F.col("_failed"), F.octet_length("html").cast("bigint")).alias("content_length"),
        blank.otherwise(F.col("title")).alias("title"),
        blank.otherwise(F.substring("text", 1, html.SAMPLE_CHARS)).alias("sample_text"),
        fetch_error().alias("error"),
    )


def crawl_outcomes(visited: DataFrame, pages: DataFrame) -> DataFrame:
    """Visited pages with the error of their fetch, null where it succeeded.

    A page that links lead to but that nobody observed counts as failed. Of several observations
    of a page one that succeeded counts, else the first error as text.
    """
    observed = (
        pages.select("url", fetch_error().alias("_error"))
        .groupBy("url")
        .agg(
            F.lit(True).alias("_observed"),
            F.when(F.count_if(F.col("_error").isNull()) == 0, F.min("_error")).alias("error"),
        )
    )
    error = F.coalesce("error", F.when(F.col("_observed").isNull(), "not observed"))
    return visited.join(observed, "url", "left").select("url", "depth", error.alias("error"))


def fetch_schedule(documents: DataFrame, delay: float = content.REQUEST_DELAY) -> DataFrame:
    """Planned start of each fetch in seconds: rank of the URL within its host, times delay.

    The rank is exact although one host may own most URLs. Rows are range-partitioned by
    (host, url), ranked inside each range, and moved up by the rows that the host has in
    earlier ranges. Only a host that crosses a range border needs that, so the list of shifts
    holds at most one row per range and can be broadcast.
    """
    named = documents.select("url", urls.host_of(F.col("url")).alias("host")).distinct()
    ranges = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = named.repartitionByRange(ranges, "host", "url").withColumn(
        "_range", F.spark_partition_id()
    )
    # Range borders are sampled anew at every execution: rows and shifts must share one.
    ranked = saved(
        ranged.withColumn(
            "_rank", F.row_number().over(Window.partitionBy("_range", "host").orderBy("url"))
        ),
        "schedule",
    )
    sizes = ranked.groupBy("host", "_range").agg(F.max("_rank").alias("_rows"))
    earlier = Window.partitionBy("host").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = (
        sizes.withColumn("_shift", F.sum("_rows").over(earlier))
        .filter("_shift > 0")
        .select("host", "_range", "_shift")
    )
    rank = F.col("_rank") + F.coalesce("_shift", F.lit(0))
    return ranked.join(F.broadcast(shifts), ["host", "_range"], "left").select(
        "url",
        "host",
        rank.cast("bigint").alias("position"),
        ((rank - 1) * F.lit(float(delay))).alias("start_seconds"),
    )
