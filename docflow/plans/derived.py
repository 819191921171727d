"""Inputs of the registered queries, derived by Spark from the provided tables.

The provided documents become resources of a site, its previous manifest, stored files,
headers, bodies and pages; line items become fetch attempts; events become an event log.
Every function reads whole tables. `catalog` states the same definitions in SQL.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import schemas
from docflow.functions.html import escape
from docflow.sources.tables import conform

ROOT = "https://docs.example.org/lib"
ALT_ROOT = "https://alt.example.org/lib"
MIRROR_ROOT = "https://mirror.example.org/lib"
FAN_OUT = 32  # child pages per page of the derived site


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; its file footers are looked at once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(n: int, remainder: int = 0, key: str = "doc_id") -> Column:
    return F.expr(f"{key} % {n} = {remainder}")


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per row: url, filename, length and date as its server announces them."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "source",
        f"concat('{ROOT}/', source, '/doc-', doc_id, '.pdf') AS url",
        "concat('doc-', doc_id, '.pdf') AS filename",
        "CAST(octet_length(text) + 15 AS BIGINT) AS content_length",
        "concat('Wed, 01 Jan 2025 00:', lpad(CAST(doc_id % 60 AS STRING), 2, '0'), ':00 GMT')"
        " AS last_modified",
        "text",
    )


def all_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resources, some of them also on one or two further hosts under the same file name."""
    roots = (
        f"array_compact(array('{ROOT}', IF(doc_id % 6 = 0, '{ALT_ROOT}', NULL), "
        f"IF(doc_id % 9 = 0, '{MIRROR_ROOT}', NULL)))"
    )
    return resources(spark, sf_dir).selectExpr(
        "*", f"explode({roots}) AS host"
    ).withColumn("url", F.expr("concat(host, '/', source, '/doc-', doc_id, '.pdf')")).drop("host")


def manifest_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier manifest: a part of the resources, some entries outdated."""
    return resources(spark, sf_dir).filter("doc_id % 5 <> 0").selectExpr(
        "filename",
        "IF(doc_id % 11 = 0, concat('https://old.example.org/', filename), url) AS url",
        "IF(doc_id % 7 = 0, content_length + 1, content_length) AS size",
        "sha2(text, 256) AS checksum",
        "CASE WHEN doc_id % 13 = 0 THEN NULL"
        " WHEN doc_id % 17 = 0 THEN 'Tue, 31 Dec 2024 00:00:00 GMT'"
        " ELSE last_modified END AS last_modified",
        "timestamp_seconds(1704067200 + (doc_id % 120) * 86400 + doc_id % 86400) AS downloaded_at",
        "concat('documents/', filename) AS local_path",
    )


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files on disk."""
    return resources(spark, sf_dir).filter("doc_id % 19 <> 0").selectExpr(
        "filename", "content_length AS length"
    )


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw headers for every URL: some lengths absent or no numbers, some requests failed."""
    return all_hosts(spark, sf_dir).selectExpr(
        "url",
        "CASE WHEN doc_id % 29 = 0 THEN 'n/a' WHEN doc_id % 31 = 0 THEN NULL"
        " ELSE CAST(content_length AS STRING) END AS content_length",
        "IF(doc_id % 41 = 0, NULL, last_modified) AS last_modified",
        "IF(doc_id % 37 = 0, 'timed out', NULL) AS error",
    )


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched content of every URL: the document's whole text, framed as a PDF or not."""
    return all_hosts(spark, sf_dir).selectExpr(
        "url",
        "CAST(concat(IF(doc_id % 23 = 0, 'not a document', '%PDF-1.4'), '\\n', text, '\\n%%EOF')"
        " AS BINARY) AS content",
    )


# Line items have no unique key: attempts are ordered by everything that tells two apart.
ATTEMPT_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax", "l_linestatus", "l_returnflag",
]


def item_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as attempts of the order's file; a returned item is a failed attempt."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *ATTEMPT_ORDER,
        "l_orderkey",
        "l_returnflag <> 'R' AS ok",
        "IF(l_returnflag = 'R', concat('HTTP 503 from part ', l_partkey), NULL) AS error",
        "CAST(l_shipdate AS TIMESTAMP) AS attempted_at",
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of the resources: every order belongs to document (order number mod document count),
    its items in order of order number, then position. All line items take part."""
    documents = table(spark, sf_dir, "documents").count()
    res = resources(spark, sf_dir).select("url", "doc_id")
    items = item_attempts(spark, sf_dir).withColumn("doc_id", F.pmod("l_orderkey", F.lit(max(documents, 1))))
    tried = items.join(res, "doc_id")
    order = F.struct("l_orderkey", *ATTEMPT_ORDER)
    return tried.select("url", order.alias("attempt"), "ok", "error", "attempted_at")


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per document: a tree of pages from the root, each linking its document.

    A page holds the document's text, links to its children and its parent, its PDF, and for
    some a copy elsewhere or a printable view. Some pages cannot be fetched, which cuts off
    what lies below them. No page gathers rows of others.
    """
    docs = table(spark, sf_dir, "documents")
    last = F.lit(docs.agg(F.max("doc_id")).first()[0])
    i = F.col("doc_id")

    def page_url(n: Column) -> Column:
        return F.when(n == 0, F.lit(ROOT)).otherwise(F.concat(F.lit(ROOT + "/p/"), n.cast("string")))

    first_child = i * FAN_OUT + 1
    children = F.when(
        first_child <= last, F.sequence(first_child, F.least(i * FAN_OUT + FAN_OUT, last))
    ).otherwise(F.array().cast("array<bigint>"))
    links = F.array_join(
        F.transform(children, lambda n: F.concat(
            F.lit('<a href="/lib/p/'), n.cast("string"), F.lit('">child</a>'))),
        "\n",
    )
    parent = F.when(i > 0, F.concat(
        F.lit("<a class='up' href='"), page_url(F.floor((i - 1) / FAN_OUT)), F.lit("'>up</a>")
    )).otherwise(F.lit(""))
    copy = F.when(every(9), F.concat(F.lit("<a href="), F.expr(f"concat('{MIRROR_ROOT}/', source, '/doc-', doc_id, '.pdf')"), F.lit(">copy</a>"))
                  ).otherwise(F.lit(""))
    view = F.when(every(50), F.lit('<A HREF="?print=1&amp;all=1">print</A>')).otherwise(F.lit(""))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>Page "), i.cast("string"),
        F.lit("</title><script>var a = '<a href=\"/lib/hidden.pdf\">';</script></head><body>"),
        F.lit("<!-- <a href=\"/lib/p/0.pdf\">old</a> -->"),
        links, parent, copy, view,
        F.lit('<a href="/lib/'), F.col("source"), F.lit("/doc-"), i.cast("string"),
        F.lit('.pdf">document</a><p>'), escape(F.col("text")), F.lit("</p></body></html>"),
    )
    return conform(
        docs.select(
            i.alias("page_id"),
            page_url(i).alias("url"),
            html.alias("html"),
            F.when(every(40, 7), 404).otherwise(200).alias("status_code"),
        ),
        schemas.PAGES,
    )


def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the provided pages by page number; cyclic, with pages not reached."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    edges = pages.selectExpr(
        "url AS page_url",
        "explode(concat(sequence(page_id * 6 + 1, page_id * 6 + 6), array(page_id DIV 12))) AS page_id",
    )
    # Pages with a number divisible by five are linked from nowhere, but for the root.
    known = pages.filter("page_id % 5 <> 0 OR page_id = 0").withColumnRenamed("url", "target_url")
    return edges.join(known, "page_id").select("page_url", "target_url")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of fetches: errors, successes, crawled pages, retries, invalid files."""
    log = table(spark, sf_dir, "events").selectExpr(
        "'run-1' AS run_id",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "CASE event_type WHEN 'error' THEN 'download_error' WHEN 'click' THEN 'download_success'"
        " WHEN 'view' THEN 'crawl_success' WHEN 'purchase' THEN 'download_retry'"
        " ELSE 'validation_error' END AS event_type",
        "concat('https://docs.example.org/u/', user_id) AS url",
        "concat('doc-', user_id, '.pdf') AS file",
        "CASE event_type WHEN 'error' THEN concat('HTTP ', 500 + event_id % 4,"
        " ' for https://docs.example.org/u/', user_id, ' after ', event_id, ' ms')"
        " WHEN 'purchase' THEN concat('timeout ', event_id)"
        " WHEN 'signup' THEN 'Invalid PDF format' END AS error",
        "CAST(floor(value * 1000) AS BIGINT) AS size",
    )
    return conform(log, schemas.EVENTS)
