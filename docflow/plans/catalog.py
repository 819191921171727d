"""Registered queries over the provided tables, each with its SQL counterpart.

`QUERIES` maps a name to a function (spark, sf_dir) -> DataFrame, `SQL` the name to a
statement over the same tables. The statements restate what a query means; they share no
logic with the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import content, urls
from docflow.operators import change, crawl, monitor, outcome, reports, skew
from docflow.plans import collection, derived
from docflow.plans.derived import ALT_ROOT, FAN_OUT, MIRROR_ROOT, ROOT
from docflow.reliable import new_folder, saved

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SMALL_CAP = 20_000


def run_at() -> Column:
    return F.lit("2025-02-01 00:00:00").cast("timestamp")


def query(sql: str, fill: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under its function's name; timestamps leave it without a zone.

    Absent numbers in the columns `fill` read -1 on both sides, since tools that compare
    results disagree on how to show a missing integer.
    """

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = build(spark, sf_dir)
            if fill:
                df = df.fillna(-1, list(fill))
            return df.select(*[
                F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n)
                for n, t in df.dtypes
            ])

        QUERIES[build.__name__] = run
        filled = ", ".join(f"coalesce({c}, -1) AS {c}" for c in fill)
        SQL[build.__name__] = f"SELECT * REPLACE ({filled}) FROM ({sql}) AS q" if fill else sql
        return build

    return register


# --- SQL definitions of the derived tables -------------------------------------------------

_RES = f"""
res AS (
  SELECT doc_id, source, '{ROOT}/' || source || '/doc-' || doc_id || '.pdf' AS url,
         'doc-' || doc_id || '.pdf' AS filename,
         CAST(strlen(text) + 15 AS BIGINT) AS content_length,
         'Wed, 01 Jan 2025 00:' || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ':00 GMT'
           AS last_modified,
         text
  FROM documents),
hosts AS (
  SELECT * FROM res
  UNION ALL
  SELECT * REPLACE ('{ALT_ROOT}/' || source || '/doc-' || doc_id || '.pdf' AS url)
  FROM res WHERE doc_id % 6 = 0
  UNION ALL
  SELECT * REPLACE ('{MIRROR_ROOT}/' || source || '/doc-' || doc_id || '.pdf' AS url)
  FROM res WHERE doc_id % 9 = 0)"""

_MANIFEST = """
manifest AS (
  SELECT doc_id, filename,
         CASE WHEN doc_id % 11 = 0 THEN 'https://old.example.org/' || filename ELSE url END AS url,
         CASE WHEN doc_id % 7 = 0 THEN content_length + 1 ELSE content_length END AS size,
         sha256(text) AS checksum,
         CASE WHEN doc_id % 13 = 0 THEN NULL
              WHEN doc_id % 17 = 0 THEN 'Tue, 31 Dec 2024 00:00:00 GMT'
              ELSE last_modified END AS last_modified,
         make_timestamp((1704067200 + (doc_id % 120) * 86400 + doc_id % 86400) * 1000000)
           AS downloaded_at,
         'documents/' || filename AS local_path
  FROM res WHERE doc_id % 5 <> 0)"""

_HEADS = """
heads AS (
  SELECT doc_id, url, filename, text, content_length AS true_length,
         TRY_CAST(CASE WHEN doc_id % 29 = 0 THEN 'n/a' WHEN doc_id % 31 = 0 THEN '0'
                       ELSE CAST(content_length AS VARCHAR) END AS BIGINT) AS content_length,
         CASE WHEN doc_id % 41 = 0 THEN NULL ELSE last_modified END AS last_modified,
         CASE WHEN doc_id % 37 = 0 THEN 'timed out'
              WHEN doc_id % 29 = 0 THEN 'invalid content-length: n/a' END AS head_error
  FROM hosts)"""

_DECIDED = """
decided AS (
  SELECT h.*,
    CASE WHEN h.head_error IS NOT NULL THEN 'head_error'
         WHEN h.doc_id % 19 = 0 THEN 'missing_file'
         WHEN m.filename IS NULL THEN 'no_metadata'
         WHEN m.size IS DISTINCT FROM h.content_length THEN 'size_changed'
         WHEN m.url IS DISTINCT FROM h.url THEN 'url_changed'
         WHEN h.last_modified IS NOT NULL AND m.last_modified IS DISTINCT FROM h.last_modified
           THEN 'last_modified_changed'
         ELSE 'unchanged' END AS snap_reason
  FROM heads h LEFT JOIN manifest m ON m.filename = h.filename)"""

_ITEM_ORDER = (
    "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, "
    "l_tax, l_linestatus, l_returnflag"
)

_TRIES = f"""
ranked AS (
  SELECT *, l_returnflag <> 'R' AS ok,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ITEM_ORDER}) AS attempt_no
  FROM lineitem),
tries AS (
  SELECT *, coalesce(bool_or(ok) OVER (PARTITION BY l_orderkey ORDER BY attempt_no
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS done
  FROM ranked WHERE attempt_no <= 3),
folded AS (
  SELECT l_orderkey, bool_or(ok) AS ok, count(*) AS attempts,
         count(*) FILTER (NOT ok) AS failures,
         arg_max(CASE WHEN ok THEN '' ELSE 'HTTP 503 from part ' || l_partkey END, attempt_no)
           AS last_message
  FROM tries WHERE NOT done GROUP BY l_orderkey)"""

# Attempts of documents: every order belongs to document (order number mod document count).
_DOC_TRIES = f"""
doc_ranked AS (
  SELECT *, l_returnflag <> 'R' AS ok, l_orderkey % (SELECT count(*) FROM documents) AS doc_key
  FROM lineitem),
doc_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY l_orderkey, {_ITEM_ORDER}) AS attempt_no
  FROM doc_ranked),
doc_tries AS (
  SELECT *, coalesce(bool_or(ok) OVER (PARTITION BY doc_key ORDER BY attempt_no
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS done
  FROM doc_numbered WHERE attempt_no <= 3),
doc_folded AS (
  SELECT doc_key, bool_or(ok) AS ok, count(*) AS attempts,
         count(*) FILTER (NOT ok) AS failures,
         arg_max(CASE WHEN ok THEN '' ELSE 'HTTP 503 from part ' || l_partkey END, attempt_no)
           AS last_message
  FROM doc_tries WHERE NOT done GROUP BY doc_key)"""

_SETTLED = f"""
settled AS (
  SELECT d.*, f.failures, f.last_message,
    CASE WHEN d.head_error IS NOT NULL THEN 'error'
         WHEN d.content_length > {SMALL_CAP} THEN 'too_large'
         WHEN f.ok IS NOT NULL AND NOT f.ok THEN 'error'
         WHEN d.doc_id % 23 = 0 THEN 'invalid_pdf'
         ELSE 'success' END AS fetch_status
  FROM decided d
  LEFT JOIN doc_folded f ON f.doc_key = d.doc_id AND d.url LIKE '{ROOT}/%'),
flips AS (
  SELECT *, snap_reason = 'unchanged' AND coalesce(
      bool_or(snap_reason <> 'unchanged' AND fetch_status = 'success') OVER (
        PARTITION BY filename ORDER BY url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      FALSE) AS flipped
  FROM settled),
outcomes AS (
  SELECT doc_id, url, filename, content_length, last_modified,
    CASE WHEN snap_reason = 'head_error' THEN 'error'
         WHEN snap_reason = 'unchanged' AND NOT flipped THEN 'skip' ELSE 'fetch' END AS decision,
    CASE WHEN flipped THEN 'url_changed' ELSE snap_reason END AS reason,
    CASE WHEN snap_reason = 'unchanged' AND NOT flipped THEN 'skipped_unchanged'
         ELSE fetch_status END AS status,
    strlen(text) + CASE WHEN doc_id % 23 = 0 THEN 21 ELSE 15 END AS length,
    sha256('%PDF-1.4' || chr(10) || text || chr(10) || '%%EOF') AS body_checksum,
    coalesce(head_error, last_message, 'no body') AS message,
    coalesce(failures, 0) AS failures
  FROM flips),
outcome_rows AS (
  SELECT url, filename, decision, reason, status, content_length, last_modified,
    CASE WHEN status = 'success' THEN CAST(length AS BIGINT) END AS body_size,
    CASE WHEN status = 'success' THEN body_checksum END AS checksum,
    CASE WHEN status = 'error' THEN message END AS error,
    failures
  FROM outcomes),
results AS (
  SELECT filename, max(url) AS url, arg_max(status, url) AS status FROM outcomes GROUP BY filename),
entries AS (
  SELECT filename, max(url) AS url, arg_max(body_size, url) AS size,
         arg_max(checksum, url) AS checksum,
         arg_max(coalesce(last_modified, '?'), url) AS modified
  FROM outcome_rows WHERE status = 'success' GROUP BY filename)"""

_OUTCOME = f"WITH {_RES}, {_MANIFEST}, {_HEADS}, {_DECIDED}, {_DOC_TRIES}, {_SETTLED}"

_LOG = """
log AS (
  SELECT ts AS timestamp, event_id, user_id, value,
    CASE event_type WHEN 'error' THEN 'download_error' WHEN 'click' THEN 'download_success'
      WHEN 'view' THEN 'crawl_success' WHEN 'purchase' THEN 'download_retry'
      ELSE 'validation_error' END AS event_type,
    'doc-' || user_id || '.pdf' AS file,
    CASE event_type
      WHEN 'error' THEN 'HTTP ' || (500 + event_id % 4) || ' for https://docs.example.org/u/'
        || user_id || ' after ' || event_id || ' ms'
      WHEN 'purchase' THEN 'timeout ' || event_id
      WHEN 'signup' THEN 'Invalid PDF format' END AS error,
    CAST(floor(value * 1000) AS BIGINT) AS size
  FROM events)"""

_WALK = f"""
top AS (SELECT max(doc_id) AS last FROM documents),
walk(i) AS (
  SELECT CAST(0 AS BIGINT)
  UNION
  SELECT d.doc_id FROM documents d JOIN walk w ON d.doc_id > 0 AND (d.doc_id - 1) // {FAN_OUT} = w.i
  WHERE w.i % 40 <> 7),
seen AS (SELECT d.* FROM documents d JOIN walk w ON w.i = d.doc_id WHERE d.doc_id % 40 <> 7),
found AS (
  SELECT '{ROOT}/' || source || '/doc-' || doc_id || '.pdf' AS url, doc_id FROM seen
  UNION
  SELECT '{MIRROR_ROOT}/' || source || '/doc-' || doc_id || '.pdf' AS url, doc_id
  FROM seen WHERE doc_id % 9 = 0)"""


# --- Links and pages -----------------------------------------------------------------------

_HREFS = r"""
links AS (
  SELECT page_id, url, replace(unnest(regexp_extract_all(
      regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'),
      '<a href="([^"]*)"', 1)), '&amp;', '&') AS href
  FROM pages)"""


@query(f"WITH {_HREFS} SELECT url AS page_url, href FROM links")
def extract_links(spark, sf_dir):
    pages = derived.conform(derived.table(spark, sf_dir, "pages"), derived.schemas.PAGES)
    return crawl.extract_links(pages).drop("base")


@query(rf"""
WITH {_HREFS}, shaped AS (
  SELECT url, strlen(href) % 6 AS shape, substr(href, 2) AS word,
    regexp_extract(url, '^[a-z]+') AS scheme,
    regexp_extract(url, '^[a-z]+://[^/?#]+') AS origin,
    regexp_replace(url, '#.*$', '') AS plain,
    regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/?#]+', '') AS path
  FROM links),
folders AS (SELECT *, regexp_extract(path, '^.*/') AS folder FROM shaped)
SELECT url AS page_url,
  CASE shape WHEN 0 THEN '/' || word WHEN 1 THEN word WHEN 2 THEN '../' || word
    WHEN 3 THEN '?q=' || word WHEN 4 THEN '#' || word ELSE '//cdn.example.org/' || word END AS href,
  CASE shape WHEN 0 THEN origin || '/' || word
    WHEN 1 THEN origin || folder || word
    WHEN 2 THEN origin || regexp_replace(folder, '[^/]+/$', '') || word
    WHEN 3 THEN origin || path || '?q=' || word
    WHEN 4 THEN plain || '#' || word
    ELSE scheme || '://cdn.example.org/' || word END AS target_url
FROM folders""")
def resolve_links(spark, sf_dir):
    pages = derived.conform(derived.table(spark, sf_dir, "pages"), derived.schemas.PAGES)
    word = F.substr("href", F.lit(2))
    prefixes = ["/", "", "../", "?q=", "#", "//cdn.example.org/"]
    prefix = F.element_at(
        F.array(*[F.lit(p) for p in prefixes]), F.octet_length("href") % len(prefixes) + 1
    )
    shaped = crawl.extract_links(pages).withColumn("href", F.concat(prefix, word))
    return urls.resolve_links(shaped, F.col("base")).drop("base")


_VARIANTS = f"""
variants AS (
  SELECT CASE doc_id % 7 WHEN 0 THEN url WHEN 1 THEN url || '?v=1' WHEN 2 THEN url || '#p2'
    WHEN 3 THEN replace(url, '.pdf', '.PDF') WHEN 4 THEN replace(url, '/lib/', '/lib-old/')
    WHEN 5 THEN url || ';v=1' ELSE replace(url, 'doc-', 'set-' || doc_id || '/?d=') END AS url
  FROM hosts)"""


def _variants(spark, sf_dir) -> DataFrame:
    return derived.all_hosts(spark, sf_dir).selectExpr(
        "CASE doc_id % 7 WHEN 0 THEN url WHEN 1 THEN concat(url, '?v=1') WHEN 2 THEN concat(url, '#p2')"
        " WHEN 3 THEN replace(url, '.pdf', '.PDF') WHEN 4 THEN replace(url, '/lib/', '/lib-old/')"
        " WHEN 5 THEN concat(url, ';v=1')"
        " ELSE replace(url, 'doc-', concat('set-', doc_id, '/?d=')) END AS url"
    )


@query(f"""
WITH {_RES}, {_VARIANTS}
SELECT url, '{ROOT}' AS root, lower(url) LIKE '%.pdf' AS is_document,
  starts_with(url, '{ROOT}') AS in_scope,
  regexp_matches(url, '^{ROOT}([/?#]|$)') AS in_scope_strict
FROM variants""")
def scope_filter(spark, sf_dir):
    u = F.col("url")
    base = ROOT.removesuffix("/lib")
    return _variants(spark, sf_dir).select(
        "url",
        urls.root_url(F.lit(base + "//"), "lib").alias("root"),
        urls.is_document(u).alias("is_document"),
        urls.in_scope(u, ROOT).alias("in_scope"),
        urls.in_scope(u, ROOT, strict=True).alias("in_scope_strict"),
    )


@query(f"""
WITH {_RES}, {_VARIANTS}
SELECT url, coalesce(nullif(regexp_replace(regexp_extract(
    regexp_replace(url, '[?#].*$', ''), '[^/]*$'), ';.*$', ''), ''),
  'document_' || left(md5(url), 8) || '.pdf') AS filename
FROM variants""")
def document_filenames(spark, sf_dir):
    return _variants(spark, sf_dir).withColumn("filename", urls.document_filename(F.col("url")))


_OBSERVED = """
observed AS (
  SELECT page_id, url, html, CASE WHEN page_id % 17 = 5 THEN 503 ELSE 200 END AS status_code,
    CASE WHEN page_id % 19 = 3 THEN 'connection reset' END AS error
  FROM pages)"""


def _observed_pages(spark, sf_dir) -> DataFrame:
    return derived.conform(
        derived.table(spark, sf_dir, "pages").withColumns({
            "status_code": F.when(derived.every(17, 5, "page_id"), 503).otherwise(200),
            "error": F.when(derived.every(19, 3, "page_id"), "connection reset"),
        }),
        derived.schemas.PAGES,
    )


_PLAIN = "replace(replace(replace(replace({}, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"


@query(rf"""
WITH {_OBSERVED}, shown AS (
  SELECT *, error IS NOT NULL OR status_code >= 400 AS failed,
    regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g') AS rest
  FROM observed)
SELECT CASE WHEN failed THEN 'failure' ELSE 'success' END AS status, url,
  CASE WHEN NOT failed THEN status_code END AS status_code,
  CASE WHEN NOT failed THEN CAST(strlen(html) AS BIGINT) END AS content_length,
  CASE WHEN failed THEN '' ELSE
    {_PLAIN.format("regexp_extract(rest, '(?s)<title>(.*?)</title>', 1)")} END AS title,
  CASE WHEN failed THEN '' ELSE substr(
    {_PLAIN.format("regexp_replace(rest, '<[a-zA-Z!/][^>]*>', '', 'g')")}, 1, 500) END AS sample_text,
  CASE WHEN failed THEN coalesce(error, 'HTTP status ' || status_code) END AS error
FROM shown""", fill=("status_code", "content_length"))
def page_profile(spark, sf_dir):
    return crawl.page_profile(_observed_pages(spark, sf_dir))


@query(f"""
WITH {_OBSERVED}
SELECT url, error IS NULL AND status_code < 400 AS fetched FROM observed""")
def page_status_split(spark, sf_dir):
    fetched, failed = crawl.split_pages(_observed_pages(spark, sf_dir))
    return fetched.select("url", F.lit(True).alias("fetched")).unionByName(
        failed.select("url", F.lit(False).alias("fetched"))
    )


@query("""
WITH RECURSIVE edges AS (
  SELECT p.page_id AS a, q.page_id AS b FROM pages p JOIN pages q
    ON q.page_id BETWEEN p.page_id * 6 + 1 AND p.page_id * 6 + 6 OR q.page_id = p.page_id // 12
  WHERE q.page_id % 5 <> 0 OR q.page_id = 0),
walk(i, depth) AS (
  SELECT CAST(0 AS BIGINT), 0
  UNION
  SELECT e.b, w.depth + 1 FROM walk w JOIN edges e ON e.a = w.i WHERE w.depth < 40)
SELECT p.url, min(w.depth) AS depth FROM walk w JOIN pages p ON p.page_id = w.i GROUP BY p.url""")
def reachable_pages(spark, sf_dir):
    links = saved(derived.link_graph(spark, sf_dir), "graph")
    root = derived.table(spark, sf_dir, "pages").filter("page_id = 0").first()["url"]
    return crawl.reachable(links, root)


@query(f"""
WITH RECURSIVE {_WALK}
SELECT url, regexp_extract(url, '[^/]*$') AS filename FROM found""")
def discover_documents(spark, sf_dir):
    return crawl.discover(derived.site_pages(spark, sf_dir), ROOT).documents


@query(f"WITH {_RES} SELECT DISTINCT url FROM hosts ORDER BY url")
def url_listing(spark, sf_dir):
    return derived.all_hosts(spark, sf_dir).select("url").distinct().orderBy("url")


@query(f"WITH {_RES} SELECT DISTINCT url FROM hosts ORDER BY url LIMIT 50")
def url_sample(spark, sf_dir):
    """The first 50 URLs: the limit is the feature."""
    return derived.all_hosts(spark, sf_dir).select("url").distinct().orderBy("url").limit(50)


@query(f"""
WITH {_RES}, targets AS (
  SELECT url FROM pages UNION SELECT url FROM hosts),
named AS (SELECT url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM targets)
SELECT url, host, row_number() OVER (PARTITION BY host ORDER BY url) AS position,
  (row_number() OVER (PARTITION BY host ORDER BY url) - 1) * CAST(0.25 AS DOUBLE) AS start_seconds
FROM named""")
def fetch_schedule(spark, sf_dir):
    targets = derived.table(spark, sf_dir, "pages").select("url").unionByName(
        derived.all_hosts(spark, sf_dir).select("url")
    )
    return crawl.fetch_schedule(targets)


# --- Change decision -----------------------------------------------------------------------


@query(f"""
WITH {_RES}, {_HEADS}
SELECT url, content_length, last_modified, head_error FROM heads""", fill=("content_length",))
def head_parse(spark, sf_dir):
    return change.head_observations(derived.heads(spark, sf_dir))


def _decided(spark, sf_dir, only: DataFrame | None = None) -> DataFrame:
    return change.change_decision(
        change.candidates(derived.all_hosts(spark, sf_dir), only),
        derived.manifest_prev(spark, sf_dir),
        derived.stored(spark, sf_dir),
        change.head_observations(derived.heads(spark, sf_dir)),
    )


_DECISION = """
SELECT url, filename, content_length, last_modified, head_error,
  CASE snap_reason WHEN 'head_error' THEN 'error' WHEN 'unchanged' THEN 'skip' ELSE 'fetch' END
    AS decision, snap_reason AS reason
FROM decided"""


@query(f"WITH {_RES}, {_MANIFEST}, {_HEADS}, {_DECIDED} {_DECISION}", fill=("content_length",))
def change_decision(spark, sf_dir):
    return _decided(spark, sf_dir)


@query(f"""
WITH {_RES}, {_MANIFEST}, {_HEADS}, {_DECIDED} {_DECISION}
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""", fill=("content_length",))
def restricted_plan(spark, sf_dir):
    """Only URLs of documents that somebody labelled good."""
    good = derived.table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    only = derived.all_hosts(spark, sf_dir).join(good, "doc_id", "left_semi").select("url")
    return _decided(spark, sf_dir, only)


@query(f"""
WITH {_RES}, {_MANIFEST}, current AS (SELECT * FROM res WHERE doc_id % 8 <> 3)
SELECT coalesce(m.filename, c.filename) AS filename,
  CASE WHEN m.filename IS NULL THEN 'new' WHEN c.filename IS NULL THEN 'removed'
    WHEN m.url = c.url AND m.size = c.content_length
      AND m.last_modified IS NOT DISTINCT FROM c.last_modified THEN 'unchanged'
    ELSE 'changed' END AS change
FROM manifest m FULL JOIN current c ON m.filename = c.filename""")
def snapshot_diff(spark, sf_dir):
    """The earlier manifest against resources of which an eighth has gone."""
    current = (
        derived.resources(spark, sf_dir)
        .filter(~derived.every(8, 3))
        .withColumnRenamed("content_length", "size")
    )
    return change.snapshot_diff(
        derived.manifest_prev(spark, sf_dir), current, ["filename"], ["url", "size", "last_modified"]
    )


@query(f"""
WITH {_RES}
SELECT filename, count(DISTINCT url) AS n_urls, min(url) AS first_url, max(url) AS winning_url
FROM hosts GROUP BY filename HAVING count(DISTINCT url) > 1""")
def filename_collisions(spark, sf_dir):
    return change.filename_collisions(derived.all_hosts(spark, sf_dir))


@query(f"""
WITH {_RES}, counted AS (
  SELECT filename, url, count(*) OVER (PARTITION BY filename) AS n_urls,
    url = max(url) OVER (PARTITION BY filename) AS is_winner FROM hosts)
SELECT * FROM counted WHERE n_urls > 1""")
def colliding_urls(spark, sf_dir):
    return change.colliding_urls(derived.all_hosts(spark, sf_dir))


@query(f"""
WITH {_RES}
SELECT filename, max(url) AS url, max(content_length) AS content_length
FROM hosts GROUP BY filename""")
def latest_by_filename(spark, sf_dir):
    hosts = derived.all_hosts(spark, sf_dir).select("filename", "url", "content_length")
    return skew.latest_by(hosts, ["filename"], ["url"])


# --- Attempts and outcomes -----------------------------------------------------------------


@query(f"""
WITH {_TRIES}
SELECT l_orderkey, ok, attempts, failures, nullif(last_message, '') AS last_error
FROM folded""")
def fold_attempts(spark, sf_dir):
    items = derived.item_attempts(spark, sf_dir)
    return outcome.fold_attempts(items, ["l_orderkey"], derived.ATTEMPT_ORDER)


@query(f"""
WITH {_TRIES}
SELECT l_orderkey, CAST(attempt_no AS INTEGER) AS attempt_no, l_shipdate AS attempted_at,
  l_shipdate + to_seconds(CAST(least(10, greatest(4, pow(2, attempt_no - 1))) AS BIGINT))
    AS next_attempt_at,
  l_shipdate + to_seconds(CAST(least(8, greatest(2, pow(2, attempt_no - 1))) AS BIGINT))
    AS next_probe_at
FROM tries WHERE NOT done AND NOT ok AND attempt_no < 3""")
def next_attempt(spark, sf_dir):
    tries = outcome.first_attempts(
        derived.item_attempts(spark, sf_dir), ["l_orderkey"], derived.ATTEMPT_ORDER
    )
    n, at = F.col("attempt_no"), F.col("attempted_at")
    return tries.filter(~F.col("ok") & (n < content.MAX_ATTEMPTS)).select(
        "l_orderkey",
        "attempt_no",
        "attempted_at",
        content.next_attempt_at(n, at).alias("next_attempt_at"),
        content.next_attempt_at(n, at, *content.PROBE_WAIT).alias("next_probe_at"),
    )


@query(f"""
WITH {_RES}
SELECT filename, content_length, content_length > {SMALL_CAP} AS too_large FROM res""")
def size_cap(spark, sf_dir):
    length = F.col("content_length")
    return derived.resources(spark, sf_dir).select(
        "filename", "content_length", content.over_size_cap(length, SMALL_CAP).alias("too_large")
    )


@query("SELECT doc_id, sha256(text) AS checksum FROM documents")
def content_checksum(spark, sf_dir):
    docs = derived.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", content.content_checksum(F.col("text").cast("binary")).alias("checksum")
    )


@query("""
SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN FALSE WHEN 2 THEN FALSE
  ELSE TRUE END AS is_valid
FROM documents""")
def pdf_check(spark, sf_dir):
    """Whole texts framed as PDFs: intact, without header, without end, with text after it."""
    kind = F.col("doc_id") % 4
    start = F.when(kind == 1, "not a document").otherwise(F.lit("%PDF-1.4"))
    end = (
        F.when(kind == 2, F.lit("\n"))
        .when(kind == 3, F.concat(F.lit("\n%%EOF\n"), F.col("text")))
        .otherwise(F.lit("\n%%EOF"))
    )
    docs = derived.table(spark, sf_dir, "documents")
    framed = docs.select(
        "doc_id", F.concat(start, F.lit("\n"), "text", end).cast("binary").alias("content")
    )
    return framed.select("doc_id", content.pdf_check(F.col("content")).alias("is_valid"))


def _outcomes(spark, sf_dir, mode: str = "incremental") -> DataFrame:
    if mode == "full":
        decided = change.full_decision(
            change.candidates(derived.all_hosts(spark, sf_dir)),
            change.head_observations(derived.heads(spark, sf_dir)),
        )
    else:
        decided = _decided(spark, sf_dir)
    return outcome.outcome_status(
        decided,
        outcome.fold_attempts(derived.attempts(spark, sf_dir)),
        saved(outcome.inspect_bodies(derived.bodies(spark, sf_dir)), "inspected"),
        SMALL_CAP,
        mode,
    )


@query(f"{_OUTCOME} SELECT * FROM outcome_rows", fill=("content_length", "body_size"))
def outcome_status(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query(f"{_OUTCOME} SELECT url, filename, fetch_status AS status FROM settled")
def outcome_status_full(spark, sf_dir):
    return _outcomes(spark, sf_dir, "full").select("url", "filename", "status")


@query(f"{_OUTCOME} SELECT filename, url, status FROM results")
def file_results(spark, sf_dir):
    return outcome.file_results(_outcomes(spark, sf_dir))


@query(f"""
{_OUTCOME}
SELECT filename, url, size, checksum, nullif(modified, '?') AS last_modified,
  TIMESTAMP '2025-02-01 00:00:00' AS downloaded_at, 'documents/' || filename AS local_path
FROM entries
UNION ALL
SELECT filename, url, size, checksum, last_modified, downloaded_at, local_path
FROM manifest WHERE filename NOT IN (SELECT filename FROM entries)""")
def upsert_manifest(spark, sf_dir):
    entries = outcome.manifest_rows(_outcomes(spark, sf_dir), run_at(), "documents")
    return outcome.upsert_manifest(derived.manifest_prev(spark, sf_dir), entries)


_EVENTS = f"""
SELECT 'run-1' AS run_id, TIMESTAMP '2025-02-01 00:00:00' AS timestamp,
  CASE status WHEN 'success' THEN 'download_success' WHEN 'too_large' THEN 'size_error'
    WHEN 'invalid_pdf' THEN 'validation_error' ELSE 'download_error' END AS event_type,
  CASE WHEN status IN ('success', 'error') THEN url END AS url, filename AS file,
  CASE status WHEN 'too_large' THEN 'File too large' WHEN 'invalid_pdf' THEN 'Invalid PDF format'
    ELSE error END AS error,
  CASE status WHEN 'too_large' THEN content_length ELSE body_size END AS size, checksum,
  CAST(NULL AS BIGINT) AS pdf_count, CAST(NULL AS INTEGER) AS retry_count
FROM outcome_rows WHERE status <> 'skipped_unchanged'"""


@query(f"""
{_OUTCOME}
{_EVENTS}
UNION ALL
SELECT 'run-1', t.l_shipdate, 'download_retry', o.url, o.filename,
  'HTTP 503 from part ' || t.l_partkey, NULL, NULL, NULL, NULL
FROM outcomes o JOIN doc_tries t ON t.doc_key = o.doc_id AND o.url LIKE '{ROOT}/%'
WHERE NOT t.done AND NOT t.ok AND o.decision <> 'error'
  AND o.status NOT IN ('skipped_unchanged', 'too_large')""", fill=("size", "pdf_count", "retry_count"))
def events_from_outcomes(spark, sf_dir):
    outcomes = saved(_outcomes(spark, sf_dir), "outcomes")
    return outcome.events_from_outcomes(outcomes, "run-1", run_at()).unionByName(
        outcome.events_from_attempts(outcomes, derived.attempts(spark, sf_dir), "run-1", run_at())
    )


@query(f"{_OUTCOME} SELECT status, count(*) AS n FROM results GROUP BY status")
def outcome_counts(spark, sf_dir):
    return reports.outcome_counts(outcome.file_results(_outcomes(spark, sf_dir)))


@query(f"""
{_OUTCOME}
SELECT count(*) AS results,
  round(avg(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END), 9) AS success_rate
FROM results""")
def success_rate(spark, sf_dir):
    results = outcome.file_results(_outcomes(spark, sf_dir))
    return reports.success_rate(results).withColumn("success_rate", F.round("success_rate", 9))


def _run(spark, sf_dir, mode: str = "incremental") -> collection.Run:
    return collection.run_collection(
        derived.site_pages(spark, sf_dir),
        ROOT,
        derived.heads(spark, sf_dir),
        derived.attempts(spark, sf_dir),
        derived.bodies(spark, sf_dir),
        derived.manifest_prev(spark, sf_dir),
        derived.stored(spark, sf_dir),
        "run-1",
        run_at(),
        mode,
        SMALL_CAP,
    )


# The run sees only the URLs that the crawl finds; document URLs elsewhere are unknown to it.
_RUN = f"""WITH RECURSIVE {_WALK}, {_RES.replace("hosts AS (", "every_host AS (")},
hosts AS (SELECT * FROM every_host WHERE url IN (SELECT url FROM found)),
{_MANIFEST}, {_HEADS}, {_DECIDED}, {_DOC_TRIES}, {_SETTLED}"""


@query(f"""
{_RUN}
SELECT (SELECT count(*) FROM walk)
    + (SELECT count(*) FROM seen WHERE doc_id % 50 = 0) AS pages_visited,
  (SELECT count(*) FROM found) AS pdfs_found,
  (SELECT count(*) FROM results WHERE status = 'success') AS success_count,
  (SELECT count(*) FROM results WHERE status = 'skipped_unchanged') AS skipped_count,
  (SELECT count(*) FROM (SELECT filename FROM manifest UNION SELECT filename FROM entries))
    AS total_files_tracked,
  TRUE AS incremental_mode""")
def run_summary(spark, sf_dir):
    return _run(spark, sf_dir).summary.select(
        "pages_visited", "pdfs_found", "success_count", "skipped_count", "total_files_tracked",
        "incremental_mode",
    )


@query(f"""
{_RUN}, crawl_log AS (
  SELECT 'crawl_error' AS event_type, count(*) AS n FROM walk WHERE i % 40 = 7
  UNION ALL
  SELECT 'crawl_error', count(*) FROM seen WHERE doc_id % 50 = 0),
fetch_log AS (
  SELECT CASE fetch_status WHEN 'success' THEN 'upload_ok' WHEN 'too_large' THEN 'size_error'
      WHEN 'invalid_pdf' THEN 'validation_error' ELSE 'upload_error' END AS event_type,
    count(*) AS n
  FROM settled GROUP BY 1
  UNION ALL
  SELECT 'download_error', count(*) FROM settled s
  JOIN doc_tries t ON t.doc_key = s.doc_id AND s.url LIKE '{ROOT}/%'
  WHERE NOT t.done AND NOT t.ok AND s.snap_reason <> 'head_error' AND s.fetch_status <> 'too_large'
  UNION ALL
  SELECT 'crawl_complete', 1)
SELECT event_type, CAST(sum(n) AS BIGINT) AS n,
  CAST(max(CASE WHEN event_type = 'crawl_complete' THEN (SELECT count(*) FROM found) END) AS BIGINT)
    AS pdf_count
FROM (SELECT * FROM crawl_log UNION ALL SELECT * FROM fetch_log) GROUP BY event_type""", fill=("pdf_count",))
def full_run_events(spark, sf_dir):
    """A run that ignores the manifest, in the older event names: events per name."""
    return _run(spark, sf_dir, "full").events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("pdf_count").alias("pdf_count")
    )


# --- Reports -------------------------------------------------------------------------------


@query(f"""
WITH {_RES}, {_MANIFEST}
SELECT count(*) AS total_files, round(sum(size) / 1048576.0, 2) AS total_size_mb,
  max(downloaded_at) AS latest_download, 'manifest' AS metadata_file,
  'ready_for_incremental' AS status
FROM manifest""")
def incremental_status(spark, sf_dir):
    return reports.incremental_status(derived.manifest_prev(spark, sf_dir), "manifest")


@query(f"""
WITH {_LOG}, totals AS (
  SELECT count(*) FILTER (event_type = 'download_success') AS files,
    count(*) FILTER (event_type IN ('download_error', 'validation_error')) AS failures,
    sum(size) FILTER (event_type = 'download_success') AS bytes,
    (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 AS seconds
  FROM log)
SELECT files, failures, round(CAST(bytes AS DOUBLE) / 1048576, 2) AS total_size_mb,
  round(seconds, 6) AS duration_seconds, round(files / seconds, 9) AS files_per_second
FROM totals""")
def throughput(spark, sf_dir):
    return reports.throughput(derived.event_log(spark, sf_dir)).withColumns({
        "duration_seconds": F.round("duration_seconds", 6),
        "files_per_second": F.round("files_per_second", 9),
    })


@query(f"""
WITH {_LOG}, shaped AS (
  SELECT event_type, file, timestamp, regexp_replace(regexp_replace(error,
    'https://[^ ]+', '<url>', 'g'), '[0-9]+', '<n>', 'g') AS pattern
  FROM log WHERE error IS NOT NULL)
SELECT event_type, pattern, count(*) AS n, min(timestamp) AS first_seen, max(timestamp) AS last_seen
FROM shaped GROUP BY event_type, pattern""")
def error_patterns(spark, sf_dir):
    """Without the approximate count of files, which no exact statement can match."""
    return reports.error_patterns(derived.event_log(spark, sf_dir)).drop("approx_files")


def _contents(spark, sf_dir) -> DataFrame:
    """Checksum and size of every document's whole text."""
    return derived.resources(spark, sf_dir).select(
        "filename",
        content.content_checksum(F.col("text").cast("binary")).alias("checksum"),
        F.octet_length("text").cast("bigint").alias("size"),
    )


@query("""
WITH sums AS (
  SELECT sha256(text) AS checksum, 'doc-' || doc_id || '.pdf' AS filename, strlen(text) AS size
  FROM documents)
SELECT checksum, count(*) AS copies, min(filename) AS keeper,
  CAST(sum(size) - max(size) AS BIGINT) AS wasted_bytes
FROM sums GROUP BY checksum HAVING count(*) > 1""")
def duplicate_content(spark, sf_dir):
    return reports.duplicate_content(_contents(spark, sf_dir))


@query("""
WITH sums AS (
  SELECT sha256(text) AS checksum, 'doc-' || doc_id || '.pdf' AS filename,
    CAST(strlen(text) AS BIGINT) AS size
  FROM documents),
counted AS (
  SELECT checksum, filename, size, count(*) OVER (PARTITION BY checksum) AS copies,
    filename = min(filename) OVER (PARTITION BY checksum) AS is_keeper
  FROM sums)
SELECT * FROM counted WHERE copies > 1""")
def duplicate_files(spark, sf_dir):
    return reports.duplicate_files(_contents(spark, sf_dir))


@query(f"""
WITH {_LOG}, files AS (
  SELECT file, (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 AS seconds,
    count(*) FILTER (event_type = 'download_success') AS ok,
    count(*) FILTER (event_type IN ('download_error', 'validation_error')) AS failed
  FROM log GROUP BY file)
SELECT count(*) AS files, round(avg(seconds), 3) AS avg_seconds,
  round(sum(ok) / (sum(ok) + sum(failed)), 9) AS success_rate,
  round(sum(failed) / (sum(ok) + sum(failed)), 9) AS failure_rate
FROM files""")
def processing_stats(spark, sf_dir):
    """Without the approximate percentiles."""
    stats = reports.processing_stats(derived.event_log(spark, sf_dir))
    return stats.select(
        "files",
        F.round("avg_seconds", 3).alias("avg_seconds"),
        F.round("success_rate", 9).alias("success_rate"),
        F.round("failure_rate", 9).alias("failure_rate"),
    )


@query(f"""
WITH {_LOG}, days AS (
  SELECT CAST(timestamp AS DATE) AS day, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes
  FROM log WHERE event_type = 'download_success' GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, files, bytes,
  files - lag(files) OVER (ORDER BY day) AS files_delta,
  bytes - lag(bytes) OVER (ORDER BY day) AS bytes_delta
FROM days""", fill=("files_delta", "bytes_delta"))
def daily_trend(spark, sf_dir):
    trend = reports.daily_trend(derived.event_log(spark, sf_dir))
    return trend.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(f"""
WITH {_RES}, profile AS (
  SELECT source AS category, content_length AS size,
    CASE WHEN content_length / 1024.0 >= 1 AND content_length / 1024.0 < 100 THEN 'small'
         WHEN content_length / 1024.0 >= 100 AND content_length / 1024.0 < 1000 THEN 'medium'
         WHEN content_length / 1024.0 >= 1000 AND content_length / 1024.0 < 10000 THEN 'large'
         WHEN content_length / 1024.0 >= 10000 AND content_length / 1024.0 < 50000
           THEN 'very_large' END AS band
  FROM res)
SELECT category, band, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes,
  CAST(grouping(category, band) AS BIGINT) AS level
FROM profile GROUP BY ROLLUP (category, band)""")
def collection_profile(spark, sf_dir):
    profiled = derived.resources(spark, sf_dir).select(
        urls.url_category(F.col("url"), ROOT).alias("category"),
        content.size_band(F.col("content_length")).alias("band"),
        F.col("content_length").alias("size"),
    )
    return reports.collection_profile(profiled)


QUOTA = 10_000_000


@query(f"""
WITH {_RES}, {_MANIFEST}, days AS (
  SELECT CAST(downloaded_at AS DATE) AS day, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes
  FROM manifest GROUP BY 1),
grown AS (
  SELECT *, CAST(sum(bytes) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_bytes
  FROM days)
SELECT strftime(day, '%Y-%m-%d') AS day, files, bytes, total_bytes,
  round(CAST(total_bytes AS DOUBLE) / {QUOTA}, 9) AS quota_share,
  CAST(total_bytes AS DOUBLE) / {QUOTA} > 0.8 AS over_quota_alert
FROM grown""")
def storage_growth(spark, sf_dir):
    grown = reports.storage_growth(derived.manifest_prev(spark, sf_dir), QUOTA)
    return grown.withColumns({
        "day": F.date_format("day", "yyyy-MM-dd"), "quota_share": F.round("quota_share", 9)
    })


@query(f"""
WITH {_RES}, {_MANIFEST}, aged AS (
  SELECT date_diff('day', CAST(downloaded_at AS DATE), DATE '2024-05-01') AS age, size FROM manifest)
SELECT CASE WHEN age >= 90 THEN 'archive' WHEN age >= 30 THEN 'infrequent' ELSE 'standard' END AS tier,
  count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes
FROM aged GROUP BY 1""")
def storage_tier(spark, sf_dir):
    return reports.storage_tiers(derived.manifest_prev(spark, sf_dir), F.lit("2024-05-01").cast("date"))


# --- Alert windows -------------------------------------------------------------------------

BREACH_VALUE = 10.0
BREACH_SECONDS = 1200

_ISLANDS = """
marked AS (
  SELECT series, t, bad,
    sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (
      PARTITION BY series ORDER BY t ROWS UNBOUNDED PRECEDING) AS island
  FROM samples),
runs AS (
  SELECT series, min(t) AS run_start, max(t) AS run_end, count(*) AS samples
  FROM marked WHERE bad GROUP BY series, island)"""


@query(f"""
WITH samples AS (
  SELECT event_type AS series, ts AS t, value > {BREACH_VALUE} AS bad FROM events),
{_ISLANDS}
SELECT series AS event_type, run_start, run_end, samples,
  (epoch_us(run_end) - epoch_us(run_start)) / 1e6 AS duration_seconds
FROM runs WHERE epoch_us(run_end) - epoch_us(run_start) > {BREACH_SECONDS}000000""")
def sustained_breach(spark, sf_dir):
    """Runs of high values per event type that last longer than twenty minutes."""
    return monitor.sustained_breach(
        derived.table(spark, sf_dir, "events"), F.col("value") > BREACH_VALUE, BREACH_SECONDS,
        ["event_type"],
    )


_ERROR_WINDOWS = f"""
WITH {_LOG}, hours AS (
  SELECT date_trunc('hour', timestamp) AS window_start, count(*) AS events,
    count(*) FILTER (event_type IN ('download_error', 'validation_error')) AS errors
  FROM log GROUP BY 1)
SELECT window_start, events, errors, round(errors / events, 9) AS error_rate,
  errors / events > 0.1 AS alert
FROM hours"""


@query(_ERROR_WINDOWS)
def error_rate_windows(spark, sf_dir):
    windows = monitor.error_rate_windows(derived.event_log(spark, sf_dir))
    return windows.withColumn("error_rate", F.round("error_rate", 9))


_MINUTES = f"""
{_LOG}, counted AS (
  SELECT date_trunc('minute', timestamp) AS window_start,
    count(*) FILTER (event_type = 'download_success') AS files
  FROM log GROUP BY 1),
minutes AS (
  SELECT s.window_start, coalesce(c.files, 0) AS files
  FROM (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 MINUTE))
          AS window_start FROM counted) s
  LEFT JOIN counted c ON c.window_start = s.window_start)"""


@query(f"""
WITH {_MINUTES}
SELECT window_start, files, round(files / 60.0, 9) AS files_per_second FROM minutes""")
def rate_windows(spark, sf_dir):
    minutes = monitor.fill_windows(monitor.rate_windows(derived.event_log(spark, sf_dir)))
    return minutes.withColumn("files_per_second", F.round("files_per_second", 9))


SLOW_RATE = 0.01


@query(f"""
WITH {_MINUTES}, samples AS (
  SELECT 0 AS series, window_start AS t, files / 60.0 < {SLOW_RATE} AS bad FROM minutes),
{_ISLANDS}
SELECT run_start, run_end, samples,
  (epoch_us(run_end) - epoch_us(run_start)) / 1e6 AS duration_seconds
FROM runs WHERE epoch_us(run_end) - epoch_us(run_start) > 1800000000""")
def slow_download_alerts(spark, sf_dir):
    return monitor.slow_download_alerts(derived.event_log(spark, sf_dir), SLOW_RATE)


# --- Sources, sinks and streams ------------------------------------------------------------


@query(f"""
WITH {_RES}, {_MANIFEST}
SELECT filename, url, CASE WHEN doc_id % 3 = 0 THEN size + 7 ELSE size END AS size, checksum,
  last_modified, downloaded_at, local_path
FROM manifest""")
def manifest_roundtrip(spark, sf_dir):
    """A manifest written, updated by a second run, compacted and read back."""
    from docflow.sources.manifests import ManifestStore

    first = derived.manifest_prev(spark, sf_dir)
    number = F.regexp_extract("filename", "doc-([0-9]+)", 1).cast("bigint")
    update = first.filter(number % 3 == 0).withColumn("size", F.col("size") + 7)
    store = ManifestStore(spark, new_folder(spark, "manifest"))
    store.append(first, "run-1")
    store.append(update, "run-2")
    store.compact("compact-2")
    return store.read()


@query(f"""
WITH {_LOG}
SELECT 'run-1' AS run_id, timestamp, event_type, file, error, size FROM log""")
def events_roundtrip(spark, sf_dir):
    """The event log written as JSON lines and read back."""
    from docflow.sources.events import read_events, write_events

    path = new_folder(spark, "events")
    write_events(derived.event_log(spark, sf_dir), path, "json")
    return read_events(spark, path, "json").select(
        "run_id", "timestamp", "event_type", "file", "error", "size"
    )


@query(f"""
{_OUTCOME}
SELECT filename, url, checksum, checksum AS read_checksum FROM entries""")
def bodies_by_location(spark, sf_dir):
    """Bodies chosen where they lie, stored over twelve runs (by file name) of which one is written
    twice, with a body that has no URL; the current ones read back where they lie."""
    from docflow.functions.content import content_checksum
    from docflow.schemas import BODIES
    from docflow.sources.documents import document_contents, latest_documents, select_stored_at, write_documents

    path = new_folder(spark, "located")
    no_url = spark.createDataFrame([(None, bytearray(b"%PDF-1.4\n\n%%EOF"))], "url string, content binary")
    derived.bodies(spark, sf_dir).unionByName(no_url).write.parquet(f"{path}/bodies")
    outcomes = saved(_outcomes(spark, sf_dir), "outcomes")
    chosen = saved(select_stored_at(spark, f"{path}/bodies", outcomes, BODIES), "chosen-bodies")
    runs = F.pmod(F.xxhash64("filename"), F.lit(12))
    for run in [*range(12), 7]:
        write_documents(chosen.filter(runs == run), f"{path}/store", f"run-{run:02d}")
    current = document_contents(spark, f"{path}/store", latest_documents(spark, f"{path}/store"))
    return current.select("filename", "url", "checksum", content_checksum(F.col("content")).alias("read_checksum"))


@query(f"""
{_OUTCOME}
SELECT filename, url, checksum FROM entries""")
def stored_roundtrip(spark, sf_dir):
    """Bodies of a run written to the document store; its current files read back."""
    from docflow.sources.documents import latest_documents, select_stored, write_documents

    path = new_folder(spark, "store")
    outcomes = saved(_outcomes(spark, sf_dir), "outcomes")
    write_documents(select_stored(derived.bodies(spark, sf_dir), outcomes), path, "run-1")
    return latest_documents(spark, path).drop("run_id")


def _waves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Observations of two days: all documents, then those that changed and those that did not."""
    res = derived.resources(spark, sf_dir)
    text = F.col("text")

    def observed(body, day: str) -> DataFrame:
        framed = F.concat(F.lit("%PDF-1.4\n"), body, F.lit("\n%%EOF")).cast("binary")
        return res.select(
            "url",
            F.octet_length(framed).cast("string").alias("content_length"),
            "last_modified",
            F.lit(None).cast("string").alias("error"),
            framed.alias("content"),
            F.lit(f"2025-01-{day} 00:00:00").cast("timestamp").alias("observed_at"),
        )

    second = F.when(derived.every(3), F.concat(text, F.lit(" changed"))).otherwise(text)
    return observed(text, "01"), observed(second, "02")


@query(f"""
WITH {_RES}
SELECT filename, url,
  CASE WHEN doc_id % 3 = 0 THEN content_length + 8 ELSE content_length END AS size,
  last_modified,
  CASE WHEN doc_id % 3 = 0 THEN TIMESTAMP '2025-01-02 00:00:00'
    ELSE TIMESTAMP '2025-01-01 00:00:00' END AS downloaded_at
FROM res""")
def incremental_stream(spark, sf_dir):
    """Two days of observations through the stream: only what changed is stored again."""
    from docflow.sources.manifests import ManifestStore
    from docflow.schemas import OBSERVATIONS
    from docflow.streaming.incremental import incremental_stream as start

    folder = new_folder(spark, "stream")
    for wave in _waves(spark, sf_dir):
        wave.write.mode("append").parquet(f"{folder}/observations")
        stream = spark.readStream.schema(OBSERVATIONS).parquet(f"{folder}/observations")
        start(stream, f"{folder}/manifest", f"{folder}/checkpoint").awaitTermination()
    return ManifestStore(spark, f"{folder}/manifest").read().select(
        "filename", "url", "size", "last_modified", "downloaded_at"
    )


@query(f"""
WITH {_RES}
SELECT filename, url,
  CASE WHEN doc_id % 3 = 0 THEN content_length + 8 ELSE content_length END AS size,
  last_modified,
  CASE WHEN doc_id % 3 = 0 THEN TIMESTAMP '2025-01-02 00:00:00'
    ELSE TIMESTAMP '2025-01-01 00:00:00' END AS downloaded_at
FROM res""")
def document_states_stream(spark, sf_dir):
    """Per-document state machines over three waves: two days, then the first day's observations again,
    late now, which change nothing. The manifest is that of the batch runs."""
    from docflow.schemas import MANIFEST, OBSERVATIONS
    from docflow.streaming.states import document_states, manifest_after

    folder = new_folder(spark, "states")
    first, second = _waves(spark, sf_dir)
    initial = spark.createDataFrame([], MANIFEST)
    for wave in (first, second, first):
        wave.write.mode("append").parquet(f"{folder}/observations")
        stream = spark.readStream.schema(OBSERVATIONS).parquet(f"{folder}/observations")
        rows = document_states(stream, initial, f"{folder}/documents")
        (rows.writeStream.format("parquet").option("path", f"{folder}/rows")
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    manifest = manifest_after(initial, spark.read.parquet(f"{folder}/rows"))
    return manifest.select("filename", "url", "size", "last_modified", "downloaded_at")


@query(f"WITH {_RES} SELECT url, last_modified FROM res")
def dedup_stream(spark, sf_dir):
    """The same observations three times over: each is counted once."""
    from docflow.streaming.incremental import distinct_observations

    folder = new_folder(spark, "dedup")
    first, _ = _waves(spark, sf_dir)
    for _ in range(3):
        first.drop("content").write.mode("append").parquet(f"{folder}/in")
    schema = first.drop("content").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    (
        distinct_observations(stream)
        .select("url", "last_modified")
        .writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema("url string, last_modified string").parquet(f"{folder}/out")


@query(f"""
WITH RECURSIVE {_WALK}
SELECT url, regexp_extract(url, '[^/]*$') AS filename FROM found ORDER BY url""")
def discovery_run(spark, sf_dir):
    """Discovery without fetching: the sorted list of documents."""
    return collection.run_discovery(derived.site_pages(spark, sf_dir), ROOT, at=run_at())[0]


@query(f"""
WITH RECURSIVE {_WALK}, {_RES.replace("hosts AS (", "every_host AS (")},
hosts AS (SELECT * FROM every_host WHERE url IN (SELECT url FROM found)),
{_MANIFEST}, {_HEADS}, {_DECIDED}
SELECT CASE snap_reason WHEN 'head_error' THEN 'error' WHEN 'unchanged' THEN 'skip'
    ELSE 'fetch' END AS decision, snap_reason AS reason, count(*) AS documents
FROM decided GROUP BY 1, 2""")
def plan_by_reason(spark, sf_dir):
    """From pages to plan: documents the crawl finds, by decision and reason."""
    found = crawl.discover(derived.site_pages(spark, sf_dir), ROOT)
    decided = change.change_decision(
        change.candidates(found.documents),
        derived.manifest_prev(spark, sf_dir),
        derived.stored(spark, sf_dir),
        change.head_observations(derived.heads(spark, sf_dir)),
    )
    return decided.groupBy("decision", "reason").agg(F.count(F.lit(1)).alias("documents"))
