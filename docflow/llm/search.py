"""Ranked lexical search: the best k documents for each query by the Best Position Algorithm.

The index holds, for each term that some query has, an impact list: the term's postings ordered by
impact (falling), then doc id and row. Positions in a list come from range partitions of that order
plus a shift per partition border, so one frequent term is spread over many tasks.

The Best Position Algorithm reads the lists of each query in rounds of depth D (`FIRST_DEPTH` times k,
then `GROWTH` times as deep):
sorted access takes positions 1..D of each of its lists; direct access then looks up every document
seen in all of the query's lists, which gives its whole score and its positions there. For each list
the best position is the end of the run of seen positions that starts at 1, which direct access may
carry beyond D; the threshold is the sum of the impacts at the best positions (0 for a list seen to
its end). A query is done when its k-th score is strictly above the threshold, or the threshold is
0: no unseen document can then enter its top k or tie with it. Queries that are done leave; the
others go a round deeper. Lists are never cut: a query that needs a list to its end reads it there.

Scores (all integer but w): N documents with a term, L their terms, n a document's terms, df and tf;
w = floor(1000 ln((2N+2)/(2df+1))), m = 10 + (90 n N) div L, impact = w ((10^9 tf) div (1000 tf + 8 m)).

Cases: a null text has no terms; a document without terms counts in neither N nor L and is never
found; repeated rows are documents each; a null doc id is kept; equal scores go by doc id, then row;
rows of the queries' table that are equal in id and text are one query, a null text has no results;
query terms that no document has read empty lists; empty tables give no rows; other columns are left
out. Texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.reliable import saved

# Fixed values of the contract: the term pattern, and lower-casing of A-Z only.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

K = 10                      # documents given for each query
FIRST_DEPTH = 16            # times k: positions of each list that the first round reads
GROWTH = 4                  # times as deep is the next round; each one shuffles the lists anew
BROADCAST_ROWS = 250_000    # rows of a side that is broadcast (each a few longs); beyond, it is joined by shuffle


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def index(docs: DataFrame, wanted: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int, int]:
    """Impact lists of the terms in `wanted` (a column `term`); and N, L of the whole table.

    Rows: term, position (from 1), row, key, impact, len (the list's length).
    """
    spark = docs.sparkSession
    q = wanted.select("term").distinct().withColumn("asked", F.lit(True))
    asked = q.count()
    words = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), terms(F.col(text)).alias("t"))
    occurrences = words.select("key", "row", F.size("t").cast("long").alias("n"), F.posexplode("t").alias("pos", "term"))
    marked = occurrences.join(_small(q, asked), "term", "left").filter(F.col("asked").isNotNull() | (F.col("pos") == 0))
    counted = saved(
        marked.groupBy("row", "key", "n", F.when(F.col("asked"), F.col("term")).alias("term"))
        .agg(F.count(F.lit(1)).alias("tf"), F.max((F.col("pos") == 0).cast("int")).alias("first")),
        "search-counts",
    )
    totals = counted.filter("first = 1").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    big_n, big_l = int(totals["N"]), int(totals["L"] or 0)
    postings = counted.filter(F.col("term").isNotNull()).select("row", "key", "n", "term", "tf")
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("len"))
    w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * big_n + 2) / (F.lit(2.0) * F.col("len") + 1))).cast("long")
    weights = df.select("term", "len", w.alias("w"))
    m = F.lit(10) + F.expr(f"(90 * n * {big_n}L) div {max(big_l, 1)}L")
    impact = F.col("w") * F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")
    scored = postings.join(_small(weights, asked), "term").withColumn("m", m).select(
        "term", "row", "key", "len", impact.alias("impact")
    )
    order = [F.col("term"), F.col("impact").desc(), F.col("key").asc_nulls_first(), F.col("row")]
    ranged = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = saved(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mono")),
                 "search-lists")
    pieces = laid.groupBy("part", "term").agg(F.min("mono").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("term").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = pieces.select("part", "term", "first", F.coalesce(before, F.lit(0)).alias("base"))
    # One row for each term and partition that it reaches: terms asked for, plus one per border.
    lists = laid.join(_small(shifts, asked + laid.rdd.getNumPartitions()), ["part", "term"]).select(
        "term", (F.col("base") + F.col("mono") - F.col("first") + 1).alias("position"), "row", "key", "impact", "len"
    )
    return saved(lists, "search-index"), big_n, big_l


def queries_of(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(qid, item, term) for each distinct query row and each of its terms, once."""
    distinct = items.select(F.col(key).alias("item"), F.col(text).alias("q")).distinct()
    return distinct.select(
        F.xxhash64("item", "q").alias("qid"), "item", F.explode(F.array_distinct(terms(F.col("q")))).alias("term")
    ).distinct()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def search(docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", item_key: str = "item_id",
           text: str = "text") -> tuple[DataFrame, list[dict]]:
    """Each query's k best documents with a score above 0: item, rank (from 1), key, score; and the rounds.

    Rounds are incremental: round r reads positions (D/GROWTH, D] by sorted access and looks up only the
    documents that it sees first. The best position of a list is found in the window (D, 2D], which
    the next round's sorted access holds: the run of positions there whose documents the query has seen
    carries it on, at most to 2D (beyond that the next round reads anyway).

    What has a row for each query or asked term at most is joined by broadcast up to `BROADCAST_ROWS`.
    """
    spark = docs.sparkSession
    asked = saved(queries_of(items, item_key, text), "search-queries")
    lists, big_n, big_l = index(docs, asked, key, text)
    lengths = lists.select("term", "len").distinct()
    # Terms that no document has are empty lists: seen to their end from the start.
    n_asked = asked.count()
    asked = saved(asked.join(_small(lengths, n_asked), "term", "left").fillna(0, ["len"]), "search-asked")
    open_ = asked.select("qid").distinct()
    results, rounds, scored, seen_rows = [], [], [], 0
    low, depth = 0, FIRST_DEPTH * k
    while open_.count() > 0:
        queries = asked.join(_small(open_, n_asked), "qid")
        pairs = _small(queries.select("qid", "term"), n_asked)
        seen_all = _union([p.select("qid", "row") for p in scored]) if scored else None
        # Sorted access: positions (low, depth] of each list of each open query; documents seen first now.
        window = lists.filter((F.col("position") > low) & (F.col("position") <= depth)).join(pairs, "term")
        new = window.select("qid", "row").distinct()
        if seen_all is not None:
            new = new.join(_small(seen_all, seen_rows), ["qid", "row"], "left_anti")
        new = saved(new, "search-new")
        n_new = new.count()
        # Direct access: every posting of a newly seen document in the lists of its queries. A document
        # that several queries see first meets its postings once; each posting then goes to those of
        # them whose query has its term.
        by_row = new.groupBy("row").agg(F.collect_set("qid").alias("qids"))
        by_term = queries.groupBy("term").agg(F.collect_set("qid").alias("tq"))
        found = lists.join(_small(by_row, n_new), "row").join(_small(by_term, n_asked), "term").select(
            F.explode(F.array_intersect("qids", "tq")).alias("qid"), "term", "row", "key", "impact")
        scored.append(saved(found.groupBy("qid", "row", "key").agg(F.sum("impact").alias("score")), "search-scores"))
        seen_rows += n_new
        seen_all = _union([p.select("qid", "row") for p in scored])
        # Best position: 1..min(depth, len) are seen; seen positions from depth + 1 on carry it further.
        covered = F.least(F.lit(depth).cast("long"), F.col("len"))
        ahead = lists.filter((F.col("position") > depth) & (F.col("position") <= 2 * depth)).join(pairs, "term") \
            .join(_small(seen_all, seen_rows), ["qid", "row"], "left_semi")
        run = F.col("position") - F.row_number().over(Window.partitionBy("qid", "term").orderBy("position"))
        carried = ahead.select("qid", "term", (run == depth).alias("on")).groupBy("qid", "term").agg(
            F.sum(F.col("on").cast("long")).alias("more"))
        best = queries.join(_small(carried, n_asked), ["qid", "term"], "left").select(
            "qid", "term", "len", (covered + F.coalesce("more", F.lit(0))).alias("best"))
        best = best.filter(F.col("best") < F.col("len"))
        at = lists.select("term", F.col("position").alias("best"), "impact").join(_small(best, n_asked), ["term", "best"])
        reached = at.groupBy("qid").agg(F.sum("impact").alias("threshold"))
        threshold = open_.join(_small(reached, n_asked), "qid", "left").fillna(0, ["threshold"])
        order = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("key").asc_nulls_first(), "row")
        mine = _union(scored).join(_small(open_, n_asked), "qid", "left_semi")
        ranked = mine.filter("score > 0").select("*", F.row_number().over(order).alias("rank")).filter(f"rank <= {k}")
        kth = ranked.groupBy("qid").agg(F.count(F.lit(1)).alias("have"), F.min("score").alias("kth"))
        verdict = saved(threshold.join(_small(kth, n_asked), "qid", "left").select(
            "qid", ((F.col("threshold") == 0) | ((F.col("have") == k) & (F.col("kth") > F.col("threshold")))).alias("done")
        ), "search-verdict")
        done = _small(verdict.filter("done").select("qid"), n_asked)
        results.append(saved(ranked.join(done, "qid"), "search-ranked"))
        open_ = verdict.filter("NOT done").select("qid")
        rounds.append({"depth": depth, "new": n_new, "open": open_.count()})
        low, depth = depth, depth * GROWTH
    names = asked.select("qid", "item").distinct()
    if not results:
        return spark.createDataFrame([], f"{item_key} {items.schema[item_key].dataType.simpleString()}, rank int, "
                                         f"{key} {docs.schema[key].dataType.simpleString()}, score long"), rounds
    return _union(results).join(names, "qid").select(
        F.col("item").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score"
    ), rounds
