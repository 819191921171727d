"""Quality rules whose thresholds follow the data.

Each measure of each language and source is summed up in a mergeable quantile sketch: counts in
buckets of constant relative width (DDSketch: Masson and others, 2019), whose merge is addition, so
results depend on no order. A group's upper fence for a measure lies above its third quartile by a
multiple of its quartile distance. Sketches of small groups are too coarse; those take their
language's merged sketch, and small languages that of all. Documents are joined with their group's
fences and rejected if a measure lies beyond its own.

Cases: a null or empty text has no words; a null language or source is a group like any other;
equal values share a bucket; repeated rows count and stay; an empty table gives an empty one; other
columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.textstats import ratio, with_counts
from docflow.reliable import saved

MIN_WORDS = 50          # base rule, given
REPEAT_PERCENT = 50     # base rule, given
ACCURACY = 0.01         # relative error of a quantile
SMALLEST = 1e-6         # below this a measure counts as zero
SPREAD = 6.0            # quartile distances from the third quartile to the fence
MIN_ROWS = 200          # rows of a group that is judged by its own sketch

#: Measures with the least distance between third quartile and fence: a group that hardly varies
#: doesn't reject what is hardly different.
MEASURES = {"symbol_ratio": 0.02, "dup_line_ratio": 0.35, "repeat_ratio": 0.4, "upper_ratio": 0.2,
            "mark_ratio": 0.05}

_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)


def measured(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """`keys`, counts and measures."""
    return with_counts(df, keys, text).withColumns({
        "symbol_ratio": ratio("n_symbols", "word_chars"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "upper_ratio": ratio("n_upper", "word_chars"),
        "mark_ratio": ratio("n_marks", "word_chars"),
    })


def sketches(rows: DataFrame, groups: list[str], measures: list[str]) -> DataFrame:
    """Sketch rows (`groups`, measure, bucket, n); adding n merges sketches."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])
    long = rows.select(*groups, F.explode(pairs).alias("_")).select(*groups, "_.*").filter("value IS NOT NULL")
    bucket = F.when(F.col("value") > SMALLEST, F.ceil(F.log(F.col("value")) / math.log(_GAMMA)))
    return long.groupBy(*groups, "measure", bucket.cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def quantiles(sketch: DataFrame, groups: list[str], wanted: list[float]) -> DataFrame:
    """`groups`, measure, `rows` and an array `q` of the wanted quantiles."""
    by = Window.partitionBy(*groups, "measure")
    value = F.coalesce(
        F.pow(F.lit(_GAMMA), F.col("bucket")) * (2 / (1 + _GAMMA)), F.lit(0.0)
    )
    run = sketch.withColumns({
        "value": value,
        "upto": F.sum("n").over(by.orderBy(F.col("bucket").asc_nulls_first())),
        "rows": F.sum("n").over(by),
    })
    found = [
        F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("rows") - 1)), F.col("value")))
        for q in wanted
    ]
    return run.groupBy(*groups, "measure").agg(F.max("rows").alias("rows"), F.array(*found).alias("q"))


def fences(rows: DataFrame, groups: list[str], measures: dict[str, float] = MEASURES,
           spread: float = SPREAD, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row for each value of `groups` (outermost first): a map `fence` from measure to bound."""
    own = saved(sketches(rows, groups, list(measures)), "sketches")
    levels = []
    for depth in range(len(groups) + 1):
        merged = own.groupBy(*groups[:depth], "measure", "bucket").agg(F.sum("n").alias("n"))
        q = F.col("q")
        margins = F.create_map(*[x for m, v in measures.items() for x in (F.lit(m), F.lit(v))])
        fence = q[1] + F.greatest(spread * (q[1] - q[0]), margins[F.col("measure")])
        levels.append(
            quantiles(merged, groups[:depth], [0.25, 0.75])
            .groupBy(*groups[:depth])
            .agg(F.max("rows").alias(f"rows{depth}"),
                 F.map_from_entries(F.collect_list(F.struct("measure", fence))).alias(f"fence{depth}"))
        )
    found = levels[-1]
    for depth in range(1, len(groups)):
        upper = levels[depth].withColumnsRenamed({g: f"_{g}" for g in groups[:depth]})
        same = [found[g].eqNullSafe(upper[f"_{g}"]) for g in groups[:depth]]
        found = found.join(upper, _all(same), "left").drop(*[f"_{g}" for g in groups[:depth]])
    whole = levels[0].first()  # one row: a bound for each measure
    every = {} if whole is None else whole["fence0"]
    rest = F.create_map(*[x for m, v in every.items() for x in (F.lit(m), F.lit(v))])
    chosen = F.coalesce(
        *[F.when(F.col(f"rows{d}") >= min_rows, F.col(f"fence{d}")) for d in range(len(groups), 0, -1)],
        rest if every else F.lit(None).cast("map<string,double>"),
    )
    return found.select(*groups, chosen.alias("fence"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def judged(rows: DataFrame, groups: list[str], measures: dict[str, float] = MEASURES,
           spread: float = SPREAD, min_rows: int = MIN_ROWS) -> DataFrame:
    """`rows` (of `measured`, written down) with base_failed, failed (measures beyond their
    fences) and kept."""
    bounds = saved(fences(rows, groups, measures, spread, min_rows), "fences")
    bounds = bounds.withColumnsRenamed({g: f"_{g}" for g in groups})
    joined = rows.join(bounds, _all([F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]), "left")
    beyond = F.array_compact(F.array(*[
        F.when(F.col(m) > F.col("fence")[m], F.lit(m)) for m in measures
    ]))
    return joined.drop(*[f"_{g}" for g in groups]).withColumns({
        "base_failed": base_failed(), "failed": beyond,
    }).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def apply(df: DataFrame, keys: list[str], groups: list[str], text: str = "text") -> DataFrame:
    """Counts, measures, failed rules and verdict of each row of `df`."""
    rows = saved(measured(df, list(dict.fromkeys([*keys, *groups])), text), "measured")
    return judged(rows, groups)
