"""Quality classifier: a sparse ensemble of rules (RuleFit: Friedman and Popescu, 2008).

Shallow trees are grown on statistics of labelled texts. Every path from a root is a rule, a
conjunction of bounds on statistics; a logistic regression with an absolute penalty (lasso) weighs
the rules, and most get no weight. What is left is compiled into one Spark column expression.

Language, source, id and labels are never inputs of a score. The fit takes at most `SAMPLE` labelled
rows, chosen by a hash of the id, only from those whose `held_out` is false; all texts are scored whole.

Cases: a null or empty text has statistics of zero and is scored by them; labels that are null or
belong to no text don't count; where the sample has one label only, or no rows, every score is that
label's share, or one half; repeated rows stay; an empty table gives an empty one; other columns are
left out.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.textstats import ratio, with_counts
from docflow.reliable import saved

SAMPLE = 8000       # labelled rows that are fitted on
TREES = 16
DEPTH = 3
PENALTY = 0.002
SEED = 42

FEATURES = ["words_log", "word_length", "symbol_share", "dup_line_share", "repeat_share",
            "distinct_share", "mark_share", "upper_share", "digit_share", "line_length_log"]


def statistics(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """`keys` and FEATURES of each text."""
    counted = with_counts(df, keys, text)
    return counted.select(
        *keys,
        F.log1p("n_words").alias("words_log"),
        ratio("word_chars", "n_words").alias("word_length"),
        ratio("n_symbols", "word_chars").alias("symbol_share"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_share"),
        ratio("n_repeat_words", "n_words").alias("repeat_share"),
        ratio("n_distinct_words", "n_words").alias("distinct_share"),
        ratio("n_marks", "word_chars").alias("mark_share"),
        ratio("n_upper", "word_chars").alias("upper_share"),
        ratio("n_digits", "word_chars").alias("digit_share"),
        F.log1p(ratio("n_words", "n_lines")).alias("line_length_log"),
    )


def held_out(key: str = "doc_id") -> Column:
    """Rows that no fit may see: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


Condition = tuple[str, str, float]  # statistic, "<=" or ">", bound


@dataclass(frozen=True)
class Ensemble:
    """Rules with weights other than zero, and the constant."""

    rules: list[tuple[tuple[Condition, ...], float]]
    constant: float

    def score(self) -> Column:
        """The compiled expression over FEATURES."""
        total = F.lit(self.constant)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for name, sign, bound in rule:
        out = out & (F.col(name) <= bound if sign == "<=" else F.col(name) > bound)
    return out


_SPLIT = re.compile(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(described: str, names: list[str]) -> list[tuple[Condition, ...]]:
    """The rules of a tree's description: a line for each branch, indented by its depth."""
    out: list[tuple[Condition, ...]] = []
    above: list[tuple[int, Condition]] = []
    for line in described.splitlines():
        found = _SPLIT.match(line)
        if not found:
            continue
        depth = len(found[1])
        above = [a for a in above if a[0] < depth]
        above.append((depth, (names[int(found[2])], found[3], float(found[4]))))
        out.append(tightest([c for _, c in above]))
    return out


def tightest(conditions: list[Condition]) -> tuple[Condition, ...]:
    """A conjunction with one bound for each statistic and side."""
    bounds: dict[tuple[str, str], float] = {}
    for name, sign, bound in conditions:
        known = bounds.get((name, sign), bound)
        bounds[name, sign] = min(known, bound) if sign == "<=" else max(known, bound)
    return tuple(sorted((n, s, b) for (n, s), b in bounds.items()))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = saved(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size), "quality-sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # SAMPLE rows at most
    rows = statistics(texts, ["doc_id", "label"])
    # One sorted partition of a bounded sample: the fit is the same each time.
    return saved(rows.repartition(1).sortWithinPartitions("doc_id", *FEATURES), "quality-statistics")


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Ensemble:
    """Rules for `quality` of `labels` (doc_id, quality)."""
    rows = sample(docs, labels, size)
    n, good = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or good in (0, n):
        share = min(max((good or 0) / n, 1e-3), 1 - 1e-3) if n else 0.5
        return Ensemble([], math.log(share / (1 - share)))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                    featureSubsetStrategy="onethird", maxBins=64).fit(data)
    rules = sorted({r for tree in forest.trees for r in paths(tree.toDebugString, FEATURES)})
    if not rules:
        return Ensemble([], math.log(good / (n - good)))
    named = {f"rule{i}": holds(r).cast("double") for i, r in enumerate(rules)}
    fired = VectorAssembler(inputCols=list(named), outputCol="fired").transform(
        rows.select("label", *[c.alias(k) for k, c in named.items()])
    ).select("label", "fired")
    lasso = LogisticRegression(labelCol="label", featuresCol="fired", elasticNetParam=1.0, regParam=PENALTY,
                               standardization=False, maxIter=60).fit(fired)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if abs(w) > 1e-6]
    return Ensemble(weights, float(lasso.intercept))


def judged(df: DataFrame, ensemble: Ensemble, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, held_out, score (0 to 1, higher: better) and predicted (1 from one half on)."""
    scored = statistics(df, [key], text).withColumn("score", ensemble.score())
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
