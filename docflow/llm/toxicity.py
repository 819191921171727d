"""Toxicity by a classifier chain.

Categories are predicted one after the other, each by a linear model that also sees the
probabilities of the categories before it. In training those are out-of-fold predictions, so that a
later model learns from errors as they will be.

A text is described by which terms it has: words and beginnings of words (`stup*`), since words
vary. The terms are those that best tell labelled texts apart. Models and terms are fitted on a
bounded sample of the labelled rows (`SAMPLE` of each label, chosen by a hash of the id) and have a
bounded size (`TERMS`), so they are broadcast; all texts are scored whole.

Cases: a null or empty text has no terms, and its probabilities are those of the models' constants;
labels that are null or belong to no text don't count; where a category isn't met, or is always met,
in the sample, its model is that share; without any labelled texts nothing is toxic; repeated rows
stay; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from docflow.llm.common import map_rows
from docflow.reliable import saved

SAMPLE = 4000         # labelled rows of each label that are fitted on
TERMS = 512           # terms that a model knows
LEAST = 5             # texts of the sample that have a term
PREFIXES = (4, 5, 6)  # lengths of word beginnings
CERTAIN = 5.0         # standard errors from which a term isn't chance, among so many
FOLDS = 3
PENALTY = 1e-3
STEPS = 300
WEAK = 0.02           # share of clean texts that may have a term of `marked`

WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "*" for w in words if len(w) >= n)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by accelerated gradient steps."""
    if y.min(initial=1) == y.max(initial=0) or not len(y):
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        return np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    full = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)  # both kinds count alike
    keep = np.append(np.full(x.shape[1], penalty), 0.0)
    vector = np.ones(full.shape[1])
    for _ in range(20):
        vector = full.T @ (weight * (full @ vector))
        vector /= np.linalg.norm(vector)
    rate = 1 / (0.25 * vector @ (full.T @ (weight * (full @ vector))) + penalty)
    w = ahead = np.zeros(full.shape[1])
    for k in range(steps):
        gradient = full.T @ (weight * (sigmoid(full @ ahead) - y)) + keep * ahead
        w, last = ahead - rate * gradient, w
        ahead = w + k / (k + 3) * (w - last)
    return w


@dataclass
class Chain:
    """`terms` in order of their columns; for each category its name and weights: terms, then the
    categories before it, then the constant."""

    terms: list[str]
    categories: list[str]
    weights: list[np.ndarray]
    threshold: float = 0.5

    def scorer(self) -> Callable[[str], list[float]]:
        number = {t: i for i, t in enumerate(self.terms)}
        words = {t for t in self.terms if not t.endswith("*")}
        starts = {n: {t[:-1] for t in self.terms if t.endswith("*") and len(t) == n + 1} for n in PREFIXES}

        def score(text: str) -> list[float]:
            mine = set(WORD.findall(text.lower()))
            held = [number[t] for t in mine & words]
            for n, known in starts.items():
                if known:
                    held += [number[t + "*"] for t in {w[:n] for w in mine} & known]
            out: list[float] = []
            for w in self.weights:
                k = len(self.terms)
                x = w[held].sum() + (w[k : k + len(out)] @ np.array(out) if out else 0.0) + w[-1]
                out.append(float(sigmoid(x)))
            return out

        return score


def fit_chain(x: np.ndarray, labels: dict[str, np.ndarray], names: list[str], folds: np.ndarray) -> tuple[Chain, np.ndarray]:
    """A chain over `labels` in their order, and the last one's out-of-fold predictions."""
    weights, before = [], np.zeros((len(x), 0))
    for y in labels.values():
        seen = np.hstack([x, before])
        held_out = np.zeros(len(x))
        for fold in range(FOLDS):
            inside = folds != fold
            w = fit_linear(seen[inside], y[inside])
            held_out[~inside] = sigmoid(seen[~inside] @ w[:-1] + w[-1])
        weights.append(fit_linear(seen, y))
        before = np.column_stack([before, held_out])
    return Chain(names, list(labels), weights), before[:, -1] if before.shape[1] else np.zeros(len(x))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Middle of the gap between two predictions at which the F1 score is highest."""
    if y.min(initial=1) == y.max(initial=0):
        return 0.5
    order = np.argsort(p, kind="stable")
    p, y = p[order], y[order]
    above = y.sum() - np.concatenate([[0], np.cumsum(y)[:-1]])
    f1 = 2 * above / (y.sum() + np.arange(len(y), 0, -1))
    new = np.concatenate([[True], p[1:] > p[:-1]])  # equal predictions go together
    best = int(np.argmax(np.where(new, f1, -1)))
    return float((p[best] + p[best - 1]) / 2) if best else float(p[0] / 2)


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(id, label, terms) of at most `size` labelled texts of each label."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    hashed = F.xxhash64("id")
    chosen = None
    for label in (0, 1):
        mine = known.filter(F.col("label") == label).orderBy(hashed, "id").limit(size)
        chosen = mine if chosen is None else chosen.unionByName(mine)
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    # Two times SAMPLE rows at most.
    rows = texts.join(F.broadcast(saved(chosen, "toxic-sample")), "id").select("id", "label", "text")
    schema = StructType([StructField("id", LongType()), StructField("label", LongType()),
                         StructField("terms", ArrayType(StringType()))])
    rows = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), "text")
    return saved(
        map_rows(rows, lambda: lambda r: (r[0], r[1], sorted(terms(r[2] or ""))), schema, lambda r: 16 * len(r[2]) + 64),
        "toxic-terms",
    )


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, most: int = TERMS) -> Chain:
    """A chain for `toxic` of `labels` (doc_id, toxic).

    Two categories come before it, derived from it in the sample: `marked`, a toxic text with a term
    that clean ones hardly have, and `repeated`, one with several such terms.
    """
    rows = sample(docs, labels, size)
    held = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")
    )
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")).first()
    n, bad = totals["n"], totals["bad"] or 0
    if not bad or bad == n:
        return Chain([], ["toxic"], [np.array([-30.0 if not bad else 30.0])])
    gap = F.col("bad") / bad - F.col("good") / (n - bad)
    pooled = (F.col("bad") + F.col("good")) / n
    # How many standard errors the shares are apart that have the term.
    score = F.abs(gap) / F.sqrt(pooled * (1 - pooled) * (1 / bad + 1 / (n - bad)) + 1e-9)
    best = held.filter(F.col("bad") + F.col("good") >= LEAST).filter(score >= CERTAIN).orderBy(F.desc(score), "term").limit(most).collect()
    names = [r["term"] for r in best]
    marks = [r["term"] for r in best if r["bad"] / bad > r["good"] / (n - bad) and r["good"] <= WEAK * (n - bad) and r["good"] * 20 <= r["bad"]]
    chosen = F.array(*[F.lit(t) for t in names]).cast("array<string>")
    data = rows.select("id", "label", F.array_intersect("terms", chosen).alias("terms")).orderBy("id").collect()
    number = {t: i for i, t in enumerate(names)}
    x = np.zeros((len(data), len(names)), "f8")
    for i, row in enumerate(data):
        x[i, [number[t] for t in row["terms"]]] = 1
    y = np.array([r["label"] for r in data], "f8")
    hits = x[:, [number[t] for t in marks]].sum(1)
    folds = np.array([(r["id"] * 2654435761 >> 7) % FOLDS for r in data])
    labelled = {"marked": y * (hits >= 1), "repeated": y * (hits >= 4), "toxic": y}
    chain, held_out = fit_chain(x, labelled, names, folds)
    chain.threshold = best_threshold(held_out, y)
    return chain


def probabilities(chain: Chain, text: str = "text") -> Column:
    """A struct of each category's probability."""
    shared = SparkSession.active().sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    @F.pandas_udf(StructType([StructField(n, DoubleType()) for n in names]))
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = shared.value.scorer()
        for batch in texts:
            yield pd.DataFrame([score(t or "") for t in batch], columns=names, dtype="f8")

    return scored(F.col(text))


def is_toxic(chain: Chain, scored: Column) -> Column:
    return scored[f"p_{chain.categories[-1]}"] >= chain.threshold


def judged(df: DataFrame, chain: Chain, keys: list[str], text: str = "text") -> DataFrame:
    """`keys`, a probability p_<category> for each category, and `toxic`."""
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], probabilities(chain, text).alias("scored"))
    return rows.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "scored.*",
        is_toxic(chain, F.col("scored")).alias("toxic"),
    )
