"""URL filters: host and path rules, and a character language-model ratio for the rest.

Two variable-order Markov models are counted, one over the URLs that rules allow and one over those
that they block. A character's probability backs off from its longest context to shorter ones, each
weighted by how often and with how many different successors it was seen (Witten-Bell). A URL that no
rule fits is blocked if its log-likelihood difference per character lies below a threshold, which is
calibrated on URLs that the counted ones leave out.

The models' size is bounded by the alphabet and the order (2.56 million character runs), so they may be
broadcast; their counts cover all URLs that a rule fits.

Cases: a null URL or one without `://` has an empty host and path, which no rule fits and which score 0;
if either model saw nothing, all scores are 0 and nothing more is blocked; repeated rows stay and count;
an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from docflow.reliable import saved

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/."  # other characters share a symbol
ORDER = 3                       # longest context
SYMBOLS = len(ALPHABET) + 2     # with "other" and the start mark
START, OTHER = SYMBOLS - 1, SYMBOLS - 2
HELD_OUT = 5                    # one in so many URLs calibrates instead of being counted

#: Host, path, whether it allows. Fixed values.
RULES = [
    ("org", "/", True),
    ("example.org", "/es/", False),
    ("example.org", "/en/1", False),
    ("com", "/fr/", True),
    ("com", "/de/", False),
]


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host, its A-Z lower-cased, and path of a URL; empty if it has no `://`."""
    after = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit("")))


def matched(rules: list[tuple[str, str, bool]], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits, as a struct (rule, allow); null if none does."""
    out = F.lit(None).cast("struct<rule:string,allow:boolean>")
    for name, start, allow in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = (F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))
        value = F.struct(F.lit(name + start).alias("rule"), F.lit(allow).alias("allow"))
        out = F.when(fits & F.startswith(F.col(path), F.lit(start)), value).otherwise(out)
    return out


def with_rules(df: DataFrame, key: str = "page_id", url: str = "url",
               rules: list[tuple[str, str, bool]] = RULES) -> DataFrame:
    """`key`, host, path, rule and allow (null where no rule fits)."""
    host, path = parts(url)
    split = df.select(F.col(key), host.alias("host"), path.alias("path"))
    return split.withColumn("_", matched(rules)).select(key, "host", "path", "_.*")


_CODES = np.full(256, OTHER, "i8")
_CODES[[ord(c) for c in ALPHABET]] = range(len(ALPHABET))


def grams(text: str, order: int = ORDER) -> np.ndarray:
    """For each character, the number of the run that it ends, of `order` + 1 characters."""
    octets = np.frombuffer(text.encode().lower(), "u1")
    # The bytes behind a character's first are left out: a character is one symbol.
    codes = np.concatenate([np.full(order, START, "i8"), _CODES[octets[(octets & 0xC0) != 0x80]]])
    n = len(codes) - order
    run = np.zeros(n, "i8")
    for i in range(order + 1):
        run = run * SYMBOLS + codes[i : i + n]
    return run


def gram_counts(df: DataFrame, order: int = ORDER) -> DataFrame:
    """(allow, gram, n) of a table of (allow, text); each task adds up before the shuffle."""
    schema = "allow boolean, gram long, n long"
    arrow = pa.schema([("allow", pa.bool_()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            allow, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for side in (True, False):
                found = [grams(t, order) for a, t in zip(allow, texts, strict=True) if a is side]
                if found:
                    gram, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([side] * len(gram)), pa.array(gram), pa.array(n)], schema=arrow)

    return df.mapInArrow(run, schema).groupBy("allow", "gram").agg(F.sum("n").alias("n"))


def log_probabilities(counts: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Witten-Bell: log probability of each run's last character behind its context."""
    by_order = [counts.astype("f8")]
    for _ in range(order):  # without the first character
        by_order.append(by_order[-1].reshape(SYMBOLS, -1).sum(0))
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for n in reversed(by_order):
        rows = n.reshape(-1, SYMBOLS)
        total, kinds = rows.sum(1, keepdims=True), (rows > 0).sum(1, keepdims=True)
        behind = np.tile(lower.reshape(-1, SYMBOLS), (len(rows) // (lower.size // SYMBOLS), 1))
        seen = np.maximum(total + kinds, 1)
        rows = np.where(total > 0, (rows + kinds * behind) / seen, behind)
        lower = rows.ravel()
    return np.log(lower)


@dataclass
class Model:
    """Log ratio of each character run (accepted over rejected) and the calibrated threshold."""

    ratios: np.ndarray
    threshold: float
    order: int = ORDER

    def score(self, text: str) -> float:
        run = grams(text, self.order)
        return float(self.ratios[run].mean()) if len(run) else 0.0


def scored(df: DataFrame, ratios: np.ndarray, keep: list[str], order: int = ORDER) -> DataFrame:
    """`keep` and the score of column `text`."""
    shared = df.sparkSession.sparkContext.broadcast(ratios)
    schema = StructType([*(df.schema[k] for k in keep), StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value, 0.0, order)
        for batch in batches:
            scores = [model.score(t) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(scores, pa.float64())], schema=arrow)

    return df.select(*keep, "text").mapInArrow(run, schema)


def _text() -> Column:
    return F.concat("host", "path")


def fit(ruled: DataFrame, order: int = ORDER, held_out: int = HELD_OUT) -> Model:
    """Models of the URLs in a table of `with_rules` that rules allow and block."""
    known = ruled.filter("allow IS NOT NULL").select("allow", _text().alias("text"))
    turn = F.pmod(F.xxhash64("text"), F.lit(held_out))
    ratios = np.zeros(SYMBOLS ** (order + 1))
    # As many rows as there are different runs, which the alphabet bounds.
    rows = gram_counts(known.filter(turn != 0), order).toPandas()
    sides = []
    for side in (True, False):
        mine = rows[rows["allow"] == side]
        counts = np.zeros(SYMBOLS ** (order + 1), "i8")
        counts[mine["gram"].to_numpy("i8")] = mine["n"].to_numpy("i8")
        sides.append(counts)
    if sides[0].any() and sides[1].any():
        ratios = log_probabilities(sides[0], order) - log_probabilities(sides[1], order)
    return Model(ratios, _threshold(scored(known.filter(turn == 0), ratios, ["allow"], order)), order)


def _threshold(known: DataFrame, steps: int = 100) -> float:
    """Score below which blocking loses least: both kinds' error rates are added up.

    The candidates are steps of a fixed width, so the histogram's size doesn't follow the input.
    """
    step = F.least(F.greatest(F.floor(F.col("score") * steps), F.lit(-20 * steps)), F.lit(20 * steps))
    rows = known.groupBy(step.alias("step")).agg(
        F.sum(F.col("allow").cast("long")).alias("good"),
        F.sum((~F.col("allow")).cast("long")).alias("bad"),
    ).orderBy("step").collect()
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        return 0.0
    below_good, below_bad, best = 0, 0, (1.0, 0.0, 0.0)
    for row, after in zip(rows, [*rows[1:], None], strict=True):
        below_good, below_bad = below_good + row["good"], below_bad + row["bad"]
        error = below_good / good + 1 - below_bad / bad
        upper = row["step"] + 1 if after is None else after["step"]
        middle = (row["step"] + 1 + upper) / 2 / steps
        best = min(best, (error, abs(middle), middle))
    return best[2]


def judged(df: DataFrame, key: str = "page_id", url: str = "url",
           rules: list[tuple[str, str, bool]] = RULES) -> DataFrame:
    """`key`, host, path, rule, verdict ("allow" or "block") and score of every URL."""
    ruled = saved(with_rules(df, key, url, rules), "ruled")
    model = fit(ruled)
    keep = [key, "host", "path", "rule", "allow"]
    out = scored(ruled.withColumn("text", _text()), model.ratios, keep, model.order)
    allowed = F.coalesce("allow", F.col("score") >= model.threshold)
    return out.select(
        key, "host", "path", "rule",
        F.when(allowed, "allow").otherwise("block").alias("verdict"), "score",
    )
