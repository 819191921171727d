"""Secret scans by a trigram inverted index.

Each rule's regular expression yields a Boolean query of trigrams. The index has a posting for each
row and each trigram that a query asks for; a row is a candidate of a rule if the intersected
postings answer the rule's query, and only then the expression runs on it. Rules without mandatory
trigrams run on every text.

Only DataFrame functions are used. Texts move once, to meet their candidate rules, by a key that
hashes the id with the text, so that copies don't gather.

Cases: a null or empty text has no spans; a null id is kept; repeated rows stay, each with its spans;
an empty table gives an empty one; other columns are left out. Positions are code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import row_key, text_of
from docflow.llm.trigrams import query
from docflow.reliable import saved


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose `group` has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules.
BASE = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
]
# Published formats of credentials.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
]
RULES = [*BASE, *MORE]

SPAN = "struct<start:int,stop:int,kind:string,place:int>"
NO_SPANS = f"array<{SPAN}>"


def matches(text: str, rule: Rule, place: int) -> Column:
    """Spans of a rule. What stands between matches tells where they are."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(
        F.transform(between, F.length).alias("gap"), F.transform(found, F.length).alias("size"),
        F.transform(measured, F.length).alias("least"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(NO_SPANS).alias("spans"))

    def step(state: Column, row: Column) -> Column:
        begin = state["at"] + row["gap"]
        stop = begin + F.coalesce(row["size"], F.lit(0))
        span = F.struct(begin.alias("start"), stop.alias("stop"), F.lit(rule.kind).alias("kind"), F.lit(place).alias("place"))
        grown = F.when(row["least"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(stop.alias("at"), grown.alias("spans"))

    walked = F.aggregate(steps, start, step)["spans"]
    return F.when(F.size(found) > 0, walked).otherwise(F.array().cast(NO_SPANS))


def index(rows: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, key) of the trigrams that queries ask for, from (key, text)."""
    low = rows.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(held).alias("gram"))


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(key, kinds): whose query the intersected postings of a key answer.

    A bit for each trigram of an alternative; an alternative is answered if all its bits are set.
    """
    terms = [
        (gram, kind, n, 1 << bit, (1 << len(alternative)) - 1)
        for kind, alternatives in queries.items()
        for n, alternative in enumerate(alternatives)
        for bit, gram in enumerate(sorted(alternative))
    ]
    names = ["gram", "kind", "alternative", "bit", "full"]
    literal = F.array(*[F.struct(*[
        (F.lit(v).cast("long") if isinstance(v, int) else F.lit(v)).alias(c) for c, v in zip(names, t, strict=True)
    ]) for t in terms])
    asked = postings.sparkSession.range(1).select(F.inline(literal))  # as many rows as the rules have trigrams
    return (
        postings.join(F.broadcast(asked), "gram")
        .groupBy("key", "kind", "alternative").agg(F.bit_or("bit").alias("bits"), F.max("full").alias("full"))
        .filter("bits = full")
        .groupBy("key").agg(F.collect_set("kind").alias("kinds"))
    )


def scan(df: DataFrame, keys: list[str], text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """`keys` and `spans`: array of (start, stop, kind, place), in order of start, then of rules."""
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], text_of(text).alias("text"))
    rows = rows.withColumn("key", row_key(*[f"k{i}" for i in range(len(keys))], "text"))
    return _scanned(rows, rules).select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "spans"
    )


def _scanned(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """`rows` (with `text` and `key`) and `spans`."""
    queries = {r.kind: q for r in rules if (q := query(r.pattern))}
    grams = sorted({g for q in queries.values() for a in q for g in a})
    if queries:
        asked = saved(candidates(index(rows, grams), queries), "secret-candidates")
        rows = rows.join(asked, "key", "left")
    parts = []
    for place, rule in enumerate(rules):
        found = matches("text", rule, place)
        if rule.kind in queries:
            found = F.when(F.array_contains("kinds", rule.kind), found).otherwise(F.array().cast(NO_SPANS))
        parts.append(found)
    ordered = F.array_sort(F.flatten(F.array(*parts)), _by_start)
    return rows.withColumn("spans", ordered).drop("kinds")


def _by_start(a: Column, b: Column) -> Column:
    key = lambda s: F.struct(s["start"], s["place"], s["stop"])
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


def listed(spans: Column) -> Column:
    """Spans as text, kind:start:stop with commas between."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def redacted(df: DataFrame, keys: list[str], text: str = "text", rules: list[Rule] = RULES,
             mark: str = "[SECRET]") -> DataFrame:
    """All columns of `df`, each run of overlapping spans in `text` replaced by `mark`."""
    others = [c for c in df.columns if c != text]
    rows = df.select(F.struct(*others).alias("row"), F.col(text).isNull().alias("was_null"),
                     text_of(text).alias("text"), row_key(*keys, text).alias("key"))
    found = _scanned(rows, rules)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]  # it overlaps what was replaced
        clear = F.col("text").substr(state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.greatest(state["at"], span["stop"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], clear, F.lit(mark))).alias("out"),
        )

    walked = F.aggregate("spans", start, step)
    rest = F.col("text").substr(walked["at"] + 1, F.length("text"))
    new = F.when(F.size("spans") > 0, F.concat(walked["out"], rest)).when(~F.col("was_null"), F.col("text"))
    return found.select(*[new.alias(c) if c == text else F.col("row")[c].alias(c) for c in df.columns])
