"""Statistics of a text that rules and classifiers use."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docflow.llm.common import map_rows

SPACES = " \t\n\v\f\r"   # what separates words
SYMBOLS = "#*$%&|<>"
WINDOW = 3               # words of which a repetition counts

_UPPER, _DIGIT = re.compile(r"[A-Z]"), re.compile(r"[0-9]")

#: Counts of a text, in this order.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_distinct_words", "n_marks", "n_upper", "n_digits"]


def counts(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # on bytes: ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        often, covered = Counter(windows), bytearray(n)
        for i, window in enumerate(windows):
            if often[window] > 1:
                covered[i : i + WINDOW] = b"\1" * WINDOW
        repeated = sum(covered)
    return (
        n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines),
        len(set(words)), text.count("!") + text.count("?"), len(_UPPER.findall(text)),
        len(_DIGIT.findall(text)),
    )


def with_counts(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """`keys` and the counts of each row's text; null counts as empty."""

    def make():
        return lambda row: (*row[:-1], *counts(row[-1] or ""))

    schema = StructType([*(df.schema[k] for k in keys), *(StructField(c, LongType()) for c in COUNTS)])
    return map_rows(df.select(*keys, F.col(text)), make, schema)


def ratio(part: str, whole: str):
    """A share, zero for an empty whole."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
