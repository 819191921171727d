"""License scans by an exact set-similarity join.

A text's blocks are runs of `BLOCK` words that begin at each of the templates' words; a block meets a template if
it holds at least the threshold's share of the template's different words. Words that are in no
template can't count, so a block is what it has of the templates' words, and a text that hasn't
enough of them as a whole has no blocks. Words are ordered by the number of texts that have them,
rarest first, over all texts; blocks and templates join on the words of their prefixes, length and
position bound what they can still share, and what remains is verified. This finds every run of words.

Beside it, phrases are counted where their words stand one behind the other.

Only DataFrame functions are used; each text is read and cut into words once. Lower-casing goes by
Unicode, which makes no difference to phrases, since no letter outside A-Z becomes one of theirs.

Cases: a null or empty text has no words and scores 0; a null id is kept; repeated rows stay; a phrase
may overlap another; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import row_key, text_of
from docflow.reliable import saved

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8     # share of a template's words
BLOCK = 64          # words of a block
STRIDE = 32         # words a template may have, half a block

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of public licenses, as their publishers word them, and their labels.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this work is licensed under a creative commons attribution international license", "cc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _phrase_places(words: Column, phrase: list[str]) -> Column:
    """Starts, counted from 0, of a phrase in an array of words."""
    def fits(i: Column) -> Column:
        out = F.get(words, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            out = out & (F.get(words, i + k) == word)
        return out

    starts = F.sequence(F.lit(0), F.size(words) - len(phrase))
    return F.when(F.size(words) >= len(phrase), F.filter(starts, fits)).otherwise(F.array().cast("array<int>"))


def _at_place(label: str):
    return lambda i: F.struct(F.lit(label).alias("label"), i.alias("at"))


def prepared(df: DataFrame, keys: list[str], text: str, phrases: dict[str, str],
             sets: list[list[str]], threshold: float) -> DataFrame:
    """k0.., key, n_words, places (label, at), held (template words of the text) and blocks."""
    vocabulary = sorted({w for s in sets for w in s} | {w for p in phrases for w in p.split()})
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], text_of(text).alias("text"))
    rows = rows.select(
        *[f"k{i}" for i in range(len(keys))],
        row_key(*[f"k{i}" for i in range(len(keys))], "text").alias("key"),
        F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"),
    )
    words, held = F.col("words"), F.col("held")
    rows = rows.withColumn("held", F.array_intersect("words", _texts(vocabulary)))
    none = F.array().cast("array<struct<label:string,at:int>>")
    places = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        found = F.transform(_phrase_places(words, parts), _at_place(label))
        maybe = F.array_contains(held, parts[0])
        for part in parts[1:]:
            maybe = maybe & F.array_contains(held, part)
        places.append(F.when(maybe, found).otherwise(none))
    enough = F.lit(False)
    for s in sets:
        enough = enough | (F.size(F.array_intersect(held, _texts(s))) >= overlap(len(s), threshold))
    least = min(overlap(len(s), threshold) for s in sets)
    counted = _texts(sorted({w for s in sets for w in s}))
    starts = F.filter(
        F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(counted, F.get(words, i))
    )
    blocks = F.filter(
        F.transform(starts, lambda s: F.array_intersect(F.slice(words, s + 1, F.lit(BLOCK)), held)),
        lambda b: F.size(b) >= least,
    )
    blocks = F.array_distinct(blocks)
    return rows.select(
        *[f"k{i}" for i in range(len(keys))], "key", F.size("words").cast("long").alias("n_words"),
        F.flatten(F.array(*places)).alias("places"), "held",
        F.when(enough & (F.size("words") > 0), blocks).otherwise(F.array().cast("array<array<string>>")).alias("blocks"),
    )


def overlap(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def word_order(rows: DataFrame) -> list[str]:
    """The template words that texts have, rarest first; there are no more than templates have."""
    counted = rows.select(F.explode("held").alias("word")).groupBy("word").count()
    return [r["word"] for r in counted.orderBy("count", "word").collect()]


def meetings(rows: DataFrame, sets: list[list[str]], threshold: float, order: list[str]) -> DataFrame:
    """(key, template, share): each text's best block for each template that it meets."""
    place = {w: i for i, w in enumerate(order)}
    # Words that no text has come last: they can't be shared.
    numbered = [sorted(place.get(w, len(order) + i) for i, w in enumerate(s)) for s in sets]
    blocks = rows.select("key", F.explode(F.array_distinct("blocks")).alias("block"))
    blocks = blocks.select(
        "key", F.array_sort(F.transform("block", lambda w: F.array_position(_texts(order), w).cast("int") - 1)).alias("block")
    )
    least = min(overlap(len(n), threshold) for n in numbered)
    prefix = F.slice("block", F.lit(1), F.size("block") - least + 1)
    tokens = blocks.select("key", "block", F.posexplode(prefix).alias("at", "token"))
    entries = [
        (n[i], t, i, len(n), need)
        for t, n in enumerate(numbered) for need in [overlap(len(n), threshold)] for i in range(len(n) - need + 1)
    ]
    names = ["token", "template", "template_at", "template_size", "need"]
    literal = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, e, strict=True)]) for e in entries])
    index = rows.sparkSession.range(1).select(F.inline(literal))  # no more rows than templates have words
    size = F.size("block")
    pairs = (
        tokens.join(F.broadcast(index), "token")
        .filter(F.col("at") <= size - F.col("need"))                                # block's prefix
        .filter(F.least(size - F.col("at"), F.col("template_size") - F.col("template_at")) >= F.col("need"))
        .select("key", "block", "template", "template_size", "need").distinct()
    )
    of = F.array(*[F.array(*[F.lit(x) for x in n]) for n in numbered])
    shared = F.size(F.array_intersect("block", F.get(of, F.col("template"))))
    return (
        pairs.withColumn("shared", shared).filter("shared >= need")
        .groupBy("key", "template").agg(F.max(F.col("shared") / F.col("template_size")).alias("share"))
    )


def scan(df: DataFrame, keys: list[str], text: str = "text", phrases: dict[str, str] = PHRASES,
         templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """`keys`, n_words, places (array of label, at), found (array of label, share) and score.

    The score is 1 for a text with a phrase, else the largest share, else 0.
    """
    sets = [list(dict.fromkeys(t.split())) for t, _ in templates]
    if any(len(t.split()) > STRIDE for t, _ in templates):
        raise ValueError(f"templates may have {STRIDE} words")
    rows = saved(prepared(df, keys, text, phrases, sets, threshold), "license-words")
    labels = F.get(_texts([label for _, label in templates]), F.col("template"))
    order = word_order(rows)
    by_key = (
        meetings(rows, sets, threshold, order)
        .groupBy("key").agg(F.collect_set(F.struct(labels.alias("label"), "share")).alias("found"))
    )
    out = rows.drop("held", "blocks").join(saved(by_key, "license-labels"), "key", "left")
    none = F.array().cast("array<struct<label:string,share:double>>")
    found = F.coalesce("found", none)
    best = F.coalesce(F.array_max(F.transform(found, lambda f: f["share"])), F.lit(0.0))
    return out.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "n_words", "places", found.alias("found"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )
