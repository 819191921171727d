import math
import re

import pytest

from docflow.llm import licenses, queries

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def brute(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    found = {}
    for start in range(len(words)):
        block = set(words[start : start + licenses.BLOCK])
        for t, label in templates:
            s = set(t.split())
            share = len(block & s) / len(s)
            if len(block & s) >= math.ceil(threshold * len(s) - 1e-9):
                found[label] = max(found.get(label, 0), share)
    base = {x for _, x in places}
    score = 1.0 if places else max(found.values(), default=0.0)
    return (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
            ",".join(sorted(base)), ",".join(sorted(base | set(found))), score)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_query(spark):
    rows = queries.op4_licenses(spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        assert tuple(r)[1:] == brute(texts[r.doc_id])


NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
TEXTS = [
    "MIT license mit mit License general public license public license",
    "filler words " * 40 + NOTICE + " more filler" * 50,
    ("of this and a to is any " * 300),
    NOTICE.replace("granted", "gave").replace("charge", "cost"),
    "Permission granted free of charge to any person",
    "This program is free software: you can\nredistribute it and/or modify it under the terms of\nthe GNU General Public License as published",
    "licensed under the apache license version 2.0 you may not use this file except in compliance with the license " * 3,
    "İmit license Kapache license mit\x00license mit-license ÉMIT license",
    None, "", "permission", NOTICE, NOTICE,
]


def test_every_block_is_found(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, key string, held long")
    got = {r.doc_id: r for r in licenses.scan(df, ["doc_id"]).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        want = brute(t)
        r = got[i]
        starts = sorted(p.at for p in r.places)
        assert (r.n_words, len(starts), starts[0] if starts else None, starts[-1] if starts else None) == want[:4]
        assert ",".join(sorted({p.label for p in r.places} | {f.label for f in r.found})) == want[5]
        assert r.score == pytest.approx(want[6])


def test_no_templates_of_more_words_than_blocks_overlap(hard):
    with pytest.raises(ValueError, match="words"):
        licenses.scan(hard, ["doc_id"], templates=[("w " * 40, "long")])


def test_hard_cases(hard, empty):
    assert licenses.scan(hard, ["doc_id"]).count() == hard.count()
    assert licenses.scan(empty, ["doc_id"]).count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op4_licenses(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_notice_is_found_wherever_it_stands(spark):
    """Two foreign words before each of a notice's: 60 words, which fit one block of 64 only."""
    spread = " ".join(f"xx yy {w}" for w in licenses.TEMPLATES[0][0].split())
    df = spark.createDataFrame([(i, "zz " * i + spread + " zz" * 40) for i in range(32)], "doc_id long, text string")
    got = {r.doc_id: [f.label for f in r.found] for r in licenses.scan(df, ["doc_id"]).collect()}
    assert got == {i: ["mit"] for i in range(32)}
