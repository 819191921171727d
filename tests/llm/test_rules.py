import re
from collections import Counter, defaultdict

import pytest

from docflow.llm import queries, rules
from docflow.llm.textstats import counts

DATA = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_query(spark):
    rows = queries.op10_rules(spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest = want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = n < 50 or 100 * rest[-1] > 50 * n
        assert r.base_failed == failed and not (failed and r.kept)
        assert r.kept == (not failed and not r.failed)


def test_verdict_agrees_with_labels(spark):
    kept = {r.doc_id: r.kept for r in queries.op10_rules(spark, "/root/testdata/sf0.01").collect()}
    docs = {r.doc_id: len((r.text or "").split()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if docs[r.doc_id] >= 50]
    good = [kept[r.doc_id] for r in labels if r.quality == 1]
    bad = [kept[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quantiles_are_within_their_error(spark):
    values = [(("a", "b")[i % 3 == 0], float((i * 37) % 1000) / 10) for i in range(3000)] + [("c", 0.0)] * 5
    df = spark.createDataFrame(values, "g string, m double")
    got = rules.quantiles(rules.sketches(df, ["g"], ["m"]), ["g"], [0.25, 0.5, 0.75, 1.0])
    by = defaultdict(list)
    for g, v in values:
        by[g].append(v)
    rows = {r.g: r for r in got.collect()}
    for g, vs in by.items():
        vs.sort()
        assert rows[g].rows == len(vs)
        for q, have in zip([0.25, 0.5, 0.75, 1.0], rows[g].q, strict=True):
            assert have == pytest.approx(vs[int(q * (len(vs) - 1))], rel=0.011)


def test_sketches_merge_to_that_of_all(spark):
    df = spark.createDataFrame([(i % 7, 0.001 * i) for i in range(500)], "g int, m double")
    parts = rules.sketches(df, ["g"], ["m"]).groupBy("measure", "bucket").sum("n").collect()
    whole = rules.sketches(df, [], ["m"]).collect()
    assert sorted(map(tuple, parts), key=str) == sorted(map(tuple, whole), key=str)


def test_fences_follow_their_group(spark):
    rows = [("en", "noisy", 0.2 + 0.1 * (i % 5)) for i in range(300)] + [("en", "calm", 0.0)] * 300
    rows += [("en", "few", 0.0)] * 3 + [(None, None, 0.5)] * 2
    df = spark.createDataFrame(rows, "lang string, source string, m double")
    got = {(r.lang, r.source): r.fence["m"] for r in rules.fences(df, ["lang", "source"], {"m": 0.05}, min_rows=100).collect()}
    assert got["en", "noisy"] == pytest.approx(0.5 + 6 * 0.2, rel=0.03) and got["en", "calm"] == pytest.approx(0.05)
    assert got["en", "calm"] < got["en", "few"] and len(got) == 4  # small groups take their language's


@pytest.mark.parametrize("text", [None, "", " \n\n ", "a b c a b c", "x\nx\n x\n\n\n#$", "é" * 9 + "\x1c!? A9", "w " * 500])
def test_counts(text):
    assert counts(text or "")[:5] == brute(text)


def test_hard_cases(hard, empty):
    got = rules.apply(hard, ["doc_id"], ["lang", "source"])
    assert got.count() == hard.count()
    assert rules.apply(empty, ["doc_id"], ["lang", "source"]).count() == 0
