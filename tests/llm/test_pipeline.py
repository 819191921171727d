from itertools import combinations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from docflow.llm import queries, rules, stages, toxicity
from docflow.reliable import saved
from test_secrets import base_spans, more_spans
from test_similar import jaccard, shingles

DATA = "/root/testdata/sf0.001"


def ids(rows):
    return sorted(r.doc_id for r in rows)


def jaccard_groups(rows, threshold=0.8):
    """The smallest id of each row's group, linked by exact Jaccard of five-word shingles."""
    sets = [(r.doc_id, shingles(r.text)) for r in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        if jaccard(sets[i][1], sets[j][1]) >= threshold:
            parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, (d, _) in enumerate(sets)}


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], DATA), f"test-{name}"))
    return out


def test_stages_against_brute_force(spark, results):
    docs, ruled, clean, single, safe, packed = (r.collect() for r in results)
    for rows in results[1:5]:
        assert rows.columns == results[0].columns
    kept = {r.doc_id for r in rules.apply(results[0], ["doc_id"], ["lang", "source"]).filter("kept").collect()}
    assert ids(ruled) == sorted(kept) and len(kept) < len(docs)
    chain = toxicity.fit(results[1], spark.read.parquet(f"{DATA}/labels.parquet"))
    assert ids(clean) == ids(toxicity.judged(results[1], chain, ["doc_id"]).filter("NOT toxic").collect())
    assert ids(single) == sorted(set(jaccard_groups(clean).values()))
    left = [shingles(r.text) for r in single]
    assert not any(jaccard(a, b) >= 0.85 for a, b in combinations(left, 2))
    before = {r.doc_id: r.text for r in single}
    assert ids(safe) == sorted(before)
    for r in safe:
        spans = sorted(tuple(map(int, s.split(":")[1:])) for s in {*base_spans(before[r.doc_id]), *more_spans(before[r.doc_id])})
        text, at = "", 0
        for start, stop in spans:
            if start >= at:
                text += before[r.doc_id][at:start] + "[SECRET]"
            at = max(at, stop)
        assert r.text == text + before[r.doc_id][at:] and r.n_chars == len(r.text)
    assert {p.doc_id for p in packed} == set(before)


def test_run_is_all_stages(spark, results):
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == results[-1].columns
    assert ids(got.collect()) == ids(results[-1].collect())


def test_hard_cases(spark, hard, empty):
    long_text = " ".join(f"word{i}" for i in range(80))
    more = [(20, long_text), (21, long_text), (21, long_text), (None, long_text.upper()), (22, long_text + " token = abcdefgh1")]
    rows = hard.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    docs = rows.withColumn("n_chars", F.length("text"))
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, DATA)
        if name != "packing":
            assert result.columns == docs.columns
        assert stage(spark, empty, DATA).count() == 0
    single = stages.near_duplicates(spark, docs.filter("text = '%s' OR doc_id IN (7, 8)" % long_text), DATA)
    assert ids(single.collect()) == [7, 20]
    assert queries.QUERIES.keys() >= {"op1_bpe", "op10_rules"}
