import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from docflow.llm import queries, search

DATA = "/root/testdata/sf0.001"
TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """docs: (doc_id, text); items: (item_id, text). Every document scored for every item."""
    bags = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    bags = [b for b in bags if b[2]]
    big_n, big_l = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in sorted(set(items), key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        asked = set(words(text))
        scored = []
        for row, (d, c, n) in enumerate(bags):
            m = 100 - 90 + (90 * n * big_n) // big_l
            score = 0
            for t in asked & c.keys():
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is not None, d or 0, row, d))
        scored.sort()
        out += [(item, rank + 1, s[4], -s[0]) for rank, s in enumerate(scored[:k])]
    return out


def norm(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, 0 if v is None else v) for v in r])


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op13_search(spark, DATA).collect())
    assert got == sorted(brute(docs, items)) and got


def test_oracle_sql_agrees():
    sql = queries.SQL["op13_search"]
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert sorted(con.execute(sql).fetchall()) == sorted(brute(docs, items))


def test_hard_cases(spark, hard, empty):
    long_text = "alpha beta " * 20_000 + "gamma"
    docs = hard.unionByName(spark.createDataFrame(
        [(40, long_text), (41, "Alpha ALPHA gamma"), (41, "Alpha ALPHA gamma"), (42, "gamma"), (43, "gamma"),
         (44, "digits 123 and_under_score ünïcode"), (None, "alpha gamma")], "doc_id long, text string"),
        allowMissingColumns=True)
    items = spark.createDataFrame(
        [(1, "alpha gamma"), (1, "alpha gamma"), (2, None), (3, "nothing here matches zzz"), (4, "GAMMA"),
         (5, "ünïcode under score"), (None, "same text twice")], "item_id long, text string"
    ).selectExpr("*", "9 AS doc_id", "'x' AS key", "0L AS row")
    got, rounds = search.search(docs, items, k=3)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k=3)
    assert norm(got.collect()) == norm(want)
    assert search.search(empty, items)[0].count() == 0
    assert search.search(docs, items.filter("item_id < 0"))[0].count() == 0


def test_deep_lists_and_ties(spark, monkeypatch):
    """Many equal scores: the threshold must fall strictly below the k-th before a query stops.

    The first round reads k positions here, so that several rounds are needed."""
    monkeypatch.setattr(search, "FIRST_DEPTH", 1)
    rows = [(i, "common " * (1 + i % 3) + ("rare" if i % 50 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "common"), (2, "rare common"), (3, "rare")], "item_id long, text string")
    got, rounds = search.search(docs, items, k=10)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, [(1, "common"), (2, "rare common"), (3, "rare")]))
    assert len(rounds) >= 2


def test_few_rounds_and_no_shuffle_of_small_sides(spark, monkeypatch):
    """Each round goes several times as deep; what has a row for a query or asked term is broadcast."""
    monkeypatch.setattr(search, "FIRST_DEPTH", 1)
    rows = [(i, "common " * (1 + i % 3) + ("rare" if i % 50 == 0 else "")) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = [(1, "common"), (2, "rare common")]
    plans = []
    monkeypatch.setattr(search, "saved", lambda df, label, f=search.saved: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()) if label == "search-verdict" else None,
        f(df, label))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got, rounds = search.search(docs, spark.createDataFrame(asked, "item_id long, text string"))
        assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, asked))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depths = [r["depth"] for r in rounds]
    assert depths[:2] == [10, 10 * search.GROWTH] and len(depths) <= 5
    assert plans and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)
