import math

import numpy as np
import pytest

from docflow.llm import queries, whitening

DATA = "/root/testdata/sf0.001"


def brute(rows, k=whitening.COMPONENTS):
    """rows: (vec_id, vector). Per valid row and component: (id, component, n, deviation, whitened, explained)."""
    good = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    lengths = {}
    for _, v in good:
        lengths[len(v)] = lengths.get(len(v), 0) + 1
    if not lengths:
        return [], 0.0
    d = max(lengths, key=lambda x: (lengths[x], x))
    good = [(i, v) for i, v in good if len(v) == d]
    x = [[math.floor(64 * float(e)) + 1_000_000 for e in v] for _, v in good]
    n, s = len(x), [sum(col) for col in zip(*x)]
    c = np.array(x, dtype=float) - np.array(s) / n
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    order = np.argsort(e)[::-1]
    e, v = e[order], v[:, order]
    k = min(k, int(np.sum(e > whitening.FLOOR * np.trace(cov))))
    w = c @ v[:, :k] / np.sqrt(e[:k])
    out = []
    for r, (i, _) in enumerate(good):
        deviation = sum((n * a - b) ** 2 for a, b in zip(x[r], s))
        out += [(i, j + 1, n, deviation, w[r, j], e[j] / np.trace(cov)) for j in range(k)]
    return out, w


def compare(got, want):
    assert len(got) == len(want)
    got = sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4])))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4])))
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert abs(abs(a[4]) - abs(b[4])) < 1e-6
        assert abs(a[5] - b[5]) <= 1e-4 * b[5]


def test_query_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = queries.op11_whitening(spark, DATA).collect()
    want, w = brute(rows)
    compare([tuple(r)[:6] for r in got], want)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4
    # one sign for all rows of a component
    signs = {}
    by = {(r.vec_id, r.component): r.whitened for r in got}
    for (i, c), value in by.items():
        signs.setdefault(c, set())
    assert got[0].n == len(rows)


def test_hard_cases(spark):
    rng = np.random.default_rng(5)
    base = [list(map(float, rng.normal(size=4))) for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(100, None), (101, []), (102, [1.0, None, 0.0, 2.0]), (103, [float("nan"), 0.0, 0.0, 0.0]),
             (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [0.5, 0.5]), (None, base[0]), (3, base[3]), (3, base[3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.selectExpr("vec_id", "embedding", "1 AS x", "'k' AS key", "2.0 AS c", "7L AS index", "0 AS part")
    got, _ = whitening.whiten(df)
    want, _ = brute(rows)
    compare([tuple(r)[:6] for r in got.collect()], want)
    assert {r.component for r in got.collect()} == {1, 2, 3, 4}


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty)[0].count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "vec_id long, embedding array<float>")
    assert whitening.whiten(one)[0].count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(same)[0].count() == 0
