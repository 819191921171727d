import numpy as np

from docflow.llm import embeddings, queries

DATA = "/root/testdata/sf0.01"


def brute(rows, cosine=0.93):
    """rows: (id, vector, label) → sorted (id, n_links, component, kept)."""
    def usable(r):
        i, v, label = r
        return i is not None and label is not None and v is not None and len(v) and all(
            x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    units = [np.array(r[1], "f8") / np.linalg.norm(np.array(r[1], "f8")) if usable(r) else None for r in rows]
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted((r[0] if r[0] is not None else -1, links[i], least.get(root(i)), r[0] is not None and least.get(root(i)) == r[0])
                  for i, r in enumerate(rows))


def result(df):
    return sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id, r.kept) for r in df.collect())


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert result(queries.op8_embeddings(spark, DATA)) == brute(rows)


def planted(seed, n=60, copies=8):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for _ in range(n):
        base = rng.normal(size=32)
        for _ in range(copies if rng.random() < 0.3 else 1):
            v = base / np.linalg.norm(base) + rng.normal(size=32) * 0.04
            rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
            i += 1
    return rows


def test_recall_and_blocks(spark):
    rows = planted(1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute(rows)
    for block in (3, 500):
        got = result(embeddings.near_duplicates(df, block=block))
        total = sum(w[1] for w in want)
        assert total >= sum(g[1] for g in got) >= 0.9 * total > 0
        assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.9 * len(want)


def test_hard_cases(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 1), (2, one, 1), (2, one, 1), (3, one, None), (4, None, 1), (5, [0.0] * 3, 1), (6, [1.0, None, 0.0], 1),
            (7, [float("nan"), 0.0, 1.0], 1), (8, [float("inf"), 0.0, 0.0], 1), (None, one, 1), (9, [], 1), (10, [2.0, 0.0, 0.0], 1),
            (11, [1.0, 0.0], 1), (12, one, 2), (13, [-0.0, 1.0, 0.0], 2), (14, [0.0, 1.0, 0.0], 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, n long, near string")
    assert result(embeddings.near_duplicates(df)) == brute(rows)
    assert embeddings.near_duplicates(df.filter("vec_id < 0")).count() == 0
