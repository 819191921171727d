import random
from itertools import combinations

import pytest
import xxhash

from docflow.llm import graph, queries, simhash
from docflow.reliable import saved

DATA = "/root/testdata/sf0.001"


def brute_print(text, n=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """prints: list of (id, fingerprint)."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
            parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d if d is not None else -1, f, least.get(root(i))) for i, (d, f) in enumerate(prints))


def test_query(spark):
    rows = queries.op5_simhash(spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = brute_components([(r.doc_id, brute_print(r.text)) for r in docs], 2)
    assert sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows) == want


def signed(x):
    return x - (x >> 63 << 64)


@pytest.mark.parametrize("distance", [0, 2, 4])
@pytest.mark.parametrize("crowd", [1, 3, 1000])
def test_components_of_made_up_fingerprints(spark, distance, crowd):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1, 1 << 63]
    prints = []
    for i in range(150):
        x = rng.choice(base)
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.randrange(64)
        prints.append((i, x))
    df = spark.createDataFrame([(i, signed(x)) for i, x in prints], "doc_id long, fingerprint long")
    links = simhash.links(df.select("fingerprint").distinct(), distance, crowd).collect()
    assert all((r.a % 2**64 ^ r.b % 2**64).bit_count() <= distance for r in links)
    got = simhash.with_components(df, "doc_id", distance, crowd).collect()
    assert sorted((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got) == brute_components(prints, distance)


@pytest.mark.parametrize("crowd", [1, 1000])
def test_balls_are_not_broadcast(spark, crowd):
    """However small Spark takes them to be: an explode's rows are sized as its input's."""
    prints = [signed((i % 3) << 40 | 1 << i) for i in range(64)]
    df = saved(spark.createDataFrame([(x,) for x in sorted(set(prints))], "fingerprint long"), "test-prints")
    plan = simhash.links(df, 2, crowd)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "SortMergeJoin" in plan
    assert "Inner, Build" not in plan  # lists of crowded values, of semi and anti joins, may be


def test_odd_distances_are_refused(spark):
    df = spark.createDataFrame([(1,)], "fingerprint long")
    with pytest.raises(ValueError, match="distance"):
        simhash.links(df, 3)


def test_hard_cases(hard, empty):
    got = simhash.near_duplicates(hard).collect()
    want = brute_components([(r.doc_id, brute_print(r.text)) for r in hard.collect()], 2)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint % 2**64, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (5, 5), (None, 3), (300, 299), (300, 298)]
    edges += [(1000, 1000 + i) for i in range(60)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 0, 200: 200, 201: 200, 300: 298, 299: 298, 298: 298}
    want |= {1000 + i: 1000 for i in range(60)}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
