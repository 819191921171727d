"""Near-duplicate vectors by a pivot-permutation index.

Each vector is described by its nearest pivots, in order; the inverted lists of the pivots give,
with their shared counts, the candidates: vectors whose descriptions share at least two pivots.
Lists are kept by pair of pivots, so a list holds exactly those that share both; a candidate pair
is verified in one list only, that of the smallest two pivots that it shares. Verification computes
the cosine in double precision.

Vectors that equal each other are one class and are met once. A list is dealt out in blocks, and
each pair of blocks is a group of its own, so no task gets a long list whole. A group gives out,
for each vector, how many links it found, and the links of a spanning forest: no pairs.

The index is approximate, as any of this kind; every vector is in it. Pivots come from a bounded
sample of the classes. The README has the measured recall.

Cases: a vector that is null, empty, zero, or holds null or non-finite components, one with a null
label or a null id, links with nothing and is its own component; vectors of different lengths
aren't compared; repeated rows count as other vectors; an empty table gives an empty one; other
columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.graph import components
from docflow.reliable import saved

COSINE = 0.93
PIVOTS = 256         # reference points
NEAREST = 6          # pivots that describe a vector
SAMPLE = 4096        # classes from which pivots are drawn
BLOCK = 512          # vectors of a list that meet those of another block in one group
CLOSE = 0.8          # cosine from which a second pivot adds nothing


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def pivots(classes: DataFrame, n: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors, from at most `sample` classes; those that nearly repeat
    an earlier one are passed over."""
    rows = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(sample).select("embedding").collect()
    out: dict[int, list[np.ndarray]] = {}
    for row in rows:
        v = np.array(row[0], "f8")
        v /= np.linalg.norm(v)
        mine = out.setdefault(len(v), [])
        if len(mine) < n and (not mine or np.max(np.stack(mine) @ v) < CLOSE):
            mine.append(v)
    return {k: np.stack(v) for k, v in out.items()}


def described(classes: DataFrame, points: dict[int, np.ndarray], nearest: int = NEAREST) -> DataFrame:
    """(label, dims, class_id, near): the numbers of a vector's nearest pivots, sorted by number.

    The order among them decided which they are; that two share them doesn't depend on it.
    """
    shared = classes.sparkSession.sparkContext.broadcast(points)
    arrow = pa.schema([("label", pa.int64()), ("dims", pa.int32()), ("class_id", pa.int64()),
                       ("near", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, ids = (batch.column(i).to_pylist() for i in (0, 1))
            vectors = batch.column(2).to_pylist()
            rows = []
            for label, class_id, v in zip(labels, ids, vectors, strict=True):
                reference = shared.value.get(len(v))
                near: list[int] = []
                if reference is not None:
                    near = np.argsort(-(reference @ np.array(v, "f8")), kind="stable")[:nearest].tolist()
                rows.append((label, len(v), class_id, sorted(near)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)],
                schema=arrow) if rows else pa.RecordBatch.from_pylist([], schema=arrow)

    return classes.select(F.col("label").cast("long"), "class_id", "embedding").mapInArrow(
        run, "label long, dims int, class_id long, near array<int>"
    )


def _pairs(near: str, count: int):
    """All pairs of a description, as one number each; a single pivot makes a pair with itself."""
    both = [
        F.when(F.size(near) > j, F.get(near, F.lit(i)).cast("long") * (1 << 31) + F.get(near, F.lit(j)))
        for i, j in combinations(range(count), 2)
    ]
    alone = F.when(F.size(near) == 1, F.get(near, F.lit(0)).cast("long") * ((1 << 31) + 1))
    return F.array_compact(F.array(*both, alone))


LISTED = ["label", "dims", "pair", "block_a", "block_b"]


def listed(descriptions: DataFrame, nearest: int = NEAREST, block: int = BLOCK) -> DataFrame:
    """Postings of lists with two members or more: LISTED, class_id, near.

    A list of more than `block` members is dealt out in blocks by a hash; a member goes to a group
    for each block that its own is to meet.
    """
    postings = descriptions.select("label", "dims", "class_id", "near", F.explode(_pairs("near", nearest)).alias("pair"))
    keys = ["label", "dims", "pair"]
    sizes = saved(
        postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(*keys, F.ceil(F.col("n") / block).cast("int").alias("blocks")),
        "list-sizes",
    )
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    return (
        postings.join(sizes, keys).withColumn("own", own).withColumn("met", F.explode(every))
        .select(*keys, F.least("own", "met").alias("block_a"), F.greatest("own", "met").alias("block_b"),
                "own", "class_id", "near")
    )


FOUND = pa.schema([("class_id", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _verify(key: tuple, rows: list[tuple], cosine: float) -> list[tuple]:
    """Links of a group: (class_id, weight of its links, null), and (a, null, b) of a forest."""
    _, _, pair, block_a, block_b = key
    first, second = divmod(pair, 1 << 31)
    own = np.array([r[0] for r in rows])
    ids = [r[1] for r in rows]
    weight = np.array([r[3] for r in rows], "i8")
    near = [r[2] for r in rows]
    # Smaller pivots that two have in common mean that an earlier list verifies them.
    earlier = sorted({p for d in near for p in d if p < second and p != first})
    holds = np.zeros((len(rows), max(1, len(earlier))), "f4")
    number = {p: i for i, p in enumerate(earlier)}
    for i, d in enumerate(near):
        for p in d:
            if p in number:
                holds[i, number[p]] = 1
    vectors = _unit(np.array([r[4] for r in rows], "f8"))
    left = np.flatnonzero(own == block_a)
    right = np.flatnonzero(own == block_b)
    hit = (vectors[left] @ vectors[right].T >= cosine) & (holds[left] @ holds[right].T == 0)
    if block_a == block_b:
        np.fill_diagonal(hit, False)
    out: list[tuple] = []
    for side, mask, others in ((left, hit, right), (right, hit.T, left)):
        n = mask @ weight[others]
        out += [(ids[side[i]], int(n[i]), None) for i in np.flatnonzero(n)]
        if block_a == block_b:
            break
    # Least label of each one's component within the group: passed on along links until it stays.
    label, before = np.arange(len(rows)), None
    while before is None or (label != before).any():
        before = label.copy()
        for side, mask, others in ((left, hit, right), (right, hit.T, left)):
            seen = np.where(mask, label[others], len(rows)).min(1, initial=len(rows))
            label[side] = np.minimum(label[side], seen)
    return out + [(ids[i], None, ids[label[i]]) for i in np.flatnonzero(label != np.arange(len(rows)))]


def verified(groups: DataFrame, classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links within each group: (class_id, links, other), see `_verify`."""
    vectors = classes.select("class_id", "n", "embedding")
    rows = groups.join(vectors, "class_id").select(*LISTED, "own", "class_id", "near", "n", "embedding")
    dealt = rows.repartition(*LISTED).sortWithinPartitions(*LISTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[: len(LISTED)] != key:
                    if len(held) > 1:
                        out += _verify(key, held, cosine)
                    key, held = row[: len(LISTED)], []
                held.append(row[len(LISTED) :])
            yield _found(out)
        if len(held) > 1:
            yield _found(_verify(key, held, cosine))

    return dealt.mapInArrow(run, "class_id long, links long, other long")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in FOUND]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, FOUND, strict=True)], schema=FOUND)


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE, n_pivots: int = PIVOTS, nearest: int = NEAREST,
                    block: int = BLOCK) -> DataFrame:
    """`key`, n_links, component_id and kept of every row of `df`."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    usable = (
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    )
    tagged = saved(rows.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    good, rest = tagged.filter("usable"), tagged.filter("NOT usable")
    classes = saved(
        good.groupBy("label", "embedding").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n")),
        "vector-classes",
    )
    points = pivots(classes, n_pivots)
    lists = listed(saved(described(classes, points, nearest), "descriptions"), nearest, block)
    found = saved(verified(lists, classes, cosine), "vector-links")
    counts = found.filter("links IS NOT NULL").groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = components(found.filter("other IS NOT NULL").select(F.col("class_id").alias("a"), F.col("other").alias("b")))
    by_class = saved(
        classes.join(counts, "class_id", "left").join(joined, F.col("class_id") == F.col("node"), "left")
        .select("label", "embedding",
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "class_id").alias("component_id")),
        "by-class",
    )
    linked = good.join(by_class, ["label", "embedding"]).select("id", "n_links", "component_id")
    alone = rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(key), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
