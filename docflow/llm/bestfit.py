"""Packing documents into as few sequences as it can: best-fit decreasing, certified by bounds.

Documents are tokenized once (`packing.tokenized`); a document longer than `CAPACITY` ids is cut into
pieces of `CAPACITY`, the last one shorter. Only the pieces' lengths take part in the packing: items
(piece key, length) are dealt over groups of about `GROUP_ITEMS` by a hash of their key, and each group
is packed by best-fit decreasing in one pandas task. Each group also computes a lower bound for its
own bin count from dual-feasible functions (below); a group whose bins meet its bound is certified.
Groups with a gap give up the items of their emptiest bins (twice the gap); those items from all
such groups are dealt into new groups by another hash, so documents of different groups meet, and
packed again. That repeats for at most `ROUNDS` rounds; a round that doesn't use fewer bins for the
items it took is discarded. Assignments then find their pieces by a join on the piece key; the ids
themselves never take part in the packing.

Lower bounds (sizes s of one group, capacity C, each value exact in integers), the largest of:
* ceil(sum s / C);
* Fekete and Schepers' u^(k), k = 1..`K_MAX`: s/C if (k+1)s/C is whole, else floor((k+1)s/C)/k;
* f_t for every t = 1..C/2: 1 for s > C - t, s/C for t <= s <= C - t, 0 for s < t.

Cases: a null or empty text is one piece of its end id; a null key stays null; repeated rows are
packed each for itself (the key of a piece is its row's place in the first pass); ties in length are
ordered by that key, so a retried task packs alike; an empty table gives no pieces; other columns
are left out; very long documents give many whole pieces, which are items like any other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.packing import tokenized
from docflow.reliable import saved

CAPACITY = 4096
GROUP_ITEMS = 200_000   # items that one task packs, about
ROUNDS = 3              # of packing; the first packs all items, later ones those of gapped groups
K_MAX = 20              # of the u^(k) family
KEY = ["part", "before", "piece"]
ASSIGNED = "part int, before long, piece int, length long, grp long, bin long, pos int, offset long, bins long, bound long, fill long"


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """The largest of the bounds above for items of `sizes` (integers 1..capacity)."""
    sizes = np.asarray(sizes, dtype=np.int64)
    if sizes.size == 0:
        return 0
    c = capacity
    best = -(-int(sizes.sum()) // c)
    for k in range(1, K_MAX + 1):
        whole = (k + 1) * sizes % c == 0
        a = int(sizes[whole].sum())
        b = int(((k + 1) * sizes[~whole] // c).sum())
        best = max(best, -(-(a * k + b * c) // (c * k)))
    h = np.bincount(sizes, minlength=c + 1).astype(np.int64)
    count_above = np.cumsum(h[::-1])[::-1]          # count_above[s] = #(size >= s)
    weight = np.concatenate([[0], np.cumsum(h * np.arange(c + 1))])  # weight[s] = sum of sizes < s
    t = np.arange(1, c // 2 + 1)
    big = count_above[c - t + 1]                     # sizes above c - t
    mid = weight[c - t + 1] - weight[t]
    best = max(best, int(np.max(big + -(-mid // c))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and final fill of each item, taken in the given order (longest first).

    An item goes to the open bin with the least room that still holds it, else to a new bin. A bit
    set over remaining room finds that bin; bins of equal room are a stack.
    """
    rooms: dict[int, list[int]] = {}
    mask = 0
    used: list[int] = []
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        above = mask >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            stack = rooms[room]
            b = stack.pop()
            if not stack:
                mask &= ~(1 << room)
                del rooms[room]
        else:
            b, room = len(used), capacity
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        left = room - size
        if left > 0:
            rooms.setdefault(left, []).append(b)
            mask |= 1 << left
    fills = np.asarray(used, np.int64)[bins] if len(lengths) else np.empty(0, np.int64)
    return bins, offsets, fills


def _pack_group(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["length", *KEY], ascending=[False, True, True, True], kind="mergesort")
    lengths = group["length"].to_numpy(np.int64)
    bins, offsets, fills = best_fit_decreasing(lengths)
    count = int(bins.max()) + 1 if len(bins) else 0
    return pd.DataFrame({
        "part": group["part"].to_numpy(), "before": group["before"].to_numpy(), "piece": group["piece"].to_numpy(),
        "length": lengths, "grp": group["grp"].to_numpy(), "bin": bins, "pos": np.arange(len(bins), dtype=np.int32),
        "offset": offsets, "bins": np.full(len(bins), count, np.int64),
        "bound": np.full(len(bins), lower_bound(lengths), np.int64), "fill": fills,
    })


def _packed(items: DataFrame, round_: int, total: int) -> DataFrame:
    groups = max(1, -(-total // GROUP_ITEMS))
    grp = F.pmod(F.xxhash64(*KEY, F.lit(round_)), F.lit(groups))
    dealt = items.select(*KEY, "length", grp.alias("grp"))
    return saved(dealt.groupBy("grp").applyInPandas(_pack_group, ASSIGNED), f"bestfit-round{round_}")


def pieces(tokens: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: key, part, before, piece, start, length, ids (the piece's, packed)."""
    size = (F.octet_length("ids") / 4).cast("long")
    cut = tokens.select(key, "part", "before", "ids", size.alias("n")).select(
        "*", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / capacity).cast("int"))).alias("piece")
    )
    start = F.col("piece").cast("long") * capacity
    return cut.select(
        key, "part", "before", "piece", start.alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("n") - start).alias("length"),
        F.col("ids").substr((start * 4 + 1).cast("int"), F.lit(capacity * 4)).alias("ids"),
    )


def assign(items: DataFrame) -> tuple[DataFrame, dict]:
    """Sequence and offset of each item (part, before, piece, length); and figures of each round."""
    total = items.count()
    spark = items.sparkSession
    if total == 0:
        return spark.createDataFrame([], "part int, before long, piece int, sequence_id long, offset long"), {}
    current, packed = 0, _packed(items.select(*KEY, "length"), 0, total)
    kept, figures = [], {"items": total, "rounds": [],
                         "first_bins": packed.select("grp", "bin").distinct().count()}
    for round_ in range(1, ROUNDS + 1):
        # A gapped group gives up the items of its 2 * gap emptiest bins.
        bins = packed.select("grp", "bin", "fill", "bins", "bound").distinct()
        rank = F.row_number().over(Window.partitionBy("grp").orderBy("fill", "bin"))
        loose = bins.filter(F.col("bins") > F.col("bound")).select(
            "grp", "bin", rank.alias("r"), (2 * (F.col("bins") - F.col("bound"))).alias("give")
        ).filter(F.col("r") <= F.col("give")).select("grp", "bin", F.lit(True).alias("loose"))
        marked = saved(packed.join(loose, ["grp", "bin"], "left"), f"bestfit-marked{round_}")
        taken = marked.filter(F.col("loose").isNotNull())
        released = taken.count()
        if released == 0:
            break
        old_bins = taken.select("grp", "bin").distinct().count()
        again = _packed(taken, round_, released)
        new_bins = again.select("grp", "bin").distinct().count()
        figures["rounds"].append({"items": released, "bins_before": old_bins, "bins_after": new_bins})
        if new_bins >= old_bins:
            break
        kept.append((current, marked.filter(F.col("loose").isNull())))
        current, packed = round_, again
    kept.append((current, packed))
    out = None
    for r, p in kept:
        sequence = F.lit(r).cast("long") * (1 << 56) + F.col("grp") * (1 << 28) + F.col("bin")
        part = p.select(*KEY, sequence.alias("sequence_id"), "offset")
        out = part if out is None else out.unionByName(part)
    return out, figures


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
         digest: Callable[[Column], Column] | None = None) -> tuple[DataFrame, dict]:
    """Pieces of all documents with their `sequence_id` and `offset` there; and the rounds' figures.

    Pieces carry their `ids`, or with `digest` only `digest(ids)`, computed before the pieces meet
    their places: then no ids cross the shuffle of that join.
    """
    tokens = tokenized(df, path, key, text)
    counts = tokens.select("part", "before", F.col("size").alias("n")).select(  # without ids, which aren't read
        "*", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / CAPACITY).cast("int"))).alias("piece"))
    items = counts.select(*KEY, F.least(F.lit(CAPACITY).cast("long"), F.col("n") - F.col("piece") * CAPACITY)
                          .alias("length"))
    placed, figures = assign(items)
    cut = pieces(tokens, key)
    if digest is not None:
        cut = cut.withColumn("ids", digest(F.col("ids")))
    return cut.join(placed, KEY).drop("part", "before"), figures
