"""Lookups by a key of which one value may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows of one key from which spreading pays off
HOT_KEYS = 1_000      # size bound of the list of hot keys, which is broadcast
SLICES = 64           # tasks over which one hot key is spread


def heavy_keys(
    df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """The heaviest key values, at most `hot_keys` of them.

    The bound only limits how many keys get spread; a key left out is joined as usual, so
    results do not depend on it. Counting combines before the shuffle.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") >= hot_rows)
        .orderBy(F.desc("_rows"))
        .limit(hot_keys)
        .select(*keys)
    )


def sliced(df: DataFrame, hot: DataFrame, keys: list[str], spread_on: list[str],
           slices: int = SLICES) -> DataFrame:
    """Adds `_slice`: 0, but a hash of `spread_on` for rows with a hot key."""
    tagged = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    return tagged.withColumn(
        "_slice",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_on), F.lit(slices)).cast("int")).otherwise(
            F.lit(0)
        ),
    ).drop("_hot")


def replicated(df: DataFrame, hot: DataFrame, keys: list[str], slices: int = SLICES) -> DataFrame:
    """The matching side: rows of hot keys once per slice, all others once."""
    tagged = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    return tagged.withColumn(
        "_slice", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    ).drop("_hot")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_on: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
    slices: int = SLICES,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Join of `left` with `right`, whose rows are unique by `keys`.

    Rows of `left` that share a hot key are spread over `slices` tasks by a hash of
    `spread_on`; only the few hot rows of `right` are repeated to meet them. Keys are counted
    in `count_in` where a cheaper table than `left` has the same keys.
    """
    hot = heavy_keys(left if count_in is None else count_in, keys, hot_rows, hot_keys)
    spread = sliced(left, hot, keys, spread_on, slices)
    return spread.join(replicated(right, hot, keys, slices), [*keys, "_slice"], how).drop("_slice")


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest `order` per key.

    An aggregate rather than a ranking: each task reduces its rows of a key to one before
    the shuffle, however many copies a key has.
    """
    best = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best).select("_row.*")

