"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set if more than half of its shingles' hashes have it. Two
fingerprints link if they differ in few bits. A fingerprint is cut into two segments; if two differ
in at most 2r + a bits (a = 0 or 1), then the first segments differ in at most r or the second
ones in at most r - 1 + a. So each fingerprint looks up the small Hamming ball round each of its
segments in a table of that segment, and complete distances verify what is found. This is exact.

Copies share a fingerprint and are met once. Segment values that very many different fingerprints
have aren't paired within themselves: whatever has or finds one is linked, just as exactly, through
the points where Hamming balls round whole fingerprints meet.

Cases: a null or empty text has fingerprint zero and links like any other; a null id takes part
and never is the smallest, and a component of null ids only has a null id; repeated rows stay
repeated; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docflow.llm.common import map_rows
from docflow.llm.graph import components
from docflow.reliable import saved

SEED = 42
BITS = 64
PIECE = 1 << 16    # hashes of a document that are unpacked at a time
CROWD = 64         # different fingerprints of a segment value from which they aren't paired


def fingerprint(text: str, words: int, seed: int = SEED) -> int:
    """Fingerprint of a text's word shingles, unsigned."""
    tokens = text.encode().lower().split()  # on bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8")
    counts = np.zeros(BITS, "i8")
    for start in range(0, len(hashes), PIECE):
        octets = hashes[start : start + PIECE].view("u1").reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, keys: list[str], text: str = "text", words: int = 3,
                 seed: int = SEED) -> DataFrame:
    """`keys` and `fingerprint`, its 64 bits as a signed integer."""

    def make():
        def one(row: tuple) -> tuple:
            value = fingerprint(row[-1] or "", words, seed)
            return (*row[:-1], value - (value >> 63 << 64))

        return one

    schema = StructType([*(df.schema[k] for k in keys), StructField("fingerprint", LongType())])
    return map_rows(df.select(*keys, F.col(text)), make, schema)


def _half(fp: Column, segment: int) -> Column:
    """A segment as an integer of 32 bits, not negative."""
    return F.shiftrightunsigned(fp, 32) if segment == 0 else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _ball(value: Column, radius: int, bits: int = 32) -> Column:
    """All values that differ from one in at most `radius` of its bits, each once."""
    single = [1 << i for i in range(bits)]
    flips = [0, *single] if radius else [0]
    if radius == 2:
        flips += [x | y for x in single for y in single if x < y]
    signed = [x - (x >> 63 << 64) for x in flips]
    return F.transform(F.array(*[F.lit(x).cast("long") for x in signed]), lambda x: value.bitwiseXOR(x))


def _shuffled(exploded: DataFrame) -> DataFrame:
    """Never broadcast: Spark sizes rows of an explode as if each of its input made one."""
    return exploded.hint("merge")


def radii(distance: int) -> list[int]:
    """Radius of each segment's ball; -1: that segment needs no look-up."""
    r, rest = divmod(distance, 2)
    return [r, r - 1 + rest]


def links(prints: DataFrame, distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between fingerprints within `distance` bits: all of them outside crowds, and
    in crowds as many as make every two that are linked reachable from each other.

    `prints` has each `fingerprint` once.
    """
    if distance % 2 or not 0 <= distance <= 4:
        raise ValueError("distance must be 0, 2 or 4")
    fp = F.col("fingerprint")
    out, crowded = [], []
    for segment, radius in enumerate(radii(distance)):
        if radius < 0:
            continue
        entries = prints.select(_half(fp, segment).alias("value"), fp.alias("b"))
        probes = prints.select(F.explode(_ball(_half(fp, segment), radius)).alias("value"), fp.alias("a"))
        sizes = entries.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        loud = saved(sizes.filter(F.col("n") > crowd).select("value"), "crowded-values")
        if not loud.isEmpty():
            entries = entries.join(loud, "value", "left_anti")
            crowded.append(probes.join(loud, "value", "left_semi").select("a"))
        out.append(
            _shuffled(probes).join(entries, "value")
            .filter(F.col("a") != F.col("b"))
            .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
            .select("a", "b")
        )
    if crowded:
        members = crowded[0] if len(crowded) == 1 else crowded[0].unionByName(crowded[1])
        out.append(_meetings(members.distinct(), distance // 2))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _meetings(members: DataFrame, radius: int) -> DataFrame:
    """Fingerprints within 2 `radius` bits, linked through the points where their balls meet.

    Two balls share a point exactly if their centres are that near. So all that share a point link
    with the least of them, and the number of links follows that of fingerprints, not of pairs.
    """
    points = members.select(F.explode(_ball(F.col("a"), radius, BITS)).alias("point"), "a")
    least = saved(
        points.groupBy("point").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("point", "b"),
        "meeting-points",
    )
    return _shuffled(points).join(least, "point").filter("a <> b").select("a", "b")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3,
                    distance: int = 2) -> DataFrame:
    """`key`, `fingerprint` (signed) and `component_id`, the smallest key reachable by links."""
    prints = saved(fingerprints(df, [key], text, words), "fingerprints")
    return with_components(prints, key, distance)


def grouped(prints: DataFrame, distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """`fingerprint` and its `component`, the smallest fingerprint reachable, each once; only of
    fingerprints that have links."""
    different = saved(prints.select("fingerprint").distinct(), "different-fingerprints")
    return components(links(different, distance, crowd)).withColumnRenamed("node", "fingerprint")


def with_components(prints: DataFrame, key: str, distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """Components of a table of `key` and `fingerprint`; one row for each of its rows."""
    classes = saved(prints.groupBy("fingerprint").agg(F.min(key).alias("least")), "classes")
    in_links = classes.join(grouped(classes, distance, crowd), "fingerprint")
    least = in_links.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = saved(
        in_links.join(saved(least, "least-keys"), "component").select("fingerprint", "component_id"), "linked"
    )
    by_print = saved(
        classes.join(linked, "fingerprint", "left").select(
            "fingerprint", F.coalesce("component_id", "least").alias("component_id")
        ),
        "components",
    )
    return prints.join(by_print, "fingerprint").select(key, "fingerprint", "component_id")


def representatives(prints: DataFrame, groups: DataFrame, key: str, row: str) -> DataFrame:
    """`row` of one row of each group: that with the smallest `key`, of those the smallest `row`.

    `prints` has `key`, `row` (told apart by what the fingerprint comes from) and `fingerprint`;
    `groups` has the `component` of fingerprints that are linked with others.
    """
    order = F.struct(F.col(key).isNull(), F.col(key), F.col(row))
    best = saved(prints.groupBy("fingerprint").agg(F.min(order).alias("best")), "best-of-prints")
    joined = best.join(saved(groups, "groups"), "fingerprint", "left")
    one = joined.groupBy(F.coalesce("component", "fingerprint").alias("group")).agg(F.min("best").alias("best"))
    return one.select(F.col(f"best.{row}").alias(row))
