import itertools
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from docflow.llm import bestfit, queries

DATA = "/root/testdata/sf0.001"
C = bestfit.CAPACITY


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.WORDS)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def optimum(sizes, capacity):
    """Fewest bins by trying every assignment; tiny inputs only."""
    best = len(sizes)
    for k in range(1, len(sizes) + 1):
        for labels in itertools.product(range(k), repeat=len(sizes)):
            loads = [0] * k
            for s, b in zip(sizes, labels):
                loads[b] += s
            if max(loads) <= capacity:
                return k
    return best


def test_lower_bound_never_exceeds_the_optimum():
    rng = np.random.default_rng(3)
    for _ in range(150):
        capacity = int(rng.integers(5, 13))
        sizes = rng.integers(1, capacity + 1, size=int(rng.integers(1, 7)))
        assert bestfit.lower_bound(sizes, capacity) <= optimum(list(sizes), capacity)
    # f_t sees that items above half need a bin each
    assert bestfit.lower_bound(np.array([2049] * 3 + [2047] * 3), C) == 3
    assert bestfit.lower_bound(np.array([1366] * 3 + [1365]), C) == 2
    assert bestfit.lower_bound(np.array([1500] * 6), C) == 3
    assert bestfit.lower_bound(np.array([], np.int64)) == 0


def test_best_fit_decreasing_is_best_fit():
    bins, offsets, fills = bestfit.best_fit_decreasing(np.array([3000, 2000, 1500, 1000, 1000, 90]))
    assert bins.tolist() == [0, 1, 1, 0, 2, 0]
    assert offsets.tolist() == [0, 0, 2000, 3000, 0, 4000]
    assert fills.tolist() == [4090, 3500, 3500, 4090, 1000, 4090]


def check(rows, texts, tokenizer):
    """Every id in exactly one piece, pieces of at most C in gapless sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for key, texts_of in texts.items():
        pieces = sorted(by_doc[key], key=lambda r: (r.start, r.piece))
        total = sum(len(ids_of(tokenizer, t)) for t in texts_of)
        assert sum(p.length for p in pieces) == total
        for p in pieces:
            assert p.start == p.piece * C and 0 < p.length <= C
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at <= C
    return len(by_sequence)


def test_query(spark, tokenizer):
    rows = queries.op12_bestfit(spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    texts = defaultdict(list)
    for d in docs:
        texts[d.doc_id].append(d.text)
    total = 0
    for r in rows:
        ids = ids_of(tokenizer, texts[r.doc_id][0])[r.start: r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        assert r.length == len(ids)
        total += r.length
    assert total == sum(len(ids_of(tokenizer, d.text)) for d in docs)
    sequences = check(rows, texts, tokenizer)
    assert sequences <= -(-total // C) + 1


def test_hard_cases(spark, hard, empty, tokenizer):
    long_doc = "longword " * 9000
    rows = hard.unionByName(spark.createDataFrame([(30, long_doc), (30, long_doc)], "doc_id long, text string"),
                            allowMissingColumns=True)
    pieces, figures = bestfit.pack(rows, queries.WORDS)
    got = pieces.select("doc_id", "piece", "start", "length", "sequence_id", "offset", "ids").collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for d in {r.doc_id for r in rows.collect()}:
        texts = [r.text for r in rows.collect() if r.doc_id == d]
        want = sum(len(ids_of(tokenizer, t)) for t in texts)
        assert sum(p.length for p in by[d]) == want
    # the very long document: whole pieces, one shorter last piece, for each of its two rows
    n = len(ids_of(tokenizer, long_doc))
    assert sorted(p.length for p in by[30]) == sorted([C] * (n // C) * 2 + [n % C] * 2)
    sequences = defaultdict(int)
    for r in got:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= C
    assert bestfit.pack(empty, queries.WORDS)[0].count() == 0


def test_rounds_join_loose_bins(spark, monkeypatch):
    """Many small groups each leave a loose bin; exchanging their items saves bins."""
    monkeypatch.setattr(bestfit, "GROUP_ITEMS", 7)
    rng = np.random.default_rng(11)
    sizes = [int(s) for s in rng.integers(300, 2500, size=300)]
    items = spark.createDataFrame([(i % 4, i, 0, s) for i, s in enumerate(sizes)],
                                  "part int, before long, piece int, length long")
    placed, figures = bestfit.assign(items)
    got = placed.join(items, bestfit.KEY).collect()
    loads = defaultdict(int)
    for r in got:
        loads[r.sequence_id] += r.length
    assert len(got) == len(sizes) and max(loads.values()) <= C
    assert figures["rounds"] and figures["rounds"][0]["bins_after"] < figures["rounds"][0]["bins_before"]
    assert len(loads) < figures["first_bins"]
    assert len(loads) >= bestfit.lower_bound(np.array(sizes))
