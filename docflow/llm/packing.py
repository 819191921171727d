"""Packing token sequences: concatenate and cut.

The first pass tokenizes each partition and notes its running totals; prefix sums over the
partitions' totals then place every document in one endless row of ids. The second pass cuts that
row at every `length` ids: a document that crosses a border gets one boundary record for each
sequence it reaches into. Only the last sequence can be short.

Cases: a null or empty text is its end mark only; a null id stays null; repeated rows are packed
each for itself; an empty table gives no pieces; other columns are left out.
"""

from __future__ import annotations

import os
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from docflow.llm.common import Memo, kept, prepared
from docflow.reliable import new_folder

LENGTH = 2048
END = 1               # id behind each document
MEMO = 750_000        # words whose ids a worker remembers
LONGEST = 64          # characters of a word that is worth remembering
PORTION = 4 << 20     # bytes of texts whose words are looked up at a time, and at least one text
MARKS = string.punctuation.replace("'", "")  # neither changes a letter before it nor joins it in a token
WORD_END = "</w>"     # how the tokenizer's file writes the end of a word
MOST_BYTES = 64 << 20  # of a tokenizer file, which is broadcast


class WordTokenizer:
    """Ids of a text by a tokenizer that drops white space, so it can be asked word by word.

    `special`: strings of special tokens in a text are those tokens, as the library has it by default,
    and not ordinary text.
    """

    def __init__(self, model: str, special: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = not special
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = [t for t in self.added if not {" ", "\n"}.isdisjoint(t)]
        self.joined = all(not set(MARKS).isdisjoint(t) for t in self.added)  # none in letters and spaces
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.words = Memo(self._ids, MEMO, lambda word: len(word) <= LONGEST)
        self.marks = Memo(self._encode, MEMO // 8, lambda mark: len(mark) <= LONGEST)

    def _encode(self, word: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _has(self, tokens: list[str], text: str) -> bool:
        """Whether the text may hold one of the added tokens."""
        folded = text.lower() if tokens else ""
        return any(t in folded for t in tokens)

    def _ids(self, word: str) -> bytes:
        if word.isalpha() or self._has(self.added, word):
            return self._encode(word)
        head = word.rstrip(MARKS)
        if head.isalpha():  # letters and marks are never one token; no mark of these changes a letter
            return self.words[head] + self.marks[word[len(head) :]]
        return self._encode(word)

    def _learn(self, pieces: set[str]) -> None:
        """Asks for all new words of letters at once: each ends with a token that ends a word."""
        heads = [h for h in {p.rstrip(MARKS) for p in pieces}
                 if h.isalpha() and len(h) <= LONGEST and h not in self.words and h not in self.words.old]
        if len(heads) < 2 or not self.joined:
            return
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(heads)], add_special_tokens=False)[0].ids, "<u4")
        stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(stops) != len(heads):  # a letter that lower-casing takes apart; those are asked one by one
            return
        data, start = ids.tobytes(), 0
        for head, stop in zip(heads, stops.tolist(), strict=True):
            self.words.put(head, data[start:stop])
            start = stop

    def __call__(self, text: str) -> bytes:
        if self._has(self.spaced, text):
            return self._encode(text)
        pieces = text.replace("\n", " ").split(" ")
        known = self.words
        self._learn({p for p in set(pieces) if p not in known})
        return b"".join(map(self.words.__getitem__, pieces))


    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none null) in a row, and for each text how many come before it; one more for all.

        Each different word of the texts is looked up once.
        """
        if self.spaced and any(self._has(self.spaced, t) for t in texts.to_pylist()):
            each = [self(t) for t in texts.to_pylist()]
            sizes = np.fromiter(map(len, each), "i8", len(each)) // 4
            return np.frombuffer(b"".join(each), "<u4"), np.concatenate([[0], np.cumsum(sizes)])
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self._learn(set(words).difference(self.words))
        packed = [*map(self.words.__getitem__, words)]
        sizes = np.fromiter(map(len, packed), "i8", len(packed)) // 4
        table, first = np.frombuffer(b"".join(packed), "<u4"), np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        size = sizes[at]
        ahead = np.concatenate([[0], np.cumsum(size)])
        ids = table[np.repeat(first[at] - ahead[:-1], size) + np.arange(ahead[-1])]
        offsets = pieces.offsets.to_numpy()
        return ids, ahead[offsets - offsets[0]]


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch (key, text) in portions of about PORTION bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PORTION, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _tokenizer(model) -> WordTokenizer:
    """A worker that goes on to another task keeps what it remembers."""
    return kept(("tokenizer", hash(model.value)), lambda: WordTokenizer(model.value, special=True))


def tokenized(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
              end: int | None = END) -> DataFrame:
    """First pass: `key`, packed `ids` with the end mark, the `part`, the ids `before` in it and their `size`.

    Written once to the shared folder: both passes must see the same order.
    """
    with open(path, encoding="utf-8") as file:
        model = file.read()
    if len(model) > MOST_BYTES:
        raise ValueError("the tokenizer file is too large to be broadcast")
    model = df.sparkSession.sparkContext.broadcast(model)
    schema = StructType([df.schema[key], StructField("ids", BinaryType()), StructField("part", IntegerType()),
                         StructField("before", LongType()), StructField("size", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, before = prepared(lambda: _tokenizer(model)), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in _portions(batch):
                ids, at = tokenizer.many(pc.fill_null(rows.column(1), ""))
                if end is not None:
                    ids, at = np.insert(ids, at[1:], end), at + np.arange(len(at))
                data = pa.Array.from_buffers(pa.large_binary(), rows.num_rows,
                                             [None, pa.py_buffer(at * 4), pa.py_buffer(ids)])
                columns = [rows.column(0), data, np.full(rows.num_rows, part), before + at[:-1], np.diff(at)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c).cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )
                before += int(at[-1])

    rows = df.select(key, F.col(text)).mapInArrow(run, schema)
    folder = new_folder(df.sparkSession, "tokenized")
    rows.write.parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)


def pack(rows: DataFrame, key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """Second pass: a row for each piece of a document that lies in one sequence.

    `start` counts the document's ids before the piece, `offset` the sequence's; `ids` holds the
    piece's own, packed.
    """
    # One row for each partition of the first pass, whatever that holds.
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.col("size")).alias("total"))
    ahead = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(ahead, F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(bases), "part").select(
        F.col(key), "ids", F.col("size").alias("doc_tokens"), (F.col("base") + F.col("before")).alias("at")
    )
    first, last = F.expr(f"at DIV {length}"), F.expr(f"(at + doc_tokens - 1) DIV {length}")
    cut = placed.filter("doc_tokens > 0").select(
        "*", F.explode(F.sequence(first, last)).alias("sequence_id")
    )
    begin = F.greatest(F.col("at"), F.col("sequence_id") * length)
    stop = F.least(F.col("at") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * length)
    return cut.select(
        F.col(key),
        (begin - F.col("at")).alias("start"),
        (stop - begin).alias("length"),
        "doc_tokens",
        "sequence_id",
        (begin - F.col("sequence_id") * length).alias("offset"),
        F.col("ids").substr((begin - F.col("at")).cast("int") * 4 + 1, (stop - begin).cast("int") * 4).alias("ids"),
    )
