"""What several operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS = 256           # rows of a batch that are Python objects at a time
FLUSH_BYTES = 4 << 20  # of results held back before a batch is given out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(*columns: str) -> Column:
    """Key of a row for joining back what was found in it.

    It hashes the text with the id, so copies of a text don't share one. Rows that agree in
    both do, or by chance some others; whoever joins on it must get the same for either.
    """
    return F.xxhash64(*columns)


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[tuple], tuple]],
    schema: StructType,
    size: Callable[[tuple], int] = lambda row: 64,
    before: Callable[[list[tuple]], None] | None = None,
) -> DataFrame:
    """Rows of `df` through a function that `make` prepares once per task.

    Arrow batches are read and given out in small portions, so a task's memory is bounded by
    one incoming batch, whatever a partition holds.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepared(make)
        out: list[tuple] = []
        held = 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    result = function(row)
                    out.append(result)
                    held += size(result)
                    if held >= FLUSH_BYTES:
                        yield as_batch(out, arrow)
                        out, held = [], 0
        if out:
            yield as_batch(out, arrow)

    return df.mapInArrow(run, schema)


_kept: dict[Hashable, Any] = {}
_asked: set[Hashable] = set()


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` gives, kept by the worker for its next tasks as long as these ask for it."""
    if key not in _kept:
        _kept[key] = make()
    _asked.add(key)
    return _kept[key]


def prepared(make: Callable[[], Callable[[tuple], tuple]]) -> Callable[[tuple], tuple]:
    """The function of a task. What earlier tasks of the worker kept and this one doesn't ask for is freed:
    a worker goes on from operator to operator, and would hold the memory of all of them."""
    _asked.clear()
    function = make()
    if _kept.keys() - _asked:
        for key in _kept.keys() - _asked:
            del _kept[key]
        gc.collect()
    return function


def as_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


class Memo(dict):
    """Results of a function of recent keys. It holds those of keys that are `worth` it, in two
    generations of at most `most`."""

    def __init__(self, function: Callable[[Any], Any], most: int, worth: Callable[[Any], bool]) -> None:
        super().__init__()
        self.function, self.most, self.worth, self.old = function, most, worth, {}

    def __missing__(self, key: Any) -> Any:
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
            if not self.worth(key):
                return value
        self.put(key, value)
        return value

    def put(self, key: Any, value: Any) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
