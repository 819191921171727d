"""Whitening embeddings with distributed block matrices.

Valid vectors are quantised to longs, centred and numbered 0..n-1; `IndexedRowMatrix` lays them out
as a `BlockMatrix` of `ROWS_PER_BLOCK` rows. The scatter matrix is the product of its transpose with
itself, split over the middle dimension so that no task holds more than `SPLIT_BLOCKS` row blocks;
only its d x d result reaches the driver, where `numpy.linalg.eigh` decomposes it. A second block
product with the d x k whitening matrix projects all rows on the executors; one aggregate of the
projected rows (sums and sums of products, combined map-side) gives their covariance, which is held
against the identity.

What reaches the driver is bounded by the dimension d, never by the rows: per-dimension sums, the
d x d scatter, k x k covariance, and the count of rows per input partition for the numbering.

Cases: a row whose vector is null, empty, holds a null or a non-finite entry, or whose length differs
from the most common one (ties: the longer) is dropped. A null `vec_id` is kept as null. Repeated rows
count once each in the fit and each get their rows. Components whose eigenvalue is not above
`FLOOR` times the trace have no whitening and are left out, as are all of them for fewer than two
rows; an empty or wholly invalid table gives no rows. Extra input columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from docflow.reliable import saved

SCALE = 64              # x = floor(SCALE * c) + SHIFT
SHIFT = 1_000_000
COMPONENTS = 32         # components given out, at most
ROWS_PER_BLOCK = 4096   # rows of a block of the distributed matrices
SPLIT_BLOCKS = 8        # row blocks that one task of the scatter product multiplies
FLOOR = 1e-12           # eigenvalues at or below FLOOR * trace aren't whitened


def valid(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite entries, with `x`: their quantised longs."""
    c = F.col(vector)
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) != F.lit(float("inf"))))
    x = F.transform(c, lambda e: (F.floor(F.lit(float(SCALE)) * e.cast("double")) + F.lit(SHIFT)).cast("long"))
    return df.filter(c.isNotNull() & (F.size(c) > 0) & finite).withColumn("x", x)


def _numbered(rows: DataFrame) -> DataFrame:
    """`index` 0..n-1 by input partition and place: counts per partition, then their prefix sums."""
    marked = saved(rows.select("*", F.spark_partition_id().alias("part"),
                               F.monotonically_increasing_id().alias("mono")), "whiten-rows")
    counts = marked.groupBy("part").agg(F.min("mono").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("part", "first", F.coalesce(before, F.lit(0)).alias("base"))
    return marked.join(F.broadcast(bases), "part").select(
        "*", (F.col("base") + F.col("mono") - F.col("first")).alias("index")
    ).drop("part", "mono", "first", "base")


def _blocks(indexed: DataFrame, column: str, n: int, d: int) -> BlockMatrix:
    rows = MLUtils.convertVectorColumnsFromML(
        indexed.select("index", array_to_vector(column).alias("vector")), "vector"
    )
    return IndexedRowMatrix(rows, n, d).toBlockMatrix(ROWS_PER_BLOCK, d)


def _release(matrix: BlockMatrix) -> None:
    """Unpersists the blocks that `BlockMatrix.cache` kept."""
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def _gram(left: BlockMatrix, right: BlockMatrix) -> np.ndarray:
    """left^T right, a small matrix, with the row dimension split over tasks."""
    blocks = -(-left.numRows() // ROWS_PER_BLOCK)
    splits = max(1, -(-blocks // SPLIT_BLOCKS))
    product = left.transpose()._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.colsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def _identity_error(rows: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance (divisor n, centred) of `w` minus the identity.

    One aggregate of the k sums and k(k+1)/2 sums of products; partial sums are combined map-side.
    """
    w = F.col("w")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = rows.agg(*[F.sum(w[i]).alias(f"m{i}") for i in range(k)],
                   *[F.sum(w[i] * w[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    mu = np.array([got[f"m{i}"] for i in range(k)]) / n
    cov = np.zeros((k, k))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = got[f"p{i}_{j}"] / n - mu[i] * mu[j]
    return float(np.max(np.abs(cov - np.eye(k))))


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """Whitened values: a row for each valid row and component, and the fit's summary.

    Rows: `key`, `component` (from 1 by falling eigenvalue), `n`, `deviation` (sum over dimensions of
    (n*x - S)^2, exact), `whitened` ((x - S/n) . v / sqrt(e)), `explained` (e / trace), and
    `identity_error` (largest absolute entry of the whitened values' covariance minus the identity).
    """
    spark = df.sparkSession
    ok = valid(df.select(F.col(key).alias("key"), F.col(vector).alias("vec")), "vec")
    lengths = ok.groupBy(F.size("x").alias("d")).count()
    mode = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    schema = StructType([StructField(key, df.schema[key].dataType), StructField("component", IntegerType()),
                         StructField("n", LongType()), StructField("deviation", LongType()),
                         StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
                         StructField("identity_error", DoubleType())])
    if mode is None:
        return spark.createDataFrame([], schema), {"n": 0}
    d = int(mode["d"])
    ok = ok.filter(F.size("x") == d)
    sums = ok.agg(F.count(F.lit(1)).alias("n"),
                  *[F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(d)]).first()
    n = int(sums["n"])
    s = [int(sums[f"s{i}"]) for i in range(d)]
    if n < 2:
        return spark.createDataFrame([], schema), {"n": n}
    mean = F.array(*[F.lit(v / n) for v in s])
    exact_s = F.array(*[F.lit(v).cast("decimal(30,0)") for v in s])
    exact_n = F.lit(n).cast("decimal(20,0)")
    dev = F.aggregate(
        F.zip_with("x", exact_s, lambda x, t: ((exact_n * x - t) * (exact_n * x - t)).cast("decimal(38,0)")),
        F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b).cast("decimal(38,0)"),
    )
    centred = ok.select("key", dev.cast("long").alias("deviation"),
                        F.zip_with("x", mean, lambda x, m: x.cast("double") - m).alias("c"))
    indexed = _numbered(centred)
    a = _blocks(indexed, "c", n, d)
    a.cache()
    covariance = _gram(a, a) / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order]
    trace = float(np.trace(covariance))
    k = int(min(components, np.sum(values > FLOOR * trace)))
    if k == 0:
        _release(a)
        return spark.createDataFrame([], schema), {"n": n, "d": d, "trace": trace}
    w = vectors[:, :k] / np.sqrt(values[:k])
    projection = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, w.flatten(order="F").tolist()))]),
                             d, k)
    y = a.multiply(projection)
    projected = callMLlibFunc("getIndexedRows", y.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    y_rows = MLUtils.convertVectorColumnsToML(projected, "vector").select(
        "index", vector_to_array("vector").alias("w"))
    y_rows = saved(y_rows, "whiten-projected")
    _release(a)
    identity_error = _identity_error(y_rows, n, k)
    explained = F.array(*[F.lit(float(v / trace)) for v in values[:k]])
    joined = indexed.select("index", "key", "deviation").join(y_rows, "index")
    out = joined.select("key", "deviation", F.posexplode("w").alias("p", "whitened")).select(
        F.col("key").alias(key), (F.col("p") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
        "deviation", "whitened", F.element_at(explained, (F.col("p") + 1).cast("int")).alias("explained"),
        F.lit(identity_error).alias("identity_error"),
    )
    summary = {"n": n, "d": d, "trace": trace, "values": values.tolist(), "vectors": vectors,
               "identity_error": identity_error}
    return out, summary
