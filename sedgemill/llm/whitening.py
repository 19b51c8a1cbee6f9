"""Embedding whitening: scatter and projection as products of distributed block matrices."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, functions as F

from sedgemill.operators.shuffles import with_row_index

#: Rows and most columns of a block, and the side of the grid that rows are dealt to.
ROWS, COLUMNS, SIDE = 4096, 512, 64
#: Scaled entries are held within this, so that they and their differences are exact as long and as double.
MOST = 1 << 50
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(vectors: DataFrame, vec_id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """(vec_id, x): entries as ``floor(scale * c) + shift``; vectors that are null, empty or hold null or non-finite entries go."""
    entries = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), entries.alias("entries")).filter(
        F.col("entries").isNotNull() & (F.size("entries") > 0)
        & F.forall("entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    whole = lambda c: F.floor(F.greatest(F.least(c * float(scale), F.lit(float(MOST))), F.lit(-float(MOST)))) + shift
    return rows.select("vec_id", F.transform("entries", whole).alias("x"))


def _sums(fit: DataFrame) -> list[int]:
    per = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    return [int(r["s"]) for r in per.orderBy("at").collect()]


def _centred(rows: DataFrame, whole: list[int], rest: list[int], n: int):
    """x less the mean, one rounding from exact: ``x - whole`` is an integer, and the mean is ``whole + rest / n``."""
    near = F.zip_with("x", F.lit(whole), lambda a, b: a - b)
    return rows.select("row_index", F.zip_with(near, F.lit([r / n for r in rest]), lambda a, b: a.cast("double") - b).alias("c"))


def block_matrix(rows: DataFrame, size: int, width: int) -> BlockMatrix:
    """Rows (row_index, c) as a block matrix. Its rows are dealt to as many partitions as the grid of blocks needs to be spread."""
    parts = min(-(-size // ROWS), SIDE) ** 2
    made = rows.repartition(parts).select(F.col("row_index").alias("index"), array_to_vector("c").alias("vector"))
    made = MLUtils.convertVectorColumnsFromML(made, "vector")
    return IndexedRowMatrix(made, size, width).toBlockMatrix(ROWS, min(width, COLUMNS))


def scatter(matrix: BlockMatrix, size: int) -> np.ndarray:
    """The matrix's transpose times itself. The middle dimension is split, so the blocks are multiplied in many tasks and summed."""
    turned = matrix.transpose()
    splits = max(1, -(-size // (4 * ROWS)))
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; the largest entry of each vector is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs


def _projection(spark: SparkSession, weights: np.ndarray, rows_per_block: int) -> BlockMatrix:
    frame = spark.createDataFrame([(i, Vectors.dense(row)) for i, row in enumerate(weights.tolist())], ["index", "vector"])
    return IndexedRowMatrix(frame, *weights.shape).toBlockMatrix(rows_per_block, weights.shape[1])


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = 16, scale: int = 64, shift: int = 1_000_000,
) -> DataFrame:
    """Whitened coordinates of every vector on the first ``most`` principal components of the distinct vectors.

    Columns: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.
    Entries become the integers x of ``integers``. The components are those of the covariance
    (divisor n) of the n distinct x; every row is projected on them, repeated rows and repeated
    or null ids included. ``deviation`` is the exact sum of ``(n * x - S)^2``, null where it
    does not fit a long; ``identity_error`` is measured on the projected distinct vectors.

    Vectors that are null, empty or hold null or non-finite entries go, and so do those whose
    length is not the most frequent one (of equally frequent ones the longest). Entries are
    held within 2^50 after scaling. A component without variance (eigenvalue of rounding size)
    has a null ``whitened`` and is left out of ``identity_error``; ``explained`` is null where
    there is no variance at all, and ``identity_error`` where no component has any. Other
    columns are not read; an empty table gives no rows.

    Centred rows are put into blocks, the scatter is the product of the transposed block
    matrix with itself, summed from partial products of many tasks, and rows are projected by
    a product with the whitening matrix. The driver holds sums, scatter and whitening matrix
    only, all bounded by the vectors' length.
    """
    spark = vectors.sparkSession
    rows = with_row_index(integers(vectors, vec_id, vector, scale, shift), [])
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], SCHEMA)
    width, size = sizes["d"], sizes["count"]
    if size < rows.count():
        rows = with_row_index(rows.filter(F.size("x") == width).drop("row_index"), [])
    fit = with_row_index(rows.select("x").distinct(), [])
    n, sums = fit.count(), _sums(fit)
    whole, rest = zip(*(divmod(s, n) for s in sums), strict=True)

    fitted = block_matrix(_centred(fit, list(whole), list(rest), n), n, width)
    covariance = scatter(fitted, n) / n
    values, axes = components(covariance, most)
    total = float(np.trace(covariance))
    full = values > max(n, width) * np.finfo(float).eps * max(float(values[0]), 0.0)
    weights = np.where(full, axes / np.sqrt(np.where(full, values, 1.0)), 0.0)
    rotation = _projection(spark, weights, min(width, COLUMNS))
    error = np.abs(scatter(fitted.multiply(rotation), n) / n - np.eye(len(values)))[np.ix_(full, full)]

    # x is still exact here: deviations are sums of squares of integers.
    part = lambda a, b: F.try_subtract(F.try_multiply(F.lit(n), a), b)
    near = F.zip_with(F.zip_with("x", F.lit(list(whole)), lambda a, b: a - b), F.lit(list(rest)), part)
    square = F.aggregate(near, F.lit(0).cast("long"), lambda total, v: F.try_add(total, F.try_multiply(v, v)))
    facts = rows.select("row_index", "vec_id", square.alias("deviation"))
    projected = block_matrix(_centred(rows, list(whole), list(rest), n), size, width).multiply(rotation).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    found = found.select(F.col("index").alias("row_index"), F.posexplode(vector_to_array("vector")).alias("at", "value"))
    share = [float(v) / total if total > 0 else None for v in values]
    table = F.lit([bool(f) for f in full])
    return found.join(facts, "row_index").select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(table[F.col("at")], F.col("value")).alias("whitened"),
        F.array(*[F.lit(s).cast("double") for s in share])[F.col("at")].alias("explained"),
        F.lit(float(error.max()) if error.size else None).cast("double").alias("identity_error"))
