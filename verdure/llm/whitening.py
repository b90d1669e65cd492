"""Whitening of vectors by their principal components, on distributed block matrices.

Rows are indexed and cut into blocks of ``BLOCK_ROWS`` centred rows. The scatter matrix is the product of the transposed
fit blocks with themselves; its middle dimension is split (``BLOCKS_PER_SPLIT`` blocks each), so no task multiplies more
than that and only sums of the size of one vector squared meet. The eigenvectors of that small matrix are found locally
and a second block product, of all centred rows with the whitening matrix, projects them.

The fit is over different vectors, each once; all rows are projected. Vectors become whole numbers first, so sums and
squared deviations are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.llm.vectors import usable
from verdure.operators.ranking import global_rank
from verdure.session import materialize

COMPONENTS = 4
BLOCK_ROWS = 1024
BLOCKS_PER_SPLIT = 16
#: Eigenvalues below this share of the largest are rounding: the vectors do not vary in that direction.
LEAST_SHARE = 1e-12

_COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(vector: Column, factor: int = 256) -> Column:
    """``floor(factor * c)`` of every component ``c``, taken as double."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(factor)) * c.cast("double")).cast("long"))


def _blocks(rows: DataFrame, total: int, width: int, mean: np.ndarray) -> BlockMatrix:
    """The centred ``x`` of ``rows`` (idx, x) as blocks; an index without a row is a row of zeros."""
    centre = F.array(*[F.lit(float(m)) for m in mean])
    centred = F.zip_with(F.col("x").cast("array<double>"), centre, lambda a, b: a - b)
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("idx"), array_to_vector(centred).alias("v")), "v")
    return IndexedRowMatrix(vectors, total, width).toBlockMatrix(BLOCK_ROWS, width)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left`` times ``right``, with the middle dimension in ``splits`` parts."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _rows(matrix: BlockMatrix) -> DataFrame:
    """(idx, values) of a block matrix."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model).toDF("idx", "v")
    return MLUtils.convertVectorColumnsToML(rows, "v").select("idx", vector_to_array("v").alias("values"))


def components_of(scatter: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Falling eigenvalues of the covariance, unit eigenvectors as columns, and the trace.

    The sign makes an eigenvector's largest entry positive; directions without variance are left out.
    """
    covariance = scatter / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:most]
    order = order[values[order] > max(0.0, LEAST_SHARE * values.max(initial=0.0))]
    vectors = vectors[:, order]
    lead = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.where(vectors[lead, np.arange(len(order))] < 0, -1.0, 1.0), float(np.trace(covariance))


def _deviation(n: int, sums: list[int]) -> Column:
    """Sum over dimensions of ``(n * x - S) ** 2`` in whole numbers; null where it does not fit a long."""
    difference = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in sums]), lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(n).cast("long")), s))
    return F.aggregate(F.transform(difference, lambda d: F.try_multiply(d, d)), F.lit(0).cast("long"), lambda acc, d: F.try_add(acc, d))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every usable row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty or hold null or non-finite entries give no rows. Vectors of another length are fitted
    among themselves. Fewer components than asked for come out where a vector is shorter or the different vectors vary in
    fewer directions, none where all are equal. Rows that repeat, or have no id, are projected each; other columns are
    not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable()).select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "whiten-rows")
    out = spark.createDataFrame([], _COLUMNS)
    for width in sorted(r[0] for r in rows.select(F.size("x")).distinct().collect()):
        out = out.unionByName(_whiten_equal(rows.where(F.size("x") == width), width, components))
    return out


def _whiten_equal(rows: DataFrame, width: int, components: int) -> DataFrame:
    """The result for vectors of one length."""
    spark = rows.sparkSession
    numbered = global_rank(rows, ["row"], "rank").select("vec_id", "x", (F.col("rank") - 1).alias("idx"))
    numbered = materialize(numbered, "whiten-numbered")
    # a vector that many rows share is one row of the fit, at the index of its first row
    fitted = materialize(numbered.groupBy("x").agg(F.min("idx").alias("idx")), "whiten-fit")
    figures = fitted.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]).first()
    total, n, sums = numbered.count(), figures["n"], [int(figures[f"s{i}"]) for i in range(width)]
    mean = np.asarray([s / n for s in sums])
    fit_blocks = _blocks(fitted, total, width, mean)
    scatter = _product(fit_blocks.transpose(), fit_blocks, -(-total // (BLOCK_ROWS * BLOCKS_PER_SPLIT))).toLocalMatrix().toArray()
    values, directions, trace = components_of(scatter, n, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], _COLUMNS)
    whitening = directions / np.sqrt(values)
    small = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(width, k, whitening.ravel("F")))], 1), width, k)
    projected = materialize(_rows(_product(_blocks(numbered, total, width, mean), small)), "whiten-projected")
    error = _identity_error(projected.join(fitted.select("idx"), "idx"), k)
    explained = F.element_at(F.array(*[F.lit(float(v / trace)) for v in values]), F.col("pos") + 1)
    each = numbered.select("idx", "vec_id", _deviation(n, sums).alias("deviation")).join(projected, "idx")
    each = each.select("vec_id", "deviation", F.posexplode("values").alias("pos", "whitened"))
    return each.select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error")
    )


def _identity_error(projected: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of the projected fit rows minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = projected.agg(*[F.covar_pop(F.col("values")[i], F.col("values")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return float(max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs))
