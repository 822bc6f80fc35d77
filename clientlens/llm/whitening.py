"""Operator 11: embedding whitening by MLlib's BlockMatrix.

Vectors become whole numbers x = floor(scale * c) and the fit list is each
distinct x once. Jobs: (1) the rows with x and a digest of x (SHA-256), written;
(2) the fit list: one row per digest, its x moving once, numbered without gaps
from counts per partition; (3) exact sums S per dimension; (4) rows centred on
the whole number next to the mean, as an ``IndexedRowMatrix``, cut into a
distributed ``BlockMatrix`` A; its transpose times A is the scatter, summed over
splits of the long dimension. The centred entries are small whole numbers, so the
scatter is exact as long as it is below 2^53, and the part of the mean that the
whole number leaves over (at most a half) is taken off in integer arithmetic:
covariance V = (n * scatter - s s') / n^2 with s = S - n * centre, rounded once;
(5) ``eigh`` of V on the driver (dimension x dimension numbers); (6) A times the
whitening matrix (eigenvectors over the roots of the eigenvalues) as another
block product projects the fit list; the rows take their vector's result by
digest.

The driver holds sums, scatter and whitening matrix, which grow with the
dimension only; MLlib's product also looks at the coordinates of the blocks, two
numbers for ``BLOCK_ENTRIES`` entries.

Edge cases: rows whose vector is null, empty or has a null, NaN or infinite entry
are dropped, and so are rows of another length than most (the longer one on a
tie); repeated rows and ids each keep their row; components whose eigenvalue is
zero to rounding are left out (a table of equal vectors has none, and then no
row); an empty table gives no rows; a deviation that exceeds 64 bits is null;
columns of any name pass through ``whiten``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.llm import common

SCALE, COMPONENTS = 256, 4
BLOCK_ENTRIES = 1 << 18          # entries of a block: 2 MB
SPLIT_BLOCKS = 32                # blocks of the long dimension that one task multiplies


class Fit(NamedTuple):
    n: int                       # fit vectors
    variances: np.ndarray        # eigenvalues, falling, above zero
    explained: np.ndarray        # their shares of the trace
    components: np.ndarray       # unit eigenvectors as columns
    mean: np.ndarray
    error: float                 # largest entry of the whitened covariance minus the identity


def _sound(vec: Column) -> Column:
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, bad)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a times b, each block of the result summed over ``splits`` parts."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def _rows_of(m: BlockMatrix) -> DataFrame:
    """(index, y array) of a block matrix."""
    rows = callMLlibFunc("getIndexedRows", m.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("y"))


def _gapless(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table with ``index`` from 0 without gaps."""
    kept = common.written(df.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    # one row per partition
    sizes = {r.p: r.n for r in kept.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    begins, total = {}, 0
    for p in sorted(sizes):
        begins[p] = total
        total += sizes[p]
    table = df.sparkSession.createDataFrame(list(begins.items()), "p bigint, begin bigint")
    return (kept.join(F.broadcast(table), part.cast("long") == F.col("p"))
            .withColumn("index", F.col("begin") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "p", "begin"))


def _whole(vec: Column, scale: int) -> Column:
    return F.transform(vec, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))


def _covariance(n: int, scatter: np.ndarray, s: list[int]) -> np.ndarray:
    """(n * scatter - s s') / n^2 in whole numbers, rounded once."""
    left = np.array(s, object)
    exact = n * np.array([[int(v) for v in row] for row in scatter], object) - np.outer(left, left)
    return (exact / (n * n)).astype(np.float64)


def fit_whiten(docs: DataFrame, vec_col: str, scale: int = SCALE, components: int | None = COMPONENTS,
               block_entries: int = BLOCK_ENTRIES) -> tuple[DataFrame, DataFrame, str, Fit] | None:
    """(rows of ``docs`` that remain with a digest column, (digest, ``deviation``,
    ``whitened``) of the fit list, the digest column's name, the fit), or None if
    no component is left."""
    spark = docs.sparkSession
    common.prepare(spark)
    key, x = common.free_name(docs, "digest", "x")
    sound = docs.filter(_sound(F.col(vec_col)))
    lengths = sound.groupBy(F.size(vec_col).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None
    d = lengths.d
    digest = F.unhex(F.sha2(F.array_join(F.col(x).cast("array<string>"), ","), 256))
    rows = common.written(sound.filter(F.size(vec_col) == d).withColumn(x, _whole(F.col(vec_col), scale)).withColumn(key, digest), "vectors")
    fit = _gapless(rows.select(F.col(key).alias("key"), F.col(x).alias("x")).groupBy("key").agg(F.first("x").alias("x")), "fit")

    # one row per dimension
    sums = {r.pos: r for r in fit.select(F.posexplode("x")).groupBy("pos").agg(
        F.sum("col").alias("s"), F.count("*").alias("n")).collect()}
    n, total = sums[0].n, [sums[i].s for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in total]               # the whole number next to the mean
    left = [s - n * c for s, c in zip(total, centre)]

    near = F.transform(F.zip_with("x", F.array(*[F.lit(c).cast("long") for c in centre]), lambda a, c: a - c), lambda v: v.cast("double"))
    centred = MLUtils.convertVectorColumnsFromML(fit.select("index", array_to_vector(near).alias("vector")), "vector")
    height = max(1, block_entries // d)
    a = IndexedRowMatrix(centred, n, d).toBlockMatrix(height, d)
    splits = max(1, -(-n // (height * SPLIT_BLOCKS)))
    scatter = _times(a.transpose(), a, splits).toLocalMatrix().toArray()          # d x d
    v = _covariance(n, scatter, left)

    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    many = min(components or d, int((e > d * np.finfo(float).eps * max(e[0], 0)).sum()))
    if not many:
        return None
    e, u = e[:many], u[:, :many]
    w = u / np.sqrt(e)
    sent = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, many, w.ravel(order="F").tolist()))], 1), d, many)
    # the projection of what the centres leave of the mean
    rest = (np.array([x / n for x in left]) @ w).tolist()
    y = _rows_of(_times(a, sent, 1)).select("index", F.zip_with("y", F.array(*[F.lit(r) for r in rest]), lambda p, r: p - r).alias("whitened"))
    off = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in total]),
                     lambda p, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), p), s))
    deviation = F.aggregate(off, F.lit(0).cast("long"), lambda acc, t: F.try_add(acc, F.try_multiply(t, t)))
    done = common.written(fit.select("index", "key", deviation.alias("deviation")).join(y, "index").drop("index"), "whitened")

    z = [F.col("whitened")[i] for i in range(many)]
    means = done.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(z)]).first()
    pairs = [(i, j) for i in range(many) for j in range(i, many)]
    cov = done.agg(*[F.avg((z[i] - means[i]) * (z[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))
    mean = np.array([s / n for s in total])
    return rows.drop(x), done, key, Fit(n, e, e / np.trace(v), u, mean, float(error))


def whiten(docs: DataFrame, vec_col: str = "embedding", scale: int = SCALE, components: int | None = None,
           block_entries: int = BLOCK_ENTRIES) -> tuple[DataFrame, str, Fit | None]:
    """The remaining rows of ``docs`` with a struct column (its name is given too)
    of ``deviation`` and ``whitened`` (the vector's coordinates on the components),
    and the fit (None, and no rows, without any component)."""
    (name,) = common.free_name(docs, "whitened")
    found = fit_whiten(docs, vec_col, scale, components, block_entries)
    if found is None:
        return docs.limit(0).withColumn(name, F.lit(None).cast("struct<deviation:bigint,whitened:array<double>>")), name, None
    rows, done, key, fit = found
    known = done.select(F.col("key").alias(key), F.struct("deviation", "whitened").alias(name))
    return rows.join(known, key).drop(key), name, fit
