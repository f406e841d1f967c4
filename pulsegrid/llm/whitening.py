"""Whitening of embeddings by distributed block matrices (MLlib's BlockMatrix).

Entries become whole numbers x = floor(scale * c) + shift, whose sums are exact.  Rows are numbered without gaps and
centred (x - S / n, the whole part of S / n first, so that no digits are lost), and become an IndexedRowMatrix and a
BlockMatrix of ROWS rows a block.  Its transpose times itself is the scatter matrix; its middle dimension, the rows, is
cut into as many splits as there are tasks, so that the product is summed by many and only d x d matrices meet.  The
driver takes eigenvectors of the d x d covariance, and the BlockMatrix times the d x k whitening matrix projects all rows.
Everything between is JVM-side: rows enter and leave as DataFrames.

Bounds: the driver and each task hold d x d numbers, d the number of dimensions; it never holds rows.  Rows are numbered by
hash buckets of about BUCKET rows, of which only the counts are summed in one place.

Cases: vectors that are null, empty, or hold null or non-finite entries, or entries whose x would not be under 2**53 in
size, are dropped; vectors of another number of dimensions are whitened among themselves (a handful of numbers is expected);
rows with a null or repeated key, and equal rows, are each kept; other columns are ignored.  Components without
variance (one row, equal rows, fewer rows than dimensions; an eigenvalue up to d * 2**-46 of the largest) cannot be whitened:
their `whitened` is null and they are no part of identity_error, which is 0 without any component.  A deviation that a
long cannot hold is null.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.session import written

ROWS = 1024
BUCKET = 65_536
LARGE = float(1 << 53)


def whole(vector: Column, scale: int, shift: int) -> Column:
    """floor(scale * c) + shift of each entry; null if an entry is null, not finite, or too large to be exact."""
    d = vector.cast("array<double>")
    bad = F.exists(d, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * scale + abs(shift) >= LARGE))
    return F.when(~bad, F.transform(d, lambda c: F.floor(c * scale) + shift))


def numbered(rows: DataFrame, n: int) -> DataFrame:
    """rows plus `index`, 0 to n - 1, by hash buckets: a number within its bucket after the counts of those before."""
    buckets = max(1, -(-n // BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "x"), F.lit(buckets)))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("rows_in"))
    before = counts.select("bucket", (F.sum("rows_in").over(Window.orderBy("bucket")) - F.col("rows_in")).alias("before"))  # n / BUCKET rows
    index = F.row_number().over(Window.partitionBy("bucket").orderBy("key", "x")) - 1
    return rows.withColumn("place", index).join(before, "bucket").withColumn("index", F.col("before") + F.col("place")).drop("bucket", "place", "before")


def _blocks(rows: DataFrame, n: int, dim: int) -> BlockMatrix:
    """n rows (index, centred) as a block matrix; with n given, no pass counts them."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("centred").alias("vector")), "vector")
    matrix = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, dim))
    return matrix.toBlockMatrix(ROWS, dim)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """left times right, the middle dimension cut into so many splits."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def _rows(matrix: BlockMatrix, name: str) -> DataFrame:
    """A block matrix as (index, array of doubles)."""
    found = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias(name))


def _deviation(t: str, rest: list[int], n: int, most: int) -> Column:
    """sum((n * t - rest)**2) exactly, from sum(t * t) and sum(t * rest) of each row; null beyond a long."""
    safe = most * most * max(1, len(rest)) < 1 << 62 and most * n * max(1, len(rest)) < 1 << 62
    kind = "bigint" if safe else "decimal(38,0)"  # exact in both
    r = F.array(*(F.lit(x) for x in rest))
    total = lambda a: F.aggregate(a, F.lit(0).cast(kind), lambda s, x: (s + x).cast(kind))
    squares = total(F.transform(t, lambda x: (x.cast(kind) * x.cast(kind)).cast(kind)))
    cross = total(F.zip_with(t, r, lambda x, y: (x.cast(kind) * y.cast(kind)).cast(kind)))
    big = lambda x: (F.lit(str(x)) if isinstance(x, int) else x).cast("decimal(38,0)")
    whole_sum = F.try_subtract(F.try_multiply(big(n * n), big(squares)), F.try_multiply(big(2 * n), big(cross)))
    return F.try_add(whole_sum, big(sum(x * x for x in rest))).try_cast("bigint")


def _whiten(rows: DataFrame, dim: int, components: int) -> DataFrame:
    """rows (key, x) of one dimension."""
    spark = rows.sparkSession
    each = rows.select(F.posexplode("x")).groupBy("pos")  # every task adds up its own rows first
    sums = each.agg(F.count("*").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s"), F.min("col").alias("least"), F.max("col").alias("most")).orderBy("pos").collect()  # d rows
    n, total = sums[0].n, [int(r.s) for r in sums]
    mean, rest = [s // n for s in total], [s % n for s in total]
    most = max(max(abs(r.least - m), abs(r.most - m)) for r, m in zip(sums, mean, strict=True))
    offset = F.array(*map(F.lit, mean))
    fraction = F.array(*(F.lit(r / n) for r in rest))
    rows = numbered(rows, n).withColumn("t", F.zip_with("x", offset, lambda x, m: x - m))
    data = written(rows.select("index", "key", F.zip_with("t", fraction, lambda t, f: t - f).alias("centred"), _deviation("t", rest, n, most).alias("deviation")))

    matrix = _blocks(data, n, dim)
    splits = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // (8 * ROWS))))
    covariance = _product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray() / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    k = min(components, dim)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1][:, :k]
    trace, ok = float(values.sum()), values[:k] > max(values[0], 0) * dim * 2.0**-46
    lead = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])  # one sign in every run
    whitening = np.where(ok, vectors * lead / np.sqrt(np.where(ok, values[:k], 1)), 0)
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(dim, k, whitening.ravel(order="F")))], 1), dim, k)
    white = written(_rows(_product(matrix, right), "white"))

    pairs = [(i, j) for i in range(k) for j in range(i + 1) if ok[i] and ok[j]]
    sums = white.agg(*(F.sum(F.get("white", i)).alias(f"s{i}") for i in range(k)), *(F.sum(F.get("white", i) * F.get("white", j)).alias(f"p{i}_{j}") for i, j in pairs)).first()
    error = max((abs(sums[f"p{i}_{j}"] / n - sums[f"s{i}"] * sums[f"s{j}"] / n / n - (i == j)) for i, j in pairs), default=0.0)

    shares = F.array(*(F.lit(float(v / trace) if trace else 0.0) for v in values[:k]))
    can = F.array(*(F.lit(bool(x)) for x in ok))
    out = data.select("index", "key", "deviation").join(white, "index").select("key", "deviation", F.posexplode("white").alias("c", "value"))
    return out.select("key", (F.col("c") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", F.when(F.get(can, "c"), F.col("value")).alias("whitened"), F.get(shares, "c").alias("explained"), F.lit(float(error)).alias("identity_error"))


def whitened(vectors: DataFrame, *, components: int = 8, key: str = "vec_id", vector: str = "embedding", scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """The key, component (from 1), n, deviation, whitened, explained and identity_error: a row for each row and component."""
    rows = vectors.select(F.col(key).alias("key"), whole(F.col(vector), scale, shift).alias("x")).filter("size(x) > 0")
    rows = written(rows)
    columns = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
    out = rows.limit(0).select("key", *(F.lit(None).cast(kind).alias(name) for name, kind in columns.items()))
    for dim in sorted(r.d for r in rows.select(F.size("x").alias("d")).distinct().collect()):
        out = out.unionByName(_whiten(rows.filter(F.size("x") == dim), dim, components))
    return out.withColumnRenamed("key", key)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
