"""Exact top-k search by inner product: a Voronoi join.

Pivots are drawn from the different vectors by a hash; every vector belongs to the cell of its nearest pivot.  A cell's
summary is its pivot, its radius, and the distances of its nearest members to the pivot, an id counting once, in
the cell where it is nearest, so that a query's own rows are one of them at most.  For a query q, a
member x of a cell with pivot p satisfies  q.p - |q| |x - p| <= q.x <= q.p + |q| |x - p|.  The left side over
the nearest members of all cells gives a bound that the k-th best score cannot be below; a cell whose right
side, with its radius, is below that bound holds no answer.  Queries are grouped by cell; to each group only the
cells that some query of it needs are replicated, in chunks of bounded size, and solved there block by block by
matrix products; the best k of each split are merged.

Smaller groups need fewer cells each, but where the bounds exclude little, every group gets nearly all vectors.  So the
groups are the finest that replicate at most SPREAD times as many vectors as the fewest groups, of one block each, would.

Scale: pivots number about four times the square root of the vectors, at most MAX_PIVOTS; only their summaries
reach the driver and the tasks (MAX_PIVOTS x (dimensions + k) numbers, and MAX_PIVOTS**2 pairs of cells).  Blocks and chunks have fixed sizes,
so that a cell with a third of all vectors is many chunks; a block meets the chunks it needs in splits of
about SPLIT vectors.

Components are floor(scale * x).  Products are exact: in double precision while they stay under 2**53, else in
Python integers, cut to the range of a long.

Cases: vectors that are null, or hold null or non-finite components, or none at all, take no part; vectors are compared with
those of the same number of dimensions; a query's own id is no candidate; several rows with one id are
each candidates, and as queries count once for each distinct vector; ties go to the smaller id; fewer
candidates than k are all returned; null ids take no part; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.session import written

MAX_PIVOTS = 2048
BLOCK = 1024
CHUNK = 2048
SPLIT = 32_768
SPREAD = 1.5
_SAFE = float(1 << 53)


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as a double; null if a component is null or not finite."""
    d = vector.cast("array<double>")
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(d, lambda x: F.floor(x * scale).cast("double")))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return (col.flatten() if pa.types.is_nested(col.type) else col).to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
    return np.sqrt(np.maximum(d2, 0))


def _cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vectors (id, v) plus cell and distance to its pivot."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            if b.num_rows:
                cell, far = [], []
                for i in range(0, b.num_rows, 512):
                    d = _distances(_matrix(b["v"].slice(i, 512), p.shape[1]), p)
                    cell.append(d.argmin(1))
                    far.append(d.min(1))
                yield pa.RecordBatch.from_arrays([b["id"], b["v"], pa.array(np.concatenate(cell).astype(np.int32)), pa.array(np.concatenate(far))], names=["id", "v", "cell", "far"])

    return vectors.mapInArrow(run, "id long, v array<double>, cell int, far double")


def _exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) < _SAFE:
        return np.rint(q @ x.T).astype(np.int64)
    lo, hi = -(1 << 63), (1 << 63) - 1
    qi, xi = ([[int(c) for c in row] for row in m] for m in (q, x))
    return np.array([[min(hi, max(lo, sum(a * b for a, b in zip(r, s, strict=True)))) for s in xi] for r in qi], np.int64).reshape(len(q), len(x))


def _best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best of one query's scores, ties to smaller ids."""
    ok = np.flatnonzero(ids != own)
    s = scores[ok]
    if len(s) > k:
        near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
        ok, s = ok[near], s[near]
    order = np.lexsort((ids[ok], -s))[:k]
    return [(int(ids[ok[i]]), int(s[i])) for i in order]


def _pack(rows: DataFrame, group: str, size: int) -> DataFrame:
    """Gathers rows (id, v) into packs of at most `size` of one group: (group, pack, ids, vs)."""
    # a hash spreads a large group over several counters, so that none numbers its rows in one task
    lots = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("in_group") / (8 * size)).cast("long"))
    rows = rows.select(group, "id", "v").join(rows.groupBy(group).agg(F.count("*").alias("in_group")), group).withColumn("lot", F.pmod(F.xxhash64("id"), lots))
    part = F.floor((F.row_number().over(Window.partitionBy(group, "lot").orderBy("id")) - 1) / size)
    packs = rows.withColumn("part", part).groupBy(group, "lot", "part").agg(F.collect_list(F.struct("id", "v")).alias("x"))
    return packs.select(group, F.xxhash64(group, "lot", "part").alias("pack"), F.col("x.id").alias("ids"), F.flatten("x.v").alias("vs"))


def _groups(need: DataFrame, data: DataFrame, pivots: np.ndarray, n_queries: int) -> list[int]:
    """The group of each cell's queries: that of the nearest of the first pivots, of as many as SPREAD allows."""
    m = len(pivots)
    size = np.zeros(m, np.int64)
    for r in data.groupBy("cell").agg(F.count("*").alias("n")).collect():  # one row a cell
        size[r.cell] = r.n
    pair = need.toArrow()  # at most MAX_PIVOTS**2 rows of two numbers
    own, cell = (pair[c].to_numpy().astype(np.int64) for c in ("own", "cell"))
    fewest = max(1, min(m, -(-n_queries // BLOCK)))
    best, least = [], 0
    for g in sorted({min(m, fewest << i) for i in range(m.bit_length() + 1)}):
        of = _distances(pivots, pivots[:g]).argmin(1)
        moved = int(size[np.unique(of[own] * m + cell) % m].sum())
        if best and moved > SPREAD * least:
            break
        best, least = of.tolist(), least or moved
    return best


def _search(vectors: DataFrame, queries: Column, dim: int, k: int) -> DataFrame:
    """vectors (id, v) of one dimension to (query_id, vec_id, score): the best k of each split of the data."""
    spark = vectors.sparkSession
    n, n_queries = vectors.count(), vectors.filter(queries).count()
    m = int(min(MAX_PIVOTS, max(1, 4 * n**0.5)))
    marked = vectors.select(F.xxhash64(F.lit(31), "v").alias("h"), "v")
    drawn = marked.select("h").distinct().orderBy("h").limit(m)  # different vectors, however often each is repeated
    drawn = marked.join(F.broadcast(drawn), "h").groupBy("h").agg(F.first("v").alias("v")).orderBy("h").collect()  # at most MAX_PIVOTS rows
    pivots = np.array([r.v for r in drawn], float).reshape(-1, dim)
    data = written(_cells(vectors, pivots))

    alone = data.groupBy("id").agg(F.min(F.struct("far", "cell")).alias("x")).select("x.cell", "x.far")
    ranked = alone.select("cell", "far", F.row_number().over(Window.partitionBy("cell").orderBy("far")).alias("r")).filter(F.col("r") <= k + 1)
    near = {r.cell: r.near for r in ranked.groupBy("cell").agg(F.collect_list("far").alias("near")).collect()}  # one row a cell
    radius = {r.cell: r.radius for r in data.groupBy("cell").agg(F.max("far").alias("radius")).collect()}
    cells = np.array(sorted(radius), np.int64)
    owner = np.repeat(np.arange(len(cells)), [len(near.get(c, [])) for c in cells.tolist()])
    facts = spark.sparkContext.broadcast((cells, pivots[cells], np.array([radius[c] for c in cells]), owner, np.concatenate([near.get(c, []) for c in cells.tolist()])))

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, p, radius, owner, near = facts.value
        for b in batches:
            for own, vs in zip(b["cell"].to_pylist(), b["vs"], strict=True):
                q = vs.values.to_numpy().reshape(-1, dim)
                size, mid = np.sqrt((q * q).sum(1))[:, None], q @ p.T
                low = mid[:, owner] - size * near
                bound = np.partition(low, low.shape[1] - k - 1, axis=1)[:, low.shape[1] - k - 1] if low.shape[1] > k else np.full(len(q), -np.inf)
                high = mid + size * radius
                slack = 1e-6 * (np.abs(high) + size * (np.sqrt((p * p).sum(1)) + radius) + 1)  # far above rounding
                cell = cells[(high + slack >= bound[:, None]).any(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), own, np.int32)), pa.array(cell.astype(np.int32))], names=["own", "cell"])

    asked = data.filter(queries).dropDuplicates(["id", "v"])
    need = written(_pack(asked, "cell", BLOCK).select("cell", "vs").mapInArrow(needs, "own int, cell int").distinct())  # at most MAX_PIVOTS**2 rows
    group = F.lit(_groups(need, data, pivots, n_queries))
    block = written(_pack(asked.withColumn("group", F.get(group, F.col("cell"))), "group", BLOCK))
    chunk = written(_pack(data, "cell", CHUNK))
    need = written(need.select(F.get(group, F.col("own")).alias("to"), "cell").distinct())
    need = block.select(F.col("group").alias("to"), F.col("pack").alias("block")).join(need, "to").select("block", "cell")
    splits = max(1, -(-n // SPLIT))
    split = F.pmod("pack", F.lit(splits)).alias("split")
    right = chunk.join(need, "cell").select("block", split, "ids", "vs")
    pairs = chunk.select("cell", split).distinct().join(need, "cell").select("block", "split").distinct()
    left = block.withColumnRenamed("pack", "block").join(pairs, "block").select("block", "split", "ids", "vs")

    def solve(asked: pa.Table, found: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if asked.num_rows and found.num_rows:
            q_ids, q = asked["ids"].combine_chunks().flatten().to_numpy(), _matrix(asked["vs"].combine_chunks().flatten(), dim)
            ids, x = found["ids"].combine_chunks().flatten().to_numpy(), _matrix(found["vs"].combine_chunks().flatten(), dim)
            for i in range(0, len(q), 64):
                for own, scores in zip(q_ids[i : i + 64].tolist(), _exact_scores(q[i : i + 64], x), strict=True):
                    out += [(own, *hit) for hit in _best(ids, scores, own, k)]
        return pa.table([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])

    return left.groupBy("block", "split").cogroup(right.groupBy("block", "split")).applyInArrow(solve, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: Column, *, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row that satisfies `queries`, a
    condition on `id`.  One search for each number of dimensions that queries have."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), scaled(F.col(vector), scale).alias("v")).filter("id IS NOT NULL AND size(v) > 0")
    rows = written(rows)
    out = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for dim in sorted(r.d for r in rows.filter(queries).select(F.size("v").alias("d")).distinct().collect()):
        out = out.unionByName(_search(rows.filter(F.size("v") == dim), queries, dim, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM (SELECT DISTINCT vec_id, e FROM v) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 5
"""
