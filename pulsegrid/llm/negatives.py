"""Hard negatives by angular triangle filtering.

An anchor's positives are its best rows of the same label; for each, the best rows of other labels are wanted whose
score lies in a window set by the positive's score.  Scores are integer inner products.

Reference directions are drawn from the different vectors by a hash.  Every row stores its norm, its nearest reference
(its cell) and the angle to it, and the angles to the first SHARED references.  For a reference that makes the angle a
with the anchor and b with a row, the angle between the two is in [|a - b|, min(a + b, 2 pi - a - b)]; the intervals of
all references are intersected, their cosines multiplied by both norms, and rounded outward with a margin far above the
rounding of floating point.  Only rows whose interval of scores overlaps what an anchor looks for get integer scores:

* positives: scores of at least the bound that the cells of the label prove for the k-th best, and then of at least the
  k-th best found so far;
* negatives: scores in one of the windows, and not below the n-th best that has been found in it so far.

Both rounds go by blocks of anchors: a cell is sent to a block only if its summary (range of norms and of all stored
angles) overlaps for some anchor of the block, in chunks of bounded size, and a task takes a block and a split of about
SPLIT rows.  In the first round blocks and cells are of one label.  The best of all splits are merged.

Scale: cells number about four times the square root of the rows, at most MAX_CELLS; their directions and, for each
label, their summaries are all that a task holds beside its block and its chunks.  Blocks and chunks have fixed sizes, so
that a label or a cell with a third of all rows is many of them.

Components are floor(scale * x).  Scores are exact: in double precision while they stay under 2**53, else in Python
integers, cut to the range of a long.

Cases: rows with a null id, a null label, a null or empty vector, or a null or non-finite component take no part; rows meet
rows of the same number of dimensions; rows with an anchor's id are neither its positives nor its negatives; an id with
several rows is several candidates, and as an anchor one for each different label and vector, each with ranks of
its own; ties go to the smaller id; fewer rows than asked for are all returned, and a positive without a row in its
window (each one with a negative score, as its window is empty) gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.knn import _best, _exact_scores, _matrix, scaled
from pulsegrid.llm.session import written

MAX_CELLS = 1024
SHARED = 8
BLOCK = 1024
CHUNK = 2048
SPLIT = 32_768
STEP = 64  # anchors that are bounded and scored at once
ANGLE_MARGIN = 1e-6  # arccos of a rounded cosine near 1 is off by 1e-7
Found = list[tuple[int, int, int, int]]


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score s with 50 p <= 100 s <= 95 p, for each p; 1 and 0 where p is negative, as there is none."""
    p = np.maximum(positive, 0)
    return np.where(positive < 0, 1, -((-p) // 2)), np.where(positive < 0, 0, p + (-p) // 20)


def _angles(x: np.ndarray, norm: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of the rows of x to unit vectors; of a zero vector, 0 (its scores are 0 by its norm)."""
    cos = x @ directions.T / np.where(norm > 0, norm, 1)[:, None]
    return np.where(norm[:, None] > 0, np.arccos(np.clip(cos, -1, 1)), 0.0)


def _bounds(angle: np.ndarray, norm: np.ndarray, cell: np.ndarray, least: np.ndarray, most: np.ndarray, small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (rows of the result) with rows or cells (its columns).  angle: of the anchors to
    all references; norm: of the anchors.  cell: the own reference of each column; least and most: the range of its
    angles, the own one first, then the shared ones; small and large: the range of its norms."""
    near, far = np.zeros((len(norm), len(cell))), np.full((len(norm), len(cell)), np.pi)
    for r in range(min(len(least), 1 + angle.shape[1])):
        a = angle[:, r - 1, None] if r else angle[:, cell]
        np.maximum(near, np.maximum(least[r] - a, a - most[r]), out=near)
        np.minimum(far, np.minimum(a + most[r], 2 * np.pi - a - least[r]), out=far)
    hi = np.cos(np.clip(near - ANGLE_MARGIN, 0, np.pi))
    lo = np.cos(np.clip(np.maximum(far, near) + ANGLE_MARGIN, 0, np.pi))
    n = norm[:, None]
    margin = 1e-9 * n * large + 1
    return np.floor(n * np.where(lo > 0, small, large) * lo - margin), np.ceil(n * np.where(hi > 0, large, small) * hi + margin)


def _place(rows: DataFrame, directions: np.ndarray, groups: int) -> DataFrame:
    """rows (id, label, v) plus norm, cell, the nearest of the first `groups` references, and the angles to its own and to
    the shared references (own first)."""
    shared = rows.sparkSession.sparkContext.broadcast(directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                x = _matrix(part["v"], d.shape[1])
                norm = np.sqrt((x * x).sum(1))
                angle = _angles(x, norm, d)
                cell = angle.argmin(1)
                stored = np.column_stack([angle[np.arange(len(x)), cell], angle[:, :SHARED]])
                yield pa.RecordBatch.from_arrays([part["id"], part["label"], part["v"], pa.array(norm), pa.array(cell.astype(np.int32)), pa.array(angle[:, :groups].argmin(1).astype(np.int32)), pa.array(stored.tolist(), pa.list_(pa.float64()))], names=["id", "label", "v", "norm", "cell", "far", "angles"])

    return rows.mapInArrow(run, "id long, label long, v array<double>, norm double, cell int, far int, angles array<double>")


def _pack(rows: DataFrame, group: list[str], size: int, *also: str) -> DataFrame:
    """Gathers rows into packs of at most `size` of one group, neighbouring cells together: the group's columns, pack, and
    arrays of id, v and `also`."""
    lots = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("in_group") / (8 * size)).cast("long"))
    lot = F.pmod(F.xxhash64("id", "v"), lots)  # several counters for a large group, so that none numbers its rows in one task
    rows = rows.join(rows.groupBy(*group).agg(F.count("*").alias("in_group")), group).withColumn("lot", lot)
    part = F.floor((F.row_number().over(Window.partitionBy(*group, "lot").orderBy("cell", "id")) - 1) / size)
    packs = rows.withColumn("part", part).groupBy(*group, "lot", "part").agg(F.collect_list(F.struct("id", "v", *also)).alias("x"))
    flat = [(F.flatten(f"x.{c}") if dict(rows.dtypes)[c].startswith("array") else F.col(f"x.{c}")).alias(c) for c in ("id", "v", *also)]
    return packs.select(*group, F.xxhash64(*group, "lot", "part").alias("pack"), *flat)


def _summaries(data: DataFrame, by: list[str]) -> DataFrame:
    """For each group of `by`, an array of its cells (at most MAX_CELLS): ranges of norms and of angles, and how many
    ids have their row nearest to its reference there."""
    n = range(1 + SHARED)
    ranges = [f(F.get("angles", i)).alias(f"{name}{i}") for name, f in (("least", F.min), ("most", F.max)) for i in n]
    cells = data.groupBy(*by, "cell").agg(F.min("norm").alias("small"), F.max("norm").alias("large"), *ranges)
    alone = data.groupBy(*by, "id").agg(F.min(F.struct(F.get("angles", 0), "cell")).alias("x")).select(*by, "x.cell")
    cells = cells.join(alone.groupBy(*by, "cell").agg(F.count("*").alias("ids")), [*by, "cell"], "left")
    packed = F.struct("cell", F.coalesce("ids", F.lit(0)).alias("ids"), "small", "large", F.array(*(f"least{i}" for i in n)).alias("least"), F.array(*(f"most{i}" for i in n)).alias("most"))
    return cells.groupBy(*by).agg(F.sort_array(F.collect_list(packed)).alias("cells"))


def _cell_bounds(x: np.ndarray, norm: np.ndarray, directions: np.ndarray, cells: list) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of each anchor with all rows of each cell."""
    small, large = (np.array([c[k] for c in cells], float) for k in ("small", "large"))
    least, most = (np.array([c[k] for c in cells], float).T for k in ("least", "most"))
    return _bounds(_angles(x, norm, directions), norm, np.array([c["cell"] for c in cells]), least[: 1 + len(directions)], most[: 1 + len(directions)], small, large)


def _kth_bound(low: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """For each anchor, a score that its k-th best is not below: cells of k + 1 different ids whose low ends are not below."""
    order = np.argsort(-low, axis=1, kind="stable")
    enough = np.cumsum(ids[order], axis=1) > k
    first = np.where(enough.any(axis=1), enough.argmax(axis=1), -1)
    bound = np.take_along_axis(low, order, axis=1)[np.arange(len(low)), first]
    return np.where(first >= 0, bound, -np.inf)


class _Rows:
    """The rows of a task's chunks, in the order of their cells."""

    def __init__(self, chunks: pa.Table, dim: int):
        chunks = chunks.sort_by([("cell", "ascending"), ("first", "ascending")])
        flat = lambda c, t: chunks[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(t)
        self.ids, self.norm, self.x = flat("id", np.int64), flat("norm", float), flat("v", float).reshape(-1, dim)
        self.angles = flat("angles", float).reshape(len(self.ids), -1).T
        self.cell = np.repeat(chunks["cell"].to_numpy(), pc.list_value_length(chunks["id"]).to_numpy())
        self.label = flat("label", np.int64) if "label" in chunks.column_names else np.zeros(len(self.ids), np.int64)

    def parts(self) -> Iterator[_Rows]:
        for i in range(0, len(self.ids), CHUNK):
            part = object.__new__(_Rows)
            part.ids, part.norm, part.x, part.cell, part.label = (c[i : i + CHUNK] for c in (self.ids, self.norm, self.x, self.cell, self.label))
            part.angles = self.angles[:, i : i + CHUNK]
            yield part

    def bounds(self, angle: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mine = self.angles[: 1 + angle.shape[1]]
        return _bounds(angle, norm, self.cell, mine, mine, self.norm, self.norm)


def _solver(directions: Broadcast, dim: int, best: Callable[[dict, _Rows, np.ndarray], Found], result: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    names = [c.split()[0] for c in result.split(", ")]

    def solve(asked: pa.Table, found: pa.Table) -> pa.Table:
        out: Found = []
        if asked.num_rows and found.num_rows:
            rows = _Rows(found, dim)
            for block in asked.to_pylist():
                out += best(block, rows, directions.value)
        return pa.table([pa.array([r[j] for r in out], pa.int64()) for j in range(len(names))], names=names)

    return solve


def _meet(blocks: DataFrame, chunks: DataFrame, need: DataFrame, on: list[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Blocks and the chunks of the cells that they need, by (block, split)."""
    split = F.pmod("pack", F.lit(max(1, -(-n // SPLIT)))).alias("split")
    right = chunks.join(need, on).select("block", split, F.col("pack").alias("first"), *(c for c in chunks.columns if c != "pack"))
    pairs = chunks.select(*on, split).distinct().join(need, on).select("block", "split").distinct()
    return blocks.join(pairs, "block"), right


def _mine(rows: DataFrame, anchors: Column, dim: int, positives: int, negatives: int) -> DataFrame:
    spark = rows.sparkSession
    n = rows.count()
    m = int(min(MAX_CELLS, max(1, 4 * n**0.5)))
    asked_blocks = max(1, -(-rows.filter(anchors).count() // BLOCK))
    marked = rows.select(F.xxhash64(F.lit(37), "v").alias("h"), "v")
    drawn = marked.join(F.broadcast(marked.select("h").distinct().orderBy("h").limit(m)), "h")
    drawn = drawn.groupBy("h").agg(F.first("v").alias("v")).orderBy("h").collect()  # at most MAX_CELLS rows
    d = np.array([r.v for r in drawn], float).reshape(-1, dim)
    size = np.sqrt((d * d).sum(1))[:, None]
    directions = np.unique(np.where(size > 0, d / np.where(size > 0, size, 1), np.eye(1, dim)), axis=0)
    shared = spark.sparkContext.broadcast(directions)
    data = written(_place(rows, directions, min(asked_blocks, len(directions))))
    asked = data.filter(anchors).dropDuplicates(["id", "label", "v"]).select("id", "label", "v", "norm", "cell", "far")

    # first round: the positives
    blocks = written(_pack(asked, ["label"], BLOCK, "norm", "cell", "far").withColumnRenamed("pack", "block"))
    chunks = written(_pack(data, ["label", "cell"], CHUNK, "norm", "angles"))  # angles: 1 + SHARED numbers a row
    summaries = _summaries(data, ["label"])

    def cells_of_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x, norm = np.array(r["v"], float).reshape(-1, dim), np.array(r["norm"], float)
                need = np.zeros(len(r["cells"]), bool)
                for i in range(0, len(x), STEP):
                    low, high = _cell_bounds(x[i : i + STEP], norm[i : i + STEP], shared.value, r["cells"])
                    need |= (high >= _kth_bound(low, np.array([c["ids"] for c in r["cells"]]), positives)[:, None]).any(axis=0)
                cell = [c["cell"] for c, ok in zip(r["cells"], need.tolist(), strict=True) if ok]
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(cell), pa.int64()), pa.array([r["label"]] * len(cell), pa.int64()), pa.array(cell, pa.int32())], names=["block", "label", "cell"])

    need = blocks.join(summaries, "label").mapInArrow(cells_of_label, "block long, label long, cell int")

    def best_positives(block: dict, rows: _Rows, directions: np.ndarray) -> Found:
        ids, norm = np.array(block["id"], np.int64), np.array(block["norm"], float)
        x, out = np.array(block["v"], float).reshape(-1, dim), []
        for i in range(0, len(ids), STEP):
            part = slice(i, i + STEP)
            angle = _angles(x[part], norm[part], directions)
            top: list[list[tuple[int, int]]] = [[] for _ in ids[part]]
            least = np.full(len(top), -np.inf)
            for c in rows.parts():
                need = c.bounds(angle, norm[part])[1] >= least[:, None]
                at = np.flatnonzero(need.any(axis=0))
                if not len(at):
                    continue
                scores = _exact_scores(x[part], c.x[at])
                for q in np.flatnonzero(need[:, at].any(axis=1)).tolist():
                    mine = need[q, at]
                    hits = _best(c.ids[at][mine], scores[q, mine], ids[i + q], positives)
                    top[q] = sorted(top[q] + hits, key=lambda h: (-h[1], h[0]))[:positives]
                    if len(top[q]) == positives:
                        least[q] = top[q][-1][1]
            out += [(i + q, block["block"], *hit) for q, hits in enumerate(top) for hit in hits]
        return out

    left, right = _meet(blocks.select("block", "id", "v", "norm"), chunks, need, ["label", "cell"], n)
    kind = "at long, block long, positive_id long, positive_score long"
    found = left.groupBy("block", "split").cogroup(right.drop("label").groupBy("block", "split")).applyInArrow(_solver(shared, dim, best_positives, kind), kind)
    order = Window.partitionBy("block", "at").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= positives)
    at = F.posexplode("id").alias("at", "one")
    one = [F.get(c, F.col("at")).alias(c) for c in ("norm", "cell", "far")]
    named = blocks.select("block", "label", "v", "norm", "cell", "far", at).select("block", F.col("at").cast("long").alias("at"), F.col("one").alias("id"), "label", F.slice("v", F.col("at") * dim + 1, dim).alias("v"), *one)
    pairs = written(found.join(named, ["block", "at"]).withColumn("anchor", F.xxhash64("id", "label", "v")))

    # second round: the negatives; anchors of all labels share blocks
    wanted = pairs.groupBy("anchor", "id", "label", "v", "norm", "cell", "far").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    wanted = wanted.withColumn("scores", F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.get("scores", i)))
    blocks = written(_pack(wanted, ["far"], BLOCK, "label", "norm", "anchor", "scores").withColumnRenamed("pack", "block").drop("far"))
    chunks = written(_pack(data, ["cell"], CHUNK, "norm", "label", "angles"))
    found_cells = _summaries(data, []).collect()  # one row of at most MAX_CELLS cells
    summary = spark.sparkContext.broadcast([c.asDict() for r in found_cells for c in r.cells])

    def windows(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positive scores and windows by anchor; a missing one has an empty window."""
        p = np.array([s if s is not None else -1 for s in block["scores"]], np.int64).reshape(len(block["id"]), -1)
        return p, *window(p)

    def cells_of_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x, norm = np.array(r["v"], float).reshape(-1, dim), np.array(r["norm"], float)
                _, low, high = windows(r)
                some = low <= high
                lowest = np.where(some, low.astype(float), np.inf).min(axis=1)
                highest = np.where(some, high.astype(float), -np.inf).max(axis=1)
                need = np.zeros(len(summary.value), bool)
                for i in range(0, len(x), STEP):
                    part = slice(i, i + STEP)
                    lo, hi = _cell_bounds(x[part], norm[part], shared.value, summary.value)
                    need |= ((hi >= lowest[part, None]) & (lo <= highest[part, None])).any(axis=0)
                cell = [c["cell"] for c, ok in zip(summary.value, need.tolist(), strict=True) if ok]
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(cell), pa.int64()), pa.array(cell, pa.int32())], names=["block", "cell"])

    need = blocks.mapInArrow(cells_of_windows, "block long, cell int")

    def best_negatives(block: dict, rows: _Rows, directions: np.ndarray) -> Found:
        ids, labels, norm = (np.array(block[c], t) for c, t in (("id", np.int64), ("label", np.int64), ("norm", float)))
        x, out = np.array(block["v"], float).reshape(-1, dim), []
        p, low, high = windows(block)
        for i in range(0, len(ids), STEP):
            part = slice(i, i + STEP)
            angle = _angles(x[part], norm[part], directions)
            least, most = low[part].astype(float), high[part].astype(float)
            least = np.where(least <= most, least, np.inf)
            top: list[list[list[tuple[int, int]]]] = [[[] for _ in range(p.shape[1])] for _ in ids[part]]
            for c in rows.parts():
                lo, hi = c.bounds(angle, norm[part])
                need = np.zeros(lo.shape, bool)
                for w in range(p.shape[1]):
                    need |= (hi >= least[:, w, None]) & (lo <= most[:, w, None])
                need &= c.label[None] != labels[part, None]
                at = np.flatnonzero(need.any(axis=0))
                if not len(at):
                    continue
                scores = _exact_scores(x[part], c.x[at])
                for q in np.flatnonzero(need[:, at].any(axis=1)).tolist():
                    mine = need[q, at] & (scores[q] >= least[q].min())
                    s, who = scores[q, mine], c.ids[at][mine]
                    for w in np.flatnonzero(least[q] < np.inf).tolist():
                        ok = (s >= least[q, w]) & (s <= high[i + q, w])
                        if ok.any():
                            hits = _best(who[ok], s[ok], ids[i + q], negatives)
                            top[q][w] = sorted(top[q][w] + hits, key=lambda h: (-h[1], h[0]))[:negatives]
                            if len(top[q][w]) == negatives:
                                least[q, w] = top[q][w][-1][1]
            out += [(block["anchor"][i + q], int(p[i + q, w]), *hit) for q, found in enumerate(top) for w, hits in enumerate(found) for hit in hits]
        return out

    left, right = _meet(blocks, chunks, need, ["cell"], n)
    kind = "anchor long, positive_score long, negative_id long, negative_score long"
    found = left.groupBy("block", "split").cogroup(right.groupBy("block", "split")).applyInArrow(_solver(shared, dim, best_negatives, kind), kind)
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return pairs.join(found, ["anchor", "positive_score"]).select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(vectors: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 3, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each row that satisfies
    `anchors`, a condition on `id`.  One search for each number of dimensions that anchors have (a handful)."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), scaled(F.col(vector), scale).alias("v"))
    rows = written(rows.filter("id IS NOT NULL AND label IS NOT NULL AND size(v) > 0"))
    out = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for dim in sorted(r.d for r in rows.filter(anchors).select(F.size("v").alias("d")).distinct().collect()):
        out = out.unionByName(_mine(rows.filter(F.size("v") == dim), anchors, dim, positives, negatives))
    return out


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    changed = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(vectors.withColumn("label", changed), F.col("id") % 50 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, c.id, c.label, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.id <> c.id AND len(a.e) = len(c.e) WHERE a.id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
