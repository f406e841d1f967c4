"""Near-duplicates at a similarity of 0.8 or more: SimHash links, a second signature, and an exact check.

The similarity is that of Jaccard over sets of five-word shingles.  A document's node is the hash of its set of shingle
hashes, so that documents with equal sets meet only once.

1. SimHash fingerprints over the sets are linked within 4 bits by anchor-point covering (simhash.py).  Each
   link is checked by the two sets, and the links that hold make components.
2. At 0.8 two fingerprints differ in about 10 bits of 64, and in up to 17; anchors out of a covering code for that
   would number thousands a fingerprint.  So nodes that are not yet together get a second signature: BANDS keys
   of ROWS minimum hashes each.  Two sets of similarity 0.8 share none of them with a chance of 7 in 100,000 (at
   0.85 of one in a million).  Of a key's nodes, those in more than one component are compared by their sets.

So no link is a chance hit.  What leaves a task is a spanning forest of the links found there, never all pairs of a
group.  Keys with more than CROWD nodes, where a node with a large set counts as one for each UNIT of its shingles, are cut
into pairs of blocks, as in simhash.py, so that a task holds two blocks of CROWD x UNIT shingles at most in expectation.
Sets are made anew from the texts, for the nodes that share a key only.

Cases: a text that is null or has no word has the empty set, like any other such text; fewer words than
a shingle are one shingle; a null key links to no other; rows with one key and different texts are documents of their own;
rows that are alike in all columns count once; an empty table gives an empty table; other columns, whatever their names, are
kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from pulsegrid.llm import simhash
from pulsegrid.llm.arrays import set_aside
from pulsegrid.llm.components import components
from pulsegrid.llm.session import written
from pulsegrid.llm.simhash import ROW, identified, linked_classes, one_of_each, split
from pulsegrid.llm.textops import U, encoded, gram_hashes, mix, small_batches, word_hashes

SIMILAR = 0.8
BANDS, ROWS = 24, 5
CROWD = 2000
UNIT = 1000
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def shingles(raw: bytes, k: int) -> np.ndarray:
    """The sorted hashes of the distinct k-word shingles of the lower-cased bytes."""
    w = word_hashes(raw.lower())
    return np.unique(gram_hashes(w, min(k, len(w)))) if len(w) else np.zeros(0, U)


def bands(s: np.ndarray) -> np.ndarray:
    """The BANDS keys of a set: minima of its elements under multiplications, hashed in groups of ROWS."""
    if not len(s):
        return np.zeros(0, np.int64)
    least = np.full(len(_SEEDS), np.iinfo(U).max, U)
    for i in range(0, len(s), 2048):
        x = s[i : i + 2048, None] * _SEEDS
        least = np.minimum(least, ((x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)).min(axis=0))
    key = mix(np.arange(BANDS, dtype=U))
    for row in least.reshape(BANDS, ROWS).T:
        key = mix(key * U(0x9E3779B97F4A7C15) + row)
    return key.astype(np.int64)


def node(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes(), 42)


def nodes(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """(key, fp, print, size, bands): one row per document; fp is the hash of its set, print its SimHash fingerprint."""
    schema = docs.select(key).schema.add("fp", "long").add("print", "long").add("size", "long").add("bands", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            fp, prints, size, keys = [], [], [], []
            for raw in encoded(b["__text"]):
                s = shingles(raw, k)
                fp.append(node(s))
                size.append(len(s))
                prints.append(simhash.majority(s[i : i + (1 << 14)] for i in range(0, len(s), 1 << 14)))
                keys.append(bands(s))
            yield pa.RecordBatch.from_arrays([b[key], *(pa.array(np.array(x, U).astype(np.int64)) for x in (fp, prints)), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=[key, "fp", "print", "size", "bands"])

    return docs.select(key, F.col(text).alias("__text")).mapInArrow(run, schema)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """docs (fp, __text) to (fp, s): the set as bytes, where it is the node's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            made = [(fp, s.tobytes()) for fp, s in zip(b["fp"].to_pylist(), (shingles(raw, k) for raw in encoded(b["__text"])), strict=True) if fp & (1 << 64) - 1 == node(s)]
            yield pa.RecordBatch.from_arrays([pa.array([fp for fp, _ in made], pa.int64()), pa.array([s for _, s in made], pa.binary())], names=["fp", "s"])

    return docs.select("fp", "__text").mapInArrow(run, "fp long, s binary").dropDuplicates(["fp"])


def forest(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links (places in sets) of a spanning forest of what has at least that similarity."""
    size = np.array([len(s) for s in sets])
    words, ids = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.concatenate(([0], np.cumsum(size)))
    left, out = np.arange(1, len(sets)), []
    front, inside = [0], np.zeros(len(words), bool)
    while len(left):
        if not front:
            front, left = [int(left[0])], left[1:]
            continue
        x = front.pop()
        inside[:] = False
        inside[ids[start[x] : start[x + 1]]] = True
        near = left[np.minimum(size[left], size[x]) >= least * np.maximum(size[left], size[x]) * (1 - 1e-9)]
        both = np.array([np.count_nonzero(inside[ids[start[i] : start[i + 1]]]) for i in near.tolist()], float)
        hit = near[both / (size[near] + size[x] - both) >= least]
        out += [(x, i) for i in hit.tolist()]
        front += hit.tolist()
        left = np.setdiff1d(left, hit, assume_unique=True)
    return out


def _compare(at: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(u, v): links of the nodes that share an anchor; at (anchor, fp) has anchors of two and more nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, fps, group = None, [], []

        def out() -> pa.RecordBatch:
            pairs = forest(group, least) if len(group) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([fps[p[j]] for p in pairs], pa.int64()) for j in (0, 1)], names=["u", "v"])

        for b in batches:
            for a, fp, s in zip(b["anchor"].to_pylist(), b["fp"].to_pylist(), b["s"], strict=True):
                if a != anchor:
                    if len(group) > 1:
                        yield out()
                    anchor, fps, group = a, [], []
                fps.append(fp)
                group.append(np.frombuffer(s.as_py(), U))
        yield out()

    return at.join(sets, "fp").select("anchor", "fp", "s").repartition("anchor").sortWithinPartitions("anchor", "fp").mapInArrow(run, "u long, v long").distinct()


def _near_prints(known: DataFrame) -> DataFrame:
    """(u, v): pairs of nodes whose SimHash fingerprints are equal or within 4 bits, enough to span every component."""
    prints = written(known.select(F.col("print").alias("fp"), F.col("fp").alias("node")).distinct())
    one = written(prints.groupBy("fp").agg(F.min("node").alias("one")))
    same = prints.join(one, "fp").filter("node <> one").select(F.col("one").alias("u"), F.col("node").alias("v"))
    end = lambda side: one.select(F.col("fp").alias(side), F.col("one").alias(f"{side}_node"))
    near = simhash.links(one).join(end("u"), "u").join(end("v"), "v").select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))
    return same.unionByName(near)


def links(docs: DataFrame, known: DataFrame, *, key: str, text: str, k: int, least: float) -> DataFrame:
    """(u, v): links between the nodes of `known` (key, fp, print, bands), enough to span every component."""
    first = known.groupBy("fp").agg(F.min(key).alias(key))
    near = written(_near_prints(known))
    weight = F.greatest(F.lit(1), F.ceil(F.col("size") / UNIT)).alias("weight")
    at = known.select("fp", weight, F.explode("bands").alias("anchor")).distinct()
    shared = at.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    at = written(at.join(shared, "anchor"))
    asked = at.select("fp").unionByName(near.select(F.explode(F.array("u", "v")).alias("fp"))).distinct()
    sets = written(_sets(docs.select(key, F.col(text).alias("__text")).join(asked.join(first, "fp"), key), k))
    pairs = near.select(F.xxhash64("u", "v").alias("anchor"), F.explode(F.array("u", "v")).alias("fp"))
    early = written(_compare(pairs, sets, least))
    roots = written(components(early))
    rest = written(at.join(roots, F.col("fp") == F.col("node"), "left").select("anchor", "fp", "weight", F.coalesce("root", "fp").alias("root")))
    apart = written(rest.groupBy("anchor").agg((F.min("root") < F.max("root")).alias("apart"), F.sum("weight").alias("count")).filter("apart").select("anchor", "count"))
    rest = rest.join(apart.select("anchor"), "anchor").select("anchor", "fp")
    crowded = apart.filter(F.col("count") > CROWD)
    if not crowded.isEmpty():
        rest = split(rest, crowded, CROWD)
    return early.unionByName(_compare(rest, sets, least)).distinct()


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5, least: float = SIMILAR) -> DataFrame:
    """One document of each component of documents that are at least that similar, the one with the least key,
    with its columns; cases as in the module's text and in simhash.one_of_each."""
    if not SIMILAR <= least <= 1:
        raise ValueError("the bands cover similarities of 0.8 and more")
    apart, back = set_aside(docs, ROW, "__text")
    key, text = (next((n for n, c in back.items() if c == x), x) for x in (key, text))
    rows = identified(apart, key)
    named = rows.filter(F.col(key).isNotNull())
    known = written(nodes(named, key=ROW, text=text, k=k))
    found = linked_classes(known.select(ROW, "fp"), written(links(named, known, key=ROW, text=text, k=k, least=least)), key=ROW)
    return one_of_each(rows, found, key).withColumnsRenamed(back)
