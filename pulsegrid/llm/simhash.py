"""Near-duplicate detection: SimHash fingerprints, linked by anchor-point covering.

The anchors are codewords of the perfect binary Golay code (23, 12): every 23-bit word lies within
the covering radius 3 of exactly one.  A 64-bit fingerprint is cut into three blocks of 22, 21 and 21
bits.  Two fingerprints that differ in at most 4 bits differ in at most 2 bits over some pair of blocks,
so that for each pair of blocks the anchors are pairs of codewords.  A fingerprint is replicated to
the pairs within covering radius plus half the threshold, one bit, in one block, and within the
covering radius in the other; two fingerprints at most 2 bits apart in these blocks then share an
anchor.  That is about 29 anchors a fingerprint, out of 3 x 2**24.

Per anchor, fingerprints are compared by XOR and bit count; what leaves a task is a spanning forest
of the links found there, never all pairs of a group.  Anchors with more than CROWD fingerprints are cut
into blocks, and each pair of blocks is compared by another task.  Components (components.py) join
the forests.  Copies share a fingerprint and are compared once.

Cases: a text that is null or has no word has fingerprint zero, which links like any other; fewer words
than a shingle are one shingle; a null key counts as larger than any other; repeated rows are each
returned; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.arrays import set_aside
from pulsegrid.llm.components import components
from pulsegrid.llm.session import written
from pulsegrid.llm.textops import encoded, small_batches

BITS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))
DISTANCE = 4
CROWD = 20_000
GOLAY = 0xC75  # fixed value: the generator polynomial of the Golay code (23, 12)
U = np.uint64


def fingerprint(raw: bytes, k: int) -> int:
    """Majority of the bits of the XXH64 (seed 42) of each k-word shingle of the lower-cased bytes."""
    w = raw.lower().split()
    if not w:
        return 0
    text, n = b" ".join(w), max(1, len(w) - k + 1)
    end = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))

    def hashes() -> Iterator[np.ndarray]:
        for i in range(0, n, 1 << 14):
            j = min(n, i + (1 << 14))
            s, e = start[i:j].tolist(), end[min(k, len(w)) - 1 :][i:j].tolist()
            yield np.fromiter((xxhash.xxh64_intdigest(text[a:b], 42) for a, b in zip(s, e, strict=True)), U, j - i)

    return majority(hashes())


def majority(parts: Iterable[np.ndarray]) -> int:
    """The bits that are set in over half of the hashes."""
    votes, n = np.zeros(64, np.int64), 0
    for h in parts:
        votes += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(sum(1 << b for b in np.flatnonzero(2 * votes > n).tolist()))


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """(key, fp): one row per document; fp is the fingerprint as a signed long."""
    schema = docs.select(key).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            fp = np.fromiter((fingerprint(raw, k) for raw in encoded(b["__text"])), U, b.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b[key], pa.array(fp)], names=[key, "fp"])

    return docs.select(key, F.col(text).alias("__text")).mapInArrow(run, schema)


def _remainder(x: int) -> int:
    for b in range(22, 10, -1):
        if x >> b & 1:
            x ^= GOLAY << (b - 11)
    return x


def _golay() -> tuple[list[np.ndarray], np.ndarray]:
    """Syndromes of each byte of a 23-bit word, and for each syndrome the error of at most 3 bits."""
    one = [_remainder(1 << b) for b in range(23)]
    leader = np.zeros(2048, np.uint32)
    for a in range(23):
        leader[one[a]] = 1 << a
        for b in range(a):
            leader[one[a] ^ one[b]] = 1 << a | 1 << b
            for c in range(b):
                leader[one[a] ^ one[b] ^ one[c]] = 1 << a | 1 << b | 1 << c
    tables = []
    for byte in range(3):
        t = np.zeros(256, np.uint32)
        for v in range(256):
            for b in range(8):
                if v >> b & 1 and 8 * byte + b < 23:
                    t[v] ^= one[8 * byte + b]
        tables.append(t)
    return tables, leader


_GOLAY = _golay()


def nearest(x: np.ndarray) -> np.ndarray:
    """The codeword within 3 bits of each 23-bit word."""
    (t0, t1, t2), leader = _GOLAY
    return x ^ leader[t0[x & 255] ^ t1[x >> 8 & 255] ^ t2[x >> 16]]


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and anchors of uint64 fingerprints, each anchor once a fingerprint."""
    near, at = [], 0
    for bits in BITS:
        x = (fp >> U(at) & U((1 << bits) - 1)).astype(np.uint32)
        flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.uint32)
        near.append(nearest(x[:, None] ^ flips).astype(U))  # the first column is the own codeword
        at += bits
    keys = []
    for p, (i, j) in enumerate(PAIRS):
        a, b = near[i], near[j]
        own = np.concatenate((a << U(23) | b[:, :1], a[:, :1] << U(23) | b[:, 1:]), axis=1)
        keys.append(own | U(p << 46))
    k = np.sort(np.concatenate(keys, axis=1), axis=1)
    first = np.concatenate((np.ones((len(k), 1), bool), k[:, 1:] != k[:, :-1]), axis=1)
    return np.nonzero(first)[0], k[first]


def _forest(fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of a group: each reached fingerprint is taken out of those still compared."""
    out, left = [], fp
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            hit = np.bitwise_count(left ^ x) <= distance
            if hit.any():
                found, left = left[hit], left[~hit]
                out.append((np.full(len(found), x), found))
                front.extend(found)
    return out


def group_links(key: np.ndarray, fp: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that span, within each group of equal (sorted) keys, what lies within the distance."""
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(edge)
    small = np.repeat(size <= 24, size)
    u, v = [], []
    for s in range(1, 24):
        i = np.flatnonzero((key[s:] == key[:-s]) & small[s:])
        if not len(i):
            break
        i = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= distance]
        u.append(fp[i])
        v.append(fp[i + s])
    for g in np.flatnonzero(size > 24):
        for a, b in _forest(np.unique(fp[edge[g] : edge[g + 1]]), distance):
            u.append(a)
            v.append(b)
    return (np.concatenate(u), np.concatenate(v)) if u else (np.zeros(0, U), np.zeros(0, U))


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v): links between the distinct fingerprints `fp`, enough to span every component."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("the anchors cover distances of 0 to 4")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4096):
            fp = b["fp"].to_numpy().astype(U)
            row, key = anchors(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(fp[row].astype(np.int64))], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def out(cut: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            u, v = group_links(cut[0], cut[1].astype(U), distance)
            pair = np.unique(np.stack((u.astype(np.int64), v.astype(np.int64)), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["u", "v"])

        for b in batches:
            key, fp = (np.concatenate((r, b[c].to_numpy())) for r, c in zip(rest, ("anchor", "fp"), strict=True))
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest = (key[cut:], fp[cut:])
            if cut:
                yield out((key[:cut], fp[:cut]))
        if len(rest[0]):
            yield out(rest)

    at = fps.select("fp").distinct().mapInArrow(spread, "anchor long, fp long")
    crowded = written(at.groupBy("anchor").count().filter(F.col("count") > CROWD))
    if not crowded.isEmpty():
        at = split(at, crowded, CROWD)
    return at.repartition("anchor").sortWithinPartitions("anchor", "fp").mapInArrow(compare, "u long, v long").distinct()


def split(at: DataFrame, crowded: DataFrame, crowd: int) -> DataFrame:
    """Gives crowded anchors an anchor for each pair of blocks of their fingerprints."""
    n = F.ceil(F.col("count") / crowd)
    own = F.pmod(F.xxhash64("fp"), n)
    pair = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda other: F.xxhash64("anchor", F.least(own, other), F.greatest(own, other))))
    joined = at.join(crowded, "anchor", "left")
    calm = joined.filter("count IS NULL").select("anchor", "fp")
    return calm.unionByName(joined.filter("count IS NOT NULL").select(pair.alias("anchor"), "fp"))


def classes(fps: DataFrame, *, key: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """fps (key, fp) plus component_id: the least key whose fingerprint is reachable by links."""
    return linked_classes(fps, links(fps, distance), key=key)


def linked_classes(fps: DataFrame, found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """classes, by links (u, v) that are given.  What is known of a fingerprint or a root is a table before it is joined, so
    that Spark can split the rows of a frequent one."""
    least = fps.groupBy("fp").agg(F.min(key).alias("least"))
    roots = written(components(found))
    every = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    known = written(every.join(least, every["node"] == least["fp"]).groupBy("root").agg(F.min("least").alias("component_id")))
    linked = every.join(known, "root").select(F.col("node").alias("fp"), "component_id")
    of = written(least.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")))
    return fps.join(of, "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5, distance: int = DISTANCE) -> DataFrame:
    """One document of each component, the one with the least key, with its columns; cases as in one_of_each."""
    named, back = set_aside(docs, ROW, "__text")
    key, text = (next((n for n, c in back.items() if c == x), x) for x in (key, text))
    rows = identified(named, key)
    found = classes(written(fingerprints(rows.filter(F.col(key).isNotNull()), key=ROW, text=text, k=k)), key=ROW, distance=distance)
    return one_of_each(rows, found, key).withColumnsRenamed(back)


ROW = "__row"


def identified(docs: DataFrame, key: str) -> DataFrame:
    """docs plus __row: the key and a hash of the whole row, which rows have in common only if they are alike in all columns.
    It is the same whenever it is computed, and orders rows by key."""
    hashed = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in t or "variant" in t else F.col(f"`{c}`") for c, t in docs.dtypes]
    return docs.withColumn(ROW, F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64(*hashed).alias("hash")))


def one_of_each(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Of rows (as from `identified`), those whose __row is their component_id in `found`, and those with a null key; columns
    as they were.  Rows are linked, not keys: rows with one key and different texts are each in a class of their own text.  A
    class keeps the row with the least key, of several with that key the one with the least hash.  Rows alike in all
    columns are one; a null key links to no other."""
    keep = found.filter(F.col(ROW) == F.col("component_id")).select(ROW).distinct()
    named = rows.filter(F.col(key).isNotNull()).join(keep, ROW, "left_semi").dropDuplicates([ROW])
    return named.unionByName(rows.filter(F.col(key).isNull()).dropDuplicates([ROW])).drop(ROW)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = classes(written(fingerprints(docs, k=4)))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
