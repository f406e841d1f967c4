"""Removal of word runs that repeat: prefix-partitioned suffix trees.

A suffix of a text is what follows one of its words.  A run of `length` words repeats where two suffixes
meet in a node of the suffix tree at least `length` words deep.  The tree is never held in one place:

1. A suffix's anchor is the leftmost of the least hashes of `ANCHOR`-word runs among its first `length` words.
   Its prefix is what it has from its first word to the end of its anchor, 10 to 35 words.  Suffixes equal
   over `length` words have equal prefixes, and so equal anchors.  Suffixes whose anchor occurs only once
   meet no other in a deep node and are left out; anchors are counted by an aggregation.
2. Neighbouring suffixes of a text that share the place of their anchor are a stretch, which holds the words of
   all of them.  Stretches go to a task by anchor: a group holds the subtrees of all prefixes that end in it.
3. A task orders the suffixes of a subtree by their words and takes the lengths of the common prefixes of
   neighbours; `length` and more are the deep internal nodes, whose leaves are repeats.  Neighbouring suffixes
   of a stretch that are leaves of deep nodes are one longer repeat and leave the task as one row.
4. Stretches are range-partitioned by anchor, and a task takes at most `CROWD` stretches of an anchor at a time, so that
   a run in a third of all texts goes through many tasks.  Of a subtree that is split so, repeats found in one part
   are repeats; each part hands on the other leaves, and one leaf of each deep node, with prefixes lengthened to all
   `length` words.  Such a prefix is a node of that depth by itself, and only its number of leaves matters, which an
   aggregation counts.
5. The words that the repeats cover are joined to their texts and removed.

Equal texts are one text with a number of copies: one of them stands for all in the tree, and a text with a
copy repeats as a whole.  Words are ordered and compared by 48 bits of their hashes, lengthened prefixes and
texts by 64.

Cases: a null or short text has nothing removed; windows inside one text count like any other; repeated
rows are each returned; a null key is a key; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from pulsegrid.llm.session import written
from pulsegrid.llm.textops import U, encoded, gram_hashes, minimizers, small_batches, word_hashes

LENGTH = 35
ANCHOR = 10
CROWD = 2000
SYMBOL = 6  # bytes of a word's hash that stand for it in a tree
ROOM = 1 << 18  # words that a task takes up before it passes stretches on
STRETCH = "anchor long, id long, first long, reach int, n int, words binary"


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal values."""
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
    return first, np.diff(np.concatenate((first, [len(at)])))


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, .. first + n - 1 of each, one after the other."""
    return np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, id, place): place packs a stretch's first suffix, the words from there to the anchor, and its suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 256):
            anchor, ids, place = [], [], []
            for raw, i in zip(encoded(b["text"]), b["id"].to_pylist(), strict=True):
                g = gram_hashes(word_hashes(raw), ANCHOR)
                at = minimizers(g, length - ANCHOR + 1)
                first, n = _runs(at)
                anchor.append(g[at[first]].astype(np.int64))
                ids.append(np.full(len(first), i, np.int64))
                place.append(first << 12 | at[first] - first << 6 | n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (anchor, ids, place)], names=["anchor", "id", "place"])

    return docs.select("id", "text").mapInArrow(run, "anchor long, id long, place long")


def _stretches(docs: DataFrame, length: int) -> DataFrame:
    """The stretches named in the column `places` of each text, with their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 32):
            held, room = [], 0
            for raw, i, places in zip(encoded(b["text"]), b["id"].to_pylist(), b["places"], strict=True):
                w = word_hashes(raw)
                place = np.unique(places.values.to_numpy())
                first, reach, n = place >> 12, place >> 6 & 63, place & 63
                symbols = w.view(np.uint8).reshape(-1, 8)[:, 8 - SYMBOL :]
                anchor = gram_hashes(w, ANCHOR)[first + reach].astype(np.int64)
                held.append((anchor, np.full(len(first), i, np.int64), first, reach, n, symbols[_spread(first, n + length - 1)].reshape(-1)))
                room += int(n.sum()) + len(n) * length
                if room > ROOM:
                    yield out(held)
                    held, room = [], 0
            if held:
                yield out(held)

    def out(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        anchor, i, first, reach, n, words = (np.concatenate(x) for x in zip(*held, strict=True))
        ends = np.concatenate(([0], np.cumsum((n + length - 1) * SYMBOL))).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(words.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(i), pa.array(first), pa.array(reach.astype(np.int32)), pa.array(n.astype(np.int32)), packed], names=["anchor", "id", "first", "reach", "n", "words"])

    return docs.select("id", "text", "places").mapInArrow(run, STRETCH)


def _words(column: pa.Array) -> np.ndarray:
    """The symbols of a column of words, one after the other."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].reshape(-1, SYMBOL)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :SYMBOL] = data
    return wide.view(U).reshape(-1)


def deep_leaves(anchor: np.ndarray, reach: np.ndarray, n: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Of stretches sorted by anchor: which suffixes are leaves of deep nodes, by stretch and by distance to the anchor."""
    most = length - ANCHOR
    size = n + length - 1
    text = np.zeros((len(n), most + length), U)  # aligned at the anchors
    row = np.repeat(np.arange(len(n)), size)
    text[row, _spread(most - reach, size)] = words
    group = np.cumsum(np.concatenate(([0], anchor[1:] != anchor[:-1])))
    leaves = np.zeros((len(n), most + 1), bool)
    for d in range(most + 1):
        r = np.flatnonzero((d <= reach) & (d > reach - n))
        r = r[np.bincount(group[r], minlength=len(n) and int(group[-1]) + 1)[group[r]] > 1]
        if not len(r):
            continue
        edges = np.empty((len(r), 1 + length), U)  # the subtree, then the suffix
        edges[:, 0], edges[:, 1:] = group[r], text[r, most - d : most - d + length]
        order = np.argsort(edges.view(f"V{8 * (1 + length)}").reshape(-1), kind="stable")
        differ = edges[order[1:]] != edges[order[:-1]]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), 1 + length) - 1  # of neighbours; -1 across subtrees
        deep = common >= length
        leaves[r[order[1:]][deep], d] = leaves[r[order[:-1]][deep], d] = True
    return leaves


def _trees(length: int):
    """Of stretches sorted by anchor, the repeats (null, id, place): place is the first suffix * 64 + how many follow each
    other.  Of anchors that may have more stretches elsewhere, also the other leaves (deep, id, place) and one leaf of
    each deep node (deep, null, null): deep is the hash of its first `length` words."""

    def repeats(b: pa.RecordBatch, split: set[int]) -> pa.RecordBatch:
        anchor, ids, first, reach, n = (b[c].to_numpy().astype(np.int64) for c in ("anchor", "id", "first", "reach", "n"))
        words = _words(b["words"])
        leaves = deep_leaves(anchor, reach, n, words, length)
        edge = np.diff(np.pad(leaves, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, start = np.nonzero(edge == 1)
        stop = np.nonzero(edge == -1)[1]  # in the same order
        at = first[row] + reach[row] - stop + 1  # the nearer the anchor, the later the suffix
        out = [(np.zeros(len(row), np.int64), ids[row], at << 6 | stop - start, 0)]
        rows = np.flatnonzero(np.isin(anchor, list(split)))
        if len(rows):
            begin = np.concatenate(([0], np.cumsum(n + length - 1)[:-1]))[rows]
            deep = gram_hashes(words, length)[_spread(begin, n[rows])].astype(np.int64)  # runs across stretches are not taken
            of, suffix = np.repeat(rows, n[rows]), _spread(np.zeros(len(rows), np.int64), n[rows])
            leaf = leaves[of, reach[of] - suffix]
            out.append((deep[~leaf], ids[of[~leaf]], first[of[~leaf]] + suffix[~leaf] << 6 | 1, 1))
            node = np.unique(deep[leaf])
            out.append((node, np.zeros(len(node), np.int64), np.zeros(len(node), np.int64), 2))
        kind = np.concatenate([np.full(len(d), k) for d, _, _, k in out])
        deep, i, place = (np.concatenate([x[c] for x in out]) for c in range(3))
        return pa.RecordBatch.from_arrays([pa.array(deep, mask=kind == 0), pa.array(i, mask=kind == 2), pa.array(place, mask=kind == 2)], names=["deep", "id", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        split: set[int] = set()  # the first anchor, the last one, and the latest that was cut
        held = 0
        for big in batches:
            for b in small_batches([big], CROWD):
                anchor = b["anchor"].to_numpy()
                if not rest and not split:
                    split.add(int(anchor[0]))
                cut = int(np.searchsorted(anchor, anchor[-1]))
                if rest and (cut or rest[-1]["anchor"][-1].as_py() != anchor[-1]):
                    yield repeats(pa.concat_batches([*rest, b.slice(0, cut)]), split)
                    rest, held = [], 0
                elif cut:
                    yield repeats(b.slice(0, cut), split)
                rest.append(b.slice(cut))
                held += b.num_rows - cut
                if held > CROWD:
                    split.add(int(anchor[-1]))
                    yield repeats(pa.concat_batches(rest), split)
                    rest, held = [], 0
        if rest:
            yield repeats(pa.concat_batches(rest), split | {rest[-1]["anchor"][-1].as_py()})

    return run


def repeated_suffixes(docs: DataFrame, copies: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """docs (id, key, text), id naming the text, and copies (id, first: the key that stands for it), to (id, place):
    word number * 64 + how many suffixes from there on start with `length` words that also start elsewhere, in
    another text or in the same one."""
    if not ANCHOR < length < ANCHOR + 38:
        raise ValueError("length is out of range")
    rows = _anchor_rows(docs, length)
    where = F.xxhash64("id", "place")
    twice = written(rows.groupBy("anchor").agg(F.min(where).alias("a"), F.max(where).alias("b")).filter("a <> b").select("anchor"))
    places = rows.join(twice, "anchor").groupBy("id").agg(F.collect_set("place").alias("places"))
    places = written(places.join(copies, "id"))
    one = docs.join(places, "id").filter(F.col("key").eqNullSafe(F.col("first")))
    stretch = written(_stretches(one, length))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = written(stretch.repartitionByRange(parts, "anchor", "id", "first").sortWithinPartitions("anchor").mapInArrow(_trees(length), "deep long, id long, place long"))
    handed = leaves.filter("deep IS NOT NULL")
    nodes = written(handed.groupBy("deep").agg(F.count("*").alias("n")).filter("n > 1").select("deep"))
    return leaves.filter("deep IS NULL").select("id", "place").unionByName(handed.filter("id IS NOT NULL").join(nodes, "deep").select("id", "place"))


def _removed(raw: bytes, places: np.ndarray, copied: bool, length: int) -> tuple[int, np.ndarray, bytes]:
    """The number of words, the spans of words removed (starts and ends), and what is left."""
    w = raw.split()
    if copied and len(w) >= length:
        return len(w), np.array([[0, len(w)]]), b""
    edge = np.zeros(len(w) + 1, np.int64)
    np.add.at(edge, places >> 6, 1)
    np.add.at(edge, np.minimum((places >> 6) + (places & 63) - 1 + length, len(w)), -1)
    gone = np.concatenate(([False], np.cumsum(edge[:-1]) > 0, [False]))
    spans = np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)
    return len(w), spans, b" ".join(x for x, g in zip(w, gone[1:].tolist(), strict=False) if not g) if len(spans) else b" ".join(w)


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, digest: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept, spans): the words that stay, joined by one space, and the stretches of words
    removed (word numbers, ends exclusive).  With digest, kept_sha256 in place of kept and spans."""
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("id", F.xxhash64("text"))
    copies = written(named.groupBy("id").agg(F.min("key").alias("first"), (F.count("*") > 1).alias("copied")))
    places = repeated_suffixes(named, copies.select("id", "first"), length=length).groupBy("id").agg(F.collect_set("place").alias("places"))
    facts = written(places.join(copies.filter("copied").select("id", "copied"), "id", "full_outer"))
    schema = docs.select(key).schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256" if digest else "kept", "string")
    if not digest:
        schema = schema.add("spans", ArrayType(ArrayType(LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for b in small_batches(batches):
            out = [_removed(raw, p.values.to_numpy() if p.is_valid else none, bool(c), length) for raw, p, c in zip(encoded(b["text"]), b["places"], b["copied"].to_pylist(), strict=True)]
            kept = [hashlib.sha256(x).hexdigest() if digest else x.decode() for *_, x in out]
            cols = [b["key"], pa.array([x[0] for x in out], pa.int64()), pa.array([int((s[:, 1] - s[:, 0]).sum()) for _, s, _ in out], pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols if digest else [*cols, pa.array([s.tolist() for _, s, _ in out], pa.list_(pa.list_(pa.int64())))], names=schema.fieldNames())

    return named.join(facts, "id", "left").select("key", "text", "places", "copied").mapInArrow(run, schema)


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), digest=True)


OP7_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT r, unnest(generate_series(1, len(w) - {LENGTH - 1})) AS i, w FROM d WHERE len(w) >= {LENGTH}),
g AS (SELECT r, i, md5(array_to_string(w[i:i + {LENGTH - 1}], ' ')) AS g FROM s),
twice AS (SELECT g FROM g GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + {LENGTH - 1})) AS p FROM g WHERE g IN (SELECT g FROM twice)),
word AS (SELECT r, unnest(generate_series(1, len(w))) AS p, unnest(w) AS x FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
