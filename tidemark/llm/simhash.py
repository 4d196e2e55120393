"""SimHash near-duplicates found with BK-trees.

A fingerprint has the majority bits of the XXH64 values of a text's word shingles.
Distinct fingerprints are sharded so that every pair within the radius meets: the 64
bits are cut into ``blocks`` blocks, and a pair that differs in at most ``radius`` bits
agrees on some ``blocks - radius`` of them, so one shard per choice of blocks and value
is enough.  Each shard's tree (children keyed by their integer distance from the
parent) is built where its queries are, and a query follows only the edges within the
radius.  Shards of more than ``shard`` fingerprints are cut into parts, and each pair
of parts becomes a task of its own, so that no group is too large for one task.

Defined cases: null and empty texts have fingerprint 0, linked like any other; equal
fingerprints are one tree entry; a null key takes part but is never a component id;
repeated rows are linked with each other.

``near_duplicates`` links by fingerprint alone.  ``keep_one`` with a ``similarity`` links by
the similarity of sets of shingles, with fingerprints and trees as its filter (``similar``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import arrow_rows, durable, fresh, with_columns
from .textbytes import LOWER, chunks, words

BITS = 64


def joined_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words joined by single spaces, so that a shingle is one slice; start, end and row of each word there."""
    s, e, row = words(data, offs)
    if not len(s):
        return data[:0], s, e, row
    keep = np.zeros(len(data) + 1, bool)
    depth = np.zeros(len(data) + 1, np.int8)
    depth[s] += 1
    depth[e] -= 1
    keep[:-1] = np.cumsum(depth[:-1], dtype=np.int8).astype(bool)
    inner = e[:-1][row[1:] == row[:-1]]  # the white space after a word that isn't its row's last
    text = np.append(data, np.uint8(32))
    text[inner] = 32
    keep[inner] = True
    place = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return text[keep], place[s], place[e], row


def fingerprints(data: np.ndarray, offs: np.ndarray, width: int = 3) -> np.ndarray:
    n = len(offs) - 1
    out = np.zeros(n, np.uint64)
    text, s, e, row = joined_words(LOWER[data], offs)
    if not len(s):
        return out
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    shingles = np.maximum(count - width + 1, (count > 0).astype(np.int64))
    at = np.repeat(first - (np.cumsum(shingles) - shingles), shingles) + np.arange(shingles.sum())
    last = np.minimum(at + width - 1, np.repeat(first + count - 1, shingles))
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[a:b], 42) for a, b in zip(s[at].tolist(), e[last].tolist(), strict=True)), np.uint64, len(at))
    return majority(h, shingles)


def majority(h: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Of each row's hashes (``shingles`` of them, row after row) the bits set in over half; 0 without hashes."""
    out = np.zeros(len(shingles), np.uint64)
    rows = np.flatnonzero(shingles)
    if not len(rows):
        return out
    ends = np.cumsum(shingles[rows])
    votes = np.empty((len(rows), BITS), np.int64)
    # rows whole, some at a time, so that the unpacked bits stay small
    lo = 0
    while lo < len(rows):
        begin = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, begin + 65536, "right")))
        if hi == lo + 1:
            part = h[begin : ends[lo]]
            votes[lo] = sum(np.unpackbits(part[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64) for k in range(0, len(part), 65536))
        else:
            bits = np.unpackbits(h[begin : ends[hi - 1]].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes[lo:hi] = np.add.reduceat(bits, ends[lo:hi] - shingles[rows[lo:hi]] - begin, axis=0, dtype=np.int32)
        lo = hi
    out[rows] = np.packbits(2 * votes > shingles[rows][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


class BKTree:
    """Over distinct 64-bit fingerprints; distance: differing bits."""

    def __init__(self, items: np.ndarray):
        self.items = items
        self.nodes: list[tuple[int, list[tuple[int, int]]]] = []  # item, [(distance, child node)]
        self._build(np.arange(len(items)))

    def _build(self, members: np.ndarray) -> None:
        todo = [(members, -1, 0)]
        while todo:
            m, parent, dist = todo.pop()
            node = len(self.nodes)
            self.nodes.append((int(m[0]), []))
            if parent >= 0:
                self.nodes[parent][1].append((dist, node))
            if len(m) > 1:
                d = np.bitwise_count(self.items[m[1:]] ^ self.items[m[0]])
                for k in np.unique(d):
                    todo.append((m[1:][d == k], node, int(k)))

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index of query, index of item) at a distance of at most ``radius``; all queries go down together."""
        found: list[tuple[np.ndarray, int]] = []
        todo = [(0, np.arange(len(queries)))] if len(self.items) and len(queries) else []
        while todo:
            node, q = todo.pop()
            item, children = self.nodes[node]
            d = np.bitwise_count(queries[q] ^ self.items[item]).astype(np.int16)
            if len(hit := q[d <= radius]):
                found.append((hit, item))
            for k, child in children:
                near = q[np.abs(d - k) <= radius]
                if len(near):
                    todo.append((child, near))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.repeat([f[1] for f in found], [len(f[0]) for f in found])


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component (minimum labels, with shortcuts)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(radius: int):
    def run(batches):
        """Rows (shard, part_a, part_b, fp, node) in the order of their shard; yields a spanning star for each shard's links."""
        rest = None
        for last, rows in _with_last(batches):
            rest = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            shard, fp, node = rest
            if not len(shard):
                continue
            new = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            upto = len(shard) if last else new[-1]
            ends = np.append(new[1:], len(shard))
            out_a, out_b = [], []
            for s, e in zip(new, ends, strict=True):
                if e > upto or e - s < 2:
                    continue
                order = s + np.argsort(node[s:e], kind="stable")
                f, ids = fp[order], node[order]
                q, item = BKTree(f).within(f, radius)
                label = _spanning(len(f), q, item)
                moved = label != np.arange(len(f))
                out_a.append(ids[moved])
                out_b.append(ids[label[moved]])
            rest = [x[upto:] for x in rest]
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    return run


def _with_last(batches):
    held = None
    for b in batches:
        if held is not None:
            yield False, held
        held = [b.column("shard").to_numpy(), b.column("fp").to_numpy().view(np.uint64), b.column("node").to_numpy()]
    if held is not None:
        yield True, held


def shards(fps: DataFrame, radius: int = 3, blocks: int = 5, shard: int = 1024) -> DataFrame:
    """``fps(fp, node)`` with distinct ``fp`` to ``(shard, fp, node)``: every pair within the radius shares a shard."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    part = lambda i: F.shiftrightunsigned(F.col("fp"), edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1)
    keys = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(t).cast("long")
        for i in chosen:
            key = F.shiftleft(key, edges[i + 1] - edges[i]).bitwiseOR(part(i))
        keys.append(key)
    keyed = fps.select("fp", "node", F.explode(F.array(*keys)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "_key")
    met = keyed.join(sizes, keyed["key"] == F.col("_key")).withColumn("parts", F.ceil(F.col("n") / shard).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # every pair of parts is a shard; a part's rows go to each of its pairs
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j")))
    return met.select("fp", "node", "key", F.explode(pairs).alias("p")).select(F.xxhash64("key", "p.i", "p.j").alias("shard"), "fp", "node")


def near_duplicates(docs: DataFrame, key: str = "doc_id", width: int = 3, radius: int = 3, blocks: int = 5, shard: int = 1024) -> DataFrame:
    """``(key, fp, component_id)`` of every row: fingerprint, and the smallest key reachable over links."""
    spark = docs.sparkSession
    arrow_rows(spark)

    def run(batches):
        for rows, data, offs in chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fingerprints(data, offs, width).view(np.int64))], [key, "fp"])

    made = durable(with_columns(docs, [key, "text"]).mapInArrow(run, f"`{key}` bigint, fp bigint"), "fingerprints")
    nodes = durable(made.groupBy("fp").agg(F.min(key).alias("node")), "distinct-fingerprints")
    sharded = shards(nodes.where(F.col("node").isNotNull()), radius, blocks, shard)
    edges = sharded.repartition("shard").sortWithinPartitions("shard").mapInArrow(_links(radius), "a bigint, b bigint")
    found = components(edges).withColumnRenamed("node", "_node")
    of = nodes.join(found, nodes["node"] == F.col("_node"), "left").select(F.col("fp").alias("_fp"), F.coalesce("component", "node").alias("component_id"))
    return made.join(of, made["fp"] == F.col("_fp")).select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", similarity: float | None = None, **how) -> DataFrame:
    """One document of each group stays, that with the smallest key; rows with a null key stay.

    Without ``similarity``, groups are those of ``near_duplicates``; with it, of texts whose
    sets of five-word shingles are that similar.
    """
    from . import similar

    dup = fresh(docs, "dup")
    got = near_duplicates(docs, key, **how) if similarity is None else similar.near_duplicates(docs, key, similarity, **how)
    found = got.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(dup)).distinct()
    return docs.join(found, docs[key] == F.col(dup), "left_anti")
