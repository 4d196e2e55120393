"""SimHash near-duplicates confirmed by the similarity of their sets of five-word shingles.

Two texts are linked if the Jaccard similarity of their sets reaches 0.8; texts equal in
words are one content.  A content's fingerprint is the SimHash of its set, and BK-trees
over fingerprints find the pairs within ``RADIUS`` bits, each of which is then verified
with its shingles, so nothing is linked by a fingerprint alone.  At 0.8 a pair differs in
9.7 of 64 bits on average (22 or fewer: all but about 4 in a million), other texts in 32.

At that radius no blocks of fingerprint bits tell anything apart, so trees are sharded by
the sets themselves: a content has ``TABLES`` keys of its smallest shingle hashes under
random orders, so a pair of similarity s shares one with probability
1 - (1 - s**ROWS)**TABLES, 0.9998 at 0.8, and what hangs together over keys is a shard.  A
shard of more than ``part_bytes`` of text or ``part_rows`` texts is cut into parts.  First
all parts meet the shard's first content; then only contents that aren't linked to it meet
the others, each of their parts with each part of the shard.

Defined cases: a text of fewer words is one shingle; null, empty and blank texts are one
content; rows with a null key are no candidates and stay; repeated rows are one content.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .simhash import BKTree, joined_words, majority
from .store import arrow_rows, durable, with_columns
from .textbytes import LOWER, Spans, chunks, column, mix, release

WIDTH, ROWS, TABLES = 5, 7, 36
#: Differing bits of a pair that is verified, and pairs that a tree returns at once.
RADIUS, ASKED = 22, 256
_U = np.uint64


def shingles(text: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray, n: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of joined words, row after row, and their number in each row."""
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    number = np.maximum(count - width + 1, (count > 0).astype(np.int64))
    at = np.repeat(first - (np.cumsum(number) - number), number) + np.arange(number.sum())
    last = np.minimum(at + width - 1, np.repeat(first + count - 1, number))
    return (Spans(text)(s[at], e[last]) if len(at) else np.zeros(0, _U)), number


def table_keys(hashes: np.ndarray, number: np.ndarray, rows: int = ROWS, tables: int = TABLES) -> np.ndarray:
    """``tables`` keys of each row that has shingles."""
    x = (hashes >> _U(32)).astype(np.uint32)
    number = number[number > 0]
    begin = np.cumsum(number) - number
    rng = np.random.default_rng(11)
    turn, odd = rng.integers(0, 2**32, (2, tables * rows), dtype=np.uint32)
    odd |= np.uint32(1)
    out = np.empty((len(number), tables), _U)
    v = np.empty_like(x)
    for t in range(tables):
        key = np.full(len(number), t + 1, _U)
        for k in range(t * rows, (t + 1) * rows):
            np.bitwise_xor(x, turn[k], out=v)
            np.multiply(v, odd[k], out=v)
            key = mix(key ^ mix(np.minimum.reduceat(v, begin).astype(_U) + _U(1))) if len(begin) else key
        out[:, t] = key
    return out


def _describe(key: str):
    def run(batches):
        for rows, data, offs in chunks(batches):
            n = rows.num_rows
            text, s, e, row = joined_words(LOWER[data], offs)
            hashes, number = shingles(text, s, e, row, n)
            raw, count = text.tobytes(), np.bincount(row, minlength=n)
            first = np.cumsum(count) - count
            spans = [(int(s[a]), int(e[a + c - 1])) if c else (0, 0) for a, c in zip(first.tolist(), count.tolist(), strict=True)]
            name = np.frombuffer(b"".join(blake2b(raw[a:b], digest_size=16).digest() for a, b in spans), np.int64).reshape(-1, 2)
            keys = table_keys(hashes, number)
            upto = np.append(0, np.cumsum(number > 0)).astype(np.int32) * keys.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(keys.view(np.int64).ravel()))
            cols = [rows.column(0), pa.array(name[:, 0].copy()), pa.array(name[:, 1].copy()), pa.array(np.diff(offs)), lists]
            yield pa.RecordBatch.from_arrays(cols, [key, "h1", "h2", "size", "keys"])

    return run


def sets(hashes: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's different hashes, rising, and their number."""
    owner = np.repeat(np.arange(len(number)), number)
    order = np.lexsort((hashes, owner))
    h, owner = hashes[order], owner[order]
    keep = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[: len(h)]
    return h[keep], np.bincount(owner[keep], minlength=len(number))


def linked(hashes: np.ndarray, number: np.ndarray, node: np.ndarray, similarity: float = 0.8, radius: int = RADIUS) -> np.ndarray:
    """The group of each set: sets of one node, and those similar enough; candidates are pairs that a BK-tree finds within the radius."""
    below = 1000
    above = math.ceil(similarity * below)
    h, size = sets(hashes, number)
    fp = majority(h, size)
    ids = np.unique(h, return_inverse=True)[1]
    start = np.cumsum(size) - size
    label = np.unique(node, return_inverse=True)[1]
    mark = np.zeros(len(h), bool)
    own_tree = BKTree(fp)
    for lo in range(0, len(fp), ASKED):
        asked, found = own_tree.within(fp[lo : lo + ASKED], radius)
        asked = asked + lo
        ahead = (found > asked) & (label[found] != label[asked])
        asked, found = asked[ahead], found[ahead]
        fit = np.minimum(size[asked], size[found]) * below >= np.maximum(size[asked], size[found]) * above
        order = np.argsort(asked[fit], kind="stable")
        asked, found = asked[fit][order], found[fit][order]
        if not len(asked):
            continue
        first = np.flatnonzero(np.append(True, asked[1:] != asked[:-1]))
        for a, z in zip(first.tolist(), np.append(first[1:], len(asked)).tolist(), strict=True):
            p, near = asked[a], found[a:z]
            near = near[(label[near] != label[p]) & (size[near] > 0)]
            if not len(near) or not size[p]:
                continue
            own = ids[start[p] : start[p] + size[p]]
            mark[own] = True
            ends = np.cumsum(size[near])
            flat = np.repeat(start[near] - (ends - size[near]), size[near]) + np.arange(ends[-1])
            common = np.add.reduceat(mark[ids[flat]], ends - size[near], dtype=np.int64)
            mark[own] = False
            alike = near[common * below >= (size[p] + size[near] - common) * above]
            if len(alike):
                label[np.isin(label, label[alike])] = label[p]
    return label


def _verify(similarity: float):
    """Rows (task, node, text) in the order of their task; yields a spanning star of each task's links."""

    def stars(node, text):
        data, offs = column(text)
        joined, s, e, row = joined_words(LOWER[data], offs)
        label = linked(*shingles(joined, s, e, row, len(node)), node, similarity)
        order = np.lexsort((node, label))
        first = np.flatnonzero(np.append(True, label[order][1:] != label[order][:-1]))
        low = np.repeat(node[order][first], np.diff(np.append(first, len(node))))
        moved = node[order] != low
        return node[order][moved], low[moved]

    def close(held):
        a, b = stars(np.concatenate([np.asarray(h.column("node")) for h in held]), pa.concat_arrays([h.column("text") for h in held]))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches):
        held, now = [], None
        for batch in batches:
            task = np.asarray(batch.column("task"))
            if not len(task):
                continue
            edges = np.flatnonzero(np.append(True, task[1:] != task[:-1])).tolist()
            for s, e in zip(edges, [*edges[1:], len(task)], strict=True):
                if now is not None and task[s] != now:
                    yield close(held)
                    held = []
                now = task[s]
                held.append(batch.slice(s, e - s))
        if held:
            yield close(held)
        release()

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", similarity: float = 0.8, part_bytes: int = 4 << 20, part_rows: int = 2000) -> DataFrame:
    """``(key, component_id)`` of every row: the smallest key reachable over verified links."""
    arrow_rows(docs.sparkSession)
    src = with_columns(docs, [key, "text"])
    made = durable(src.mapInArrow(_describe(key), f"`{key}` bigint, h1 bigint, h2 bigint, size bigint, keys array<bigint>"), "shingle-tables")
    contents = durable(made.groupBy("h1", "h2").agg(F.min(key).alias("node"), F.first("size").alias("size"), F.first("keys").alias("keys")), "contents")
    keyed = contents.where(F.col("node").isNotNull()).select("node", F.explode("keys").alias("key"))
    low = keyed.groupBy("key").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "_key")
    near = components(keyed.join(low, keyed["key"] == F.col("_key")).select(F.col("node").alias("a"), "b"))
    near = durable(contents.select("node", "size").join(near.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")).select("node", "size", F.col("component").alias("shard")), "shards")
    cut = lambda df: F.greatest(F.ceil(F.sum("size") / part_bytes), F.ceil(F.count(F.lit(1)) / part_rows), F.lit(1)).cast("int")
    sizes = durable(near.groupBy("shard").agg(cut(near).alias("parts")), "shard-sizes").withColumnRenamed("shard", "_shard")
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("mine")
    met = near.join(sizes, near["shard"] == F.col("_shard")).select("node", "size", "shard", "parts", mine)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def verified(tasks: DataFrame, name: str) -> DataFrame:
        """``tasks(task, node, group)``: the links of each task's texts; those of one group aren't compared."""
        rows = src.join(tasks.withColumnRenamed("node", "_node"), src[key] == F.col("_node")).select("task", F.col("group").alias("node"), "text")
        return durable(rows.repartition("task").sortWithinPartitions("task").mapInArrow(_verify(similarity), "a bigint, b bigint"), name)

    task = lambda *c: F.xxhash64("shard", *c).alias("task")
    whole = met.where("parts = 1").select(task(), "node", F.col("node").alias("group"))
    large = met.where("parts > 1")
    first = large.where("node = shard").withColumn("part", each("parts")).select(task("part"), "node", F.col("node").alias("group"))
    edges = verified(whole.unionByName(large.select(task("mine"), "node", F.col("node").alias("group"))).unionByName(first), "shingle-links")
    # of large shards: what isn't linked yet to the first content meets every part
    to_first = components(edges).select(F.col("node").alias("_n"), "component")
    large = durable(large.join(to_first, large["node"] == F.col("_n"), "left").select("node", "size", "shard", "parts", "mine", F.coalesce("component", "node").alias("group")), "large-shards")
    rest = large.where("group <> shard")
    number = rest.groupBy("shard").agg(cut(rest).alias("rest_parts")).withColumnRenamed("shard", "_shard")
    with_rest = lambda df: df.join(number, df["shard"] == F.col("_shard"))
    other = with_rest(rest).withColumn("other", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("rest_parts")).cast("int")).withColumn("mine", each("parts"))
    every = with_rest(large).withColumn("other", each("rest_parts"))
    more = verified(every.unionByName(other.select(every.columns)).select(task("mine", "other"), "node", "group"), "shingle-links")
    found = components(edges.unionByName(more)).withColumnRenamed("node", "_node")
    of = contents.join(found, contents["node"] == F.col("_node"), "left").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.coalesce("component", "node").alias("component_id"))
    return made.join(of, (made["h1"] == F.col("_h1")) & (made["h2"] == F.col("_h2"))).select(key, "component_id")
