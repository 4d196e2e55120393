"""Removing passages that repeat, found with suffix arrays built by two-stage sorting.

Two-stage sorting: only suffixes smaller than their successors are sorted directly; the
others are induced from them in one scan over the buckets of first bytes, because such a
suffix follows, within its bucket, the order of its successor.  Common prefixes of
neighbours in the array then show every string of ``length`` bytes that starts twice.

Distribution: a window of ``length`` bytes belongs to the smallest hash (the anchor)
among its strings of ``anchor`` bytes.  Equal windows have equal anchors at equal places,
so a document is cut into segments of consecutive windows with one anchor, and only
segments that share an anchor are compared.  Segments equal as a whole (by the hashes of
anchor and content, 128 bits) are one entry of the array, and occur twice; where an anchor
comes with different contents, one text of each is sent, and the anchor's texts are
searched in one array.  An anchor whose texts are more than ``array_bytes`` (the edges of
a very common passage) is split exactly, in ``STEPS``: windows can only be equal if the
anchor has the same offset in them, so segments are cut into ranges of offsets, and a
range's key has the bytes that all of its windows share.  Keys get longer as ranges get
shorter; a range of one offset has its whole window as key, so nothing stays too large.
All rows are one a segment, so they grow with the input.

Defined cases: null and empty texts, and texts shorter than ``length``, lose nothing;
matches never cross documents; repeated rows are occurrences of their text like any
other; rows are told apart by a hash of key and text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_rows, durable
from .textbytes import Spans, chunks, column, mix, release

LENGTH, ANCHOR = 200, 64
#: Offsets of a range, where an anchor's texts don't fit one array.
STEPS = (16, 1)
#: Positions of one slice: they share a word with 40 bits of hash.
SLICE = 1 << 23
#: Text of one suffix array.
ARRAY_BYTES = 1 << 21
#: Never part of UTF-8.
END = 0xFF

ENTRY = "key bigint, content bigint, uid bigint, start int, windows int, at int"
MARK = "uid bigint, start int, windows int"


# --- suffix arrays -------------------------------------------------------------------


def _words(text: np.ndarray, spare: int) -> np.ndarray:
    """The eight bytes at each position as one big-endian number; zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(spare + 8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text) + spare, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(out)]
    return out


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All positions in the order of their suffixes' first ``depth`` bytes, and the words of the text."""
    n = len(text)
    w = _words(text, depth + 8)
    if n < 2:
        return np.arange(n), w
    step = text[1:].astype(np.int16) - text[:-1]
    turn = np.where(step != 0, np.arange(n - 1), n - 1)
    turn = np.minimum.accumulate(turn[::-1])[::-1]  # where a run of equal bytes ends
    rises = np.zeros(n, bool)  # smaller than its successor; the last suffix isn't
    inside = turn < n - 1
    rises[:-1][inside] = step[turn[inside]] > 0

    p = np.flatnonzero(rises)
    p = p[np.argsort(w[p], kind="stable")]
    group = np.cumsum(np.append(False, w[p[1:]] != w[p[:-1]])) if len(p) else np.zeros(0, np.int64)
    at = np.arange(len(p))
    for d in range(8, depth, 8):
        tied = np.zeros(len(at) + 1, bool)
        tied[1:-1] = group[1:] == group[:-1]
        keep = tied[1:] | tied[:-1]
        at, group = at[keep], group[keep]
        if not len(at):
            break
        word = w[p[at] + d]
        by = np.lexsort((word, group))
        word = word[by]
        p[at] = p[at][by]
        group = np.cumsum(np.append(False, (group[1:] != group[:-1]) | (word[1:] != word[:-1])))

    direct = np.searchsorted(text[p], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    pending[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        wave = np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
        pending[c] = []
        bucket = []
        while len(wave):  # runs of c: each longer run follows the shorter ones
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(text[before] == c) & ~rises[before]]
        bucket.append(p[direct[c] : direct[c + 1]])
        bucket = np.concatenate(bucket)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~rises[before] & (text[before] > c)]
        if len(before):
            by = np.argsort(text[before], kind="stable")
            before = before[by]
            first = np.searchsorted(text[before], np.arange(257))
            for d in np.flatnonzero(np.diff(first)):
                pending[d].append(before[first[d] : first[d + 1]])
    return np.concatenate(out), w


def common_prefixes(order: np.ndarray, w: np.ndarray, depth: int) -> np.ndarray:
    """Of each neighbouring pair in the array, the bytes in common, at most ``depth``."""
    out = np.full(max(len(order) - 1, 0), depth, np.int64)
    live = np.arange(len(out))
    for d in range(0, depth, 8):
        x = w[order[live] + d] ^ w[order[live + 1] + d]
        differ = x != 0
        if differ.any():
            y = x[differ]
            same = np.zeros(len(y), np.int64)
            for k in range(1, 8):
                same += (y >> np.uint64(64 - 8 * k)) == 0
            out[live[differ]] = np.minimum(d + same, depth)
            live = live[~differ]
        if not len(live):
            break
    return out


def repeated_starts(text: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """True at valid positions whose ``length`` bytes also start at another valid one."""
    order, w = suffix_array(text, length)
    joined = common_prefixes(order, w, length) >= length
    run = np.cumsum(np.append(0, ~joined)) if len(order) else np.zeros(0, np.int64)
    ok = valid[order]
    out = np.zeros(len(text), bool)
    out[order] = ok & (np.bincount(run, ok, len(order) + 1)[run] > 1)
    return out


# --- segments ------------------------------------------------------------------------


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours: prefix and suffix minima of blocks of ``w``."""
    m = len(x) - w + 1
    size = -(-len(x) // w) * w
    block = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    block[: len(x)] = x
    block = block.reshape(-1, w)
    head = np.minimum.accumulate(block, axis=1).ravel()
    tail = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:m], head[w - 1 : w - 1 + m])


def segments(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Row, start in the row, number of windows, anchor and content hash, and the anchor's place of each segment."""
    if len(data) > SLICE:  # one very long text (or few): slices that overlap by a window
        parts = []
        for at in range(0, len(data), SLICE):
            upto = min(len(data), at + SLICE + length - 1)
            inner = np.clip(offs, at, upto) - at
            row, start, *rest = segments_of(data[at:upto], inner, length, anchor)
            parts.append((row, start + np.maximum(at - offs[:-1], 0)[row], *rest))
            if upto == len(data):
                break
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    return segments_of(data, offs, length, anchor)


def segments_of(data: np.ndarray, offs: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    spans = Spans(data)
    at = np.arange(n - anchor + 1)
    kh = spans(at, at + anchor)
    low = np.uint64((1 << 24) - 1)
    least = _sliding_min((kh & ~low) | at.astype(np.uint64), length - anchor + 1)
    size = np.diff(offs)
    fit = np.flatnonzero(size >= length)
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, offs[fit], 1)
    np.add.at(inside, offs[fit] + size[fit] - length + 1, -1)
    s = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    if not len(s):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    where = (least[s] & low).astype(np.int64)
    row = np.searchsorted(offs, s, "right") - 1
    first = np.flatnonzero(np.append(True, (where[1:] != where[:-1]) | (row[1:] != row[:-1])))
    count = np.diff(np.append(first, len(s)))
    start, x, row = s[first], where[first], row[first]
    content = mix(spans(start, start + count - 1 + length) + (x - start).astype(np.uint64))
    return row, start - offs[row], count, kh[x], content, x - start


def _table(schema: str, *cols: np.ndarray) -> pa.RecordBatch:
    names = [c.split(" ")[0] for c in schema.split(", ")]
    wide = [c.endswith("bigint") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64) if w else c.astype(np.int32)) for c, w in zip(cols, wide, strict=True)], names)


def _cut(length: int, anchor: int):
    """Documents to the segments of their windows."""

    def run(batches):
        for rows, data, offs in chunks(batches):
            row, start, windows, a, c, at = segments(data, offs, length, anchor)
            yield _table(ENTRY, a, c, np.asarray(rows.column("uid"))[row], start, windows, at)

    return run


def _listed(rows: pa.RecordBatch, offs: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The row of each listed segment, and its fields."""
    lists = rows.column("wants")
    ends = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.flatten()
    row = np.repeat(np.arange(rows.num_rows), np.diff(ends))
    return row, {f.name: np.asarray(flat.field(f.name)) for f in flat.type}


def pieces(data: np.ndarray, offs: np.ndarray, row: np.ndarray, seg: dict[str, np.ndarray], step: int, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Segments cut where the anchor's offset in a window passes a multiple of ``step``: key, content, segment, start, windows, at."""
    at, windows = seg["at"].astype(np.int64), seg["windows"].astype(np.int64)
    high = at // step
    number = high - (at - windows + 1) // step + 1
    of = np.repeat(np.arange(len(at)), number)
    turn = np.arange(number.sum()) - (np.cumsum(number) - number)[of]
    low = (high[of] - turn) * step  # the least offset of the range
    top = np.minimum(low + step - 1, length - anchor)
    first, last = np.maximum(at[of] - low - step + 1, 0), np.minimum(windows[of] - 1, at[of] - low)
    spans = Spans(data)
    x = (offs[row] + seg["start"] + at)[of]
    core = spans(x - low, x - top + length)
    begin = (offs[row] + seg["start"])[of] + first
    content = mix(spans(begin, begin + (last - first) + length) + (x - begin).astype(np.uint64))
    key = mix(core ^ mix(seg["key"][of].view(np.uint64) + low.astype(np.uint64)))
    return key, content, of, seg["start"][of] + first, last - first + 1, at[of] - first


def _split(step: int, length: int, anchor: int):
    """Texts with segments of crowded keys to the segments' pieces."""

    def run(batches):
        for rows, data, offs in chunks(batches):
            row, seg = _listed(rows, offs)
            key, content, of, *rest = pieces(data, offs, row, seg, step, length, anchor)
            yield _table(ENTRY, key, content, np.asarray(rows.column("uid"))[row[of]], *rest)

    return run


def _fetch(length: int):
    """Texts with wanted segments to the segments' bytes."""

    def run(batches):
        for rows, data, offs in chunks(batches):
            row, seg = _listed(rows, offs)
            uid, raw = np.asarray(rows.column("uid"))[row], data.tobytes()
            begin = offs[row] + seg["start"]
            end = begin + seg["windows"] + length - 1
            for k in range(0, len(row), 4000):
                part = slice(k, k + 4000)
                texts = pa.array([raw[a:b] for a, b in zip(begin[part].tolist(), end[part].tolist(), strict=True)], pa.binary())
                cols = [pa.array(seg["key"][part]), pa.array(uid[part]), pa.array(seg["start"][part]), pa.array(seg["windows"][part]), texts]
                yield pa.RecordBatch.from_arrays(cols, ["key", "uid", "start", "windows", "segment"])

    return run


def _compare(length: int, array_bytes: int):
    """Segments in the order of their key: suffix arrays over whole keys; marks of what repeats."""

    def close(held: list[tuple]) -> pa.RecordBatch:
        uid, start, windows = (np.concatenate([h[i] for h in held]) for i in range(3))
        size = np.concatenate([h[4] for h in held])
        owner = np.repeat(np.arange(len(size)), size)
        text = np.full(size.sum() + len(size), END, np.uint8)
        text[np.arange(len(owner)) + owner] = np.concatenate([h[3] for h in held])
        begin = np.cumsum(size + 1) - (size + 1)
        windows = windows.astype(np.int64)
        of = np.repeat(np.arange(len(size)), windows)
        off = np.arange(windows.sum()) - (np.cumsum(windows) - windows)[of]
        valid = np.zeros(len(text), bool)
        valid[begin[of] + off] = True
        hit = repeated_starts(text, valid, length)[begin[of] + off]
        of, off = of[hit], off[hit]
        new = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (off[1:] != off[:-1] + 1))[: len(of)])  # runs of neighbours
        return _table(MARK, uid[of[new]], start[of[new]] + off[new], np.diff(np.append(new, len(of))))

    def run(batches):
        held, size, now = [], 0, None
        for b in batches:
            data, offs = column(b.column("segment"))
            key, *cols = (np.asarray(b.column(c)) for c in ("key", "uid", "start", "windows"))
            if not len(key):
                continue
            edges = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            lo = 0
            for at in edges.tolist():  # an array closes between two keys only
                if size + offs[at] - offs[lo] >= array_bytes and (at > 0 or key[0] != now):
                    held.append((*(c[lo:at] for c in cols), data[offs[lo] : offs[at]], np.diff(offs[lo : at + 1])))
                    yield close(held)
                    held, size, lo = [], 0, at
            held.append((*(c[lo:] for c in cols), data[offs[lo] :], np.diff(offs[lo:])))
            size, now = size + int(offs[-1] - offs[lo]), key[-1]
        if held:
            yield close(held)
        release()

    return run


def covered(start: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs (start, end) that the marked windows cover."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    by = np.argsort(start, kind="stable")
    start = start[by].astype(np.int64)
    end = start + windows[by] - 1 + length
    upto = np.maximum.accumulate(end)
    at = np.flatnonzero(np.append(True, start[1:] > upto[:-1]))
    return np.stack([start[at], upto[np.append(at[1:], len(start)) - 1]], axis=1)


def _meet(entries: DataFrame, length: int, array_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Entries to marks of what is equal as a whole, and one text of each content of keys with several: ``crowded`` if they are too much for one array."""
    keys = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi")).where("n > 1")
    # written, so that the join below reads it through an exchange of its own: then a hot key's side can be split
    keys = durable(keys.select(F.col("key").alias("_key"), (F.col("lo") < F.col("hi")).alias("mixed")), "repeat-keys")
    shared = durable(entries.join(keys, entries["key"] == F.col("_key")).drop("_key"), "repeat-shared")
    mixed = shared.where("mixed")
    one = mixed.groupBy("key", "content").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("uid", "start", "windows", "at")])
    one = durable(one, "repeat-contents")
    load = one.groupBy("key").agg(F.sum(F.col("windows") + F.lit(length)).alias("load")).where(F.col("load") > array_bytes).select(F.col("key").alias("_key"))
    twice = one.where("n > 1").select(F.col("key").alias("_key"), F.col("content").alias("_content"))
    again = mixed.join(twice, (mixed["key"] == F.col("_key")) & (mixed["content"] == F.col("_content")), "left_semi")
    marks = shared.where("not mixed").unionByName(again).select("uid", "start", "windows")
    wanted = one.join(load, one["key"] == F.col("_key"), "left").select("key", "uid", "start", "windows", "at", F.col("_key").isNotNull().alias("crowded"))
    return marks, durable(wanted, "repeat-wanted")


def _with_text(src: DataFrame, wanted: DataFrame) -> DataFrame:
    lists = wanted.groupBy(F.col("uid").alias("w_uid")).agg(F.collect_list(F.struct("key", "start", "windows", "at")).alias("wants"))
    return src.select("uid", "text").join(lists, F.col("uid") == F.col("w_uid")).select("uid", "text", "wants")


def repeats(docs: DataFrame, key: str = "doc_id", length: int = LENGTH, anchor: int = ANCHOR, array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """``(key, n_bytes, spans, kept_sha256)`` of every row; ``spans``: byte ranges that repeat anywhere."""
    spark = docs.sparkSession
    arrow_rows(spark)
    src = docs.select(F.col(key).alias("key"), F.xxhash64(key, "text").alias("uid"), "text")
    entries = durable(src.select("uid", "text").mapInArrow(_cut(length, anchor), ENTRY), "repeat-segments")
    marks = None
    for step in (*STEPS, 0):
        equal, wanted = _meet(entries, length, array_bytes)
        texts = _with_text(src, wanted.where("not crowded")).mapInArrow(_fetch(length), "key bigint, uid bigint, start int, windows int, segment binary")
        found = durable(texts.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(length, array_bytes), MARK), "repeat-marks")
        marks = equal.unionByName(found) if marks is None else marks.unionByName(equal).unionByName(found)
        if wanted.where("crowded").isEmpty():
            break
        entries = durable(_with_text(src, wanted.where("crowded")).mapInArrow(_split(step, length, anchor), ENTRY), "repeat-pieces")
    marks = marks.groupBy(F.col("uid").alias("m_uid")).agg(F.collect_list(F.struct("start", "windows")).alias("wants"))
    name = key

    def run(batches):
        for rows, data, offs in chunks(batches):
            raw = data.tobytes()
            row, mark = _listed(rows, offs)
            ends = np.searchsorted(row, np.arange(rows.num_rows + 1))
            spans, sums = [], []
            for i in range(rows.num_rows):
                text, own = raw[offs[i] : offs[i + 1]], slice(ends[i], ends[i + 1])
                got = covered(mark["start"][own], mark["windows"][own], length).tolist()
                left = text if not got else b"".join(text[a:b] for a, b in zip([0, *(e for _, e in got)], [*(s for s, _ in got), len(text)], strict=True))
                spans.append([{"start": a, "end": b} for a, b in got])
                sums.append(hashlib.sha256(left).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(np.diff(offs)), pa.array(spans, kind), pa.array(sums)], [name, "n_bytes", "spans", "kept_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    joined = src.join(marks, F.col("uid") == F.col("m_uid"), "left").select("key", "text", F.coalesce("wants", F.array()).alias("wants"))
    return joined.mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")


def counted(found: DataFrame, key: str = "doc_id") -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, x: acc + x["end"] - x["start"])
    return found.select(key, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")
