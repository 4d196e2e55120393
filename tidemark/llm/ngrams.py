"""Language-model scores from an n-gram trie coded with Elias-Fano sequences.

The model is a trigram model with interpolated absolute discounting,
    p(w | u v) = max(c(uvw) - D, 0) / c(uv) + D n(uv) / c(uv) * p(w | v)
    p(w | v)   = max(c(vw) - D, 0) / c(v)   + D n(v) / c(v)   * (c(w) + 1) / (N + V + 1),
n being the different words seen after a context; a context never seen leaves all to the
shorter one.  A text's first word has the context of the start alone.

A trie has three levels, context words, their successors, and theirs.  Each level is
monotone (a successor's number is added to the last number of the context before), in
Elias-Fano code, as are the pointers from level to level; discounted probabilities and
back-off weights are quantised to even steps of their logarithm, so a score depends on the
corpus alone.  The levels lie in one memory map, and an n-gram is found by successor
search: the context's rank, its pointers, then the successor relative to the context's
start, level after level.

All counts are of all training documents; nothing is pruned.  The corpus is cut into
chunks.  A chunk's distinct words go to shards by hash, which answer with their counts and
numbers; then its distinct trigrams go to shards by their first word, each of which builds
the trie of its trigrams and answers with the codes of each, in the chunk's own order.  A
word, or pair of words, with more than a small share of all tokens is dealt out by what
follows it; its totals are summed over the shards, from the same shuffled requests, before
the tries are built.  There is a shard for each ``SHARD_TOKENS`` tokens, and a task holds
one shard at a time.

Defined cases: null and empty texts are one end token; a null key is a training row;
repeated rows count as often as they occur; an empty table gives an empty table.
"""

from __future__ import annotations

import mmap
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out
from .store import ARROW_ROWS, arrow_rows, durable, shared_dir
from .textbytes import LOWER, Spans, chunks, mix, release, words

DISCOUNT = 0.75
#: Tokens of a chunk and of a shard, and steps of a quantised log10 value.
CHUNK_TOKENS, SHARD_TOKENS, STEPS = 800_000, 1_000_000, 2000
#: N-grams searched at once.
ASKED = 1 << 18
#: Input of a bucket of chunks.
BUCKET_BYTES = 1 << 25
#: Spark's own bound of buckets.
MOST_BUCKETS = 100_000
START, STOP, PAD = (mix(np.array([k], np.uint64))[0] for k in (11, 12, 13))
_U = np.uint64


# --- Elias-Fano ----------------------------------------------------------------------


def _select(words_: np.ndarray, super_: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Position of the k-th one (or zero) of a bit vector with counts before every eight words."""
    block = np.searchsorted(super_, k, "right") - 1
    left = (k - super_[block]).astype(np.int64)
    at = block * 8
    pending = np.arange(len(k))
    word = np.empty(len(k), _U)
    while len(pending):
        x = words_[at[pending]]
        x = ~x if flip else x
        n = np.bitwise_count(x).astype(np.int64)
        here = left[pending] < n
        word[pending[here]] = x[here]
        pending, n = pending[~here], n[~here]
        left[pending] -= n
        at[pending] += 1
    pos = at * 64
    for size in (32, 16, 8, 4, 2, 1):
        n = np.bitwise_count(word & _U((1 << size) - 1)).astype(np.int64)
        up = left >= n
        left -= np.where(up, n, 0)
        pos += np.where(up, size, 0)
        word = np.where(up, word >> _U(size), word)
    return pos


class EliasFano:
    """A rising sequence: low bits packed, high bits as gaps in a bit vector."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones, self.zeros = n, low_bits, low, high, ones, zeros
        self._all: dict[bool, np.ndarray] = {}

    def _place(self, k: np.ndarray, flip: bool) -> np.ndarray:
        """Position of the k-th one (or zero): many at once are read off all of them, few are searched for."""
        if len(k) * 8 < self.n and flip not in self._all:
            return _select(self.high, self.zeros if flip else self.ones, k, flip)
        if flip not in self._all:
            bits = np.unpackbits(self.high.view(np.uint8), bitorder="little").view(bool)
            self._all[flip] = np.flatnonzero(~bits if flip else bits).astype(np.uint32 if len(bits) < 1 << 32 else np.int64)
        return self._all[flip][k].astype(np.int64)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(_U)
        n = len(values)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        buckets = ((universe - 1) >> low_bits) + 1 if universe else 1
        place = (values >> _U(low_bits)) + np.arange(n, dtype=_U)
        size = -(-(n + buckets + 1) // 512) * 8
        high = np.zeros(size, _U)
        np.bitwise_or.at(high, (place >> _U(6)).astype(np.int64), _U(1) << (place & _U(63)))
        low = np.zeros(n * low_bits // 64 + 2, _U)
        if low_bits:
            v = values & _U((1 << low_bits) - 1)
            bit = np.arange(n, dtype=_U) * _U(low_bits)
            w, s = (bit >> _U(6)).astype(np.int64), bit & _U(63)
            np.bitwise_or.at(low, w, v << s)
            over = np.flatnonzero(s + _U(low_bits) > 64)
            np.bitwise_or.at(low, w[over] + 1, v[over] >> (_U(64) - s[over]))
        count = np.bitwise_count(high).reshape(-1, 8).sum(axis=1).astype(np.int64)
        ones = np.cumsum(count) - count
        return cls(n, low_bits, low, high, ones, np.arange(len(ones), dtype=np.int64) * 512 - ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)
        bit = i.astype(_U) * _U(self.low_bits)
        w, s = (bit >> _U(6)).astype(np.int64), bit & _U(63)
        out = self.low[w] >> s
        out |= np.where(s > 0, self.low[w + 1] << ((_U(64) - s) & _U(63)), _U(0))
        return out & _U((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        high = self._place(i, False) - i
        return (high.astype(_U) << _U(self.low_bits)) | self._low(i)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Successor search: index of the first value that isn't less, and whether it is equal."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        h = (x >> _U(self.low_bits)).astype(np.int64)
        xl = x & _U((1 << self.low_bits) - 1)
        a = np.where(h > 0, self._place(np.maximum(h - 1, 0), True) - np.maximum(h - 1, 0), 0)
        b = self._place(h, True) - h
        at, end = a, b.copy()
        live = np.flatnonzero(at < end)
        while len(live):  # halving: where values crowd, many have the same high bits
            mid = (at[live] + end[live]) >> 1
            less = self._low(mid) < xl[live]
            at[live[less]] = mid[less] + 1
            end[live[~less]] = mid[~less]
            live = live[at[live] < end[live]]
        hit = at < b
        hit[hit] = self._low(at[hit]) == xl[hit]
        return at, hit

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.ones, self.zeros]


# --- arrays as bytes -----------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Compressed: the arrays' first bytes, then their second ones and so on, so that zeros lie together."""
    arrays = tuple(np.ascontiguousarray(a) for a in arrays)
    body = b"".join(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    return head.tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def unpack(data) -> list[np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    head = raw[8 : 8 + 16 * n].view(np.int64).reshape(n, 2)
    kinds = [np.dtype(chr(c)) for c in head[:, 0]]
    size = sum(k.itemsize * int(m) for k, m in zip(kinds, head[:, 1], strict=True))
    body = np.frombuffer(pa.decompress(raw[8 + 16 * n :].tobytes(), decompressed_size=size, codec="zstd"), np.uint8)
    out, at = [], 0
    for kind, m in zip(kinds, head[:, 1].tolist(), strict=True):
        out.append(np.ascontiguousarray(body[at : at + m * kind.itemsize].reshape(kind.itemsize, m).T).view(kind).ravel())
        at += m * kind.itemsize
    return out


def small(x: np.ndarray) -> np.ndarray:
    """In the narrowest unsigned type that holds it."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The same arrays one after another in a memory map of this task, which goes with its last view."""
    starts = np.cumsum([0, *(a.nbytes + -a.nbytes % 8 for a in arrays)])
    area = np.frombuffer(mmap.mmap(-1, max(int(starts[-1]), 1)), np.uint8)
    out = []
    for a, at in zip(arrays, starts.tolist(), strict=False):
        area[at : at + a.nbytes] = np.ascontiguousarray(a).view(np.uint8).ravel()
        out.append(area[at : at + a.nbytes].view(a.dtype))
    return out


# --- the trie ------------------------------------------------------------------------


def quantised(x: np.ndarray) -> np.ndarray:
    """Codes of values in (0, 1]; 0 is no value."""
    return (1 + np.minimum(np.rint(-np.log10(x) * STEPS), 65534)).astype(np.uint16)


_VALUES = np.append(0.0, 10.0 ** (-np.arange(65535) / STEPS))


def value(codes: np.ndarray) -> np.ndarray:
    """What ``quantised`` stands for; 0 where there is none."""
    return _VALUES[codes]


#: Between two codes, that one isn't there: no count is large enough for it.
_NONE = 30000


def _apart(codes: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Codes of shares of ``total`` as steps from that of 1 / total: the same few numbers again and again."""
    base = quantised(1 / np.maximum(total, 1))
    return np.where(codes == 0, np.uint16(_NONE), codes - base)


def _together(steps: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(steps == _NONE, np.uint16(0), steps + quantised(1 / np.maximum(total, 1)))


class Level:
    """Successors of contexts: each number is added to the last one of the context before, so all of them rise."""

    def __init__(self, owner: np.ndarray, contexts: int, word: np.ndarray):
        """Words (rising within an owner) of ``contexts`` contexts, of which some may have none."""
        size = np.bincount(owner, minlength=contexts) if contexts else np.zeros(0, np.int64)
        ends = np.cumsum(size)
        last = np.zeros(contexts, np.int64)
        last[size > 0] = word[ends[size > 0] - 1].astype(np.int64) + 1
        base = np.cumsum(last) - last
        self.pointers = EliasFano.of(np.append(0, ends), len(word) + 1)
        self.successors = EliasFano.of(base[owner] + word.astype(np.int64) + 1, int(last.sum()) + 2)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each word after its context, or -1; a context of -1 has none."""
        out = np.full(len(context), -1, np.int64)
        known = np.flatnonzero(context >= 0)
        if not len(known) or not self.successors.n:
            return out
        ctx, of = np.unique(context[known], return_inverse=True)
        lo, hi = self.pointers[ctx], self.pointers[ctx + 1]
        base = np.zeros(len(ctx), _U)
        later = np.flatnonzero(lo > 0)
        base[later] = self.successors[lo[later].astype(np.int64) - 1]
        at, hit = self.successors.find(np.minimum(base[of] + word[known].astype(_U) + _U(1), self.top))
        hit &= (at >= lo[of].astype(np.int64)) & (at < hi[of].astype(np.int64))
        out[known[hit]] = at[hit]
        return out

    @property
    def top(self) -> np.uint64:
        """The largest value; nothing beyond it is there."""
        return self.successors[np.array([self.successors.n - 1])][0] + _U(1)


class Trie:
    """Numbers of words, context words, successors, and theirs, with the codes of each level."""

    def __init__(self, first: np.ndarray, pair_of: np.ndarray, second: np.ndarray, of: np.ndarray, third: np.ndarray, codes: list[np.ndarray]):
        """``second`` words after context ``first[pair_of]``, ``third`` words after pair ``of``; each rising within its context.

        ``codes``: back-off weights of the first level, probabilities and back-off weights
        of the second, probabilities of the third.
        """
        self.first = EliasFano.of(first, int(first[-1]) + 2 if len(first) else 1)
        self.pairs, self.triples = Level(pair_of, len(first), second), Level(of, len(second), third)
        seqs = [self.first, self.pairs.pointers, self.pairs.successors, self.triples.pointers, self.triples.successors]
        area = mapped([a for e in seqs for a in (e.low, e.high, e.ones, e.zeros)] + codes)
        for i, e in enumerate(seqs):
            e.low, e.high, e.ones, e.zeros = area[4 * i : 4 * i + 4]
        self.codes = area[20:]

    def contexts(self, word: np.ndarray) -> np.ndarray:
        """The rank of each first word, or -1."""
        if not self.first.n:
            return np.full(len(word), -1, np.int64)
        top = self.first[np.array([self.first.n - 1])][0]
        at, hit = self.first.find(np.minimum(word.astype(_U), top + _U(1)))
        return np.where(hit, at, -1)

    def query(self, first: np.ndarray, pair_of: np.ndarray, second: np.ndarray, of: np.ndarray, third: np.ndarray) -> list[np.ndarray]:
        """The codes of each asked context, pair and triple (laid out as in the constructor); 0 for what isn't there."""
        a = self.contexts(first)
        parts = lambda n: (slice(k, k + ASKED) for k in range(0, n, ASKED))  # noqa: E731  bounded intermediate arrays
        b = np.concatenate([self.pairs.find(a[pair_of[x]], second[x]) for x in parts(len(second))] or [a[:0]])
        c = np.concatenate([self.triples.find(b[of[x]], third[x]) for x in parts(len(third))] or [a[:0]])
        at = lambda codes, k: np.where(k >= 0, codes[np.maximum(k, 0)], 0).astype(np.uint16) if len(codes) else np.zeros(len(k), np.uint16)
        return [at(self.codes[0], a), at(self.codes[1], b), at(self.codes[2], b), at(self.codes[3], c)]


# --- chunks --------------------------------------------------------------------------

SCHEMA = "kind int, key bigint, part int, n bigint, data binary"
TEXTS, WORDS, COUNTS, TOTALS, HEAVY, MARK = range(6)


def _rows(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["kind", "key", "part", "n", "data"])


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards rise with the hash, so what is sorted by hash is sorted by shard."""
    return (((hashes >> _U(32)) * _U(shards)) >> _U(32)).astype(np.int64)


def _read():
    """Documents to chunks of tokens, numbered in the chunk's vocabulary (sorted hashes)."""

    def flush(chunk: int, held: list):
        key, valid, out, count, tokens = (np.concatenate(x) for x in zip(*held, strict=True))
        vocab, number = np.unique(tokens, return_inverse=True)
        yield _rows([(TEXTS, chunk, 0, len(tokens), pack(key, valid, out, small(count), small(number), vocab))])

    def run(batches):
        chunk, held, size = TaskContext.get().partitionId() << 24, [], 0
        for rows, data, offs in chunks(batches):
            n = rows.num_rows
            low = LOWER[data]
            s, e, row = words(low, offs)
            count = np.bincount(row, minlength=n)
            ends = np.cumsum(count + 1)
            tokens = np.full(len(s) + n, STOP, _U)
            tokens[np.arange(len(s)) + row] = Spans(low)(s, e)
            keys = rows.column("key")
            held.append((np.asarray(keys.fill_null(0)), np.asarray(keys.is_valid()).astype(np.uint8), np.asarray(rows.column("out")).astype(np.uint8), np.diff(np.append(0, ends)), tokens))
            size += len(tokens)
            if size >= CHUNK_TOKENS:
                yield from flush(chunk, held)
                chunk, held, size = chunk + 1, [], 0
        if held:
            yield from flush(chunk, held)

    return run


def pair_name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a ^ mix(b + _U(1)))


def heavy(number: np.ndarray, count: np.ndarray, names: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of words and pairs with more than 1 / (8 shards) of a chunk's tokens, and how often they occur."""
    size = len(names) - 1
    before = np.empty(len(number), np.int64)
    before[1:] = number[:-1]
    before[np.cumsum(count) - count] = size
    least = len(number) / (8 * shards)
    often = np.bincount(before, minlength=size + 1)
    some = often > least
    pair, n = np.unique(before[some[before]] * (size + 1) + number[some[before]], return_counts=True)
    pair, n = pair[n > least], n[n > least]
    one = np.flatnonzero(some)
    return np.append(names[one], pair_name(names[pair // (size + 1)], names[pair % (size + 1)])), np.append(often[one], n)


def _name(shards: int):
    """Each chunk's distinct words with their training counts, by shard; and what is heavy in it."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                chunk = b.column("key")[i].as_py()
                _, _, out, count, number, vocab = unpack(b.column("data")[i].as_buffer())
                count, number = count.astype(np.int64), number.astype(np.int64)
                train = np.bincount(number, np.repeat(~out.astype(bool), count), len(vocab)).astype(np.int64)
                at = np.searchsorted(shard_of(vocab, shards), np.arange(shards + 1))
                rows = [(WORDS, chunk, s, 0, pack(vocab[at[s] : at[s + 1]], small(train[at[s] : at[s + 1]]))) for s in range(shards) if at[s + 1] > at[s]]
                names, n = heavy(number, count, np.append(vocab, START), shards)
                rows += [(HEAVY, k, s, x, b"") for k, s, x in zip(names.view(np.int64).tolist(), shard_of(names, shards).tolist(), n.tolist(), strict=True)]
                for k in range(0, len(rows), 256):
                    yield _rows(rows[k : k + 256])

    return run


def _by_part(batches):
    """Rows in the order of their part, as lists of (key, kind, n, data) of one part."""
    held, now = [], None
    for b in batches:
        kinds, parts, keys, ns, data = (b.column(c) for c in ("kind", "part", "key", "n", "data"))
        for i in range(b.num_rows):
            part = parts[i].as_py()
            if held and part < now:
                raise ValueError("rows aren't in the order of their part")
            if held and part != now:
                yield now, held
                held = []
            now = part
            held.append((keys[i].as_py(), kinds[i].as_py(), ns[i].as_py(), data[i].as_buffer()))
    if held:
        yield now, held


def _count(shards: int):
    """Shards of words: each chunk's answer (counts and numbers in its order), the shard's totals, sums of what is heavy."""

    def run(batches):
        for part, rows in _by_part(batches):
            load: dict[int, int] = {}
            for key, kind, n, _ in rows:
                if kind == HEAVY:
                    load[key] = load.get(key, 0) + n
            if load:
                yield _rows([(HEAVY, k, part, n, b"") for k, n in load.items()])
            asked = [(key, *unpack(data)) for key, kind, _, data in rows if kind == WORDS]
            if not asked:
                continue
            vocab, number = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
            total = np.bincount(number, np.concatenate([a[2] for a in asked]), len(vocab)).astype(np.int64)
            rank = np.empty(len(vocab), _U)
            rank[np.argsort(-total, kind="stable")] = np.arange(len(vocab), dtype=_U)
            ids = rank * _U(shards) + _U(part + 2)  # frequent words have small numbers; 0 and 1 are the start and the padding
            yield _rows([(TOTALS, int((total > 0).sum()), part, int(total.sum()), b"")])
            at = 0
            for chunk, v, _ in asked:
                own = number[at : at + len(v)]
                yield _rows([(COUNTS, chunk, part, 0, pack(total[own], ids[own]))])
                at += len(v)
        release()

    return run


class Chunk:
    """A chunk's tokens with the global counts of its words, and its distinct trigrams in shard order.

    Token t stands for the trigram (word before, t, word after), the ends padded, so that
    every bigram of the chunk is the beginning of one of them.
    """

    def __init__(self, texts, counts: list[tuple[int, bytes]], n: int, v: int, shards: int, hot: np.ndarray):
        self.key, self.valid, self.out, count, token, vocab = unpack(texts)
        self.count, self.token = count.astype(np.int64), token.astype(np.int64)
        of, ids = (np.concatenate(x) for x in zip(*(unpack(d) for _, d in sorted(counts, key=lambda x: x[0])), strict=True))
        self.uni, self.known = (of + 1) / (n + v + 1), of > 0
        size = len(vocab)
        names, self.ids = np.append(vocab, [START, PAD]), np.append(ids, np.array([0, 1], _U))
        stop = np.searchsorted(vocab, STOP)
        self.total = np.append(of, [of[stop], 0])  # there are as many starts as ends
        self.start = np.cumsum(self.count) - self.count
        before, after = np.empty(len(self.token), np.int64), np.empty(len(self.token), np.int64)
        before[1:], after[:-1] = self.token[:-1], self.token[1:]
        before[self.start], after[self.start + self.count - 1] = size, size + 1
        pair, number = np.unique(before * (size + 2) + self.token, return_inverse=True)
        triple, self.number = np.unique(number * (size + 2) + after, return_inverse=True)
        w = triple % (size + 2)
        pair = pair[triple // (size + 2)]
        u, v_ = pair // (size + 2), pair % (size + 2)
        warm = np.isin(names, hot)
        self.warm = warm[u]
        self.hot_pair = np.zeros(len(u), bool)
        if warm.any():
            k = np.flatnonzero(self.warm)
            name = pair_name(names[u[k]], names[v_[k]])
            both = np.isin(name, hot)
            self.hot_pair[k] = both
            where = names[u]
            where[k] = np.where(both, pair_name(name, names[w[k]]), name)
            shard = shard_of(where, shards)
            order = np.argsort(shard, kind="stable")
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            self.number = back[self.number]
            u, v_, w, shard, self.warm, self.hot_pair = u[order], v_[order], w[order], shard[order], self.warm[order], self.hot_pair[order]
        else:
            shard = shard_of(names[u], shards)
        self.u, self.v, self.w = u, v_, w
        new = np.append(True, (u[1:] != u[:-1]) | (shard[1:] != shard[:-1]))[: len(u)]
        self.first = np.flatnonzero(new)
        new_pair = new | np.append(True, v_[1:] != v_[:-1])[: len(u)]
        self.second = np.flatnonzero(new_pair)
        self.first_of, self.second_of = np.cumsum(new) - 1, np.cumsum(new_pair) - 1
        self.at = np.searchsorted(shard, np.arange(shards + 1))
        train = np.repeat(~self.out.astype(bool), self.count)
        self.train = np.bincount(self.number, train, len(u)).astype(np.int64)

    def requests(self):
        """(shard, its trigrams): contexts, pairs and successors as runs, in numbers of a small vocabulary."""
        for s in np.flatnonzero(np.diff(self.at)).tolist():
            a, b = self.at[s], self.at[s + 1]
            f, p = (x[slice(*np.searchsorted(x, [a, b]))] for x in (self.first, self.second))
            ids, number = np.unique(self.ids[np.concatenate([self.u[f], self.v[p], self.w[a:b]])], return_inverse=True)
            number = small(number)
            of_pair = np.diff(np.append(np.searchsorted(p, f), len(p)))
            of_word = np.diff(np.append(p, b))
            parts = [number[: len(f)], number[len(f) : len(f) + len(p)], number[len(f) + len(p) :]]
            yield s, pack(small(np.diff(ids, prepend=_U(0))), self.total[self.u[f]], self.warm[f], self.hot_pair[p], parts[0], small(of_pair), parts[1], small(of_word), parts[2], small(self.train[a:b]))

    def scores(self, codes: list[tuple[int, bytes]]) -> np.ndarray:
        """log10 probability of each token."""
        back1, alpha2, back2, alpha3 = (np.concatenate(x) for x in zip(*(unpack(d) for _, d in sorted(codes, key=lambda x: x[0])), strict=True))
        weight = lambda c: np.where(c == 0, 1.0, value(c))  # noqa: E731  a context never seen leaves all to the shorter one
        pair = self.second_of[self.number]
        alpha2 = _together(alpha2, self.total[self.u[self.second]])
        two = value(alpha2[pair]) + weight(back1[self.first_of[self.number]]) * self.uni[self.token]
        p = two.copy()
        later = np.ones(len(p), bool)
        later[self.start] = False
        t = np.flatnonzero(later)
        p[t] = value(alpha3[self.number[t - 1]]) + weight(back2[pair[t - 1]]) * two[t]
        return np.log10(p)


def _ask(n: int, v: int, shards: int, hot: np.ndarray):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                counts = [(x["part"], x["data"]) for x in b.column("counts")[i].as_py()]
                c = Chunk(b.column("data")[i].as_buffer(), counts, n, v, shards, hot)
                key, rows = b.column("key")[i].as_py(), []
                for s, data in c.requests():
                    rows.append((WORDS, key, s, 0, data))
                    if len(rows) == 64:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)
                del c, rows
                release()

    return run


class Request:
    """One chunk's trigrams in a shard: words as ids, runs as the owners of what follows."""

    def __init__(self, data):
        steps, total, warm, hot, first, pairs, second, words_, third, train = unpack(data)
        self.ids = np.cumsum(steps, dtype=_U)
        self.first, self.second, self.third, self.train, self.total = first, second, third, train, total
        self.warm, self.hot = warm.astype(bool), hot.astype(bool)
        self.pair_of, self.of = (np.repeat(np.arange(len(x), dtype=np.int32), n) for x, n in ((first, pairs), (second, words_)))


class Shard:
    """The distinct trigrams of a shard's requests, merged: runs of contexts, pairs and successors, with training counts."""

    def __init__(self, requests: list[Request]):
        self.ids, number = np.unique(np.concatenate([r.ids for r in requests]), return_inverse=True)
        m, at = len(self.ids), 0
        rows = []
        for r in requests:
            name = number[at : at + len(r.ids)]
            at += len(r.ids)
            rows.append((name[r.first[r.pair_of]] * m + name[r.second], name[r.third], r.of, r.warm[r.pair_of], r.hot, r.total[r.pair_of]))
        pair, pair_back = np.unique(np.concatenate([x[0] for x in rows]), return_inverse=True)
        self.pair_back = pair_back.astype(np.int32)
        ends = np.cumsum([0, *(len(x[0]) for x in rows)])
        triple = np.concatenate([pair_back[e + x[2]] * m + x[1] for x, e in zip(rows, ends, strict=False)])
        warm, hot, total = (np.concatenate([x[i] for x in rows]) for i in (3, 4, 5))
        del rows, pair_back, number
        triple, back = np.unique(triple, return_inverse=True)
        self.back = back.astype(np.int32)
        del back
        self.count = np.bincount(self.back, np.concatenate([r.train for r in requests]), len(triple)).astype(np.int64)
        self.of, self.third = triple // m, triple % m
        first = pair // m
        self.second = pair % m
        new = np.append(True, first[1:] != first[:-1])[: len(first)]
        self.first, self.pair_of = first[new], np.cumsum(new) - 1
        self.warm, self.hot, self.total = np.zeros(len(self.first), bool), np.zeros(len(pair), bool), np.zeros(len(self.first), np.int64)
        self.hot[self.pair_back[hot]] = True
        self.warm[self.pair_of[self.pair_back[warm]]] = True
        self.total[self.pair_of[self.pair_back]] = total
        self.seen = np.bincount(self.of, self.count, len(pair)).astype(np.int64)
        self.kinds = np.bincount(self.of, self.count > 0, len(pair)).astype(np.int64)

    def dealt(self) -> list[tuple[int, int, int, int]]:
        """This shard's part of what is dealt out: (word, follower or -1, different successors, occurrences)."""
        pairs = np.flatnonzero(self.hot)
        own = np.bincount(self.pair_of, (self.seen > 0) & ~self.hot, len(self.first)).astype(np.int64)  # hot pairs are in several shards
        ids = self.ids.astype(np.int64)
        out = [(a, -1, k, 0) for a, k in zip(ids[self.first[self.warm]].tolist(), own[self.warm].tolist(), strict=True)]
        a, b = ids[self.first[self.pair_of[pairs]]], ids[self.second[pairs]]
        return out + list(zip(a.tolist(), b.tolist(), self.kinds[pairs].tolist(), self.seen[pairs].tolist(), strict=True))

    def trie(self, words_: dict[int, int], pairs: dict[tuple[int, int], tuple[int, int]]) -> Trie:
        """``words_``: different successors of words dealt out; ``pairs``: those, and occurrences, of pairs dealt out."""
        ids = self.ids.astype(np.int64)
        seen, kinds = self.seen.copy(), self.kinds.copy()
        for i in np.flatnonzero(self.hot).tolist():
            kinds[i], seen[i] = pairs[int(ids[self.first[self.pair_of[i]]]), int(ids[self.second[i]])]
        after = np.bincount(self.pair_of, seen > 0, len(self.first)).astype(np.int64)
        for i in np.flatnonzero(self.warm).tolist():
            after[i] = words_[int(ids[self.first[i]])]
        # a context with a total has successors, here or in other shards
        one, two, three = np.flatnonzero(self.total > 0), np.flatnonzero(seen > 0), np.flatnonzero(self.count > 0)
        rank = np.cumsum(self.total > 0) - 1
        rank2 = np.cumsum(seen > 0) - 1
        back1 = np.minimum(DISCOUNT * np.maximum(after[one], 1) / self.total[one], 1)
        alpha2 = (seen[two] - DISCOUNT) / self.total[self.pair_of[two]]
        back2 = DISCOUNT * np.maximum(kinds[two], 1) / seen[two]
        alpha3 = (self.count[three] - DISCOUNT) / seen[self.of[three]]
        codes = [quantised(x) for x in (back1, alpha2, back2, alpha3)]
        return Trie(self.first[one], rank[self.pair_of[two]], self.second[two], rank2[self.of[three]], self.third[three], codes)

    def answers(self, requests: list[Request], trie: Trie):
        """The codes of each request, in its order: each distinct n-gram is searched once."""
        back1, alpha2, back2, alpha3 = trie.query(self.first, self.pair_of, self.second, self.of, self.third)
        p = t = 0
        for r in requests:
            pair, own = self.pair_back[p : p + len(r.second)], self.back[t : t + len(r.third)]
            p, t = p + len(r.second), t + len(r.third)
            lead = pair[np.flatnonzero(np.append(True, r.pair_of[1:] != r.pair_of[:-1]))]
            yield pack(back1[self.pair_of[lead]], _apart(alpha2[pair], r.total[r.pair_of]), back2[pair], alpha3[own])


def _dealt(batches):
    """Rows (word, follower or -1, different successors, occurrences) of what is dealt out."""
    for _, rows in _by_part(batches):
        requests = [r for r in (Request(data) for _, kind, _, data in rows if kind == WORDS) if r.warm.any()]
        if requests and (got := Shard(requests).dealt()):
            cols = list(zip(*got, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "kinds", "seen"])
    release()


def _answer(batches):
    """Rows of shards, each after a mark with the totals of what is dealt out, to the codes of each request."""
    totals: dict[tuple[int, int], tuple[int, int]] = {}

    def noting():
        for k, b in enumerate(batches):
            if k == 0 and b.num_rows:
                totals.update({(r["a"], r["b"]): (r["kinds"], r["seen"]) for r in b.column("hot")[0].as_py()})
            yield b

    words_, pairs = None, {}
    for part, rows in _by_part(noting()):
        if words_ is None:
            pairs = {ab: x for ab, x in totals.items() if ab[1] >= 0}
            words_ = {a: kinds for (a, b), (kinds, _) in totals.items() if b < 0}
            for (a, _), (_, seen) in pairs.items():  # each counts once, wherever its successors are
                words_[a] += seen > 0
        asked = [(key, data) for key, kind, _, data in rows if kind == WORDS]
        if not asked:
            continue
        requests = [Request(data) for _, data in asked]
        shard = Shard(requests)
        for (chunk, _), codes in zip(asked, shard.answers(requests, shard.trie(words_, pairs)), strict=True):
            yield _rows([(COUNTS, chunk, part, 0, codes)])
        del requests, shard
        release()


def _score(n: int, v: int, shards: int, hot: np.ndarray, key: str):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                lists = lambda c: [(x["part"], x["data"]) for x in b.column(c)[i].as_py()]  # noqa: B023, E731
                c = Chunk(b.column("data")[i].as_buffer(), lists("counts"), n, v, shards, hot)
                total = lambda x: np.add.reduceat(x, c.start)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c.key, mask=c.valid == 0), pa.array(c.out.astype(bool)), pa.array(c.count), pa.array(total(c.known[c.token].astype(np.int64))),
                        pa.array(np.full(len(c.start), n, np.int64)), pa.array(total(np.log10(c.uni)[c.token])), pa.array(total(c.scores(lists("codes")))),
                    ],
                    [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )
                del c
                release()

    return run


def scores(docs: DataFrame, key: str = "doc_id", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every whole text; ``key`` is a whole number."""
    spark = docs.sparkSession
    # as many buckets as the input needs, where its size is known, and at least what the session shuffles into
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES) if size < 1 << 50 else 0)
    buckets = min(buckets, MOST_BUCKETS)
    batch = spark.conf.get(ARROW_ROWS)
    arrow_rows(spark)
    src = docs.select(F.col(key).cast("bigint").alias("key"), held_out(key, 7).alias("out"), "text")
    # chunks are bucketed by their number, so that what comes back to them moves and they don't
    name = f"tidemark_chunks_{uuid.uuid4().hex}"
    cut = src.mapInArrow(_read(), SCHEMA).select("key", "n", "data")
    cut.write.option("path", f"{shared_dir(spark)}/{name}").option("compression", "zstd").bucketBy(buckets, "key").saveAsTable(name)
    texts = spark.table(name)
    try:
        arrow_rows(spark, 1)  # rows are chunks, or a chunk's part of a shard
        tokens = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        shards = max(buckets, -(-tokens // shard_tokens))
        dealt_out = lambda df: df.repartition(shards, "part").sortWithinPartitions("part")
        counted = durable(dealt_out(texts.mapInArrow(_name(shards), SCHEMA)).mapInArrow(_count(shards), SCHEMA), "lm-words")
        n, v = counted.where(F.col("kind") == TOTALS).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("key"), F.lit(0))).first()
        # at most 16 a shard: each has a share of the tokens
        busy = counted.where(F.col("kind") == HEAVY).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") * 8 * shards > tokens)
        hot = np.array(sorted(r["key"] for r in busy.collect()), np.int64).view(_U)
        listed = lambda df, name: df.where(F.col("kind") == COUNTS).groupBy("key").agg(F.collect_list(F.struct("part", "data")).alias(name))
        known = texts.drop("n").join(listed(counted, "counts"), "key")
        marks = spark.range(shards).select(F.lit(MARK).alias("kind"), F.lit(0).cast("bigint").alias("key"), F.col("id").cast("int").alias("part"), F.lit(0).cast("bigint").alias("n"), F.lit(b"").alias("data"))
        asked = known.mapInArrow(_ask(n, v, shards, hot), SCHEMA).unionByName(marks).repartition(shards, "part")
        shared = asked.sortWithinPartitions("part").mapInArrow(_dealt, "a bigint, b bigint, kinds bigint, seen bigint").groupBy("a", "b").agg(F.sum("kinds").alias("kinds"), F.sum("seen").alias("seen"))
        # one row, at most 16 totals a shard, for the mark of each shard; both sides have the same exchange, for Spark to reuse
        shared = shared.agg(F.collect_list(F.struct("a", "b", "kinds", "seen")).alias("hot"))
        met = asked.join(F.broadcast(shared), F.col("kind") == MARK, "left").sortWithinPartitions("part", F.col("kind").desc())
        answered = met.mapInArrow(_answer, SCHEMA)
        done = known.join(listed(answered, "codes"), "key").mapInArrow(_score(n, v, shards, hot, key), f"`{key}` bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
        return durable(done, "lm-scores")
    finally:
        spark.conf.set(ARROW_ROWS, batch)
        spark.sql(f"drop table if exists {name}")
