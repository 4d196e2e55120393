"""Sampled segmentation into the pieces of a SentencePiece vocabulary, and decoding.

Every segmentation of a text into pieces is a path through a lattice; its weight is the
product of its pieces' weights (Zipf's law over the vocabulary's score order).  Forward
filtering sums the weights of all paths to each position, and backward sampling draws
pieces from the end in proportion to them, so a segmentation is drawn exactly in
proportion to its weight.  The random numbers depend only on the seed, the row key and
the position in the text: the same row is always cut the same way, wherever it runs.

No piece crosses two characters that never stand together inside a piece, so texts fall
apart into short units there without any approximation, and filtering is done once for
each distinct unit of a batch.  A longer text than a batch is read in slices that end
between units.  Longer units are cut into blocks that go forward side by side: each block's
sums are linear in those of the positions before it, so blocks are run for every one of
these first, joined, and run again.  Memory is a fixed amount a batch, and a few bytes a
character of a single unit.  Characters without a piece become byte pieces, and a
literal U+2581 does too, so decoding gives back every text byte for byte.

Defined cases: null and empty texts have no pieces; repeated rows are cut alike; a null
key seeds like any other value; texts of any length are encoded whole, in time that grows
with their length.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_rows
from .textbytes import _BASE, Spans, chunks, mix

#: The vocabulary file, unless the environment or a parameter names another.
MODEL = os.environ.get("TIDEMARK_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
MARK = 0x2581
LITERAL_MARK = 0x110000  # a U+2581 of the text itself: no character has this code
#: Longer units are filtered in blocks of at least ``BLOCK`` positions, at most about ``BLOCKS`` of them.
SHORT, BLOCK, BLOCKS = 32, 256, 8192
_PLACES = np.uint64((1 << 20) - 1)
#: Text bytes of a batch: its lattice takes about a hundred times as much memory.
BATCH = 1 << 20


class Vocabulary:
    """The pieces of a model file's bytes.  ``power``: exponent of Zipf's law; higher is closer to the best segmentation."""

    def __init__(self, model: bytes, power: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = sp.get_piece_size()
        self.byte_id = np.full(256, -1, np.int64)
        self.text_of = [b""] * self.size
        pieces: list[tuple[str, int, float]] = []
        for i in range(self.size):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.text_of[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces.append((p, i, sp.get_score(i)))
                self.text_of[i] = p.replace("▁", " ").encode()
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary has no byte pieces, so unknown characters couldn't be decoded")
        order = sorted(range(len(pieces)), key=lambda k: (-pieces[k][2], pieces[k][1]))
        weight = np.empty(len(pieces))
        weight[order] = (np.arange(len(pieces)) + 2.0) ** -power
        self.unknown_weight = float((len(pieces) + 2.0) ** -power)

        chars = sorted({c for p, _, _ in pieces for c in p})
        self.code = np.zeros(LITERAL_MARK + 1, np.int32)  # 0: not in the vocabulary
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.table = mix(np.arange(1, len(chars) + 2, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        inner = sorted({c for p, _, _ in pieces if len(p) > 1 for c in p})
        self.inner = np.zeros(len(chars) + 1, np.int32)
        self.inner[self.code[[ord(c) for c in inner]]] = np.arange(1, len(inner) + 1)
        self.meets = np.zeros((len(inner) + 1, len(inner) + 1), bool)
        flat = self.code[np.array([ord(c) for p, _, _ in pieces for c in p], np.int64)]
        length = np.array([len(p) for p, _, _ in pieces], np.int64)
        ends = np.cumsum(length)
        joint = np.ones(len(flat), bool)
        joint[ends - 1] = False
        at = np.flatnonzero(joint)
        self.meets[self.inner[flat[at]], self.inner[flat[at + 1]]] = True
        h = Spans(flat, self.table)(ends - length, ends)
        by = np.argsort(h)
        self.hash, self.id, self.weight = h[by], np.array([i for _, i, _ in pieces])[by], weight[by]
        self.longest = int(length.max())  # a state has one edge a length
        if self.longest > 31:
            raise ValueError("pieces of more than 31 characters")
        # rows by their hash's low bits; the few that share a place are found by searching
        self.place = np.full(1 << 20, -1, np.int32)
        low = (self.hash & _PLACES).astype(np.int64)
        self.place[low] = np.arange(len(low))
        self.shared = np.zeros(1 << 20, bool)
        self.shared[low[self.place[low] != np.arange(len(low))]] = True
        self.piece_start = np.concatenate([[0], np.cumsum([len(t) for t in self.text_of])])
        self.piece_bytes = np.frombuffer(b"".join(self.text_of), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        """The pieces' bytes one after another, a block of pieces at a time."""
        out = []
        for k in range(0, len(ids), 1 << 20):
            part = ids[k : k + (1 << 20)]
            size = np.diff(self.piece_start)[part]
            end = np.cumsum(size)
            out.append(self.piece_bytes[np.repeat(self.piece_start[:-1][part] - (end - size), size) + np.arange(end[-1])].tobytes())
        return b"".join(out)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and their rows in ``id`` and ``weight``."""
        low = (h & _PLACES).astype(np.int64)
        at = self.place[low]
        near = np.flatnonzero(at >= 0)
        at, low = at[near].astype(np.int64), low[near]
        more = np.flatnonzero(self.shared[low])
        at[more] = np.minimum(np.searchsorted(self.hash, h[near[more]]), len(self.hash) - 1)
        hit = self.hash[at] == h[near]
        return near[hit], at[hit]


def _codes(text: str) -> np.ndarray:
    """Character codes, spaces as marks."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
    codes[codes == MARK] = LITERAL_MARK
    codes[codes == 32] = MARK
    return codes


def _characters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character codes with the leading mark of each non-empty row; row starts."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "surrogateescape") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
    return _codes("".join(" " + t if t else "" for t in texts)), np.concatenate([[0], np.cumsum([len(t) + (t != "") for t in texts])]).astype(np.int64)


def boundaries(v: Vocabulary, chars: np.ndarray) -> np.ndarray:
    """True where a character can't be in one piece with the one before; the first can't."""
    inner = v.inner[v.code[chars]]
    cut = np.ones(len(chars), bool)
    cut[1:] = ~v.meets[inner[:-1], inner[1:]]
    return cut


def _bytes_of(code: int) -> bytes:
    if code == LITERAL_MARK:
        return chr(MARK).encode()
    if code == MARK:
        return b" "
    if 0xDC80 <= code <= 0xDCFF:  # a byte that was no UTF-8
        return bytes([code - 0xDC00])
    return chr(code).encode("utf-8", "surrogatepass")


def _rank(share: np.ndarray) -> np.ndarray:
    """Lower for what is likelier, in steps of a billionth."""
    return ((1 << 30) - 1) - np.minimum((share * (1 << 30)).astype(np.int64), (1 << 30) - 1)


def lattice(v: Vocabulary, codes: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Edges of the short units that start at ``start``: states, first edge of each, edge lengths, piece rows (-1: bytes), probabilities summed within a state.

    State ``k + i`` is position ``i`` of the unit whose states begin at ``k = cumsum(length)``.
    """
    n = len(start)
    before = np.cumsum(length) - length
    unit = np.repeat(np.arange(n), length)
    off = np.arange(len(unit)) - before[unit]
    pos = start[unit] + off
    spans = Spans(codes, v.table)
    parts = []
    single = np.zeros(len(unit), bool)
    for size in range(1, v.longest + 1):
        sel = np.flatnonzero(off >= size - 1)
        if not len(sel):
            break
        hit, row = v.find(spans(pos[sel] + 1 - size, pos[sel] + 1))
        if size == 1:
            single[sel[hit]] = True
        parts.append((sel[hit], np.full(len(hit), size, np.int32), row))
    lone = np.flatnonzero(~single)
    parts.append((lone, np.ones(len(lone), np.int32), np.full(len(lone), -1)))
    at, size, row = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.argsort(at, kind="stable")
    at, size, row = at[by], size[by], row[by]
    w = np.where(row < 0, v.unknown_weight, v.weight[row])
    first = np.searchsorted(at, np.arange(len(unit) + 1))

    share = np.empty(len(at))
    end, u = off[at] + 1, unit[at]
    alpha = np.zeros((n, SHORT + 1))
    alpha[:, 0] = 1
    near = np.argsort(end.astype(np.uint8), kind="stable")  # by position; a unit's edges stay in order
    stops = np.searchsorted(end[near], np.arange(1, SHORT + 2))
    for i in range(1, SHORT + 1):
        e = near[stops[i - 1] : stops[i]]
        if not len(e):
            break
        ue = u[e]
        p = alpha[ue, i - size[e]] * w[e]
        alpha[:, i] = np.bincount(ue, p, n)
        share[e] = p / alpha[ue, i]
    # a state's likeliest edge first: few steps to the drawn one; an edge's number in its state ends the key
    nth = np.arange(len(at)) - first[at]
    order = np.sort((at << 35) | ((_rank(share)) << 5) | nth)
    likely = first[order >> 35] + (order & 31)
    size, row, share = size[likely], row[likely], share[likely]
    total = np.concatenate([[0], np.cumsum(share)])
    cumulative = total[1:] - total[first[at]]
    cumulative[first[1:] - 1] = 2.0  # a state's last edge takes what rounding leaves
    return before, first, size, row, cumulative


def _random(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Between 0 and 1, from a row's key and a position."""
    return (mix(key + mix(place.astype(np.uint64))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def draw_short(v: Vocabulary, codes: np.ndarray, us: np.ndarray, length: np.ndarray, key: np.ndarray, begin: np.ndarray):
    """Pieces of short units, from the end: unit, piece row (-1: bytes), first character and number among the unit's, counted from its end."""
    _, first_at, which = np.unique(Spans(codes, v.table)(us, us + length), return_index=True, return_inverse=True)
    before, first, size, row, cumulative = lattice(v, codes, us[first_at], length[first_at])
    live, here = np.arange(len(us)), length.copy()
    out = []
    while len(live):
        state = before[which[live]] + here[live] - 1
        u = _random(key[live], begin[live] + here[live])
        edge = first[state]
        more = np.flatnonzero(cumulative[edge] <= u)
        while len(more):
            edge[more] += 1
            more = more[cumulative[edge[more]] <= u[more]]
        here[live] -= size[edge]
        out.append((live, row[edge], us[live] + here[live], np.full(len(live), len(out))))
        live = live[here[live] > 0]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def draw_long(v: Vocabulary, codes: np.ndarray, us: np.ndarray, length: np.ndarray, key: np.ndarray, begin: np.ndarray):
    """The same of long units, whose blocks go forward side by side."""
    width = v.longest
    size = max(BLOCK, -(-int(length.sum()) // BLOCKS))
    number = -(-length // size)
    unit = np.repeat(np.arange(len(us)), number)
    nth = np.arange(len(unit)) - (np.cumsum(number) - number)[unit]
    steps = np.minimum(size, length[unit] - nth * size)
    order = np.argsort(-steps, kind="stable")  # those that still go on come first
    unit, nth, steps = unit[order], nth[order], steps[order]
    before = np.cumsum(length) - length

    def edges(i: int, b: np.ndarray):
        """Weights and piece rows of the pieces that end at the i-th position of the blocks, by length."""
        off = nth[b] * size + i
        pos = us[unit[b]] + off
        weight, row = np.zeros((len(b), width)), np.full((len(b), width), -1, np.int32)
        h = np.zeros(len(b), np.uint64)
        for k in range(1, width + 1):
            h = v.table[codes[np.maximum(pos - k + 1, 0)]] + _BASE * h
            hit, at = v.find(mix(h + np.uint64(k)))
            ok = off[hit] >= k - 1
            weight[hit[ok], k - 1], row[hit[ok], k - 1] = v.weight[at[ok]], at[ok]
        weight[row[:, 0] < 0, 0] = v.unknown_weight
        return weight, row, pos, off

    # a block's sums for each position before it alone, but for the last block of a unit
    state = np.zeros((len(unit), width))
    state[nth == 0, 0] = 1
    inner = np.flatnonzero(nth < number[unit] - 1)
    if len(inner):
        sums = np.tile(np.eye(width), (len(inner), 1, 1))
        for i in range(size):
            new = np.einsum("bk,bkj->bj", edges(i, inner)[0], sums)
            sums = np.concatenate([new[:, None, :], sums[:, :-1]], axis=1)
            sums /= sums.max(axis=(1, 2), keepdims=True)
        place = {(u, k): b for b, (u, k) in enumerate(zip(unit.tolist(), nth.tolist(), strict=True))}
        for j in np.lexsort((nth[inner], unit[inner])).tolist():
            b = inner[j]
            after = sums[j] @ state[b]
            state[place[int(unit[b]), int(nth[b]) + 1]] = after / after.max()
        del sums

    drawn, rows = np.empty(int(length.sum()), np.uint8), np.empty(int(length.sum()), np.int32)
    for i in range(int(steps[0])):
        b = np.arange(np.searchsorted(-steps, -i, "left"))
        weight, row, pos, off = edges(i, b)
        p = weight * state[b]
        total = p.sum(axis=1)
        state[b] = np.concatenate([np.ones((len(b), 1)), state[b, :-1] / total[:, None]], axis=1)
        likely = np.argsort(_rank(p / total[:, None]), axis=1, kind="stable")
        cumulative = np.cumsum(np.take_along_axis(p, likely, axis=1) / total[:, None], axis=1)
        u = _random(key[unit[b]], begin[unit[b]] + off + 1)
        edge = np.minimum((cumulative <= u[:, None]).sum(axis=1), (weight > 0).sum(axis=1) - 1)
        k = likely[b, edge]
        at = before[unit[b]] + off
        drawn[at], rows[at] = k + 1, row[b, k]

    out = []
    for n in range(len(us)):
        sizes = drawn[before[n] : before[n] + length[n]].tolist()
        at, ends = len(sizes), []
        while at > 0:
            ends.append(at)
            at -= sizes[at - 1]
        ends = np.array(ends)
        at = before[n] + ends - 1
        out.append((np.full(len(ends), n), rows[at].astype(np.int64), us[n] + ends - drawn[at], np.arange(len(ends))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def sample(v: Vocabulary, chars: np.ndarray, us: np.ndarray, length: np.ndarray, key: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of units (``begin``: their place in their row), and how many each has."""
    codes = v.code[chars]
    parts = []
    for some, draw in ((np.flatnonzero(length <= SHORT), draw_short), (np.flatnonzero(length > SHORT), draw_long)):
        if len(some):
            unit, *rest = draw(v, codes, us[some], length[some], key[some], begin[some])
            parts.append((some[unit], *rest))
    unit, row, at, nth = (np.concatenate(x) for x in zip(*parts, strict=True))
    count = np.bincount(unit, minlength=len(us))
    place = np.cumsum(count)[unit] - 1 - nth
    flat, lead = np.empty(len(unit), np.int64), np.empty(len(unit), np.int64)
    flat[place], lead[place] = np.where(row >= 0, v.id[row], -1), at

    lost = np.flatnonzero(flat < 0)
    if len(lost):
        codes_lost, back = np.unique(chars[lead[lost]], return_inverse=True)
        as_bytes = [np.frombuffer(_bytes_of(int(c)), np.uint8) for c in codes_lost]
        wide = np.ones(len(flat), np.int64)
        wide[lost] = np.array([len(b) for b in as_bytes])[back]
        at = np.cumsum(wide) - wide
        out = np.repeat(flat, wide)
        table = np.zeros((len(as_bytes), 4), np.int64)
        for i, b in enumerate(as_bytes):
            table[i, : len(b)] = v.byte_id[b]
        for k in range(4):
            sel = wide[lost] > k
            out[at[lost][sel] + k] = table[back[sel], k]
        count = np.bincount(np.repeat(np.repeat(np.arange(len(us)), count), wide), minlength=len(us))
        flat = out
    return flat, count


def encode(v: Vocabulary, data: np.ndarray, offs: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all rows one after another, and the rows' offsets in them."""
    n = len(offs) - 1
    chars, starts = _characters(data, offs)
    if not len(chars):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    cut = boundaries(v, chars)
    cut[starts[starts < len(chars)]] = True
    us = np.flatnonzero(cut)
    row = np.searchsorted(starts, us, "right") - 1
    ids, count = sample(v, chars, us, np.diff(np.append(us, len(chars))), _seeds(keys, seed)[row], us - starts[row])
    return ids, np.concatenate([[0], np.cumsum(np.bincount(row, count, n).astype(np.int64))])


def _seeds(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.view(np.uint64) ^ mix(np.uint64(seed)))


def encode_long(v: Vocabulary, data: np.ndarray, key: np.ndarray, seed: int, size: int):
    """One row's piece ids, in slices of about ``size`` bytes that end between units."""
    own, done = _seeds(key, seed), 0
    held: list[np.ndarray] = []  # characters of a unit that goes on
    at = 0
    while at < len(data):
        upto = min(len(data), at + size)
        back = 0
        while upto < len(data) and back < 3 and data[upto] & 0xC0 == 0x80:
            upto, back = upto - 1, back + 1
        chars = _codes((" " if at == 0 else "") + data[at:upto].tobytes().decode("utf-8", "surrogateescape"))
        cut = boundaries(v, np.append(held[-1][-1:], chars))[1:] if held else boundaries(v, chars)
        at = upto
        ends = np.flatnonzero(cut)
        last = at >= len(data)
        if not last and not len(ends):
            held.append(chars)
            continue
        stop = len(chars) if last else ends[-1]
        lead = sum(map(len, held))
        whole = np.concatenate([*held, chars[:stop]])
        held = [chars[stop:]] if stop < len(chars) else []
        us = ends[ends < stop] + lead
        us = np.append(0, us) if lead else us
        if len(whole):
            yield sample(v, whole, us, np.diff(np.append(us, len(whole))), np.repeat(own, len(us)), us + done)[0]
        done += len(whole)


def decode(v: Vocabulary, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and the rows' offsets; the space of the leading mark goes."""
    size = np.diff(v.piece_start)[ids]
    end = np.cumsum(size)
    data = v.piece_bytes[np.repeat(v.piece_start[:-1][ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
    at = np.concatenate([[0], end])[offs]
    full = np.diff(at) > 0
    keep = np.ones(len(data), bool)
    keep[at[:-1][full]] = False
    return data[keep], at - np.concatenate([[0], np.cumsum(full)])


def model_bytes(path: str = MODEL) -> bytes:
    """Read once on the driver; executors get the bytes."""
    try:
        with open(path, "rb") as f:
            return f.read()
    except FileNotFoundError:
        raise FileNotFoundError(f"no vocabulary at {path}: pass model=, or set TIDEMARK_PIECES") from None


def encoded(docs: DataFrame, key: str = "doc_id", model: str = MODEL, seed: int = 42, power: float = 1.0, digest: bool = False, keep: tuple[str, ...] = (), batch: int = BATCH) -> DataFrame:
    """``(key, keep..., ids)`` of each whole text; with ``digest`` instead ``(key, n_pieces, ids_md5, decoded_sha256, lossless)``."""
    arrow_rows(docs.sparkSession)
    proto, name = model_bytes(model), key
    src = docs.select(F.col(key).alias("key"), F.xxhash64(key).alias("row_seed"), "text", *[F.col(c).alias(f"keep_{c}") for c in keep])

    def cut(v: Vocabulary, rows: pa.RecordBatch, data: np.ndarray, offs: np.ndarray):
        """The rows' ids in one piece, or in slices if there is one long row."""
        seeds = np.asarray(rows.column("row_seed"))
        if rows.num_rows > 1 or len(data) <= batch:
            return encode(v, data, offs, seeds, seed)
        return encode_long(v, data, seeds, seed, batch)

    def long_digest(v: Vocabulary, data: np.ndarray, slices) -> tuple[int, str, str, bool]:
        n, at, same = 0, 0, True
        ids_md5, sha = hashlib.md5(), hashlib.sha256()
        for ids in slices:
            raw = v.bytes_of(ids)[at == 0 :]  # the leading mark's space goes
            ids_md5.update(ids.astype("<i4").tobytes())
            sha.update(raw)
            same &= raw == data[at : at + len(raw)].tobytes()
            n, at = n + len(ids), at + len(raw)
        return n, ids_md5.hexdigest(), sha.hexdigest(), same and at == len(data)

    def run(batches):
        v = Vocabulary(proto, power)
        names = [name, "n_pieces", "ids_md5", "decoded_sha256", "lossless"]
        for rows, data, offs in chunks(batches, size=batch):
            got = cut(v, rows, data, offs)
            if digest and not isinstance(got, tuple):
                yield pa.RecordBatch.from_arrays([rows.column("key"), *(pa.array([x]) for x in long_digest(v, data, got))], names)
                continue
            if not isinstance(got, tuple):
                ids = np.concatenate([x.astype(np.int32) for x in got])
                got = ids, np.array([0, len(ids)])
            ids, at = got
            if not digest:
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([rows.column("key"), *(rows.column(f"keep_{c}") for c in keep), lists], [name, *keep, "ids"])
                continue
            back, where = decode(v, ids, at)
            raw, out, small = data.tobytes(), back.tobytes(), ids.astype("<i4").tobytes()
            pairs = list(zip(where[:-1].tolist(), where[1:].tolist(), offs[:-1].tolist(), offs[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key"), pa.array(np.diff(at)),
                    pa.array([hashlib.md5(small[4 * a : 4 * b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]),
                    pa.array([hashlib.sha256(out[a:b]).hexdigest() for a, b, _, _ in pairs]),
                    pa.array([out[a:b] == raw[c:d] for a, b, c, d in pairs]),
                ],
                names,
            )

    kind = docs.schema[key].dataType.simpleString()
    rest = "n_pieces bigint, ids_md5 string, decoded_sha256 string, lossless boolean" if digest else ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "ids array<int>"])
    return src.mapInArrow(run, f"`{key}` {kind}, {rest}")


def decoded(rows: DataFrame, key: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``(key, text)`` of rows with piece ids; null ids give an empty text."""
    proto, name = model_bytes(model), key

    def run(batches):
        v = Vocabulary(proto)
        for b in batches:
            col = b.column("ids")
            lists = col.to_pylist()
            at = np.concatenate([[0], np.cumsum([len(x or ()) for x in lists])]).astype(np.int64)
            flat = np.fromiter((i for x in lists for i in x or ()), np.int64, at[-1])
            got, where = decode(v, flat, at)
            raw = got.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([raw[a:z] for a, z in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)], pa.binary())], [name, "text"])

    kind = rows.schema[key].dataType.simpleString()
    out = rows.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"`{key}` {kind}, text binary")
    return out.withColumn("text", F.col("text").cast("string"))
