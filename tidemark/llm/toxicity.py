"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of the hashed embeddings of the word and of two of its
prefixes.  Filters one, two and three words wide slide over the text, the largest answer
of each filter is kept, and a logistic layer gives the score.  For scoring, each filter
column is multiplied into the embedding table beforehand, so a position costs a few
gathers.  Scores are calibrated on a part of the training rows (Platt's scaling), and a
threshold by language is chosen there for the best F1; languages are never inputs of
the score.

Defined cases: null and empty texts, and texts without a letter, get the score of no
evidence; repeated rows get equal scores; without training labels of both classes every
score is the base rate; texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, sample
from .store import arrow_rows
from .textbytes import LOWER, Spans, chunks, mix, words

#: Everything but letters, digits and bytes beyond ASCII ends a word.
GAP = np.ones(256, bool)
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

BUCKETS = 1 << 17
PREFIXES = (6, 8)
#: Training rows of each class, at most about twice as many.
BOUNDS = {1: 2000, 0: 4000}
#: Words of all training texts: what the driver holds is at most 12 bytes a word, whatever the texts' lengths.
MAX_WORDS = 8_000_000
WIDTHS = (1, 2, 3)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (itself and its prefixes; words x 3), and the words' rows."""
    low = LOWER[data]
    s, e, row = words(low, offs, GAP)
    spans = Spans(low)
    cols = [spans(s, e), *(spans(s, np.minimum(s + k, e)) + np.uint64(k) for k in PREFIXES)]
    return np.stack([(mix(c) % np.uint64(BUCKETS)).astype(np.int32) for c in cols], axis=1) if len(s) else np.zeros((0, len(cols)), np.int32), row


@dataclass
class Model:
    table: np.ndarray  # buckets x dims
    filters: list[np.ndarray]  # by width: width x dims x filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] | None = None

    def columns(self) -> list[np.ndarray]:
        """The table times each filter's columns: what one word adds at one place."""
        return [self.table @ f[j] for f in self.filters for j in range(len(f))]

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -40, 40)))


def pooled(cols: list[np.ndarray], n_filters: int, ids: np.ndarray, row: np.ndarray, n: int, bias: np.ndarray, with_place: bool = False):
    """Largest positive answer of each filter by row, zero without one; and the place that gave it (-1: none)."""
    out = np.zeros((n, len(WIDTHS) * n_filters), np.float32)
    place = np.full(out.shape, -1, np.int64)
    count = np.bincount(row, minlength=n)
    k = 0
    for w, width in enumerate(WIDTHS):
        m = len(ids) - width + 1
        if m <= 0:
            break
        answer = np.zeros((m, n_filters), np.float32)
        for j in range(width):
            for c in range(ids.shape[1]):
                answer += cols[k + j][ids[j : j + m, c]]
        k += width
        answer += bias[w * n_filters : (w + 1) * n_filters]
        if width > 1:
            answer[row[:m] != row[width - 1 :]] = -np.inf
        rows = np.flatnonzero(count >= width)
        start = (np.cumsum(count) - count)[rows]
        # a row's places end where the next row's begin; the -inf ones never win
        best = np.maximum.reduceat(answer, start, axis=0) if len(rows) else answer[:0]
        sl = slice(w * n_filters, (w + 1) * n_filters)
        out[rows, sl] = np.maximum(best, 0)
        if with_place and len(rows):
            owner = np.repeat(np.arange(n), count)[:m]
            for f in range(n_filters):
                top = np.full(n, -np.inf, np.float32)
                top[rows] = best[:, f]
                hit = np.flatnonzero((answer[:, f] == top[owner]) & (answer[:, f] > 0))[::-1]
                place[owner[hit], w * n_filters + f] = hit  # the first one stays
    return (out, place) if with_place else out


def fit(ids: list[np.ndarray], y: np.ndarray, lang: list[str], dims: int = 8, n_filters: int = 6, epochs: int = 10, batch: int = 128, rate: float = 0.02, seed: int = 7) -> Model:
    """Adam on log loss; embeddings start at the buckets' smoothed log odds."""
    rng = np.random.default_rng(seed)
    table = np.zeros((BUCKETS, dims), np.float32)
    filters = [rng.normal(0, 0.3 / w, (w, dims, n_filters)).astype(np.float32) for w in WIDTHS]
    bias = np.zeros(len(WIDTHS) * n_filters, np.float32)
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    model = Model(table, filters, bias, np.zeros(len(bias), np.float32), base)
    if not 0 < y.sum() < len(y):
        return model
    check = rng.random(len(y)) < 0.2
    learn = np.flatnonzero(~check)
    seen = [np.unique(x) for x in ids]
    pos = np.bincount(np.concatenate([seen[i] for i in learn if y[i]] or [np.zeros(0, int)]), minlength=BUCKETS) + 0.2
    neg = np.bincount(np.concatenate([seen[i] for i in learn if not y[i]] or [np.zeros(0, int)]), minlength=BUCKETS) + 0.2
    known = (pos + neg) > 0.5
    odds = np.log(pos / (y[learn].sum() + 0.4)) - np.log(neg / ((1 - y[learn]).sum() + 0.4))
    odds[pos + neg < 2.5] = 0  # one document says little
    table[:, 0] = np.clip(odds, -3, 4) * known / 4
    table[:, 1:] = rng.normal(0, 0.02, (BUCKETS, dims - 1)) * known[:, None]
    for f in filters:
        f[:, 0, 0] = 1.0
    model.out += rng.normal(0, 0.1, len(bias)).astype(np.float32)
    model.out[:: n_filters] = 1.0

    params = [table, *filters, bias, model.out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
    for _ in range(epochs):
        rng.shuffle(learn)
        for at in range(0, len(learn), batch):
            part = learn[at : at + batch]
            count = np.array([len(ids[i]) for i in part])
            x = np.concatenate([ids[i] for i in part])
            row = np.repeat(np.arange(len(part)), count)
            cols = [f[j] for f in filters for j in range(len(f))]
            used, back = np.unique(x, return_inverse=True)
            small = [table[used] @ c for c in cols]
            h, place = pooled(small, n_filters, back.reshape(x.shape), row, len(part), bias, True)
            z = h @ model.out + model.out_bias
            d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[part]) * weight[part] / len(part)
            grads = [np.zeros((len(used), dims), np.float32), *[np.zeros_like(f) for f in filters], np.zeros_like(bias), h.T @ d + 1e-4 * model.out]
            dh = np.outer(d, model.out) * (place >= 0)
            grads[-2] += dh.sum(axis=0)
            for w, width in enumerate(WIDTHS):
                for f in range(n_filters):
                    c = w * n_filters + f
                    r = np.flatnonzero(dh[:, c])
                    for j in range(width):
                        words_at = back.reshape(x.shape)[place[r, c] + j]
                        emb = table[used][words_at].sum(axis=1)
                        grads[1 + w][j, :, f] += dh[r, c] @ emb
                        for k in range(x.shape[1]):
                            np.add.at(grads[0], words_at[:, k], dh[r, c][:, None] * filters[w][j, :, f][None, :])
            step += 1
            model.out_bias -= rate * float(d.sum())
            for i, (p, g) in enumerate(zip(params, grads, strict=True)):
                at_rows = used if i == 0 else slice(None)
                m1, m2 = first[i], second[i]
                m1[at_rows] = 0.9 * m1[at_rows] + 0.1 * g
                m2[at_rows] = 0.99 * m2[at_rows] + 0.01 * g * g
                p[at_rows] -= rate * (m1[at_rows] / (1 - 0.9**step)) / (np.sqrt(m2[at_rows] / (1 - 0.99**step)) + 1e-6)
    table[~known] = 0  # words never seen say nothing
    cols = model.columns()
    z = np.array([float(pooled(cols, n_filters, x, np.zeros(len(x), np.int64), 1, bias)[0] @ model.out) + model.out_bias for x in (ids[i] for i in np.flatnonzero(check))])
    yc = y[check]
    if 0 < yc.sum() < len(yc):
        model.scale, model.shift = platt(z, yc)
        model.thresholds = best_thresholds(model.score(z), yc, [lang[i] for i in np.flatnonzero(check)])
    return model


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logits, by Newton steps on smoothed targets."""
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = np.array([((p - t) * z).sum() + 1e-3 * (a - 1), (p - t).sum() + 1e-3 * b])
        q = p * (1 - p)
        h = np.array([[(q * z * z).sum() + 1e-3, (q * z).sum()], [(q * z).sum(), q.sum() + 1e-3]])
        da, db = np.linalg.solve(h, g)
        size = max(1.0, abs(da), abs(db) / 4)
        a, b = a - da / size, b - db / size
    return max(float(a), 1e-3), float(b)


def best_thresholds(score: np.ndarray, y: np.ndarray, lang: list[str]) -> dict[str, float]:
    out = {}
    for name in {"", *lang}:
        own = np.array([name in ("", x) for x in lang])
        s, t = score[own], y[own]
        if 0 < t.sum() < len(t):
            by = np.argsort(-s)
            hit = np.cumsum(t[by])
            f1 = 2 * hit / (np.arange(1, len(by) + 1) + t.sum())
            k = int(np.argmax(f1))
            below = s[by[k + 1]] if k + 1 < len(by) else 0.0
            out[name] = float((s[by[k]] + below) / 2)
    return out


def _lists(docs: DataFrame, extra: list[str]) -> DataFrame:
    def run(batches):
        for rows, data, offs in chunks(batches):
            ids, row = features(data, offs)
            at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows.num_rows))]).astype(np.int32) * ids.shape[1]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in extra), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.ravel()))], [*extra, "ids"])

    arrow_rows(docs.sparkSession)
    src = docs.select(*extra, "text")
    return src.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.select(*extra).schema), "ids array<int>"]))


def within_words(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Of a bounded sample, rows in the order of their key's hash whose words are ``most`` at most, all together; a longer one is passed over."""
    words_ = F.coalesce(F.regexp_count("text", F.lit("[0-9A-Za-z\u0080-\U0010FFFF]+")), F.lit(0)).alias("n")
    sizes = rows.select(key, words_, F.xxhash64(F.lit(3), key).alias("h")).collect()  # rows are bounded
    kept, left = [], most
    for r in sorted(sizes, key=lambda r: (r["h"], str(r[key]))):
        if r["n"] <= left:
            kept.append((r[key],))
            left -= r["n"]
    if len(kept) == len(sizes):
        return rows
    few = rows.sparkSession.createDataFrame(kept, rows.select(F.col(key).alias("_k")).schema).distinct()
    return rows.join(F.broadcast(few), rows[key] == F.col("_k"), "left_semi")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", bounds: dict[int, int] = BOUNDS, max_words: int = MAX_WORDS) -> Model:
    """From a sample of the training rows, bounded by rows and by words, on the driver."""
    some = within_words(sample(docs.select(key, "lang", "text"), labels, label, bounds, key), key, max_words)
    got = _lists(some, [key, "y", "lang"]).toArrow().sort_by(key)
    if not got.num_rows:
        return fit([], np.zeros(0, np.int64), [])
    lists = got.combine_chunks().column("ids").chunk(0)
    flat, at = np.asarray(lists.flatten()), np.asarray(lists.offsets)
    ids = [flat[a - at[0] : b - at[0]].reshape(-1, 1 + len(PREFIXES)) for a, b in zip(at[:-1], at[1:], strict=True)]
    return fit(ids, np.asarray(got.column("y")).astype(np.int64), [x or "" for x in got.column("lang").to_pylist()])


def scored(docs: DataFrame, model: Model, key: str = "doc_id", limit: float = 0.3) -> DataFrame:
    """``(key, held_out, score, predicted, lang_threshold, flagged)`` of each whole text."""
    arrow_rows(docs.sparkSession)
    n_filters = model.filters[0].shape[2]
    # the model has a fixed size: 2**17 buckets of a few numbers, whatever the corpus
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        cols = m.columns()
        for rows, data, offs in chunks(batches):
            ids, row = features(data, offs)
            h = pooled(cols, n_filters, ids, row, rows.num_rows, m.bias)
            yield pa.RecordBatch.from_arrays([rows.column(key), rows.column("lang"), pa.array(m.score(h @ m.out + m.out_bias).astype(np.float64))], [key, "lang", "score"])

    src = docs.select(key, "lang", "text")
    out = src.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, lang string, score double")
    limits = model.thresholds or {}
    threshold = F.lit(limits.get("", limit))
    for name, t in sorted(limits.items()):
        if name:
            threshold = F.when(F.col("lang") == name, t).otherwise(threshold)
    return out.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"), threshold.alias("lang_threshold")).withColumn("flagged", F.col("score") >= F.col("lang_threshold"))
