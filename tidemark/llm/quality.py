"""Quality by positive-unlabelled learning.

Trusted positives are training rows labelled 1; everything else is unlabelled web text,
good and bad.  A small network on numbers taken from the whole text minimises the
non-negative unbiased risk  pi R+(+1) + max(0, Ru(-1) - pi R+(-1)),  where pi, the share
of good text among the unlabelled, is estimated: the smallest ratio, over thresholds,
of the unlabelled to the positives that score above it.  No negative label is used.

The network is fitted on bounded samples (``POSITIVES``, ``UNLABELLED``), the unlabelled
ones from all documents, held-out texts included, since no label of theirs is read.  The
final estimate of pi scores every document, in one pass that counts them between
thresholds.

Defined cases: null and empty texts have their own numbers (no words) and a score;
repeated rows get equal scores; without positives or unlabelled text every score is 0.5;
texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .host_rules import SYMBOLS, count_text
from .labelled import held_out, sample, thinned
from .store import arrow_rows
from .textbytes import Spans, chunks, per_row, within, words

#: Rows of the trusted positives and of the unlabelled text to learn from, at most about twice as many.
POSITIVES, UNLABELLED = 6000, 9000

#: Classes of bytes: lower case, upper case, digit, space, line break, sentence marks, symbols, other ASCII, beyond ASCII.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[128:] = 8
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = 5
_CLASS[SYMBOLS] = 6
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_CLASS[48:58] = 2
_CLASS[65:91] = 1
_CLASS[97:123] = 0
CLASSES = 9


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Numbers of each text: shares of odd words, repetition, and frequencies of byte class pairs."""
    n = len(offs) - 1
    got = count_text(data, offs)
    s, e, row = words(data, offs)
    nw = np.maximum(got["n_words"], 1).astype(float)
    size = np.maximum(np.diff(offs), 1).astype(float)
    cls = _CLASS[data]
    among = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    has = lambda mask: (among(mask)[e] - among(mask)[s]) if len(s) else np.zeros(0, int)
    upper, lower, digit, symbol, marks = (has(cls == 1), has(cls == 0), has(cls == 2), has(cls == 6), has(data == ord("!")))
    part = lambda mask: per_row(row[mask], n) / nw
    h = Spans(data)(s, e)
    again = np.zeros(len(s), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    first = np.unique(within(row, h), return_index=True)[1] if len(s) else np.zeros(0, int)
    cols = [
        part(symbol > 0), part(symbol == (e - s)), part((upper > 1) & (lower == 0)), part(marks > 1), part(digit > 0), part(again),
        np.bincount(row[first], minlength=n) / nw, np.log1p(got["n_words"]), got["word_chars"] / nw, np.log1p(got["n_dup_lines"]), got["n_repeat_words"] / nw,
        per_row(row[(e - s) > 30], n) / nw, (got["n_words"] == 0).astype(float),
    ]
    pair = cls[:-1].astype(np.int64) * CLASSES + cls[1:] if len(cls) else np.zeros(0, np.int64)
    owner = np.searchsorted(offs, np.arange(len(data)), "right") - 1
    if len(pair):
        same = owner[1:] == owner[:-1]
        grid = np.bincount(owner[:-1][same] * CLASSES**2 + pair[same], minlength=n * CLASSES**2).reshape(n, -1) / size[:, None]
    else:
        grid = np.zeros((n, CLASSES**2))
    return np.column_stack([*cols, np.sqrt(grid)])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float = 0.5

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray, limit: float = 0.7) -> np.ndarray:
        """The risk's boundary, logit 0, is the score ``limit``."""
        return 1 / (1 + np.exp(-np.clip(self.logits(x) + np.log(limit / (1 - limit)), -40, 40)))


def _descend(p: np.ndarray, u: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray, hidden: int, epochs: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    zp, zu = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    par = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m1, m2 = [np.zeros_like(x) for x in par], [np.zeros_like(x) for x in par]
    step, size, rate = 0, 512, 0.004
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    batches = max(len(zu) // size, 8)
    decay = float(np.clip(100 / len(p) ** 2, 1e-4, 0.1))  # few positives say little about each weight
    for _ in range(epochs):
        for _ in range(batches):
            a, b = zp[rng.integers(0, len(zp), min(size, len(zp)))], zu[rng.integers(0, len(zu), min(size, len(zu)))]
            ha, hb = np.tanh(a @ par[0] + par[1]), np.tanh(b @ par[0] + par[1])
            ga, gb = sig(ha @ par[2] + par[3]), sig(hb @ par[2] + par[3])  # sigmoid loss: l(+1) = 1 - g, l(-1) = g
            negative = gb.mean() - prior * ga.mean()
            da, db = ga * (1 - ga) / len(a), gb * (1 - gb) / len(b)
            if negative >= 0:
                up_a, up_b = -2 * prior * da, db
            else:  # over-fitted: only undo the negative part
                up_a, up_b = prior * da, -db
            grads = [np.zeros_like(x) for x in par]
            for x, h, up in ((a, ha, up_a), (b, hb, up_b)):
                back = np.outer(up, par[2]) * (1 - h * h)
                for g, add in zip(grads, (x.T @ back, back.sum(0), h.T @ up, np.array([up.sum()])), strict=True):
                    g += add
            grads[0] += decay * par[0]
            grads[2] += decay * par[2]
            step += 1
            for i, g in enumerate(grads):
                m1[i] = 0.9 * m1[i] + 0.1 * g
                m2[i] = 0.999 * m2[i] + 0.001 * g * g
                par[i] = par[i] - rate * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, par[0], par[1], par[2], float(par[3][0]), prior)


def thresholds(p: np.ndarray, most: int = 256) -> np.ndarray:
    """Scores of the positives that the estimate of the prior looks at, rising; the highest tenth is too few."""
    p = np.sort(p)
    t = p[: max(1, int(0.9 * len(p)))]
    return np.unique(t[np.linspace(0, len(t) - 1, min(most, len(t))).astype(int)])


def prior_of(p: np.ndarray, t: np.ndarray, above: np.ndarray, n: int) -> float:
    """Best-bin estimate: the smallest upper bound, over thresholds, of unlabelled (``above`` of ``n``) over positives at or above them."""
    qp, qu = 1 - np.searchsorted(np.sort(p), t, "left") / len(p), above / n
    slack = np.sqrt(np.log(20) / (2 * n)) + np.sqrt(np.log(20) / (2 * len(p)))
    best = np.argmin((qu + slack) / qp)
    return float(np.clip(qu[best] / qp[best], 0.02, 0.98))


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    t = thresholds(p)
    return prior_of(p, t, len(u) - np.searchsorted(np.sort(u), t, "left"), len(u))


def fit(p: np.ndarray, u: np.ndarray, hidden: int = 16, epochs: int = 25, seed: int = 7, everywhere: Callable[[Model, np.ndarray], tuple[np.ndarray, int]] | None = None) -> Model:
    """``everywhere``: how many of all texts a model scores at or above each threshold, and how many there are; else the sample stands for them."""
    both = np.concatenate([p, u]) if len(p) + len(u) else np.zeros((1, p.shape[1]))
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    if not len(p) or not len(u):
        return Model(mean, scale, np.zeros((p.shape[1], 1)), np.zeros(1), np.zeros(1), float(np.log(3 / 7)))
    rng = np.random.default_rng(seed)
    hold_p, hold_u = rng.random(len(p)) < 0.3, rng.random(len(u)) < 0.3
    prior = 0.5
    for last in (False, True):  # a first estimate to learn with, then a better one
        m = _descend(p[~hold_p], u[~hold_u], prior, mean, scale, hidden, max(5, epochs // 2), seed)
        if hold_p.any() and last and everywhere is not None:
            own = m.logits(p[hold_p])
            prior = prior_of(own, t := thresholds(own), *everywhere(m, t))
        elif hold_p.any() and hold_u.any():
            prior = estimate_prior(m.logits(p[hold_p]), m.logits(u[hold_u]))
    return _descend(p, u, prior, mean, scale, hidden, epochs, seed + 1)


def count_above(docs: DataFrame, model: Model, t: np.ndarray) -> tuple[np.ndarray, int]:
    """Of all documents, how many score at or above each threshold, and how many there are: a short histogram a task, summed."""

    def run(batches):
        total = np.zeros(len(t) + 1, np.int64)
        for _, data, offs in chunks(batches):
            total += np.bincount(np.searchsorted(t, model.logits(features(data, offs)), "right"), minlength=len(t) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["bin", "n"])

    got = docs.select("text").mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect()  # at most 257 rows
    n = np.zeros(len(t) + 1, np.int64)
    for r in got:
        n[r["bin"]] = r["n"]
    return np.cumsum(n[::-1])[::-1][1:], int(n.sum())


def _matrix(docs: DataFrame, key: str) -> np.ndarray:
    def run(batches):
        for rows, data, offs in chunks(batches):
            x = features(data, offs)
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([rows.column(key), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], [key, "x"])

    arrow_rows(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    got = docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, x array<double>").toArrow().sort_by(key)
    width = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    return np.asarray(got.combine_chunks().column("x").chunk(0).flatten()).reshape(-1, width) if got.num_rows else np.zeros((0, width))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """From bounded samples, on the driver; the class prior from all documents."""
    p = _matrix(sample(docs.select(key, "text"), labels, label, {1: positives}, key), key)
    u = _matrix(thinned(docs.where(F.col(key).isNotNull()), key, unlabelled, 5), key)
    return fit(p, u, everywhere=lambda model, t: count_above(docs, model, t))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", limit: float = 0.7) -> DataFrame:
    """``(key, held_out, score, predicted)`` of each whole text."""
    arrow_rows(docs.sparkSession)

    def run(batches):
        for rows, data, offs in chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(key), pa.array(model.score(features(data, offs), limit))], [key, "score"])

    out = docs.select(key, "text").mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")
    return out.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", limit: float = 0.7) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    arrow_rows(docs.sparkSession)
    model = train(docs, labels, key)

    def run(batches):
        for rows, data, offs in chunks(batches):
            yield rows.filter(pa.array(model.score(features(data, offs), limit) >= limit))

    return docs.mapInArrow(run, docs.schema)
