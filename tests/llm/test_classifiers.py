import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import quality, toxicity
from tidemark.llm.textbytes import column


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.fixture(scope="module")
def larger(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return docs.where("doc_id < 5000"), labels, {r.doc_id: r for r in labels.collect()}


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.99), (toxicity, "toxic", 0.93)])
def test_held_out_rows(larger, module, label, least):
    docs, labels, truth = larger
    got = [r for r in module.scored(docs, module.train(docs, labels)).collect()]
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    y = np.array([truth[r.doc_id][label] for r in held])
    assert auc(np.array([r.score for r in held]), y) > least
    right = np.mean([r.predicted == t for r, t in zip(held, y, strict=True)])
    assert right > max(y.mean(), 1 - y.mean())


def test_held_out_labels_are_not_read(spark, docs, labels):
    from pyspark.sql import functions as F

    from tidemark.llm.labelled import held_out

    broken = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.scored(docs, quality.train(docs, x)).select("doc_id", "score").collect() for x in (labels, broken))
    assert sorted(a) == sorted(b)


def test_pooling_against_a_loop():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50, (40, 3)).astype(np.int32)
    row = np.sort(rng.integers(0, 9, 40))
    m = toxicity.Model(rng.normal(size=(50, 4)).astype(np.float32), [rng.normal(size=(w, 4, 2)).astype(np.float32) for w in toxicity.WIDTHS], rng.normal(size=6).astype(np.float32), np.ones(6, np.float32), 0.0)
    got = toxicity.pooled(m.columns(), 2, ids, row, 9, m.bias)
    for r in range(9):
        emb = m.table[ids[row == r]].sum(axis=1)
        for w, width in enumerate(toxicity.WIDTHS):
            for f in range(2):
                answers = [sum(emb[t + j] @ m.filters[w][j, :, f] for j in range(width)) + m.bias[2 * w + f] for t in range(len(emb) - width + 1)]
                assert abs(got[r, 2 * w + f] - max([0, *answers])) < 1e-4


def test_prior_estimate():
    rng = np.random.default_rng(2)
    p, u = rng.normal(2, 1, 4000), np.concatenate([rng.normal(2, 1, 4200), rng.normal(-3, 1, 1800)])
    assert abs(quality.estimate_prior(p, u) - 0.7) < 0.04


def test_risk_learns_without_negatives():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1.5, 1, (3000, 5)), rng.normal(-1.5, 1, (1500, 5))
    m = quality.fit(good[:1500], np.concatenate([good[1500:], bad]))
    assert (m.logits(good) > 0).mean() > 0.97 and (m.logits(bad) < 0).mean() > 0.97 and abs(m.prior - 0.5) < 0.08


def test_features_by_hand():
    data, offs = column(__import__("pyarrow").array(["A a a %%% HI!! 1\nb\nb", "", None]))
    x = quality.features(data, offs)
    assert x[0, 0] == 1 / 8 and x[0, 1] == 1 / 8 and x[0, 2] == 1 / 8 and x[0, 5] == 2 / 8 and (x[1] == x[2]).all() and x[1, 12] == 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, odd, none, labels, module):
    model = module.train(odd, labels)
    got = module.scored(odd, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got) and by[1].score == by[7].score and by[2].score == by[3].score and by[None].held_out is False
    assert module.scored(none, module.train(none, labels.where("false"))).count() == 0


def test_accepted_keeps_columns(odd, labels):
    assert quality.accepted(odd, labels).columns == odd.columns


# --- whole queries against plain loops over the fitted models ----------------------------

MASK = 2**64 - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def span_hash(raw):
    total, power = 0, 1
    for b in raw:
        total = (total + mix(((b + 1) * 0x9E3779B97F4A7C15) & MASK) * power) & MASK
        power = (power * 0x9E3779B97F4A7C15) & MASK
    return mix((total + len(raw)) & MASK)


def toxicity_by_loop(m, text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    emb = []
    for w in re.findall(rb"[0-9a-z\x80-\xff]+", low):
        grams = [span_hash(w), *((span_hash(w[:k]) + k) & MASK for k in toxicity.PREFIXES)]
        emb.append(sum(m.table[mix(g) % toxicity.BUCKETS].astype(float) for g in grams))
    z, n = m.out_bias, m.filters[0].shape[2]
    for w, width in enumerate(toxicity.WIDTHS):
        for f in range(n):
            answers = [sum(float(emb[t + j] @ m.filters[w][j, :, f]) for j in range(width)) + float(m.bias[w * n + f]) for t in range(len(emb) - width + 1)]
            z += max([0.0, *answers]) * float(m.out[w * n + f])
    return 1 / (1 + math.exp(-(m.scale * z + m.shift)))


def test_toxicity_query_against_a_loop(docs, labels):
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    short = [i for i, (t, _) in texts.items() if len(t or "") < 3000]
    assert len(short) > 100 and set(got) == set(texts)
    for i in short:
        want = toxicity_by_loop(model, texts[i][0])
        limit = (model.thresholds or {}).get(texts[i][1], (model.thresholds or {}).get("", 0.3))
        assert abs(got[i].score - want) < 1e-4 and got[i].predicted == (got[i].score >= 0.3) and got[i].flagged == (got[i].score >= limit)


def quality_features(text):
    """The numbers of a text, one after another, from their descriptions."""
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    n = max(len(words), 1)
    symbols, marks = set(b"#*$%&|<>"), set(b".,;:?'\"-()")

    def kind(b):
        if b >= 128:
            return 8
        if b in symbols:
            return 6
        if b in marks:
            return 5
        if b in (9, 11, 12, 13, 32):
            return 3
        return 4 if b == 10 else 2 if 48 <= b < 58 else 1 if 65 <= b < 91 else 0 if 97 <= b < 123 else 7

    count = lambda w, k: sum(kind(b) == k for b in w)
    share = lambda test: sum(map(bool, map(test, words))) / n
    lines = [x for x in data.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    cols = [
        share(lambda w: count(w, 6)), share(lambda w: count(w, 6) == len(w)), share(lambda w: count(w, 1) > 1 and not count(w, 0)), share(lambda w: w.count(b"!") > 1), share(lambda w: count(w, 2)),
        sum(a == b for a, b in itertools.pairwise(words)) / n, len(set(words)) / n, math.log1p(len(words)), sum(len(w.decode(errors="replace")) for w in words) / n,
        math.log1p(len(lines) - len(set(lines))), len(repeated) / n, share(lambda w: len(w) > 30), float(not words),
    ]
    grid = collections.Counter(map(lambda p: kind(p[0]) * 9 + kind(p[1]), itertools.pairwise(data)))
    return cols + [math.sqrt(grid[k] / max(len(data), 1)) for k in range(81)]


def test_quality_query_against_a_loop(docs, labels):
    m = quality.train(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs, m).collect()}
    rows = docs.collect()
    assert set(got) == {r.doc_id for r in rows}
    for r in rows:
        x = [min(max((a - b) / c, -8), 8) for a, b, c in zip(quality_features(r.text), m.mean.tolist(), m.scale.tolist(), strict=True)]
        z = float(m.b2)
        for h in range(len(m.b1)):
            z += math.tanh(sum(a * float(w) for a, w in zip(x, m.w1[:, h], strict=True)) + float(m.b1[h])) * float(m.w2[h])
        want = 1 / (1 + math.exp(-(z + math.log(7 / 3))))
        assert abs(got[r.doc_id].score - want) < 1e-6 and got[r.doc_id].predicted == (got[r.doc_id].score >= 0.7)


def test_training_is_bounded_by_words(docs, labels):
    from tidemark.llm.labelled import sample

    some = sample(docs.select("doc_id", "lang", "text"), labels, "toxic", toxicity.BOUNDS)
    sizes = {r.doc_id: len(re.findall(r"[0-9A-Za-z\u0080-\U0010FFFF]+", r.text or "")) for r in some.collect()}
    kept = {r.doc_id for r in toxicity.within_words(some, "doc_id", 5000).collect()}
    assert kept < set(sizes) and 3000 < sum(sizes[i] for i in kept) <= 5000
    assert toxicity.within_words(some, "doc_id", 10**9).count() == len(sizes)
    assert toxicity.train(docs, labels, max_words=5000).filters


def test_prior_counts_all_documents(docs, labels):
    m = quality.train(docs, labels)
    t = np.quantile([0.0, 1.0], [0.1, 0.5, 0.9])
    data, offs = column(__import__("pyarrow").array([r.text for r in docs.collect()]))
    logits = m.logits(quality.features(data, offs))
    above, n = quality.count_above(docs.repartition(5), m, t)
    assert n == docs.count() and above.tolist() == [(logits >= x).sum() for x in t]
