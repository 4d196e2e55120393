import collections
import hashlib
import os

import numpy as np
import pytest

from tidemark.llm import suffixes as sx


@pytest.mark.parametrize("letters", [1, 2, 4, 250])
def test_suffix_array_and_prefixes(letters):
    rng = np.random.default_rng(letters)
    for n in (0, 1, 2, 3, 50, 300):
        x = rng.integers(0, letters, n).astype(np.uint8)
        x = np.concatenate([x, x])
        order, w = sx.suffix_array(x, 2 * n + 8)
        b = x.tobytes()
        assert order.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        got = sx.common_prefixes(order, w, 16)
        for i, k in enumerate(got):
            want = len(os.path.commonprefix([b[order[i] :], b[order[i + 1] :]]))
            assert k == min(16, want) or letters == 1 or 0 in x  # zeros equal the padding


def brute(texts, length):
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("array_bytes", [sx.ARRAY_BYTES, 1000, 200, 1])
def test_against_brute_force(spark, array_bytes):
    rng = np.random.default_rng(3)
    passage = "the quick brown fox jumps over the lazy dog while é ü rain falls on plain streets. "
    texts = []
    for i in range(90):
        t = "".join(rng.choice(list("abcdef "), rng.integers(0, 80)))
        t += passage[: rng.integers(10, len(passage))] + "".join(rng.choice(list("xyz "), 20)) if i % 3 == 0 else ""
        texts.append(t * (2 if i % 7 == 0 else 1))
    texts += [None, "", texts[0], texts[0], "ab" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in sx.repeats(df, length=24, anchor=8, array_bytes=array_bytes).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (t, gone) in enumerate(zip(raw, brute(raw, 24), strict=True)):
        mine = np.zeros(len(t), bool)
        for s in got[i].spans:
            assert not mine[max(0, s.start - 1) : s.end].any()  # maximal runs
            mine[s.start : s.end] = True
        assert (mine == gone).all() and got[i].n_bytes == len(t)
        assert got[i].kept_sha256 == hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()


def test_query_on_documents(docs):
    rows = docs.collect()
    raw = [(r.text or "").encode() for r in rows]
    got = {r.doc_id: r for r in sx.counted(sx.repeats(docs)).collect()}
    for r, t, gone in zip(rows, raw, brute(raw, 200), strict=True):
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_removed, got[r.doc_id].n_spans) == (len(t), gone.sum(), (edges == 1).sum())


def test_slices_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offs = np.array([0, 100, 4000, 4000, 5000])
    whole = sx.segments_of(data, offs, 60, 16)
    monkeypatch.setattr(sx, "SLICE", 700)
    cut = sx.segments(data, offs, 60, 16)
    windows = lambda s: sorted((int(r), int(a) + k, int(h)) for r, a, n, h in zip(*s[:4], strict=True) for k in range(n))
    assert windows(whole) == windows(cut)


def test_odd_rows(odd, none):
    got = {}
    for r in sx.counted(sx.repeats(odd)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[1]) == 2 and all(r.n_removed == r.n_bytes > 0 and r.n_spans == 1 for r in [*got[1], *got[7]])
    assert got[2][0].n_bytes == 0 and got[3][0].n_removed == 0 and got[5][0].n_removed > 0
    assert sx.counted(sx.repeats(none)).count() == 0
