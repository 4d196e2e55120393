import collections
import math
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import ngrams as ng


@pytest.mark.parametrize("universe", [5, 100, 10**6, 2**40, 2**63])
def test_elias_fano(universe):
    rng = np.random.default_rng(universe % 1000)
    for n in (1, 2, 63, 600):
        v = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
        e = ng.EliasFano.of(v, universe)
        assert (e[np.arange(n)] == v).all()
        q = np.concatenate([v, rng.integers(0, universe, 200, dtype=np.uint64)])
        at, hit = e.find(q)
        assert (hit == np.isin(q, v)).all() and (at[hit] == np.searchsorted(v, q)[hit]).all()
        few = ng.EliasFano.of(v, universe)  # one at a time, without reading all positions
        for x in q[::7]:
            (at,), (hit,) = few.find(np.array([x]))
            assert hit == (x in v) and (not hit or v[at] == x)
        assert n < 9 or not few._all


def test_trie():
    """Three levels against a dictionary, with contexts that have no successor here."""
    rng = np.random.default_rng(1)
    grams = sorted({tuple(int(x) for x in g) for g in rng.integers(0, 40, (3000, 3)) ** 2})
    pairs = sorted({g[:2] for g in grams} | {(5000, 3), (5000, 4)})
    first = sorted({p[0] for p in pairs} | {6000})
    of = lambda big, small_: np.array([small_.index(x) for x in big])
    codes = [rng.integers(1, 65535, n).astype(np.uint16) for n in (len(first), len(pairs), len(pairs), len(grams))]
    col = lambda x, i: np.array([y[i] for y in x])
    t = ng.Trie(np.array(first), of([p[0] for p in pairs], first), col(pairs, 1), of([g[:2] for g in grams], pairs), col(grams, 2), codes)
    asked = sorted({tuple(int(x) for x in g) for g in rng.integers(0, 42, (4000, 3)) ** 2} | {(5000, 3, 1), (6000, 1, 1), (9999, 1, 1), (5000, 9999, 0)})
    p, f = sorted({g[:2] for g in asked}), sorted({g[0] for g in asked})
    got = t.query(np.array(f), of([x[0] for x in p], f), col(p, 1), of([g[:2] for g in asked], p), col(asked, 2))
    known = [dict(zip(x, c.tolist(), strict=True)) for x, c in zip((first, pairs, pairs, grams), codes, strict=True)]
    for want, ask, mine in zip(known, (f, p, p, asked), got, strict=True):
        assert mine.tolist() == [want.get(x, 0) for x in ask]


def test_arrays_as_bytes():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.int64), np.array([True, False]), np.arange(300, dtype=np.uint16)]
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, ng.unpack(ng.pack(*arrays)), strict=True))


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def check(df, got, key="doc_id"):
    tok = {r[key]: [*re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOWER)), None] for r in df.collect()}
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in tok}
    c = collections.Counter(w for i in tok if not out[i] for w in tok[i])
    n, v = sum(c.values()), len(c)
    train = [i for i in tok if not out[i]]
    b = collections.Counter(p for i in train for p in zip(["<s>", *tok[i]], tok[i], strict=False))
    tri = collections.Counter(p for i in train for p in zip(["<s>", *tok[i]], tok[i], tok[i][1:], strict=False))
    kinds, kinds2, seen = collections.Counter(p[0] for p in b), collections.Counter(p[:2] for p in tri), collections.Counter(c)
    seen["<s>"] = c[None]
    seen2 = collections.Counter()
    for p, k in tri.items():
        seen2[p[:2]] += k
    part = lambda count, all_, kinds_, p: max(count - ng.DISCOUNT, 0) / all_ + ng.DISCOUNT * kinds_ / all_ * p if all_ else p
    for i, t in tok.items():
        r = got[i]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        score, before = 0, "<s>"
        for k, w in enumerate(t):
            p = part(b[before, w], seen[before], kinds[before], (c[w] + 1) / (n + v + 1))
            if k:
                two = (t[k - 2] if k > 1 else "<s>", before)
                p = part(tri[*two, w], seen2[two], kinds2[two], p)
            score += math.log10(p)
            before = w
        assert abs(r.base_score - base) < 1e-6 * max(1, -base) and (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(c[w] > 0 for w in t), n, out[i])
        assert abs(r.score - score) <= 1.5 / ng.STEPS * len(t)  # half a step each of a probability and of two weights
    return tok, out


def test_against_brute_force(docs, monkeypatch):
    got = {r.doc_id: r for r in ng.scores(docs).collect()}
    _, out = check(docs, got)
    held = [got[i] for i in got if out[i]]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.fixture
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)


def crowded(spark):
    """A word, a pair and a start that are dealt out, in training and held-out texts."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"hot w{rng.integers(0, 20)} rare{rng.integers(0, 400)} hot pair x{rng.integers(0, 300)}" for _ in range(15))) for i in range(60)]
    rows += [(1000 + i, f"hot rare{i} hot unseen{i} w3 hot pair new{i} hot pair x{i}") for i in range(30)] + [(2000, "a a a a a a"), (2001, ""), (2002, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3, "doc_id")


def test_crowded_contexts_against_brute_force(spark, partitions):
    partitions(64)
    df = crowded(spark)
    check(df, {r.doc_id: r for r in ng.scores(df).collect()})


def test_scores_depend_on_the_corpus_only(spark, docs, partitions):
    for df in (crowded(spark), docs):
        first = None
        for n, shard_tokens, rows in ((2, ng.SHARD_TOKENS, df), (8, 2000, df.repartition(7)), (64, 500, df), (3, 10**9, df.coalesce(1))):
            partitions(n)
            got = sorted(tuple(r) for r in ng.scores(rows, shard_tokens=shard_tokens).collect())
            first = first or got
            assert got == first


def test_shards_with_several_chunks(monkeypatch):
    """Chunks of a few tokens, merged in one shard, against chunks in one piece."""
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 6, rng.integers(1, 30)) for _ in range(40)]

    def run(sizes, shards):
        vocab = np.append(ng.mix(np.arange(100, 106, dtype=np.uint64)), ng.STOP)
        total, at, made = sum(np.bincount(t, minlength=6) for t in texts), 0, []
        order = np.argsort(vocab)
        where = np.argsort(order)
        of = np.append(total, len(texts))[order]
        for size in sizes:
            part = texts[at : at + size]
            at += size
            token = np.concatenate([where[np.append(t, 6)] for t in part])
            data = ng.pack(np.arange(size), np.ones(size, np.uint8), np.zeros(size, np.uint8), np.array([len(t) + 1 for t in part]), token, vocab[order])
            made.append(ng.Chunk(data, [(0, ng.pack(of, np.arange(7, dtype=np.uint64) + 2))], int(of.sum()), 7, shards, vocab[:2]))
        asked = [dict(c.requests()) for c in made]
        answers = [[] for _ in made]
        kinds = {}
        merged = {}
        for s in sorted({s for a in asked for s in a}):
            who = [i for i, a in enumerate(asked) if s in a]
            requests = [ng.Request(asked[i][s]) for i in who]
            merged[s] = who, requests, ng.Shard(requests)
            for a, _, k, _ in merged[s][2].dealt():
                kinds[a] = kinds.get(a, 0) + k
        for s, (who, requests, shard) in merged.items():
            for i, codes in zip(who, shard.answers(requests, shard.trie(kinds, {})), strict=True):
                answers[i].append((s, codes))
        return np.concatenate([c.scores(a) for c, a in zip(made, answers, strict=True)])

    want = run([40], 1)
    for sizes, shards in (([40], 5), ([7] * 5 + [5], 1), ([1] * 40, 9)):
        assert np.array_equal(run(sizes, shards), want)


def test_odd_rows(odd, none):
    got = ng.scores(odd).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and by[2].n_tokens == by[3].n_tokens == by[4].n_tokens == 1 and None in by and by[2].score == by[3].score
    assert ng.scores(none).count() == 0
