import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import simhash, similar
from tidemark.llm.textbytes import LOWER, column
from tidemark.llm.simhash import joined_words


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups(texts):
    """Smallest key of each text's group, by all pairs; texts equal in words are alike."""
    label, sets = {i: i for i in texts}, {i: shingles(t) for i, t in texts.items()}
    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if label[a] != label[b] and (x == y or 5 * len(x & y) >= 4 * len(x | y)):
            low, high = sorted((label[a], label[b]))
            label = {i: low if c == high else c for i, c in label.items()}
    return label


def edited(rng, words, n):
    out = list(words)
    for i in rng.choice(len(out), n, replace=False):
        out[i] = f"new{rng.integers(0, 10**9)}"
    return out


def corpus():
    """Copies with one to four edited words of 100 (similarities about 0.65 to 0.95), chains of edits, and others."""
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(60):
        words = [f"w{x}" for x in rng.integers(0, 500, 100)]
        texts.append(words)
        texts += [edited(rng, words, int(rng.integers(1, 5))) for _ in range(3)]
    for _ in range(12):
        texts.append(edited(rng, texts[-1], 1))
    return {i: " ".join(t) for i, t in enumerate(texts)} | {900: "", 901: " \n", 902: "One two", 903: "one  TWO", 904: "one"}


@pytest.mark.parametrize("how", [{}, {"part_rows": 3}])
def test_edited_copies_against_brute_force(spark, how):
    texts = corpus()
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in similar.near_duplicates(df, **how).collect()}
    assert got == groups(texts)


def test_pipeline_stage_drops_edited_copies(spark, sf_dir):
    texts = corpus()
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id for r in corpus_pipeline.one_of_each(spark, df, sf_dir).collect()} == set(groups(texts).values())


def test_documents_against_brute_force(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(docs).collect()} == groups(texts)


def test_tables_find_pairs_at_the_threshold():
    """Sets of 90 shingles of which 80 are common: a similarity of exactly 0.8."""
    rng = np.random.default_rng(4)
    n = 3000
    common = rng.integers(0, 2**64, (n, 80), dtype=np.uint64)
    keys = [similar.table_keys(np.concatenate([common, rng.integers(0, 2**64, (n, 10), dtype=np.uint64)], axis=1).ravel(), np.full(n, 90)) for _ in range(2)]
    assert (keys[0] == keys[1]).any(axis=1).mean() >= 0.998
    assert (keys[0] == np.roll(keys[1], 1, axis=0)).sum() == 0


def test_fingerprints_of_pairs_at_the_threshold_are_within_the_radius():
    """Sets of 4 to 90 shingles with a similarity of just 0.8; unlike ones are mostly beyond."""
    rng = np.random.default_rng(6)
    n = 4000
    for common, more in ((4, (1, 0)), (8, (1, 1)), (40, (5, 5)), (80, (10, 10))):
        h = rng.integers(0, 2**64, (n, common), dtype=np.uint64)
        fps = [simhash.majority(np.concatenate([h, rng.integers(0, 2**64, (n, k), dtype=np.uint64)], axis=1).ravel(), np.full(n, common + k)) for k in more]
        assert (np.bitwise_count(fps[0] ^ fps[1]) <= similar.RADIUS).mean() >= 0.998
        assert (np.bitwise_count(fps[0] ^ np.roll(fps[1], 1)) <= similar.RADIUS).mean() < 0.05


def test_large_shard_with_chains(spark):
    """One shard in many parts: most texts near the first, some only near those, some near neither."""
    rng = np.random.default_rng(7)
    base = [f"w{x}" for x in rng.integers(0, 900, 120)]
    texts = [base] + [edited(rng, base, 1) for _ in range(40)]
    far = base
    for _ in range(8):
        far = edited(rng, far, 2)
        texts += [far, edited(rng, far, 1)]
    texts = {i: " ".join(t) for i, t in enumerate(texts)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for part_rows in (5, 1000):
        assert {r.doc_id: r.component_id for r in similar.near_duplicates(df, part_rows=part_rows).collect()} == groups(texts)


def test_odd_documents(odd, none):
    got = similar.near_duplicates(odd).collect()
    by = {r.doc_id: r.component_id for r in got}
    assert len(got) == 10 and by[1] == by[7] == 1 and by[2] == by[3] == by[4] == 2
    kept = simhash.keep_one(odd, similarity=0.8)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 1 and kept.where("doc_id in (3, 4, 7)").count() == 0
    assert similar.near_duplicates(none).count() == 0


def test_shingle_sets_of_texts():
    texts = ["a b c d e f", "", None, "x", "a b c d e f a b c d e f"]
    data, offs = column(pa.array(texts))
    joined, s, e, row = joined_words(LOWER[data], offs)
    h, number = similar.shingles(joined, s, e, row, len(texts))
    assert number.tolist() == [2, 0, 0, 1, 8] and len(np.unique(h)) == 1 + len(shingles(texts[0]) | shingles(texts[4]))
