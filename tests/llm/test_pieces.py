import collections
import itertools
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import pieces
from tidemark.llm.textbytes import column


@pytest.fixture(scope="module")
def v():
    return pieces.Vocabulary(pieces.model_bytes())


def cut(v, texts, seed=1, keys=None):
    data, offs = column(pa.array(texts))
    ids, at = pieces.encode(v, data, offs, np.arange(len(texts)) if keys is None else keys, seed)
    out, where = pieces.decode(v, ids, at)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)], [out[a:b].tobytes().decode() for a, b in zip(where[:-1], where[1:], strict=True)]


TEXTS = ["", "Hello  world\n\n ▁x ▁▁ é 漢字 😀 \x00tab\t", " lead", " ", "a" * 300, "x" * 5000 + " " + "é" * 70, "\n", "\r\n\t", "the the"]


def test_round_trip(v, docs):
    assert cut(v, TEXTS)[1] == TEXTS
    texts = [r.text for r in docs.select("text").collect()]
    assert cut(v, texts)[1] == texts


def test_the_library_decodes_the_same(v):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for text in ("Hello world, über 漢字", "two  spaces\nand a line"):
        assert sp.decode(cut(v, [text])[0][0]) == text


def test_samples_have_the_lattice_distribution(v):
    weight = {tuple(map(ord, p)): w for p, w in zip((v.text_of[i].decode() for i in v.id), v.weight, strict=True)}
    number = {tuple(map(ord, v.text_of[i].decode())): i for i in v.id}
    for word in ("then", "aaaa"):
        text, want = tuple(map(ord, " " + word)), {}
        for k in itertools.product([0, 1], repeat=len(text) - 1):
            ends = [0, *(i + 1 for i, x in enumerate(k) if x), len(text)]
            parts = [text[a:b] for a, b in itertools.pairwise(ends)]
            if all(p in weight for p in parts):
                want[tuple(int(number[p]) for p in parts)] = np.prod([weight[p] for p in parts])
        total, n = sum(want.values()), 20000
        got = collections.Counter(map(tuple, cut(v, [word] * n)[0]))
        assert set(got) <= set(want)
        for k, w in want.items():
            p = w / total
            assert abs(got[k] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3


def test_long_units_in_blocks(v, monkeypatch):
    """The same draws whether a unit counts as short or long, and however it is cut into blocks."""
    texts = ["internationalisation", "aaaaaaaaaaaaaaaa", "x" * 30, "é漢" * 8, "ab" * 14 + "\u2581"]
    short = cut(v, texts)[0]
    monkeypatch.setattr(pieces, "SHORT", 3)
    for block, blocks in ((256, 8192), (5, 8192), (1, 7)):
        monkeypatch.setattr(pieces, "BLOCK", block)
        monkeypatch.setattr(pieces, "BLOCKS", blocks)
        assert cut(v, texts)[0] == short
    longer = ["a" * 3000, "x" * 700 + "y" * 900, "0123456789" * 80]
    monkeypatch.setattr(pieces, "BLOCK", 10**6)
    whole = cut(v, longer)
    monkeypatch.setattr(pieces, "BLOCK", 64)
    assert cut(v, longer) == whole and whole[1] == longer


def test_slices_of_a_long_text(v, docs):
    text = " ".join(r.text for r in docs.limit(20).collect()) + "é漢😀" * 50 + "z" * 500 + " end"
    want = cut(v, [text], keys=np.array([5]))[0][0]
    data, _ = column(pa.array([text]))
    for size in (50, 777, len(data) - 1):
        got = np.concatenate(list(pieces.encode_long(v, data, np.array([5]), 1, size)))
        assert got.tolist() == want
    assert v.bytes_of(np.array(want)) == (" " + text).encode()


def test_queries_slice_long_texts(spark, docs):
    for digest in (True, False):
        a, b = (sorted(map(tuple, pieces.encoded(docs.select("doc_id", "text"), digest=digest, batch=n).collect())) for n in (pieces.BATCH, 1000))
        assert a == b and (not digest or all(r[-1] for r in a))


def test_memory_and_time_of_long_texts():
    """A text of 12 MB and a run of one letter of 2 MB: a bounded peak, in time in proportion."""
    code = """
import resource, sys, time
import numpy as np
from tidemark.llm import pieces
v = pieces.Vocabulary(pieces.model_bytes())
rng = np.random.default_rng(1)
words = np.array(["w" + "".join(rng.choice(list("abcdefghij"), 6)) + " " for _ in range(50000)])
text = "".join(words[rng.integers(0, len(words), 1500000)]) if sys.argv[1] == "words" else "a" * 2000000
data = np.frombuffer(text.encode(), np.uint8)
start = time.time()
n = 0
for ids in pieces.encode_long(v, data, np.array([1]), 1, pieces.BATCH):
    n += len(v.bytes_of(ids))
assert n == len(data) + 1
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024, round(time.time() - start, 1), len(data))
"""
    root = str(Path(__file__).resolve().parents[2])
    for kind in ("words", "run"):
        got = subprocess.run([sys.executable, "-c", code, kind], capture_output=True, text=True, cwd=root, timeout=300)
        print(kind, got.stdout, got.stderr[-500:])
        assert got.returncode == 0 and int(got.stdout.split()[0]) < 1000


def test_reproducible_and_seeded(spark, docs):
    a = {r.doc_id: r.ids for r in pieces.encoded(docs).collect()}
    b = {r.doc_id: r.ids for r in pieces.encoded(docs.repartition(7)).collect()}
    c = {r.doc_id: r.ids for r in pieces.encoded(docs, seed=43).collect()}
    assert a == b and a != c
    back = {r.doc_id: r.text for r in pieces.decoded(pieces.encoded(docs)).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}


def test_odd_rows(odd, none):
    got = {}
    for r in pieces.encoded(odd, digest=True).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all(r.lossless for rs in got.values() for r in rs) and got[1][0] == got[1][1] and got[2][0].n_pieces == got[3][0].n_pieces == 0 and got[5][0].n_pieces > 1000
    assert pieces.encoded(none).count() == 0 and pieces.encoded(odd, keep=("lang",)).columns == ["doc_id", "lang", "ids"]
