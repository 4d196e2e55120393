import re

import corpus_pipeline
from test_similar import groups

from tidemark.llm import mixing, pieces, pii, quality


def test_stages_by_hand(spark, sf_dir, docs, labels):
    """Each stage's decisions against its operator's own, on what the stage before kept."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "pii", "mixing", "pieces"]
    now = docs
    for name, f in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in now.collect()}
        out = f(spark, now, sf_dir)
        rows = out.collect()
        ids = {r.doc_id for r in rows}
        assert ids <= set(before)
        if name != "pieces":
            assert out.columns == docs.columns
        if name == "quality":
            kept = {r.doc_id for r in quality.scored(now, quality.train(now, labels)).collect() if r.predicted}
            assert ids == kept and all(r == before[r.doc_id] for r in rows)
            known = {r.doc_id: r.quality for r in labels.collect()}
            good = [i for i, q in known.items() if q == 1 and i in before]
            assert len(ids & set(good)) >= 0.95 * len(good)
        elif name == "near_duplicates":
            # one of each group of texts whose five-word shingles are similar to 0.8, by all pairs
            assert ids == set(groups({i: r.text for i, r in before.items()}).values()) and all(r == before[r.doc_id] for r in rows)
        elif name == "pii":
            p = pii.Pseudonyms(b"tidemark")
            assert ids == set(before) and all(r.text == p.text(before[r.doc_id].text)[0] and r.n_chars == len(r.text) for r in rows)
            assert not any(re.search(r"@mail\d", r.text) and r.text == before[r.doc_id].text for r in rows)
        elif name == "mixing":
            want = {r.doc_id: r.epochs for r in mixing.select(now).collect()}
            assert ids == set(want) and len(rows) == sum(want.values())
        else:
            back = {r.doc_id: r.text for r in pieces.decoded(out).collect()}
            assert back == {i: before[i].text for i in ids}
        now = out
    assert corpus_pipeline.run(spark, sf_dir).count() == len(rows)


def test_odd_and_empty_documents(spark, sf_dir, odd, none):
    for start in (odd, none):
        now = start
        for name, f in corpus_pipeline.STAGES:
            now = f(spark, now, sf_dir)
            if name != "pieces":
                assert now.columns == start.columns
        now.collect()
