import re

from pyspark.sql import functions as F

from tidemark.llm import mixing


def share(budget, children):
    """Water-filling by repeated rounds: {name: (weight, capacity)} to {name: share}, real numbers."""
    out, live, left = {}, dict(children), budget
    while live:
        total = sum(w for w, _ in live.values())
        full = [k for k, (w, cap) in live.items() if cap * total < w * left]
        if not full:
            out |= {k: left * w / total for k, (w, _) in live.items()}
            break
        for k in full:
            out[k] = live[k][1]
        left -= sum(live[k][1] for k in full)
        live = {k: v for k, v in live.items() if k not in full}
    return out


LEAVES = [("web", "en", "src0", 1000), ("web", "en", "src2", 10), ("web", "fr", "src4", 50), ("books", "en", "src1", 20), ("books", "de", "src3", 5), ("other", "?", "?", 1)]


def test_budgets(spark):
    df = spark.createDataFrame(LEAVES, "domain string, lang string, source string, tokens bigint")
    for per_mille in (10, 300, 800, 1500, 2500):
        mix = mixing.Mix(per_mille=per_mille)
        got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(df, mix).collect()}
        total = sum(x[3] for x in LEAVES) * per_mille // 1000
        assert sum(got.values()) == min(total, 2 * sum(x[3] for x in LEAVES))
        weight = lambda level, n: mix.weights.get((level, n), 1)  # noqa: B023, E731
        cap = lambda *p: 2 * sum(x[3] for x in LEAVES if x[: len(p)] == p)
        top = share(total, {d: (weight("domain", d), cap(d)) for d in {x[0] for x in LEAVES}})
        for d, b in top.items():
            mid = share(b, {n: (weight("lang", n), cap(d, n)) for n in {x[1] for x in LEAVES if x[0] == d}})
            for n, c in mid.items():
                for s, leaf in share(c, {s: (1, cap(d, n, s)) for s in {x[2] for x in LEAVES if x[:2] == (d, n)}}).items():
                    assert abs(got[d, n, s] - leaf) <= 4  # whole tokens at three levels


def test_leaves_take_epochs_and_a_prefix(spark, docs):
    mix = mixing.Mix(per_mille=1400, max_epochs=3)
    tokens = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = docs.withColumn("domain", mix.domain()).collect()
    size = {}
    for r in rows:
        size[r.domain, r.lang, r.source] = size.get((r.domain, r.lang, r.source), 0) + tokens(r.text)
    leaves = spark.createDataFrame([(*k, v) for k, v in size.items()], "domain string, lang string, source string, tokens bigint")
    budget = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(leaves, mix).collect()}
    got = {}
    for r in mixing.select(docs, mix).collect():
        got.setdefault((r.domain, r.lang, r.source), []).append(r)
    for k, b in budget.items():
        taken = sum(r.tokens * r.epochs for r in got.get(k, []))
        assert taken <= b <= 3 * size[k]
        biggest = max(tokens(r.text) for r in rows if (r.domain, r.lang, r.source) == k)
        assert b - taken < biggest or b == taken


def test_copies_of_documents(docs):
    mix = mixing.Mix(per_mille=1500)
    out = mixing.mixed(docs, mix)
    assert out.columns == docs.columns
    assert out.count() == mixing.select(docs, mix).agg(F.sum("epochs")).first()[0]


def test_odd_rows(odd, none):
    got = {r.doc_id: r for r in mixing.select(odd, mixing.Mix(per_mille=2000)).collect()}
    assert set(got) == {1, 5, None, 6, 7, 8} and all(r.epochs == 2 for r in got.values()) and got[6].lang == "?"
    out = mixing.mixed(odd, mixing.Mix(per_mille=2000))
    assert out.columns == odd.columns and out.where("doc_id = 1").count() == 4
    assert mixing.select(none).count() == 0 and mixing.mixed(none).count() == 0


def test_no_python(docs):
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
