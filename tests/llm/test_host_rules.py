import collections
import re

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import host_rules as hr
from tidemark.llm.textbytes import column


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_counts(docs):
    texts = [r.text for r in docs.collect()] + ["", None, "\n", "a\n\na\n a\na", "é漢 é漢 é漢 é漢", "x", "one two three one two three", "\r\na\r\na\r\n"]
    got = hr.count_text(*column(pa.array(texts)))
    for i, t in enumerate(texts):
        assert {k: int(x[i]) for k, x in got.items()} == brute(t), t


def test_a_bad_host_goes_and_a_small_one_is_shrunk(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(i, long, f"good{i % 20}") for i in range(400)] + [(1000 + i, long if i % 10 == 0 else "short", "bad") for i in range(200)] + [(2000, "short", "small"), (2001, long, "small")]
    df = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in hr.HostRules().apply(df).collect()}
    assert not got[1000].kept and not got[1000].base_failed and got[0].kept
    assert got[2001].kept and got[2001].host_rate < 0.5  # one of two: shrunk towards the others
    assert not got[2000].kept


def test_odd_rows(odd, none):
    got = hr.HostRules().apply(odd).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and by[2].n_words == 0 and by[2].base_failed and not by[2].kept and by[5].n_words == 180 and by[5].source is None
    assert hr.HostRules().apply(none).count() == 0
    only = hr.HostRules(rules={"short": F.col("n_words") < 2}, base=("short",), max_rate=1.0)
    assert {r.doc_id for r in only.apply(odd).where("kept").collect()} == {1, 5, None, 7, 8}
