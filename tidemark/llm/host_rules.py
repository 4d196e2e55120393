"""Quality rules judged by host: shrunken failure rates joined back to documents.

Each document's whole text gives a few counts; each rule marks the documents it fails.
Failures are summed by host (partial sums first, so a host with a third of all rows is
no hot key), each host's rate is shrunk towards an empirical beta prior fitted to all
hosts by moments, and a host whose shrunken rate passes the limit for any rule is
rejected as a whole.

Defined cases: a null or empty text has no words (and fails the length rule); a null
host is no host, so only the document's own rules count; repeated rows count as often
as they occur; empty input gives empty output.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import arrow_rows, durable, with_columns
from .textbytes import SPACE, Spans, chunks, mix, per_row, within, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

#: A host with more than one in ``HOT`` documents is hot, so there are fewer than ``HOT`` of them.
HOT = 1000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(key: np.ndarray) -> np.ndarray:
    """True for keys that occur twice or more."""
    order = np.argsort(key)
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.empty(len(k), bool)
    out[order] = same[1:] | same[:-1]
    return out


def count_text(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    s, e, row = words(data, offs)
    out = {"n_words": per_row(row, n)}
    rows_of = lambda at: np.searchsorted(offs, at, "right") - 1
    out["word_chars"] = per_row(rows_of(np.flatnonzero(~SPACE[data] & ((data & 0xC0) != 0x80))), n)
    out["n_symbols"] = per_row(rows_of(np.flatnonzero(SYMBOLS[data])), n)
    spans = Spans(data)

    breaks = np.flatnonzero(data == 10)
    ls = np.unique(np.concatenate([offs[:-1][np.diff(offs) > 0], breaks + 1]))
    ls = ls[ls < len(data)]
    le = np.minimum(np.append(ls[1:], len(data)), len(data))
    le = le - (data[le - 1] == 10) if len(ls) else le
    lrow = rows_of(ls)
    solid = np.searchsorted(s, ls) < np.searchsorted(s, le) if len(ls) else np.zeros(0, bool)
    ls, le, lrow = ls[solid], le[solid], lrow[solid]
    _, first = np.unique(within(lrow, spans(ls, le)), return_index=True)
    out["n_dup_lines"] = per_row(lrow, n) - per_row(lrow[first], n)

    covered = np.zeros(len(s), bool)
    if len(s) > 2:
        h = spans(s, e)
        whole = np.flatnonzero(row[2:] == row[:-2])
        key = within(row[whole], mix(h[whole] + mix(h[whole + 1] + mix(h[whole + 2]))))
        hit = whole[_repeated(key)]
        for k in range(3):
            covered[hit + k] = True
    out["n_repeat_words"] = per_row(row[covered], n)
    return out


def text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the counts of each whole text."""

    def run(batches):
        for rows, data, offs in chunks(batches):
            got = count_text(data, offs)
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in keep] + [pa.array(got[c].astype(np.int64)) for c in COUNTS], [*keep, *COUNTS])

    arrow_rows(docs.sparkSession)
    src = with_columns(docs, [*keep, "text"])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.select(*keep).schema), *(f"{c} bigint" for c in COUNTS)])
    return src.mapInArrow(run, schema)


@dataclass(frozen=True)
class HostRules:
    """Rules (name: condition over the counts that marks a failure), and the highest shrunken rate a host may have."""

    rules: dict[str, Column] = field(
        default_factory=lambda: {
            "short": F.col("n_words") < 50,
            "repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
            "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
            "dup_lines": F.col("n_dup_lines") > 30,
        }
    )
    base: tuple[str, ...] = ("short", "repeats")
    max_rate: float = 0.5

    def host_table(self, counted: DataFrame, host: str = "source") -> DataFrame:
        """One row a host: documents, and by rule failures and the shrunken rate."""
        hosts = counted.where(F.col(host).isNotNull()).groupBy(host).agg(F.count(F.lit(1)).alias("n"), *[F.sum(rule.cast("long")).alias(f"f_{k}") for k, rule in self.rules.items()])
        rate = lambda k: F.col(f"f_{k}") / F.col("n")
        stats = hosts.agg(*[x for k in self.rules for x in (F.avg(rate(k)).alias(f"m_{k}"), F.avg(rate(k) * rate(k)).alias(f"q_{k}"))])
        # Beta(a, b) by moments; strength m(1-m)/v - 1, held within 1 and 1000 pseudo-documents.
        out = hosts.crossJoin(F.broadcast(stats))  # one row
        for k in self.rules:
            m, v = F.col(f"m_{k}"), F.greatest(F.col(f"q_{k}") - F.col(f"m_{k}") * F.col(f"m_{k}"), F.lit(1e-9))
            strength = F.least(F.greatest(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1000.0))
            out = out.withColumn(f"r_{k}", (F.col(f"f_{k}") + m * strength) / (F.col("n") + strength))
        return out.select(host, "n", *[f"{p}_{k}" for k in self.rules for p in ("f", "r")])

    def apply(self, docs: DataFrame, host: str = "source", key: str = "doc_id") -> DataFrame:
        """Counts of each document, ``base_failed``, ``host_rate`` and ``kept``."""
        counted = durable(text_counts(docs, [key, host]), "host-counts")
        hosts = self.host_table(counted, host)
        worst = F.greatest(*[F.col(f"r_{k}") for k in self.rules], F.lit(0.0))
        verdict = durable(hosts.select(F.col(host).alias("_host"), "n", worst.alias("host_rate")), "host-verdicts")
        total = verdict.agg(F.sum("n").alias("_all"))  # one row
        sized = verdict.crossJoin(F.broadcast(total))
        hot = sized.where(F.col("n") * HOT > F.col("_all")).select(F.col("_host").alias("_hot"), F.col("host_rate").alias("_hot_rate"))
        other = sized.where(F.col("n") * HOT <= F.col("_all")).select("_host", "host_rate", F.lit(0).alias("_to"))
        # hot hosts' verdicts go to every task; their documents, and those without a host, are spread over the exchange that the others need
        out = counted.join(F.broadcast(hot), counted[host] == F.col("_hot"), "left")
        settled = F.col("_hot").isNotNull() | F.col(host).isNull()
        out = out.withColumn("_mine", F.when(~settled, F.col(host))).withColumn("_part", F.when(settled, 1 + F.pmod(F.xxhash64(key, *COUNTS), F.lit(HOT))).otherwise(0).cast("int"))
        out = out.join(other, (F.col("_mine") == F.col("_host")) & (F.col("_part") == F.col("_to")), "left")
        failed = F.lit(False)
        for k in self.base:
            failed = failed | self.rules[k]
        out = out.withColumn("host_rate", F.coalesce("_hot_rate", "host_rate")).withColumn("base_failed", failed)
        return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("host_rate"), F.lit(0.0)) <= self.max_rate)).drop("_host", "_hot", "_hot_rate", "_mine", "_part", "_to")


ORACLE = r"""
with w as (select doc_id, source, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
base as (select doc_id, source, cast(len(ws) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls, ws from w),
win as (select doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] as g from base, unnest(range(1, greatest(len(ws) - 1, 1))) as t(i)),
rep as (select doc_id, i from win qualify count(*) over (partition by doc_id, g) > 1),
cov as (select doc_id, count(distinct i + k) as c from rep, unnest([0, 1, 2]) as u(k) group by doc_id),
counts as (select b.doc_id, source, n_words, word_chars, n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(c, 0) as bigint) as n_repeat_words from base b left join cov using (doc_id)),
flags as (select *, n_words < 50 as short, 100 * n_repeat_words > 50 * n_words as repeats, 10 * n_symbols > n_words as symbols, n_dup_lines > 30 as dup_lines from counts),
hosts as (select source, rule, count(*) as n, sum(cast(failed as bigint)) as f from (
    select source, unnest(['short', 'repeats', 'symbols', 'dup_lines']) as rule, unnest([short, repeats, symbols, dup_lines]) as failed from flags where source is not null) group by source, rule),
prior as (select rule, avg(f / n) as m, greatest(avg((f / n) * (f / n)) - avg(f / n) * avg(f / n), 1e-9) as v from hosts group by rule),
strength as (select rule, m, least(greatest(m * (1 - m) / v - 1, 1.0), 1000.0) as k from prior),
verdict as (select source, max((f + m * k) / (n + k)) <= 0.5 as good from hosts join strength using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short or repeats as base_failed,
    not (short or repeats) and coalesce(good, true) as kept
from flags left join verdict using (source)
"""
