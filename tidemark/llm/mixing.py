"""Mixing sources to target weights, with DataFrame functions only.

Weights sit on a tree of domain, language and source.  A token budget flows down from
the root: at each node the children share it by weight, none beyond what its leaves can
give in ``max_epochs`` passes, and what a full child leaves is shared among its siblings;
only what all siblings cannot take is left to the parent's siblings, because a node's
capacity is the sum of its leaves'.  Sharing is exact integer water-filling.

Each leaf then takes whole epochs, and of the last one the prefix of a seeded order of
its documents that fits the rest of its budget.  The prefix is found without sorting a
leaf: token sums of 256 ranges of the order's key, then of 256 within the one where the prefix
ends, and so on three times; only the rows of the last range are ordered.  What comes out is
one row a leaf, and each document is decided by its leaf's row alone.

Defined cases: null and empty texts have no tokens and are never taken; a null language
or source is a name of its own (``?``); a null key is ordered first; rows with the same
key tie and are taken together or not at all; unlisted names have weight 1; an
empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .store import durable

TREE = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    #: source to domain; other sources are a domain by their last digit's half, see ``domain``
    domains: dict[str, str] = field(default_factory=dict)
    #: (level, name) to a positive integer weight
    weights: dict[tuple[str, str], int] = field(default_factory=lambda: {("domain", "web"): 2, ("domain", "books"): 3, ("lang", "en"): 5, ("lang", "fr"): 2, ("lang", "de"): 2, ("lang", "es"): 1})
    #: the budget as thousandths of the tokens there are, unless ``tokens`` names it
    per_mille: int = 800
    tokens: int | None = None
    max_epochs: int = 2
    seed: int = 42

    def domain(self) -> Column:
        """Sources that end in an even digit are ``web``, in an odd one ``books``, unless listed."""
        out = F.when(F.col("source").rlike("[02468]$"), "web").when(F.col("source").rlike("[13579]$"), "books").otherwise("other")
        for name, domain in self.domains.items():
            out = F.when(F.col("source") == name, domain).otherwise(out)
        return out

    def weight(self, level: str) -> Column:
        out = F.lit(1)
        for (where, name), w in self.weights.items():
            if where == level:
                out = F.when(F.col(level) == name, w).otherwise(out)
        return out.cast("decimal(38,0)")


def _share(nodes: DataFrame, parent: list[str], weight: Column) -> DataFrame:
    """``nodes(..., budget, cap)`` with the parent's ``budget`` to each node's own share.

    Children are ordered by capacity per weight.  Let k be the first child whose capacity
    is at least its share of what those before it leave: all before k are full, k and
    those after share the rest by weight; the units that rounding leaves go to the first.
    """
    zero = F.lit(0).cast("decimal(38,0)")
    nodes = nodes.withColumn("w", weight)
    order = [(F.col("cap").cast("double") / F.col("w").cast("double")), *[F.col(c) for c in TREE if c in nodes.columns]]
    w = W.partitionBy(*parent).orderBy(*order) if parent else W.partitionBy(F.lit(0)).orderBy(*order)
    before, after = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(0, W.unboundedFollowing)
    out = nodes.withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), zero)).withColumn("ws", F.sum("w").over(after))
    out = out.withColumn("full", (F.col("cap") * F.col("ws") < F.col("w") * F.col("left")))
    # once a child isn't full, none after it is
    open_left = F.first(F.when(~F.col("full"), F.struct("left", "ws")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    out = out.withColumn("o", open_left).withColumn("share", F.when(F.col("o").isNull(), F.col("cap")).otherwise(F.expr("cast((w * o.left) div o.ws as decimal(38,0))")))
    every = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    spare = F.least(F.col("budget"), F.sum("cap").over(every)) - F.sum("share").over(every)
    opened = F.sum(F.when(F.col("o").isNotNull() & (F.col("share") < F.col("cap")), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))
    out = out.withColumn("share", F.col("share") + F.when(F.col("o").isNotNull() & (F.col("share") < F.col("cap")) & (opened <= spare), 1).otherwise(0).cast("decimal(38,0)"))
    return out.drop("budget", "w", "left", "ws", "full", "o").withColumnRenamed("share", "budget")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves(domain, lang, source, tokens)`` with each leaf's ``budget``."""
    number = "decimal(38,0)"
    leaves = leaves.withColumn("cap", (F.col("tokens") * mix.max_epochs).cast(number))
    all_of = leaves.agg(F.sum("tokens").cast(number).alias("t"))
    total = F.lit(mix.tokens).cast(number) if mix.tokens is not None else F.expr(f"cast((t * {mix.per_mille}) div 1000 as {number})")
    root = all_of.select(total.alias("budget"))
    caps = lambda keys: leaves.groupBy(*keys).agg(F.sum("cap").cast(number).alias("cap"))
    got = _share(caps(["domain"]).crossJoin(F.broadcast(root)), [], mix.weight("domain"))
    got = _share(caps(["domain", "lang"]).join(got.drop("cap"), ["domain"]), ["domain"], mix.weight("lang"))
    got = _share(leaves.join(got.drop("cap"), ["domain", "lang"]), ["domain", "lang"], mix.weight("source"))
    return got.select(*TREE, "tokens", F.col("budget").cast("bigint").alias("budget"))


_LEAF = [f"_{c}" for c in TREE]
#: Bytes of the order's key in which a prefix's end is looked for, 256 ranges each.
_DIGITS = 3


def _described(docs: DataFrame, mix: Mix, key: str, *more: Column) -> DataFrame:
    """Each document's leaf and key, whatever its other columns are called."""
    name = lambda c: F.coalesce(F.col(c), F.lit("?")).alias(c)
    rows = docs.select(F.col(key).alias("_id"), name("lang"), name("source"), *more)
    return rows.withColumn("domain", mix.domain())


def _placed(rows: DataFrame, of_leaf: DataFrame, mix: Mix) -> DataFrame:
    """Rows with their leaf's row, and their place in the seeded order of its last epoch, which has its own number."""
    joined = rows.join(of_leaf, [rows[c] == of_leaf[f"_{c}"] for c in TREE])
    order = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("whole").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"))
    joined = joined.withColumn("o", order)
    bits = F.conv(F.substring("o", 1, 6), 16, 10).cast("int")
    return joined.withColumns({f"b{k}": F.shiftright(bits, 16 - 8 * k).bitwiseAND(255) for k in range(_DIGITS)})


def _marks(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row a leaf: whole epochs, and where in the order its prefix ends (null: nowhere, all are inside)."""
    got = budgets(rows.groupBy(*TREE).agg(F.sum("tokens").alias("tokens")), mix)
    marks = durable(got.select(*[F.col(c).alias(f"_{c}") for c in TREE], F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")), "mix-plan")
    for k in range(_DIGITS):
        edge = _placed(rows, marks, mix)
        for j in range(k):
            edge = edge.where(F.col(f"b{j}") == F.col(f"c{j}"))
        sums = edge.groupBy(*_LEAF, "rest", f"b{k}").agg(F.sum("tokens").alias("s"))
        upto = F.sum("s").over(W.partitionBy(*_LEAF).orderBy(f"b{k}"))
        over = sums.withColumn("upto", upto).where("upto > rest")
        # the first range that the rest doesn't cover whole, and the rest left there
        first = over.groupBy(*[F.col(c).alias(f"_{c}") for c in _LEAF]).agg(F.min(F.struct(f"b{k}", (F.col("rest") - F.col("upto") + F.col("s")).alias("r"))).alias("m"))
        joined = marks.join(first, [marks[c] == first[f"_{c}"] for c in _LEAF], "left")
        marks = durable(joined.select(*_LEAF, "whole", F.coalesce("m.r", "rest").alias("rest"), *[f"c{j}" for j in range(k)], F.col(f"m.b{k}").alias(f"c{k}")), "mix-plan")
    last = _placed(rows, marks, mix)
    for j in range(_DIGITS):
        last = last.where(F.col(f"b{j}") == F.col(f"c{j}"))
    run = F.sum("tokens").over(W.partitionBy(*_LEAF).orderBy("o").rangeBetween(W.unboundedPreceding, W.currentRow))
    inside = last.withColumn("run", run).where("run <= rest").groupBy(*[F.col(c).alias(f"_{c}") for c in _LEAF]).agg(F.max("o").alias("upto_o"))
    joined = marks.join(inside, [marks[c] == inside[f"_{c}"] for c in _LEAF], "left")
    return durable(joined.select(*_LEAF, "whole", *[f"c{j}" for j in range(_DIGITS)], "upto_o"), "mix-plan")


def _taken(rows: DataFrame, marks: DataFrame, mix: Mix) -> DataFrame:
    """Rows with how often they are taken, those that are."""
    rows = _placed(rows, marks, mix)
    inside, same = F.lit(False), F.lit(True)
    for k in range(_DIGITS):
        b, c = F.col(f"b{k}"), F.col(f"c{k}")
        inside, same = inside | (same & (c.isNull() | (b < c))), same & (b == c)
    inside = inside | (same & (F.col("o") <= F.col("upto_o")))
    return rows.withColumn("epochs", F.col("whole") + F.coalesce(inside, F.lit(False)).cast("bigint")).where("epochs > 0")


def _words(docs: DataFrame) -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("tokens")


def select(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id") -> DataFrame:
    """``(key, domain, lang, source, tokens, epochs)`` of the documents taken at least once."""
    rows = durable(_described(docs, mix, key, _words(docs)).where("tokens > 0"), "mix-rows")
    return _taken(rows, _marks(rows, mix), mix).select(F.col("_id").alias(key), *TREE, "tokens", "epochs")


def mixed(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id") -> DataFrame:
    """The documents taken, each as often as it was; decided as they are scanned, by the small table of leaves."""
    rows = durable(_described(docs, mix, key, _words(docs)).where("tokens > 0"), "mix-rows")
    whole = _described(docs, mix, key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")).where(F.col("_doc.text").rlike(r"[^\x20\x09-\x0D]"))
    got = _taken(whole, _marks(rows, mix), mix)
    return got.select("_doc", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("epochs")))).select("_doc.*")


ORACLE = r"""
with r as (select doc_id, coalesce(lang, '?') as lang, coalesce(source, '?') as source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as tokens,
    case when regexp_matches(source, '[02468]$') then 'web' when regexp_matches(source, '[13579]$') then 'books' else 'other' end as domain from documents),
d as (select * from r where tokens > 0),
leaf as (select domain, lang, source, sum(tokens)::hugeint as tokens, 2 * sum(tokens)::hugeint as cap from d group by all),
tot as (select (sum(tokens) * 800 // 1000)::hugeint as budget from leaf),
s1 as (select domain as p, '' as q, domain as n, sum(cap)::hugeint as cap, any_value(case domain when 'web' then 2 when 'books' then 3 else 1 end) as w, (select budget from tot) as budget from leaf group by domain),
@1@
s2 as (select l.domain as p, '' as q, l.lang as n, sum(l.cap)::hugeint as cap, any_value(case l.lang when 'en' then 5 when 'fr' then 2 when 'de' then 2 else 1 end) as w, any_value(s.share) as budget from leaf l join f1 s on s.n = l.domain group by l.domain, l.lang),
@2@
s3 as (select l.domain as p, l.lang as q, l.source as n, sum(l.cap)::hugeint as cap, 1 as w, any_value(s.share) as budget from leaf l join f2 s on s.p = l.domain and s.n = l.lang group by l.domain, l.lang, l.source),
@3@
plan as (select p as domain, q as lang, n as source, share // t.tokens as whole, share % t.tokens as rest from f3 join leaf t on t.domain = p and t.lang = q and t.source = n),
o as (select d.*, whole, rest, md5('42:' || cast(whole as varchar) || ':' || coalesce(cast(doc_id as varchar), '')) as o from d join plan using (domain, lang, source)),
run as (select *, sum(tokens) over (partition by domain, lang, source order by o range between unbounded preceding and current row) as upto from o)
select doc_id, domain, lang, source, cast(tokens as bigint) as tokens, cast(whole + cast(upto <= rest as int) as bigint) as epochs from run where whole + cast(upto <= rest as int) > 0
"""
_LEVEL = """g@ as (select *, budget - coalesce(sum(cap) over (partition by @P order by cap::double / w::double, n rows between unbounded preceding and 1 preceding), 0) as lft,
    sum(w) over (partition by @P order by cap::double / w::double, n rows between current row and unbounded following) as ws from s@),
h@ as (select *, cap * ws < w * lft as fll from g@),
i@ as (select *, first_value(case when not fll then {'l': lft, 'w': ws} end ignore nulls) over (partition by @P order by cap::double / w::double, n rows between unbounded preceding and current row) as op from h@),
j@ as (select *, case when op is null then cap else (w * op.l) // op.w end as sh from i@),
k@ as (select *, least(budget, sum(cap) over (partition by @P)) - sum(sh) over (partition by @P) as spare,
    sum(case when op is not null and sh < cap then 1 else 0 end) over (partition by @P order by cap::double / w::double, n rows between unbounded preceding and current row) as nth from j@),
f@ as (select p, q, n, (sh + case when op is not null and sh < cap and nth <= spare then 1 else 0 end)::hugeint as share from k@),"""
for _n, _p in (("1", "''"), ("2", "p"), ("3", "p, q")):
    ORACLE = ORACLE.replace(f"@{_n}@", _LEVEL.replace("@P", _p).replace("@", _n))
