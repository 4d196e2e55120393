"""Merging a stage into a target, as functions from DataFrames to a DataFrame.

``upserts`` and ``deletes`` hold the key columns in the target's types; ``upserts`` also
holds every target column, and the stage's metadata in ``_op`` and ``_ts_ns``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import OP_GATED


def _keys_only(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *(["_ts_ns"] if "_ts_ns" in df.columns else []))


def _on(left: DataFrame, right: DataFrame, keys: list[str]):
    return [left[k] == right[f"_k_{k}"] for k in keys]


def _not_newer(target: DataFrame, changes: DataFrame, version: str | None):
    """With a version column: only changes that are at least as new as the target's row."""
    return F.lit(True) if version is None else F.col("_ts_ns") >= target[version]


def delete_matched(target: DataFrame, deletes: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    d = _keys_only(deletes, keys)
    on = _on(target, d, keys)
    return target.join(d, on if version is None else [*on, _not_newer(target, d, version)], "left_anti")


def insert_missing(target: DataFrame, upserts: DataFrame, keys: list[str]) -> DataFrame:
    """The upserts whose key the target lacks."""
    t = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return upserts.join(t, _on(upserts, t, keys), "left_anti").select(*target.columns)


def update_matched(target: DataFrame, upserts: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """The target, with every column of matched rows taken from the stage."""
    s = upserts.select(F.lit(True).alias("_hit"), "_ts_ns", *[F.col(c).alias(f"_s_{c}") for c in target.columns])
    on = [target[k] == s[f"_s_{k}"] for k in keys]
    if version is not None:
        on.append(_not_newer(target, s, version))
    hit = F.col("_hit").isNotNull()
    return target.join(s, on, "left").select(*[F.when(hit, F.col(f"_s_{c}")).otherwise(target[c]).alias(c) for c in target.columns])


def upsert(target: DataFrame, upserts: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """Matched rows are replaced, others inserted."""
    if version is not None:
        return update_matched(target, upserts, keys, version).unionByName(insert_missing(target, upserts, keys))
    return delete_matched(target, upserts, keys).unionByName(upserts.select(*target.columns))


def op_gated(target: DataFrame, upserts: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """Only updates change matched rows; any upsert inserts a missing one."""
    changed = update_matched(target, upserts.where(F.col("_op") == "u"), keys, version)
    return changed.unionByName(insert_missing(target, upserts, keys))


def paired(upserts: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    """Upserts and deletes side by side, one row a key: ``(keys, i, d)``, as ``stage.changes`` gives them."""
    row = lambda df: F.struct(*[c for c in df.columns])
    i = upserts.select(*[F.col(k).alias(f"_i_{k}") for k in keys], row(upserts).alias("i"))
    d = deletes.select(*[F.col(k).alias(f"_d_{k}") for k in keys], row(deletes).alias("d"))
    both = i.join(d, [i[f"_i_{k}"] == d[f"_d_{k}"] for k in keys], "full")
    return both.select(*[F.coalesce(f"_i_{k}", f"_d_{k}").alias(k) for k in keys], "i", "d")


def merged(target: DataFrame, changes: DataFrame, keys: list[str], profile: str = "upsert", version: str | None = None, hidden: bool = False, guard: bool = False) -> DataFrame:
    """Every row of the target and of the changes with what becomes of it in ``_state``, from one join.

    ``changes`` has one row a key: ``i`` with every target column and ``d``, either may be
    null; upserts come first, then deletes.  ``_state``: kept, updated, inserted, deleted.

    ``version``: a target column; changes older than the row's do nothing.  ``hidden``: the
    target has the column ``_cdc``, the newest change applied to a row.  With ``guard``,
    changes older than that do nothing, and a delete leaves a mark (state ``mark``), so that
    changes may come in any order.
    """
    t = target.withColumn("_had", F.lit(True))
    c = changes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "i", "d")
    met = t.join(c, [t[k] == c[f"_k_{k}"] for k in keys], "full")
    gone = F.coalesce(F.col("_cdc.gone"), F.lit(False)) if hidden else F.lit(False)
    there = F.coalesce(F.col("_had"), F.lit(False))
    had, known = there & ~gone, F.col("_cdc.ts_ns").isNotNull() if hidden else F.lit(False)
    put, drop = F.col("i").isNotNull(), F.col("d").isNotNull()
    if profile == OP_GATED:
        put = put & (~had | (F.col("i._op") == "u"))
    if version is not None:
        put = put & (~had | (F.col("i._ts_ns") >= F.col(version)))
    if guard:
        put = put & (~known | (F.struct("i._ts_ns", "i._pos") >= F.struct("_cdc.ts_ns", "_cdc.pos")))
    put = F.coalesce(put, F.lit(False))
    if version is not None:
        drop = drop & (F.col("d._ts_ns") >= F.when(put, F.col(f"i.{version}")).otherwise(F.col(version)))
    if guard:
        drop = drop & (put | ~known | (F.col("d._ts_ns") > F.col("_cdc.ts_ns")))
    drop = F.coalesce(drop, F.lit(False))
    state = F.when(drop & (had | put), "deleted").when(put & had, "updated").when(put, "inserted").when(had, "kept")
    own = [n for n in target.columns if n != "_cdc"]
    out = {n: F.when(put, F.col(f"i.{n}")).otherwise(F.col(n)) for n in own}
    if not hidden:
        return met.select(*[o.alias(n) for n, o in out.items()], state.alias("_state")).where(F.col("_state").isNotNull())
    out |= {k: F.coalesce(out[k], F.col(f"_k_{k}")) for k in keys}
    as_of = lambda x, dead: F.struct(F.col(f"{x}._ts_ns").alias("ts_ns"), F.col(f"{x}._pos").alias("pos"), F.lit(dead).alias("gone"))
    mark = F.when(drop, as_of("d", True)).when(put, as_of("i", False)).otherwise(F.col("_cdc"))
    stays = there | put | (drop if guard else F.lit(False))
    return met.where(stays).select(*[o.alias(n) for n, o in out.items()], mark.alias("_cdc"), F.coalesce(state, F.lit("mark")).alias("_state"))


def applied(target: DataFrame, changes: DataFrame, keys: list[str], profile: str = "upsert", version: str | None = None) -> DataFrame:
    """The target after the changes of ``stage.changes`` or ``paired``: it is read once."""
    return merged(target, changes, keys, profile, version).where(F.col("_state") != "deleted").drop("_state")


def merge(target: DataFrame, upserts: DataFrame, deletes: DataFrame, keys: list[str], profile: str = "upsert", version: str | None = None) -> DataFrame:
    """Upserts first, then deletes, as one transaction would."""
    return applied(target, paired(upserts, deletes, keys), keys, profile, version)


def keyed_upsert(table: DataFrame, rows: DataFrame, keys: list[str], changes: list[str]) -> DataFrame:
    """Matched rows take only ``changes`` from ``rows``, others are inserted whole."""
    s = rows.select(F.lit(True).alias("_hit"), *[F.col(c).alias(f"_s_{c}") for c in table.columns])
    kept = table.join(s, [table[k] == s[f"_s_{k}"] for k in keys], "left")
    pick = [F.when(F.col("_hit").isNotNull(), F.col(f"_s_{c}")).otherwise(table[c]).alias(c) if c in changes else table[c] for c in table.columns]
    return kept.select(*pick).unionByName(insert_missing(table, rows, keys))


def state_upsert(state: DataFrame, row: DataFrame) -> DataFrame:
    """Merging one row on a condition that always holds: it replaces every row, or is the first."""
    s = row.select(*[F.col(c).alias(f"_s_{c}") for c in state.columns])
    replaced = state.crossJoin(F.broadcast(s)).select(*[F.col(f"_s_{c}").alias(c) for c in state.columns])
    none = state.limit(1).select(F.lit(True).alias("_any"))
    first = row.join(F.broadcast(none), F.lit(True), "left_anti").select(*state.columns)
    return replaced.unionByName(first)


def repeated_keys(upserts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a merge source holds more than once; it must hold none."""
    return upserts.groupBy(*keys).count().where("count > 1")
