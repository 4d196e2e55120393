"""The latest change of each key in a window, and deletes weighed against upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.coerce import epoch, iso_to_utc
from ..functions.payload import get


def _order() -> list[Column]:
    """Newest first by source time and position; load time and payload settle ties."""
    return [F.col("_ts_ns").desc(), F.col("_pos").desc(), F.col("load_ts").desc(), F.col("_hash").desc()]


def latest(log: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key: one shuffle by key, cut to one row a group before it and after.

    The text stays behind: its hash settles ties, and the parsed image says the rest.
    """
    log = log.withColumn("_hash", F.xxhash64("data")).drop("data")
    return log.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*_order()))).where("_rn = 1").drop("_rn", "_hash")


def latest_upserts(log: DataFrame, keys: list[str]) -> DataFrame:
    return latest(log.where(F.col("_op").isNotNull() & (F.col("_op") != "d")), keys)


def latest_deletes(log: DataFrame, keys: list[str]) -> DataFrame:
    return latest(log.where(F.col("_op") == "d"), keys)


def arbitrate(deletes: DataFrame, upserts: DataFrame, keys: list[str]) -> DataFrame:
    """Deletes whose key has no upsert, or a strictly older one; an unknown time keeps the row."""
    i = upserts.select(*[F.col(k).alias(f"_i_{k}") for k in keys], F.col("_ts_ns").alias("_i_ts"), F.lit(True).alias("_i"))
    on = [deletes[k] == i[f"_i_{k}"] for k in keys]
    out = deletes.join(i, on, "left").where(F.col("_i").isNull() | (F.col("_i_ts") < F.col("_ts_ns")))
    return out.drop("_i", "_i_ts", *[f"_i_{k}" for k in keys])


def changes(log: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """One row a key from one scan and one shuffle: ``i``, its newest upsert, and ``d``, its newest delete if that survives.

    Both hold ``carry`` and ``_op, _ts_ns, _pos, load_ts``.  Changes with a ``_bad`` reason
    (where the log has that column) are only counted, one row a reason.
    """
    row = F.struct(*carry, "_op", "_ts_ns", "_pos", "load_ts")
    # the same order as ``latest``: nulls are lowest in a struct comparison
    rank = F.struct("_ts_ns", "_pos", "load_ts", F.xxhash64("data"))
    best = lambda cond: F.max_by(F.when(cond, row), F.when(cond, rank))
    op, more, sound = F.col("_op"), [], F.lit(True)
    if "_bad" not in log.columns:
        log = log.where(op.isNotNull())
    else:  # their keys may be anything: nulls keep them together
        sound = F.col("_bad").isNull()
        log = log.select(*[F.when(sound, F.col(k)).alias(k) if k in keys else F.col(k) for k in log.columns])
        more = ["_bad"]
    both = log.groupBy(*keys, *more).agg(best(sound & (op != "d")).alias("i"), best(sound & (op == "d")).alias("d"), F.count_if(~sound).alias("_n_bad"))
    survives = F.col("i").isNull() | (F.col("i._ts_ns") < F.col("d._ts_ns"))
    return both.withColumn("d", F.when(survives, F.col("d")))


def fused(log: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """Upserts and surviving deletes of a window as rows ``(keys, kind, carry..., _op, _ts_ns, _pos, load_ts)``; ``kind`` is ``I`` or ``D``."""
    rows = F.filter(F.array(F.struct(F.lit("I").alias("kind"), F.col("i").alias("v")), F.struct(F.lit("D").alias("kind"), F.col("d").alias("v"))), lambda x: x["v"].isNotNull())
    return changes(log, keys, carry).select(*keys, F.explode(rows).alias("x")).select(*keys, "x.kind", "x.v.*")


def iso_versions(log: DataFrame) -> DataFrame:
    """For logs that write the source time as ISO text: its nanoseconds become the version."""
    return log.withColumn("_ts_ns", F.timestamp_diff("MICROSECOND", epoch(), iso_to_utc(get(F.col("_v"), "__ts_ns", "string"))) * 1000)


def null_keys(log: DataFrame, keys: list[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def stage_stats(upserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """One row: rows and load times of the upserts, rows of the deletes."""
    both = upserts.select(F.lit("I").alias("kind"), "load_ts").unionByName(deletes.select(F.lit("D").alias("kind"), "load_ts"))
    i = F.col("kind") == "I"
    return both.agg(F.count_if(i).alias("records_inserted"), F.count_if(~i).alias("records_deleted"), F.min(F.when(i, F.col("load_ts"))).alias("min_load_ts"), F.max(F.when(i, F.col("load_ts"))).alias("max_load_ts"), F.max("load_ts").alias("max_any_load_ts"))


def change_stats(changes: DataFrame, part: Column) -> DataFrame:
    """The same of ``changes``, one job for all: also what is set aside, and the different values of ``part`` of keys."""
    i, d = F.col("i").isNotNull(), F.col("d").isNotNull()
    return changes.agg(
        F.count_if(i).alias("records_inserted"), F.count_if(d).alias("records_deleted"), F.coalesce(F.sum("_n_bad"), F.lit(0)).alias("records_rejected"),
        F.min("i.load_ts").alias("min_load_ts"), F.max("i.load_ts").alias("max_load_ts"), F.max(F.greatest("i.load_ts", "d.load_ts")).alias("max_any_load_ts"),
        F.collect_set(F.when(i | d, part)).alias("parts"),
    )
