"""Held-out rows, and bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: str | Column, of: int) -> Column:
    """crc32 of the key's text modulo ``of``; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary") if isinstance(key, str) else key) % of, F.lit(-1))


def held_out(key: str = "doc_id", of: int = 4) -> Column:
    return remainder(key, of) == 2


def thinned(rows: DataFrame, key: str, bound: int, salt: int = 0) -> DataFrame:
    """At most about twice ``bound`` rows, chosen by a hash of their key; all if there are fewer."""
    n = rows.count()
    return rows.where(F.pmod(F.xxhash64(F.lit(salt), key), F.lit(max(1, n // bound))) == 0)


def sample(docs: DataFrame, labels: DataFrame, label: str, bounds: dict[int, int], key: str = "doc_id") -> DataFrame:
    """``docs`` rows with a training label (1 or 0), of each class at most about twice its bound.

    Training rows are those whose remainder modulo 4 isn't 2.  The labels kept are few by
    that bound, so they are sent to the scan of the documents.
    """
    known = labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("_k").isNotNull() & (remainder("_k", 4) != 2))
    known = known.groupBy("_k").agg(F.max("y").alias("y"))
    some = None
    for y, bound in bounds.items():
        part = thinned(known.where(F.col("y") == y), "_k", bound, y)
        some = part if some is None else some.unionByName(part)
    return docs.join(F.broadcast(some), docs[key] == F.col("_k")).drop("_k")
