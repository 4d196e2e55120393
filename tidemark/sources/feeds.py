"""Change logs derived from ordinary tables: one JSON row image with its envelope a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = ("__op", "__ts_ns", "__source_pos")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), ts)


def as_log(df: DataFrame, payload: list[Column], op: Column, ts: Column, pos: Column) -> DataFrame:
    """``(data, load_ts, load_date)``; a null operation is left out of the JSON."""
    image = F.struct(*payload, op.alias("__op"), (epoch_micros(ts) * 1000).alias("__ts_ns"), pos.alias("__source_pos"))
    return df.select(F.to_json(image).alias("data"), ts.alias("load_ts"), ts.cast("date").alias("load_date"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events keyed by (user_id, k): every 97th without an operation, every 5th a delete, every 7th a create, else updates."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    n = F.col("event_id")
    op = F.when(n % 97 == 0, F.lit(None)).when(n % 5 == 0, "d").when(n % 7 == 0, "c").otherwise("u")
    return as_log(e, [F.col("user_id"), k, F.col("event_type"), F.col("value")], op, F.col("ts"), n)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an initial load that carries each encoding the coercion rules read."""
    o = read(spark, sf_dir, "orders")
    us, n = epoch_micros(F.col("o_orderdate")), F.col("o_orderkey")
    payload = [
        n, F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice"),
        (us * 1000).alias("od_nano"), F.expr("1").alias("one"), F.floor(us / 1000000).alias("od_sec"), F.floor(us / 1000).alias("od_ms"), F.floor(us / 86400000000).alias("od_day"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("od_iso"),
        F.when(F.col("o_orderstatus") == "O", "true").otherwise("false").alias("is_open_bit"),
        F.element_at(F.array(*map(F.lit, ("true", "1", "false", "0"))), (n % 4 + 1).cast("int")).alias("is_open_bool"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price_txt"),
        F.base64(F.unhex(F.lpad(F.hex(n), 16, "0"))).alias("rowkey_b64"),
        F.when(n % 50 == 0, "{broken").otherwise(F.to_json(F.struct(F.col("o_orderpriority").alias("p")))).alias("attrs"),
        F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, "null").otherwise(F.col("o_orderpriority")).alias("nullish"),
    ]
    return as_log(o, payload, F.lit("r"), F.col("o_orderdate"), n)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items keyed by (order, line), which repeat: a log to keep the latest of."""
    li = read(spark, sf_dir, "lineitem")
    cols = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")]
    return as_log(li, cols, F.lit("r"), F.col("l_shipdate"), F.col("l_partkey") * 100000 + F.col("l_suppkey"))
