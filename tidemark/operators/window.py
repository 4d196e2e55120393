"""The incremental window over load times, and its watermark."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
POLICIES = ("max_upsert_load_ts", "max_load_ts", "window_end")


def ntz(t: datetime | None) -> Column:
    return F.to_timestamp_ntz(F.lit(None if t is None else t.strftime("%Y-%m-%d %H:%M:%S.%f")))


def in_window(log: DataFrame, start: datetime, end: datetime, at: str = "load_ts", day: str = "load_date") -> DataFrame:
    """Half-open: after ``start``, up to and with ``end``; prunes partitions by day too."""
    out = log.where((F.col(at) > ntz(start)) & (F.col(at) <= ntz(end)))
    if day in log.columns:
        out = out.where((F.col(day) >= F.lit(start.date())) & (F.col(day) <= F.lit(end.date())))
    return out


def watermark(log: DataFrame, cdc_table: str, database: str, table: str) -> DataFrame:
    """One row: the latest end of a successful run of the job, or the epoch."""
    mine = (F.col("cdc_table_name") == cdc_table) & (F.col("target_database") == database) & (F.col("target_table") == table)
    return log.where(mine & (F.col("run_status") == "SUCCESS")).agg(F.coalesce(F.max("cdc_end_ts"), ntz(EPOCH)).alias("start_ts"))


def next_run_id(log: DataFrame, at: str = "id") -> DataFrame:
    return log.agg((F.coalesce(F.max(F.col(at)), F.lit(0)) + 1).cast("bigint").alias("next_id"))


def day_of_year_partitions(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Names ``pNNN`` of the days of the year in the window, which may wrap around; a window of a year or more has all."""
    first, last = start.timetuple().tm_yday, end.timetuple().tm_yday
    n = F.col("id").cast("int")
    days = spark.range(1, 367)
    if end - start < timedelta(days=365):
        days = days.where(n.between(first, last) if first <= last else (n >= first) | (n <= last))
    return days.select(n.alias("day"), F.concat(F.lit("p"), F.lpad(n.cast("string"), 3, "0")).alias("partition_name"))
