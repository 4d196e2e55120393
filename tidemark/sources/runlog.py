"""Watermark log (appended), run log (upserted by run) and each job's last run.

Reports of the run log are appended and folded on reading: the first report of a run gives
its row, the last one the columns that a report changes.  So two engines may report at the
same time, and a report that is sent twice is one row.
"""

from __future__ import annotations

import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from .config import log_table_name
from .store import CommitConflict, Lock, SnapshotStore, _Fs

WATERMARK = (
    "id string, cdc_table_name string, target_database string, cdc_start_ts timestamp_ntz, cdc_end_ts timestamp_ntz, insert_timestamp timestamp_ntz, "
    "target_table string, error_msg string, run_status string, records_inserted bigint, records_deleted bigint, records_rejected bigint"
)
RUNS = (
    "run_id string, proc_name string, target_database string, target_table string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "run_status string, error_msg string, records_inserted bigint, records_deleted bigint, records_rejected bigint"
)
RUN_KEYS = ["run_id", "target_database", "target_table"]
#: What a repeated report of a run changes; its start and the rest stay.
RUN_CHANGES = ["end_time", "run_status", "error_msg", "records_inserted", "records_deleted", "records_rejected"]
#: Fixed values.
STATUS = {0: "SUCCESS", 1: "FAILED"}
#: The order of reports, beside the run log's own columns.
ORDER = "reported_ns bigint"


def status_name(code: int) -> str:
    return STATUS.get(code, "PENDING")


def _schema(name: str) -> str:
    return WATERMARK if name == "watermark" else f"{RUNS}, {ORDER}"


def bootstrap(spark: SparkSession, base: str) -> None:
    """Empty control tables where there are none."""
    for name in ("watermark", "runs"):
        spark.createDataFrame([], _schema(name)).write.mode("ignore").parquet(f"{base}/{name}")


def _row(schema: str, row: dict) -> pa.Table:
    """A row of that schema, as Arrow."""
    return pa.Table.from_pylist([row], to_arrow_schema(T.StructType.fromDDL(schema)))


def append(spark: SparkSession, base: str, name: str, row: dict) -> None:
    _Fs(spark, base).put(_row(_schema(name), row | {"reported_ns": time.time_ns()}), name, f"part-{uuid.uuid4().hex}.parquet")


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    rows = spark.read.schema(_schema(name)).parquet(f"{base}/{name}")
    return rows if name == "watermark" else folded(rows)


def folded(reports: DataFrame) -> DataFrame:
    """One row a run: a repeated key takes ``RUN_CHANGES`` from its last report."""
    names = [c for c in reports.columns if c != "reported_ns" and c not in RUN_KEYS]
    values = [(F.max_by if c in RUN_CHANGES else F.min_by)(c, "reported_ns").alias(c) for c in names]
    keys = [F.coalesce(F.col(k), F.lit("")).alias(k) for k in RUN_KEYS]
    return reports.groupBy(*keys).agg(*values).select(*[c for c in reports.columns if c != "reported_ns"])


def last_table(spark: SparkSession, base: str, cdc_table: str, lock: Lock | None = None) -> SnapshotStore:
    """A job's own table of one row, its last run; made if it isn't there."""
    s = SnapshotStore(spark, f"{base}/{log_table_name(cdc_table)}", lock)
    s.create(T.StructType.fromDDL(WATERMARK))
    return s


def write_last(spark: SparkSession, base: str, row: dict, lock: Lock | None = None) -> None:
    """The run replaces the job's last one, as an upsert on a condition that always holds."""
    s = last_table(spark, base, row["cdc_table_name"], lock)
    while True:
        try:
            s.replace(s.current(), _row(WATERMARK, row))
            return s.vacuum()
        except CommitConflict:  # another run ended at the same time
            continue


def last_state(log: DataFrame) -> DataFrame:
    """Each job's last run."""
    w = W.partitionBy("cdc_table_name", "target_database", "target_table").orderBy(F.col("insert_timestamp").desc(), F.col("id").desc())
    return log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
