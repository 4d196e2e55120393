"""The same merge fed by a file stream, one micro-batch a run."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.store import _Fs

LOG_SCHEMA = "data string, load_ts timestamp_ntz, load_date date"


def log_stream(spark: SparkSession, path: str, files_per_batch: int = 1, schema: str | T.StructType = LOG_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, apply_batch: Callable[[DataFrame, tuple[str, int]], None], checkpoint: str) -> None:
    """Everything that is there now, in micro-batches, then stops.

    The checkpoint remembers what was read; ``apply_batch`` gets the batch as (stream,
    number), which a snapshot's manifest records, so a batch replayed after its commit
    changes nothing, and a new checkpoint is another stream.
    """

    def run(df: DataFrame, number: int) -> None:
        name = json.loads(_Fs(df.sparkSession, checkpoint).text("metadata"))["id"]
        apply_batch(df, (name, number))

    query = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
