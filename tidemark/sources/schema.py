"""The target's columns drive the projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Metadata columns that are never read from the payload.
RESERVED = frozenset(
    ["source_ts_ns_order", "publish_time", "bq_load_ts", "pos", "bigquery_updated_on", "message_id", "source_ts", "source_db_table", "subscription_name", "mysql_load_ts", "mysql_updated_on", "__op"]
)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: T.DataType
    ordinal: int


def specs(target: T.StructType, skip_reserved: bool = True) -> list[ColumnSpec]:
    return [ColumnSpec(f.name, f.dataType, i + 1) for i, f in enumerate(target.fields) if not (skip_reserved and f.name.lower() in RESERVED)]


def as_relation(spark: SparkSession, target: T.StructType, pk: list[str]) -> DataFrame:
    """The catalogue of a target: name, type, position, and whether the column is a key."""
    keys = {k.lower() for k in pk}
    rows = [(f.name, f.dataType.simpleString(), i + 1, f.name.lower() in keys) for i, f in enumerate(target.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal_position int, is_key boolean")
