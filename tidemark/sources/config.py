"""Job configuration: one row a job, column lists as comma-separated text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("target_database", "target_table", "cdc_table")
LISTS = (
    "pk", "epoc_cols", "epoc_nano_cols", "epoc_day_cols", "bit_to_int_col", "epoch_to_date_to_string_col", "non_epoch_datetime_col",
    "datetime_to_int_val_col", "datetime_null", "col_value_as_current_time_ist", "epoc_datetime_ist",
)
SCALARS = ("source_fp", "target_fp", "partition_field", "row_key_binary", "row_key_timestamp")
SCHEMA = ", ".join([*(f"{c} string" for c in (*KEYS, *SCALARS, *LISTS)), "is_active int"])


class ConfigError(ValueError):
    """The configuration is ambiguous or doesn't fit the target."""


def bootstrap(spark: SparkSession, base: str) -> None:
    """An empty configuration table where there is none."""
    spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{base}/config")


def read(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{base}/config")


def add(spark: SparkSession, base: str, rows: list[dict]) -> None:
    """Adds jobs: the three names, the keys and the source are required, a job is there once, and it is active unless it says otherwise."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for r in rows:
        if lost := [c for c in (*KEYS, "pk", "source_fp") if not r.get(c)]:
            raise ConfigError(f"a job needs {', '.join(lost)}: {r}")
        if unknown := set(r) - set(names):
            raise ConfigError(f"no such settings: {sorted(unknown)}")
    new = spark.createDataFrame([tuple((r | {"is_active": r.get("is_active", 1)}).get(c) for c in names) for r in rows], SCHEMA)
    twice = read(spark, base).select(*KEYS).unionByName(new.select(*KEYS)).groupBy(*KEYS).count().where("count > 1").first()
    if twice:
        raise ConfigError(f"more than one configuration for {twice['target_database']}.{twice['target_table']} from {twice['cdc_table']}")
    new.coalesce(1).write.mode("append").parquet(f"{base}/config")


def clean_list(c: Column) -> Column:
    """Comma-separated text to an array: blanks and newlines go, empty items go, empty text is null."""
    items = F.filter(F.split(F.regexp_replace(c, r"[ \r\n\t]", ""), ","), lambda x: x != "")
    return F.when(F.size(items) > 0, items)


def split_list(text: str | None) -> tuple[str, ...]:
    return tuple(x for x in re.sub(r"\s", "", text or "").split(",") if x)


def split_name(full: str) -> tuple[str | None, str]:
    """``db.table`` to its parts; a bare table has no database."""
    db, _, name = full.rpartition(".")
    return db or None, name


def log_table_name(cdc_table: str) -> str:
    """Name of a job's own last-run table: the part before the first dot without ``_cdc``, and the table."""
    return "last_run_" + cdc_table.split(".")[0].replace("_cdc", "") + "_" + cdc_table.split(".")[-1]


@dataclass(frozen=True)
class JobConfig:
    target_database: str
    target_table: str
    cdc_table: str
    pk: tuple[str, ...]
    source_fp: str | None = None
    target_fp: str | None = None
    partition_field: str | None = None
    row_key_binary: str | None = None
    row_key_timestamp: str | None = None
    epoc_cols: tuple[str, ...] = ()
    epoc_nano_cols: tuple[str, ...] = ()
    epoc_day_cols: tuple[str, ...] = ()
    bit_to_int_col: tuple[str, ...] = ()
    epoch_to_date_to_string_col: tuple[str, ...] = ()
    non_epoch_datetime_col: tuple[str, ...] = ()
    datetime_to_int_val_col: tuple[str, ...] = ()
    datetime_null: tuple[str, ...] = ()
    col_value_as_current_time_ist: tuple[str, ...] = ()
    epoc_datetime_ist: tuple[str, ...] = ()
    is_active: bool = True
    json_key_overrides: dict[str, str] = field(default_factory=dict)

    def keys_in(self, columns: list[str]) -> list[str]:
        """The key columns in the target's spelling; a key that the target lacks is an error."""
        have = {c.lower(): c for c in columns}
        if not self.pk or (lost := [k for k in self.pk if k.lower() not in have]):
            raise ConfigError(f"{self.target_table}: key columns {lost if self.pk else '(none given)'} aren't in the target")
        return [have[k.lower()] for k in self.pk]


def lookup_rows(config: DataFrame, target_database: str, target_table: str, cdc_table: str) -> DataFrame:
    key = (F.col("target_database") == target_database) & (F.col("target_table") == target_table) & (F.col("cdc_table") == cdc_table)
    return config.where(key)


def lookup(config: DataFrame, target_database: str, target_table: str, cdc_table: str) -> JobConfig | None:
    """The job's configuration, or None if there is none; two rows for a job are an error."""
    rows = lookup_rows(config, target_database, target_table, cdc_table).limit(2).collect()
    if len(rows) > 1:
        raise ConfigError(f"more than one configuration for {target_database}.{target_table} from {cdc_table}")
    if not rows:
        return None
    row = rows[0].asDict()
    known = {f.name for f in fields(JobConfig)}
    got = {k: split_list(row.get(k)) if k in LISTS else (row.get(k) or None) for k in (*KEYS, *SCALARS, *LISTS) if k in known}
    return JobConfig(**got, is_active=row.get("is_active") == 1)


def active(config: DataFrame) -> DataFrame:
    """The gate: jobs whose flag isn't exactly 1 don't run."""
    return config.where(F.coalesce(F.col("is_active"), F.lit(0)) == 1)
