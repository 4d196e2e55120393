"""From JSON scalar text to the target's types: ordered rules, the first that applies wins.

Every rule is a function of a text column.  Timestamps are wall clocks in UTC without a
zone, built by adding to the epoch, so no result depends on the session's time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.config import JobConfig
from ..sources.schema import RESERVED, ColumnSpec
from .payload import OP_GATED, UPSERT, get, path, scalar_text

Rule = Callable[[Column, str], Column]


def epoch() -> Column:
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))


def since_epoch(unit: str, n: Column) -> Column:
    return F.timestamp_add(unit, n, epoch())


def cast(x: Column, to: T.DataType | str, on_error: str = "fail") -> Column:
    return x.cast(to) if on_error == "fail" else x.try_cast(to)


def sys_end_time() -> Column:
    return F.to_timestamp_ntz(F.lit("9999-12-31 23:59:59.999999"))


def row_key_from_base64(x: Column) -> Column:
    """The first 8 bytes, big-endian and signed."""
    return F.conv(F.hex(F.substring(F.unbase64(x), 1, 8)), 16, -10).cast("bigint")


def iso_to_utc(x: Column, on_error: str = "fail") -> Column:
    """ISO 8601 text to a UTC wall clock; text without an offset is in UTC already."""
    x = F.trim(x)
    zoned = F.when(F.length(x) == 10, F.concat(x, F.lit("T00:00:00Z"))).when(x.rlike(r"(Z|[+-]\d\d(:?\d\d)?)$"), x).otherwise(F.concat(x, F.lit("Z")))
    return since_epoch("MICROSECOND", F.unix_micros(cast(zoned, "timestamp", on_error)))


def iso_to_wall(x: Column, on_error: str = "fail") -> Column:
    """ISO text with its ``T`` and ``Z`` dropped, read as it stands."""
    return cast(F.regexp_replace(F.regexp_replace(x, "T", " "), "Z", ""), "timestamp_ntz", on_error)


def row_key_from_time(x: Column) -> Column:
    return F.timestamp_diff("SECOND", epoch(), iso_to_utc(x))


def epoch_nanos(x: Column, on_error: str = "fail") -> Column:
    n = cast(x, "bigint", on_error)
    return since_epoch("MICROSECOND", F.floor(n / F.lit(1000).cast("decimal(19,0)")).cast("bigint"))


def epoch_days(x: Column) -> Column:
    """Malformed text is null whatever the error policy."""
    return F.date_add(F.to_date(F.lit("1970-01-01")), x.try_cast("int"))


def epoch_seconds(x: Column, on_error: str = "fail") -> Column:
    return since_epoch("SECOND", cast(x, "bigint", on_error))


def epoch_millis(x: Column, on_error: str = "fail") -> Column:
    """Fractions of a millisecond round."""
    return since_epoch("MILLISECOND", F.round(cast(x, "decimal(38,9)", on_error)).cast("bigint"))


def epoch_seconds_ist(x: Column, on_error: str = "fail") -> Column:
    return F.timestamp_add("MINUTE", F.lit(330), epoch_seconds(x, on_error))


def epoch_day_text(x: Column) -> Column:
    return F.date_format(epoch_days(x), "yyyy-MM-dd")


def bit_to_int(x: Column) -> Column:
    return F.when(x == "true", 1).when(x == "false", 0)


def iso_to_number(x: Column, on_error: str = "fail") -> Column:
    return F.date_format(iso_to_utc(x, on_error), "yyyyMMddHHmmss").cast("bigint")


def ist_now(run_ts: Column) -> Column:
    """The run's time (a UTC wall clock) in +05:30."""
    return F.timestamp_add("MINUTE", F.lit(330), run_ts)


def boolean(x: Column) -> Column:
    low = F.lower(x)
    return F.when(low.isin("true", "1"), True).when(low.isin("false", "0"), False)


def json_value(x: Column) -> Column:
    return F.try_parse_json(x)


def coerce(v: Column, spec: ColumnSpec, cfg: JobConfig, run_ts: Column, profile: str = UPSERT, on_error: str = "fail", strict_scalar_json: bool = False) -> Column:
    """The column of the target that ``spec`` describes, from the parsed row image ``v``."""
    key = cfg.json_key_overrides.get(spec.name, spec.name)
    has = lambda names: spec.name in names
    x, kind, name = scalar_text(v, key, profile), spec.type, spec.name.lower()
    as_target = lambda c: c if c is None else cast(c, kind, on_error)
    if name == "sysendtime":
        return as_target(sys_end_time())
    if name == "rowkeynum" and cfg.row_key_binary:
        return as_target(row_key_from_base64(scalar_text(v, cfg.row_key_binary, profile)))
    if name == "rowkeynum" and cfg.row_key_timestamp:
        return as_target(row_key_from_time(scalar_text(v, cfg.row_key_timestamp, profile)))
    if has(cfg.epoc_nano_cols):
        return as_target(epoch_nanos(x, on_error))
    if has(cfg.epoc_day_cols):
        return as_target(epoch_days(x))
    if has(cfg.epoc_cols) and profile == OP_GATED:
        return as_target(epoch_seconds(x, on_error))
    if has(cfg.bit_to_int_col):
        return as_target(bit_to_int(x))
    if has(cfg.epoch_to_date_to_string_col):
        return as_target(epoch_day_text(x))
    if has(cfg.epoc_datetime_ist):
        return as_target(epoch_seconds_ist(x, on_error))
    if has(cfg.non_epoch_datetime_col):
        return as_target(iso_to_utc(x, on_error) if profile == UPSERT else iso_to_wall(x, on_error))
    if has(cfg.datetime_to_int_val_col):
        return as_target(iso_to_number(x, on_error))
    if has(cfg.col_value_as_current_time_ist):
        return as_target(ist_now(run_ts))
    if isinstance(kind, T.BooleanType):
        return boolean(x)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        if profile == OP_GATED:
            return as_target(iso_to_wall(x, on_error))
        # by form: a number is epoch milliseconds, other text is ISO
        return as_target(F.when(x.rlike(r"^[+-]?\d+(\.\d+)?$"), epoch_millis(F.when(x.rlike(r"^[+-]?\d+(\.\d+)?$"), x), on_error)).otherwise(iso_to_utc(F.when(~x.rlike(r"^[+-]?\d+(\.\d+)?$"), x), on_error)))
    if isinstance(kind, T.VariantType):
        whole = F.variant_get(v, path(key), "variant")
        return json_value(x) if strict_scalar_json else F.when(F.coalesce(F.schema_of_variant(whole).rlike("^(OBJECT|ARRAY)"), F.lit(False)), whole).otherwise(json_value(get(v, key, "string")))
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.from_json(get(v, key, "string"), kind)
    if isinstance(kind, (T.VarcharType, T.CharType)):
        return F.substring(x, 1, kind.length)
    if isinstance(kind, T.StringType):
        return x
    return cast(x, kind, on_error)


def project(cfg: JobConfig, specs: list[ColumnSpec], run_ts: Column, profile: str = UPSERT, on_error: str = "fail") -> list[Column]:
    return [coerce(F.col("_v"), s, cfg, run_ts, profile, on_error).alias(s.name) for s in specs]


def metadata(spec: ColumnSpec, log_columns: list[str], run_ts: Column) -> Column:
    """A reserved column from the change's envelope, never from its image; those that a log may carry itself are taken from there."""
    name = spec.name.lower()
    if name == "source_ts_ns_order":
        value = epoch_nanos(F.col("_ts_ns"))
    elif name == "pos":
        value = F.col("_pos")
    elif name == "__op":
        value = F.col("_op")
    elif name in ("bq_load_ts", "mysql_load_ts"):
        value = F.col("load_ts")
    elif name in ("bigquery_updated_on", "mysql_updated_on"):
        value = run_ts
    else:
        have = {c.lower(): c for c in log_columns}
        value = F.col(f"`{have[name]}`") if name in have else F.lit(None)
    return value.cast(spec.type)


def target_row(cfg: JobConfig, specs: list[ColumnSpec], log_columns: list[str], run_ts: Column, profile: str = UPSERT, on_error: str = "fail") -> list[Column]:
    """Every column of the target: reserved ones from the envelope, the others from the image."""
    own = lambda s: metadata(s, log_columns, run_ts) if s.name.lower() in RESERVED and s.name not in cfg.json_key_overrides else coerce(F.col("_v"), s, cfg, run_ts, profile, on_error)
    return [own(s).alias(s.name) for s in specs]


def unreadable(v: Column, specs: list[ColumnSpec], cfg: JobConfig, run_ts: Column, profile: str = UPSERT, but: tuple[str, ...] = ()) -> Column:
    """True if a value that is there doesn't convert: what the quarantine policy sets aside; ``but``: columns that are checked elsewhere."""
    out = F.lit(False)
    for s in (s for s in specs if s.name.lower() not in RESERVED and s.name not in but):
        x = scalar_text(v, cfg.json_key_overrides.get(s.name, s.name), profile)
        if not isinstance(s.type, (T.StringType, T.VariantType)):
            out = out | (x.isNotNull() & coerce(v, s, cfg, run_ts, profile, "null").isNull())
    return out
