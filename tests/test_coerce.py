from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce as co
from tidemark.functions import payload as pl
from tidemark.operators import window
from tidemark.sources.config import JobConfig
from tidemark.sources.schema import ColumnSpec, specs

RUN = datetime(2024, 2, 1, 12)

CASES = [
    (co.row_key_from_base64, "AAAAAAAAAAU=", 5), (co.row_key_from_base64, "//////////8=", -1), (co.row_key_from_base64, None, None),
    (co.row_key_from_time, "1970-01-01T00:00:07Z", 7),
    (co.epoch_nanos, "1999", datetime(1970, 1, 1, 0, 0, 0, 1)), (co.epoch_nanos, "-1", datetime(1969, 12, 31, 23, 59, 59, 999999)), (co.epoch_nanos, "0", datetime(1970, 1, 1)), (co.epoch_nanos, "9007199254740993000", datetime(2255, 6, 5, 23, 47, 34, 740993)),
    (co.epoch_days, "-1", date(1969, 12, 31)), (co.epoch_days, "2932896", date(9999, 12, 31)), (co.epoch_days, "x", None), (co.epoch_days, "0", date(1970, 1, 1)),
    (co.epoch_seconds, "-1", datetime(1969, 12, 31, 23, 59, 59)),
    (co.epoch_millis, "1.6", datetime(1970, 1, 1, 0, 0, 0, 2000)), (co.epoch_millis, "-1", datetime(1969, 12, 31, 23, 59, 59, 999000)),
    (co.epoch_seconds_ist, "0", datetime(1970, 1, 1, 5, 30)), (co.epoch_day_text, "1", "1970-01-02"),
    (co.bit_to_int, "true", 1), (co.bit_to_int, "false", 0), (co.bit_to_int, "TRUE", None), (co.bit_to_int, None, None),
    (co.boolean, "TRUE", True), (co.boolean, "1", True), (co.boolean, "False", False), (co.boolean, "0", False), (co.boolean, "yes", None),
    (co.iso_to_utc, "2024-01-01T00:00:00.123456Z", datetime(2024, 1, 1, 0, 0, 0, 123456)), (co.iso_to_utc, "2024-01-01T05:30:00+05:30", datetime(2024, 1, 1)), (co.iso_to_utc, "2024-01-01", datetime(2024, 1, 1)), (co.iso_to_utc, "9999-12-31T23:59:59Z", datetime(9999, 12, 31, 23, 59, 59)),
    (co.iso_to_wall, "2024-01-01T01:02:03Z", datetime(2024, 1, 1, 1, 2, 3)), (co.iso_to_number, "2024-01-02T03:04:05Z", 20240102030405),
]


def test_rules(spark):
    row = spark.range(1).select(*[f(F.lit(x).cast("string")).alias(f"c{i}") for i, (f, x, _) in enumerate(CASES)]).first()
    assert list(row) == [want for _, _, want in CASES]


def value(spark, data, kind, profile=pl.UPSERT, on_error="fail", name="a", **cfg):
    spec = ColumnSpec(name, T._parse_datatype_string(kind) if isinstance(kind, str) else kind, 1)
    df = spark.createDataFrame([(data,)], "data string").withColumn("_v", pl.parsed(F.col("data")))
    return df.select(co.coerce(F.col("_v"), spec, JobConfig("d", "t", "c", ("a",), **cfg), window.ntz(RUN), profile, on_error).alias("x")).first()["x"]


def test_json_scalars(spark):
    assert value(spark, '{"a": 12345678901234567890.12}', "decimal(38,2)") == Decimal("12345678901234567890.12")
    assert value(spark, '{"a": 9007199254740993}', "bigint") == 9007199254740993
    assert value(spark, '{"a": {"b": 1}}', "string") is None
    assert value(spark, '{"a": {"b": 1}}', "string", pl.OP_GATED) == '{"b":1}'
    assert value(spark, '{"a": "null"}', "string") == "null"
    assert value(spark, '{"a": "null"}', "string", pl.OP_GATED) is None
    assert value(spark, "{}", "string") is None and value(spark, '{"a": null}', "int") is None


def test_precedence_and_keys(spark):
    assert value(spark, '{"a": "7"}', "timestamp_ntz", epoc_nano_cols=("a",), epoc_day_cols=("a",)) == datetime(1970, 1, 1)
    assert value(spark, '{"A x": "7"}', "int", json_key_overrides={"a": "A x"}) == 7
    assert value(spark, "{}", "timestamp_ntz", name="SysEndTime") == datetime(9999, 12, 31, 23, 59, 59, 999999)
    assert value(spark, '{"rk": "AAAAAAAAAAU="}', "bigint", name="rowkeynum", row_key_binary="rk") == 5
    assert value(spark, "{}", "timestamp_ntz", col_value_as_current_time_ist=("a",)) == datetime(2024, 2, 1, 17, 30)
    assert value(spark, '{"a": "abcdef"}', T.VarcharType(3)) == "abc"
    assert value(spark, '{"a": [1, 2]}', "array<int>") == [1, 2]
    assert value(spark, '{"a": 86400000}', "timestamp_ntz") == datetime(1970, 1, 2)
    assert value(spark, '{"a": "1970-01-02T00:00:00Z"}', "timestamp_ntz") == datetime(1970, 1, 2)


def test_error_policies(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, '{"a": "x"}', "int")
    assert value(spark, '{"a": "x"}', "int", on_error="null") is None


def test_reserved_columns_are_not_read(spark):
    target = T.StructType.fromDDL("id bigint, Publish_Time timestamp, message_id string, v int")
    assert [s.name for s in specs(target)] == ["id", "v"]
