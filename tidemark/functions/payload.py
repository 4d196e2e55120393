"""Reading the JSON row image: envelope, keys and scalar text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPSERT, OP_GATED = "upsert", "op_gated"


def path(key: str) -> str:
    """A JSON path for one key, whatever characters it holds."""
    return "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def parsed(data: Column, safe: bool = False) -> Column:
    return F.try_parse_json(data) if safe else F.parse_json(data)


def get(v: Column, key: str, kind: str) -> Column:
    return F.try_variant_get(v, path(key), kind)


def is_nested(v: Column, key: str) -> Column:
    return F.schema_of_variant(F.variant_get(v, path(key), "variant")).rlike("^(OBJECT|ARRAY)")


def scalar_text(v: Column, key: str, profile: str = UPSERT, strict: bool = True) -> Column:
    """The text of a scalar.

    ``upsert``: objects and arrays are null, the text ``null`` stays.  ``op_gated``: objects
    and arrays are their JSON text, the text ``null`` is null.  A missing key and a JSON
    null are null in both.
    """
    text = get(v, key, "string")
    if profile == OP_GATED:
        return F.nullif(text, F.lit("null"))
    return F.when(~F.coalesce(is_nested(v, key), F.lit(False)), text) if strict else text


def envelope(log: DataFrame, keys: list[tuple[str, str, str]], profile: str = UPSERT, safe: bool = False) -> DataFrame:
    """The log with its parsed image ``_v``, the envelope and the typed keys.

    ``keys``: (column, JSON key, type).  ``op_gated`` reads a JSON null operation as the
    text ``null``, which is no delete; ``upsert`` drops such rows later on.
    """
    # through a generator, since a filter on what is read from the image would be pushed to the
    # scan with a parse of its own for each field that it names
    v = log.select("*", F.inline(F.array(F.struct(parsed(F.col("data"), safe).alias("_v")))))
    op = get(F.col("_v"), "__op", "string")
    if profile == OP_GATED:
        there = F.is_variant_null(F.variant_get(F.col("_v"), path("__op"), "variant"))
        op = F.when(F.coalesce(there, F.lit(False)), F.lit("null")).otherwise(op)
    cols = [op.alias("_op"), get(F.col("_v"), "__ts_ns", "bigint").alias("_ts_ns"), get(F.col("_v"), "__source_pos", "bigint").alias("_pos")]
    return v.select("*", *cols, *[get(F.col("_v"), k, t).alias(c) for c, k, t in keys])


def there(v: Column, key: str) -> Column:
    """The key is there, and not a JSON null."""
    whole = F.variant_get(v, path(key), "variant")
    return F.coalesce(~F.is_variant_null(whole), F.lit(False))


def rejected(keys: list[tuple[str, str, str]], allow_null: bool = False) -> Column:
    """Why an enveloped change can't be applied, or null.

    ``json``: the image doesn't parse; ``key``: a key is null or doesn't read as its type
    (with ``allow_null`` only the latter); ``version``, ``position``: such a field is there
    but doesn't read.
    """
    v = F.col("_v")
    lost = F.lit(False)
    for c, k, _ in keys:
        lost = lost | (F.col(c).isNull() & (there(v, k) if allow_null else F.lit(True)))
    return (
        F.when(v.isNull(), "json").when(lost, "key")
        .when(F.col("_ts_ns").isNull() & there(v, "__ts_ns"), "version").when(F.col("_pos").isNull() & there(v, "__source_pos"), "position")
    )
