"""Queries of the merge engine, one or more an operator, and the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce as co
from ..functions import payload as pl
from ..operators import apply, stage, window
from ..sources import config as conf
from ..sources import feeds, runlog
from ..sources import schema as sch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

KEYS = ["user_id", "k"]
TARGET = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("pos", T.LongType())])
COLS = ["user_id", "k", "event_type", "value", "pos"]
JOB = conf.JobConfig("silver", "events", "events_cdc", tuple(KEYS), json_key_overrides={"pos": "__source_pos"})
RUN_TS = datetime(2024, 2, 1)
ENDS = [datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2024, 2, 1)]

# --- the logs in SQL -----------------------------------------------------------------

E1 = """e1 as (select user_id, cast(props->>'$.k' as bigint) as k, event_type, value, event_id as pos, epoch_us(ts) * 1000 as ts_ns, ts as load_ts,
    case when event_id % 97 = 0 then null when event_id % 5 = 0 then 'd' when event_id % 7 = 0 then 'c' else 'u' end as op from events)"""


def _latest(cond: str, keys: str = "user_id, k", src: str = "e1") -> str:
    return f"select * from {src} where {cond} qualify row_number() over (partition by {keys} order by ts_ns desc, pos desc) = 1"


def _window_sql(start: str, end: str) -> str:
    return f"load_ts > {start} and load_ts <= timestamp '{end}'"


W1 = _window_sql("timestamp '1970-01-01'", "2024-01-11")
W12 = _window_sql("timestamp '1970-01-01'", "2024-01-21")
I1 = f"i1 as ({_latest(W1 + ' and op is not null and op <> ' + chr(39) + 'd' + chr(39))})"
D1 = f"d1 as ({_latest(W1 + ' and op = ' + chr(39) + 'd' + chr(39))})"
A1 = "a1 as (select d1.* from d1 left join i1 using (user_id, k) where i1.pos is null or i1.ts_ns < d1.ts_ns)"
T1 = "t1 as (select user_id, k, event_type, value, pos from i1 where not exists (from a1 where a1.user_id = i1.user_id and a1.k = i1.k))"


def windows_sql(profile: str, n: int = 3, part: str = "target") -> str:
    """The merge of ``n`` windows, the next starting at the last upsert's load time."""
    ctes = [E1, "t0 as (select user_id, k, event_type, value, pos from e1 where false)"]
    for w, end in enumerate(ENDS[:n], 1):
        start = "timestamp '1970-01-01'" if w == 1 else f"(select max(load_ts) from i{w - 1})"
        cond = _window_sql(start, f"{end:%Y-%m-%d}")
        ctes.append(f"i{w} as ({_latest(cond + ' and op is not null and op <> ' + chr(39) + 'd' + chr(39))})")
        ctes.append(f"d{w} as ({_latest(cond + ' and op = ' + chr(39) + 'd' + chr(39))})")
        ctes.append(f"a{w} as (select d.* from d{w} d left join i{w} i using (user_id, k) where i.pos is null or i.ts_ns < d.ts_ns)")
        old, cols = f"t{w - 1}", "user_id, k, event_type, value, pos"
        gate = " and i.op = 'u'" if profile == "op_gated" else ""
        same = "i.user_id = t.user_id and i.k = t.k"
        ctes.append(f"u{w} as (select t.* from {old} t where not exists (from i{w} i where {same}{gate}) union all select {cols} from i{w} i where {('(i.op = ' + chr(39) + 'u' + chr(39) + ' and exists (from ' + old + ' t where ' + same + ')) or ') if gate else ''}{'not exists (from ' + old + ' t where ' + same + ')' if gate else 'true'})")
        ctes.append(f"t{w} as (select {cols} from u{w} t where not exists (from a{w} i where {same}))")
    return "with " + ",\n".join(ctes) + f"\nselect * from t{n}"


# --- the logs in Spark ---------------------------------------------------------------


def enveloped(spark: SparkSession, sf_dir: str, profile: str = pl.UPSERT) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return pl.envelope(feeds.events(spark, sf_dir), [("user_id", "user_id", "bigint"), ("k", "k", "bigint")], profile)


def plain(df: DataFrame, *more: str) -> DataFrame:
    """The stage's rows as ordinary columns."""
    v = F.col("_v")
    image = [pl.get(v, "event_type", "string").alias("event_type"), pl.get(v, "value", "double").alias("value")]
    return df.select("user_id", "k", *image, F.col("_pos").alias("pos"), F.col("_ts_ns").alias("ts_ns"), *more)


def staged(spark: SparkSession, sf_dir: str, start: datetime = window.EPOCH, end: datetime = ENDS[0], fused: bool = False):
    from .engine import Options, stages

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return stages(window.in_window(feeds.events(spark, sf_dir), start, end), JOB, TARGET, RUN_TS, Options(fused=fused))


def empty_target(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TARGET)


def replay(spark: SparkSession, sf_dir: str, profile: str, windows: int = 3, fused: bool = False) -> DataFrame:
    """The target after some windows; each starts at the last upsert's load time (one scalar a window)."""
    from .engine import Options, stages

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    log = feeds.events(spark, sf_dir)
    target, start = empty_target(spark), window.EPOCH
    for n, end in enumerate(ENDS[:windows]):
        got = stages(window.in_window(log, start, end), JOB, TARGET, RUN_TS, Options(profile=profile, fused=fused))
        target = apply.applied(target, got.changes, KEYS, profile)
        if n + 1 < windows:
            start = got.upserts.agg(F.max("load_ts")).first()[0] or start
    return target


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


# --- log, window, filters ------------------------------------------------------------


@query("feed_events", f"with {E1} select user_id, k, event_type, value, pos, ts_ns, op, load_ts from e1")
def feed_events(spark, sf_dir):
    return plain(enveloped(spark, sf_dir), F.col("_op").alias("op"), "load_ts")


@query("window_filter", f"with {E1} select pos, load_ts from e1 where {W1}")
def window_filter(spark, sf_dir):
    log = window.in_window(enveloped(spark, sf_dir), window.EPOCH, ENDS[0])
    return log.select(F.col("_pos").alias("pos"), "load_ts")


@query("op_filters", f"with {E1} select case when op = 'd' then 'delete' else 'upsert' end as kind, count(*) as n, cast(sum(pos) as bigint) as sum_pos from e1 where op is not null group by 1")
def op_filters(spark, sf_dir):
    log = enveloped(spark, sf_dir).where(F.col("_op").isNotNull())
    return log.groupBy(F.when(F.col("_op") == "d", "delete").otherwise("upsert").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum("_pos").alias("sum_pos"))


# --- stage ---------------------------------------------------------------------------


@query("latest_upserts_single_pk", f"with {E1}, l as ({_latest('op is not null and op <> ' + chr(39) + 'd' + chr(39), 'user_id')}) select user_id, k, event_type, value, pos, ts_ns from l")
def latest_upserts_single_pk(spark, sf_dir):
    return plain(stage.latest_upserts(enveloped(spark, sf_dir), ["user_id"]))


@query("latest_upserts_multi_pk", f"with {E1}, {I1} select user_id, k, event_type, value, pos, ts_ns from i1")
def latest_upserts_multi_pk(spark, sf_dir):
    return plain(stage.latest_upserts(window.in_window(enveloped(spark, sf_dir), window.EPOCH, ENDS[0]), KEYS))


@query("latest_deletes", f"with {E1}, {D1} select user_id, k, pos, ts_ns from d1")
def latest_deletes(spark, sf_dir):
    return plain(stage.latest_deletes(window.in_window(enveloped(spark, sf_dir), window.EPOCH, ENDS[0]), KEYS)).drop("event_type", "value")


@query("arbitrated_deletes", f"with {E1}, {I1}, {D1}, {A1} select user_id, k, pos, ts_ns from a1")
def arbitrated_deletes(spark, sf_dir):
    log = window.in_window(enveloped(spark, sf_dir), window.EPOCH, ENDS[0])
    return plain(stage.arbitrate(stage.latest_deletes(log, KEYS), stage.latest_upserts(log, KEYS), KEYS)).drop("event_type", "value")


@query("latest_by_iso_time", f"with {E1}, {I1} select user_id, k, event_type, value, pos, ts_ns from i1")
def latest_by_iso_time(spark, sf_dir):
    """The log writes its source time as ISO text."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    data = F.regexp_replace("data", r'"__ts_ns":\d+', F.concat(F.lit('"__ts_ns":"'), F.date_format("load_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit('"')))
    log = pl.envelope(feeds.events(spark, sf_dir).withColumn("data", data), [("user_id", "user_id", "bigint"), ("k", "k", "bigint")])
    return plain(stage.latest_upserts(stage.iso_versions(window.in_window(log, window.EPOCH, ENDS[0])), KEYS))


@query("fused_latest", f"with {E1}, {I1}, {D1}, {A1} select 'I' as kind, user_id, k, pos, ts_ns from i1 union all select 'D', user_id, k, pos, ts_ns from a1")
def fused_latest(spark, sf_dir):
    log = window.in_window(enveloped(spark, sf_dir), window.EPOCH, ENDS[0])
    return stage.fused(log, KEYS, []).select("kind", *KEYS, F.col("_pos").alias("pos"), F.col("_ts_ns").alias("ts_ns"))


@query("stage_stats", f"with {E1}, {I1}, {D1}, {A1} select (select count(*) from i1) as records_inserted, (select count(*) from a1) as records_deleted, (select min(load_ts) from i1) as min_load_ts, (select max(load_ts) from i1) as max_load_ts")
def stage_stats(spark, sf_dir):
    got = staged(spark, sf_dir)
    return stage.stage_stats(got.upserts, got.deletes).drop("max_any_load_ts")


@query("stage_repeated_keys", "select l_orderkey, l_linenumber, count(*) as count from lineitem group by all having count(*) > 1")
def stage_repeated_keys(spark, sf_dir):
    return apply.repeated_keys(feeds.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


L1_SQL = """with l as (select *, l_partkey * 100000 + l_suppkey as pos, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey * 100000 + l_suppkey desc) as rn from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, pos from l where rn = 1"""


@query("dedup_lineitem", L1_SQL)
def dedup_lineitem(spark, sf_dir):
    keys = [("l_orderkey", "l_orderkey", "bigint"), ("l_linenumber", "l_linenumber", "int")]
    log = pl.envelope(feeds.lineitem(spark, sf_dir), keys)
    image = [pl.get(F.col("_v"), c, t).alias(c) for c, t in (("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_quantity", "double"))]
    envelope = ["_op", "_ts_ns", "_pos", "load_ts", "data"]
    log = log.select("l_orderkey", "l_linenumber", *image, *envelope)  # typed before the shuffle: every row is wanted
    return stage.latest_upserts(log, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("_pos").alias("pos"))


# --- merge ---------------------------------------------------------------------------


@query("upsert_merge", f"with {E1}, {I1}, {D1}, {A1}, {T1} select * from t1")
def upsert_merge(spark, sf_dir):
    got = staged(spark, sf_dir)
    return apply.merge(empty_target(spark), got.upserts, got.deletes, KEYS)


@query("upsert_merge_fused", f"with {E1}, {I1}, {D1}, {A1}, {T1} select * from t1")
def upsert_merge_fused(spark, sf_dir):
    got = staged(spark, sf_dir, fused=True)
    return apply.applied(empty_target(spark), got.changes, KEYS)


#: A base to merge into: the first window's result; and the second window's stage.
SECOND = f"""{E1}, {I1}, {D1}, {A1}, {T1},
i2 as ({_latest(_window_sql("timestamp '2024-01-11'", '2024-01-21') + ' and op is not null and op <> ' + chr(39) + 'd' + chr(39))}),
d2 as ({_latest(_window_sql("timestamp '2024-01-11'", '2024-01-21') + ' and op = ' + chr(39) + 'd' + chr(39))}),
a2 as (select d2.* from d2 left join i2 using (user_id, k) where i2.pos is null or i2.ts_ns < d2.ts_ns)"""


def second(spark, sf_dir):
    one = staged(spark, sf_dir)
    return apply.merge(empty_target(spark), one.upserts, one.deletes, KEYS), staged(spark, sf_dir, ENDS[0], ENDS[1])


@query("op_gated_update", f"with {SECOND} select t.user_id, t.k, coalesce(i.event_type, t.event_type) as event_type, coalesce(i.value, t.value) as value, coalesce(i.pos, t.pos) as pos from t1 t left join (select * from i2 where op = 'u') i on t.user_id = i.user_id and t.k = i.k")
def op_gated_update(spark, sf_dir):
    target, got = second(spark, sf_dir)
    return apply.update_matched(target, got.upserts.where(F.col("_op") == "u"), KEYS)


@query("insert_not_exists", f"with {SECOND} select user_id, k, event_type, value, pos from i2 where not exists (from t1 where t1.user_id = i2.user_id and t1.k = i2.k)")
def insert_not_exists(spark, sf_dir):
    target, got = second(spark, sf_dir)
    return apply.insert_missing(target, got.upserts, KEYS)


@query("delete_matched", f"with {SECOND} select * from t1 where not exists (from a2 where t1.user_id = a2.user_id and t1.k = a2.k)")
def delete_matched(spark, sf_dir):
    target, got = second(spark, sf_dir)
    return apply.delete_matched(target, got.deletes, KEYS)


@query("guard_late_merge", f"with {E1}, {I1}, f as (select * from e1 where op is not null and op <> 'd' and {_window_sql(chr(116) + 'imestamp ' + chr(39) + '2024-01-11' + chr(39), '2024-01-21')}), late as ({_latest('true', src='f')}), both_ as (select * from i1 union all select * from late) select user_id, k, event_type, value, pos, ts_ns from both_ qualify row_number() over (partition by user_id, k order by ts_ns desc) = 1")
def guard_late_merge(spark, sf_dir):
    """The second window's upserts are loaded first, then the first's, which must not overwrite newer rows."""
    one, two = staged(spark, sf_dir), staged(spark, sf_dir, ENDS[0], ENDS[1])
    shape = lambda s: s.upserts.withColumn("ts_ns", F.col("_ts_ns"))
    target = shape(two).select(*COLS, "ts_ns")
    return apply.upsert(target, shape(one), KEYS, version="ts_ns")


@query("three_window_upsert", windows_sql("upsert"))
def three_window_upsert(spark, sf_dir):
    return replay(spark, sf_dir, pl.UPSERT)


@query("three_window_op_gated", windows_sql("op_gated"))
def three_window_op_gated(spark, sf_dir):
    return replay(spark, sf_dir, pl.OP_GATED, fused=True)


@query("three_window_upsert_fused", windows_sql("upsert"))
def three_window_upsert_fused(spark, sf_dir):
    return replay(spark, sf_dir, pl.UPSERT, fused=True)


@query("snapshot_orders", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def snapshot_orders(spark, sf_dir):
    from .engine import stages

    cfg = conf.JobConfig("silver", "orders", "orders_cdc", ("o_orderkey",))
    target = T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")
    got = stages(feeds.orders(spark, sf_dir), cfg, target, RUN_TS)
    return apply.applied(spark.createDataFrame([], target), got.changes, ["o_orderkey"])


@query("key_cast_join", "select o_orderkey, o_totalprice from orders where o_orderkey in (select l_orderkey from lineitem)")
def key_cast_join(spark, sf_dir):
    """Keys arrive as zero-padded text, with every line of an order, and must meet the target's numbers."""
    o, li = feeds.read(spark, sf_dir, "orders"), feeds.read(spark, sf_dir, "lineitem")
    texts = li.select(F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("key_text"))
    return o.join(texts.select(F.col("key_text").cast("bigint").alias("o_orderkey")), "o_orderkey", "left_semi").select("o_orderkey", "o_totalprice")


# --- coercion ------------------------------------------------------------------------


def _orders_text(spark, sf_dir, profile=pl.UPSERT):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return pl.envelope(feeds.orders(spark, sf_dir), [("o_orderkey", "o_orderkey", "bigint")], profile)


def rule(name: str, key: str, make, sql: str, profile: str = pl.UPSERT):
    def run(spark, sf_dir):
        return _orders_text(spark, sf_dir, profile).select("o_orderkey", make(pl.scalar_text(F.col("_v"), key, profile)).alias("v"))

    query(name, f"select o_orderkey, {sql} as v from orders")(run)


rule("coerce_sys_end_time", "od_iso", lambda x: co.sys_end_time().cast("string"), "'9999-12-31 23:59:59.999999'")
rule("coerce_row_key_binary", "rowkey_b64", co.row_key_from_base64, "o_orderkey")
rule("coerce_row_key_time", "od_iso", co.row_key_from_time, "epoch_us(o_orderdate) // 1000000")
rule("coerce_epoch_nanos", "od_nano", co.epoch_nanos, "o_orderdate")
rule("coerce_epoch_days", "od_day", co.epoch_days, "cast(o_orderdate as date)")
rule("coerce_epoch_seconds", "od_sec", co.epoch_seconds, "date_trunc('second', o_orderdate)")
rule("coerce_epoch_seconds_ist", "od_sec", co.epoch_seconds_ist, "date_trunc('second', o_orderdate) + interval 330 minute")
rule("coerce_epoch_millis", "od_ms", co.epoch_millis, "date_trunc('millisecond', o_orderdate)")
rule("coerce_epoch_day_text", "od_day", co.epoch_day_text, "strftime(o_orderdate, '%Y-%m-%d')")
rule("coerce_bit", "is_open_bit", co.bit_to_int, "cast(o_orderstatus = 'O' as int)")
rule("coerce_bool", "is_open_bool", co.boolean, "o_orderkey % 4 < 2")
rule("coerce_iso_datetime", "od_iso", co.iso_to_utc, "date_trunc('second', o_orderdate)")
rule("coerce_iso_wall", "od_iso", co.iso_to_wall, "date_trunc('second', o_orderdate)", pl.OP_GATED)
rule("coerce_iso_to_number", "od_iso", co.iso_to_number, "cast(strftime(o_orderdate, '%Y%m%d%H%M%S') as bigint)")
rule("coerce_ist_now", "od_iso", lambda x: co.ist_now(window.ntz(RUN_TS)), "timestamp '2024-02-01 05:30:00'")
rule("coerce_json", "attrs", lambda x: F.try_variant_get(co.json_value(x), "$.p", "string"), "case when o_orderkey % 50 <> 0 then o_orderpriority end")
rule("coerce_decimal", "price_txt", lambda x: x.cast("decimal(18,2)"), "cast(o_totalprice as decimal(18,2))")


@query(
    "coerce_type_switch",
    """select o_orderkey, substr(o_orderstatus || '-' || o_custkey, 1, 4) as fixed, substr('n' || o_orderkey, 1, 3) as short_text, cast(o_orderkey % 100 as tinyint) as tiny, cast(o_orderkey % 30000 as smallint) as small,
    cast(o_custkey as int) as medium, o_orderkey * 4000000000 as wide, cast(o_totalprice as float) as single, o_totalprice as amount, cast(round(o_totalprice, 2) as decimal(12,2)) as exact, cast(o_orderdate as date) as day, date_trunc('second', o_orderdate) as at
    from orders""",
)
def coerce_type_switch(spark, sf_dir):
    """Every type that the target may declare, from JSON text alone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    o, n = feeds.read(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = lambda c: c.cast("string")
    payload = [
        n, F.concat("o_orderstatus", F.lit("-"), text(F.col("o_custkey"))).alias("fixed"), F.concat(F.lit("n"), text(n)).alias("short_text"), text(n % 100).alias("tiny"), text(n % 30000).alias("small"), text(F.col("o_custkey")).alias("medium"),
        text(n * F.lit(4000000000)).alias("wide"), F.col("o_totalprice").alias("single"), text(F.col("o_totalprice")).alias("amount"), text(F.round("o_totalprice", 2).cast("decimal(12,2)")).alias("exact"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
    ]
    log = feeds.as_log(o, payload, F.lit("c"), F.col("o_orderdate"), n)
    declared = [("o_orderkey", T.LongType()), ("fixed", T.CharType(4)), ("short_text", T.VarcharType(3)), ("tiny", T.ByteType()), ("small", T.ShortType()), ("medium", T.IntegerType()), ("wide", T.LongType()), ("single", T.FloatType()), ("amount", T.DoubleType()), ("exact", T.DecimalType(12, 2)), ("day", T.DateType()), ("at", T.TimestampNTZType())]
    cols = [sch.ColumnSpec(name, kind, i + 1) for i, (name, kind) in enumerate(declared)]
    return pl.envelope(log, [("o_orderkey", "o_orderkey", "bigint")]).select(*co.project(conf.JobConfig("silver", "o", "o", ("o_orderkey",)), cols, window.ntz(RUN_TS)))


rule("coerce_null_text", "nullish", lambda x: x, "case when o_orderkey % 4 > 1 then o_orderpriority end", pl.OP_GATED)
rule("coerce_null_text_kept", "nullish", lambda x: x, "case o_orderkey % 4 when 0 then null when 1 then 'null' else o_orderpriority end")


SAMPLES = """(1, '{"a": 7}'), (2, '{"a": null}'), (3, '{}'), (4, '{"a": "null"}'), (5, '{"a": {"b": 1}}'), (6, '{"a": [1, 2]}'), (7, '{"a": true}'), (8, '{"a b": 1}')"""


@query(
    "coerce_json_null_policies",
    f"""with s(id, data) as (values {SAMPLES}), j as (select id, json_type(data, '$.a') as t, data->>'$.a' as x from s)
    select id, case when t in ('OBJECT', 'ARRAY') then null else x end as upsert_text, case when x = 'null' then null else x end as gated_text from j""".replace('{"b": 1}', '{"b":1}').replace("[1, 2]", "[1,2]"),
)
def coerce_json_null_policies(spark, sf_dir):
    rows = spark.sql(f"select * from values {SAMPLES} as t(id, data)").withColumn("_v", pl.parsed(F.col("data")))
    v = F.col("_v")
    return rows.select("id", pl.scalar_text(v, "a").alias("upsert_text"), pl.scalar_text(v, "a", pl.OP_GATED).alias("gated_text"))


@query("json_key_override", f"with {E1} select pos, event_type as kind from e1")
def json_key_override(spark, sf_dir):
    """The target's column ``kind`` is read from another key."""
    cfg = conf.JobConfig("silver", "x", "x", ("pos",), json_key_overrides={"kind": "event_type", "pos": "__source_pos"})
    target = T.StructType.fromDDL("pos bigint, kind string")
    rows = enveloped(spark, sf_dir)
    return rows.select(*co.project(cfg, sch.specs(target, skip_reserved=False), window.ntz(RUN_TS)))


def with_metadata(spark, sf_dir, more: str, profile: str):
    """The first window's upserts for a target with reserved columns."""
    from .engine import Options, stages

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    log = window.in_window(feeds.events(spark, sf_dir), window.EPOCH, ENDS[0]).withColumn("message_id", F.concat(F.lit("m"), F.unix_micros(F.col("load_ts").cast("timestamp"))))
    target = T.StructType.fromDDL(f"user_id bigint, k bigint, event_type string, {more}")
    got = stages(log, conf.JobConfig("silver", "events", "events_cdc", tuple(KEYS)), target, RUN_TS, Options(profile=profile))
    return got.changes.where("i is not null").select("i.*").select(*target.fieldNames())


@query("metadata_projection_upsert", f"with {E1}, {I1} select user_id, k, event_type, make_timestamp(ts_ns // 1000) as source_ts_ns_order, cast(null as timestamp) as publish_time, load_ts as bq_load_ts, pos, timestamp '2024-02-01' as bigquery_updated_on, 'm' || epoch_us(load_ts) as message_id from i1")
def metadata_projection_upsert(spark, sf_dir):
    """Reserved columns come from the envelope and the log's own columns, never from the image."""
    return with_metadata(spark, sf_dir, "source_ts_ns_order timestamp_ntz, publish_time timestamp_ntz, bq_load_ts timestamp_ntz, pos bigint, bigquery_updated_on timestamp_ntz, message_id string", pl.UPSERT)


@query("metadata_projection_op_gated", f"with {E1}, {I1} select user_id, k, event_type, make_timestamp(ts_ns // 1000) as source_ts_ns_order, pos, load_ts as mysql_load_ts, timestamp '2024-02-01' as mysql_updated_on, op as __op from i1")
def metadata_projection_op_gated(spark, sf_dir):
    return with_metadata(spark, sf_dir, "source_ts_ns_order timestamp_ntz, pos bigint, mysql_load_ts timestamp_ntz, mysql_updated_on timestamp_ntz, `__op` string", pl.OP_GATED)


@query("target_shape_projection", "select o_orderkey, cast(o_totalprice as decimal(18,2)) as price_txt, date_trunc('second', o_orderdate) as od_iso, cast(o_orderdate as date) as od_day, o_orderkey % 4 < 2 as is_open_bool, cast(o_orderstatus = 'O' as int) as is_open_bit, o_orderdate as od_nano from orders")
def target_shape_projection(spark, sf_dir):
    """The target's schema and the rule lists give the whole projection."""
    cfg = conf.JobConfig("silver", "o", "o", ("o_orderkey",), epoc_nano_cols=("od_nano",), epoc_day_cols=("od_day",), bit_to_int_col=("is_open_bit",), non_epoch_datetime_col=("od_iso",))
    target = T.StructType.fromDDL("o_orderkey bigint, price_txt decimal(18,2), od_iso timestamp_ntz, od_day date, is_open_bool boolean, is_open_bit int, od_nano timestamp_ntz, pos bigint")
    return _orders_text(spark, sf_dir).select(*co.project(cfg, sch.specs(target), window.ntz(RUN_TS)))


# --- control tables ------------------------------------------------------------------

CONFIG_ROWS = [
    ("silver", "events", "e_cdc.events", "user_id, k", "ts , \nload_ts", "", 1),
    ("silver", "orders", "o_cdc.orders", "o_orderkey", None, "a,b,,c", 1),
    ("silver", "old", "x_cdc.old", "id", "", None, 0),
    ("silver", "unset", "y_cdc.unset", "id", None, None, None),
]
CONFIG_SQL = """c(target_database, target_table, cdc_table, pk, epoc_cols, epoc_nano_cols, is_active) as (values
    ('silver', 'events', 'e_cdc.events', 'user_id, k', 'ts , ' || chr(10) || 'load_ts', '', 1), ('silver', 'orders', 'o_cdc.orders', 'o_orderkey', null, 'a,b,,c', 1),
    ('silver', 'old', 'x_cdc.old', 'id', '', null, 0), ('silver', 'unset', 'y_cdc.unset', 'id', null, null, null))"""


def config_rows(spark):
    return spark.createDataFrame(CONFIG_ROWS, "target_database string, target_table string, cdc_table string, pk string, epoc_cols string, epoc_nano_cols string, is_active int")


@query("config_lookup", f"with {CONFIG_SQL} select target_table, pk from c where target_database = 'silver' and target_table = 'events' and cdc_table = 'e_cdc.events'")
def config_lookup(spark, sf_dir):
    return conf.lookup_rows(config_rows(spark), "silver", "events", "e_cdc.events").select("target_table", "pk")


@query("config_active", f"with {CONFIG_SQL} select target_table from c where is_active = 1")
def config_active(spark, sf_dir):
    return conf.active(config_rows(spark)).select("target_table")


@query("config_lists", f"with {CONFIG_SQL}, l as (select target_table, unnest(['pk', 'epoc_cols', 'epoc_nano_cols']) as list, unnest([pk, epoc_cols, epoc_nano_cols]) as txt from c), s as (select target_table, list, generate_subscripts(x, 1) as nth, unnest(x) as item from (select target_table, list, list_filter(string_split(regexp_replace(txt, '\\s', '', 'g'), ','), lambda y: y <> '') as x from l)) select target_table, list, nth - 1 as nth, item, item in ('k', 'load_ts', 'b') as listed from s")
def config_lists(spark, sf_dir):
    c = config_rows(spark)
    lists = F.explode(F.array(*[F.struct(F.lit(n).alias("list"), conf.clean_list(F.col(n)).alias("items")) for n in ("pk", "epoc_cols", "epoc_nano_cols")]))
    flat = c.select("target_table", lists.alias("x")).select("target_table", "x.list", F.posexplode("x.items").alias("nth", "item"))
    return flat.withColumn("nth", F.col("nth").cast("bigint")).withColumn("listed", F.find_in_set(F.col("item"), F.lit("k,load_ts,b")) > 0)


@query("log_table_name", f"with {CONFIG_SQL} select cdc_table, 'last_run_' || replace(split_part(cdc_table, '.', 1), '_cdc', '') || '_' || split_part(cdc_table, '.', 2) as log_table from c")
def log_table_name(spark, sf_dir):
    return spark.createDataFrame([(r[2], conf.log_table_name(r[2])) for r in CONFIG_ROWS], "cdc_table string, log_table string")


@query("name_split", f"with {CONFIG_SQL} select cdc_table, split_part(cdc_table, '.', 1) as database, split_part(cdc_table, '.', 2) as table_name from c union all select 'bare', null, 'bare'")
def name_split(spark, sf_dir):
    names = [*(r[2] for r in CONFIG_ROWS), "bare"]
    return spark.createDataFrame([(n, *conf.split_name(n)) for n in names], "cdc_table string, database string, table_name string")


@query("text_lengths", "select n_nationkey, length(n_name) as n_chars, strlen('é' || n_name) as n_bytes, lpad(cast(n_nationkey as varchar), 4, '0') as padded from nation")
def text_lengths(spark, sf_dir):
    n = feeds.read(spark, sf_dir, "nation")
    return n.select("n_nationkey", F.char_length("n_name").cast("bigint").alias("n_chars"), F.octet_length(F.concat(F.lit("é"), "n_name")).cast("bigint").alias("n_bytes"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("padded"))


@query("config_table", f"with {CONFIG_SQL} select target_database, target_table, cdc_table, pk, coalesce(is_active, 1) as is_active from c")
def config_table(spark, sf_dir):
    """The configuration table as the library makes and fills it; a second row for a job is refused."""
    base = f"{_base(spark)}/control"
    conf.bootstrap(spark, base)
    names = ("target_database", "target_table", "cdc_table", "pk", "epoc_cols", "epoc_nano_cols", "is_active")
    rows = [{k: v for k, v in zip(names, r, strict=True) if v is not None} | {"source_fp": "raw"} for r in CONFIG_ROWS]
    conf.add(spark, base, rows[:2])
    conf.add(spark, base, rows[2:])
    try:
        conf.add(spark, base, rows[:1])
    except conf.ConfigError:
        return conf.read(spark, base).select("target_database", "target_table", "cdc_table", "pk", "is_active")
    raise AssertionError("a job was added twice")


@query("quoted_keys", "select * from (values (1, 'x'), (2, 'y'), (3, null)) as t(id, v)")
def quoted_keys(spark, sf_dir):
    """Keys with blanks, dots and quotes are read as they are; letter case counts."""
    rows = spark.createDataFrame([(1, '{"a b": "x"}', "a b"), (2, '{"a.b": "y"}', "a.b"), (3, '{"A b": "z"}', "a b")], "id int, data string, name string")
    v = rows.withColumn("_v", pl.parsed(F.col("data")))
    return v.select("id", F.when(F.col("name") == "a b", pl.scalar_text(F.col("_v"), "a b")).otherwise(pl.scalar_text(F.col("_v"), "a.b")).alias("v"))


@query("schema_catalog", "select * from (values ('user_id', 'bigint', 1, true), ('k', 'bigint', 2, true), ('event_type', 'string', 3, false), ('value', 'double', 4, false)) as t(column_name, data_type, ordinal_position, is_key)")
def schema_catalog(spark, sf_dir):
    rel = sch.as_relation(spark, TARGET, KEYS)
    return rel.where(~F.lower("column_name").isin(*sorted(sch.RESERVED)))


@query("ordered_listagg", "select r_name, string_agg(n_name, ', ' order by n_nationkey) as names from nation join region on n_regionkey = r_regionkey group by r_name")
def ordered_listagg(spark, sf_dir):
    n, r = feeds.read(spark, sf_dir, "nation"), feeds.read(spark, sf_dir, "region")
    items = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"])
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_join(items, ", ").alias("names"))


LOG_ROWS = [
    ("r1", "c", "silver", "2024-01-01", "t", "SUCCESS", 1, 0), ("r2", "c", "silver", "2024-01-05", "t", "SUCCESS", 3, 2), ("r3", "c", "silver", "2024-01-09", "t", "FAILED", 0, 0),
    ("r4", "c", "silver", None, "t", "SUCCESS", 0, 4), ("r5", "other", "silver", "2024-03-01", "u", "SUCCESS", 9, 9),
]
LOG_SQL = """l(id, cdc_table_name, target_database, cdc_end_ts, target_table, run_status, records_inserted, records_deleted) as (values
    ('r1', 'c', 'silver', timestamp '2024-01-01', 't', 'SUCCESS', 1::bigint, 0::bigint), ('r2', 'c', 'silver', timestamp '2024-01-05', 't', 'SUCCESS', 3, 2),
    ('r3', 'c', 'silver', timestamp '2024-01-09', 't', 'FAILED', 0, 0), ('r4', 'c', 'silver', null, 't', 'SUCCESS', 0, 4), ('r5', 'other', 'silver', timestamp '2024-03-01', 'u', 'SUCCESS', 9, 9))"""


def log_rows(spark):
    df = spark.createDataFrame(LOG_ROWS, "id string, cdc_table_name string, target_database string, end_text string, target_table string, run_status string, records_inserted bigint, records_deleted bigint")
    return df.withColumn("cdc_end_ts", F.to_timestamp_ntz("end_text")).drop("end_text")


@query("watermark_read", f"with {LOG_SQL} select coalesce(max(cdc_end_ts), timestamp '1970-01-01') as start_ts from l where cdc_table_name = 'c' and target_table = 't' and run_status = 'SUCCESS'")
def watermark_read(spark, sf_dir):
    return window.watermark(log_rows(spark), "c", "silver", "t")


@query("watermark_first_run", "select timestamp '1970-01-01' as start_ts")
def watermark_first_run(spark, sf_dir):
    return window.watermark(log_rows(spark), "new", "silver", "new")


@query("next_run_id", f"with {LOG_SQL} select coalesce(max(cast(substr(id, 2) as bigint)), 0) + 1 as next_id from l")
def next_run_id(spark, sf_dir):
    return window.next_run_id(log_rows(spark).withColumn("id", F.expr("cast(substr(id, 2) as bigint)")))


def _reports(spark, base: str, name: str, rows) -> None:
    for id_, cdc, database, end, table, status, inserted, deleted in rows:
        row = {"id": id_, "run_id": id_, "cdc_table_name": cdc, "target_database": database, "target_table": table, "run_status": status, "records_inserted": inserted, "records_deleted": deleted, "cdc_end_ts": end and datetime.fromisoformat(end)}
        runlog.append(spark, base, name, row)


@query("run_log_append", f"with {LOG_SQL} select id, cdc_table_name, cdc_end_ts, run_status, records_inserted from l union all select 'r6', 'c', timestamp '2024-02-01', 'SUCCESS', 5")
def run_log_append(spark, sf_dir):
    """The watermark log as the library makes it and adds to it."""
    base = f"{_base(spark)}/control"
    runlog.bootstrap(spark, base)
    _reports(spark, base, "watermark", [*LOG_ROWS, ("r6", "c", "silver", "2024-02-01", "t", "SUCCESS", 5, 0)])
    runlog.bootstrap(spark, base)  # what is there stays
    return runlog.read(spark, base, "watermark").select("id", "cdc_table_name", "cdc_end_ts", "run_status", "records_inserted")


@query("run_log_upsert", f"with {LOG_SQL} select id as run_id, target_table, case id when 'r3' then 'SUCCESS' else run_status end as run_status, case id when 'r3' then 7 else records_inserted end as records_inserted from l union all select 'r6', 'v', 'PENDING', 1")
def run_log_upsert(spark, sf_dir):
    """A run that is reported again has one row, with what the last report says."""
    base = f"{_base(spark)}/control"
    runlog.bootstrap(spark, base)
    _reports(spark, base, "runs", [*LOG_ROWS, ("r3", "c", "silver", None, "t", "SUCCESS", 7, 0), ("r6", "c", "silver", None, "v", runlog.status_name(9), 1, 0)])
    return runlog.read(spark, base, "runs").select("run_id", "target_table", "run_status", "records_inserted")


@query("keyed_upsert", f"with {LOG_SQL} select id, case id when 'r3' then 'SUCCESS' else run_status end as run_status, case id when 'r3' then 7 else records_inserted end as records_inserted, target_table from l union all select 'r6', 'PENDING', 1, 'v'")
def keyed_upsert(spark, sf_dir):
    runs = log_rows(spark).select("id", "run_status", "records_inserted", "target_table")
    new = spark.createDataFrame([("r3", "SUCCESS", 7, "ignored"), ("r6", runlog.status_name(9), 1, "v")], runs.schema)
    return apply.keyed_upsert(runs, new, ["id"], ["run_status", "records_inserted"])


@query("last_run_table", "select 'r9' as id, 'x_cdc.u' as cdc_table_name, 'FAILED' as run_status, cast(4 as bigint) as records_inserted")
def last_run_table(spark, sf_dir):
    """A job's own table holds its last run only."""
    base = f"{_base(spark)}/control"
    for id_, status, n in (("r7", "SUCCESS", 1), ("r8", "SUCCESS", 2), ("r9", "FAILED", 4)):
        runlog.write_last(spark, base, {"id": id_, "cdc_table_name": "x_cdc.u", "run_status": status, "records_inserted": n})
    return runlog.last_table(spark, base, "x_cdc.u").read().select("id", "cdc_table_name", "run_status", "records_inserted")


@query("state_upsert_on_true", "select 'r9' as id, 'SUCCESS' as run_status")
def state_upsert_on_true(spark, sf_dir):
    row = spark.createDataFrame([("r9", "SUCCESS")], "id string, run_status string")
    once = apply.state_upsert(spark.createDataFrame([], row.schema), row.withColumn("id", F.lit("r8")))
    return apply.state_upsert(once, row)


@query("last_run_view", f"with {LOG_SQL} select cdc_table_name, max(id) as id from l group by 1")
def last_run_view(spark, sf_dir):
    return runlog.last_state(log_rows(spark).withColumn("insert_timestamp", F.lit(RUN_TS))).select("cdc_table_name", "id")


@query("doy_partitions", "select cast(i as int) as day, 'p' || lpad(cast(i as varchar), 3, '0') as partition_name from range(1, 367) t(i) where i >= 350 or i <= 31")
def doy_partitions(spark, sf_dir):
    return window.day_of_year_partitions(spark, date(2023, 12, 16), date(2024, 1, 31))


@query("pruned_scan", f"with {E1} select op, count(*) as n from e1 where load_ts > timestamp '2024-01-11' and load_ts <= timestamp '2024-01-21' group by op")
def pruned_scan(spark, sf_dir):
    log = window.in_window(enveloped(spark, sf_dir), ENDS[0], ENDS[1])
    return log.groupBy(F.col("_op").alias("op")).agg(F.count(F.lit(1)).alias("n"))


# --- the whole engine ----------------------------------------------------------------


def _engine(spark, sf_dir, base, log=None):
    from .engine import CdcEngine

    row = {"target_database": "silver", "target_table": "events", "cdc_table": "events_cdc", "source_fp": "raw.events", "pk": "user_id, k", "is_active": 1}
    cfg = spark.createDataFrame([tuple(row.get(c.split()[0]) for c in conf.SCHEMA.split(", "))], conf.SCHEMA)
    eng = CdcEngine(spark, base, cfg, {"raw.events": lambda: log if log is not None else feeds.events(spark, sf_dir)}, clock=lambda: RUN_TS)
    eng.create_target("silver", "events", T.StructType([f for f in TARGET.fields if f.name != "pos"]))
    return eng


def _base(spark) -> str:
    """A folder that all executors share; it goes when the application ends."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/engine-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


ENGINE_SQL = windows_sql("upsert").replace("select * from t3", "select user_id, k, event_type, value from t3")


@query("engine_runs", ENGINE_SQL)
def engine_runs(spark, sf_dir):
    """Three runs through configuration, logs and snapshots, with the watermark at the last upsert."""
    from .engine import Options

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    eng = _engine(spark, sf_dir, _base(spark))
    for end in ENDS:
        eng.run("silver", "events", "events_cdc", Options(watermark_policy="max_upsert_load_ts"), end)
    return eng.store(conf.lookup(eng.config, "silver", "events", "events_cdc")).read()


@query("preview_stage", f"with {E1}, {I1}, {D1}, {A1} select 'I' as kind, user_id, k, event_type, value, ts_ns from i1 union all select 'D', user_id, k, null, null, ts_ns from a1")
def preview_stage(spark, sf_dir):
    """What the next run would apply; the target stays as it is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    eng = _engine(spark, sf_dir, _base(spark))
    got = eng.preview("silver", "events", "events_cdc", end=ENDS[0])
    if eng.store(conf.lookup(eng.config, "silver", "events", "events_cdc")).current().version:
        raise AssertionError("a preview changed the target")
    i = got.upserts.select(F.lit("I").alias("kind"), *KEYS, "event_type", "value", F.col("_ts_ns").alias("ts_ns"))
    return i.unionByName(got.deletes.select(F.lit("D").alias("kind"), *KEYS, F.col("_ts_ns").alias("ts_ns")), allowMissingColumns=True)


@query("failed_run", f"with {E1}, {I1}, {D1}, {A1}, {T1} select 'FAILED' as run_status, 'key' as names, (select count(*) from t1) as target_rows union all select 'SUCCESS', null, (select count(*) from t1)")
def failed_run(spark, sf_dir):
    """A run that meets a key that doesn't read is logged with its error, raises it, and leaves the target as the run before made it."""
    from .engine import MergeError

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base, log = _base(spark), feeds.events(spark, sf_dir)
    _engine(spark, sf_dir, base, log).run("silver", "events", "events_cdc", end=ENDS[0])
    late = F.col("load_ts") > window.ntz(ENDS[0])
    eng = _engine(spark, sf_dir, base, log.withColumn("data", F.when(late, F.regexp_replace("data", r'"user_id":\d+', '"user_id":"x"')).otherwise(F.col("data"))))
    try:
        eng.run("silver", "events", "events_cdc", end=ENDS[1])
    except MergeError:
        rows = eng.store(conf.lookup(eng.config, "silver", "events", "events_cdc")).read().agg(F.count(F.lit(1)).alias("target_rows"))
        runs = runlog.read(spark, eng.control, "runs").select("run_status", F.nullif(F.regexp_extract("error_msg", "'(key)'", 1), F.lit("")).alias("names"))
        return runs.crossJoin(F.broadcast(rows))
    raise AssertionError("the run should have failed")


@query("commit_conflict", "select n_nationkey, n_name, 1 as version from nation")
def commit_conflict(spark, sf_dir):
    """Of two commits on the same version the first stands, and the second is refused and leaves nothing behind."""
    from ..sources.store import CommitConflict, SnapshotStore

    rows = feeds.read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = SnapshotStore(spark, f"{_base(spark)}/nation")
    before = s.create(rows.schema, keys=["n_nationkey"], buckets=4)
    s.commit(before, rows)
    try:
        s.commit(before, rows.withColumn("n_name", F.lit("other")))
    except CommitConflict:
        now = s.current()
        return s.read(now).withColumn("version", F.lit(len([n for n in s.fs.names() if n.startswith("v")])).cast("int"))
    raise AssertionError("both commits went through")


@query("stream_available_now", windows_sql("upsert", 1).replace("2024-01-11", "2024-02-01").replace("select * from t1", "select user_id, k, event_type, value from t1"))
def stream_available_now(spark, sf_dir):
    """The log as files of a stream, by load date in order; each micro-batch is merged into the snapshot."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = _base(spark)
    log = feeds.events(spark, sf_dir)
    for n, (lo, hi) in enumerate(zip([window.EPOCH, *ENDS[:2]], ENDS, strict=True)):
        window.in_window(log, lo, hi).coalesce(1).write.mode("append").parquet(f"{base}/landing/part={n}")
    return _streamed(spark, sf_dir, base)


def _streamed(spark, sf_dir, base: str) -> DataFrame:
    from ..streaming.available_now import log_stream, run_available
    from .engine import Options

    box: dict = {}

    def batch(df, of):
        s = df.sparkSession
        eng = _engine(s, sf_dir, base, df.select("data", "load_ts", "load_date"))
        eng.run("silver", "events", "events_cdc", Options(watermark_policy="max_load_ts"), ENDS[-1], batch=of)
        box["store"] = eng.store(conf.lookup(eng.config, "silver", "events", "events_cdc"))

    run_available(log_stream(spark, f"{base}/landing/*"), batch, f"{base}/checkpoint")
    return box["store"].read()


LATE_SQL = f"""with {E1}, newest as (select * from e1 where op is not null and {W1.replace("2024-01-11", "2024-02-01")} qualify row_number() over (partition by user_id, k order by ts_ns desc, case when op = 'd' then 1 else 0 end, pos desc) = 1)
select user_id, k, event_type, value from newest where op <> 'd'"""


@query("stream_late_files", LATE_SQL)
def stream_late_files(spark, sf_dir):
    """The newest file comes first, then the oldest, then the one between: late changes neither get lost nor overwrite newer ones."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = _base(spark)
    log = feeds.events(spark, sf_dir)
    for n, k in enumerate((2, 0, 1)):
        lo, hi = [window.EPOCH, *ENDS[:2]][k], ENDS[k]
        window.in_window(log, lo, hi).coalesce(1).write.mode("append").parquet(f"{base}/landing/part={n}")
    return _streamed(spark, sf_dir, base)


@query(
    "rejected_changes",
    f"""with {E1}, w as (select *, case pos % 10 when 0 then 'json' when 1 then 'key' when 2 then 'version' when 3 then 'position' end as reason from e1 where load_ts > timestamp '1970-01-01' and load_ts <= timestamp '2024-02-01'),
    bad as (select reason, count(*) as n from w where reason is not null and (op is not null or reason = 'json') group by 1), f as (select * from w where reason is null and op is not null),
    newest as (select * from f qualify row_number() over (partition by user_id, k order by ts_ns desc, case when op = 'd' then 1 else 0 end, pos desc) = 1)
    select reason, n from bad union all select 'logged', sum(n)::bigint from bad union all select 'rows', count(*) from newest where op <> 'd'""",
)
def rejected_changes(spark, sf_dir):
    """Images, keys, versions and positions that don't read are set aside with their reason, and counted in the run's log."""
    from .engine import Options

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base, log = _base(spark), feeds.events(spark, sf_dir)
    pos = F.regexp_extract("data", r'"__source_pos":(\d+)', 1).cast("bigint")
    swap = lambda key, value: F.regexp_replace("data", rf'"{key}":[^,}}]*', f'"{key}":{value}')
    broken = F.when(pos % 10 == 0, F.concat(F.lit("{"), F.col("data"))).when(pos % 10 == 1, swap("user_id", '"x1"')).when(pos % 10 == 2, swap("__ts_ns", '"soon"')).when(pos % 10 == 3, swap("__source_pos", '"end"')).otherwise(F.col("data"))
    eng = _engine(spark, sf_dir, base, log.withColumn("data", broken))
    eng.run("silver", "events", "events_cdc", Options(on_error="quarantine"), ENDS[-1])
    by_reason = eng.quarantined("silver", "events").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    logged = runlog.read(spark, eng.control, "runs").agg(F.sum("records_rejected").alias("n")).select(F.lit("logged").alias("reason"), "n")
    rows = eng.store(conf.lookup(eng.config, "silver", "events", "events_cdc")).read().agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("reason"), "n")
    return by_reason.unionByName(logged).unionByName(rows)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
