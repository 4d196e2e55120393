from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import payload as pl
from tidemark.operators import apply, stage, window
from tidemark.plans.engine import CdcEngine, MergeError, Options
from tidemark.sources import config as conf
from tidemark.sources import runlog
from tidemark.sources.store import CommitConflict, SnapshotStore

TARGET = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.IntegerType()), T.StructField("part", T.StringType())])


def change(op, ts, id_=1, v=0, pos=0, load=None, part="a"):
    body = [f'"id": {id_}' if id_ is not None else '"x": 0', f'"v": {v}' if not isinstance(v, str) else f'"v": "{v}"', f'"part": "{part}"', f'"__source_pos": {pos}']
    if op:
        body.append(f'"__op": "{op}"')
    if ts is not None:
        body.append(f'"__ts_ns": {ts}')
    return "{" + ", ".join(body) + "}", datetime(2024, 1, 1, 0, 0, load if load is not None else (ts or 0))


def log(spark, *changes):
    return spark.createDataFrame(list(changes), "data string, load_ts timestamp_ntz").withColumn("load_date", F.to_date("load_ts"))


def enveloped(spark, *changes):
    return pl.envelope(log(spark, *changes), [("id", "id", "bigint")])


def staged(spark, *changes):
    rows = enveloped(spark, *changes)
    i = stage.latest_upserts(rows, ["id"])
    d = stage.arbitrate(stage.latest_deletes(rows, ["id"]), i, ["id"])
    fused = stage.fused(rows, ["id"], [])
    both = {(k, r["id"], r["_pos"]) for k, df in (("I", i), ("D", d)) for r in df.collect()}
    assert both == {(r["kind"], r["id"], r["_pos"]) for r in fused.collect()}
    return sorted(x[::2] for x in both)


@pytest.mark.parametrize(
    ("changes", "want"),
    [
        ([change("u", 1, pos=1), change("d", 2, pos=2)], [("D", 2), ("I", 1)]),
        ([change("u", 2, pos=1), change("d", 1, pos=2)], [("I", 1)]),
        ([change("u", 2, pos=1), change("d", 2, pos=2)], [("I", 1)]),  # a tie: the upsert stays
        ([change("d", 1, pos=2)], [("D", 2)]),
        ([change(None, 1, pos=1)], []),
        ([change("u", None, pos=1, load=1), change("d", 1, pos=2)], [("I", 1)]),  # unknown time
        ([change("u", 1, pos=9), change("u", 1, pos=10)], [("I", 10)]),  # numbers, not text
        ([change("u", 1, pos=1, load=1), change("u", 1, pos=1, load=2)], [("I", 1)]),
    ],
)
def test_arbitration(spark, changes, want):
    assert staged(spark, *changes) == want


def engine(spark, base, rows, pk="id", active=1, partition=None):
    row = {"target_database": "d", "target_table": "t", "cdc_table": "c", "source_fp": "raw", "pk": pk, "is_active": active}
    cfg = spark.createDataFrame([tuple(row.get(c.split()[0]) for c in conf.SCHEMA.split(", "))], conf.SCHEMA)
    box = {"rows": rows}
    eng = CdcEngine(spark, f"file://{base}", cfg, {"raw": lambda: box["rows"]}, clock=lambda: datetime(2024, 3, 1))
    eng.create_target("d", "t", TARGET, partition)
    return eng, box


def target(eng):
    return sorted(tuple(r) for r in eng.store(conf.lookup(eng.config, "d", "t", "c")).read().collect())


JOB = ("d", "t", "c")
END = datetime(2024, 2, 1)


@pytest.mark.parametrize("fused", [False, True])
def test_run_is_incremental_and_repeatable(spark, tmp_path, fused):
    opt = Options(fused=fused)
    eng, box = engine(spark, tmp_path, log(spark, change("c", 1, 1, 10), change("c", 2, 2, 20), change("u", 3, 1, 11), change("d", 4, 2)))
    first = eng.run(*JOB, opt, END)
    assert first.counts["records_rejected"] == 0 and target(eng) == [(1, 11, "a")] and first.counts["records_inserted"] == 2 and first.counts["rows_deleted"] == 1
    assert first.watermark == datetime(2024, 1, 1, 0, 0, 4)
    again = eng.run(*JOB, opt, END)  # an empty window
    assert again.counts["records_inserted"] == 0 and target(eng) == [(1, 11, "a")]
    box["rows"] = box["rows"].unionByName(log(spark, change("u", 5, 3, 30)))
    eng.run(*JOB, opt, END)
    assert target(eng) == [(1, 11, "a"), (3, 30, "a")]
    assert runlog.read(spark, f"file://{tmp_path}/control", "watermark").where("run_status = 'SUCCESS'").count() == 3


def test_partitions_that_are_not_touched_carry_over(spark, tmp_path):
    eng, box = engine(spark, tmp_path, log(spark, change("c", 1, 1, 10, part="a"), change("c", 2, 2, 20, part="b/é")), partition="part")
    eng.run(*JOB, Options(), END)
    s = eng.store(conf.lookup(eng.config, *JOB))
    before = s.current().parts
    box["rows"] = log(spark, change("u", 9, 1, 99, part="a"))
    eng.run(*JOB, Options(), END)
    after = s.current().parts
    assert before["b/é"] == after["b/é"] and before["a"] != after["a"]
    box["rows"] = log(spark, change("u", 10, 1, 5, part="b/é"))  # moves
    eng.run(*JOB, Options(), END)
    assert target(eng) == [(1, 5, "b/é"), (2, 20, "b/é")]
    s.vacuum(1, grace=0)
    assert target(eng) == [(1, 5, "b/é"), (2, 20, "b/é")]


def test_partitions_with_columns_that_have_no_hash(spark, tmp_path):
    schema = T.StructType.fromDDL("p string, v variant, m map<string,int>")
    s = SnapshotStore(spark, f"file://{tmp_path}/s")
    s.create(schema, partition="p")
    rows = spark.sql("select * from values ('a', parse_json('{\"x\": 1}'), map('k', 1)), ('b', null, null), (null, null, null) as t(p, v, m)")
    s.commit(s.current(), rows)
    assert sorted(str(r["p"]) for r in s.read().collect()) == ["None", "a", "b"] and s.read(only=["a"]).first()["m"] == {"k": 1}


def test_gated_profile_ignores_recreation(spark, tmp_path):
    opt = Options(profile=pl.OP_GATED)
    eng, box = engine(spark, tmp_path, log(spark, change("c", 1, 1, 10)))
    eng.run(*JOB, opt, END)
    box["rows"] = log(spark, change("d", 2, 1), change("c", 3, 1, 30))
    eng.run(*JOB, opt, END)
    assert target(eng) == [(1, 10, "a")]
    box["rows"] = log(spark, change("u", 4, 1, 40))
    eng.run(*JOB, opt, END)
    assert target(eng) == [(1, 40, "a")]


def test_watermark_policies_and_late_rows(spark, tmp_path):
    late = [change("u", 5, 1, 55, load=1), change("u", 3, 1, 33, load=2)]
    for policy, want in (("max_upsert_load_ts", 33), ("max_load_ts", 55)):
        eng, box = engine(spark, tmp_path / policy, log(spark, *late).where("load_ts <= timestamp_ntz'2024-01-01 00:00:02'"))
        eng.run(*JOB, Options(watermark_policy=policy), END)
        if policy == "max_load_ts":
            # all events were read, but the winner's load time is the watermark here
            assert eng.run(*JOB, Options(watermark_policy=policy), END).counts["records_inserted"] in (0, 1)
        else:
            eng.run(*JOB, Options(watermark_policy=policy), END)
            assert target(eng) == [(1, want, "a")]
    eng, _ = engine(spark, tmp_path / "end", log(spark, *late))
    eng.run(*JOB, Options(watermark_policy="window_end"), END)
    eng.run(*JOB, Options(watermark_policy="window_end"), END)
    assert target(eng) == [(1, 55, "a")]


def test_deletes_only_keep_the_watermark(spark, tmp_path):
    eng, box = engine(spark, tmp_path, log(spark, change("c", 1, 1, 10)))
    eng.run(*JOB, Options(watermark_policy="max_upsert_load_ts"), END)
    box["rows"] = log(spark, change("d", 2, 1))
    got = eng.run(*JOB, Options(watermark_policy="max_upsert_load_ts"), END)
    assert got.watermark is None and target(eng) == []
    assert eng.run(*JOB, Options(watermark_policy="max_upsert_load_ts"), END).start == datetime(2024, 1, 1, 0, 0, 1)


def test_failures_are_logged_and_change_nothing(spark, tmp_path):
    eng, box = engine(spark, tmp_path, log(spark, change("c", 1, 1, 10)))
    eng.run(*JOB, Options(), END)
    box["rows"] = log(spark, change("u", 2, 1, "x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        eng.run(*JOB, Options(), END)
    logged = runlog.read(spark, f"file://{tmp_path}/control", "runs").where("run_status = 'FAILED'").collect()
    assert len(logged) == 1 and "CAST_INVALID_INPUT" in logged[0]["error_msg"] and target(eng) == [(1, 10, "a")]
    assert eng.run(*JOB, Options(on_error="null"), END).status == "SUCCESS" and target(eng) == [(1, None, "a")]


def test_quarantine_and_null_keys(spark, tmp_path):
    eng, _ = engine(spark, tmp_path, log(spark, change("u", 1, 1, "x"), change("u", 2, 2, 5), change("u", 3, None, 6)))
    eng.run(*JOB, Options(on_error="quarantine"), END)
    assert target(eng) == [(2, 5, "a")]
    assert sorted(r["reason"] for r in eng.quarantined("d", "t").collect()) == ["key", "value"]


def test_gates(spark, tmp_path):
    eng, _ = engine(spark, tmp_path, log(spark, change("u", 1)), active=0)
    assert eng.run(*JOB).status == "SKIPPED" and eng.run("d", "t", "nothing").status == "SKIPPED" and eng.preview(*JOB) is None
    eng2, _ = engine(spark, tmp_path / "2", log(spark, change("u", 1)), pk="nope")
    with pytest.raises(conf.ConfigError):
        eng2.run(*JOB, Options(), END)
    eng2.config = eng2.config.union(eng2.config)
    with pytest.raises(conf.ConfigError, match="more than one"):
        eng2.run(*JOB, Options(), END)


def test_preview_writes_nothing(spark, tmp_path):
    eng, _ = engine(spark, tmp_path, log(spark, change("u", 1, 1, 5)))
    got = eng.preview(*JOB, Options(), END)
    assert got.upserts.count() == 1 and target(eng) == []


RAW = [('{"id": 1, "v": 10, "part": "a", "__op": "u", "__ts_ns": 1, "__source_pos": 1}', 1), ('{"id": "abc", "v": 2, "__op": "u", "__ts_ns": 2, "__source_pos": 2}', 2), ('{"id": null, "v": 3, "__op": "u", "__ts_ns": 3, "__source_pos": 3}', 3), ('{"id": 4, "v": 4, "__op": "d", "__ts_ns": "x", "__source_pos": 4}', 4)]


def raw_log(spark):
    rows = [(data, datetime(2024, 1, 1, 0, 0, s)) for data, s in RAW]
    return spark.createDataFrame(rows, "data string, load_ts timestamp_ntz").withColumn("load_date", F.to_date("load_ts"))


@pytest.mark.parametrize("fused", [True, False])
def test_unreadable_changes_fail_the_run(spark, tmp_path, fused):
    eng, box = engine(spark, tmp_path, raw_log(spark))
    with pytest.raises(MergeError, match="'key': 2"):
        eng.run(*JOB, Options(fused=fused), END)
    assert target(eng) == [] and eng.quarantined("d", "t").count() == 0
    runs = runlog.read(spark, eng.control, "runs").collect()
    assert [r["run_status"] for r in runs] == ["FAILED"] and "version" in runs[0]["error_msg"]
    box["rows"] = raw_log(spark).where("load_ts < timestamp_ntz'2024-01-01 00:00:02'")
    assert eng.run(*JOB, Options(fused=fused), END).start == window.EPOCH and target(eng) == [(1, 10, "a")]


@pytest.mark.parametrize("on_error", ["null", "quarantine"])
def test_unreadable_changes_are_set_aside_and_counted(spark, tmp_path, on_error):
    eng, _ = engine(spark, tmp_path, raw_log(spark).unionByName(log(spark, change("u", 5, 6, "x"))).unionByName(spark.createDataFrame([("{no", datetime(2024, 1, 1, 0, 0, 9))], "data string, load_ts timestamp_ntz").withColumn("load_date", F.to_date("load_ts"))))
    got = eng.run(*JOB, Options(on_error=on_error), END)
    want = ["json", "key", "key", "version"] + (["value"] if on_error == "quarantine" else [])
    assert sorted(r["reason"] for r in eng.quarantined("d", "t").collect()) == sorted(want) and got.counts["records_rejected"] == len(want)
    assert target(eng) == [(1, 10, "a")] + ([(6, None, "a")] if on_error == "null" else [])
    run = runlog.read(spark, eng.control, "runs").first()
    assert (run["run_status"], run["records_rejected"]) == ("SUCCESS", len(want))


def test_a_repeated_run_sets_aside_once(spark, tmp_path):
    eng, _ = engine(spark, tmp_path, raw_log(spark))
    real, SnapshotStore.commit = SnapshotStore.commit, lambda *a, **k: 1 / 0
    try:
        with pytest.raises(ZeroDivisionError):
            eng.run(*JOB, Options(on_error="quarantine"), END)
    finally:
        SnapshotStore.commit = real
    assert eng.quarantined("d", "t").count() == 0
    eng.run(*JOB, Options(on_error="quarantine"), END)
    assert eng.quarantined("d", "t").count() == 3


def test_null_keys_by_choice(spark, tmp_path):
    rows = raw_log(spark).where("data not like '%abc%' and data not like '%\"x\"%'")
    eng, _ = engine(spark, tmp_path, rows)
    eng.run(*JOB, Options(allow_null_pk=True), END)
    rows = eng.store(conf.lookup(eng.config, *JOB)).read().collect()
    assert sorted(str(tuple(r)) for r in rows) == ["(1, 10, 'a')", "(None, 3, None)"]


def test_changes_in_any_order(spark, tmp_path):
    """Micro-batches with old changes after new ones: the newest of each key wins, deletes included."""
    parts = [[change("u", 1, 1, 10), change("u", 2, 2, 20)], [change("d", 3, 1), change("u", 4, 3, 30)], [change("u", 5, 2, 21), change("d", 6, 3), change("u", 6, 4, 40)]]
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 2, 0)]):
        eng, box = engine(spark, tmp_path / str(n), log(spark, *parts[0]))
        for k, i in enumerate(order):
            box["rows"] = log(spark, *parts[i])
            eng.run(*JOB, Options(), END, batch=("s", k))
        assert target(eng) == [(2, 21, "a"), (4, 40, "a")]


def test_plan_reads_and_exchanges_the_target_once(spark, tmp_path):
    eng, box = engine(spark, tmp_path, log(spark, *[change("c", i, i, i, load=i % 50) for i in range(1, 200)]))
    eng.run(*JOB, Options(), END)
    s = eng.store(conf.lookup(eng.config, *JOB))
    before = s.current()
    assert before.buckets == 16 and all(len(list((tmp_path / "targets/d/t" / p).glob("*.parquet"))) == 1 for p in before.parts.values())
    box["rows"] = log(spark, change("u", 300, 5, 77, load=55), change("d", 301, 6, load=56))
    plans = []
    real, SnapshotStore._write = SnapshotStore._write, lambda self, m, rows, folder: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or real(self, m, rows, folder)
    try:
        got = eng.run(*JOB, Options(), END)
    finally:
        SnapshotStore._write = real
    plan = plans[0].split("InMemoryRelation")[0]  # the stage, computed once before, comes last
    assert len(plans) == 1 and plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning(id") == plan.count("Exchange ") == 2
    assert {k: got.counts[k] for k in ("rows_updated", "rows_inserted", "rows_deleted")} == {"rows_updated": 1, "rows_inserted": 0, "rows_deleted": 1}
    after = s.current()
    assert 1 <= sum(after.parts.get(k) != v for k, v in before.parts.items()) <= 2  # the buckets of two keys
    assert len(target(eng)) == 198


def test_two_threads_commit_the_same_version(spark, tmp_path):
    """A hundred races: one writer wins each, the other is told."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    s = SnapshotStore(spark, f"file://{tmp_path}/s")
    s.create(TARGET)
    gate = Barrier(2)

    def one(who):
        before = s.current()
        gate.wait()
        try:
            return s.commit(before, None, counts={"who": who}).counts["who"]
        except CommitConflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        for n in range(100):
            won = [x for x in pool.map(one, (1, 2)) if x]
            assert len(won) == 1 and s.current().version == n + 1 and s.current().counts["who"] == won[0]
    assert not [x for x in s.fs.names() if x.startswith("_tmp-")]


def test_vacuum_leaves_what_is_being_written(spark, tmp_path):
    s = SnapshotStore(spark, f"file://{tmp_path}/s")
    s.create(TARGET, keys=["id"])
    for k in range(3):
        s.commit(s.current(), spark.createDataFrame([(k, 2, "a")], TARGET))
    spark.createDataFrame([(9, 9, "z")], TARGET).write.parquet(f"file://{tmp_path}/s/v000000000009-abc/_p=x")
    s.vacuum(1)
    assert "v000000000009-abc" in s.fs.names() and len([n for n in s.fs.names() if n.startswith("v")]) == 4
    s.vacuum(1, grace=0)
    assert len([n for n in s.fs.names() if n.startswith("v")]) == 1 and s.read().count() == 1


def test_other_stores_need_a_lock(spark, tmp_path):
    from contextlib import contextmanager

    held = []

    @contextmanager
    def lock(path):
        held.append(path)
        yield

    s = SnapshotStore(spark, f"file://{tmp_path}/s", lock)
    s.create(TARGET)

    class Elsewhere:
        """The local disk under another name."""

        def __init__(self, fs):
            self.fs = fs

        def getUri(self):
            return type("U", (), {"getScheme": lambda _: "s3a"})()

        def __getattr__(self, name):
            return getattr(self.fs, name)

    s.fs.fs = Elsewhere(s.fs.fs)
    s.commit(s.current(), None)
    assert len(held) == 1 and s.current().version == 1
    s.lock = None
    with pytest.raises(ValueError, match="needs a lock"):
        s.commit(s.current(), None)


def test_two_writers_conflict(spark, tmp_path):
    s = SnapshotStore(spark, f"file://{tmp_path}/s")
    before = s.create(TARGET)
    rows = spark.createDataFrame([(1, 2, "a")], TARGET)
    s.commit(before, rows)
    with pytest.raises(CommitConflict):
        s.commit(before, rows)
    assert s.read().count() == 1


def test_replayed_batch_changes_nothing(spark, tmp_path):
    eng, box = engine(spark, tmp_path, log(spark, change("c", 1, 1, 10)))
    eng.run(*JOB, Options(), END, batch=("s", 7))
    box["rows"] = log(spark, change("c", 2, 2, 20))
    assert eng.run(*JOB, Options(), END, batch=("s", 7)).counts["records_inserted"] == 0 and target(eng) == [(1, 10, "a")]
    eng.run(*JOB, Options(), END)  # a plain run in between doesn't forget it
    assert target(eng) == [(1, 10, "a"), (2, 20, "a")]
    box["rows"] = log(spark, change("u", 3, 2, 21))
    assert eng.run(*JOB, Options(), END, batch=("s", 7)).counts["records_inserted"] == 0 and target(eng) == [(1, 10, "a"), (2, 20, "a")]
    eng.run(*JOB, Options(), END, batch=("other", 0))  # another stream
    assert target(eng) == [(1, 10, "a"), (2, 21, "a")]


def test_many_jobs(spark, tmp_path):
    eng, _ = engine(spark, tmp_path, log(spark, change("c", 1, 1, 10)))
    got = eng.run_many([JOB, ("d", "t", "none")], Options(), end=END)
    assert [g.status for g in got] == ["SUCCESS", "SKIPPED"]


def test_guard_late(spark):
    schema = T.StructType.fromDDL("id bigint, v int, ver bigint")
    old = spark.createDataFrame([(1, 10, 5), (2, 20, 5)], schema)
    new = spark.createDataFrame([(1, 11, 4, "u", 4), (2, 21, 6, "u", 6), (3, 30, 1, "u", 1)], "id bigint, v int, ver bigint, _op string, _ts_ns bigint")
    got = sorted(tuple(r) for r in apply.upsert(old, new, ["id"], version="ver").collect())
    assert got == [(1, 10, 5), (2, 21, 6), (3, 30, 1)]
    gone = spark.createDataFrame([(1, 4), (2, 9)], "id bigint, _ts_ns bigint")
    assert [r["id"] for r in apply.delete_matched(old, gone, ["id"], version="ver").collect()] == [1]


def test_repeated_keys_are_refused(spark):
    assert issubclass(MergeError, RuntimeError)
    df = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    assert [r["id"] for r in apply.repeated_keys(df, ["id"]).collect()] == [1]


def test_window_helpers(spark):
    from datetime import date

    names = [r["partition_name"] for r in window.day_of_year_partitions(spark, date(2023, 12, 31), date(2024, 1, 2)).orderBy("day").collect()]
    assert names == ["p001", "p002", "p365", "p366"]
    assert window.day_of_year_partitions(spark, date(1970, 1, 1), date(2024, 1, 2)).count() == 366
    edge = log(spark, change("u", 1), change("u", 2), change("u", 3))
    got = window.in_window(edge, datetime(2024, 1, 1, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 3))
    assert got.count() == 2


def test_many_windows_equal_one(spark, sf_dir):
    """With changes in order, windows one after another give what one large window does."""
    from tidemark.plans import catalogue as c

    one = c.staged(spark, sf_dir, window.EPOCH, c.ENDS[2])
    whole = apply.merge(c.empty_target(spark), one.upserts, one.deletes, c.KEYS)
    steps, start = c.empty_target(spark), window.EPOCH
    for end in c.ENDS:
        got = c.staged(spark, sf_dir, start, end)
        steps, start = apply.merge(steps, got.upserts, got.deletes, c.KEYS), end
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, steps.collect()))
