"""One incremental run of a job: window, stage, merge, commit, logs.

A run reads its window of the log once and shuffles it once, to one row a key; a single job
over that gives the counts, the new watermark, the changes that can't be applied and the
parts of the target that are touched.  Those parts meet the changes in one join, whose rows
are written and counted as they pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import target_row, unreadable
from ..functions.payload import UPSERT, envelope, rejected
from ..operators import apply, stage, window
from ..sources import config as conf
from ..sources import runlog
from ..sources.schema import specs
from ..sources.store import Lock, SnapshotStore

#: Columns of changes that are set aside.
ASIDE = "data string, load_ts timestamp_ntz, reason string"


class MergeError(RuntimeError):
    """The stage can't be applied."""


@dataclass(frozen=True)
class Options:
    """How a run treats its window.

    ``on_error``: what becomes of a change whose image, key, version or position doesn't
    read.  ``fail``: the run fails and changes nothing; ``null`` and ``quarantine``: it is
    set aside and counted.  A value of another column that doesn't read fails the run,
    becomes null, or sets its change aside.  Nothing is ever dropped uncounted.
    """

    profile: str = UPSERT
    watermark_policy: str = "max_load_ts"
    on_error: str = "fail"  # or null, quarantine
    guard_late: str | None = None  # the target's version column (nanoseconds)
    allow_null_pk: bool = False
    fused: bool = True  # False: a window function each for upserts and deletes, and a join
    lookback: timedelta = timedelta(0)


@dataclass(frozen=True)
class RunResult:
    status: str
    run_id: str | None = None
    start: datetime | None = None
    end: datetime | None = None
    watermark: datetime | None = None
    counts: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """A window's changes: one row a key, with ``i`` and ``d``; rows with ``_bad`` only count what is set aside."""

    changes: DataFrame
    keys: list[str]
    #: the log's rows that can't be applied, with their reason
    quarantined: DataFrame

    def _side(self, name: str) -> DataFrame:
        own = [f.name for f in self.changes.schema[name].dataType.fields]
        return self.changes.where(F.col(name).isNotNull()).select(*self.keys, *[F.col(f"{name}.{c}").alias(c) for c in own if c not in self.keys])

    @property
    def upserts(self) -> DataFrame:
        return self._side("i")

    @property
    def deletes(self) -> DataFrame:
        return self._side("d")


def stages(log: DataFrame, cfg: conf.JobConfig, target: T.StructType, run_ts: datetime, opt: Options = Options()) -> Staged:
    """The latest upserts and surviving deletes of a log that is cut to its window already."""
    keys = cfg.keys_in(target.fieldNames())
    typed = [(k, cfg.json_key_overrides.get(k, k), target[k].dataType.simpleString()) for k in keys]
    rows = envelope(log, typed, opt.profile, safe=opt.on_error != "fail")
    cols, now = specs(target, skip_reserved=False), window.ntz(run_ts)
    # a change without an operation isn't applied, whatever it holds; without an image there is none to see
    rows = rows.where(F.col("_op").isNotNull() | F.col("_v").isNull())
    bad = rejected(typed, opt.allow_null_pk)
    if opt.on_error == "quarantine":
        bad = F.coalesce(bad, F.when(unreadable(F.col("_v"), cols, cfg, now, opt.profile, tuple(keys)), "value"))
    rows = rows.withColumn("_bad", bad)
    more = [c for c in log.columns if c.lower() in {f.name.lower() for f in target.fields} - {k.lower() for k in keys} and c not in ("data", "load_ts")]
    carry = ["_v", *[F.col(f"`{c}`").alias(f"_log_{c}") for c in more]]
    if opt.fused:
        both = stage.changes(rows, keys, carry)
    else:
        good = rows.where(F.col("_bad").isNull())
        i = stage.latest_upserts(good, keys)
        d = stage.arbitrate(stage.latest_deletes(good, keys), i, keys)
        names = [*keys, *carry, "_op", "_ts_ns", "_pos", "load_ts"]
        counted = rows.where(F.col("_bad").isNotNull()).groupBy("_bad").agg(F.count(F.lit(1)).alias("_n_bad"))
        both = apply.paired(i.select(*names), d.select(*names), keys).unionByName(counted, allowMissingColumns=True)
    # the image is typed after the shuffle, for the rows that are left
    flat = both.select(*keys, "_bad", "_n_bad", "d", "i", F.col("i._v").alias("_v"), *[F.col(f"i.{c}").alias(c) for c in ("_op", "_ts_ns", "_pos", "load_ts")], *[F.col(f"i._log_{c}").alias(c) for c in more if c not in keys])
    on_error = "fail" if opt.on_error == "fail" else "null"
    image = target_row(cfg, cols, more, now, opt.profile, on_error)
    typed_row = F.struct(*[F.col(c.name) if c.name in keys else x.alias(c.name) for c, x in zip(cols, image, strict=True)], "_op", "_ts_ns", "_pos", "load_ts")
    d = F.when(F.col("d").isNotNull(), F.struct(*[F.col(f"d.{c}").alias(c) for c in ("_op", "_ts_ns", "_pos", "load_ts")]))
    changes = flat.select(*keys, F.when(F.col("i").isNotNull(), typed_row).alias("i"), d.alias("d"), "_bad", "_n_bad")
    return Staged(changes, keys, rows.where(F.col("_bad").isNotNull()).select("data", "load_ts", F.col("_bad").alias("reason")))


class CdcEngine:
    """Runs the jobs of a configuration table over a base folder.

    ``sources``: name of a raw log to a function that reads it (columns ``data``,
    ``load_ts`` and, for pruning, ``load_date``).  Targets and control tables live under
    ``base``, which all executors must share.
    """

    def __init__(self, spark: SparkSession, base: str, config: DataFrame, sources: dict[str, Callable[[], DataFrame]], clock: Callable[[], datetime] | None = None, lock: Lock | None = None):
        self.spark, self.base, self.config, self.sources, self.lock = spark, base.rstrip("/"), config, sources, lock
        self.clock = clock or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))
        self.control = f"{self.base}/control"
        runlog.bootstrap(spark, self.control)

    def store(self, cfg: conf.JobConfig) -> SnapshotStore:
        return SnapshotStore(self.spark, f"{self.base}/targets/{cfg.target_database}/{cfg.target_table}", self.lock)

    def create_target(self, database: str, table: str, schema: T.StructType, partition: str | None = None, buckets: int = 16) -> SnapshotStore:
        """An empty target, in buckets of its job's keys unless a partition column is named."""
        s = SnapshotStore(self.spark, f"{self.base}/targets/{database}/{table}", self.lock)
        row = self.config.where((F.col("target_database") == database) & (F.col("target_table") == table)).select("pk").first()
        have = {c.lower(): c for c in schema.fieldNames()}
        keys = [have.get(k.lower()) for k in conf.split_list(row["pk"])] if row else []
        s.create(schema, partition, keys if all(keys) else [], buckets)
        return s

    def _window(self, cfg: conf.JobConfig, opt: Options, end: datetime | None) -> tuple[datetime, datetime]:
        log = runlog.read(self.spark, self.control, "watermark")
        start = window.watermark(log, cfg.cdc_table, cfg.target_database, cfg.target_table).first()[0]
        held = self.store(cfg).current().watermark  # committed with the data: survives a lost log write
        if held:
            start = max(start, datetime.fromisoformat(held))
        return (start - opt.lookback if start > window.EPOCH else start), end or self.clock()

    def preview(self, database: str, table: str, cdc_table: str, opt: Options = Options(), end: datetime | None = None) -> Staged | None:
        """The stage of the next run; writes nothing."""
        cfg = conf.lookup(self.config, database, table, cdc_table)
        if cfg is None or not cfg.is_active:
            return None
        start, end = self._window(cfg, opt, end)
        s = self.store(cfg)
        return stages(window.in_window(self.sources[cfg.source_fp](), start, end), cfg, s.schema(s.current()), end, opt)

    def quarantined(self, database: str, table: str) -> DataFrame:
        """All changes of a target that were set aside, with their reason."""
        return SnapshotStore(self.spark, f"{self.base}/targets/{database}/{table}", self.lock).quarantined(ASIDE)

    def run(self, database: str, table: str, cdc_table: str, opt: Options = Options(), end: datetime | None = None, batch: tuple[str, int] | None = None) -> RunResult:
        """One run of a job.

        ``batch``: the stream and number of a micro-batch.  Its changes are taken as they
        come, whatever their load times, and guarded by version; a batch that was applied
        before does nothing.
        """
        cfg = conf.lookup(self.config, database, table, cdc_table)
        if cfg is None or not cfg.is_active:
            return RunResult("SKIPPED")
        run_id, began = str(uuid.uuid4()), self.clock()
        about = {"id": run_id, "run_id": run_id, "proc_name": "cdc_merge", "cdc_table_name": cdc_table, "target_database": database, "target_table": table, "start_time": began}
        self._report(about | {"run_status": runlog.status_name(-1)})
        try:
            start, end = self._window(cfg, opt, end)
            about["cdc_start_ts"] = start
            counts, mark = self._merge(cfg, opt, start, end, batch)
        except Exception as e:
            self._log(about | {"run_status": runlog.status_name(1), "error_msg": str(e)[:2000]})
            raise
        self._log(about | {"run_status": runlog.status_name(0), "cdc_end_ts": mark, **{c: counts[c] for c in ("records_inserted", "records_deleted", "records_rejected")}})
        return RunResult("SUCCESS", run_id, start, end, mark, counts)

    def _report(self, row: dict) -> None:
        runlog.append(self.spark, self.control, "runs", row | {"end_time": self.clock()})

    def _log(self, row: dict) -> None:
        now = self.clock()
        runlog.append(self.spark, self.control, "watermark", row | {"insert_timestamp": now})
        self._report(row)
        runlog.write_last(self.spark, self.control, row | {"insert_timestamp": now}, self.lock)

    def _merge(self, cfg: conf.JobConfig, opt: Options, start: datetime, end: datetime, batch: tuple[str, int] | None) -> tuple[dict[str, int], datetime | None]:
        s = self.store(cfg)
        before = s.current()
        nothing = {"records_inserted": 0, "records_deleted": 0, "records_rejected": 0}
        if batch is not None and batch[0] in before.batches and batch[1] <= int(before.batches[batch[0]]):  # replayed after its commit
            return nothing, before.watermark and datetime.fromisoformat(before.watermark)
        schema = s.schema(before)
        log = self.sources[cfg.source_fp]()
        staged = stages(window.in_window(log, start, end) if batch is None else log, cfg, schema, end, opt)
        changes = staged.changes.persist()
        try:
            sound = F.col("_bad").isNull()
            part = s.part(before) if before.buckets else F.lit(None)
            stats = stage.change_stats(changes, part).first()
            counts = {k: stats[k] for k in ("records_inserted", "records_deleted", "records_rejected")}
            if counts["records_rejected"] and opt.on_error == "fail":
                reasons = {r["_bad"]: r["_n_bad"] for r in changes.where(~sound).select("_bad", "_n_bad").collect()}
                raise MergeError(f"changes that can't be applied, by reason: {reasons}; the window is left as it is")
            mark = {"max_upsert_load_ts": stats["max_load_ts"], "max_load_ts": stats["max_any_load_ts"], "window_end": end}[opt.watermark_policy]
            aside = [s.set_aside(staged.quarantined)] if counts["records_rejected"] else []
            new, touched, seen = None, None, None
            if counts["records_inserted"] or counts["records_deleted"]:
                touched = sorted(stats["parts"]) if before.buckets else self._touched(s, before, changes, staged.keys)
                seen = Observation()
                new = self._merged(s, before, changes.where(sound), touched, staged.keys, opt, batch is not None, seen)
            elif not aside and batch is None:
                return counts | {"rows_updated": 0, "rows_inserted": 0, "rows_deleted": 0}, mark
            held = max([x for x in (mark, before.watermark and datetime.fromisoformat(before.watermark)) if x], default=None)
            batches = before.batches | ({batch[0]: str(batch[1])} if batch is not None else {})
            done = s.commit(before, new, touched, seen, watermark=held and held.isoformat(), batches=batches, counts=counts, quarantine=[*before.quarantine, *aside])
            return {"rows_updated": 0, "rows_inserted": 0, "rows_deleted": 0} | done.counts, mark
        finally:
            changes.unpersist()

    def _merged(self, s: SnapshotStore, before, changes: DataFrame, touched: list[str] | None, keys: list[str], opt: Options, guard: bool, seen: Observation) -> DataFrame:
        """The touched parts as they will be.  In buckets, both sides are exchanged into them, one task each, so the join and the write need no other."""
        old = s.read(before, touched, hidden=True)
        if before.buckets:
            old, changes = old.repartition(before.buckets, *keys), changes.repartition(before.buckets, *keys)
        rows = apply.merged(old, changes, keys, opt.profile, opt.guard_late, hidden=True, guard=guard)
        count = lambda state: F.count_if(F.col("_state") == state)
        rows = rows.observe(seen, count("updated").alias("rows_updated"), count("inserted").alias("rows_inserted"), count("deleted").alias("rows_deleted"))
        return rows.where((F.col("_state") != "deleted") | F.coalesce(F.col("_cdc.gone"), F.lit(False)) if guard else F.col("_state") != "deleted").drop("_state")

    def _touched(self, s: SnapshotStore, before, changes: DataFrame, keys: list[str]) -> list[str] | None:
        """Values of the partition column that hold a changed key, or get a row; None: all (no partitioning)."""
        if before.partition is None:
            return None
        value = s.part(before).alias("p")
        held = s.read(before, hidden=True).join(changes.where(F.col("_bad").isNull()).select(*keys), keys, "left_semi").select(value)
        got = changes.where(F.col("i").isNotNull()).select("i.*").select(value)
        return [r["p"] for r in held.union(got).distinct().collect()]  # one row a partition of the target

    def run_many(self, jobs: list[tuple[str, str, str]], opt: Options = Options(), threads: int = 4, end: datetime | None = None) -> list[RunResult | Exception]:
        """Independent jobs side by side; one that fails doesn't stop the others."""

        def one(job):
            try:
                return self.run(*job, opt, end)
            except Exception as e:  # reported with its job
                return e

        with ThreadPoolExecutor(threads) as pool:
            return list(pool.map(one, jobs))
