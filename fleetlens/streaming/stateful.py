"""Stateful streams on event time: cooldowns (T2), host staleness (T7), closed rate windows (T8), task lifecycles.

State lives in RocksDB (changelog checkpoints) and moves with the watermark only, so results don't depend on the wall clock or on
how rows are dealt to files and micro-batches, as long as rows come within the allowed delay:

* **Cooldown.** Of one alert key's candidates within one second only the first can execute (cooldowns are whole seconds and the
  clock restarts at a whole second). So candidates are first reduced to one row per (key, second, cooldown) by a windowed
  aggregate with map-side partials; it is also the buffer that the watermark releases in event-time order. The state
  processor behind it sees at most one row per second and cooldown of a key, however many rows a hot key has, and keeps one number a
  key. A timer removes it once no cooldown can reach back to it.
* **Host staleness.** One number a host and one timer at the moment its age passes the limit; the timer emits the host, a later
  snapshot emits its recovery.
* **Task lifecycle.** Events fold commutatively (latest by (time, seq), extremes and counts), changed tasks are emitted per
  micro-batch, and a finished task leaves the state when the watermark passes its last event; then its transitions are judged.
  Tasks are many and each has few events, so the fold runs in the JVM (``Lifecycle.java``); the others are processors in Python.
  A micro-batch looks through the open tasks once for those that leave.
* **Closed windows.** Append mode: a window is written once, when the watermark has passed its end.

``with_clock`` adds heartbeats (a folder of timestamps): they move the watermark on while a source is silent. ``close_stream``
writes the last one, which releases everything.

A row that comes after its second or window was closed is not decided again. Arrivals are kept (T1's sink), so
``late_candidates`` and ``late_signals`` count such rows by comparing what arrived with what was closed.
"""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from fleetlens.session import checkpoint_dir, ensure_session
from fleetlens.streaming.jvm import flat_map_groups_with_state

# Processors run in Python workers: pickled by value, a worker needs no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

US = 1_000_000
DELAY = "10 minutes"
FAR_FUTURE = "2999-12-31 00:00:00"
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def beat(spark: SparkSession, clock: str, ts: str | None = None) -> None:
    """Write a heartbeat (or, without a time, make the folder known) for streams with this clock."""
    rows = spark.createDataFrame([(ts,)] if ts else [], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    rows.coalesce(1).write.mode("append").parquet(clock)


def with_clock(df: DataFrame, clock: str, delay: str = DELAY) -> DataFrame:
    """``df`` (with an event time ``ts``) and heartbeats, under one watermark. Heartbeats are null in all other columns."""
    beats = df.sparkSession.readStream.schema("ts timestamp").parquet(clock)
    return df.withColumn("ts", F.col("ts").cast("timestamp")).unionByName(beats, allowMissingColumns=True).withWatermark("ts", delay)


def drive(df: DataFrame, root: str, mode: str = "append", batch=None):
    """Run a stream to the end of what is there. Started again with the same root, it goes on from its checkpoint."""
    spark = df.sparkSession
    held = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
        q = (w.foreachBatch(batch) if batch else w.format("parquet").option("path", f"{root}/data")).start()
        q.awaitTermination()
        return q
    finally:
        for k, v in held.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def close_stream(build, name: str, spark: SparkSession, mode: str = "append", batch=None) -> str:
    """Run ``build(clock)`` over its sources, then once more from its checkpoint with the closing heartbeat; the sink's root."""
    root = scratch(spark, name)
    clock = f"{root}/clock"
    beat(spark, clock)
    drive(build(clock), root, mode, batch and batch(root))
    beat(spark, clock, FAR_FUTURE)
    drive(build(clock), root, mode, batch and batch(root))
    return root


# ----------------------------------------------------------------------------- T2

_GROUPS = "alert_key string, second timestamp, cd_us long, sid long, n long, executed boolean"


class Cooldown(StatefulProcessor):
    """Greedy cooldown over the closed seconds of a key, in event-time order."""

    def __init__(self, longest_us: int) -> None:
        self.longest_us = longest_us

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_exec", "second_us long")

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None:  # heartbeats
            return
        last = before = self.last.get()[0] if self.last.exists() else None
        for r in sorted(rows, key=lambda r: (r.t, r.sid)):
            executed = last is None or r.t - last >= r.cd_us
            if executed:
                last = r.t - r.t % US
            yield Row(alert_key=key[0], second=r.second, cd_us=r.cd_us, sid=r.sid, n=r.n, executed=executed)
        if last != before:
            self.last.update((last,))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer((last + self.longest_us) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def candidates(decided: DataFrame) -> DataFrame:
    """Signals whose rule has a cooldown, as (ts, alert_key, sid, cd_us)."""
    able = (F.col("decision") != "ignore") & (F.col("cooldown_seconds") > 0)
    return decided.where(able).select(F.col("ts").cast("timestamp").alias("ts"), "alert_key", F.col("signal_id").cast("long").alias("sid"),
                                      (F.col("cooldown_seconds") * F.lit(US)).cast("long").alias("cd_us"))


def cooldown_groups(cands: DataFrame, longest_us: int) -> DataFrame:
    """(alert_key, second, cd_us, sid, n, executed) per closed second of a key; ``cands`` from :func:`with_clock`."""
    heads = cands.groupBy(F.window("ts", "1 second").alias("w"), "alert_key", "cd_us").agg(
        F.min(F.struct(F.unix_micros("ts").alias("t"), "sid")).alias("head"), F.count(F.lit(1)).alias("n"))
    rows = heads.select("alert_key", F.col("w.start").alias("second"), "w", "cd_us", "head.t", "head.sid", "n")
    return rows.groupBy("alert_key").transformWithState(Cooldown(longest_us), _GROUPS, "Append", "EventTime")


def decided_view(arrived: DataFrame, groups: DataFrame) -> DataFrame:
    """(signal_id, decision, late) of all arrived signals, from T1's sink and the closed groups.

    A candidate that isn't its second's executed head is ``cooldown``. ``late``: its whole second was closed before it came
    (with no row of its group in time), so it was never weighed; its decision is ``cooldown`` as well.
    """
    able = (F.col("decision") != "ignore") & (F.col("cooldown_seconds") > 0)
    second = F.date_trunc("second", F.col("ts").cast("timestamp"))
    run = groups.where("executed").select(F.col("sid").alias("_sid"), F.lit(True).alias("_ran"))
    known = groups.select(F.col("alert_key").alias("_key"), F.col("second").alias("_second"), (F.col("cd_us") / US).cast("int").alias("_cd"), F.lit(True).alias("_closed"))
    rows = arrived.join(run, F.col("signal_id") == F.col("_sid"), "left")
    rows = rows.join(known, (F.col("alert_key") == F.col("_key")) & (second == F.col("_second")) & (F.col("cooldown_seconds") == F.col("_cd")), "left")
    return rows.select("signal_id", F.when(able & F.col("_ran").isNull(), F.lit("cooldown")).otherwise(F.col("decision")).alias("decision"),
                       (able & F.col("_closed").isNull()).alias("late"))


def late_candidates(arrived: DataFrame, groups: DataFrame) -> DataFrame:
    """(alert_key, second, cd_us, late): candidates of closed seconds that came too late to be weighed."""
    end = groups.agg(F.max("second").alias("newest"))
    came = candidates(arrived).groupBy("alert_key", F.date_trunc("second", "ts").alias("second"), "cd_us").agg(F.count(F.lit(1)).alias("came"))
    out = came.join(groups.select("alert_key", "second", "cd_us", "n"), ["alert_key", "second", "cd_us"], "left").join(F.broadcast(end), F.col("second") <= F.col("newest"))
    return out.select("alert_key", "second", "cd_us", (F.col("came") - F.coalesce("n", F.lit(0))).alias("late")).where("late > 0")


# ----------------------------------------------------------------------------- T7

_STALE = "host string, event string, last_unix long, at_unix long"


class Staleness(StatefulProcessor):
    """Emits a host when its newest snapshot gets older than the limit, and again when it comes back."""

    def __init__(self, max_age: int) -> None:
        self.max_age = max_age

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last_unix long, stale boolean")

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None:
            return
        newest = max(r.timestamp_unix for r in rows)
        last, stale = self.seen.get() if self.seen.exists() else (None, False)
        if last is not None and newest <= last:
            return
        if stale:
            yield Row(host=key[0], event="recovered", last_unix=newest, at_unix=newest)
        self.seen.update((newest, False))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer((newest + self.max_age) * 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, _ = self.seen.get()
        self.seen.update((last, True))
        yield Row(host=key[0], event="stale", last_unix=last, at_unix=last + self.max_age)

    def close(self) -> None:
        pass


def staleness_events(snaps: DataFrame, max_age: int) -> DataFrame:
    """(host, event, last_unix, at_unix) in the order of event time; ``snaps`` (ts, host, timestamp_unix) from :func:`with_clock`.

    The state is one row a host (a stale host stays known until it comes back)."""
    newest = snaps.select("ts", "host", F.col("timestamp_unix").cast("long").alias("timestamp_unix"))
    return newest.groupBy("host").transformWithState(Staleness(max_age), _STALE, "Append", "EventTime")


def hosts_by_state(events: DataFrame) -> DataFrame:
    """(host, last_unix) of the hosts whose last event says stale."""
    newest = events.groupBy("host").agg(F.max(F.struct("last_unix", F.col("event") == "stale")).alias("x"))
    return newest.where("x.col2").select("host", "x.last_unix")


# ----------------------------------------------------------------------------- T8

def closed_rates(signals: DataFrame, window: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """(alertname, w, events) of windows that the watermark has passed; ``signals`` (ts, alertname) from :func:`with_clock`."""
    return signals.groupBy("alertname", F.window("ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("events"))


def late_signals(arrived: DataFrame, closed: DataFrame, window: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """(alertname, w, late): arrivals missing from closed windows, per window."""
    end = closed.agg(F.max("w.end").alias("newest"))
    came = arrived.select("alertname", F.col("ts").cast("timestamp").alias("ts")).groupBy("alertname", F.window("ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("came"))
    out = came.join(closed, ["alertname", "w"], "left").join(F.broadcast(end), F.col("w.end") <= F.col("newest"))
    return out.select("alertname", "w", (F.col("came") - F.coalesce("events", F.lit(0))).alias("late")).where("late > 0")


# ----------------------------------------------------------------------------- T9

_TASK_STATE = ("last_us long, last_seq int, status string, started_us long, finished_us long, n_events long, n_created long, n_started long, "
               "n_finished long, created_us long, first_started_us long, first_finished_us long")
_TASK_FOLD = f"task_id long, evicted boolean, {_TASK_STATE}"


def transition_faults(n_created, n_started, n_finished, created, started, finished) -> list[str]:
    """What breaks pending -> running -> terminal, from the counts and first times of a task's events."""
    faults = []
    if not n_created:
        faults.append("no creation")
    if n_created > 1:
        faults.append("created again")
    if n_started > 1:
        faults.append("started again")
    if n_finished > 1:
        faults.append("finished again")
    if n_finished and not n_started:
        faults.append("finished without a start")
    if created is not None and started is not None and started < created:
        faults.append("started before creation")
    if finished is not None and started is not None and finished < started:
        faults.append("finished before the start")
    return faults


def faults_column():
    """:func:`transition_faults` over the columns of a task's state."""
    none = lambda c: F.col(c) == 0
    faults = [(none("n_created"), "no creation"), (F.col("n_created") > 1, "created again"), (F.col("n_started") > 1, "started again"),
              (F.col("n_finished") > 1, "finished again"), (~none("n_finished") & none("n_started"), "finished without a start"),
              (F.col("first_started_us") < F.col("created_us"), "started before creation"),
              (F.col("first_finished_us") < F.col("first_started_us"), "finished before the start")]
    return F.array_compact(F.array(*(F.when(broken, F.lit(fault)) for broken, fault in faults)))


def lifecycle(events: DataFrame) -> DataFrame:
    """Changed tasks of each micro-batch (update mode); ``events`` (ts, task_id, seq, status, started_at, finished_at) from :func:`with_clock`.

    Lifecycle.java folds and evicts; a task that has left the state is judged in a projection behind it."""
    rows = events.select("task_id", F.unix_micros("ts").alias("at_us"), F.col("seq").cast("int").alias("seq"), "status",
                         F.unix_micros("started_at").alias("started_us"), F.unix_micros("finished_at").alias("finished_us"), "ts")
    folds = flat_map_groups_with_state(rows, "task_id", "Lifecycle", _TASK_STATE, _TASK_FOLD)
    faults = F.when(F.col("evicted"), faults_column()).otherwise(F.array().cast("array<string>"))
    return folds.select("task_id", "status", "started_us", "finished_us", "n_events", "evicted", faults.alias("faults"))
