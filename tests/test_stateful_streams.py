"""Stateful streams: equal to the batch over shuffled files, micro-batches and restarts; state shrinks; late rows are counted."""

import datetime
import itertools
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetlens.operators import mac as MAC
from fleetlens.operators import queue as Q
from fleetlens.operators import rules as R
from fleetlens.session import checkpoint_dir
from fleetlens.sources import fixtures as fx
from fleetlens.sources import sinks
from fleetlens.sources.config import RULES
from fleetlens.streaming import stateful as ST
from fleetlens.streaming import twins as TW

LONGEST = max(r["cooldown_seconds"] for r in RULES) * ST.US


def scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/tests/{name}-{uuid.uuid4().hex}"


def deal(table, root, column):
    """One file per value of ``column``, written one after another."""
    for (v,) in sorted(tuple(r) for r in table.select(column).distinct().collect()):
        table.where(F.col(column) == v).drop(column).coalesce(1).write.mode("append").parquet(root)


def files(spark, root, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(root)


def batch_decisions(spark):
    got = R.greedy_cooldown(R.first_match(fx.signals(spark, SF_SMALL))).select("signal_id", "decision").collect()
    return {r.signal_id: r.decision for r in got}


@pytest.mark.parametrize("shuffled", [True, False])
def test_cooldown_equals_the_batch_over_micro_batches_and_a_restart(spark, shuffled):
    root = scratch(spark, "cooldown")
    ev = fx.read_table(spark, SF_SMALL, "events")
    # in shuffled order rows of any time come in any file; else files follow time, with disorder inside
    n = F.pmod(F.xxhash64("event_id"), F.lit(3)) if shuffled else F.ntile(3).over(__import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("ts"))
    deal(ev.withColumn("_file", n), f"{root}/in", "_file")
    delay = "400 days" if shuffled else ST.DELAY
    ST.beat(spark, f"{root}/clock")

    def build():
        decided = R.first_match(fx.signals_from(files(spark, f"{root}/in", ev.schema)))
        return ST.cooldown_groups(ST.with_clock(ST.candidates(decided), f"{root}/clock", delay), LONGEST)

    first = ST.drive(build(), root)
    assert sum(p["numInputRows"] for p in first.recentProgress) > 0 and len(first.recentProgress) >= 3
    ST.beat(spark, f"{root}/clock", ST.FAR_FUTURE)
    last = ST.drive(build(), root)  # a restart from the checkpoint
    arrived = R.first_match(fx.signals(spark, SF_SMALL))
    groups = spark.read.parquet(f"{root}/data")
    got = ST.decided_view(arrived, groups).collect()
    assert {r.signal_id: r.decision for r in got} == batch_decisions(spark) and not any(r.late for r in got)
    assert ST.late_candidates(arrived, groups).count() == 0
    state = {o["operatorName"]: o["numRowsTotal"] for o in last.recentProgress[-1]["stateOperators"]}
    # idle keys and closed seconds have left; the last heartbeat's own second stays open
    assert state["transformWithStateInPySparkExec"] == 0 and state["stateStoreSave"] <= 1, state


def test_late_candidates_and_signals_are_counted(spark):
    root = scratch(spark, "late")
    ev = fx.read_table(spark, SF_SMALL, "events")
    late = ev.where("pmod(xxhash64(event_id), 10) = 0")
    ev.where("pmod(xxhash64(event_id), 10) <> 0").coalesce(1).write.parquet(f"{root}/in")
    for name in ("c", "w"):
        ST.beat(spark, f"{root}/{name}/clock", ST.FAR_FUTURE)

    def build(name):
        decided = R.first_match(fx.signals_from(files(spark, f"{root}/in", ev.schema)))
        if name == "c":
            return ST.cooldown_groups(ST.with_clock(ST.candidates(decided), f"{root}/c/clock"), LONGEST)
        return ST.closed_rates(ST.with_clock(decided.select("alertname", "ts"), f"{root}/w/clock"))

    for step in range(2):
        for name in ("c", "w"):
            ST.drive(build(name), f"{root}/{name}")
        if not step:
            late.coalesce(1).write.mode("append").parquet(f"{root}/in")
    arrived = R.first_match(fx.signals(spark, SF_SMALL))
    groups, closed = (spark.read.parquet(f"{root}/{n}/data").where(f"{k} is not null") for n, k in (("c", "alert_key"), ("w", "alertname")))
    missed = arrived.where("pmod(xxhash64(signal_id), 10) = 0")
    assert ST.late_candidates(arrived, groups).agg(F.sum("late")).first()[0] == ST.candidates(missed).count()
    assert ST.late_signals(arrived, closed).agg(F.sum("late")).first()[0] == 5 * missed.count()  # five sliding windows each
    in_time = R.greedy_cooldown(arrived.where("pmod(xxhash64(signal_id), 10) <> 0")).select("signal_id", "decision").collect()
    got = {r.signal_id: r.decision for r in ST.decided_view(arrived, groups).collect()}
    assert all(got[r.signal_id] == r.decision for r in in_time)


def test_closed_windows_equal_the_batch(spark):
    root = scratch(spark, "rates")
    ev = fx.read_table(spark, SF_SMALL, "events")
    deal(ev.withColumn("_file", F.pmod(F.xxhash64("event_id"), F.lit(3))), f"{root}/in", "_file")
    ST.beat(spark, f"{root}/clock")
    build = lambda: ST.closed_rates(ST.with_clock(fx.signals_from(files(spark, f"{root}/in", ev.schema)).select("alertname", "ts"), f"{root}/clock", "400 days"))
    ST.drive(build(), root)
    ST.beat(spark, f"{root}/clock", ST.FAR_FUTURE)
    ST.drive(build(), root)
    got = {tuple(r) for r in spark.read.parquet(f"{root}/data").where("alertname is not null").collect()}
    batch = fx.signals(spark, SF_SMALL).groupBy("alertname", F.window("ts", "5 minutes", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("events"))
    assert got == {tuple(r) for r in batch.collect()}


def test_staleness_equals_the_batch_at_each_watermark(spark):
    root, max_age = scratch(spark, "stale"), 900
    snaps = fx.snapshots(spark, SF_SMALL).select("host", "timestamp_unix", F.timestamp_seconds("timestamp_unix").alias("ts"))
    lo, hi = snaps.agg(F.min("timestamp_unix"), F.max("timestamp_unix")).first()
    marks = [lo + (hi - lo) * k // 3 for k in (1, 2, 3)] + [hi + max_age, hi + max_age + 1]
    ST.beat(spark, f"{root}/clock")
    seen = lo - 1
    for mark in marks:
        new = snaps.where((F.col("timestamp_unix") > seen) & (F.col("timestamp_unix") <= mark))
        new.coalesce(1).write.mode("append").parquet(f"{root}/in")
        seen = mark
        ST.beat(spark, f"{root}/clock", str(spark.sql(f"select timestamp_seconds({mark})").first()[0]))
        ST.drive(ST.staleness_events(ST.with_clock(files(spark, f"{root}/in", snaps.schema), f"{root}/clock", "0 seconds"), max_age), root)
        want = MAC.stale_hosts(snaps.where(F.col("timestamp_unix") <= mark), mark, max_age).where("stale").collect()
        got = ST.hosts_by_state(spark.read.parquet(f"{root}/data")).collect()
        assert {(r.host, r.last_unix) for r in got} == {(r.host, r.last_unix) for r in want}, mark


def test_lifecycle_folds_shuffled_events_and_forgets_finished_tasks(spark):
    root = scratch(spark, "tasks")
    log = Q.task_events(fx.tasks(spark, SF_SMALL)).withColumnRenamed("event_ts", "ts")
    deal(log.withColumn("_file", F.pmod(F.xxhash64("task_id", "seq"), F.lit(3))), f"{root}/in", "_file")
    ST.beat(spark, f"{root}/clock")
    write = lambda b, i: sinks.append_batch(b, f"{root}/data", i) and None
    build = lambda: ST.lifecycle(ST.with_clock(files(spark, f"{root}/in", log.schema), f"{root}/clock", "400 days"))
    ST.drive(build(), root, "update", write)
    ST.beat(spark, f"{root}/clock", ST.FAR_FUTURE)
    q = ST.drive(build(), root, "update", write)
    rows = sinks.newest_by_key(sinks.read_batches(spark, f"{root}/data"), "task_id", "evicted").collect()
    want = Q.task_latest_state(log.withColumnRenamed("ts", "event_ts")).collect()
    assert {(r.task_id, r.status, r.n_events) for r in rows} == {(r.task_id, r.status, r.n_events) for r in want}
    assert all(r.evicted == (r.finished_us is not None) and not r.faults for r in rows)
    open_tasks = sum(r.finished_at is None for r in want)
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == open_tasks


@pytest.mark.parametrize("events, faults", [
    ((1, 1, 1, 5, 6, 9), []), ((1, 0, 1, 5, None, 9), ["finished without a start"]), ((0, 1, 1, None, 6, 9), ["no creation"]),
    ((2, 1, 2, 5, 6, 9), ["created again", "finished again"]), ((1, 2, 0, 5, 3, None), ["started again", "started before creation"]),
    ((1, 1, 1, 5, 9, 7), ["finished before the start"])])
def test_transition_faults(events, faults):
    assert ST.transition_faults(*events) == faults


def test_faults_column_judges_as_the_function(spark):
    times = (None, 5, 6, 9)
    cases = [c + t for c in itertools.product(range(3), repeat=3) for t in itertools.product(times, repeat=3)]
    names = ("n_created", "n_started", "n_finished", "created_us", "first_started_us", "first_finished_us")
    rows = spark.createDataFrame(cases, ", ".join(f"{n} long" for n in names)).select(*names, ST.faults_column().alias("faults")).collect()
    assert len(rows) == len(cases) and all(r.faults == ST.transition_faults(*r[:6]) for r in rows)


_LOG = "ts timestamp, task_id long, seq int, status string, started_at timestamp, finished_at timestamp"


def second(n):
    return n if n is None else datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(seconds=n)


def test_lifecycle_runs_without_python(spark):
    """With a Python processor every task costs several round trips, which is what 6 GB of events took too long for."""
    root = scratch(spark, "plan")
    ST.beat(spark, f"{root}/clock")
    spark.createDataFrame([], _LOG).write.parquet(f"{root}/in")
    stream = ST.lifecycle(ST.with_clock(files(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema), f"{root}/clock"))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsWithState" in plan and "Python" not in plan and "PySpark" not in plan


def test_lifecycle_query_keeps_its_state_in_the_jvm(spark, monkeypatch):
    ran, drive = [], ST.drive
    monkeypatch.setattr(ST, "drive", lambda *a: ran.append(drive(*a)) or ran[-1])
    got = TW.stream_task_lifecycle(spark, SF_SMALL).select("task_id", "status", "started_at", "finished_at", "n_events").collect()
    assert {o["operatorName"] for q in ran for p in q.recentProgress for o in p["stateOperators"]} == {"flatMapGroupsWithState"}
    assert sorted(got) == sorted(Q.task_latest_state(Q.task_events(fx.tasks(spark, SF_SMALL))).collect())


def test_lifecycle_of_repeated_late_and_timeless_events(spark):
    root = scratch(spark, "odd_tasks")
    ST.beat(spark, f"{root}/clock")
    end = lambda k, n, status="success": (second(n), k, 2, status, None, second(n))
    start = lambda k, n: (second(n), k, 1, "running", second(n), None)
    new = lambda k, n: (second(n), k, 0, "pending", None, None)
    files_of = [[new(1, 0), start(1, 10), end(1, 20), new(2, 0), new(2, 1), start(3, 5), (None, 3, 0, "pending", None, None), new(None, 3), end(4, 7)],
                [start(1, 40), start(2, 30), end(5, 16)],  # task 5: the watermark passed its end within the micro-batch before
                [start(6, 2), end(2, 45, "failed")]]  # task 6: late
    at, got = [None, None, 52, 60], []
    for step, mark in enumerate(at):
        if step < len(files_of):
            spark.createDataFrame(files_of[step], _LOG).coalesce(1).write.mode("append").parquet(f"{root}/in")
        if mark:
            ST.beat(spark, f"{root}/clock", str(spark.sql(f"select timestamp'2024-01-01 00:00:00' + interval {mark} seconds").first()[0]))
        build = ST.lifecycle(ST.with_clock(files(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema), f"{root}/clock", "10 seconds"))
        q = ST.drive(build, root, "update", lambda b, i: sinks.append_batch(b, f"{root}/data", i) and None)
        rows = sinks.newest_by_key(sinks.read_batches(spark, f"{root}/data"), "task_id", "evicted").collect()
        got.append({r.task_id: (r.status, r.n_events, r.evicted, r.faults) for r in rows})
        assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == sum(not r.evicted for r in rows)
    lost = ("success", 1, True, ["no creation", "finished without a start"])
    first = {1: ("success", 3, False, []), 2: ("pending", 2, False, []), 3: ("running", 2, False, []), 4: lost}
    assert got[0] == first
    # task 1's second start comes after its end, so its stay is longer
    assert got[1] == first | {1: ("running", 4, False, []), 2: ("running", 3, False, []), 5: lost}
    gone = {1: ("running", 4, True, ["started again"]), 2: ("failed", 4, False, [])}
    assert got[2] == got[1] | gone
    assert got[3] == got[2] | {2: ("failed", 4, True, ["created again"])}


# exactly once (K1, K3) -------------------------------------------------------------------------------------

def test_writer_killed_between_write_and_commit(spark):
    root = scratch(spark, "killed")
    ev = fx.read_table(spark, SF_SMALL, "events")
    deal(ev.withColumn("_file", F.col("event_id") % 3), f"{root}/in", "_file")
    tries = []

    def write(batch, batch_id):
        tries.append(batch_id)
        if batch_id == 1 and tries.count(1) == 1:  # files stand in the batch's folder, the marker doesn't
            batch.limit(7).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/data/batch=1")
            raise RuntimeError("killed")
        sinks.append_batch(batch, f"{root}/data", batch_id)

    def run():
        q = (files(spark, f"{root}/in", ev.schema).select("event_id").writeStream.foreachBatch(write)
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    assert sinks.committed(spark, f"{root}/data") == [0]
    run()
    run()  # nothing new
    assert tries == [0, 1, 1, 2] and sinks.committed(spark, f"{root}/data") == [0, 1, 2]
    ids = [r.event_id for r in sinks.read_batches(spark, f"{root}/data").collect()]
    assert sorted(ids) == sorted(r.event_id for r in ev.select("event_id").collect())


def test_replayed_upsert_adds_nothing(spark):
    root = scratch(spark, "upsert")
    mk = lambda rows: spark.createDataFrame(rows, "alert_key string, t string").select("alert_key", F.col("t").cast("timestamp").alias("exec_ts"))
    assert sinks.upsert_batch(mk([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:00")]), root, 0)
    mk([("x", "2024-01-01 00:00:00")]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v00000002")  # a dead writer's
    assert sinks.upsert_batch(mk([("a", "2024-01-03 00:00:00")]), root, 1)
    assert not sinks.upsert_batch(mk([("a", "2025-01-01 00:00:00")]), root, 1)  # a replay
    got = {r.alert_key: str(r.last_executed_at) for r in sinks.read_latest(spark, root).collect()}
    assert got == {"a": "2024-01-03 00:00:00", "b": "2024-01-01 00:00:00"}
