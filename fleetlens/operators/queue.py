"""Task queue, run listings, lineage and run overlap.

No operator here keeps a whole key in one task: the queue head per pool is a partial aggregation,
top-k lists use ``row_number() <= k`` (Spark plans a partial group limit before the shuffle), the
overlap test is a two-level prefix maximum (:mod:`fleetlens.operators.scan`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators.scan import prefix_max_before

# FIXED VALUES - worker pools and the task types each one polls.
POOLS = {"executor": ["chain", "action"], "notify": ["notify"], "mac_agent": ["mac_action"]}


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """L1: newest ``n`` runs by id, without stdout/stderr (top-k, TakeOrderedAndProject)."""
    return (runs.select("id", "action", "trigger_type", "status", fmt_utc("started_at").alias("started_at"),
                        fmt_utc("finished_at").alias("finished_at"), "exit_code", "error")
            .orderBy(F.col("id").desc()).limit(n))


def _run_ids(result_json: str = "result_json"):
    """Run ids recorded in a task's result: ``run_id`` and every element of ``run_ids``."""
    r = F.from_json(result_json, "struct<run_id:bigint, run_ids:array<bigint>>")
    none = F.array().cast("array<bigint>")
    return F.array_distinct(F.concat(F.when(r["run_id"].isNotNull(), F.array(r["run_id"])).otherwise(none), F.coalesce(r["run_ids"], none)))


def task_run_ids(tasks: DataFrame) -> DataFrame:
    """(task_id, decision_id, run_id) of the runs recorded in task results."""
    t = tasks.where(F.col("result_json").isNotNull())
    return t.select(F.col("id").alias("task_id"), "decision_id", F.explode(_run_ids()).alias("run_id"))


def lookup_by_ids(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """J11 batch form: rows whose ``key`` is in ``ids`` (left semi join; AQE broadcasts a small id side)."""
    return table.join(ids.select(key), on=key, how="left_semi")


def task_events(tasks: DataFrame) -> DataFrame:
    """Event-log view of tasks: created (pending), started (running), finished (terminal status)."""
    created = tasks.select(F.col("id").alias("task_id"), F.col("created_at").alias("event_ts"),
                           F.lit(0).alias("seq"), F.lit("pending").alias("status"),
                           F.lit(None).cast("timestamp").alias("started_at"),
                           F.lit(None).cast("timestamp").alias("finished_at"))
    started = tasks.where(F.col("started_at").isNotNull()).select(
        F.col("id").alias("task_id"), F.col("started_at").alias("event_ts"), F.lit(1).alias("seq"),
        F.lit("running").alias("status"), "started_at", F.lit(None).cast("timestamp").alias("finished_at"))
    finished = tasks.where(F.col("finished_at").isNotNull()).select(
        F.col("id").alias("task_id"), F.col("finished_at").alias("event_ts"), F.lit(2).alias("seq"),
        "status", F.lit(None).cast("timestamp").alias("started_at"), "finished_at")
    return created.unionByName(started).unionByName(finished)


def task_latest_state(events: DataFrame) -> DataFrame:
    """Fold create -> start -> finish updates into one row per task (partial aggregation)."""
    return events.groupBy("task_id").agg(
        F.max_by("status", F.struct("event_ts", "seq")).alias("status"),
        F.max("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.count(F.lit(1)).alias("n_events"),
    )


def _pool_col(pools: dict[str, list[str]]):
    expr = None
    for pool, types in pools.items():
        cond = F.col("task_type").isin(*types)
        expr = F.when(cond, F.lit(pool)) if expr is None else expr.when(cond, F.lit(pool))
    return expr


def next_task(tasks: DataFrame, pools: dict[str, list[str]] = POOLS) -> DataFrame:
    """W8 (=1): the task each pool's worker takes next - pending, priority desc, id asc."""
    p = tasks.where(F.col("status") == "pending").withColumn("pool", _pool_col(pools)).where(F.col("pool").isNotNull())
    best = p.groupBy("pool").agg(F.max(F.struct(F.col("priority"), (-F.col("id")).alias("neg_id"))).alias("b"))
    return best.select("pool", (-F.col("b.neg_id")).alias("id"), F.col("b.priority").alias("priority"))


def next_tasks(tasks: DataFrame, k: int, pools: dict[str, list[str]] = POOLS) -> DataFrame:
    """The first ``k`` tasks of each pool's queue with their queue position (top-k per group)."""
    p = tasks.where(F.col("status") == "pending").withColumn("pool", _pool_col(pools)).where(F.col("pool").isNotNull())
    w = Window.partitionBy("pool").orderBy(F.col("priority").desc(), F.col("id").asc())
    return (p.withColumn("queue_position", F.row_number().over(w)).where(F.col("queue_position") <= k)
            .select("pool", "queue_position", "id", "task_type", "priority"))


def lineage(decisions: DataFrame, tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """Decision -> task (decision_id) -> run (run ids inside result_json); left joins keep
    decisions without tasks and tasks without recorded runs."""
    d = decisions.select(F.col("signal_id").alias("decision_id"), "decision")
    t = tasks.select(F.col("id").alias("task_id"), "decision_id", F.col("status").alias("task_status"), F.explode_outer(_run_ids()).alias("run_id"))
    r = runs.select(F.col("id").alias("run_id"), F.col("action").alias("run_action"), F.col("status").alias("run_status"))
    # tasks without a recorded run stay out of the join on run_id: their nulls would meet in one partition
    dt = d.join(t, "decision_id", "left")
    ran = dt.where(F.col("run_id").isNotNull()).join(r, "run_id", "left")
    rest = dt.where(F.col("run_id").isNull())
    return (ran.unionByName(rest, allowMissingColumns=True)
            .select("decision_id", "decision", "task_id", "task_status", "run_id", "run_action", "run_status"))


def overlapping_runs(runs: DataFrame) -> DataFrame:
    """A run that starts while an earlier run of the same action is still open would have found
    the action lock held -> ``overlaps`` = true. Open runs (no finished_at) hold the lock forever.

    Earlier = smaller (started_at, id). Skew-safe two-level prefix max per action.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp")
    r = runs.where(F.col("status") != "blocked").select("id", "action", "started_at", F.coalesce("finished_at", far).alias("end_ts"))
    pm = prefix_max_before(r, ["action"], ["started_at", "id"], "end_ts", out="open_until")
    return pm.select("id", "action", fmt_utc("started_at").alias("started_at"),
                     F.coalesce(F.col("open_until") > F.col("started_at"), F.lit(False)).alias("overlaps"))
