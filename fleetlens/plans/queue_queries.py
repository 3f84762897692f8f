"""Queue, lineage and overlap queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators import queue as Q
from fleetlens.plans.registry import query
from fleetlens.plans.signal_queries import COOLDOWN_CTES, decisions
from fleetlens.sources import fixtures as fx

_FMT = "'%Y-%m-%d %H:%M:%S UTC'"
_POOL_SQL = ("CASE WHEN task_type IN ('chain', 'action') THEN 'executor' WHEN task_type = 'notify' THEN 'notify' "
             "WHEN task_type = 'mac_action' THEN 'mac_agent' END")


@query("next_task", f"""
SELECT pool, id, priority FROM (
  SELECT {_POOL_SQL} AS pool, id, priority,
         row_number() OVER (PARTITION BY {_POOL_SQL} ORDER BY priority DESC, id ASC) AS rn
  FROM tasks WHERE status = 'pending') q WHERE rn = 1 AND pool IS NOT NULL
""", ctes=("tasks",))
def q_next_task(spark, sf_dir):
    return Q.next_task(fx.tasks(spark, sf_dir))


@query("next_task_rank", f"""
SELECT pool, CAST(rn AS INTEGER) AS queue_position, id, task_type, priority FROM (
  SELECT {_POOL_SQL} AS pool, id, task_type, priority,
         row_number() OVER (PARTITION BY {_POOL_SQL} ORDER BY priority DESC, id ASC) AS rn
  FROM tasks WHERE status = 'pending') q WHERE rn <= 10 AND pool IS NOT NULL
""", ctes=("tasks",))
def q_next_task_rank(spark, sf_dir):
    return Q.next_tasks(fx.tasks(spark, sf_dir), 10)


@query("task_latest_state", f"""
SELECT id AS task_id, status, strftime(started_at, {_FMT}) AS started_at,
  strftime(finished_at, {_FMT}) AS finished_at,
  CAST(1 + (started_at IS NOT NULL)::INT + (finished_at IS NOT NULL)::INT AS BIGINT) AS n_events
FROM tasks
""", ctes=("tasks",))
def q_task_latest_state(spark, sf_dir):
    st = Q.task_latest_state(Q.task_events(fx.tasks(spark, sf_dir)))
    return st.select("task_id", "status", fmt_utc("started_at").alias("started_at"),
                     fmt_utc("finished_at").alias("finished_at"), "n_events")


@query("lineage", f"""
WITH RECURSIVE {COOLDOWN_CTES},
tr AS (
  SELECT id AS task_id, CAST(json_extract(result_json, '$.run_id') AS BIGINT) AS run_id
  FROM tasks WHERE result_json IS NOT NULL AND json_extract(result_json, '$.run_id') IS NOT NULL
  UNION
  SELECT id, CAST(unnest(CAST(json_extract(result_json, '$.run_ids') AS BIGINT[])) AS BIGINT)
  FROM tasks WHERE result_json IS NOT NULL AND json_extract(result_json, '$.run_ids') IS NOT NULL
)
SELECT cd.signal_id AS decision_id, cd.final_decision AS decision, t.id AS task_id, t.status AS task_status,
  tr.run_id, r.action AS run_action, r.status AS run_status
FROM cd LEFT JOIN tasks t ON t.decision_id = cd.signal_id
LEFT JOIN tr ON tr.task_id = t.id
LEFT JOIN runs r ON r.id = tr.run_id
""", ctes=("sig0", "signals", "tasks", "runs"))
def q_lineage(spark, sf_dir):
    return Q.lineage(decisions(spark, sf_dir), fx.tasks(spark, sf_dir), fx.runs(spark, sf_dir))


@query("overlapping_runs", f"""
SELECT id, action, strftime(started_at, {_FMT}) AS started_at,
  coalesce(max(coalesce(finished_at, TIMESTAMP '9999-12-31 00:00:00')) OVER (
    PARTITION BY action ORDER BY started_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > started_at,
    false) AS overlaps
FROM runs WHERE status <> 'blocked'
""", ctes=("runs",))
def q_overlapping_runs(spark, sf_dir):
    return Q.overlapping_runs(fx.runs(spark, sf_dir))


@query("run_latest_state", f"""
SELECT id AS run_id, status, strftime(started_at, {_FMT}) AS started_at, strftime(finished_at, {_FMT}) AS finished_at,
  exit_code, CAST(1 + (finished_at IS NOT NULL)::INT AS BIGINT) AS n_events
FROM runs
""", ctes=("runs",))
def q_run_latest_state(spark, sf_dir):
    """K12 + W7: runs recorded as events (inserted ``running``, then updated to the terminal status with
    exit code), folded back to one row per run."""
    r = fx.runs(spark, sf_dir)
    ins = r.select(F.col("id").alias("run_id"), F.col("started_at").alias("event_ts"), F.lit(0).alias("seq"),
                   F.lit("running").alias("status"), "started_at", F.lit(None).cast("timestamp").alias("finished_at"),
                   F.lit(None).cast("int").alias("exit_code"))
    upd = r.where(F.col("finished_at").isNotNull()).select(
        F.col("id").alias("run_id"), F.col("finished_at").alias("event_ts"), F.lit(1).alias("seq"), "status",
        F.lit(None).cast("timestamp").alias("started_at"), "finished_at", "exit_code")
    ev = ins.unionByName(upd)
    st = ev.groupBy("run_id").agg(
        F.max_by("status", F.struct("event_ts", "seq")).alias("status"), F.max("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"), F.max_by("exit_code", F.struct("event_ts", "seq")).alias("exit_code"),
        F.count(F.lit(1)).alias("n_events"))
    return st.select("run_id", "status", fmt_utc("started_at").alias("started_at"),
                     fmt_utc("finished_at").alias("finished_at"), "exit_code", "n_events")
