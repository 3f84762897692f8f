"""Metric families, exposition text, listings and point lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators import metrics as M
from fleetlens.operators import queue as Q
from fleetlens.plans.registry import query
from fleetlens.plans.signal_queries import COOLDOWN_CTES, decisions
from fleetlens.sources import fixtures as fx

_FMT = "'%Y-%m-%d %H:%M:%S UTC'"


@query("tasks_by_type_status", "SELECT task_type, status, count(*) AS count FROM tasks GROUP BY task_type, status",
       ctes=("tasks",))
def q_tasks_by_type_status(spark, sf_dir):
    return M.tasks_by_type_status(fx.tasks(spark, sf_dir))


@query("runs_by_action_status", "SELECT action, status, count(*) AS count FROM runs GROUP BY action, status",
       ctes=("runs",))
def q_runs_by_action_status(spark, sf_dir):
    return M.runs_by_action_status(fx.runs(spark, sf_dir))


@query("remediation_by_action", """
SELECT coalesce(json_extract_string(payload, '$.action'), '') AS action, status, count(*) AS count
FROM tasks WHERE task_type = 'mac_action' GROUP BY 1, 2
""", ctes=("tasks",))
def q_remediation_by_action(spark, sf_dir):
    return M.remediation_by_action_status(fx.tasks(spark, sf_dir))


@query("queue_depth", """
SELECT k.task_type, CAST(coalesce(c.depth, 0) AS BIGINT) AS depth
FROM (VALUES ('action'), ('chain'), ('notify'), ('mac_action')) k(task_type)
LEFT JOIN (SELECT task_type, count(*) AS depth FROM tasks WHERE status IN ('pending', 'running')
           GROUP BY task_type) c ON c.task_type = k.task_type
""", ctes=("tasks",))
def q_queue_depth(spark, sf_dir):
    return M.queue_depth(fx.tasks(spark, sf_dir))


@query("last_activity", """
SELECT
  (SELECT CAST(coalesce(floor(epoch(max(ts))), 0) AS BIGINT) FROM signals) AS last_decision_unixtime,
  (SELECT CAST(coalesce(floor(epoch(max(coalesce(finished_at, started_at, created_at)))), 0) AS BIGINT) FROM tasks)
    AS last_task_unixtime,
  (SELECT CAST(coalesce(floor(epoch(max(coalesce(finished_at, started_at)))), 0) AS BIGINT) FROM runs)
    AS last_run_unixtime
""", ctes=("sig0", "signals", "tasks", "runs"))
def q_last_activity(spark, sf_dir):
    return M.last_activity(fx.signals(spark, sf_dir), fx.tasks(spark, sf_dir), fx.runs(spark, sf_dir))


_PROM_SQL = f"""
WITH RECURSIVE {COOLDOWN_CTES},
fam(family_order, family, help, type) AS (VALUES
  (0, 'action_runner_decisions_total', 'Total decisions by decision type.', 'counter'),
  (1, 'action_runner_tasks_total', 'Total tasks by type and status.', 'counter'),
  (2, 'action_runner_runs_total', 'Total action runs by action and status.', 'counter'),
  (3, 'action_runner_mac_remediation_total', 'Total remote mac remediation results.', 'counter'),
  (4, 'action_runner_queue_depth', 'Current pending and running tasks by type.', 'gauge'),
  (5, 'action_runner_last_decision_unixtime', 'Latest decision timestamp in unix seconds.', 'gauge'),
  (6, 'action_runner_last_task_unixtime', 'Latest task timestamp in unix seconds.', 'gauge'),
  (7, 'action_runner_last_run_unixtime', 'Latest run timestamp in unix seconds.', 'gauge')),
samples AS (
  SELECT 0 AS fo, final_decision AS ok, '{{decision="' || final_decision || '"}}' AS lbl, count(*) AS v
    FROM cd GROUP BY final_decision
  UNION ALL
  SELECT 1, task_type || chr(1) || status, '{{status="' || status || '",task_type="' || task_type || '"}}', count(*)
    FROM tasks GROUP BY task_type, status
  UNION ALL
  SELECT 2, action || chr(1) || status, '{{action="' || action || '",status="' || status || '"}}', count(*)
    FROM runs GROUP BY action, status
  UNION ALL
  SELECT 3, a || chr(1) || status, '{{action="' || a || '",status="' || status || '"}}', count(*)
    FROM (SELECT coalesce(json_extract_string(payload, '$.action'), '') AS a, status FROM tasks
          WHERE task_type = 'mac_action') m GROUP BY a, status
  UNION ALL
  SELECT 4, printf('%05d', k.o), '{{task_type="' || k.t || '"}}', coalesce(c.n, 0)
    FROM (VALUES (1, 'action'), (2, 'chain'), (3, 'notify'), (4, 'mac_action')) k(o, t)
    LEFT JOIN (SELECT task_type, count(*) AS n FROM tasks WHERE status IN ('pending', 'running')
               GROUP BY task_type) c ON c.task_type = k.t
  UNION ALL
  SELECT 5, '', '', CAST(coalesce(floor(epoch(max(ts))), 0) AS BIGINT) FROM cd
  UNION ALL
  SELECT 6, '', '', CAST(coalesce(floor(epoch(max(coalesce(finished_at, started_at, created_at)))), 0) AS BIGINT)
    FROM tasks
  UNION ALL
  SELECT 7, '', '', CAST(coalesce(floor(epoch(max(coalesce(finished_at, started_at)))), 0) AS BIGINT) FROM runs
)
SELECT family_order, -1 AS line_order, '# HELP ' || family || ' ' || help AS line FROM fam
UNION ALL
SELECT family_order, 0, '# TYPE ' || family || ' ' || type FROM fam
UNION ALL
SELECT s.fo, CAST(row_number() OVER (PARTITION BY s.fo ORDER BY s.ok) + 1 AS INTEGER),
       f.family || s.lbl || ' ' || CAST(s.v AS VARCHAR)
FROM samples s JOIN fam f ON f.family_order = s.fo
"""


@query("prom_exposition", _PROM_SQL, ctes=("sig0", "signals", "tasks", "runs"))
def q_prom_exposition(spark, sf_dir):
    t, r = fx.tasks(spark, sf_dir), fx.runs(spark, sf_dir)
    return M.exposition_lines(M.metric_table(decisions(spark, sf_dir), t, r))


@query("latest_runs", f"""
SELECT id, action, trigger_type, status, strftime(started_at, {_FMT}) AS started_at,
  strftime(finished_at, {_FMT}) AS finished_at, exit_code, error
FROM runs ORDER BY id DESC LIMIT 20
""", ctes=("runs",))
def q_latest_runs(spark, sf_dir):
    return Q.latest_runs(fx.runs(spark, sf_dir), 20)


@query("latest_decisions", f"""
WITH RECURSIVE {COOLDOWN_CTES}
SELECT signal_id AS id, alertname, severity, final_decision AS decision, strftime(ts, {_FMT}) AS created_at
FROM cd ORDER BY signal_id DESC LIMIT 50
""", ctes=("sig0", "signals"))
def q_latest_decisions(spark, sf_dir):
    d = decisions(spark, sf_dir)
    return (d.select(F.col("signal_id").alias("id"), "alertname", "severity", "decision",
                     fmt_utc("ts").alias("created_at")).orderBy(F.col("id").desc()).limit(50))


@query("latest_tasks", f"""
SELECT id, decision_id, task_type, priority, status, strftime(created_at, {_FMT}) AS created_at
FROM tasks ORDER BY id DESC LIMIT 50
""", ctes=("tasks",))
def q_latest_tasks(spark, sf_dir):
    t = fx.tasks(spark, sf_dir)
    return (t.select("id", "decision_id", "task_type", "priority", "status", fmt_utc("created_at").alias("created_at"))
            .orderBy(F.col("id").desc()).limit(50))


@query("run_by_id", f"""
SELECT r.id, r.action, r.status, strftime(r.started_at, {_FMT}) AS started_at
FROM runs r WHERE r.id IN (
  SELECT CAST(json_extract(result_json, '$.run_id') AS BIGINT) FROM tasks WHERE result_json IS NOT NULL
  UNION
  SELECT CAST(unnest(CAST(json_extract(result_json, '$.run_ids') AS BIGINT[])) AS BIGINT) FROM tasks
  WHERE result_json IS NOT NULL)
""", ctes=("tasks", "runs"))
def q_run_by_id(spark, sf_dir):
    """J11 batch form: the runs referenced by task results (semi join with an id table)."""
    ids = Q.task_run_ids(fx.tasks(spark, sf_dir)).select("run_id").distinct()
    r = fx.runs(spark, sf_dir)
    return Q.lookup_by_ids(r, ids.withColumnRenamed("run_id", "id")).select(
        "id", "action", "status", fmt_utc("started_at").alias("started_at"))
