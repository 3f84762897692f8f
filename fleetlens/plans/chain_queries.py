"""Chain replay queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import chains as CH
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx
from fleetlens.sources.config import normalized_rules

# Chain templates: two configured rule chains plus one with retries on executed steps (the configured
# chains only retry the queued notify step, where retries have no effect).
_RULES = {r["name"]: r for r in normalized_rules()}
TEMPLATES = {
    "backup_missing_chain": _RULES["backup_missing_chain"]["steps"],
    "vps_host_audit_daily": _RULES["vps_host_audit_daily"]["steps"],
    "retrying_backup": [
        {"name": "run_backup", "retries": 2},
        {"name": "verify_backup", "retries": 1},
        {"name": "analyze_vps_host_audit", "retries": 0},
        {"name": "generate_ai_ops_brief", "retries": 0, "analysis_level_in": ["warning", "critical"]},
        {"name": "notify_tg", "retries": 3, "analysis_level_in": ["warning", "critical"]},
    ],
}
_NAMES = list(TEMPLATES)
MAX_ATTEMPTS = max(int(s.get("retries", 0)) + 1 for steps in TEMPLATES.values() for s in steps)


def attempts_and_chains(spark, sf_dir):
    """Attempt log derived from events: chain = user, template by user, step by event id."""
    ev = fx.read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    tmpl = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("user_id") % len(_NAMES) + 1).cast("int"))
    nsteps = F.element_at(F.array(*[F.lit(len(TEMPLATES[n])) for n in _NAMES]),
                          (F.col("user_id") % len(_NAMES) + 1).cast("int"))
    status = (F.when(F.col("event_type") == "error", "failed").when(F.col("event_type").isin("click", "view"), "success")
              .when(F.col("event_type") == "signup", "skipped").otherwise("blocked"))
    level = (F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(F.col("value") >= 70, "critical")
             .when(F.col("value") >= 15, "warning").otherwise("ok"))
    a = ev.select(F.col("user_id").alias("chain_id"), tmpl.alias("template"),
                  (F.col("event_id") % nsteps + 1).cast("int").alias("step_index"),
                  F.col("event_id").alias("attempt_order"), status.alias("status"), F.col("event_id").alias("run_id"),
                  level.alias("analysis_level"))
    chains = a.select("chain_id", "template").distinct()
    return a.drop("template"), chains


def _sql_templates() -> tuple[str, str]:
    rows = []
    for n, steps in TEMPLATES.items():
        for i, s in enumerate(steps, start=1):
            lv = s.get("analysis_level_in")
            lv_sql = "CAST(NULL AS VARCHAR[])" if lv is None else "[" + ", ".join(f"'{x}'" for x in lv) + "]"
            rows.append(f"('{n}', {i}, '{s['name']}', {int(s.get('retries', 0))}, {lv_sql})")
    tnames = "[" + ", ".join(f"'{n}'" for n in _NAMES) + "]"
    tsteps = "[" + ", ".join(str(len(TEMPLATES[n])) for n in _NAMES) + "]"
    return ",\n  ".join(rows), f"{tnames}[user_id % {len(_NAMES)} + 1]|{tsteps}[user_id % {len(_NAMES)} + 1]"


_CFG_ROWS, _T = _sql_templates()
_TNAME, _TSTEPS = _T.split("|")

COLLAPSE_SQL = f"""
cfg(template, step_index, name, retries, levels) AS (VALUES
  {_CFG_ROWS}),
attempts AS (
  SELECT user_id AS chain_id, {_TNAME} AS template, CAST(event_id % {_TSTEPS} + 1 AS INTEGER) AS step_index,
    event_id AS attempt_order,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type IN ('click', 'view') THEN 'success'
         WHEN event_type = 'signup' THEN 'skipped' ELSE 'blocked' END AS status,
    event_id AS run_id,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN value >= 70 THEN 'critical' WHEN value >= 15 THEN 'warning'
         ELSE 'ok' END AS analysis_level
  FROM events
),
ranked AS (
  SELECT a.*, row_number() OVER (PARTITION BY chain_id, step_index ORDER BY attempt_order) AS rn FROM attempts a
),
lim AS (SELECT r.* FROM ranked r JOIN cfg c ON c.template = r.template AND c.step_index = r.step_index
        WHERE r.rn <= c.retries + 1),
fok AS (SELECT chain_id, step_index, min(rn) FILTER (WHERE status IN ('success', 'skipped')) AS first_ok
        FROM lim GROUP BY chain_id, step_index),
kept AS (SELECT l.* FROM lim l JOIN fok f ON f.chain_id = l.chain_id AND f.step_index = l.step_index
         WHERE l.rn <= coalesce(f.first_ok, 1000000)),
col AS (
  SELECT chain_id, step_index, CAST(count(*) AS INTEGER) AS attempts_used,
    list(status ORDER BY rn)[-1] AS final_status, list(run_id ORDER BY rn) AS run_ids,
    list(analysis_level ORDER BY rn)[-1] AS analysis_level
  FROM kept GROUP BY chain_id, step_index
)"""

OUTCOME_SQL = COLLAPSE_SQL + """,
chains AS (SELECT DISTINCT chain_id, template FROM attempts),
st AS (
  SELECT chain_id, template, 0 AS k, 'success' AS status, false AS stopped, CAST(NULL AS BIGINT) AS first_run_id,
    CAST(NULL AS BIGINT) AS last_run_id, CAST([] AS BIGINT[]) AS run_ids, 0 AS queued, 0 AS recorded,
    CAST(NULL AS VARCHAR) AS last_step_status, CAST(NULL AS VARCHAR) AS analysis_level,
    CAST([] AS VARCHAR[]) AS summary
  FROM chains
  UNION ALL
  SELECT chain_id, template, k, CASE WHEN stop THEN final ELSE status END, stop, coalesce(first_run_id, new_runs[1]),
    CASE WHEN len(all_runs) > 0 THEN all_runs[-1] END, all_runs, queued + CAST(is_queued AS INTEGER),
    recorded + 1, step_status, CASE WHEN ran AND lvl IS NOT NULL THEN lvl ELSE analysis_level END,
    list_append(summary, CAST(k AS VARCHAR) || ':' || step_status)
  FROM (
    SELECT y.*, list_concat(y.run_ids, y.new_runs) AS all_runs,
      CASE WHEN y.skip THEN 'skipped' WHEN y.is_queued THEN 'queued' ELSE y.final END AS step_status,
      y.ran AND y.final NOT IN ('success', 'skipped') AS stop
    FROM (
      SELECT x.*, NOT x.skip AND NOT x.is_queued AS ran,
        CASE WHEN NOT x.skip AND NOT x.is_queued THEN coalesce(x.res_runs, CAST([] AS BIGINT[]))
             ELSE CAST([] AS BIGINT[]) END AS new_runs
      FROM (
        SELECT st.chain_id, st.template, st.k + 1 AS k, st.status, st.first_run_id, st.run_ids, st.queued,
          st.recorded, st.analysis_level, st.summary,
          (cfg.levels IS NOT NULL AND NOT list_contains(list_transform(cfg.levels, lambda v: lower(trim(v))),
                                                        lower(trim(coalesce(st.analysis_level, ''))))) AS skip,
          (NOT (cfg.levels IS NOT NULL AND NOT list_contains(list_transform(cfg.levels, lambda v: lower(trim(v))),
                                                             lower(trim(coalesce(st.analysis_level, ''))))))
            AND cfg.name IN ('notify_tg') AS is_queued,
          coalesce(col.final_status, 'failed') AS final, col.run_ids AS res_runs, col.analysis_level AS lvl
        FROM st JOIN cfg ON cfg.template = st.template AND cfg.step_index = st.k + 1
        LEFT JOIN col ON col.chain_id = st.chain_id AND col.step_index = st.k + 1
        WHERE NOT st.stopped
      ) x
    ) y
  ) z
)"""


def _collapsed(spark, sf_dir):
    a, chains = attempts_and_chains(spark, sf_dir)
    t = CH.templates_table(spark, TEMPLATES)
    return CH.attempt_collapse(a, chains, t, MAX_ATTEMPTS), chains, t


@query("attempt_collapse", f"""WITH {COLLAPSE_SQL}
SELECT chain_id, step_index, attempts_used, final_status, array_to_string(run_ids, ',') AS run_ids, analysis_level
FROM col""", ctes=())
def q_attempt_collapse(spark, sf_dir):
    c, _, _ = _collapsed(spark, sf_dir)
    return c.select("chain_id", "step_index", "attempts_used", "final_status",
                    F.array_join("run_ids", ",").alias("run_ids"), "analysis_level")


@query("chain_outcome", f"""WITH RECURSIVE {OUTCOME_SQL}
SELECT chain_id, template, status, first_run_id, last_run_id, CAST(len(run_ids) AS INTEGER) AS run_count,
  queued, recorded AS steps_recorded, last_step_status, analysis_level, array_to_string(summary, ',') AS summary
FROM st QUALIFY row_number() OVER (PARTITION BY chain_id ORDER BY k DESC) = 1""", ctes=())
def q_chain_outcome(spark, sf_dir):
    c, chains, t = _collapsed(spark, sf_dir)
    return CH.chain_outcome(c, chains, t)


@query("run_states", """
SELECT id, action, CAST(id % 13 AS INTEGER) AS exit_code,
  CASE WHEN id % 13 = 0 THEN 'success' WHEN action = 'run_backup' AND id % 13 = 10 THEN 'blocked'
       WHEN action = 'run_backup' AND id % 13 = 11 THEN 'skipped' ELSE 'failed' END AS status
FROM runs""", ctes=("runs",))
def q_run_states(spark, sf_dir):
    """U4: action results normalised from exit codes (exit code derived per run as id % 13)."""
    r = fx.runs(spark, sf_dir).select("id", "action", (F.col("id") % 13).cast("int").alias("exit_code"))
    return r.withColumn("status", CH.normalize_result("action", "exit_code"))
