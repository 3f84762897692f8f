"""Queries over signals: first match, cooldown, fingerprint, context, task payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.maps import context_pick
from fleetlens.functions.numeric import severity_priority
from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators import rules as R
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx
from fleetlens.sources.config import normalized_rules


def _sql_first_match(src: str = "signals", rules: list | None = None) -> str:
    """DuckDB text of the first-match classification (the oracle's own CASE chain)."""
    rules = [r for r in normalized_rules(rules) if r["enabled"]]
    idx = "CASE " + " ".join(
        "WHEN " + " AND ".join(f"coalesce(trim(CAST({k} AS VARCHAR)), '') = '{v}'" for k, v in r["match"].items())
        + f" THEN {i}" for i, r in enumerate(rules)) + " END"

    def arr(field):
        return "[" + ", ".join(f"'{r[field]}'" if isinstance(r[field], str) else str(r[field]) for r in rules) + "]"

    return f"""
    SELECT *,
      CASE WHEN ridx IS NULL THEN 'ignore' WHEN action_type = 'chain' THEN 'execute_chain'
           WHEN action_type = 'execute' THEN 'execute' ELSE 'ignore' END AS decision,
      CASE WHEN ridx IS NULL THEN 'no matching action rule'
           WHEN action_type = 'ignore' THEN 'matched ignore rule: ' || rule_name
           WHEN action_type = 'execute' THEN 'matched execute rule: ' || rule_name
           ELSE 'matched chain rule: ' || rule_name END AS reason,
      CASE WHEN ridx IS NULL THEN fpkey ELSE rule_name || ':' || fpkey END AS alert_key
    FROM (
      SELECT *, {arr('name')}[ridx + 1] AS rule_name, coalesce({arr('action_type')}[ridx + 1], 'none') AS action_type,
             CAST(coalesce({arr('cooldown_seconds')}[ridx + 1], 0) AS BIGINT) AS cooldown_seconds,
             CASE WHEN trim(coalesce(fingerprint, '')) <> '' THEN trim(fingerprint)
                  ELSE coalesce(nullif(trim(coalesce(alertname, '')), ''), 'unknown-alert') END AS fpkey
      FROM (SELECT *, {idx} AS ridx FROM {src}) m0
    ) m1
    """


FIRST_MATCH_CTE = f"d AS ({_sql_first_match()})"

# Greedy cooldown by recursion: each key's first candidate executes; the next execution is the first
# candidate (by time, then id) at or after trunc_to_second(previous execution) + cooldown.
COOLDOWN_CTES = FIRST_MATCH_CTE + """,
cand AS (
  SELECT alert_key, signal_id AS sid, epoch_us(ts) AS t, cooldown_seconds * 1000000 AS cd
  FROM d WHERE decision <> 'ignore' AND cooldown_seconds > 0
),
ex AS (
  SELECT alert_key, sid, t, cd FROM (
    SELECT *, row_number() OVER (PARTITION BY alert_key ORDER BY t, sid) AS rn FROM cand) f WHERE rn = 1
  UNION ALL
  SELECT alert_key, sid, t, cd FROM (
    SELECT c.alert_key, c.sid, c.t, c.cd,
           row_number() OVER (PARTITION BY c.alert_key ORDER BY c.t, c.sid) AS rn
    FROM ex JOIN cand c ON c.alert_key = ex.alert_key AND c.t >= ex.t - (ex.t % 1000000) + ex.cd) n
  WHERE rn = 1
),
cd AS (
  SELECT d.*,
    CASE WHEN d.decision <> 'ignore' AND d.cooldown_seconds > 0 AND ex.sid IS NULL THEN 'cooldown'
         ELSE d.decision END AS final_decision,
    CASE WHEN d.decision <> 'ignore' AND d.cooldown_seconds > 0 AND ex.sid IS NULL
         THEN 'matched rule ''' || d.rule_name || ''' but action recently executed' ELSE d.reason END AS final_reason
  FROM d LEFT JOIN ex ON d.signal_id = ex.sid
)
"""


def decided(spark, sf_dir):
    return R.first_match(fx.signals(spark, sf_dir))


def decisions(spark, sf_dir):
    """Recorded decisions: first match, then greedy cooldown (assume every execution succeeds)."""
    return R.greedy_cooldown(decided(spark, sf_dir))


@query("decisions_first_match", f"WITH {FIRST_MATCH_CTE} SELECT signal_id, decision, rule_name, reason, alert_key, "
       "cooldown_seconds FROM d", ctes=("sig0", "signals"))
def q_decisions_first_match(spark, sf_dir):
    return decided(spark, sf_dir).select("signal_id", "decision", "rule_name", "reason", "alert_key",
                                         "cooldown_seconds")


@query("cooldown_decisions", f"WITH RECURSIVE {COOLDOWN_CTES} SELECT signal_id, alert_key, "
       "final_decision AS decision, final_reason AS reason FROM cd", ctes=("sig0", "signals"))
def q_cooldown_decisions(spark, sf_dir):
    return decisions(spark, sf_dir).select("signal_id", "alert_key", "decision", "reason")


@query("decisions_by_type", f"WITH RECURSIVE {COOLDOWN_CTES} SELECT final_decision AS decision, "
       "count(*) AS count FROM cd GROUP BY final_decision", ctes=("sig0", "signals"))
def q_decisions_by_type(spark, sf_dir):
    return R.decisions_by_type(decisions(spark, sf_dir))


@query("cooldown_asof", f"""
WITH {FIRST_MATCH_CTE},
execs AS (
  SELECT d.alert_key, date_trunc('second', t.finished_at) AS exec_ts
  FROM d JOIN tasks t ON t.decision_id = d.signal_id
  WHERE d.decision IN ('execute', 'execute_chain') AND t.status = 'success' AND t.finished_at IS NOT NULL
),
probe AS (SELECT * FROM d WHERE decision <> 'ignore' AND cooldown_seconds > 0),
lastx AS (
  SELECT p.signal_id, max(e.exec_ts) AS last_ts
  FROM probe p JOIN execs e ON e.alert_key = p.alert_key AND e.exec_ts <= p.ts GROUP BY p.signal_id
)
SELECT d.signal_id, d.alert_key,
  CASE WHEN d.decision <> 'ignore' AND d.cooldown_seconds > 0 AND l.last_ts IS NOT NULL
        AND epoch_us(d.ts) - epoch_us(l.last_ts) < d.cooldown_seconds * 1000000 THEN 'cooldown'
       ELSE d.decision END AS decision,
  strftime(l.last_ts, '%Y-%m-%d %H:%M:%S UTC') AS last_executed_at
FROM d LEFT JOIN lastx l ON l.signal_id = d.signal_id
""", ctes=("sig0", "signals", "tasks"))
def q_cooldown_asof(spark, sf_dir):
    out = R.cooldown_asof(decided(spark, sf_dir), fx.tasks(spark, sf_dir))
    return out.select("signal_id", "alert_key", "decision", fmt_utc("last_executed_at").alias("last_executed_at"))


@query("signal_fingerprint", "SELECT signal_id, fingerprint, length(fingerprint) AS fp_len FROM signals",
       ctes=("sig0", "signals"))
def q_signal_fingerprint(spark, sf_dir):
    s = fx.signals(spark, sf_dir)
    return s.select("signal_id", "fingerprint", F.length("fingerprint").cast("long").alias("fp_len"))


@query("signal_context", """
SELECT signal_id,
  CAST(list_count(list_filter([ann_top_app, trim(ann_swap_used_mb), trim(ann_reason_text)], lambda x: x <> ''))
       AS BIGINT) AS n_context,
  ann_top_app AS top_app, trim(ann_swap_used_mb) AS swap_used_mb,
  nullif(trim(ann_reason_text), '') AS reason_text
FROM signals
""", ctes=("sig0", "signals"))
def q_signal_context(spark, sf_dir):
    s = fx.signals(spark, sf_dir)
    ctx = context_pick(F.col("labels"), F.col("annotations"))
    return s.select("signal_id", ctx.alias("ctx")).select(
        "signal_id", F.size("ctx").cast("long").alias("n_context"),
        F.col("ctx")["top_app"].alias("top_app"), F.col("ctx")["swap_used_mb"].alias("swap_used_mb"),
        F.col("ctx")["reason_text"].alias("reason_text"))


@query("task_priority", """
SELECT signal_id, severity,
  CASE lower(severity) WHEN 'critical' THEN 100 WHEN 'warning' THEN 70 WHEN 'info' THEN 50 WHEN 'test' THEN 10
       ELSE 50 END AS priority
FROM signals
""", ctes=("sig0", "signals"))
def q_task_priority(spark, sf_dir):
    s = fx.signals(spark, sf_dir)
    return s.select("signal_id", "severity", severity_priority("severity").alias("priority"))
