"""Webhook intake, task payloads, decision views, notices and outbox rows
(S1, K2, K10, K13, K14, K15, K16, J8, P3, P39, U-1..U-4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.maps import context_pick
from fleetlens.functions.text import render_summary
from fleetlens.operators import audits as AU
from fleetlens.operators import mac as MAC
from fleetlens.operators import outputs as OUT
from fleetlens.operators import rules as R
from fleetlens.plans.audit_queries import FACTS_SQL, VPS_SQL
from fleetlens.plans.mac_queries import _TOP_SQL
from fleetlens.plans.registry import query
from fleetlens.plans.schedule_queries import DUE_SQL
from fleetlens.plans.signal_queries import COOLDOWN_CTES, _sql_first_match, decisions
from fleetlens.sources import fixtures as fx
from fleetlens.sources.config import RULES, normalized_rules

# ------------------------------------------------------------------ S1 webhook intake


def _webhooks(spark, sf_dir):
    """One webhook body per signal: a malformed ``alerts`` every 50th, a leading non-object item every 7th,
    an explicit fingerprint on two of three, status with padding and upper case."""
    s = fx.signals(spark, sf_dir)
    sid = F.col("signal_id")
    fp = F.when(sid % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("fp-"), sid.cast("string")))
    alert = F.concat(
        F.lit('{"status":" FIRING ","labels":{"alertname":"'), F.col("alertname"), F.lit('","severity":"'),
        F.col("severity"), F.lit('","instance":"'), F.col("instance"), F.lit('","job":"'), F.col("job"),
        F.lit('"},"annotations":{"summary":" '), F.col("summary"), F.lit(' "},"fingerprint":"'), fp, F.lit('"}'))
    alerts = (F.when(sid % 50 == 0, F.lit("5")).when(sid % 7 == 0, F.concat(F.lit("[1,"), alert, F.lit("]")))
              .otherwise(F.concat(F.lit("["), alert, F.lit("]"))))
    return s.select("signal_id", F.concat(F.lit('{"receiver":"r","alerts":'), alerts, F.lit("}")).alias("body"))


@query("alerts_explode", """
SELECT signal_id, CAST(CASE WHEN signal_id % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS pos, 'firing' AS status,
  alertname, CASE WHEN signal_id % 3 = 0 THEN fingerprint ELSE 'fp-' || CAST(signal_id AS VARCHAR) END AS fingerprint,
  summary
FROM signals WHERE signal_id % 50 <> 0
""", ctes=("sig0", "signals"))
def q_alerts_explode(spark, sf_dir):
    return OUT.alerts_from_webhook(_webhooks(spark, sf_dir)).select(
        "signal_id", "pos", "status", "alertname", "fingerprint", "summary")


# ------------------------------------------------------------------ K16 decision view

def _json_str(x: str) -> str:
    return f"'\"' || replace(replace({x}, '\\', '\\\\'), '\"', '\\\"') || '\"'"


_CTX_JSON = ("'{' || array_to_string(list_filter(["
             f"CASE WHEN trim(ann_reason_text) <> '' THEN '\"reason_text\":' || {_json_str('trim(ann_reason_text)')} END, "
             f"CASE WHEN trim(ann_swap_used_mb) <> '' THEN '\"swap_used_mb\":' || {_json_str('trim(ann_swap_used_mb)')} END, "
             f"CASE WHEN trim(ann_top_app) <> '' THEN '\"top_app\":' || {_json_str('trim(ann_top_app)')} END"
             "], lambda x: x IS NOT NULL), ',') || '}'")


# the oracle's own text of each rule's steps (fixed values of the configuration)
_STEPS_SQL = "CASE rule_name " + " ".join(
    "WHEN '" + r["name"] + "' THEN '[" + ",".join(
        '{"name":"' + x["name"] + '","payload":' + ('{"message":"' + x["message"] + '"}' if x.get("message") else "{}")
        + ',"retries":' + str(x.get("retries", 0)) + ',"retry_delay_seconds":' + str(x.get("retry_delay_seconds", 0))
        + (',"when":{"analysis_level_in":["' + '","'.join(x["analysis_level_in"]) + '"]}' if x.get("analysis_level_in") else "") + "}"
        for x in r["steps"]) + "]'" for r in RULES) + " END"


@query("decision_view", f"""WITH RECURSIVE {COOLDOWN_CTES}
SELECT signal_id AS decision_id, alertname, status, severity, instance, job, summary, fingerprint,
  final_decision AS decision, final_reason AS reason, rule_name,
  CASE WHEN final_decision = 'execute_chain' THEN 'chain' END AS action,
  CASE WHEN final_decision = 'execute_chain' THEN {_STEPS_SQL} END AS steps_json, {_CTX_JSON} AS context_json
FROM cd
""", ctes=("sig0", "signals"))
def q_decision_view(spark, sf_dir):
    return OUT.decision_view(decisions(spark, sf_dir), OUT.rule_actions(spark))


# ------------------------------------------------------------------ S1 -> J1 -> K2, K16: webhook bodies to tasks

_CHAIN_CONTEXT = "'{' || array_to_string(list_filter([" + ", ".join([
    f"'\"alert_status\":' || {_json_str('status')}", f"'\"alertname\":' || {_json_str('alertname')}", f"'\"context\":' || {_CTX_JSON}",
    "'\"description\":\"\"'", f"'\"fingerprint\":' || {_json_str('fingerprint')}", f"'\"instance\":' || {_json_str('instance')}",
    f"'\"job\":' || {_json_str('job')}",
    f"CASE WHEN trim(ann_reason_text) <> '' THEN '\"reason_text\":' || {_json_str('trim(ann_reason_text)')} END",
    f"'\"rule_name\":' || {_json_str('rule_name')}", f"'\"severity\":' || {_json_str('severity')}", f"'\"summary\":' || {_json_str('summary')}",
    f"CASE WHEN trim(ann_swap_used_mb) <> '' THEN '\"swap_used_mb\":' || {_json_str('trim(ann_swap_used_mb)')} END",
    f"CASE WHEN trim(ann_top_app) <> '' THEN '\"top_app\":' || {_json_str('trim(ann_top_app)')} END",
]) + "], lambda x: x IS NOT NULL), ',') || '}'"
_PRIORITY = ("CASE lower(severity) WHEN 'critical' THEN 100 WHEN 'warning' THEN 70 WHEN 'info' THEN 50 WHEN 'test' THEN 10 "
             "ELSE 50 END")
_CHAIN_PAYLOAD = f"'{{\"alert_key\":' || {_json_str('alert_key')} || ',\"chain_context\":' || {_CHAIN_CONTEXT} || ',\"steps\":' || {_STEPS_SQL} || '}}'"


@query("chain_task_payload", f"""WITH RECURSIVE {COOLDOWN_CTES}
SELECT signal_id AS decision_id, 'chain' AS task_type, {_PRIORITY} AS priority, alert_key, {_CHAIN_PAYLOAD} AS payload
FROM cd WHERE final_decision = 'execute_chain'
""", ctes=("sig0", "signals"))
def q_chain_task_payload(spark, sf_dir):
    """K2 + P39 after the cooldown; the whole payload text is compared."""
    return OUT.decision_tasks(decisions(spark, sf_dir), OUT.rule_actions(spark))


#: The configured rules and one that executes an action, so that branch runs too.
EXECUTE_RULES = [*RULES, {"name": "demo_checkout_execute", "match": {"alertname": "DemoCheckout", "status": "firing", "severity": "critical"},
                          "action_type": "execute", "action_name": "run_backup", "payload": {"target": "vps", "depth": 2}, "cooldown_seconds": 600}]


@query("webhook_to_tasks", f"""WITH d AS ({_sql_first_match(rules=EXECUTE_RULES)})
SELECT signal_id AS decision_id, CASE WHEN decision = 'execute' THEN 'action' ELSE 'chain' END AS task_type,
  {_PRIORITY} AS priority, alert_key,
  CASE WHEN decision = 'execute'
    THEN '{{"action":"run_backup","alert_key":' || {_json_str('alert_key')} || ',"payload":{{"depth":2,"target":"vps"}}}}'
    ELSE {_CHAIN_PAYLOAD} END AS payload
FROM d WHERE decision IN ('execute', 'execute_chain')
""", ctes=("sig0", "signals"))
def q_webhook_to_tasks(spark, sf_dir):
    """S1 -> J1 -> K2: webhook bodies are parsed, classified and turned into tasks, payload text included."""
    s = fx.signals(spark, sf_dir)
    alert = F.struct("status", "labels", "annotations", F.lit("").alias("fingerprint"))
    bodies = s.select("signal_id", "ts", F.to_json(F.struct(F.array(alert).alias("alerts"))).alias("body"))
    decided = R.first_match(OUT.alerts_from_webhook(bodies), EXECUTE_RULES)
    return OUT.decision_tasks(decided, OUT.rule_actions(spark, EXECUTE_RULES))


# ------------------------------------------------------------------ K13 remediation tasks, J8 notices

@query("remediation_tasks", f"""WITH RECURSIVE {COOLDOWN_CTES}
SELECT signal_id AS source_decision_id, CAST(NULL AS BIGINT) AS decision_id, 'mac_action' AS task_type,
  '{{"action":"soft_quit_allowlisted_candidate","instance":"' || trim(instance) || '"}}' AS payload,
  CASE lower(trim(coalesce(nullif(severity, ''), 'critical'))) WHEN 'critical' THEN 100 WHEN 'warning' THEN 70
       WHEN 'info' THEN 50 WHEN 'test' THEN 10 ELSE 50 END AS priority
FROM cd WHERE final_decision = 'execute_chain' AND rule_name = 'mac_memory_pressure_critical_escalate'
""", ctes=("sig0", "signals"))
def q_remediation_tasks(spark, sf_dir):
    return OUT.remediation_tasks(decisions(spark, sf_dir))


@query("remediation_results", """
SELECT signal_id, CASE WHEN a <> '' THEN 'success' ELSE 'failed' END AS result_status, CASE WHEN a <> '' THEN 0 ELSE 1 END AS exit_code,
  CASE WHEN a = '' THEN 'missing field: action' END AS error,
  CASE WHEN a <> '' THEN '{"action":"' || a || '","instance":"' || instance || '"}' END AS task_payload,
  CASE WHEN a <> '' THEN CASE coalesce(sev, 'critical') WHEN 'critical' THEN 100 WHEN 'warning' THEN 70 WHEN 'info' THEN 50 WHEN 'test' THEN 10 ELSE 50 END END AS task_priority
FROM (SELECT signal_id, instance, CASE signal_id % 4 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'soft_quit' ELSE 'quit' END AS a,
        CASE WHEN signal_id % 3 = 0 THEN NULL ELSE severity END AS sev FROM signals) x
""", ctes=("sig0", "signals"))
def q_remediation_results(spark, sf_dir):
    """K13 with payloads that miss the action (absent or blank) or the severity."""
    k = F.col("signal_id") % 4
    action = F.when(k == 0, F.lit("  ")).when(k == 2, F.lit(" soft_quit ")).when(k == 3, F.lit("quit"))
    s = fx.signals(spark, sf_dir).select("signal_id", "instance", action.alias("action"), F.when(F.col("signal_id") % 3 != 0, F.upper("severity")).alias("severity"))
    return OUT.remediation_results(s).select("signal_id", "result_status", "exit_code", "error", "task_payload", "task_priority")


@query("failed_remediation", """
SELECT id AS task_id, decision_id, 'notify' AS task_type, 100 AS priority, 'critical' AS severity,
  '[MAC][REMEDIATION FAILED] ' || a || ' on ' || i AS message,
  concat_ws(chr(10), 'Remote mac remediation failed', '', 'task_id: ' || CAST(id AS VARCHAR), 'instance: ' || i,
            'action: ' || a, CASE WHEN tg <> '' THEN 'target: ' || tg END,
            'error: ' || trim(coalesce(json_extract_string(result_json, '$.error'), 'unknown remediation failure')))
    AS description,
  'mac_remediation_failed' AS event
FROM (
  SELECT *, coalesce(nullif(trim(coalesce(json_extract_string(payload, '$.instance'), 'unknown')), ''), 'unknown') AS i,
    coalesce(nullif(trim(coalesce(json_extract_string(payload, '$.action'), 'unknown')), ''), 'unknown') AS a,
    trim(coalesce(json_extract_string(result_json, '$.target'), json_extract_string(payload, '$.target'), '')) AS tg
  FROM tasks WHERE task_type = 'mac_action' AND status = 'failed') t
""", ctes=("tasks",))
def q_failed_remediation(spark, sf_dir):
    return OUT.failed_remediation_notices(fx.tasks(spark, sf_dir))


# ------------------------------------------------------------------ P3 + K10 notification outbox

# FIXED VALUES - notify facts of the memory-pressure rules, in order (values are templates).
_MEM_FACTS = ["top_app", "top_rss_mb", "swap_used_mb", "memory_free_percent", "uptime_days", "suggested_action"]
_TITLES = {r["name"]: s["message"] for r in normalized_rules() for s in r["steps"]
           if s["name"] == "notify_tg" and s.get("message")}


def _notes(spark, sf_dir):
    d = decisions(spark, sf_dir).where(F.col("rule_name").isin("mac_memory_pressure_warning_notify",
                                                               "mac_memory_pressure_critical_escalate")
                                       & (F.col("decision") == "execute_chain"))
    tmpl = spark.createDataFrame(list(_TITLES.items()), "rule_name string, title_tpl string")
    d = d.join(F.broadcast(tmpl), "rule_name")
    ctx = F.map_concat(F.create_map(F.lit("instance"), F.col("instance"), F.lit("alertname"), F.col("alertname"),
                                    F.lit("severity"), F.col("severity")),
                       context_pick(F.col("labels"), F.col("annotations")))
    facts = [F.struct(F.lit(k).alias("key"), OUT.render_template(F.lit("{{ " + k + " }}"), ctx).alias("value"))
             for k in _MEM_FACTS]
    facts_crit = facts + [F.struct(F.lit("remediation").alias("key"),
                                   F.lit("soft_quit_allowlisted_candidate").alias("value"))]
    return d.select(
        F.col("signal_id").alias("decision_id"),
        OUT.render_template(F.col("title_tpl"), ctx).alias("title"), F.lit(None).cast("string").alias("message"),
        OUT.render_template(F.lit("{{ reason_text }}"), ctx).alias("body"),
        F.lit(None).cast("string").alias("description"),
        F.when(F.col("rule_name") == "mac_memory_pressure_critical_escalate", F.array(*facts_crit))
        .otherwise(F.array(*facts)).alias("facts"),
        F.lit("mac_memory_pressure").alias("event"), F.lit("action-runner").alias("source"),
        F.col("severity"), F.lit("firing").alias("status"))


_OUTBOX_CTES = f"""WITH RECURSIVE {COOLDOWN_CTES},
n AS (
  SELECT signal_id AS decision_id,
    CASE WHEN rule_name = 'mac_memory_pressure_critical_escalate' THEN '[MAC][CRITICAL] ' ELSE '[MAC][WARNING] ' END
      || instance || ' memory pressure' AS title,
    list_filter([
      CASE WHEN trim(ann_top_app) <> '' THEN 'top_app: ' || trim(ann_top_app) END,
      CASE WHEN trim(ann_swap_used_mb) <> '' THEN 'swap_used_mb: ' || trim(ann_swap_used_mb) END,
      CASE WHEN rule_name = 'mac_memory_pressure_critical_escalate'
           THEN 'remediation: soft_quit_allowlisted_candidate' END], lambda x: x IS NOT NULL) AS lines,
    trim(ann_reason_text) AS body, severity
  FROM cd WHERE final_decision = 'execute_chain'
    AND rule_name IN ('mac_memory_pressure_warning_notify', 'mac_memory_pressure_critical_escalate')
)
"""
_OUTBOX_DETAILS = "trim(array_to_string(CASE WHEN body <> '' THEN list_concat(lines, ['', body]) ELSE lines END, chr(10)), ' ' || chr(10))"


@query("notification_outbox", f"{_OUTBOX_CTES} SELECT decision_id, title AS out_title, {_OUTBOX_DETAILS} AS out_details FROM n", ctes=("sig0", "signals"))
def q_notification_outbox(spark, sf_dir):
    return OUT.notification_outbox(_notes(spark, sf_dir)).select("decision_id", "out_title", "out_details")


def _payload_sql(status: str, event: str, severity: str, source: str, job: str, summary: str, description: str) -> str:
    return f"""to_json({{'alerts': [{{'annotations': {{'description': {description}, 'summary': {summary}}},
      'labels': {{'alertname': {event}, 'instance': 'vps', 'job': '{job}', 'severity': {severity}, 'service': {source}}}, 'status': {status}}}],
    'commonAnnotations': {{'summary': {summary}}}, 'commonLabels': {{'severity': {severity}, 'service': {source}}}, 'groupLabels': {{'alertname': {event}}},
    'receiver': 'action-runner', 'status': {status}}})"""


@query("alert_payloads", f"""
WITH n AS (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'note "' || event_type || '" ' || CAST(event_id AS VARCHAR) END AS message,
    CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'a' || chr(10) || 'b\\c' ELSE 'é ' END AS description, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS event,
    CASE WHEN event_id % 2 = 0 THEN 'critical' END AS severity FROM events),
p AS (SELECT event_id, coalesce(nullif(trim(message), ''), 'Notification from action-runner') AS message, nullif(trim(description), '') AS description,
  coalesce(nullif(event, ''), 'action_runner_event') AS event, coalesce(severity, 'info') AS severity FROM n)
SELECT event_id AS note_id, CAST({_payload_sql("'firing'", "event", "severity", "'action-runner'", "action-runner", "message", "coalesce(description, message)")} AS VARCHAR) AS payload FROM p
""")
def q_alert_payloads(spark, sf_dir):
    """Alert-shaped payload texts, fields missing or blank in turn."""
    k = F.col("event_id")
    ev = fx.read_table(spark, sf_dir, "events").select("event_id", "event_type")
    n = ev.select(k.alias("note_id"), F.when(k % 5 == 0, None).when(k % 5 == 1, "  ").otherwise(F.concat(F.lit('note "'), "event_type", F.lit('" '), k.cast("string"))).alias("message"),
                  F.when(k % 3 == 0, None).when(k % 3 == 1, "a\nb\\c").otherwise("é ").alias("description"), F.when(k % 7 == 0, "").otherwise(F.col("event_type")).alias("event"),
                  F.lit(None).cast("string").alias("source"), F.when(k % 2 == 0, "critical").alias("severity"), F.lit(None).cast("string").alias("status"))
    return OUT.alert_payloads(n).select("note_id", "payload")


@query("message_payloads", f"""{_OUTBOX_CTES}, m AS (SELECT decision_id, title, severity, {_OUTBOX_DETAILS} AS details FROM n)
SELECT decision_id, CAST({_payload_sql("'firing'", "'mac_memory_pressure'", "severity", "'action-runner'", "control-plane", "title", "details")} AS VARCHAR) AS payload FROM m
""", ctes=("sig0", "signals"))
def q_message_payloads(spark, sf_dir):
    """Payload texts of notes in message format."""
    return OUT.message_payloads(_notes(spark, sf_dir)).select("decision_id", "payload")


@query("decision_tasks_view", f"""WITH RECURSIVE {COOLDOWN_CTES}
SELECT signal_id AS decision_id, alertname, final_decision AS decision, CASE WHEN final_decision IN ('execute', 'execute_chain') THEN t.id END AS task_id
FROM cd LEFT JOIN tasks t ON t.decision_id = cd.signal_id
""", ctes=("sig0", "signals", "tasks"))
def q_decision_tasks_view(spark, sf_dir):
    """The response rows with the ids of the tasks they have queued."""
    view = OUT.decision_view(decisions(spark, sf_dir), OUT.rule_actions(spark))
    return OUT.with_task_ids(view, fx.tasks(spark, sf_dir)).select("decision_id", "alertname", "decision", "task_id")


# ------------------------------------------------------------------ K14, K15

@query("kv_log_lines", f"""WITH {FACTS_SQL}
SELECT l.log_id, coalesce(string_agg(f.key || '=' || f.value, chr(10) ORDER BY f.key), '') AS text
FROM kv_logs l LEFT JOIN facts f ON f.log_id = l.log_id GROUP BY l.log_id
""", ctes=("kv_logs",))
def q_kv_log_lines(spark, sf_dir):
    """Every fact of every log, in key order."""
    return OUT.kv_log_lines(fx.kv_logs(spark, sf_dir).select("log_id", AU.kv_facts_map("text").alias("facts")))


@query("analysis_trailer", f"""WITH {VPS_SQL},
lv AS (
  SELECT l.log_id, l.host,
    CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 'critical'
         WHEN count(f.pos) > 0 THEN 'warning' ELSE 'ok' END AS level,
    count(f.pos) AS n,
    coalesce(string_agg(f.severity || ':' || f.message, '; ' ORDER BY f.pos), 'ok:no findings') AS summary
  FROM kv_logs l LEFT JOIN fnd f ON f.log_id = l.log_id GROUP BY l.log_id, l.host
)
SELECT log_id, 'host=' || host || ' audit_analyze=' || level || ' findings=' || summary || chr(10) || 'RESULT_JSON:'
  || '{{"analysis_findings_count":' || CAST(n AS VARCHAR) || ',"analysis_level":"' || level
  || '","analysis_log_path":"/var/log/vps-host-audit/audit_' || CAST(log_id AS VARCHAR)
  || '.log","analysis_summary":"' || summary || '","metrics_path":"/var/lib/node_exporter/vps_host_audit.prom"}}'
  AS stdout
FROM lv
""", ctes=("kv_logs",))
def q_analysis_trailer(spark, sf_dir):
    a = AU.analyze(fx.kv_logs(spark, sf_dir), AU.vps_findings)
    line = render_summary(F.col("host"), F.col("level"), F.col("summary"))
    fields = {
        "analysis_level": F.col("level"), "analysis_summary": F.col("summary"),
        "analysis_findings_count": F.col("findings_count"),
        "analysis_log_path": F.concat(F.lit("/var/log/vps-host-audit/audit_"), F.col("log_id").cast("string"),
                                      F.lit(".log")),
        "metrics_path": F.lit("/var/lib/node_exporter/vps_host_audit.prom"),
    }
    return a.select("log_id", OUT.analysis_trailer(line, fields).alias("stdout"))


# ------------------------------------------------------------------ U-1 .. U-4 set operations

@query("setops", """
WITH d AS (SELECT DISTINCT alertname, severity FROM signals)
SELECT 'union_sources' AS op, CAST((SELECT count(*) FROM signals) + (SELECT count(*) FROM snapshots) AS BIGINT) AS n
UNION ALL SELECT 'distinct_pairs', CAST(count(*) AS BIGINT) FROM d
UNION ALL SELECT 'except_pairs', CAST(count(*) AS BIGINT) FROM d WHERE severity <> 'info'
""", ctes=("sig0", "signals", "snapshots"))
def q_setops(spark, sf_dir):
    """U-1 union of two signal sources (different columns, by name), U-3 distinct pairs, U-2 difference."""
    s = fx.signals(spark, sf_dir).select("signal_id", "alertname", "severity", F.lit("alertmanager").alias("source"))
    a = fx.snapshots(spark, sf_dir).select(F.col("snapshot_id").alias("signal_id"), "host",
                                           F.lit("agent").alias("source"))
    u = s.unionByName(a, allowMissingColumns=True)
    pairs = s.select("alertname", "severity").distinct()
    diff = pairs.exceptAll(s.where(F.col("severity") == "info").select("alertname", "severity").distinct())
    return (u.agg(F.count(F.lit(1)).alias("n")).select(F.lit("union_sources").alias("op"), "n")
            .unionByName(pairs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("distinct_pairs").alias("op"), "n"))
            .unionByName(diff.agg(F.count(F.lit(1)).alias("n")).select(F.lit("except_pairs").alias("op"), "n")))


# ------------------------------------------------------------------ K8 brief markdown

@query("brief_markdown", """WITH """ + __import__("fleetlens.plans.weekly_queries", fromlist=["x"]).reviews_sql(3650, "true")
       + """,
b AS (
  SELECT r.*, p.review FROM reviews r JOIN responses p ON p.response_id = r.id
  WHERE lower(r.analysis_level) IN ('warning', 'critical') AND r.analysis_summary <> ''
    AND json_valid(p.review) AND json_extract_string(p.review, '$.brief_status') IN ('stable', 'watch', 'risky')
    AND json_extract(p.review, '$.operator_note') IS NOT NULL
)
SELECT id, trim(array_to_string(list_concat(
  ['# Ops incident brief', '', '- Generated at: ' || started_at, '- Source: ' || domain,
   '- Analysis level: ' || lower(analysis_level), '- Findings count: ' || CAST(analysis_findings_count AS VARCHAR),
   '- Log path: ' || analysis_log_path, '- Brief status: ' || json_extract_string(review, '$.brief_status'), '',
   '## Analyzer summary', '', analysis_summary, '', '## Executive summary', '',
   json_extract_string(review, '$.executive_summary'), '', '## Top risks', ''],
  list_transform(CAST(json_extract(review, '$.top_risks') AS VARCHAR[]), lambda x: '- ' || x),
  ['', '## Recommended actions', ''],
  list_transform(CAST(json_extract(review, '$.recommended_actions') AS VARCHAR[]), lambda x: '- ' || x),
  ['', '## Operator note', '', json_extract_string(review, '$.operator_note'), ''],
  ['## Facts', '', '- host: ' || domain, '- metrics_path: /m/' || CAST(id AS VARCHAR) || '.prom', '']
), chr(10)), ' ' || chr(10)) || chr(10) AS markdown
FROM b
""", ctes=("runs", "responses"))
def q_brief_markdown(spark, sf_dir):
    """K8 over data: actionable reviews joined with the stored model response of the same run; valid
    responses (U7) are rendered with the review as brief input."""
    from fleetlens.operators import weekly as W
    from fleetlens.operators.artifacts import validate_review
    from fleetlens.plans.weekly_queries import AS_OF_RUNS, HISTORY_DAYS

    r = W.all_reviews(fx.runs(spark, sf_dir), AS_OF_RUNS, HISTORY_DAYS)
    r = r.where(F.lower("analysis_level").isin("warning", "critical") & (F.col("analysis_summary") != ""))
    resp = fx.responses(spark, sf_dir).select(F.col("response_id").alias("id"), "review")
    j = r.join(resp, "id").where(validate_review("review")["valid"])
    j = j.select(
        "id", F.col("started_at").alias("generated_at"), F.col("domain").alias("source"),
        F.lower("analysis_level").alias("analysis_level"), "analysis_findings_count", "analysis_log_path",
        "analysis_summary", F.from_json("review", OUT.BRIEF_SCHEMA).alias("brief"),
        F.create_map(F.lit("host"), F.col("domain"), F.lit("metrics_path"),
                     F.concat(F.lit("/m/"), F.col("id").cast("string"), F.lit(".prom"))).alias("facts"))
    return j.select("id", OUT.render_brief_markdown(j).alias("markdown"))


# ------------------------------------------------------------------ U-1 all signal sources in one schema

@query("all_signals", f"""WITH {_TOP_SQL.lstrip()},
{DUE_SQL.strip()},
u AS (
  SELECT 'alertmanager' AS source, status, alertname, severity, instance, job, summary, fingerprint FROM signals
  UNION ALL
  SELECT 'scheduler', status, alertname, severity, instance, job, '',
    'schedule:' || name || ':' || strftime(slot_ts, '%Y-%m-%d %H:%M') FROM due2
  UNION ALL
  SELECT 'agent', 'firing', 'MacMemoryPressure', status, host, 'mac-agent', NULL,
    sha256('{{"alertname":"MacMemoryPressure","instance":"' || host || '","job":"mac-agent","severity":"' || status || '"}}')
  FROM ev2 WHERE status IN ('warning', 'critical')
)
SELECT source, alertname, severity, instance, fingerprint, decision, rule_name, alert_key FROM ({_sql_first_match('u')}) d
""", ctes=("sig0", "signals", "snapshots", "processes"))
def q_all_signals(spark, sf_dir):
    """U-1: webhook alerts, scheduler slots and agent events in one schema, classified by the same rules."""
    from fleetlens.operators import schedule as SC
    from fleetlens.plans.mac_queries import _evaluated
    from fleetlens.plans.schedule_queries import _due

    s = fx.signals(spark, sf_dir)
    alert = F.struct("status", "labels", "annotations", F.lit("").alias("fingerprint"))
    alerts = OUT.alerts_from_webhook(s.select(F.to_json(F.struct(F.array(alert).alias("alerts"))).alias("body")))
    u = alerts.unionByName(SC.schedule_signals(_due(spark, sf_dir)), allowMissingColumns=True).unionByName(
        MAC.agent_signals(_evaluated(spark, sf_dir)), allowMissingColumns=True)
    return R.first_match(u).select("source", "alertname", "severity", "instance", "fingerprint", "decision", "rule_name", "alert_key")
