"""Scalar functions and predicate gates over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions import numeric as N
from fleetlens.functions import text as TX
from fleetlens.functions import timefn as TF
from fleetlens.functions.maps import contains_any
from fleetlens.operators import audits as AU
from fleetlens.operators import chains as CH
from fleetlens.operators import mac as MAC
from fleetlens.operators import weekly as W
from fleetlens.plans.registry import query
from fleetlens.plans.weekly_queries import AS_OF_RUNS, HISTORY_DAYS, reviews_sql, rollup_sql
from fleetlens.sources import fixtures as fx

# FIXED VALUES - actions the executor accepts.
ALLOWED_ACTIONS = [
    "run_backup",
    "verify_backup",
    "notify_tg",
    "notify_email",
    "enqueue_mac_action",
    "run_admin_host_audit",
    "verify_admin_host_audit",
    "analyze_admin_host_audit",
    "run_vps_host_audit",
    "verify_vps_host_audit",
    "analyze_vps_host_audit",
    "run_monitoring_stack_audit",
    "verify_monitoring_stack_audit",
    "analyze_monitoring_stack_audit",
    "verify_mac_host_audit",
    "analyze_mac_host_audit",
    "generate_weekly_ops_review",
    "generate_ai_ops_brief",
    "copy_file_to_mac",
]
AS_OF_SNAP = "2024-01-31 00:00:00"


@query("text_scalars", """
SELECT pid,
  regexp_replace(regexp_replace(lower(trim(command)), '[^a-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g') AS label,
  coalesce(nullif(regexp_replace(regexp_replace(command, '[^A-Za-z0-9_-]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown')
    AS safe,
  replace(replace(command, '"', ''), '\\', '_') AS kind_clean,
  trim(regexp_replace(command || '  x', '\\s+', ' ', 'g')) AS squashed
FROM processes
""", ctes=("processes",))
def q_text_scalars(spark, sf_dir):
    """P5 sanitize_label, P6 safe_name, P7 drop_quotes_kind, P9 squash_spaces over process commands."""
    p = fx.processes(spark, sf_dir)
    return p.select("pid", TX.sanitize_label("command").alias("label"), TX.safe_name("command").alias("safe"),
                    TX.drop_quotes_kind("command").alias("kind_clean"),
                    TX.squash_spaces(F.concat("command", F.lit("  x"))).alias("squashed"))


@query("log_text_scalars", """
SELECT log_id,
  array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[-3:], '|') AS tail3,
  trim(list_filter(string_split(text, chr(10)), lambda x: starts_with(ltrim(x), 'reboot_required='))[-1][
       strpos(list_filter(string_split(text, chr(10)), lambda x: starts_with(ltrim(x), 'reboot_required='))[-1],
              'reboot_required=') + 16:]) AS last_reboot,
  contains(lower(text), 'docker_reachable=no') OR contains(lower(text), 'ufw_status=unknown') AS any_alarm
FROM kv_logs
""", ctes=("kv_logs",))
def q_log_text_scalars(spark, sf_dir):
    """P11 tail_lines, P12 last_prefixed_line, P38 contains_any over audit log texts."""
    k = fx.kv_logs(spark, sf_dir)
    return k.select("log_id", F.array_join(TX.tail_lines("text", 3), "|").alias("tail3"),
                    TX.last_prefixed_line("text", "reboot_required=").alias("last_reboot"),
                    contains_any("text", ["docker_reachable=no", "ufw_status=unknown"]).alias("any_alarm"))


@query("numeric_scalars", """
SELECT s.snapshot_id,
  CAST(trunc(s.swap_used_mb / 7.0) AS BIGINT) AS swap_int,
  CASE WHEN s.agent_launchd_loaded THEN 1 ELSE 0 END AS launchd_flag,
  CASE s.power_source WHEN 'ac' THEN 0 WHEN 'battery' THEN 1 WHEN 'unknown' THEN 2 ELSE 3 END AS power_code,
  greatest(CAST(s.brew_outdated_count AS BIGINT) - 30, 0) AS brew_over,
  CAST(round_even(s.swap_used_mb / 1024.0, 1) AS DOUBLE) AS swap_gb,
  CAST(CAST(round_even(s.swap_used_mb / 3.0, 0) AS BIGINT) AS VARCHAR) AS swap_third
FROM snapshots s
""", ctes=("snapshots",))
def q_numeric_scalars(spark, sf_dir):
    """P15 safe_int (truncation), P20 bool_int / level_code, P21 clamp_diff, P23 rounding, P24 fmt_num."""
    s = fx.snapshots(spark, sf_dir)
    pc = F.create_map(F.lit("ac"), F.lit(0), F.lit("battery"), F.lit(1), F.lit("unknown"), F.lit(2))
    return s.select(
        "snapshot_id", N.safe_int((F.col("swap_used_mb") / 7.0).cast("string")).alias("swap_int"),
        N.bool_int("agent_launchd_loaded").alias("launchd_flag"),
        F.coalesce(F.try_element_at(pc, F.col("power_source")), F.lit(3)).alias("power_code"),
        N.clamp_diff(F.col("brew_outdated_count").cast("long"), F.lit(30)).alias("brew_over"),
        N.rss_mb(F.col("swap_used_mb"), 1).alias("swap_gb"),
        N.fmt_num(F.col("swap_used_mb") / 3.0, 0).alias("swap_third"))


@query("time_scalars", f"""
SELECT snapshot_id,
  CAST(epoch(strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC')) AS BIGINT) AS parsed_unix,
  strftime(strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC'), '%Y-%m-%d_%H-%M-%S') AS stamp,
  strftime(date_trunc('minute', strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC')), '%Y-%m-%d %H:%M') AS slot_key,
  CAST(isodow(strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC')) - 1 AS INTEGER) AS weekday,
  greatest(CAST(epoch(TIMESTAMP '{AS_OF_SNAP}') AS BIGINT) - timestamp_unix, 0) AS age_seconds
FROM snapshots
""", ctes=("snapshots",))
def q_time_scalars(spark, sf_dir):
    """P25 parse_utc, P26 stamp, P27 slot_key, P28 weekday, P29 age_seconds (floored at 0)."""
    s = fx.snapshots(spark, sf_dir)
    ts = TF.parse_utc("timestamp_utc")
    return s.select("snapshot_id", F.unix_timestamp(ts).alias("parsed_unix"), TF.stamp(ts).alias("stamp"),
                    TF.slot_key(ts).alias("slot_key"), TF.weekday_mon0(ts).alias("weekday"),
                    TF.age_seconds(TF.as_of_lit(AS_OF_SNAP), F.timestamp_seconds("timestamp_unix")).alias("age_seconds"))


@query("probe_status", f"""
WITH kvl AS (
  SELECT k.log_id, trim(l.raw) AS line, l.pos FROM kv_logs k,
    unnest(string_split(k.text, chr(10))) WITH ORDINALITY AS l(raw, pos)
),
kvp AS (
  SELECT log_id, trim(substr(line, 1, strpos(line, '=') - 1)) AS key, trim(substr(line, strpos(line, '=') + 1)) AS value,
    pos FROM kvl WHERE line <> '' AND NOT starts_with(line, '===') AND strpos(line, '=') > 0
),
f AS (SELECT log_id, key, arg_max(value, pos) AS value FROM kvp WHERE starts_with(key, 'probe_') GROUP BY log_id, key)
SELECT log_id, key AS probe, coalesce(lower(trim(value)), '') IN {tuple(AU.PROBE_OK_VALUES)!r} AS probe_ok FROM f
""", ctes=("kv_logs",))
def q_probe_status(spark, sf_dir):
    """F12 over every ``probe_*`` fact of every log."""
    f = AU.kv_facts(fx.kv_logs(spark, sf_dir)).where(F.col("key").startswith("probe_"))
    return f.select("log_id", F.col("key").alias("probe"), AU.probe_ok(F.col("value")).alias("probe_ok"))


@query("allowed_actions", f"""
SELECT action, count(*) AS runs, action IN {tuple(ALLOWED_ACTIONS)!r} AS allowed FROM runs GROUP BY action
""", ctes=("runs",))
def q_allowed_actions(spark, sf_dir):
    """run actions checked against the allow list (a broadcast semi/anti join with the list)."""
    allow = spark.createDataFrame([(a,) for a in ALLOWED_ACTIONS], "action string").withColumn("allowed", F.lit(True))
    r = fx.runs(spark, sf_dir).groupBy("action").agg(F.count(F.lit(1)).alias("runs"))
    return r.join(F.broadcast(allow), "action", "left").select(
        "action", "runs", F.coalesce("allowed", F.lit(False)).alias("allowed"))


@query("event_gate", """
SELECT snapshot_id, (CASE WHEN swap_used_mb >= 2400 OR uptime_days >= 20 OR disk_used_percent >= 92 THEN 'critical'
    WHEN swap_used_mb >= 1400 OR uptime_days >= 10 OR disk_used_percent >= 85 THEN 'warning' ELSE 'ok' END)
    IN ('warning', 'critical') AS emit
FROM snapshots
""", ctes=("snapshots",))
def q_event_gate(spark, sf_dir):
    """F14 over memory evaluations (no top process attached: metrics-only thresholds)."""
    e = MAC.memory_evaluate(fx.snapshots(spark, sf_dir).withColumn("top_rss_kb", F.lit(None).cast("long"))
                            .withColumn("top_command", F.lit(None).cast("string")))
    return e.select("snapshot_id", MAC.should_emit_event(F.col("status")).alias("emit"))


@query("brief_gate", f"""WITH {reviews_sql(HISTORY_DAYS, 'true')}
SELECT domain, id, CASE WHEN analysis_level NOT IN ('warning', 'critical') THEN 'skipped'
  WHEN analysis_summary = '' THEN 'failed' ELSE 'generate' END AS brief_action
FROM reviews
""", ctes=("runs",))
def q_brief_gate(spark, sf_dir):
    """F15 over normalised audit reviews: level warning/critical -> brief; else skipped; empty summary -> failed."""
    r = W.all_reviews(fx.runs(spark, sf_dir), AS_OF_RUNS, HISTORY_DAYS)
    lvl = F.lower(TX.py_strip("analysis_level"))
    act = (F.when(~lvl.isin("warning", "critical"), F.lit("skipped"))
           .when(TX.py_strip("analysis_summary") == "", F.lit("failed")).otherwise(F.lit("generate")))
    return r.select("domain", "id", act.alias("brief_action"))


@query("step_gate", f"""WITH {reviews_sql(HISTORY_DAYS, 'true')}
SELECT domain, id, analysis_level, lower(trim(analysis_level)) IN ('warning', 'critical') AS brief_step_runs,
  status IN ('success', 'skipped') AS continue_chain
FROM reviews
""", ctes=("runs",))
def q_step_gate(spark, sf_dir):
    """F9 (``when: analysis_level_in``) and F10 (continue statuses) over reviewed levels."""
    r = W.all_reviews(fx.runs(spark, sf_dir), AS_OF_RUNS, HISTORY_DAYS)
    levels = F.array(F.lit("warning"), F.lit("critical"))
    return r.select("domain", "id", "analysis_level",
                    CH.step_when(levels, F.col("analysis_level")).alias("brief_step_runs"),
                    CH.chain_continue(F.col("status")).alias("continue_chain"))


@query("brief_input", f"""WITH {reviews_sql(HISTORY_DAYS, 'true')}
SELECT domain, id, '{{"analysis_findings_count":' || CAST(analysis_findings_count AS VARCHAR) || ',"analysis_level":"'
  || lower(analysis_level) || '","analysis_log_path":"' || analysis_log_path || '","analysis_summary":"'
  || analysis_summary || '","source":"' || domain || '"}}' AS brief_input
FROM reviews WHERE lower(analysis_level) IN ('warning', 'critical') AND analysis_summary <> ''
""", ctes=("runs",))
def q_brief_input(spark, sf_dir):
    """The structured input of a brief, built from an actionable review (sorted-key JSON)."""
    r = W.all_reviews(fx.runs(spark, sf_dir), AS_OF_RUNS, HISTORY_DAYS)
    r = r.where(F.lower("analysis_level").isin("warning", "critical") & (F.col("analysis_summary") != ""))
    j = F.to_json(F.struct(F.col("analysis_findings_count").alias("analysis_findings_count"),
                           F.lower("analysis_level").alias("analysis_level"), "analysis_log_path", "analysis_summary",
                           F.col("domain").alias("source")))
    return r.select("domain", "id", j.alias("brief_input"))


@query("posture_adjust", f"""WITH {rollup_sql(HISTORY_DAYS)},
ok AS (SELECT coalesce(bool_and(latest_level = 'ok'), false) AND count(*) > 0 AS all_ok FROM rollup)
SELECT response_id,
  CASE WHEN all_ok AND s = 'risky' THEN 'watch' ELSE s END AS week_status, summary
FROM (SELECT response_id, CASE response_id % 3 WHEN 0 THEN 'risky' WHEN 1 THEN 'watch' ELSE 'stable' END AS s,
             'weekly summary ' || CAST(response_id AS VARCHAR) AS summary FROM responses) x CROSS JOIN ok
""", ctes=("runs", "responses"))
def q_posture_adjust(spark, sf_dir):
    """A15 + A14: posture of weekly reviews adjusted by whether every audit domain is ok now."""
    roll = W.domain_rollup(W.audit_reviews(fx.runs(spark, sf_dir), AS_OF_RUNS, HISTORY_DAYS))
    ok = W.all_domains_ok(roll)
    r = fx.responses(spark, sf_dir).select(
        "response_id", F.element_at(F.array(F.lit("risky"), F.lit("watch"), F.lit("stable")),
                                    (F.col("response_id") % 3 + 1).cast("int")).alias("s"),
        F.concat(F.lit("weekly summary "), F.col("response_id").cast("string")).alias("summary"))
    all_ok = bool(ok.first()["all_domains_ok"])  # a single flag, not data
    status, summ = W.posture_adjust(F.col("s"), F.col("summary"), F.lit(all_ok))
    return r.select("response_id", status.alias("week_status"), summ.alias("summary"))


@query("weekly_totals_doc", f"""WITH {rollup_sql(HISTORY_DAYS)}
SELECT CAST(count(*) AS BIGINT) AS domains, CAST(sum(total_runs) AS BIGINT) AS reviews,
  CAST(sum(critical_count) AS BIGINT) AS critical_reviews,
  string_agg(domain || '=' || latest_level, ',' ORDER BY domain) AS posture
FROM rollup
""", ctes=("runs",))
def q_weekly_totals_doc(spark, sf_dir):
    """The weekly document's audit part folded to one row (domains are few: one small group)."""
    roll = W.domain_rollup(W.audit_reviews(fx.runs(spark, sf_dir), AS_OF_RUNS, HISTORY_DAYS))
    return roll.agg(
        F.count(F.lit(1)).alias("domains"), F.sum("total_runs").cast("long").alias("reviews"),
        F.sum("critical_count").cast("long").alias("critical_reviews"),
        F.array_join(F.array_sort(F.collect_list(F.concat("domain", F.lit("="), "latest_level"))), ",")
        .alias("posture"))
