"""Operational tables projected from the driver's Parquet tables.

The reference keeps decisions / tasks / runs in a row store and reads audit
logs and snapshots from files. The test data is a TPC-H-like star schema, so
each operational table is a *narrow, map-only projection* of one driver table
(no shuffle, column-pruned scan). Every projection exists twice: as a Spark
DataFrame builder and as a DuckDB SQL text (``ORACLE_CTES``), so an oracle can
recompute any query from the same Parquet files.

Timestamps: Parquet stores them without a zone; they are cast once to
``TimestampType`` under a UTC session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.maps import fingerprint
from fleetlens.session import cached_expr, ensure_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, where: Column | None = None) -> DataFrame:
    """Scan a table; ``where`` (on raw columns) is applied at the scan, so it
    reaches the Parquet reader as a pushed filter (row groups outside it are skipped)."""
    ensure_session(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if where is not None:
        df = df.where(where)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows dealt evenly over the session's cores, before a projection makes whole texts or records of them: a
    table's file may hold a single row group, and one task would do all of the work."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def time_range(col: str, rng: tuple[str, str] | None) -> Column | None:
    """Pushable form of the closed, second-precision window ``[lo, hi]`` on a raw (zone-less) timestamp
    column: ``lo <= c < hi + 1 second``."""
    if rng is None:
        return None
    lo, hi = rng
    return ((F.col(col) >= F.lit(lo).cast("timestamp_ntz"))
            & (F.col(col) < F.lit(hi).cast("timestamp_ntz") + F.expr("INTERVAL 1 SECOND")))


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The same table as a file stream (schema fixed from the batch read; the path is a glob so a single
    file or a directory of arriving files both work)."""
    ensure_session(spark)
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]"))


def _ts(c: str) -> Column:
    return F.col(c).cast("timestamp")


def _cases(col: Column, pairs: list[tuple], default) -> Column:
    expr = None
    for when_value, then_value in pairs:
        cond = col == F.lit(when_value)
        expr = F.when(cond, F.lit(then_value)) if expr is None else expr.when(cond, F.lit(then_value))
    return expr.otherwise(F.lit(default) if not isinstance(default, Column) else default)


# --------------------------------------------------------------------------------------------
# signals <- events
# --------------------------------------------------------------------------------------------

def signals(spark: SparkSession, sf_dir: str, ts_range: tuple[str, str] | None = None) -> DataFrame:
    """``ts_range`` limits the scan to a closed event-time window (only for uses that need no history)."""
    return signals_from(read_table(spark, sf_dir, "events", time_range("ts", ts_range)))


def signals_from(events: DataFrame) -> DataFrame:
    """Projection of an events frame (batch or streaming) to signal rows."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    alertname = _cases(
        F.col("event_type"),
        [("error", "MacMemoryPressure"), ("click", "BackupMissing"), ("view", "HostRebootDetected"),
         ("signup", "WeeklyOpsReview")],
        "DemoCheckout",
    )
    severity = (
        F.when(F.col("event_type") == "signup", F.lit("info"))
        .when(F.col("value") >= 70, F.lit("critical"))
        .when(F.col("value") >= 15, F.lit("warning"))
        .otherwise(F.lit("info"))
    )
    out = ev.select(
        F.col("event_id").alias("signal_id"),
        _ts("ts").alias("ts"),
        F.lit("alertmanager").alias("source"),
        F.when(F.col("event_id") % 10 == 0, F.lit("resolved")).otherwise(F.lit("firing")).alias("status"),
        alertname.alias("alertname"),
        severity.alias("severity"),
        F.concat(F.lit("host-"), (F.col("user_id") % 8).cast("string")).alias("instance"),
        F.concat(F.lit("job-"), (F.col("user_id") % 3).cast("string")).alias("job"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
        F.col("event_id"),
    )
    out = out.withColumn(
        "labels",
        F.create_map(
            F.lit("alertname"), F.col("alertname"),
            F.lit("instance"), F.col("instance"),
            F.lit("job"), F.col("job"),
            F.lit("severity"), F.col("severity"),
        ),
    ).withColumn(
        "annotations",
        F.create_map(
            F.lit("summary"), F.concat(F.col("alertname"), F.lit(" on "), F.col("instance")),
            F.lit("top_app"), F.col("event_type"),
            F.lit("swap_used_mb"), F.concat(F.lit(" "), (F.col("event_id") % 3000).cast("string"), F.lit(" ")),
            F.lit("reason_text"), F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("props")),
        ),
    )
    return out.select(
        "signal_id", "ts", "source", "status", "alertname", "severity", "instance", "job",
        F.col("annotations")["summary"].alias("summary"),
        F.lit("").alias("description"),
        fingerprint(F.col("labels"), F.lit(None).cast("string")).alias("fingerprint"),
        "labels", "annotations", "value",
    )


_SIGNALS_SQL = """
SELECT event_id AS signal_id, ts, 'alertmanager' AS source,
  CASE WHEN event_id % 10 = 0 THEN 'resolved' ELSE 'firing' END AS status,
  CASE event_type WHEN 'error' THEN 'MacMemoryPressure' WHEN 'click' THEN 'BackupMissing'
       WHEN 'view' THEN 'HostRebootDetected' WHEN 'signup' THEN 'WeeklyOpsReview' ELSE 'DemoCheckout' END AS alertname,
  CASE WHEN event_type = 'signup' THEN 'info' WHEN value >= 70 THEN 'critical'
       WHEN value >= 15 THEN 'warning' ELSE 'info' END AS severity,
  'host-' || CAST(user_id % 8 AS VARCHAR) AS instance,
  'job-' || CAST(user_id % 3 AS VARCHAR) AS job,
  event_type, value, props, event_id
FROM events
"""

_SIGNALS_FULL_SQL = """
SELECT signal_id, ts, source, status, alertname, severity, instance, job,
  alertname || ' on ' || instance AS summary, '' AS description,
  sha256('{"alertname":"' || alertname || '","instance":"' || instance || '","job":"' || job
         || '","severity":"' || severity || '"}') AS fingerprint,
  event_type AS ann_top_app,
  ' ' || CAST(event_id % 3000 AS VARCHAR) || ' ' AS ann_swap_used_mb,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE props END AS ann_reason_text,
  value
FROM (""" + _SIGNALS_SQL + """) s0
"""

# --------------------------------------------------------------------------------------------
# tasks <- events
# --------------------------------------------------------------------------------------------

TASK_TYPES = ("action", "chain", "notify", "mac_action")


def tasks(spark: SparkSession, sf_dir: str, created_range: tuple[str, str] | None = None) -> DataFrame:
    return tasks_from(read_table(spark, sf_dir, "events", time_range("ts", created_range)))


def tasks_from(events: DataFrame) -> DataFrame:
    ev = events.select("event_id", "ts", "user_id", "value")
    status = _cases(F.col("event_id") % 7, [(0, "pending"), (1, "running"), (2, "failed"), (3, "skipped")], "success")
    task_type = _cases(F.col("event_id") % 4, [(0, "action"), (1, "chain"), (2, "notify")], "mac_action")
    action = F.when(F.col("user_id") % 2 == 0, F.lit("soft_quit")).otherwise(F.lit("soft_quit_allowlisted_candidate"))
    instance = F.concat(F.lit("host-"), (F.col("user_id") % 8).cast("string"))
    base = ev.select(
        F.col("event_id").alias("id"),
        F.col("event_id").alias("decision_id"),
        task_type.alias("task_type"),
        F.concat(F.lit('{"action":"'), action, F.lit('","instance":"'), instance, F.lit('"}')).alias("payload"),
        F.when(F.col("value") >= 70, F.lit(100)).when(F.col("value") >= 15, F.lit(70)).otherwise(F.lit(50)).alias("priority"),
        status.alias("status"),
        _ts("ts").alias("created_at"),
        action.alias("_action"),
        instance.alias("_instance"),
        F.col("user_id"),
    )
    started = F.when(F.col("status") == "pending", F.lit(None)).otherwise(F.col("created_at") + F.expr("INTERVAL 1 MINUTE"))
    finished = F.when(F.col("status").isin("pending", "running"), F.lit(None)).otherwise(
        F.col("created_at") + F.expr("INTERVAL 5 MINUTES"))
    run_id = (F.col("id") * 10).cast("string")
    result = (
        F.when(F.col("status").isin("pending", "running"), F.lit(None))
        .when(F.col("task_type") == "mac_action", F.concat(
            F.lit('{"action":"'), F.col("_action"), F.lit('","rss_mb":'), (F.col("user_id") % 5000).cast("string"),
            F.lit(',"status":"'), F.col("status"), F.lit('","target":"'), F.col("_instance"), F.lit('"}')))
        .when(F.col("task_type") == "chain", F.concat(
            F.lit('{"first_run_id":'), run_id, F.lit(',"last_run_id":'), (F.col("id") * 10 + 1).cast("string"),
            F.lit(',"run_ids":['), run_id, F.lit(","), (F.col("id") * 10 + 1).cast("string"),
            F.lit('],"status":"'), F.col("status"), F.lit('"}')))
        .otherwise(F.concat(F.lit('{"run_id":'), run_id, F.lit(',"status":"'), F.col("status"), F.lit('"}')))
    )
    return base.select(
        "id", "decision_id", "task_type", "payload", "priority", "status", "created_at",
        started.alias("started_at"), finished.alias("finished_at"), result.alias("result_json"),
        F.when(F.col("status") == "failed", F.lit("exit status 1")).alias("error"),
    )


_TASKS_SQL = """
SELECT id, decision_id, task_type, payload, priority, status, created_at, started_at, finished_at,
  CASE WHEN status IN ('pending','running') THEN NULL
       WHEN task_type = 'mac_action' THEN '{"action":"' || _action || '","rss_mb":' || CAST(user_id % 5000 AS VARCHAR)
            || ',"status":"' || status || '","target":"' || _instance || '"}'
       WHEN task_type = 'chain' THEN '{"first_run_id":' || CAST(id * 10 AS VARCHAR) || ',"last_run_id":'
            || CAST(id * 10 + 1 AS VARCHAR) || ',"run_ids":[' || CAST(id * 10 AS VARCHAR) || ','
            || CAST(id * 10 + 1 AS VARCHAR) || '],"status":"' || status || '"}'
       ELSE '{"run_id":' || CAST(id * 10 AS VARCHAR) || ',"status":"' || status || '"}' END AS result_json,
  CASE WHEN status = 'failed' THEN 'exit status 1' END AS error
FROM (
  SELECT id, decision_id, task_type, payload, priority, status, created_at, _action, _instance, user_id,
    CASE WHEN status = 'pending' THEN NULL ELSE created_at + INTERVAL 1 MINUTE END AS started_at,
    CASE WHEN status IN ('pending','running') THEN NULL ELSE created_at + INTERVAL 5 MINUTE END AS finished_at
  FROM (
    SELECT event_id AS id, event_id AS decision_id,
      CASE event_id % 4 WHEN 0 THEN 'action' WHEN 1 THEN 'chain' WHEN 2 THEN 'notify' ELSE 'mac_action' END AS task_type,
      '{"action":"' || (CASE WHEN user_id % 2 = 0 THEN 'soft_quit' ELSE 'soft_quit_allowlisted_candidate' END)
        || '","instance":"host-' || CAST(user_id % 8 AS VARCHAR) || '"}' AS payload,
      CASE WHEN value >= 70 THEN 100 WHEN value >= 15 THEN 70 ELSE 50 END AS priority,
      CASE event_id % 7 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' WHEN 3 THEN 'skipped'
           ELSE 'success' END AS status,
      ts AS created_at,
      CASE WHEN user_id % 2 = 0 THEN 'soft_quit' ELSE 'soft_quit_allowlisted_candidate' END AS _action,
      'host-' || CAST(user_id % 8 AS VARCHAR) AS _instance, user_id
    FROM events) t0) t1
"""

# --------------------------------------------------------------------------------------------
# runs <- orders
# --------------------------------------------------------------------------------------------

RUN_ACTION_BY_PRIORITY = [
    ("1-URGENT", "run_backup"),
    ("2-HIGH", "analyze_vps_host_audit"),
    ("3-MEDIUM", "analyze_admin_host_audit"),
    ("4-NOT SPECIFIED", "analyze_monitoring_stack_audit"),
]
RUN_SUMMARIES = [
    (0, ""),
    (1, "warning:3 upgradable packages"),
    (2, "warning:root disk used 87%"),
    (3, "critical:docker daemon unreachable; warning:reboot required"),
    (4, "warning:infra-backups path missing; warning:9 upgradable packages"),
    (5, "ok:no findings"),
]
RUN_SOURCES = [(0, "admin_host_audit"), (1, "vps_host_audit"), (2, "monitoring_stack_audit"), (3, "manual")]


def runs(spark: SparkSession, sf_dir: str, started_range: tuple[str, str] | None = None) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", time_range("o_orderdate", started_range)).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                                     "o_orderpriority")
    m6 = F.col("o_custkey") % 6
    summary = _cases(m6, RUN_SUMMARIES, "")
    level = _cases(m6, [(0, ""), (3, "critical"), (5, "ok")], "warning")
    source = _cases(F.col("o_custkey") % 4, RUN_SOURCES, "manual")
    status = _cases(F.col("o_orderstatus"), [("O", "success"), ("F", "failed")], "running")
    hours = _cases(F.col("o_custkey") % 3, [(0, 1), (1, 6)], 30)
    started = _ts("o_orderdate")
    finished = F.when(status == "running", F.lit(None)).otherwise(started + F.make_dt_interval(hours=hours))
    stdout = F.concat(
        F.lit("ok\nRESULT_JSON:{\"analysis_level\":\""), level, F.lit("\",\"analysis_summary\":\""), summary,
        F.lit("\",\"source\":\""), source, F.lit("\",\"markdown_path\":\"/b/"), F.col("o_orderkey").cast("string"),
        F.lit(".md\"}"),
    )
    return o.select(
        F.col("o_orderkey").alias("id"),
        _cases(F.col("o_orderpriority"), RUN_ACTION_BY_PRIORITY, "generate_ai_ops_brief").alias("action"),
        F.lit("task").alias("trigger_type"),
        status.alias("status"),
        started.alias("started_at"),
        finished.alias("finished_at"),
        F.when(status == "success", F.lit(0)).when(status == "failed", F.lit(1)).alias("exit_code"),
        stdout.alias("stdout"),
        F.lit("").alias("stderr"),
        F.when(status == "failed", F.lit("exit code 1")).alias("error"),
    )


_RUNS_SQL = """
SELECT id, action, trigger_type, status, started_at,
  CASE WHEN status = 'running' THEN NULL ELSE started_at + to_hours(hrs) END AS finished_at,
  CASE WHEN status = 'success' THEN 0 WHEN status = 'failed' THEN 1 END AS exit_code,
  'ok' || chr(10) || 'RESULT_JSON:{"analysis_level":"' || lvl || '","analysis_summary":"' || summ
    || '","source":"' || src || '","markdown_path":"/b/' || CAST(id AS VARCHAR) || '.md"}' AS stdout,
  '' AS stderr,
  CASE WHEN status = 'failed' THEN 'exit code 1' END AS error
FROM (
  SELECT o_orderkey AS id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'run_backup' WHEN '2-HIGH' THEN 'analyze_vps_host_audit'
      WHEN '3-MEDIUM' THEN 'analyze_admin_host_audit' WHEN '4-NOT SPECIFIED' THEN 'analyze_monitoring_stack_audit'
      ELSE 'generate_ai_ops_brief' END AS action,
    'task' AS trigger_type,
    CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'running' END AS status,
    o_orderdate AS started_at,
    CASE o_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 6 ELSE 30 END AS hrs,
    CASE o_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'warning:3 upgradable packages'
      WHEN 2 THEN 'warning:root disk used 87%'
      WHEN 3 THEN 'critical:docker daemon unreachable; warning:reboot required'
      WHEN 4 THEN 'warning:infra-backups path missing; warning:9 upgradable packages'
      WHEN 5 THEN 'ok:no findings' END AS summ,
    CASE o_custkey % 6 WHEN 0 THEN '' WHEN 3 THEN 'critical' WHEN 5 THEN 'ok' ELSE 'warning' END AS lvl,
    CASE o_custkey % 4 WHEN 0 THEN 'admin_host_audit' WHEN 1 THEN 'vps_host_audit'
      WHEN 2 THEN 'monitoring_stack_audit' ELSE 'manual' END AS src
  FROM orders) r0
"""

# --------------------------------------------------------------------------------------------
# kv_logs <- customer  (key=value audit logs, one text per log)
# --------------------------------------------------------------------------------------------
# Line spec, shared by the Spark builder and the DuckDB text. k = c_custkey.
#   ("lit", text)                      constant line
#   ("mod", key, m)                    key=<k % m>
#   ("flag", key, m, a, b)             key=a when k % m = 0 else b
#   ("fmt", key, m, div, fmt)          key=printf(fmt, (k % m) / div)
#   ("opt", m, spec)                   the line is absent when k % m = 0
KV_LINES = [
    ("lit", "=== audit ==="),
    ("mod", "root_used_percent", 101),
    ("raw_mod", " swap_used_mb = ", 3000),
    ("lit", ""),
    ("lit", "noise line"),
    ("flag", "docker_reachable", 17, "no", "yes"),
    ("lit", "reboot_required=no"),
    ("flag", "reboot_required", 5, "yes", "no"),
    ("flag", "unit_docker_service_active", 23, "failed", "active"),
    ("lit", "unit_prometheus_node_exporter_service_active=active"),
    ("flag", "unit_action_runner_service_active", 41, "inactive", "active"),
    ("opt", 3, ("lit", "unit_caddy_service_active=active")),
    ("flag", "unit_fail2ban_service_active", 7, "inactive", "active"),
    ("flag", "prometheus_probe", 19, "fail", "ok"),
    ("lit", "alertmanager_probe=ok"),
    ("lit", "grafana_probe=ok"),
    ("lit", "action_runner_probe=ok"),
    ("flag", "node_exporter_probe", 13, "timeout", "ok"),
    ("flag", "tg_relay_probe", 11, "fail", "ok"),
    ("mod", "root_inode_used_percent", 97),
    ("mod", "journal_p3_count", 150),
    ("mod", "docker_unhealthy_containers", 4),
    ("mod", "docker_restarting_containers", 3),
    ("mod", "docker_running_containers", 12),
    ("flag", "container_prometheus_exists", 29, "no", "yes"),
    ("flag", "container_prometheus_state", 13, "exited", "running"),
    ("flag", "container_prometheus_health", 11, "unhealthy", "healthy"),
    ("flag", "container_prometheus_status", 47, "inspect_failed", "ok"),
    ("lit", "container_alertmanager_exists=yes"),
    ("lit", "container_alertmanager_state=running"),
    ("flag", "container_alertmanager_health", 2, "none", "healthy"),
    ("lit", "container_grafana_exists=yes"),
    ("flag", "container_grafana_state", 31, "restarting", "running"),
    ("lit", "container_grafana_health=none"),
    ("opt", 53, ("lit", "container_loki_exists=yes")),
    ("lit", "container_loki_state=running"),
    ("lit", "container_tg_relay_exists=yes"),
    ("lit", "container_tg_relay_state=running"),
    ("flag", "container_tg_relay_health", 37, "starting", "healthy"),
    ("flag", "container_promtail_exists", 14, "no", "yes"),
    ("lit", "container_promtail_state=running"),
    ("flag", "container_demo_app_exists", 2, "no", "yes"),
    ("flag", "container_demo_app_state", 9, "exited", "running"),
    ("flag", "container_demo_app_health", 15, "unhealthy", "healthy"),
    ("flag", "ufw_status", 31, "unknown", "active"),
    ("flag", "ufw_default_incoming", 43, "allow", "deny"),
    ("lit", "ufw_rule_22_present=yes"),
    ("flag", "ufw_rule_80_present", 10, "no", "yes"),
    ("lit", "ufw_rule_443_present=yes"),
    ("flag", "tailscale_serve_status", 8, "error", "ok"),
    ("lit", "tailscale_serve_port_3000=yes"),
    ("lit", "tailscale_serve_port_3100=yes"),
    ("flag", "tailscale_serve_port_9080", 6, "no", "yes"),
    ("lit", "tailscale_serve_port_9090=yes"),
    ("lit", "tailscale_serve_port_9093=yes"),
    ("flag", "probe_prometheus_ready", 7, "FAIL", " ok "),
    ("lit", "probe_alertmanager_ready=ok"),
    ("lit", "probe_grafana_health=healthy"),
    ("lit", "probe_loki_ready=up"),
    ("lit", "probe_tg_relay_ready=true"),
    ("lit", "probe_promtail_ready=1"),
    ("flag", "probe_demo_app_health", 12, "down", "OK"),
    ("flag", "prometheus_query_api", 59, "error", "ok"),
    ("lit", "prometheus_target_nodes_vps_up=1"),
    ("mod", "prometheus_target_nodes_admin_up", 2),
    ("opt", 5, ("lit", "prometheus_target_action_runner_up=1")),
    ("lit", "prometheus_target_demo_app_up=1.0"),
    ("flag", "prometheus_required_targets_down", 2, "1", "0"),
    ("mod", "prometheus_total_targets_down", 3),
    ("fmt", "demo_app_5xx_rate", 5, 100.0, "%.4f"),
    ("fmt", "demo_app_p95_latency_seconds", 9, 10.0, "%.3f"),
    ("mod", "containers_restarting_total", 3),
]


def _kv_line_spark(spec, k: Column) -> Column:
    kind = spec[0]
    if kind == "lit":
        return F.lit(spec[1])
    if kind == "mod":
        return F.concat(F.lit(spec[1] + "="), (k % spec[2]).cast("string"))
    if kind == "raw_mod":
        return F.concat(F.lit(spec[1]), (k % spec[2]).cast("string"))
    if kind == "flag":
        return F.concat(F.lit(spec[1] + "="), F.when(k % spec[2] == 0, F.lit(spec[3])).otherwise(F.lit(spec[4])))
    if kind == "fmt":
        return F.concat(F.lit(spec[1] + "="), F.format_string(spec[4], (k % spec[2]) / F.lit(spec[3])))
    if kind == "opt":
        return F.when(k % spec[1] != 0, _kv_line_spark(spec[2], k))
    raise ValueError(kind)


def _sql_str(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _kv_line_sql(spec, k: str) -> str:
    kind = spec[0]
    if kind == "lit":
        return _sql_str(spec[1])
    if kind == "mod":
        return f"{_sql_str(spec[1] + '=')} || CAST({k} % {spec[2]} AS VARCHAR)"
    if kind == "raw_mod":
        return f"{_sql_str(spec[1])} || CAST({k} % {spec[2]} AS VARCHAR)"
    if kind == "flag":
        return (f"{_sql_str(spec[1] + '=')} || (CASE WHEN {k} % {spec[2]} = 0 THEN {_sql_str(spec[3])} "
                f"ELSE {_sql_str(spec[4])} END)")
    if kind == "fmt":
        return f"{_sql_str(spec[1] + '=')} || printf({_sql_str(spec[4])}, ({k} % {spec[2]}) / {spec[3]})"
    if kind == "opt":
        return f"(CASE WHEN {k} % {spec[1]} <> 0 THEN {_kv_line_sql(spec[2], k)} END)"
    raise ValueError(kind)


def kv_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spread(read_table(spark, sf_dir, "customer").select("c_custkey"))
    k = F.col("c_custkey")
    return c.select(
        k.alias("log_id"),
        F.concat(F.lit("host-"), (k % 50).cast("string")).alias("host"),
        (F.lit(1704067200) + k * 3600).cast("long").alias("mtime_unix"),
        cached_expr(("kv_logs_text",), lambda: F.concat_ws("\n", *[_kv_line_spark(sp, k) for sp in KV_LINES]))
        .alias("text"),
    )


_KV_LOGS_SQL = (
    "SELECT c_custkey AS log_id, 'host-' || CAST(c_custkey % 50 AS VARCHAR) AS host,\n"
    "  CAST(1704067200 + c_custkey * 3600 AS BIGINT) AS mtime_unix,\n  concat_ws(chr(10), "
    + ",\n    ".join(_kv_line_sql(sp, "c_custkey") for sp in KV_LINES)
    + ") AS text\nFROM customer\n"
)

# --------------------------------------------------------------------------------------------
# admin_logs <- customer  (sectioned audit text, plus the wrapped command output)
# --------------------------------------------------------------------------------------------
# Same line-spec idea as KV_LINES; ("sec", title) emits a "==== title ====" header.
ADMIN_LINES = [
    ("sec", "NETWORK CHECK"),
    ("flag", "ip_ping: ", 13, "FAIL", "OK"),
    ("flag", "dns_resolve: ", 17, "FAIL", "OK"),
    ("sec", "MEMORY + SWAP"),
    ("lit", "               total        used        free"),
    ("lit", "Mem:           7.6Gi       2.1Gi       3.2Gi"),
    ("swap",),
    ("sec", "BOOT STATE"),
    ("flag", "reboot_required: ", 5, "YES", "NO"),
    ("lit", "reboot_detected_recently: NO"),
    ("lit", "boot_time_unixtime: 1704000000"),
    ("mul", "uptime_seconds: ", 60),
    ("sec", "NETWORK + TAILSCALE"),
    ("lit", "  Enabled "),
    ("flag", "", 11, "inactive", "active"),
    ("sec", "SSH LISTEN"),
    ("flag", "ssh :22 ", 19, "not listening", "listening"),
    ("sec", "UFW SUMMARY"),
    ("lit", "Status: active"),
    ("sec", "WIFI WATCHDOG"),
    ("mod", "wifi_watchdog_events_journal_boot: ", 3),
    ("mod", "wifi_watchdog_events_dmesg_boot: ", 4),
    ("sec", "FAIL2BAN (status only)"),
    ("flag", "fail2ban ", 7, "inactive", "active"),
    ("sec", "DISK ROOT"),
    ("lit", "Filesystem      Size  Used Avail Use% Mounted on"),
    ("mod", "/dev/sda1        50G   20G   30G  ", 101, "% /"),
    ("sec", "INODES"),
    ("lit", "Filesystem      Inodes  IUsed  IFree IUse% Mounted on"),
    ("mod", "/dev/sda1      3276800 100000 3176800 ", 97, "% /"),
    ("sec", "SYSSTAT (summary)"),
    ("flag", "ENABLED=", 23, '"false"', '"true"'),
    ("sec", "JOURNAL P3+ (current boot)"),
    ("flag", "", 29, "systemd-journald.service: Watchdog timeout", "-- No entries --"),
    ("sec", "APT"),
    ("mod", "upgradable_packages: ", 12),
    ("sec", "SMB SERVICES"),
    ("lit", "enabled"),
    ("lit", "active"),
    ("flag", "smb ports ", 31, "not listening", "listening"),
    ("sec", "TIME MACHINE PATH"),
    ("flag", "timemachine_path_exists: ", 37, "NO", "YES"),
    ("flag", "timemachine_path_writable: ", 41, "NO", "YES"),
    ("sec", "TIME MACHINE FRESHNESS"),
    ("mul", "timemachine_age_seconds: ", 100),
    ("sec", "INFRA BACKUPS PATH"),
    ("flag", "infra_backups_path_exists: ", 43, "NO", "YES"),
    ("lit", "infra_backups_path_writable: YES"),
    ("sec", "INFRA BACKUPS FRESHNESS"),
    ("mul", "infra_backups_tar_age_seconds: ", 300),
    ("flag", "infra_backups_sha_age_seconds: ", 10, "-1", "600"),
    ("lit", "infra_backups_tar_count: 7"),
    ("flag", "infra_backups_sha_count: ", 47, "6", "7"),
    ("flag", "infra_backups_pairs_match: ", 47, "NO", "YES"),
    ("opt", 3, ("sec", "SMART HEALTH")),
    ("opt", 3, ("flag", "SMART overall-health self-assessment test result: ", 53, "FAILED", "PASSED")),
]


def _admin_line_spark(spec, k: Column) -> Column:
    kind = spec[0]
    if kind == "sec":
        return F.lit(f"==== {spec[1]} ====")
    if kind == "lit":
        return F.lit(spec[1])
    if kind == "flag":
        return F.concat(F.lit(spec[1]), F.when(k % spec[2] == 0, F.lit(spec[3])).otherwise(F.lit(spec[4])))
    if kind == "mod":
        tail = spec[3] if len(spec) > 3 else ""
        return F.concat(F.lit(spec[1]), (k % spec[2]).cast("string"), F.lit(tail))
    if kind == "mul":
        return F.concat(F.lit(spec[1]), (k * spec[2]).cast("string"))
    if kind == "swap":
        used = (F.when(k % 4 == 0, F.concat(((k % 9) * 100).cast("string"), F.lit("MiB")))
                .when(k % 4 == 1, F.concat((k % 3).cast("string"), F.lit(".5GiB")))
                .when(k % 4 == 2, F.concat((k % 700).cast("string"), F.lit("Mi")))
                .otherwise(F.concat((k % 2000).cast("string"), F.lit("kB"))))
        return F.concat(F.lit("Swap:          2.0Gi       "), used, F.lit("       1.5Gi"))
    if kind == "opt":
        return F.when(k % spec[1] != 0, _admin_line_spark(spec[2], k))
    raise ValueError(kind)


def _admin_line_sql(spec, k: str) -> str:
    kind = spec[0]
    if kind == "sec":
        return _sql_str(f"==== {spec[1]} ====")
    if kind == "lit":
        return _sql_str(spec[1])
    if kind == "flag":
        return (f"{_sql_str(spec[1])} || (CASE WHEN {k} % {spec[2]} = 0 THEN {_sql_str(spec[3])} "
                f"ELSE {_sql_str(spec[4])} END)")
    if kind == "mod":
        tail = spec[3] if len(spec) > 3 else ""
        return f"{_sql_str(spec[1])} || CAST({k} % {spec[2]} AS VARCHAR) || {_sql_str(tail)}"
    if kind == "mul":
        return f"{_sql_str(spec[1])} || CAST({k} * {spec[2]} AS VARCHAR)"
    if kind == "swap":
        return ("'Swap:          2.0Gi       ' || (CASE "
                f"WHEN {k} % 4 = 0 THEN CAST(({k} % 9) * 100 AS VARCHAR) || 'MiB' "
                f"WHEN {k} % 4 = 1 THEN CAST({k} % 3 AS VARCHAR) || '.5GiB' "
                f"WHEN {k} % 4 = 2 THEN CAST({k} % 700 AS VARCHAR) || 'Mi' "
                f"ELSE CAST({k} % 2000 AS VARCHAR) || 'kB' END) || '       1.5Gi'")
    if kind == "opt":
        return f"(CASE WHEN {k} % {spec[1]} <> 0 THEN {_admin_line_sql(spec[2], k)} END)"
    raise ValueError(kind)


def admin_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spread(read_table(spark, sf_dir, "customer").select("c_custkey"))
    k = F.col("c_custkey")
    text = cached_expr(("admin_logs_text",),
                       lambda: F.concat_ws("\n", *[_admin_line_spark(sp, k) for sp in ADMIN_LINES]))
    path = F.concat(F.lit("/var/log/admin-host-audit/audit_"), k.cast("string"), F.lit(".log"))
    output = F.when(k % 10 == 0, F.concat(F.lit("LOG_PATH:"), path, F.lit("\n"), text)).otherwise(
        F.concat(F.lit("LOG_PATH:"), path, F.lit("\n__AUDIT_BODY_BEGIN__\n"), text))
    return c.select(k.alias("log_id"), F.lit("admin").alias("host"), text.alias("text"), output.alias("output"))


_ADMIN_TEXT_SQL = "concat_ws(chr(10), " + ",\n    ".join(_admin_line_sql(sp, "c_custkey") for sp in ADMIN_LINES) + ")"
_ADMIN_LOGS_SQL = (
    "SELECT log_id, host, text, CASE WHEN log_id % 10 = 0 THEN 'LOG_PATH:' || path || chr(10) || text "
    "ELSE 'LOG_PATH:' || path || chr(10) || '__AUDIT_BODY_BEGIN__' || chr(10) || text END AS output FROM (\n"
    "SELECT c_custkey AS log_id, 'admin' AS host, '/var/log/admin-host-audit/audit_' || CAST(c_custkey AS VARCHAR) "
    "|| '.log' AS path,\n  " + _ADMIN_TEXT_SQL + " AS text\nFROM customer) a0\n"
)

# --------------------------------------------------------------------------------------------
# snapshots <- part (Mac host snapshots)
# --------------------------------------------------------------------------------------------


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots_from(spread(read_table(spark, sf_dir, "part").select("p_partkey", "p_size")))


def snapshots_from(part: DataFrame) -> DataFrame:
    p = part.select("p_partkey", "p_size")
    k = F.col("p_partkey")
    unix = F.lit(1704067200) + k * 60
    return p.select(
        k.alias("snapshot_id"),
        F.concat(F.lit("host-"), (k % 40).cast("string")).alias("host"),
        unix.cast("long").alias("timestamp_unix"),
        F.date_format(F.timestamp_seconds(unix), "yyyy-MM-dd HH:mm:ss 'UTC'").alias("timestamp_utc"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("p_size")).cast("double").alias("memory_free_percent"),
        ((k % 9000) * 5).cast("double").alias("swap_used_mb"),
        (k % 25).cast("double").alias("uptime_days"),
        (k % 100).cast("double").alias("disk_used_percent"),
        (k % 101).cast("int").alias("battery_percent"),
        _cases(k % 3, [(0, "ac"), (1, "battery")], "unknown").alias("power_source"),
        F.when(k % 6 == 0, F.lit("")).otherwise(F.lit("/tm/2024-01-01-000000")).alias("tm_latest_backup"),
        (k % 45).cast("int").alias("brew_outdated_count"),
        F.when(k % 3 == 1, F.lit(True)).when(k % 3 == 2, F.lit(False)).alias("agent_launchd_loaded"),
    )


_SNAPSHOTS_SQL = """
SELECT p_partkey AS snapshot_id, 'host-' || CAST(p_partkey % 40 AS VARCHAR) AS host,
  CAST(1704067200 + p_partkey * 60 AS BIGINT) AS timestamp_unix,
  strftime(to_timestamp(1704067200 + p_partkey * 60) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S UTC') AS timestamp_utc,
  CAST(CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS DOUBLE) AS memory_free_percent,
  CAST((p_partkey % 9000) * 5 AS DOUBLE) AS swap_used_mb,
  CAST(p_partkey % 25 AS DOUBLE) AS uptime_days,
  CAST(p_partkey % 100 AS DOUBLE) AS disk_used_percent,
  CAST(p_partkey % 101 AS INTEGER) AS battery_percent,
  CASE p_partkey % 3 WHEN 0 THEN 'ac' WHEN 1 THEN 'battery' ELSE 'unknown' END AS power_source,
  CASE WHEN p_partkey % 6 = 0 THEN '' ELSE '/tm/2024-01-01-000000' END AS tm_latest_backup,
  CAST(p_partkey % 45 AS INTEGER) AS brew_outdated_count,
  CASE p_partkey % 3 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS agent_launchd_loaded
FROM part
"""

# --------------------------------------------------------------------------------------------
# samples <- events (metric samples)
# --------------------------------------------------------------------------------------------

LATENCY_BUCKETS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5)  # plus +Inf


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        F.col("event_id").alias("sample_id"),
        _ts("ts").alias("ts"),
        F.concat(F.lit("host-"), (F.col("user_id") % 8).cast("string")).alias("instance"),
        F.col("event_type").alias("service"),
        F.when(F.col("event_id") % 13 == 0, F.lit(0.0)).otherwise(F.lit(1.0)).alias("up_value"),
        (F.col("event_id") % 500).cast("double").alias("counter_value"),
        (F.col("value") / 1000.0).alias("latency_seconds"),
    )


_SAMPLES_SQL = """
SELECT event_id AS sample_id, ts, 'host-' || CAST(user_id % 8 AS VARCHAR) AS instance, event_type AS service,
  CAST(CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS up_value,
  CAST(event_id % 500 AS DOUBLE) AS counter_value,
  value / 1000.0 AS latency_seconds
FROM events
"""

# FIXED VALUES - labels and shares of the labelled samples' values: jobs, status codes, upper bounds with their shares.
SAMPLE_JOBS = ["nodes", "action-runner", "demo-app", "alertmanager"]
SAMPLE_STATUS = ["200", "404", "500", "503"]
SAMPLE_LES = [("0.1", 20), ("0.25", 50), ("0.5", 70), ("1", 90), ("2.5", 95), ("+Inf", 100)]


def labelled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, sample_id, name, labels, value): up, a request counter and latency buckets per event. Counters restart; one
    instance has no 0.5 bucket."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    k, u = F.col("event_id"), F.col("user_id")
    labels = lambda **x: F.map_filter(F.create_map(*[c for n, v in x.items() for c in (F.lit(n), v)]), lambda _, v: v.isNotNull())
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
    host = lambda n: F.concat(F.lit("host-"), (u % n).cast("string"))
    service = F.when(u % 3 < 2, F.lit("demo-app")).otherwise(F.lit("relay"))
    node = F.when(k % 4 == 0, F.when(u % 2 == 0, F.lit("vps")).otherwise(F.lit("admin")))
    sample = lambda name, tags, value: F.struct(F.lit(name).alias("name"), tags.alias("labels"), value.cast("double").alias("value"))
    up = sample("up", labels(job=pick(SAMPLE_JOBS, k % 4), node=node, instance=host(3)), F.when(k % 13 == 0, 0).otherwise(1))
    requests = sample("http_requests_total", labels(service=service, status=pick(SAMPLE_STATUS, k % 4), instance=host(2)), k * 3 % 2000)
    buckets = [F.when(F.lit(le != "0.5") | (u % 4 != 3),
                      sample("http_request_duration_seconds_bucket", labels(service=service, le=F.lit(le), instance=host(4)), F.floor(k % 900 * share / 100)))
               for le, share in SAMPLE_LES]
    all_of = F.filter(F.array(up, requests, *buckets), lambda x: x.isNotNull())
    return ev.select(_ts("ts").alias("ts"), k.alias("sample_id"), F.explode(all_of).alias("x")).select("ts", "sample_id", "x.*")


_LABELLED_SQL = f"""
SELECT ts, event_id AS sample_id, 'up' AS name,
  CASE WHEN event_id % 4 = 0 THEN MAP {{'job': 'nodes', 'node': CASE WHEN user_id % 2 = 0 THEN 'vps' ELSE 'admin' END, 'instance': 'host-' || CAST(user_id % 3 AS VARCHAR)}}
    ELSE MAP {{'job': {SAMPLE_JOBS}[event_id % 4 + 1], 'instance': 'host-' || CAST(user_id % 3 AS VARCHAR)}} END AS labels,
  CAST(CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS value FROM events
UNION ALL SELECT ts, event_id, 'http_requests_total', MAP {{'service': CASE WHEN user_id % 3 < 2 THEN 'demo-app' ELSE 'relay' END,
    'status': {SAMPLE_STATUS}[event_id % 4 + 1], 'instance': 'host-' || CAST(user_id % 2 AS VARCHAR)}}, CAST(event_id * 3 % 2000 AS DOUBLE) FROM events
UNION ALL SELECT ts, event_id, 'http_request_duration_seconds_bucket', MAP {{'service': CASE WHEN user_id % 3 < 2 THEN 'demo-app' ELSE 'relay' END,
    'le': b.le, 'instance': 'host-' || CAST(user_id % 4 AS VARCHAR)}}, CAST(floor(event_id % 900 * b.share / 100) AS DOUBLE)
  FROM events CROSS JOIN (VALUES {", ".join(str(x) for x in SAMPLE_LES)}) b(le, share) WHERE b.le <> '0.5' OR user_id % 4 <> 3
"""

# --------------------------------------------------------------------------------------------
# files <- supplier (backup archive inventory)
# --------------------------------------------------------------------------------------------


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("vps-backup-"), k.cast("string"),
                 F.when(k % 2 == 0, F.lit(".tar.gz")).otherwise(F.lit(".tar.gz.sha256"))).alias("name"),
        F.concat(F.lit("host-"), (F.col("s_nationkey") % 5).cast("string")).alias("host"),
        (F.lit(1704067200) + k * 86400).cast("long").alias("mtime_unix"),
    )


_FILES_SQL = """
SELECT 'vps-backup-' || CAST(s_suppkey AS VARCHAR) || (CASE WHEN s_suppkey % 2 = 0 THEN '.tar.gz' ELSE '.tar.gz.sha256' END)
    AS name,
  'host-' || CAST(s_nationkey % 5 AS VARCHAR) AS host,
  CAST(1704067200 + s_suppkey * 86400 AS BIGINT) AS mtime_unix
FROM supplier
"""

# --------------------------------------------------------------------------------------------
# processes <- orders
# --------------------------------------------------------------------------------------------

PROCESS_COMMANDS = [
    ("1-URGENT", "/Applications/Safari.app/Contents/MacOS/Safari"),
    ("2-HIGH", "/Applications/Obsidian.app/x"),
    ("3-MEDIUM", "/usr/libexec/WindowServer"),
    ("4-NOT SPECIFIED", "/opt/tool/some_long_process_name_over_forty_characters_x"),
]


def processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return o.select(
        F.concat(F.lit("host-"), (F.col("o_custkey") % 20).cast("string")).alias("host"),
        F.col("o_orderkey").alias("pid"),
        (F.col("o_custkey") * 1000 + F.col("o_orderkey") % 997).alias("rss_kb"),
        _cases(F.col("o_orderpriority"), PROCESS_COMMANDS, "").alias("command"),
    )


_PROCESSES_SQL = """
SELECT 'host-' || CAST(o_custkey % 20 AS VARCHAR) AS host, o_orderkey AS pid,
  o_custkey * 1000 + o_orderkey % 997 AS rss_kb,
  CASE o_orderpriority WHEN '1-URGENT' THEN '/Applications/Safari.app/Contents/MacOS/Safari'
    WHEN '2-HIGH' THEN '/Applications/Obsidian.app/x' WHEN '3-MEDIUM' THEN '/usr/libexec/WindowServer'
    WHEN '4-NOT SPECIFIED' THEN '/opt/tool/some_long_process_name_over_forty_characters_x' ELSE '' END AS command
FROM orders
"""

# --------------------------------------------------------------------------------------------
# running apps <- orders (names as the desktop shows them)
# --------------------------------------------------------------------------------------------

APP_NAMES = ["Safari", "Obsidian", "iTerm2", "  Visual   Studio Code ", "ChatGPT", "", "Mail"]


def running_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    names = F.array(*[F.lit(x) for x in APP_NAMES])
    return o.select(
        F.concat(F.lit("host-"), (F.col("o_custkey") % 20).cast("string")).alias("host"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(0)).otherwise(F.col("o_orderkey")).alias("pid"),
        F.element_at(names, (F.col("o_orderkey") % 7 + 1).cast("int")).alias("name"),
    )


_RUNNING_APPS_SQL = """
SELECT 'host-' || CAST(o_custkey % 20 AS VARCHAR) AS host, CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE o_orderkey END AS pid,
  ['Safari', 'Obsidian', 'iTerm2', '  Visual   Studio Code ', 'ChatGPT', '', 'Mail'][o_orderkey % 7 + 1] AS name
FROM orders
"""

# --------------------------------------------------------------------------------------------
# agent_log <- events
# --------------------------------------------------------------------------------------------


def agent_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    event = _cases(F.col("event_type"), [("error", "remediation_failed"), ("click", "candidate_selected"),
                                          ("view", "worker_task_received")], "report_cycle_end")
    line = F.concat(
        F.lit("[2024-01-01 00:00:"), F.lpad((F.col("event_id") % 60).cast("string"), 2, "0"), F.lit(" UTC] level="),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")),
        F.lit(" event="), event, F.lit(" task_id="), F.col("event_id").cast("string"),
        F.lit(' reason="two words" error=null'),
    )
    return ev.select(F.col("event_id").alias("line_no"), line.alias("line"))


_AGENT_LOG_SQL = """
SELECT event_id AS line_no,
  '[2024-01-01 00:00:' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || ' UTC] level='
  || (CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END) || ' event='
  || (CASE event_type WHEN 'error' THEN 'remediation_failed' WHEN 'click' THEN 'candidate_selected'
        WHEN 'view' THEN 'worker_task_received' ELSE 'report_cycle_end' END)
  || ' task_id=' || CAST(event_id AS VARCHAR) || ' reason="two words" error=null' AS line
FROM events
"""

# --------------------------------------------------------------------------------------------
# inspect <- supplier (container inspect output), collector <- part, responses <- orders
# --------------------------------------------------------------------------------------------

INSPECT_RAW = [
    (0, '[{"State":{"Status":"running","Health":{"Status":"healthy"}},"Config":{"Image":"img:1"}}]'),
    (1, '[{"State":{"Status":"restarting"},"Config":{}}]'),
    (2, "[]"),
]


def inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    return s.select(
        F.col("s_suppkey").alias("inspect_id"),
        F.concat(F.lit("c"), (F.col("s_suppkey") % 7).cast("string")).alias("container"),
        _cases(F.col("s_suppkey") % 4, INSPECT_RAW, "not json").alias("raw"),
    )


_INSPECT_SQL = """
SELECT s_suppkey AS inspect_id, 'c' || CAST(s_suppkey % 7 AS VARCHAR) AS container,
  CASE s_suppkey % 4
    WHEN 0 THEN '[{"State":{"Status":"running","Health":{"Status":"healthy"}},"Config":{"Image":"img:1"}}]'
    WHEN 1 THEN '[{"State":{"Status":"restarting"},"Config":{}}]'
    WHEN 2 THEN '[]' ELSE 'not json' END AS raw
FROM supplier
"""


def collector(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey")
    return p.select(
        k.alias("sample_id"),
        F.concat(F.lit("System-wide memory free percentage: "), (k % 101).cast("string"), F.lit("%")).alias("memory_text"),
        F.concat(F.lit("total = 9.00G  used = "), (k % 8).cast("string"), F.lit(".50"),
                 F.when(k % 2 == 0, F.lit("G")).otherwise(F.lit("M"))).alias("swap_text"),
        F.concat(F.lit("up "), F.when(k % 3 == 0, F.lit("")).otherwise(F.concat((k % 30).cast("string"), F.lit(" days, "))),
                 F.lit("3:15, 2 users")).alias("uptime_text"),
        F.when(k % 9 == 0, F.lit("Filesystem")).otherwise(F.concat(
            F.lit("Filesystem Size Used Avail Capacity Mounted\n/dev/d1  460Gi 10Gi 100Gi "),
            F.when(k % 9 == 1, F.lit("x%")).otherwise(F.concat((k % 100).cast("string"), F.lit("%"))), F.lit(" /"))).alias("disk_text"),
        _cases(k % 4, [(0, "Now drawing from 'AC Power'\n -Battery 93%; charged"), (1, "Now drawing from 'Battery Power'\n -Battery 41%; discharging"),
                       (2, "no report\n'AC Power'")], "").alias("battery_text"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.lit("/opt/bin/brew")).alias("installed_text"),
        _cases(k % 3, [(0, "git\n\n  \nnode\n"), (1, "wget")], "").alias("outdated_text"),
        _cases(k % 4, [(0, " /Volumes/tm/2024-01-31-235959.backup\n"), (1, "/Volumes/tm/2024-13-31-235959.backup"), (2, "/Volumes/tm/latest")], "").alias("backup_text"),
        _cases(k % 5, [(0, "PID\tStatus\tLabel\n71\t0\tmemory-worker\n-\t0\tmemory-report"), (1, "-\t0\tmemory-worker\n-\t0\tmemory-report\n9\t0\tother"),
                       (2, "5 0 memory-worker"), (3, "short line")], "").alias("launchd_text"),
    )


_COLLECTOR_SQL = """
SELECT p_partkey AS sample_id,
  'System-wide memory free percentage: ' || CAST(p_partkey % 101 AS VARCHAR) || '%' AS memory_text,
  'total = 9.00G  used = ' || CAST(p_partkey % 8 AS VARCHAR) || '.50' || (CASE WHEN p_partkey % 2 = 0 THEN 'G' ELSE 'M' END)
    AS swap_text,
  'up ' || (CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_partkey % 30 AS VARCHAR) || ' days, ' END) || '3:15, 2 users'
    AS uptime_text,
  CASE WHEN p_partkey % 9 = 0 THEN 'Filesystem' ELSE 'Filesystem Size Used Avail Capacity Mounted' || chr(10) || '/dev/d1  460Gi 10Gi 100Gi '
    || CASE WHEN p_partkey % 9 = 1 THEN 'x%' ELSE CAST(p_partkey % 100 AS VARCHAR) || '%' END || ' /' END AS disk_text,
  p_partkey % 4 AS battery_kind, p_partkey % 5 AS installed_kind, p_partkey % 3 AS outdated_kind, p_partkey % 4 AS backup_kind, p_partkey % 5 AS launchd_kind
FROM part
"""

RESPONSE_RAW = [
    (0, '{"output_text":" {} "}'),
    (1, '{"output":[{"content":[{"text":"a"},{"text":" "}]},{"content":[{"text":"b"}]}]}'),
    (2, '{"output":5}'),
]
REVIEW_RAW = [
    (0, '{"brief_status":"watch","executive_summary":"disk filling","operator_note":"check tomorrow",'
        '"recommended_actions":[],"top_risks":[]}'),
    (1, '{"brief_status":"odd"}'),
]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.select(
        F.col("o_orderkey").alias("response_id"),
        _cases(F.col("o_custkey") % 4, RESPONSE_RAW, "bad").alias("response"),
        _cases(F.col("o_custkey") % 3, REVIEW_RAW, '{"extra":1}').alias("review"),
    )


_RESPONSES_SQL = """
SELECT o_orderkey AS response_id,
  CASE o_custkey % 4 WHEN 0 THEN '{"output_text":" {} "}'
    WHEN 1 THEN '{"output":[{"content":[{"text":"a"},{"text":" "}]},{"content":[{"text":"b"}]}]}'
    WHEN 2 THEN '{"output":5}' ELSE 'bad' END AS response,
  CASE o_custkey % 3
    WHEN 0 THEN '{"brief_status":"watch","executive_summary":"disk filling","operator_note":"check tomorrow","recommended_actions":[],"top_risks":[]}'
    WHEN 1 THEN '{"brief_status":"odd"}' ELSE '{"extra":1}' END AS review
FROM orders
"""

# DuckDB text of every projection, for the oracle queries.
ORACLE_CTES = {
    "sig0": _SIGNALS_SQL,
    "signals": _SIGNALS_FULL_SQL,
    "tasks": _TASKS_SQL,
    "runs": _RUNS_SQL,
    "kv_logs": _KV_LOGS_SQL,
    "admin_logs": _ADMIN_LOGS_SQL,
    "snapshots": _SNAPSHOTS_SQL,
    "samples": _SAMPLES_SQL,
    "labelled": _LABELLED_SQL,
    "files": _FILES_SQL,
    "processes": _PROCESSES_SQL,
    "running_apps": _RUNNING_APPS_SQL,
    "agent_log": _AGENT_LOG_SQL,
    "inspect": _INSPECT_SQL,
    "collector": _COLLECTOR_SQL,
    "responses": _RESPONSES_SQL,
}


def with_ctes(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the DuckDB projections it uses (in dependency order)."""
    parts = [f"{n} AS ({ORACLE_CTES[n]})" for n in names]
    body = sql.strip()
    head = "WITH "
    if body.upper().startswith("WITH RECURSIVE "):
        head, body = "WITH RECURSIVE ", body[len("WITH RECURSIVE "):]
        return head + ",\n".join(parts) + ",\n" + body
    if body.upper().startswith("WITH "):
        return head + ",\n".join(parts) + ",\n" + body[5:]
    return head + ",\n".join(parts) + "\n" + body
