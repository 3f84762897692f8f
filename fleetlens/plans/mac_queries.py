"""Mac snapshot and process queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.text import normalize_app_name
from fleetlens.operators import mac as MAC
from fleetlens.plans.audit_queries import exposition_sql, lines_of
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

# FIXED VALUES - report time point for snapshots (FIXTURES.md section 4) and the freshness limit.
AS_OF_UNIX = 1706659200  # 2024-01-31 00:00:00 UTC
MAX_AGE_SECONDS = 1800


def _app_sql(cmd: str) -> str:
    """DuckDB text of the app-name normalisation."""
    c = f"trim(coalesce({cmd}, ''))"
    whens = " ".join(f"WHEN contains({c}, '{n}') THEN '{a}'" for n, a in
                     __import__("fleetlens.functions.text", fromlist=["x"]).APP_NAME_PATTERNS)
    last = f"string_split({c}, '/')[-1]"
    return (f"(CASE {whens} WHEN {last} <> '' THEN left({last}, 40) WHEN {c} <> '' THEN left({c}, 40) "
            f"ELSE 'unknown' END)")


def _r0(x: str) -> str:
    return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"


_MAC_CHECKS = [
    ("memory_free_percent < 5", "critical", "memory_pressure", f"'memory free ' || {_r0('memory_free_percent')} || '%'"),
    ("memory_free_percent >= 5 AND memory_free_percent < 10", "warning", "memory_pressure",
     f"'memory free ' || {_r0('memory_free_percent')} || '%'"),
    ("swap_used_mb >= 8192", "critical", "swap_high", f"'swap used ' || {_r0('swap_used_mb')} || 'MB'"),
    ("swap_used_mb < 8192 AND swap_used_mb >= 4096", "warning", "swap_high",
     f"'swap used ' || {_r0('swap_used_mb')} || 'MB'"),
    ("CAST(trunc(disk_used_percent) AS BIGINT) >= 92", "critical", "disk_high",
     "'root disk used ' || CAST(CAST(trunc(disk_used_percent) AS BIGINT) AS VARCHAR) || '%'"),
    ("CAST(trunc(disk_used_percent) AS BIGINT) < 92 AND CAST(trunc(disk_used_percent) AS BIGINT) >= 85", "warning",
     "disk_high", "'root disk used ' || CAST(CAST(trunc(disk_used_percent) AS BIGINT) AS VARCHAR) || '%'"),
    ("coalesce(nullif(power_source, ''), 'unknown') = 'battery' AND battery_percent <= 10", "critical", "battery_low",
     "'battery ' || CAST(battery_percent AS VARCHAR) || '% on battery power'"),
    ("coalesce(nullif(power_source, ''), 'unknown') = 'battery' AND battery_percent > 10 AND battery_percent <= 20",
     "warning", "battery_low", "'battery ' || CAST(battery_percent AS VARCHAR) || '% on battery power'"),
    ("brew_outdated_count >= 30", "warning", "brew_outdated",
     "CAST(brew_outdated_count AS VARCHAR) || ' outdated brew packages'"),
    ("agent_launchd_loaded = false", "warning", "agent_launchd_missing", "'mac memory guard launchd jobs not loaded'"),
    ("trim(coalesce(tm_latest_backup, '')) = ''", "warning", "timemachine_unknown",
     "'time machine latest backup unavailable'"),
]

MAC_FINDINGS_SQL = """
mf0 AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT snapshot_id, host, {i} AS ord, '{sev}' AS severity, '{kind}' AS kind, {msg} AS message "
    f"FROM snapshots WHERE coalesce({cond}, false)" for i, (cond, sev, kind, msg) in enumerate(_MAC_CHECKS)) + """
),
mf AS (SELECT snapshot_id, host, CAST(row_number() OVER (PARTITION BY snapshot_id ORDER BY ord) - 1 AS INTEGER) AS pos,
       severity, kind, message FROM mf0)
"""


@query("mac_findings", f"WITH {MAC_FINDINGS_SQL} SELECT * FROM mf", ctes=("snapshots",))
def q_mac_findings(spark, sf_dir):
    a = MAC.analyze_snapshots(fx.snapshots(spark, sf_dir))
    rows = F.transform("findings", lambda x, i: F.struct(i.alias("pos"), x["severity"].alias("severity"),
                                                         x["kind"].alias("kind"), x["message"].alias("message")))
    return a.select("snapshot_id", "host", F.inline(rows))


@query("mac_levels", f"""WITH {MAC_FINDINGS_SQL}
SELECT s.snapshot_id, s.host,
  CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 'critical'
       WHEN count(f.pos) > 0 THEN 'warning' ELSE 'ok' END AS level,
  count(f.pos) AS findings_count,
  coalesce(string_agg(f.severity || ':' || f.message, '; ' ORDER BY f.pos), 'ok:no findings') AS summary
FROM snapshots s LEFT JOIN mf f ON f.snapshot_id = s.snapshot_id GROUP BY s.snapshot_id, s.host
""", ctes=("snapshots",))
def q_mac_levels(spark, sf_dir):
    return MAC.analyze_snapshots(fx.snapshots(spark, sf_dir)).select("snapshot_id", "host", "level",
                                                                      "findings_count", "summary")


_TOP_SQL = ("""
topp AS (
  SELECT host, pid AS top_pid, rss_kb AS top_rss_kb, command AS top_command FROM processes
  QUALIFY row_number() OVER (PARTITION BY host ORDER BY rss_kb DESC, pid DESC) = 1
),
ev0 AS (
  SELECT s.*, t.top_rss_kb, t.top_command, t.top_rss_kb / 1024.0 AS rss FROM snapshots s LEFT JOIN topp t ON t.host = s.host
),
ev AS (
  SELECT *,
    CASE WHEN swap_used_mb >= 2400 OR uptime_days >= 20 OR rss >= 2400 OR disk_used_percent >= 92 THEN 'critical'
         WHEN swap_used_mb >= 1400 OR uptime_days >= 10 OR rss >= 1800 OR disk_used_percent >= 85 THEN 'warning'
         ELSE 'ok' END AS status,
    list_filter([
      CASE WHEN swap_used_mb >= 1400 THEN 'swap ' || """ + _r0("swap_used_mb") + """ || 'MB' END,
      CASE WHEN uptime_days >= 10 THEN 'uptime ' || printf('%.1f', uptime_days) || 'd' END,
      CASE WHEN rss >= 1800 THEN APP || ' ' || """ + _r0("rss") + """ || 'MB' END,
      CASE WHEN disk_used_percent >= 85 THEN 'disk ' || CAST(CAST(disk_used_percent AS BIGINT) AS VARCHAR) || '%' END,
      CASE WHEN swap_used_mb >= 2400 THEN 'critical swap ' || """ + _r0("swap_used_mb") + """ || 'MB' END,
      CASE WHEN uptime_days >= 20 THEN 'critical uptime ' || printf('%.1f', uptime_days) || 'd' END,
      CASE WHEN rss >= 2400 THEN 'critical ' || APP || ' ' || """ + _r0("rss") + """ || 'MB' END,
      CASE WHEN disk_used_percent >= 92 THEN 'critical disk ' || CAST(CAST(disk_used_percent AS BIGINT) AS VARCHAR)
           || '%' END], lambda x: x IS NOT NULL) AS reasons0
  FROM ev0
),
ev2 AS (
  SELECT *, CASE WHEN len(reasons0) = 0 THEN ['system within thresholds'] ELSE reasons0 END AS reasons,
    CASE WHEN status = 'ok' THEN 'none'
         WHEN coalesce(disk_used_percent >= 92, false) THEN 'free_disk_space'
         WHEN coalesce(disk_used_percent >= 85, false) THEN 'check_disk_usage'
         WHEN status = 'critical' THEN CASE
              WHEN coalesce(rss >= 2400, false) OR coalesce(memory_free_percent <= 12, false)
                   OR coalesce(swap_used_mb >= 2400, false) THEN 'soft_quit_top_candidate'
              WHEN coalesce(uptime_days >= 20, false) THEN 'reboot_if_persistent'
              ELSE 'soft_quit_top_candidate' END
         WHEN coalesce(rss >= 1800, false) OR coalesce(swap_used_mb >= 1024, false)
              OR coalesce(memory_free_percent <= 20, false) THEN 'observe_or_quit_top_app'
         WHEN coalesce(uptime_days >= 10, false) THEN 'observe_or_reboot_later'
         ELSE 'observe' END AS suggested_action
  FROM ev
)
""").replace("APP", _app_sql("top_command"))


def _evaluated(spark, sf_dir):
    snaps = fx.snapshots(spark, sf_dir)
    top = MAC.top_process(fx.processes(spark, sf_dir))
    return MAC.memory_evaluate(snaps.join(top, "host", "left"))


@query("memory_status", f"""WITH {_TOP_SQL}
SELECT snapshot_id, host, status, array_to_string(reasons, ' | ') AS reasons, suggested_action FROM ev2
""", ctes=("snapshots", "processes"))
def q_memory_status(spark, sf_dir):
    e = _evaluated(spark, sf_dir)
    return e.select("snapshot_id", "host", "status", F.array_join("reasons", " | ").alias("reasons"),
                    "suggested_action")


@query("agent_signals", f"""WITH {_TOP_SQL}
SELECT snapshot_id AS signal_id, 'agent' AS source, 'firing' AS status, 'MacMemoryPressure' AS alertname,
  status AS severity, host AS instance, 'mac-agent' AS job,
  host || ' memory pressure: top=' || (CASE WHEN top_rss_kb IS NULL THEN 'none' ELSE APP END)
    || ' rss=' || (CASE WHEN top_rss_kb IS NULL THEN 'n/a' ELSE {_r0('rss')} END)
    || 'MB swap=' || coalesce({_r0('swap_used_mb')}, 'n/a')
    || 'MB free=' || coalesce(printf('%.1f', memory_free_percent), 'n/a') || '%' AS summary,
  sha256('{{"alertname":"MacMemoryPressure","instance":"' || host || '","job":"mac-agent","severity":"'
         || status || '"}}') AS fingerprint,
  CASE WHEN len(reasons) > 0 THEN array_to_string(reasons, ', ') ELSE 'none' END AS reason_text, suggested_action,
  concat_ws(chr(10), 'status=' || status, 'reasons=' || CASE WHEN len(reasons) > 0 THEN array_to_string(reasons, ', ') ELSE 'none' END,
    'swap_used_mb=' || coalesce({_r0('swap_used_mb')}, 'n/a'), 'memory_free_percent=' || coalesce(printf('%.1f', memory_free_percent), 'n/a'),
    'uptime_days=' || coalesce(printf('%.1f', CAST(uptime_days AS DOUBLE)), 'n/a'), 'disk_used_percent=' || coalesce(CAST(disk_used_percent AS VARCHAR), 'n/a'),
    'top_app=' || (CASE WHEN top_rss_kb IS NULL THEN 'none' ELSE APP END),
    'top_rss_mb=' || (CASE WHEN top_rss_kb IS NULL THEN 'n/a' ELSE {_r0('rss')} END),
    'suggested_action=' || suggested_action, 'time=' || coalesce(timestamp_utc, '')) AS description, 11 AS n_annotations, 'mac-agent' AS label_job
FROM ev2 WHERE status IN ('warning', 'critical')
""".replace("APP", _app_sql("top_command")), ctes=("snapshots", "processes"))
def q_agent_signals(spark, sf_dir):
    a = MAC.agent_signals(_evaluated(spark, sf_dir))
    return a.select(*[c for c in a.columns if c not in ("labels", "annotations", "ts")], F.size("annotations").alias("n_annotations"),
                    F.col("labels")["job"].alias("label_job"))


@query("snapshot_latest", """
SELECT host, snapshot_id, timestamp_unix, timestamp_utc, memory_free_percent, disk_used_percent FROM snapshots
QUALIFY row_number() OVER (PARTITION BY host ORDER BY timestamp_unix DESC, snapshot_id DESC) = 1
""", ctes=("snapshots",))
def q_snapshot_latest(spark, sf_dir):
    return MAC.snapshot_latest(fx.snapshots(spark, sf_dir)).select(
        "host", "snapshot_id", "timestamp_unix", "timestamp_utc", "memory_free_percent", "disk_used_percent")


@query("stale_hosts", f"""
SELECT host, max(timestamp_unix) AS last_unix, {AS_OF_UNIX} - max(timestamp_unix) AS age_seconds,
  {AS_OF_UNIX} - max(timestamp_unix) > {MAX_AGE_SECONDS} AS stale
FROM snapshots GROUP BY host
""", ctes=("snapshots",))
def q_stale_hosts(spark, sf_dir):
    return MAC.stale_hosts(fx.snapshots(spark, sf_dir), AS_OF_UNIX, MAX_AGE_SECONDS)


@query("snapshot_store_names", """
SELECT snapshot_id, host, 'audit_' || coalesce(nullif(replace(replace(replace(replace(trim(timestamp_utc), ' UTC', ''),
  '-', ''), ':', ''), ' ', '_'), ''), 'unknown') AS file_stem FROM snapshots
""", ctes=("snapshots",))
def q_snapshot_store_names(spark, sf_dir):
    s = fx.snapshots(spark, sf_dir)
    return s.select("snapshot_id", "host", MAC.snapshot_stamp(F.col("timestamp_utc")).alias("file_stem"))


@query("top_processes", f"""
SELECT host, CAST(rank AS INTEGER) AS rank, pid, rss_kb, APP AS app FROM (
  SELECT *, row_number() OVER (PARTITION BY host ORDER BY rss_kb DESC, pid DESC) AS rank FROM processes) p
WHERE rank <= 5
""".replace("APP", _app_sql("command")), ctes=("processes",))
def q_top_processes(spark, sf_dir):
    return MAC.top_processes(fx.processes(spark, sf_dir), 5)


_CANDIDATES_SQL = """
cand AS (
  SELECT a.host, a.pid, a.name, p.rss_kb FROM (
    SELECT host, pid, regexp_replace(trim(coalesce(name, '')), '\\s+', ' ', 'g') AS name FROM running_apps) a
  JOIN processes p ON p.host = a.host AND p.pid = a.pid
  WHERE a.name <> '' AND a.pid > 0 AND a.name NOT IN ('ChatGPT', 'Obsidian', 'iTerm2') AND p.rss_kb IS NOT NULL)
"""


@query("process_pick", f"""WITH {_CANDIDATES_SQL}
SELECT host, name AS app, pid, round_even(rss_kb / 1024.0, 1) AS rss_mb FROM cand
QUALIFY row_number() OVER (PARTITION BY host ORDER BY rss_kb DESC, name DESC, pid DESC) = 1
""", ctes=("processes", "running_apps"))
def q_process_pick(spark, sf_dir):
    return MAC.process_pick(fx.running_apps(spark, sf_dir), fx.processes(spark, sf_dir))


@query("process_candidates", f"""WITH {_CANDIDATES_SQL} SELECT * FROM cand""", ctes=("processes", "running_apps"))
def q_process_candidates(spark, sf_dir):
    """J10 + F17: running apps that are not protected, with their rss."""
    return MAC.process_candidates(fx.running_apps(spark, sf_dir), fx.processes(spark, sf_dir))


@query("snapshot_json_roundtrip", """
SELECT host, timestamp_unix, memory_free_percent, swap_used_mb, power_source, agent_launchd_loaded FROM snapshots
""", ctes=("snapshots",))
def q_snapshot_json_roundtrip(spark, sf_dir):
    """S6 + K11: snapshots written as JSON documents to shared storage and read back with the fixed
    snapshot schema (no inference)."""
    import uuid

    from fleetlens.session import checkpoint_dir
    from fleetlens.sources.readers import read_snapshots

    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/snapshots-json-{uuid.uuid4().hex}"
    fx.snapshots(spark, sf_dir).drop("snapshot_id").write.json(path)
    back = read_snapshots(spark, path)
    return back.select("host", "timestamp_unix", "memory_free_percent", "swap_used_mb", "power_source",
                       "agent_launchd_loaded")


def _pyf(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'NaN' WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) || '.0' "
            f"ELSE CAST({x} AS VARCHAR) END")


_MAC_NUMS = [("mac_host_audit_last_run_unixtime", "timestamp_unix"),
             ("mac_host_audit_memory_free_percent", "memory_free_percent"),
             ("mac_host_audit_swap_used_mb", "swap_used_mb"), ("mac_host_audit_disk_used_percent", "disk_used_percent"),
             ("mac_host_audit_battery_percent", "battery_percent"),
             ("mac_host_audit_brew_outdated_count", "brew_outdated_count")]


_MAC_LEVELS_SQL = f"""WITH {MAC_FINDINGS_SQL},
lv AS (
  SELECT s.*, CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 'critical'
       WHEN count(f.pos) > 0 THEN 'warning' ELSE 'ok' END AS level, count(f.pos) AS n
  FROM snapshots s LEFT JOIN mf f ON f.snapshot_id = s.snapshot_id
  GROUP BY ALL
)
"""
_MAC_GAUGES_SQL = ("""SELECT snapshot_id, 'mac_host_audit_status' AS metric, 'host="' || host || '",level="' || level || '"' AS labels,
  CAST(CASE level WHEN 'ok' THEN 0 WHEN 'warning' THEN 1 WHEN 'critical' THEN 2 ELSE 3 END AS VARCHAR) AS value FROM lv
UNION ALL SELECT snapshot_id, 'mac_host_audit_findings_count', 'host="' || host || '"', CAST(n AS VARCHAR) FROM lv
""" + "".join(f"UNION ALL SELECT snapshot_id, '{m}', 'host=\"' || host || '\"', {_pyf(f'CAST({c} AS DOUBLE)')} FROM lv\n"
              for m, c in _MAC_NUMS) + """
UNION ALL SELECT snapshot_id, 'mac_host_audit_agent_launchd_loaded', 'host="' || host || '"',
  CASE WHEN agent_launchd_loaded THEN '1' ELSE '0' END FROM lv
UNION ALL SELECT snapshot_id, 'mac_host_audit_finding_present',
  'host="' || host || '",kind="' || kind || '",severity="' || severity || '"', '1' FROM mf
""")


@query("mac_gauges", _MAC_LEVELS_SQL + _MAC_GAUGES_SQL, ctes=("snapshots",))
def q_mac_gauges(spark, sf_dir):
    """Mac host audit gauges in long form."""
    return MAC.mac_gauges(fx.snapshots(spark, sf_dir))


@query("process_lines", """
SELECT host, pid, rss_kb, CAST(round(rss_kb / 163840.0, 1) AS DOUBLE) AS mem_percent, command
FROM processes WHERE command <> ''
""", ctes=("processes",))
def q_process_lines(spark, sf_dir):
    """``ps`` output lines (pid, rss, %mem, args) parsed back into rows; rows whose command is empty
    have fewer than four fields and are dropped, as the reference's parser does."""
    p = fx.processes(spark, sf_dir)
    mem = F.round(F.col("rss_kb") / F.lit(163840.0), 1)
    lines = p.select("host", F.concat_ws(" ", F.lit(" "), F.col("pid").cast("string"), F.col("rss_kb").cast("string"),
                                         mem.cast("string"), "command").alias("line"))
    return MAC.parse_process_lines(lines).select("host", "pid", "rss_kb", "mem_percent", "command")


_MEMORY_LEVELS_SQL = f"""WITH {_TOP_SQL}
"""
_MEMORY_GAUGES_SQL = ("""SELECT snapshot_id, 'mac_memory_status' AS metric, 'host="mba"' AS labels,
  CAST(CASE status WHEN 'ok' THEN 0 WHEN 'warning' THEN 1 WHEN 'critical' THEN 2 ELSE 3 END AS VARCHAR) AS value FROM ev2
""" + "".join(f"UNION ALL SELECT snapshot_id, '{m}', 'host=\"mba\"', {_pyf(f'CAST({c} AS DOUBLE)')} FROM ev2\n" for m, c in (
    ("mac_memory_free_percent", "memory_free_percent"), ("mac_swap_used_mb", "swap_used_mb"),
    ("mac_uptime_days", "uptime_days"), ("mac_disk_used_percent", "disk_used_percent"),
    ("mac_battery_percent", "battery_percent"))) + "".join(
    f"UNION ALL SELECT snapshot_id, 'mac_power_source', 'host=\"mba\",source=\"{s}\"', "
    f"CASE WHEN coalesce(power_source, 'unknown') = '{s}' THEN '1' ELSE '0' END FROM ev2\n" for s in ("ac", "battery", "unknown"))
    + """UNION ALL SELECT snapshot_id, 'mac_top_process_rss_mb',
  'host="mba",process="' || (CASE WHEN top_rss_kb IS NULL THEN 'none' ELSE APP END) || '"',
  printf('%.2f', coalesce(CAST(top_rss_kb AS DOUBLE) / 1024, 0)) FROM ev2
UNION ALL SELECT snapshot_id, 'mac_memory_last_run_unixtime', 'host="mba"', CAST(timestamp_unix AS VARCHAR) FROM ev2
""".replace("APP", _app_sql("top_command")))


@query("memory_gauges", _MEMORY_LEVELS_SQL + _MEMORY_GAUGES_SQL, ctes=("snapshots", "processes"))
def q_memory_gauges(spark, sf_dir):
    """D7 (memory guard) over evaluated snapshots."""
    return MAC.memory_gauges(_evaluated(spark, sf_dir))


@query("mac_exposition", _MAC_LEVELS_SQL + exposition_sql("snapshot_id", _MAC_GAUGES_SQL, MAC.MAC_HELP, "mac_host_audit_finding_present"), ctes=("snapshots",))
def q_mac_exposition(spark, sf_dir):
    """K5 (Mac host audit): the lines of every snapshot's text."""
    return lines_of(MAC.mac_exposition(fx.snapshots(spark, sf_dir)), "snapshot_id")


@query("memory_exposition", _MEMORY_LEVELS_SQL + exposition_sql("snapshot_id", _MEMORY_GAUGES_SQL, MAC.MEMORY_HELP), ctes=("snapshots", "processes"))
def q_memory_exposition(spark, sf_dir):
    """K5 (memory guard): the lines of every snapshot's text."""
    return lines_of(MAC.memory_exposition(_evaluated(spark, sf_dir)), "snapshot_id")
