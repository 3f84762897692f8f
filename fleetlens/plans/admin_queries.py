"""Admin host audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import admin as AD
from fleetlens.plans.audit_queries import exposition_sql, lines_of
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _sec(start: str, end: str = "") -> str:
    pat = "(?s)\\Q==== " + start + " ====\\E" + ("(.*?)\\Q==== " + end + " ====\\E" if end else "(.*)$")
    return _strip(f"regexp_extract(text, '{pat}', 1)")


def _pair(sec: str) -> str:
    lines = (f"list_filter(list_transform(string_split({sec}, chr(10)), lambda x: lower({_strip('x')})), "
             "lambda x: x <> '')")
    return f"contains(chr(10) || array_to_string({lines}, chr(10)) || chr(10), chr(10) || 'enabled' || chr(10) || 'active' || chr(10))"


def _int(pattern: str, src: str = "text") -> str:
    return f"TRY_CAST(nullif(regexp_extract({src}, '(?im){pattern}', 1), '') AS BIGINT)"


def _nonneg(pattern: str) -> str:
    v = _int(pattern)
    return f"(CASE WHEN {v} >= 0 THEN {v} END)"


ADMIN_FACTS_SQL = f"""
af0 AS (
  SELECT log_id, host, text,
    {_sec('NETWORK CHECK', 'MEMORY + SWAP')} AS s_network,
    {_sec('NETWORK + TAILSCALE', 'SSH LISTEN')} AS s_services,
    {_sec('SSH LISTEN', 'UFW SUMMARY')} AS s_ssh,
    {_sec('FAIL2BAN (status only)', 'DISK ROOT')} AS s_fail2ban,
    {_sec('SMB SERVICES', 'TIME MACHINE PATH')} AS s_smb,
    {_sec('TIME MACHINE PATH', 'TIME MACHINE FRESHNESS')} AS s_tm,
    {_sec('INFRA BACKUPS PATH', 'INFRA BACKUPS FRESHNESS')} AS s_infra,
    {_sec('SYSSTAT (summary)', 'JOURNAL P3+ (current boot)')} AS s_sysstat,
    {_sec('DISK ROOT', 'INODES')} AS s_disk,
    {_sec('INODES', 'SYSSTAT (summary)')} AS s_inodes,
    {_sec('MEMORY + SWAP', 'BOOT STATE')} AS s_memory,
    {_sec('WIFI WATCHDOG', 'FAIL2BAN (status only)')} AS s_wifi,
    {_sec('SMART HEALTH')} AS s_smart
  FROM admin_logs
),
af1 AS (
  SELECT *, lower({_strip("regexp_extract(s_memory, '(?m)^Swap:\\s+\\S+\\s+(\\S+)\\s+\\S+', 1)")}) AS swap_tok FROM af0
),
af AS (
  SELECT log_id, host,
    contains(s_network, 'ip_ping: FAIL') AS ping_failed,
    contains(s_network, 'dns_resolve: FAIL') AS dns_failed,
    NOT contains(s_ssh, 'ssh :22 not listening') AS ssh_healthy,
    {_pair('s_services')} AS tailscale_healthy,
    NOT contains(s_fail2ban, 'fail2ban inactive') AS fail2ban_healthy,
    {_pair('s_smb')} AND NOT contains(s_smb, 'smb ports not listening') AS smb_healthy,
    contains(s_tm, 'timemachine_path_exists: YES') AS timemachine_path_exists,
    contains(s_tm, 'timemachine_path_writable: YES') AS timemachine_path_writable,
    contains(s_infra, 'infra_backups_path_exists: YES') AS infra_backups_path_exists,
    contains(s_infra, 'infra_backups_path_writable: YES') AS infra_backups_path_writable,
    {_nonneg('infra_backups_tar_age_seconds:\\s*(-?\\d+)')} AS infra_backups_tar_age_seconds,
    contains(text, 'infra_backups_pairs_match: YES') AS infra_backups_pairs_match,
    TRY_CAST(nullif(regexp_extract(s_disk, '(?m)^/dev/\\S+\\s+\\S+\\s+\\S+\\s+\\S+\\s+\\S+\\s+(\\d+)%\\s+/$', 1), '')
             AS BIGINT) AS root_disk_used_percent,
    TRY_CAST(nullif(regexp_extract(s_inodes, '(?m)^/dev/\\S+\\s+\\d+\\s+\\d+\\s+\\d+\\s+(\\d+)%\\s+/$', 1), '')
             AS BIGINT) AS root_inode_used_percent,
    contains(text, 'reboot_required: YES') AS reboot_required,
    coalesce({_int('upgradable_packages:\\s*(\\d+)')}, 0) AS upgradable_packages,
    contains(lower(s_sysstat), lower('ENABLED="false"')) OR contains(lower(s_sysstat), chr(10) || 'disabled' || chr(10))
      OR contains(lower(s_sysstat), chr(10) || 'inactive' || chr(10)) AS sysstat_bad,
    contains(lower(text), lower('systemd-journald.service: Watchdog timeout'))
      OR contains(lower(text), lower('Failed to start systemd-journald.service')) AS journald_bad,
    greatest(coalesce({_int('wifi_watchdog_events_journal_boot:\\s*(\\d+)', 's_wifi')}, 0),
             coalesce({_int('wifi_watchdog_events_dmesg_boot:\\s*(\\d+)', 's_wifi')}, 0)) AS wifi_watchdog_events,
    CASE WHEN regexp_matches(swap_tok, '^([0-9]*\\.?[0-9]+)([a-z]+)$') THEN
      TRY_CAST(regexp_extract(swap_tok, '^([0-9]*\\.?[0-9]+)([a-z]+)$', 1) AS DOUBLE) *
      (CASE regexp_extract(swap_tok, '^([0-9]*\\.?[0-9]+)([a-z]+)$', 2)
         WHEN 'kib' THEN 1.0 / 1024 WHEN 'kb' THEN 1.0 / 1000 WHEN 'mib' THEN 1.0 WHEN 'mb' THEN 1.0
         WHEN 'gib' THEN 1024.0 WHEN 'gb' THEN 1000.0 WHEN 'tib' THEN 1048576.0 WHEN 'tb' THEN 1000000.0 END)
    END AS swap_used_mb,
    s_smart <> '' AND NOT contains(lower(s_smart), lower('{AD.SMART_PASSED}')) AS smart_unclear,
    contains(text, 'reboot_detected_recently: YES') AS reboot_detected_recently,
    {_nonneg('boot_time_unixtime:\\s*(-?\\d+)')} AS boot_time_unixtime,
    {_nonneg('uptime_seconds:\\s*(-?\\d+)')} AS uptime_seconds,
    {_nonneg('timemachine_age_seconds:\\s*(-?\\d+)')} AS timemachine_age_seconds,
    {_nonneg('audit_log_age_seconds:\\s*(-?\\d+)')} AS audit_log_age_seconds,
    {_nonneg('infra_backups_sha_age_seconds:\\s*(-?\\d+)')} AS infra_backups_sha_age_seconds,
    coalesce({_int('infra_backups_tar_count:\\s*(\\d+)')}, 0) AS infra_backups_tar_count,
    coalesce({_int('infra_backups_sha_count:\\s*(\\d+)')}, 0) AS infra_backups_sha_count
  FROM af1
)"""

_CHECKS = [
    ("ping_failed", "critical", "network_ping_failed", "'external ping failed'"),
    ("dns_failed", "critical", "dns_resolution_failed", "'dns resolution failed'"),
    ("NOT ssh_healthy", "critical", "ssh_unhealthy", "'ssh not listening on port 22'"),
    ("NOT tailscale_healthy", "critical", "tailscale_unhealthy", "'tailscale or network service inactive'"),
    ("NOT smb_healthy", "critical", "smb_unhealthy", "'smb service unhealthy'"),
    ("NOT timemachine_path_exists", "critical", "timemachine_path_missing", "'time machine path missing'"),
    ("timemachine_path_exists AND NOT timemachine_path_writable", "critical", "timemachine_path_not_writable",
     "'time machine path not writable'"),
    ("NOT infra_backups_path_exists", "warning", "infra_backups_path_missing", "'infra-backups path missing'"),
    ("infra_backups_path_exists AND NOT infra_backups_path_writable", "warning", "infra_backups_path_not_writable",
     "'infra-backups path not writable'"),
    ("NOT infra_backups_pairs_match", "warning", "infra_backups_pairs_mismatch",
     "'infra-backups tar/sha256 counts do not match'"),
    ("infra_backups_tar_age_seconds > 259200", "warning", "infra_backups_stale",
     "'infra-backups latest archive is stale (' || CAST(infra_backups_tar_age_seconds AS VARCHAR) || 's)'"),
    ("root_disk_used_percent > 90", "critical", "root_disk_high",
     "'root filesystem usage high (' || CAST(root_disk_used_percent AS VARCHAR) || '%)'"),
    ("root_disk_used_percent <= 90 AND root_disk_used_percent > 80", "warning", "root_disk_elevated",
     "'root filesystem usage elevated (' || CAST(root_disk_used_percent AS VARCHAR) || '%)'"),
    ("root_inode_used_percent > 90", "critical", "root_inode_high",
     "'root inode usage high (' || CAST(root_inode_used_percent AS VARCHAR) || '%)'"),
    ("root_inode_used_percent <= 90 AND root_inode_used_percent > 80", "warning", "root_inode_elevated",
     "'root inode usage elevated (' || CAST(root_inode_used_percent AS VARCHAR) || '%)'"),
    ("reboot_required", "warning", "reboot_required", "'reboot required'"),
    ("upgradable_packages > 0", "warning", "upgradable_packages",
     "CAST(upgradable_packages AS VARCHAR) || ' upgradable packages'"),
    ("NOT fail2ban_healthy", "warning", "fail2ban_unhealthy", "'fail2ban inactive'"),
    ("sysstat_bad", "warning", "sysstat_unhealthy", "'sysstat not healthy'"),
    ("journald_bad", "warning", "journald_unstable", "'recent journald watchdog/start failures detected'"),
    ("wifi_watchdog_events >= 1", "warning", "wifi_watchdog",
     "'broadcom wifi watchdog events detected (' || CAST(wifi_watchdog_events AS VARCHAR) || ' this boot)'"),
    ("swap_used_mb > 512", "warning", "swap_elevated",
     "'swap usage elevated (' || CAST(CAST(round_even(swap_used_mb, 0) AS BIGINT) AS VARCHAR) || 'MiB)'"),
    ("smart_unclear", "warning", "smart_unclear", "'smart health check not clearly passed'"),
]

ADMIN_FINDINGS_SQL = ADMIN_FACTS_SQL + """,
adf0 AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT log_id, host, {i} AS ord, '{sev}' AS severity, '{kind}' AS kind, {msg} AS message FROM af "
    f"WHERE coalesce({cond}, false)" for i, (cond, sev, kind, msg) in enumerate(_CHECKS)) + """
),
adf AS (
  SELECT log_id, host, CAST(row_number() OVER (PARTITION BY log_id ORDER BY ord) - 1 AS INTEGER) AS pos,
    severity, kind, message FROM adf0
  WHERE NOT (contains(lower(trim(message)), 'broadcom wifi watchdog events detected')
          OR contains(lower(trim(message)), 'recent kernel wifi watchdog/errors detected')
          OR (regexp_matches(lower(trim(message)), '^(\\d+)\\s+upgradable packages?$')
              AND TRY_CAST(regexp_extract(lower(trim(message)), '^(\\d+)\\s+upgradable packages?$', 1) AS BIGINT) <= 5))
)"""


def _admin(spark, sf_dir):
    return AD.analyze_admin(fx.admin_logs(spark, sf_dir))


@query("admin_sections", f"""WITH {ADMIN_FACTS_SQL}
SELECT log_id, s_network AS network_section, s_smart AS smart_section,
  {_pair('s_services')} AS tailscale_pair FROM af0
""", ctes=("admin_logs",))
def q_admin_sections(spark, sf_dir):
    from fleetlens.functions.maps import enabled_active_pair
    from fleetlens.operators.audits import LINE_BREAKS

    a = fx.admin_logs(spark, sf_dir)
    services = AD.section("text", "NETWORK + TAILSCALE", "SSH LISTEN")
    return a.select("log_id", AD.section("text", "NETWORK CHECK", "MEMORY + SWAP").alias("network_section"),
                    AD.section("text", "SMART HEALTH").alias("smart_section"),
                    enabled_active_pair(F.split(services, LINE_BREAKS)).alias("tailscale_pair"))


@query("admin_facts", f"""WITH {ADMIN_FACTS_SQL}
SELECT log_id, ssh_healthy, tailscale_healthy, smb_healthy, infra_backups_tar_age_seconds, root_disk_used_percent,
  root_inode_used_percent, upgradable_packages, wifi_watchdog_events, swap_used_mb FROM af
""", ctes=("admin_logs",))
def q_admin_facts(spark, sf_dir):
    a = fx.admin_logs(spark, sf_dir).select("log_id", AD.admin_facts("text").alias("f"))
    return a.select("log_id", *[F.col("f." + c).alias(c) for c in (
        "ssh_healthy", "tailscale_healthy", "smb_healthy", "infra_backups_tar_age_seconds", "root_disk_used_percent",
        "root_inode_used_percent", "upgradable_packages", "wifi_watchdog_events", "swap_used_mb")])


@query("admin_findings", f"WITH {ADMIN_FINDINGS_SQL} SELECT log_id, pos, severity, kind, message FROM adf",
       ctes=("admin_logs",))
def q_admin_findings(spark, sf_dir):
    a = _admin(spark, sf_dir)
    rows = F.transform("findings", lambda x, i: F.struct(i.alias("pos"), x["severity"].alias("severity"),
                                                         x["kind"].alias("kind"), x["message"].alias("message")))
    return a.select("log_id", F.inline(rows))


@query("admin_levels", f"""WITH {ADMIN_FINDINGS_SQL}
SELECT l.log_id,
  CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 'critical'
       WHEN count(f.pos) > 0 THEN 'warning' ELSE 'ok' END AS overall,
  count(f.pos) AS findings_count,
  coalesce(string_agg(f.severity || ':' || f.message, '; ' ORDER BY f.pos), '') AS summary,
  CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 2 ELSE 0 END AS exit_code,
  'host=admin audit_analyze=' || (CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 'critical'
       WHEN count(f.pos) > 0 THEN 'warning' ELSE 'ok' END) || ' findings=' || CAST(count(f.pos) AS VARCHAR)
    || coalesce(' details=' || string_agg(f.severity || ':' || f.message, '; ' ORDER BY f.pos), '') AS report_line
FROM admin_logs l LEFT JOIN adf f ON f.log_id = l.log_id GROUP BY l.log_id
""", ctes=("admin_logs",))
def q_admin_levels(spark, sf_dir):
    return _admin(spark, sf_dir).select("log_id", "overall", "findings_count", "summary", "exit_code", "report_line")


@query("section_marker", """
SELECT log_id,
  '/var/log/admin-host-audit/audit_' || CAST(log_id AS VARCHAR) || '.log' AS marker_path,
  CASE WHEN log_id % 10 = 0 THEN '' ELSE regexp_replace(text, '^\\s+|\\s+$', '', 'g') END AS body
FROM admin_logs
""", ctes=("admin_logs",))
def q_section_marker(spark, sf_dir):
    """Path and body from the wrapped command output (no marker: path kept, body empty)."""
    a = AD.strip_body_marker(fx.admin_logs(spark, sf_dir).select("log_id", "output"))
    return a.select("log_id", F.col("log_path").alias("marker_path"), "body")


@query("admin_finding_presence", f"WITH {ADMIN_FINDINGS_SQL} SELECT DISTINCT log_id, kind, severity FROM adf",
       ctes=("admin_logs",))
def q_admin_finding_presence(spark, sf_dir):
    """A21 (admin): distinct (kind, severity) presence gauges per log."""
    f = q_admin_findings(spark, sf_dir)
    return f.select("log_id", "kind", "severity").distinct()


# FIXED VALUES - time point standing for the admin audit's run time (reproducible gauges).
ADMIN_AS_OF_UNIX = 1706659200


def _admin_gauge_sql() -> str:
    h = 'host="admin"'
    sel = lambda m, lb, v, src="lv": f"SELECT log_id, '{m}' AS metric, '{lb}' AS labels, CAST({v} AS VARCHAR) AS value FROM {src}"
    parts = [sel("admin_host_audit_last_run_unixtime", h, str(ADMIN_AS_OF_UNIX))]
    for lv in ("ok", "warning", "critical"):
        parts.append(sel("admin_host_audit_status", h + f',level="{lv}"', f"CASE WHEN overall = '{lv}' THEN 1 ELSE 0 END"))
    parts.append(sel("admin_host_audit_findings_count", h, "n"))
    for sev in ("warning", "critical"):
        parts.append(sel("admin_host_audit_findings_count_by_severity", h + f',severity="{sev}"', f"{sev}_n"))
    parts.append(sel("admin_host_audit_upgradable_packages", h, "upgradable_packages"))
    parts.append(sel("admin_host_audit_wifi_watchdog_events", h, "wifi_watchdog_events"))
    for m, c in AD.ADMIN_FLAG_GAUGES:
        parts.append(sel(m, h, f"CASE WHEN {c} THEN 1 ELSE 0 END"))
    for m, c in AD.ADMIN_OPTIONAL_GAUGES:
        parts.append(sel(m, h, c) + f" WHERE {c} IS NOT NULL")
    parts.append(sel("admin_host_infra_backups_tar_count", h, "infra_backups_tar_count"))
    parts.append(sel("admin_host_infra_backups_sha_count", h, "infra_backups_sha_count"))
    parts.append(sel("admin_host_infra_backups_pairs_match", h, "CASE WHEN infra_backups_pairs_match THEN 1 ELSE 0 END"))
    parts.append("SELECT DISTINCT log_id, 'admin_host_audit_finding_present', 'host=\"admin\",kind=\"' || kind || "
                 "'\",severity=\"' || severity || '\"', '1' FROM adf")
    return "\nUNION ALL\n".join(parts)


_ADMIN_LEVELS_SQL = f"""WITH {ADMIN_FINDINGS_SQL},
lv AS (
  SELECT a.*, count(f.pos) AS n, count(f.pos) FILTER (WHERE f.severity = 'warning') AS warning_n,
    count(f.pos) FILTER (WHERE f.severity = 'critical') AS critical_n,
    CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 'critical'
         WHEN count(f.pos) > 0 THEN 'warning' ELSE 'ok' END AS overall
  FROM af a LEFT JOIN adf f ON f.log_id = a.log_id GROUP BY ALL
)
"""


@query("admin_gauges", _ADMIN_LEVELS_SQL + _admin_gauge_sql(), ctes=("admin_logs",))
def q_admin_gauges(spark, sf_dir):
    """D7 (admin): the admin audit's gauge families in long form."""
    return AD.admin_gauges(_admin(spark, sf_dir), ADMIN_AS_OF_UNIX)


@query("admin_exposition", _ADMIN_LEVELS_SQL + exposition_sql("log_id", _admin_gauge_sql(), AD.ADMIN_HELP, "admin_host_audit_finding_present"), ctes=("admin_logs",))
def q_admin_exposition(spark, sf_dir):
    """K5 (admin): the lines of every log's text."""
    return lines_of(AD.admin_exposition(_admin(spark, sf_dir), ADMIN_AS_OF_UNIX), "log_id")
