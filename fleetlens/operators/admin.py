"""Admin host audit over sectioned text logs.

Everything is a per-row expression: sections are cut with ``regexp_extract`` (DOTALL, non-greedy,
first match), values with anchored multi-line patterns. A fleet of logs is a column of texts; no
shuffle is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import contains_any, enabled_active_pair
from fleetlens.functions.numeric import extract_first_int, extract_nonneg_int, fmt_num, max_of_two_counts, size_to_mb
from fleetlens.functions.text import py_strip, render_summary
from fleetlens.operators.audits import FINDING, LINE_BREAKS, count_severity, level_of

# FIXED VALUES - admin audit noise rules and thresholds.
ADMIN_NOISE_PATTERNS = ["broadcom wifi watchdog events detected", "recent kernel wifi watchdog/errors detected"]
MAX_UPGRADABLE_PACKAGES_NOISE = 5
INFRA_BACKUPS_STALE_SECONDS = 3 * 24 * 3600
SWAP_ELEVATED_MIB = 512
SYSSTAT_BAD_PATTERNS = ['ENABLED="false"', "\ndisabled\n", "\ninactive\n"]
JOURNALD_BAD_PATTERNS = ["systemd-journald.service: Watchdog timeout", "Failed to start systemd-journald.service"]
SMART_PASSED = "SMART overall-health self-assessment test result: PASSED"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def section(text, start_title: str, end_title: str = "") -> Column:
    """Text between ``==== start ====`` and ``==== end ====`` (first match, non-greedy, DOTALL),
    stripped; empty end title = to the end of the text; no match -> ''."""
    start = r"\Q==== " + start_title + r" ====\E"
    pattern = "(?s)" + start + (r"(.*?)\Q==== " + end_title + r" ====\E" if end_title else r"(.*)$")
    return py_strip(F.regexp_extract(F.coalesce(_c(text), F.lit("")), pattern, 1))


BODY_MARKER = "__AUDIT_BODY_BEGIN__"


def strip_body_marker(outputs: DataFrame, output: str = "output") -> DataFrame:
    """``log_path`` and ``body`` from command output, in the place of its column. ``LOG_PATH:`` line before the
    marker gives the path (empty -> null); lines after the ``__AUDIT_BODY_BEGIN__`` line are the body, stripped; no
    marker -> empty body. Lines and marker are computed once per output."""
    from fleetlens.operators.audits import materialize

    keep = [c for c in outputs.columns if c != output]
    x = materialize(outputs, keep, _lines=F.split(F.coalesce(F.col(output), F.lit("")), LINE_BREAKS))
    stripped = F.transform("_lines", lambda x: F.when(x.contains(BODY_MARKER), py_strip(x)).otherwise(F.lit("")))
    x = materialize(x, [*keep, "_lines"], _marker=F.array_position(stripped, F.lit(BODY_MARKER)))
    lines, marker, n = F.col("_lines"), F.col("_marker"), F.size("_lines")
    head = F.when(marker > 0, F.slice(lines, 1, marker)).otherwise(lines)
    last_path = F.get(F.reverse(F.filter(head, lambda x: x.startswith("LOG_PATH:"))), 0)
    log_path = F.nullif(py_strip(F.substr(last_path, F.lit(len("LOG_PATH:") + 1))), F.lit(""))
    body = F.when((marker > 0) & (marker < n), py_strip(
        F.array_join(F.slice(lines, marker + 1, F.greatest(n - marker, F.lit(1))), "\n"))).otherwise(F.lit(""))
    return materialize(x, keep, log_path=log_path, body=body)


def _lines(sec: Column) -> Column:
    return F.split(sec, LINE_BREAKS)


def admin_facts(text) -> Column:
    """Typed facts of one admin log, as a struct."""
    t = F.coalesce(_c(text), F.lit(""))
    network = section(t, "NETWORK CHECK", "MEMORY + SWAP")
    services = section(t, "NETWORK + TAILSCALE", "SSH LISTEN")
    ssh = section(t, "SSH LISTEN", "UFW SUMMARY")
    fail2ban = section(t, "FAIL2BAN (status only)", "DISK ROOT")
    smb = section(t, "SMB SERVICES", "TIME MACHINE PATH")
    tm_path = section(t, "TIME MACHINE PATH", "TIME MACHINE FRESHNESS")
    infra_path = section(t, "INFRA BACKUPS PATH", "INFRA BACKUPS FRESHNESS")
    sysstat = section(t, "SYSSTAT (summary)", "JOURNAL P3+ (current boot)")
    disk = section(t, "DISK ROOT", "INODES")
    inodes = section(t, "INODES", "SYSSTAT (summary)")
    memory = section(t, "MEMORY + SWAP", "BOOT STATE")
    wifi = section(t, "WIFI WATCHDOG", "FAIL2BAN (status only)")
    smart = section(t, "SMART HEALTH", "")

    swap_tok = F.lower(py_strip(F.regexp_extract(memory, r"(?m)^Swap:\s+\S+\s+(\S+)\s+\S+", 1)))
    num = F.regexp_extract(swap_tok, r"^([0-9]*\.?[0-9]+)([a-z]+)$", 1)
    unit = F.regexp_extract(swap_tok, r"^([0-9]*\.?[0-9]+)([a-z]+)$", 2)
    swap_mb = F.when(num != "", size_to_mb(num, unit))
    disk_pct = F.nullif(F.regexp_extract(disk, r"(?m)^/dev/\S+\s+\S+\s+\S+\s+\S+\s+\S+\s+(\d+)%\s+/$", 1),
                        F.lit("")).try_cast("long")
    inode_pct = F.nullif(F.regexp_extract(inodes, r"(?m)^/dev/\S+\s+\d+\s+\d+\s+\d+\s+(\d+)%\s+/$", 1),
                         F.lit("")).try_cast("long")
    return F.struct(
        network.contains("ip_ping: FAIL").alias("ping_failed"),
        network.contains("dns_resolve: FAIL").alias("dns_failed"),
        (~ssh.contains("ssh :22 not listening")).alias("ssh_healthy"),
        enabled_active_pair(_lines(services)).alias("tailscale_healthy"),
        (~fail2ban.contains("fail2ban inactive")).alias("fail2ban_healthy"),
        (enabled_active_pair(_lines(smb)) & ~smb.contains("smb ports not listening")).alias("smb_healthy"),
        tm_path.contains("timemachine_path_exists: YES").alias("timemachine_path_exists"),
        tm_path.contains("timemachine_path_writable: YES").alias("timemachine_path_writable"),
        infra_path.contains("infra_backups_path_exists: YES").alias("infra_backups_path_exists"),
        infra_path.contains("infra_backups_path_writable: YES").alias("infra_backups_path_writable"),
        extract_nonneg_int(t, r"infra_backups_tar_age_seconds:\s*(-?\d+)").alias("infra_backups_tar_age_seconds"),
        extract_nonneg_int(t, r"infra_backups_sha_age_seconds:\s*(-?\d+)").alias("infra_backups_sha_age_seconds"),
        F.coalesce(extract_first_int(t, r"infra_backups_tar_count:\s*(\d+)"), F.lit(0)).alias("infra_backups_tar_count"),
        F.coalesce(extract_first_int(t, r"infra_backups_sha_count:\s*(\d+)"), F.lit(0)).alias("infra_backups_sha_count"),
        t.contains("infra_backups_pairs_match: YES").alias("infra_backups_pairs_match"),
        disk_pct.alias("root_disk_used_percent"),
        inode_pct.alias("root_inode_used_percent"),
        t.contains("reboot_required: YES").alias("reboot_required"),
        t.contains("reboot_detected_recently: YES").alias("reboot_detected_recently"),
        extract_nonneg_int(t, r"boot_time_unixtime:\s*(-?\d+)").alias("boot_time_unixtime"),
        extract_nonneg_int(t, r"uptime_seconds:\s*(-?\d+)").alias("uptime_seconds"),
        F.coalesce(extract_first_int(t, r"upgradable_packages:\s*(\d+)"), F.lit(0)).alias("upgradable_packages"),
        contains_any(sysstat, SYSSTAT_BAD_PATTERNS).alias("sysstat_bad"),
        contains_any(t, JOURNALD_BAD_PATTERNS).alias("journald_bad"),
        max_of_two_counts(extract_first_int(wifi, r"wifi_watchdog_events_journal_boot:\s*(\d+)"),
                          extract_first_int(wifi, r"wifi_watchdog_events_dmesg_boot:\s*(\d+)"))
        .alias("wifi_watchdog_events"),
        swap_mb.alias("swap_used_mb"),
        ((smart != "") & ~F.lower(smart).contains(SMART_PASSED.lower())).alias("smart_unclear"),
        extract_nonneg_int(t, r"timemachine_age_seconds:\s*(-?\d+)").alias("timemachine_age_seconds"),
        extract_nonneg_int(t, r"audit_log_age_seconds:\s*(-?\d+)").alias("audit_log_age_seconds"),
    )


def _f(sev: str, kind: str, message) -> Column:
    m = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(sev).alias("severity"), F.lit(kind).alias("kind"), m.alias("message"))


def is_audit_noise(message: Column) -> Column:
    """wifi watchdog lines, or ``N upgradable packages`` with N <= 5."""
    low = F.lower(py_strip(message))
    m = F.regexp_extract(low, r"^(\d+)\s+upgradable packages?$", 1)
    return (F.exists(F.array(*[F.lit(p) for p in ADMIN_NOISE_PATTERNS]), lambda p: low.contains(p))
            | ((m != "") & (m.try_cast("long") <= MAX_UPGRADABLE_PACKAGES_NOISE)))


def admin_findings(fx: Column) -> Column:
    """Ordered findings (noise removed) from the facts struct."""
    tar_age = fx["infra_backups_tar_age_seconds"]
    disk, inode = fx["root_disk_used_percent"], fx["root_inode_used_percent"]
    up = fx["upgradable_packages"]
    wifi = fx["wifi_watchdog_events"]
    swap = fx["swap_used_mb"]
    items = [
        (fx["ping_failed"], _f("critical", "network_ping_failed", "external ping failed")),
        (fx["dns_failed"], _f("critical", "dns_resolution_failed", "dns resolution failed")),
        (~fx["ssh_healthy"], _f("critical", "ssh_unhealthy", "ssh not listening on port 22")),
        (~fx["tailscale_healthy"], _f("critical", "tailscale_unhealthy", "tailscale or network service inactive")),
        (~fx["smb_healthy"], _f("critical", "smb_unhealthy", "smb service unhealthy")),
        (~fx["timemachine_path_exists"], _f("critical", "timemachine_path_missing", "time machine path missing")),
        (fx["timemachine_path_exists"] & ~fx["timemachine_path_writable"],
         _f("critical", "timemachine_path_not_writable", "time machine path not writable")),
        (~fx["infra_backups_path_exists"], _f("warning", "infra_backups_path_missing", "infra-backups path missing")),
        (fx["infra_backups_path_exists"] & ~fx["infra_backups_path_writable"],
         _f("warning", "infra_backups_path_not_writable", "infra-backups path not writable")),
        (~fx["infra_backups_pairs_match"],
         _f("warning", "infra_backups_pairs_mismatch", "infra-backups tar/sha256 counts do not match")),
        (tar_age > INFRA_BACKUPS_STALE_SECONDS,
         _f("warning", "infra_backups_stale",
            F.concat(F.lit("infra-backups latest archive is stale ("), tar_age.cast("string"), F.lit("s)")))),
        (disk > 90, _f("critical", "root_disk_high",
                       F.concat(F.lit("root filesystem usage high ("), disk.cast("string"), F.lit("%)")))),
        ((disk <= 90) & (disk > 80), _f("warning", "root_disk_elevated",
                                        F.concat(F.lit("root filesystem usage elevated ("), disk.cast("string"),
                                                 F.lit("%)")))),
        (inode > 90, _f("critical", "root_inode_high",
                        F.concat(F.lit("root inode usage high ("), inode.cast("string"), F.lit("%)")))),
        ((inode <= 90) & (inode > 80), _f("warning", "root_inode_elevated",
                                          F.concat(F.lit("root inode usage elevated ("), inode.cast("string"),
                                                   F.lit("%)")))),
        (fx["reboot_required"], _f("warning", "reboot_required", "reboot required")),
        (up > 0, _f("warning", "upgradable_packages", F.concat(up.cast("string"), F.lit(" upgradable packages")))),
        (~fx["fail2ban_healthy"], _f("warning", "fail2ban_unhealthy", "fail2ban inactive")),
        (fx["sysstat_bad"], _f("warning", "sysstat_unhealthy", "sysstat not healthy")),
        (fx["journald_bad"], _f("warning", "journald_unstable", "recent journald watchdog/start failures detected")),
        (wifi >= 1, _f("warning", "wifi_watchdog", F.concat(F.lit("broadcom wifi watchdog events detected ("),
                                                          wifi.cast("string"), F.lit(" this boot)")))),
        (swap > SWAP_ELEVATED_MIB, _f("warning", "swap_elevated",
                                      F.concat(F.lit("swap usage elevated ("), fmt_num(swap, 0), F.lit("MiB)")))),
        (fx["smart_unclear"], _f("warning", "smart_unclear", "smart health check not clearly passed")),
    ]
    arr = F.array(*[F.when(F.coalesce(c, F.lit(False)), v) for c, v in items]).cast(f"array<{FINDING}>")
    return F.filter(arr, lambda x: x.isNotNull() & ~is_audit_noise(x["message"]))


def analyze_admin(logs: DataFrame, host: str = "admin") -> DataFrame:
    """D1 per log: facts, findings, overall level, counts, summary ('' when no findings), one-line report.

    Facts and findings are each computed once per row behind a generator (see ``audits.materialize``);
    everything after reads plain columns."""
    from fleetlens.operators.audits import materialize
    from fleetlens.session import cached_expr

    keep = [c for c in logs.columns if c not in ("text", "output")]
    a = materialize(logs, keep, facts=cached_expr(("admin_facts", "text"), lambda: admin_facts("text")))
    a = materialize(a, keep + ["facts"],
                    findings=cached_expr(("admin_findings", "facts"), lambda: admin_findings(F.col("facts"))))
    fs = F.col("findings")
    a = a.select(
        *keep, "facts", "findings", level_of(fs).alias("overall"), F.size(fs).cast("long").alias("findings_count"),
        count_severity(fs, "warning").alias("warning_count"), count_severity(fs, "critical").alias("critical_count"),
        F.array_join(F.transform(fs, lambda x: F.concat(x["severity"], F.lit(":"), x["message"])), "; ")
        .alias("summary"))
    report = render_summary(F.lit(host), F.col("overall"), F.col("findings_count").cast("string"),
                            details=F.col("summary"))
    return a.withColumn("exit_code", F.when(F.col("overall") == "critical", F.lit(2)).otherwise(F.lit(0))) \
            .withColumn("report_line", report)


# FIXED VALUES - admin gauge families fed by a boolean fact (1 when true) or a count, in output order.
ADMIN_FLAG_GAUGES = [
    ("admin_host_audit_reboot_required", "reboot_required"),
    ("admin_host_reboot_detected_recently", "reboot_detected_recently"),
    ("admin_host_audit_timemachine_path_exists", "timemachine_path_exists"),
    ("admin_host_audit_timemachine_path_writable", "timemachine_path_writable"),
    ("admin_host_audit_infra_backups_path_exists", "infra_backups_path_exists"),
    ("admin_host_audit_infra_backups_path_writable", "infra_backups_path_writable"),
    ("admin_host_audit_smb_healthy", "smb_healthy"),
    ("admin_host_audit_ssh_healthy", "ssh_healthy"),
    ("admin_host_audit_tailscale_healthy", "tailscale_healthy"),
    ("admin_host_audit_fail2ban_healthy", "fail2ban_healthy"),
]
ADMIN_OPTIONAL_GAUGES = [  # emitted only when the fact is present
    ("admin_host_boot_time_unixtime", "boot_time_unixtime"),
    ("admin_host_uptime_seconds", "uptime_seconds"),
    ("admin_host_audit_root_disk_used_percent", "root_disk_used_percent"),
    ("admin_host_audit_root_inode_used_percent", "root_inode_used_percent"),
    ("admin_host_timemachine_age_seconds", "timemachine_age_seconds"),
    ("admin_host_audit_log_age_seconds", "audit_log_age_seconds"),
    ("admin_host_infra_backups_tar_age_seconds", "infra_backups_tar_age_seconds"),
    ("admin_host_infra_backups_sha_age_seconds", "infra_backups_sha_age_seconds"),
]


# FIXED VALUES - help texts of the admin audit's metrics.
ADMIN_HELP = {
    "admin_host_audit_last_run_unixtime": "Unix timestamp of the last completed admin host audit.",
    "admin_host_audit_status": "Overall admin host audit status encoded as one-hot levels.",
    "admin_host_audit_findings_count": "Total number of audit findings.",
    "admin_host_audit_findings_count_by_severity": "Number of audit findings grouped by severity.",
    "admin_host_audit_upgradable_packages": "Number of upgradable packages detected by audit.",
    "admin_host_audit_wifi_watchdog_events": "Broadcom Wi-Fi watchdog events seen in current boot.",
    "admin_host_audit_reboot_required": "Whether reboot-required marker is present.",
    "admin_host_reboot_detected_recently": "Whether the node booted recently according to audit.",
    "admin_host_boot_time_unixtime": "Boot time derived from /proc/uptime.",
    "admin_host_uptime_seconds": "Uptime in seconds derived from /proc/uptime.",
    "admin_host_audit_timemachine_path_exists": "Whether Time Machine path exists.",
    "admin_host_audit_timemachine_path_writable": "Whether Time Machine path is writable.",
    "admin_host_audit_infra_backups_path_exists": "Whether infra-backups path exists.",
    "admin_host_audit_infra_backups_path_writable": "Whether infra-backups path is writable.",
    "admin_host_audit_smb_healthy": "Whether SMB service is healthy according to audit.",
    "admin_host_audit_ssh_healthy": "Whether SSH service is healthy according to audit.",
    "admin_host_audit_tailscale_healthy": "Whether Tailscale/network service is healthy according to audit.",
    "admin_host_audit_fail2ban_healthy": "Whether fail2ban is healthy according to audit.",
    "admin_host_audit_root_disk_used_percent": "Root filesystem used percent.",
    "admin_host_audit_root_inode_used_percent": "Root inode used percent.",
    "admin_host_timemachine_age_seconds": "Age of the newest Time Machine sparsebundle artifact in seconds.",
    "admin_host_audit_log_age_seconds": "Age of the newest audit log in seconds.",
    "admin_host_infra_backups_tar_age_seconds": "Age of newest VPS backup archive in seconds.",
    "admin_host_infra_backups_sha_age_seconds": "Age of newest VPS backup checksum in seconds.",
    "admin_host_infra_backups_tar_count": "Number of VPS backup archives present.",
    "admin_host_infra_backups_sha_count": "Number of VPS backup checksum files present.",
    "admin_host_infra_backups_pairs_match": "Whether VPS backup archives and checksum counts match.",
    "admin_host_audit_finding_present": "Finding presence grouped by kind and severity.",
}


def admin_gauge_rows(analysis: DataFrame, as_of_unix: int, host: str = "admin") -> DataFrame:
    """D7 (admin): one-hot status, counts, fact flags and values (optional ones only when present) and the
    distinct (kind, severity) presence pairs. ``as_of_unix`` stands for the run time (reproducible)."""
    h = f'host="{host}"'
    fx = F.col("facts")

    def row(metric, labels, value):
        return F.struct(F.lit(metric).alias("metric"), (F.lit(labels) if isinstance(labels, str) else labels)
                        .alias("labels"), value.cast("string").alias("value"))

    rows = [row("admin_host_audit_last_run_unixtime", h, F.lit(as_of_unix))]
    rows += [row("admin_host_audit_status", h + f',level="{lv}"', F.when(F.col("overall") == lv, 1).otherwise(0))
             for lv in ("ok", "warning", "critical")]
    rows.append(row("admin_host_audit_findings_count", h, F.col("findings_count")))
    rows += [row("admin_host_audit_findings_count_by_severity", h + f',severity="{sev}"', F.col(f"{sev}_count"))
             for sev in ("warning", "critical")]
    rows.append(row("admin_host_audit_upgradable_packages", h, fx["upgradable_packages"]))
    rows.append(row("admin_host_audit_wifi_watchdog_events", h, fx["wifi_watchdog_events"]))
    rows += [row(m, h, F.when(fx[c], 1).otherwise(0)) for m, c in ADMIN_FLAG_GAUGES]
    rows += [F.when(fx[c].isNotNull(), row(m, h, fx[c])) for m, c in ADMIN_OPTIONAL_GAUGES]
    rows.append(row("admin_host_infra_backups_tar_count", h, fx["infra_backups_tar_count"]))
    rows.append(row("admin_host_infra_backups_sha_count", h, fx["infra_backups_sha_count"]))
    rows.append(row("admin_host_infra_backups_pairs_match", h, F.when(fx["infra_backups_pairs_match"], 1).otherwise(0)))
    pairs = F.array_sort(F.array_distinct(F.transform("findings", lambda f: F.struct(f["kind"].alias("k"),
                                                                                     f["severity"].alias("s")))))
    present = F.transform(pairs, lambda p: F.struct(
        F.lit("admin_host_audit_finding_present").alias("metric"),
        F.concat(F.lit(h + ',kind="'), p["k"], F.lit('",severity="'), p["s"], F.lit('"')).alias("labels"),
        F.lit("1").alias("value")))
    allrows = F.filter(F.concat(F.array(*rows), present), lambda x: x.isNotNull())
    return analysis.select("log_id", allrows.alias("rows"))


def admin_gauges(analysis: DataFrame, as_of_unix: int, host: str = "admin") -> DataFrame:
    """Long form ``(log_id, metric, labels, value)`` of :func:`admin_gauge_rows`."""
    from fleetlens.operators.audits import inline_rows

    return inline_rows(admin_gauge_rows(analysis, as_of_unix, host), ["log_id"], "rows")


def admin_exposition(analysis: DataFrame, as_of_unix: int, host: str = "admin") -> DataFrame:
    """K5 (admin): one text per log."""
    from fleetlens.operators.audits import exposition_text

    return admin_gauge_rows(analysis, as_of_unix, host).select(
        "log_id", exposition_text(F.col("rows"), ADMIN_HELP, "admin_host_audit_finding_present").alias("text"))
