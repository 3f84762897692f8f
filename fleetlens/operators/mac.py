"""Mac host snapshots: audit checks (D4), memory evaluation (D5, P17), agent signals (S2),
latest snapshot per host (W2, T5), staleness (F13, T7), top processes (S12, W4, W11, J10, F17, P8).

The per-host reductions (latest snapshot, top process) are aggregates (``max_by``), so a host with a
huge share of the rows is combined map-side instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.maps import fingerprint
from fleetlens.functions.numeric import fmt_num, safe_float, safe_int
from fleetlens.functions.text import finding_text, normalize_app_name, py_strip, squash_spaces
from fleetlens.operators.audits import FINDING, count_severity, level_of, materialize

# FIXED VALUES - Mac host audit thresholds.
MAC_MEMORY_FREE_CRIT, MAC_MEMORY_FREE_WARN = 5, 10
MAC_SWAP_CRIT, MAC_SWAP_WARN = 8192, 4096
MAC_DISK_CRIT, MAC_DISK_WARN = 92, 85
MAC_BATTERY_CRIT, MAC_BATTERY_WARN = 10, 20
MAC_BREW_WARN = 30

# FIXED VALUES - memory guard thresholds.
WARNING_SWAP_MB, CRITICAL_SWAP_MB = 1400.0, 2400.0
WARNING_UPTIME_DAYS, CRITICAL_UPTIME_DAYS = 10.0, 20.0
WARNING_TOP_RSS_MB, CRITICAL_TOP_RSS_MB = 1800.0, 2400.0
WARNING_DISK_USED_PERCENT, CRITICAL_DISK_USED_PERCENT = 85, 92
HIGH_SWAP_MB = 1024.0
LOW_FREE_MEMORY_PERCENT, VERY_LOW_FREE_MEMORY_PERCENT = 20.0, 12.0

# FIXED VALUES - processes the remediation never touches.
PROTECTED_APPS = ["ChatGPT", "Obsidian", "iTerm2"]


def _f(sev: str, kind: str, message: Column) -> Column:
    return F.struct(F.lit(sev).alias("severity"), F.lit(kind).alias("kind"), message.alias("message"))


def mac_findings(snap: DataFrame) -> Column:
    """Ordered findings of one snapshot row (columns of the snapshot schema)."""
    mem = safe_float(F.col("memory_free_percent"))
    swap = safe_float(F.col("swap_used_mb"))
    disk = safe_int(F.col("disk_used_percent"))
    batt = safe_int(F.col("battery_percent"))
    power = F.coalesce(F.nullif(F.col("power_source").cast("string"), F.lit("")), F.lit("unknown"))
    brew = safe_int(F.col("brew_outdated_count"))
    tm = py_strip(F.coalesce(F.col("tm_latest_backup"), F.lit("")))
    mem_msg = F.concat(F.lit("memory free "), fmt_num(mem, 0), F.lit("%"))
    swap_msg = F.concat(F.lit("swap used "), fmt_num(swap, 0), F.lit("MB"))
    disk_msg = F.concat(F.lit("root disk used "), disk.cast("string"), F.lit("%"))
    batt_msg = F.concat(F.lit("battery "), batt.cast("string"), F.lit("% on battery power"))
    on_batt = (power == "battery") & batt.isNotNull()
    items = [
        (mem < MAC_MEMORY_FREE_CRIT, _f("critical", "memory_pressure", mem_msg)),
        ((mem >= MAC_MEMORY_FREE_CRIT) & (mem < MAC_MEMORY_FREE_WARN), _f("warning", "memory_pressure", mem_msg)),
        (swap >= MAC_SWAP_CRIT, _f("critical", "swap_high", swap_msg)),
        ((swap < MAC_SWAP_CRIT) & (swap >= MAC_SWAP_WARN), _f("warning", "swap_high", swap_msg)),
        (disk >= MAC_DISK_CRIT, _f("critical", "disk_high", disk_msg)),
        ((disk < MAC_DISK_CRIT) & (disk >= MAC_DISK_WARN), _f("warning", "disk_high", disk_msg)),
        (on_batt & (batt <= MAC_BATTERY_CRIT), _f("critical", "battery_low", batt_msg)),
        (on_batt & (batt > MAC_BATTERY_CRIT) & (batt <= MAC_BATTERY_WARN), _f("warning", "battery_low", batt_msg)),
        (brew >= MAC_BREW_WARN, _f("warning", "brew_outdated",
                                   F.concat(brew.cast("string"), F.lit(" outdated brew packages")))),
        (F.col("agent_launchd_loaded") == F.lit(False),
         _f("warning", "agent_launchd_missing", F.lit("mac memory guard launchd jobs not loaded"))),
        (tm == "", _f("warning", "timemachine_unknown", F.lit("time machine latest backup unavailable"))),
    ]
    arr = F.array(*[F.when(F.coalesce(c, F.lit(False)), v) for c, v in items]).cast(f"array<{FINDING}>")
    return F.filter(arr, lambda x: x.isNotNull())


def analyze_snapshots(snaps: DataFrame) -> DataFrame:
    """D4 per snapshot: findings, level, counts, summary (map-side)."""
    from fleetlens.session import cached_expr

    a = materialize(snaps, ["snapshot_id", "host", "timestamp_unix"], findings=cached_expr(("mac_findings",), lambda: mac_findings(snaps)))
    return a.select(
        "snapshot_id", "host", "timestamp_unix", "findings",
        level_of("findings").alias("level"),
        F.size("findings").cast("long").alias("findings_count"),
        count_severity("findings", "warning").alias("warning_count"),
        count_severity("findings", "critical").alias("critical_count"),
        finding_text("findings").alias("summary"),
    )


# ----------------------------------------------------------------------------- processes

def parse_process_lines(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """``pid rss_kb mem_percent command`` lines; short or non-numeric rows dropped."""
    parts = F.split(py_strip(F.col(text_col)), r"\s+", 4)
    out = lines.select(
        "host",
        F.element_at(parts, 1).try_cast("long").alias("pid"),
        F.element_at(parts, 2).try_cast("long").alias("rss_kb"),
        F.element_at(parts, 3).try_cast("double").alias("mem_percent"),
        F.when(F.size(parts) >= 4, F.element_at(parts, 4)).alias("command"),
    )
    return out.where(F.col("pid").isNotNull() & F.col("rss_kb").isNotNull() & F.col("mem_percent").isNotNull()
                     & F.col("command").isNotNull())


def top_process(processes: DataFrame) -> DataFrame:
    """Top process per host by rss (ties: higher pid). Partial aggregation."""
    return processes.groupBy("host").agg(
        F.max_by(F.struct("pid", "rss_kb", "command"), F.struct("rss_kb", "pid")).alias("top")).select(
        "host", F.col("top.pid").alias("top_pid"), F.col("top.rss_kb").alias("top_rss_kb"),
        F.col("top.command").alias("top_command"))


def top_processes(processes: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest processes per host (partial group limit before the shuffle)."""
    w = Window.partitionBy("host").orderBy(F.col("rss_kb").desc(), F.col("pid").desc())
    return (processes.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("host", "rank", "pid", "rss_kb", normalize_app_name("command").alias("app")))


def unprotected_apps(apps: DataFrame) -> DataFrame:
    """running apps (host, pid, name) that may be quit. The app's own name counts, with spaces squashed,
    not the display name of its process; rows without a name or with a pid below 1 are no apps."""
    name = squash_spaces(py_strip(F.coalesce("name", F.lit(""))))
    return apps.select("host", "pid", name.alias("name")).where((F.col("name") != "") & (F.col("pid") > 0)
                                                                & ~F.col("name").isin(*PROTECTED_APPS))


def process_candidates(apps: DataFrame, processes: DataFrame) -> DataFrame:
    """Unprotected running apps with the rss of their (host, pid); apps without a process row drop out."""
    return unprotected_apps(apps).join(processes.select("host", "pid", "rss_kb"), on=["host", "pid"], how="inner").where(F.col("rss_kb").isNotNull())


def process_pick(apps: DataFrame, processes: DataFrame) -> DataFrame:
    """Per host the candidate with the highest rss; ties by app name descending."""
    return process_candidates(apps, processes).groupBy("host").agg(
        F.max_by(F.struct("name", "pid", "rss_kb"), F.struct("rss_kb", "name", "pid")).alias("b")) \
        .select("host", F.col("b.name").alias("app"), F.col("b.pid").alias("pid"),
                F.bround(F.col("b.rss_kb") / F.lit(1024.0), 1).alias("rss_mb"))


# ----------------------------------------------------------------------------- memory evaluation

def memory_evaluate(df: DataFrame) -> DataFrame:
    """D5 / P17 over rows with swap_used_mb, uptime_days, disk_used_percent, memory_free_percent,
    top_rss_kb, top_command. Adds status, reasons (array), suggested_action."""
    swap = F.col("swap_used_mb")
    up = F.col("uptime_days")
    disk = F.col("disk_used_percent").cast("long")
    free = F.col("memory_free_percent")
    rss = F.col("top_rss_kb") / F.lit(1024.0)
    has_top = F.col("top_rss_kb").isNotNull()
    app = normalize_app_name(F.col("top_command"))
    reasons = F.array(
        F.when(swap >= WARNING_SWAP_MB, F.concat(F.lit("swap "), fmt_num(swap, 0), F.lit("MB"))),
        F.when(up >= WARNING_UPTIME_DAYS, F.concat(F.lit("uptime "), fmt_num(up, 1), F.lit("d"))),
        F.when(has_top & (rss >= WARNING_TOP_RSS_MB), F.concat(app, F.lit(" "), fmt_num(rss, 0), F.lit("MB"))),
        F.when(disk >= WARNING_DISK_USED_PERCENT, F.concat(F.lit("disk "), disk.cast("string"), F.lit("%"))),
        F.when(swap >= CRITICAL_SWAP_MB, F.concat(F.lit("critical swap "), fmt_num(swap, 0), F.lit("MB"))),
        F.when(up >= CRITICAL_UPTIME_DAYS, F.concat(F.lit("critical uptime "), fmt_num(up, 1), F.lit("d"))),
        F.when(has_top & (rss >= CRITICAL_TOP_RSS_MB),
               F.concat(F.lit("critical "), app, F.lit(" "), fmt_num(rss, 0), F.lit("MB"))),
        F.when(disk >= CRITICAL_DISK_USED_PERCENT, F.concat(F.lit("critical disk "), disk.cast("string"), F.lit("%"))),
    )
    crit = (F.coalesce(swap >= CRITICAL_SWAP_MB, F.lit(False)) | F.coalesce(up >= CRITICAL_UPTIME_DAYS, F.lit(False))
            | F.coalesce(has_top & (rss >= CRITICAL_TOP_RSS_MB), F.lit(False))
            | F.coalesce(disk >= CRITICAL_DISK_USED_PERCENT, F.lit(False)))
    warn = (F.coalesce(swap >= WARNING_SWAP_MB, F.lit(False)) | F.coalesce(up >= WARNING_UPTIME_DAYS, F.lit(False))
            | F.coalesce(has_top & (rss >= WARNING_TOP_RSS_MB), F.lit(False))
            | F.coalesce(disk >= WARNING_DISK_USED_PERCENT, F.lit(False)))
    status = F.when(crit, F.lit("critical")).when(warn, F.lit("warning")).otherwise(F.lit("ok"))
    r = F.filter(reasons, lambda x: x.isNotNull())
    r = F.when(F.size(r) == 0, F.array(F.lit("system within thresholds"))).otherwise(r)

    def ge(c, v):
        return F.coalesce(c >= v, F.lit(False))

    def le(c, v):
        return F.coalesce(c <= v, F.lit(False))

    action = (
        F.when(F.col("status") == "ok", F.lit("none"))
        .when(ge(disk, CRITICAL_DISK_USED_PERCENT), F.lit("free_disk_space"))
        .when(ge(disk, WARNING_DISK_USED_PERCENT), F.lit("check_disk_usage"))
        .when(F.col("status") == "critical",
              F.when(ge(rss, CRITICAL_TOP_RSS_MB) | le(free, VERY_LOW_FREE_MEMORY_PERCENT)
                     | ge(swap, CRITICAL_SWAP_MB), F.lit("soft_quit_top_candidate"))
              .when(ge(up, CRITICAL_UPTIME_DAYS), F.lit("reboot_if_persistent"))
              .otherwise(F.lit("soft_quit_top_candidate")))
        .when(ge(rss, WARNING_TOP_RSS_MB) | ge(swap, HIGH_SWAP_MB) | le(free, LOW_FREE_MEMORY_PERCENT),
              F.lit("observe_or_quit_top_app"))
        .when(ge(up, WARNING_UPTIME_DAYS), F.lit("observe_or_reboot_later"))
        .otherwise(F.lit("observe"))
    )
    return df.withColumn("status", status).withColumn("reasons", r).withColumn("suggested_action", action)


def should_emit_event(status: Column, force: Column | bool = False) -> Column:
    """F14."""
    f = F.lit(force) if isinstance(force, bool) else force
    return f | status.isin("warning", "critical")


def agent_signals(evaluated: DataFrame, instance_col: str = "host") -> DataFrame:
    """MacMemoryPressure signals built from evaluated snapshots (only warning / critical), in the schema of
    webhook signals: labels, annotations with the formatted facts, description, fingerprint of the labels."""
    e = evaluated.where(should_emit_event(F.col("status")))
    none = F.lit("n/a")
    app = F.when(F.col("top_rss_kb").isNull(), F.lit("none")).otherwise(normalize_app_name("top_command"))
    rss = F.when(F.col("top_rss_kb").isNull(), none).otherwise(fmt_num(F.col("top_rss_kb") / 1024.0, 0))
    swap = F.coalesce(fmt_num(F.col("swap_used_mb"), 0), none)
    free = F.coalesce(fmt_num(F.col("memory_free_percent"), 1), none)
    uptime = F.coalesce(fmt_num(F.col("uptime_days"), 1), none)
    disk = F.coalesce(F.col("disk_used_percent").cast("string"), none)
    reasons = F.when(F.size("reasons") > 0, F.array_join("reasons", ", ")).otherwise(F.lit("none"))
    summary = F.concat(F.col(instance_col), F.lit(" memory pressure: top="), app, F.lit(" rss="), rss,
                       F.lit("MB swap="), swap, F.lit("MB free="), free, F.lit("%"))
    facts = [("status", F.col("status")), ("reasons", reasons), ("swap_used_mb", swap), ("memory_free_percent", free), ("uptime_days", uptime),
             ("disk_used_percent", disk), ("top_app", app), ("top_rss_mb", rss), ("suggested_action", F.col("suggested_action")),
             ("time", F.col("timestamp_utc"))]
    description = F.array_join(F.array(*[F.concat(F.lit(k + "="), F.coalesce(v, F.lit(""))) for k, v in facts]), "\n")
    annotations = {"summary": summary, "description": description, "top_app": app, "top_rss_mb": rss, "swap_used_mb": swap,
                   "memory_free_percent": free, "uptime_days": uptime, "disk_used_percent": disk,
                   "suggested_action": F.col("suggested_action"), "reason_text": reasons, "timestamp_utc": F.col("timestamp_utc")}
    labels = F.create_map(F.lit("alertname"), F.lit("MacMemoryPressure"), F.lit("instance"), F.col(instance_col),
                          F.lit("job"), F.lit("mac-agent"), F.lit("severity"), F.col("status"))
    return e.select(
        F.col("snapshot_id").alias("signal_id"), F.lit("agent").alias("source"), F.lit("firing").alias("status"),
        F.lit("MacMemoryPressure").alias("alertname"), F.col("status").alias("severity"),
        F.col(instance_col).alias("instance"), F.lit("mac-agent").alias("job"), summary.alias("summary"), description.alias("description"),
        fingerprint(labels, F.lit(None).cast("string")).alias("fingerprint"), labels.alias("labels"),
        F.create_map(*[x for k, v in annotations.items() for x in (F.lit(k), v)]).alias("annotations"),
        F.timestamp_seconds("timestamp_unix").alias("ts"), reasons.alias("reason_text"), F.col("suggested_action"),
    )


# ----------------------------------------------------------------------------- latest / staleness

def snapshot_latest(snaps: DataFrame) -> DataFrame:
    """Newest snapshot per host (max_by over (timestamp_unix, snapshot_id))."""
    cols = [c for c in snaps.columns if c != "host"]
    return snaps.groupBy("host").agg(
        F.max_by(F.struct(*cols), F.struct("timestamp_unix", "snapshot_id")).alias("s")).select("host", "s.*")


def stale_hosts(snaps: DataFrame, as_of_unix: int, max_age_seconds: int) -> DataFrame:
    """Per host the latest snapshot age; stale when age > max_age (age == max is fresh)."""
    latest = snaps.groupBy("host").agg(F.max("timestamp_unix").alias("last_unix"))
    age = F.lit(as_of_unix) - F.col("last_unix")
    return latest.select("host", "last_unix", age.alias("age_seconds"), (age > max_age_seconds).alias("stale"))


def snapshot_stamp(ts_utc: Column) -> Column:
    """``audit_<YYYYMMDD_HHMMSS>`` from the snapshot's UTC text; empty -> ``unknown``."""
    t = py_strip(F.coalesce(ts_utc, F.lit("")))
    s = F.replace(F.replace(F.replace(F.replace(t, F.lit(" UTC"), F.lit("")), F.lit("-"), F.lit("")),
                            F.lit(":"), F.lit("")), F.lit(" "), F.lit("_"))
    return F.concat(F.lit("audit_"), F.coalesce(F.nullif(s, F.lit("")), F.lit("unknown")))


# FIXED VALUES - help texts of the Mac host audit's and the memory guard's metrics.
MAC_HELP = {
    "mac_host_audit_last_run_unixtime": "Last mac host audit snapshot timestamp.",
    "mac_host_audit_status": "Mac host audit status (0=ok, 1=warning, 2=critical).",
    "mac_host_audit_findings_count": "Mac host audit findings count.",
    "mac_host_audit_memory_free_percent": "Mac memory free percent.",
    "mac_host_audit_swap_used_mb": "Mac swap used megabytes.",
    "mac_host_audit_disk_used_percent": "Mac root disk used percent.",
    "mac_host_audit_battery_percent": "Mac battery percent.",
    "mac_host_audit_brew_outdated_count": "Mac Homebrew outdated package count.",
    "mac_host_audit_agent_launchd_loaded": "Mac memory guard launchd loaded.",
    "mac_host_audit_finding_present": "Mac host audit finding presence by kind and severity.",
}
MEMORY_HELP = {
    "mac_memory_status": "Mac memory status (0=ok, 1=warning, 2=critical).",
    "mac_memory_free_percent": "System-wide memory free percentage from memory_pressure.",
    "mac_swap_used_mb": "Swap used in megabytes.",
    "mac_uptime_days": "Mac uptime in days.",
    "mac_disk_used_percent": "Root filesystem used percent.",
    "mac_battery_percent": "Mac battery percent.",
    "mac_power_source": "Mac current power source (1=current source).",
    "mac_top_process_rss_mb": "Top process RSS in megabytes.",
    "mac_memory_last_run_unixtime": "Last successful run timestamp.",
}


def mac_gauge_rows(snaps: DataFrame) -> DataFrame:
    """D7 (Mac host audit): snapshot numbers as ``str(float)`` text (missing -> NaN), status with its level
    label, launchd flags (true only -> 1) and one presence gauge per finding. (The analysis-time gauge is
    wall-clock in the reference and is left out: results must be reproducible.)"""
    from fleetlens.operators.audits import py_float_text

    host = F.coalesce(F.nullif(F.col("host"), F.lit("")), F.lit("mba"))
    a = materialize(snaps, snaps.columns, findings=mac_findings(snaps), _host=host)
    a = materialize(a, a.columns, _level=level_of("findings"))
    host, level = F.col("_host"), F.col("_level")
    hl = F.concat(F.lit('host="'), host, F.lit('"'))
    code = F.when(level == "ok", 0).when(level == "warning", 1).when(level == "critical", 2).otherwise(3)
    nums = [("mac_host_audit_last_run_unixtime", "timestamp_unix"),
            ("mac_host_audit_memory_free_percent", "memory_free_percent"),
            ("mac_host_audit_swap_used_mb", "swap_used_mb"), ("mac_host_audit_disk_used_percent", "disk_used_percent"),
            ("mac_host_audit_battery_percent", "battery_percent"),
            ("mac_host_audit_brew_outdated_count", "brew_outdated_count")]
    fam = [F.struct(F.lit("mac_host_audit_status").alias("metric"),
                    F.concat(F.lit('host="'), host, F.lit('",level="'), level, F.lit('"')).alias("labels"),
                    code.cast("string").alias("value")),
           F.struct(F.lit("mac_host_audit_findings_count").alias("metric"), hl.alias("labels"),
                    F.size("findings").cast("string").alias("value"))]
    fam += [F.struct(F.lit(m).alias("metric"), hl.alias("labels"), py_float_text(F.col(c).cast("double")).alias("value"))
            for m, c in nums]
    fam.append(F.struct(F.lit("mac_host_audit_agent_launchd_loaded").alias("metric"), hl.alias("labels"),
                        F.when(F.col("agent_launchd_loaded") == F.lit(True), "1").otherwise("0").alias("value")))
    present = F.transform("findings", lambda f: F.struct(
        F.lit("mac_host_audit_finding_present").alias("metric"),
        F.concat(F.lit('host="'), host, F.lit('",kind="'), f["kind"], F.lit('",severity="'), f["severity"], F.lit('"'))
        .alias("labels"), F.lit("1").alias("value")))
    return a.select("snapshot_id", F.concat(F.array(*fam), present).alias("rows"))


def mac_gauges(snaps: DataFrame) -> DataFrame:
    """Long form ``(snapshot_id, metric, labels, value)`` of :func:`mac_gauge_rows`."""
    return mac_gauge_rows(snaps).select("snapshot_id", F.inline("rows"))


def mac_exposition(snaps: DataFrame) -> DataFrame:
    """K5 (Mac host audit): one text per snapshot."""
    from fleetlens.operators.audits import exposition_text

    return mac_gauge_rows(snaps).select("snapshot_id", exposition_text(F.col("rows"), MAC_HELP, "mac_host_audit_finding_present").alias("text"))


def memory_gauge_rows(evaluated: DataFrame, host_label: str = "mba") -> DataFrame:
    """D7 (memory guard): status code, snapshot numbers (``str(float)``; missing -> NaN), one-hot power
    source, top process rss with two decimals (half-even) and the run time, in long form."""
    from fleetlens.operators.audits import py_float_text

    h = f'host="{host_label}"'
    code = F.when(F.col("status") == "ok", 0).when(F.col("status") == "warning", 1).when(
        F.col("status") == "critical", 2).otherwise(3)
    power = F.when(F.col("power_source").isin("ac", "battery", "unknown"), F.col("power_source")).otherwise("unknown")
    app = F.when(F.col("top_rss_kb").isNull(), F.lit("none")).otherwise(normalize_app_name("top_command"))
    rss = F.coalesce(F.col("top_rss_kb") / F.lit(1024.0), F.lit(0.0))

    def row(metric, labels, value):
        return F.struct(F.lit(metric).alias("metric"), (F.lit(labels) if isinstance(labels, str) else labels)
                        .alias("labels"), value.alias("value"))

    rows = [row("mac_memory_status", h, code.cast("string"))]
    for metric, col in (("mac_memory_free_percent", "memory_free_percent"), ("mac_swap_used_mb", "swap_used_mb"),
                        ("mac_uptime_days", "uptime_days"), ("mac_disk_used_percent", "disk_used_percent"),
                        ("mac_battery_percent", "battery_percent")):
        rows.append(row(metric, h, py_float_text(F.col(col).cast("double"))))
    for src in ("ac", "battery", "unknown"):
        rows.append(row("mac_power_source", h + f',source="{src}"', F.when(power == src, "1").otherwise("0")))
    rows.append(row("mac_top_process_rss_mb", F.concat(F.lit(h + ',process="'), app, F.lit('"')),
                    fmt_num(rss, 2)))
    rows.append(row("mac_memory_last_run_unixtime", h, F.col("timestamp_unix").cast("string")))
    return evaluated.select("snapshot_id", F.array(*rows).alias("rows"))


def memory_gauges(evaluated: DataFrame, host_label: str = "mba") -> DataFrame:
    """Long form ``(snapshot_id, metric, labels, value)`` of :func:`memory_gauge_rows`."""
    return memory_gauge_rows(evaluated, host_label).select("snapshot_id", F.inline("rows"))


def memory_exposition(evaluated: DataFrame, host_label: str = "mba") -> DataFrame:
    """K5 (memory guard): one text per snapshot."""
    from fleetlens.operators.audits import exposition_text

    return memory_gauge_rows(evaluated, host_label).select("snapshot_id", exposition_text(F.col("rows"), MEMORY_HELP).alias("text"))
