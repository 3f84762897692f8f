"""Weekly operations rollup.

One function per part of the weekly document; each takes the operational tables and an explicit
``as_of`` / ``days`` window. Limits are the feature (the report shows the newest N rows) and are kept
in the reference's order: **limit first, then filter** where the reference filters in Python after
its SQL ``LIMIT`` (L3, L5, W5). Per-domain limits use ``row_number() <= n``, which Spark plans with a
partial group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.text import py_strip, split_findings
from fleetlens.functions.timefn import as_of_lit, fmt_utc, in_window

# FIXED VALUES - weekly report exclusions, allow-lists and noise patterns.
EXCLUDED_ALERTNAMES = [
    "AdminHostAuditWeekly",
    "AdminHostAuditDaily",
    "VpsHostAuditDaily",
    "MonitoringStackAuditDaily",
    "WeeklyOpsReview",
    "HostRebootDetected",
]
EXCLUDED_ALERT_PREFIXES = ["Demo"]
EXCLUDED_SEVERITIES = ["ok"]
EXCLUDED_FAILURE_ACTIONS = ["generate_weekly_ops_review", "notify_email"]
INCLUDED_OPERATIONAL_ACTIONS = [
    "run_backup",
    "verify_backup",
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
    "generate_ai_ops_brief",
    "notify_tg",
    "enqueue_mac_action",
    "copy_file_to_mac",
]
LEGACY_AUDIT_SUMMARY_PATTERNS = [
    "infra-backups path missing",
    "infra-backups tar/sha256 counts do not match",
    "backup path missing",
    "backup path not writable",
    "backup configs age",
]
WEEKLY_NOISE_PATTERNS = [
    "broadcom wifi watchdog events detected",
    "recent kernel wifi watchdog/errors detected",
]
UPGRADABLE_NOISE_THRESHOLD = 5
RECENT_FAILURE_LOOKBACK_HOURS = 24
# (domain, analyze action, clean legacy findings, reviews per week)
AUDIT_DOMAINS = [
    ("admin_host_audit", "analyze_admin_host_audit", True, 30),
    ("vps_host_audit", "analyze_vps_host_audit", False, 30),
    ("monitoring_stack_audit", "analyze_monitoring_stack_audit", False, 30),
    ("mac_host_audit", "analyze_mac_host_audit", False, 30),
]

RESULT_JSON_GREEDY = r"(?s)RESULT_JSON:(\{.*\})"
RESULT_JSON_ANCHORED = r"(?s)RESULT_JSON:(\{.*\})$"


# ----------------------------------------------------------------------------- S8, P35

def result_json_text(stdout, anchored: bool = False) -> Column:
    """The JSON object text after ``RESULT_JSON:`` (greedy, DOTALL); null when absent.

    The anchored variant (executor) requires the object to end the (right-stripped) output.
    """
    s = F.coalesce(F.col(stdout) if isinstance(stdout, str) else stdout, F.lit(""))
    if anchored:
        s = F.regexp_replace(s, r"\s+$", "")
    g = F.regexp_extract(s, RESULT_JSON_ANCHORED if anchored else RESULT_JSON_GREEDY, 1)
    return F.nullif(g, F.lit(""))


def result_json_map(stdout, anchored: bool = False) -> Column:
    """S8 + P35: parsed trailer as map<string,string>; bad JSON / non-object -> null."""
    return F.from_json(result_json_text(stdout, anchored), "map<string,string>", {"mode": "PERMISSIVE"})


# ----------------------------------------------------------------------------- F2-F8

def is_excluded_alert(alertname: Column, severity: Column) -> Column:
    """F2."""
    name = F.coalesce(alertname, F.lit(""))
    return ((name == "") | F.coalesce(severity, F.lit("")).isin(*EXCLUDED_SEVERITIES)
            | name.isin(*EXCLUDED_ALERTNAMES)
            | F.exists(F.array(*[F.lit(p) for p in EXCLUDED_ALERT_PREFIXES]), lambda p: name.startswith(p)))


def is_operational_failure(action: Column) -> Column:
    """F3."""
    a = F.coalesce(action, F.lit(""))
    return (a != "") & ~a.isin(*EXCLUDED_FAILURE_ACTIONS) & a.isin(*INCLUDED_OPERATIONAL_ACTIONS)


def is_legacy_finding(f: Column) -> Column:
    """F4."""
    low = F.lower(f)
    return F.exists(F.array(*[F.lit(p) for p in LEGACY_AUDIT_SUMMARY_PATTERNS]), lambda p: low.contains(p))


def is_weekly_noise(f: Column) -> Column:
    """empty, 'ok:no findings', wifi watchdog lines, or <= 5 upgradable packages."""
    low = F.lower(py_strip(F.coalesce(f, F.lit(""))))
    m = F.regexp_extract(low, r"^(warning|critical):(\d+)\s+upgradable packages?$", 2)
    return ((low == "") | (low == "ok:no findings")
            | F.exists(F.array(*[F.lit(p) for p in WEEKLY_NOISE_PATTERNS]), lambda p: low.contains(p))
            | ((m != "") & (m.try_cast("long") <= UPGRADABLE_NOISE_THRESHOLD)))


def clean_summary(summary: Column, clean_legacy) -> Column:
    """split -> drop legacy (admin only) -> drop noise -> rejoin with '; '."""
    parts = split_findings(summary)
    legacy = parts if clean_legacy is False else F.filter(parts, lambda x: ~is_legacy_finding(x))
    if not isinstance(clean_legacy, bool):
        legacy = F.when(clean_legacy, F.filter(parts, lambda x: ~is_legacy_finding(x))).otherwise(parts)
    kept = F.filter(legacy, lambda x: ~is_weekly_noise(x))
    return F.array_join(kept, "; ")


# ----------------------------------------------------------------------------- A7, A8, A2, A3

def window_totals(decisions: DataFrame, tasks: DataFrame, runs: DataFrame, as_of_events: str, as_of_runs: str,
                  days: int = 7) -> DataFrame:
    """Three counts in the closed window (one row, one aggregation over the tagged union)."""
    d = decisions.where(in_window("ts", as_of_events, days)).select(F.lit(0).alias("src"))
    t = tasks.where(in_window("created_at", as_of_events, days)).select(F.lit(1).alias("src"))
    r = runs.where(in_window("started_at", as_of_runs, days)).select(F.lit(2).alias("src"))
    u = d.unionByName(t).unionByName(r)
    return u.agg(F.count_if(F.col("src") == 0).alias("decisions"), F.count_if(F.col("src") == 1).alias("tasks"),
                 F.count_if(F.col("src") == 2).alias("runs"))


def top_alerts(decisions: DataFrame, as_of: str, days: int = 7, n: int = 10) -> DataFrame:
    """Count by (alertname, severity) in the window, excluded alerts dropped, top n."""
    g = (decisions.where(in_window("ts", as_of, days)).groupBy("alertname", "severity")
         .agg(F.count(F.lit(1)).alias("count")))
    return (g.where(~is_excluded_alert(F.col("alertname"), F.col("severity")))
            .orderBy(F.col("count").desc(), F.col("alertname").asc(), F.col("severity").asc()).limit(n))


def weekly_task_status(tasks: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """A2 (weekly): task counts by (type, status) in the window, running dropped."""
    return (tasks.where(in_window("created_at", as_of, days) & (F.col("status") != "running"))
            .groupBy("task_type", "status").agg(F.count(F.lit(1)).alias("count")))


def weekly_run_status(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """A3 (weekly): run counts by (action, status); running / skipped / excluded actions dropped."""
    return (runs.where(in_window("started_at", as_of, days) & ~F.col("status").isin("running", "skipped")
                       & ~F.coalesce(F.col("action"), F.lit("")).isin(*EXCLUDED_FAILURE_ACTIONS))
            .groupBy("action", "status").agg(F.count(F.lit(1)).alias("count")))


# ----------------------------------------------------------------------------- L2-L5, A13

def _run_row(r: DataFrame) -> DataFrame:
    return r.select("id", "action", "status", fmt_utc("started_at").alias("started_at"),
                    fmt_utc("finished_at").alias("finished_at"), "exit_code",
                    F.coalesce("error", F.lit("")).alias("error"))


def backup_runs(runs: DataFrame, as_of: str, days: int = 7, n: int = 50) -> DataFrame:
    """L2."""
    r = runs.where(F.col("action").isin("run_backup", "verify_backup") & in_window("started_at", as_of, days)
                   & ~F.col("status").isin("running", "skipped"))
    return _run_row(r.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(n))


def mac_alerts(decisions: DataFrame, as_of: str, days: int = 7, n: int = 80) -> DataFrame:
    """L3: newest n MacMemoryPressure decisions, *then* F16 (severity not ok, no 'synthetic')."""
    d = decisions.where((F.col("alertname") == "MacMemoryPressure") & in_window("ts", as_of, days))
    head = d.orderBy(F.col("ts").desc(), F.col("signal_id").desc()).limit(n)
    keep = (~F.coalesce(F.col("severity"), F.lit("")).isin(*EXCLUDED_SEVERITIES)
            & ~F.lower(F.coalesce(F.col("summary"), F.lit(""))).contains("synthetic"))
    return head.where(keep).select(F.col("signal_id").alias("id"), "severity", "summary", "decision", "reason",
                                   fmt_utc("ts").alias("created_at"))


def mac_actions(tasks: DataFrame, as_of: str, days: int = 7, n: int = 50) -> DataFrame:
    """L4: newest n finished mac_action tasks with result fields projected (bad JSON -> {})."""
    t = tasks.where((F.col("task_type") == "mac_action") & in_window("created_at", as_of, days)
                    & (F.col("status") != "running"))
    head = t.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)
    rj = F.from_json("result_json", "map<string,string>", {"mode": "PERMISSIVE"})
    return head.select(
        "id", "status", fmt_utc("created_at").alias("created_at"), fmt_utc("finished_at").alias("finished_at"),
        F.coalesce("error", F.lit("")).alias("error"), rj.alias("rj"),
    ).select("id", "status", "created_at", "finished_at", "error",
             F.coalesce(F.col("rj")["action"], F.lit("")).alias("action"),
             F.coalesce(F.col("rj")["target"], F.lit("")).alias("target"),
             F.coalesce(F.col("rj")["status"], F.lit("")).alias("result_status"),
             F.col("rj")["rss_mb"].try_cast("double").alias("rss_mb"))


def latest_failures(runs: DataFrame, as_of: str, days: int = 7, n_sql: int = 50, n_keep: int = 15) -> DataFrame:
    """Newest 50 failed runs, *then* F3, *then* the first 15 (rank kept as ``failure_rank``)."""
    f = runs.where(in_window("started_at", as_of, days) & (F.col("status") == "failed"))
    head = f.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(n_sql)
    kept = head.where(is_operational_failure(F.col("action")))
    w = Window.orderBy(F.col("started_at").desc(), F.col("id").desc())  # <= 50 rows: single-partition is fine
    ranked = kept.withColumn("failure_rank", F.row_number().over(w)).where(F.col("failure_rank") <= n_keep)
    return ranked.select("id", "action", "status", fmt_utc("started_at").alias("started_at"),
                         fmt_utc("finished_at").alias("finished_at"), "exit_code",
                         F.coalesce("error", F.lit("")).alias("error"), "failure_rank",
                         F.col("started_at").alias("_st"))


def recent_failure_count(failures: DataFrame, as_of: str, hours: int = RECENT_FAILURE_LOOKBACK_HOURS) -> DataFrame:
    """Failures started at or after as_of - hours (among ``latest_failures``)."""
    threshold = as_of_lit(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return failures.agg(F.count(F.when(F.col("_st") >= threshold, F.lit(1))).alias("recent_failure_count"))


# ----------------------------------------------------------------------------- L6, W1, W3, A9, A10, A14

def audit_domains_table(spark) -> DataFrame:
    return spark.createDataFrame(AUDIT_DOMAINS, "domain string, action string, clean_legacy boolean, max_reviews int")


_REVIEW_FIELDS = ["id", "status", "started_at", "finished_at", "exit_code", "error", "analysis_level",
                  "analysis_findings_count", "analysis_summary", "analysis_log_path", "metrics_path"]


def _analyze_runs(runs: DataFrame, as_of: str, days: int) -> DataFrame:
    dom = audit_domains_table(runs.sparkSession)
    return runs.where(in_window("started_at", as_of, days) & (F.col("status") != "running")).join(F.broadcast(dom), "action")


def _normalised(r: DataFrame) -> DataFrame:
    """F7 and the level fallback, per run (no shuffle)."""
    rj = result_json_map("stdout")
    r = r.withColumn("rj", rj)
    raw = F.coalesce(F.col("rj")["analysis_summary"], F.lit(""))
    r = r.withColumn("cleaned", clean_summary(raw, F.col("clean_legacy")))
    meaningful = F.col("status").isin("failed", "success") | (F.col("cleaned") != "")
    r = r.where(meaningful)
    lvl0 = F.coalesce(F.col("rj")["analysis_level"], F.lit(""))
    lvl1 = (F.when(lvl0 != "", lvl0).when(F.col("status") == "failed", F.lit("critical"))
            .when(F.col("cleaned") != "", F.lit("warning")).otherwise(F.lit("ok")))
    empty = F.col("cleaned") == ""
    level = F.when(empty & (F.col("status") == "success"), F.lit("ok")).otherwise(lvl1)
    return r.select(
        *(["review_rank"] if "review_rank" in r.columns else []), "domain", "id", "status", fmt_utc("started_at").alias("started_at"),
        fmt_utc("finished_at").alias("finished_at"), "exit_code", F.coalesce("error", F.lit("")).alias("error"),
        level.alias("analysis_level"),
        F.when(empty, F.lit(0)).otherwise(F.size(split_findings(F.col("cleaned")))).cast("long")
        .alias("analysis_findings_count"),
        F.when(empty, F.lit("ok:no findings")).otherwise(F.col("cleaned")).alias("analysis_summary"),
        F.coalesce(F.col("rj")["analysis_log_path"], F.lit("")).alias("analysis_log_path"),
        F.coalesce(F.col("rj")["metrics_path"], F.lit("")).alias("metrics_path"),
    )


def all_reviews(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Every non-running analyze run of the window, normalised: what gates (F9, F15) and briefs (U5, K8) read."""
    return _normalised(_analyze_runs(runs, as_of, days)).select("domain", *_REVIEW_FIELDS)


def audit_reviews(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Per audit domain the newest 30 non-running analyze runs, normalised:

    cleaned summary (F7), findings count, level fallback (failed -> critical, findings -> warning,
    else ok), empty -> 'ok:no findings' (and level ok when the run succeeded). ``review_rank`` is the
    position in the domain's started_at-desc list.
    """
    r = _analyze_runs(runs, as_of, days)
    w = Window.partitionBy("domain").orderBy(F.col("started_at").desc(), F.col("id").desc())
    # the literal bound (largest configured limit) lets Spark cut each domain map-side before the shuffle
    # (partial group limit); the per-domain limit is then applied exactly
    bound = max(d[3] for d in AUDIT_DOMAINS)
    r = (r.withColumn("review_rank", F.row_number().over(w)).where(F.col("review_rank") <= bound)
         .where(F.col("review_rank") <= F.col("max_reviews")))
    return _normalised(r).select("domain", "review_rank", *_REVIEW_FIELDS)


def domain_rollup(reviews: DataFrame) -> DataFrame:
    """A9 + W1 + W3: per domain counts by level, latest review, latest non-ok review.
    Domains without reviews give zero counts and level ``unknown`` (left join from the domain list)."""
    spark = reviews.sparkSession
    dom = audit_domains_table(spark).select("domain")
    lvl = F.col("analysis_level")
    agg = reviews.groupBy("domain").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count(F.when(lvl == "ok", 1)).alias("ok_count"),
        F.count(F.when(lvl == "warning", 1)).alias("warning_count"),
        F.count(F.when(lvl == "critical", 1)).alias("critical_count"),
        F.min_by(F.struct("analysis_level", "analysis_summary", "started_at"), F.col("review_rank")).alias("latest"),
        F.min_by(F.when(lvl.isin("warning", "critical"), F.struct("id", "analysis_level", "started_at")),
                 F.when(lvl.isin("warning", "critical"), F.col("review_rank"))).alias("latest_non_ok"),
    )
    out = F.broadcast(dom).join(agg, "domain", "left")
    return out.select(
        "domain",
        F.coalesce("total_runs", F.lit(0)).cast("long").alias("total_runs"),
        F.coalesce("ok_count", F.lit(0)).cast("long").alias("ok_count"),
        F.coalesce("warning_count", F.lit(0)).cast("long").alias("warning_count"),
        F.coalesce("critical_count", F.lit(0)).cast("long").alias("critical_count"),
        F.coalesce(F.col("latest.analysis_level"), F.lit("unknown")).alias("latest_level"),
        F.coalesce(F.col("latest.analysis_summary"), F.lit("")).alias("latest_summary"),
        F.coalesce(F.col("latest.started_at"), F.lit("")).alias("latest_started_at"),
        F.col("latest_non_ok.id").alias("latest_non_ok_id"),
        F.col("latest_non_ok.analysis_level").alias("latest_non_ok_level"),
    )


def recurring_findings(reviews: DataFrame, n: int = 5) -> DataFrame:
    """A10: findings of the cleaned summaries, noise dropped, counted per domain; top n per domain,
    ties broken by first appearance (review order, then position in the summary)."""
    ex = reviews.select("domain", "review_rank",
                        F.posexplode(split_findings(F.col("analysis_summary"))).alias("pos", "finding"))
    ex = ex.where(~is_weekly_noise(F.col("finding")))
    g = ex.groupBy("domain", "finding").agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.struct("review_rank", "pos")).alias("first_seen"))
    w = Window.partitionBy("domain").orderBy(F.col("count").desc(), F.col("first_seen").asc())
    return (g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("domain", "rank", "finding", "count"))


def all_domains_ok(rollup: DataFrame) -> DataFrame:
    """Every domain's latest level is ok; no domains -> false."""
    return rollup.agg((F.coalesce(F.bool_and(F.col("latest_level") == "ok"), F.lit(False))
                       & (F.count(F.lit(1)) > 0)).alias("all_domains_ok"))


# ----------------------------------------------------------------------------- W5, J5, A15

BRIEF_SOURCES_WITH_AUDIT_DOMAINS = [d[0] for d in AUDIT_DOMAINS]


def latest_briefs(runs: DataFrame, as_of: str, days: int = 7, n: int = 30) -> DataFrame:
    """Newest 30 successful brief runs, *then* drop runs without a path, then first per source."""
    r = runs.where((F.col("action") == "generate_ai_ops_brief") & in_window("started_at", as_of, days)
                   & (F.col("status") == "success"))
    head = r.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(n)
    rj = result_json_map("stdout")
    b = head.select("id", "status", "started_at", "finished_at", "exit_code", rj.alias("rj"))
    b = b.select(
        "id", "status", "started_at", "finished_at", "exit_code", "rj",
        F.coalesce(F.nullif(py_strip(F.coalesce(F.col("rj")["source"], F.lit(""))), F.lit("")),
                   F.lit("unknown")).alias("source"),
        F.coalesce(F.col("rj")["markdown_path"], F.lit("")).alias("markdown_path"),
        F.coalesce(F.col("rj")["json_path"], F.lit("")).alias("json_path"),
        F.coalesce(F.col("rj")["brief_status"], F.lit("")).alias("brief_status"),
        F.coalesce(F.col("rj")["executive_summary"], F.lit("")).alias("executive_summary"),
    )
    b = b.where(F.col("rj").isNotNull() & (F.size("rj") > 0)
                & ((F.col("markdown_path") != "") | (F.col("json_path") != ""))).drop("rj")
    w = Window.partitionBy("source").orderBy(F.col("started_at").desc(), F.col("id").desc())
    first = b.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return first


def fresh_briefs(briefs: DataFrame, rollup: DataFrame) -> DataFrame:
    """Drop a domain brief when the domain's latest level is ok and the brief is older than the
    latest review (or either time is missing); sources outside the audit domains pass."""
    ro = rollup.select(F.col("domain").alias("source"), "latest_level",
                       F.try_to_timestamp(F.nullif(F.col("latest_started_at"), F.lit("")),
                                          F.lit("yyyy-MM-dd HH:mm:ss 'UTC'")).alias("latest_ts"))
    j = briefs.join(F.broadcast(ro), "source", "left")
    is_domain = F.col("source").isin(*BRIEF_SOURCES_WITH_AUDIT_DOMAINS)
    stale = (F.col("latest_level") == "ok") & (
        F.col("started_at").isNull() | F.col("latest_ts").isNull() | (F.col("started_at") < F.col("latest_ts")))
    keep = ~is_domain | (F.col("latest_level").isNotNull() & ~F.coalesce(stale, F.lit(False)))
    return j.where(keep).drop("latest_level", "latest_ts")


# FIXED VALUE - the note on a recovered posture.
RECOVERED_NOTE = (" Current posture across admin_host_audit, vps_host_audit, monitoring_stack_audit, and "
                  "mac_host_audit is now ok; remaining risk is mainly historical instability and recurrence prevention.")


def all_domains_ok_by(rollup: DataFrame, by: str, domains: list[str]) -> DataFrame:
    """A14 per group: every one of ``domains`` has a latest level, and it is ok."""
    ok = F.count_if(F.col("domain").isin(*domains) & (F.col("latest_level") == "ok"))
    return rollup.groupBy(by).agg((ok == len(domains)).alias("all_domains_ok"))


def posture_adjust(week_status: Column, executive_summary: Column, all_ok: Column) -> tuple[Column, Column]:
    """Risky -> watch and a recovered note appended when every domain is ok now."""
    note = RECOVERED_NOTE
    status = F.when(all_ok & (week_status == "risky"), F.lit("watch")).otherwise(week_status)
    summ = F.when(all_ok & (F.coalesce(executive_summary, F.lit("")) != "")
                  & ~executive_summary.contains(note.strip()),
                  F.concat(F.regexp_replace(executive_summary, r"\s+$", ""), F.lit(note))).otherwise(executive_summary)
    return status, summ


# FIXED VALUES - audit domain titles in the weekly document, in document order.
AUDIT_DOMAIN_TITLES = [
    ("admin_host_audit", "Admin host audit"),
    ("vps_host_audit", "VPS host audit"),
    ("monitoring_stack_audit", "Monitoring stack audit"),
    ("mac_host_audit", "Mac host audit"),
]


def audit_domain_report_lines(rollup: DataFrame, recurring: DataFrame) -> DataFrame:
    """K7 (audit-domain section): markdown lines ``(domain_order, line_order, line)`` per domain from its
    rollup and top recurring findings. Bounded per domain: the recurring list is already top-5."""
    spark = rollup.sparkSession
    titles = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(AUDIT_DOMAIN_TITLES)],
                                   "domain_order int, domain string, title string")
    rec = recurring.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("rank", "finding", "count")))
                                          .alias("rec"))
    r = rollup.join(F.broadcast(titles), "domain").join(rec, "domain", "left")
    items = F.transform(F.coalesce("rec", F.array().cast("array<struct<rank:int,finding:string,count:bigint>>")),
                        lambda x: F.concat(F.lit("  - "), x["finding"], F.lit(" ("), x["count"].cast("string"),
                                           F.lit(")")))
    head = F.array(
        F.concat(F.lit("### "), F.col("title")), F.lit(""),
        F.concat(F.lit("- Runs: "), F.col("total_runs").cast("string")),
        F.concat(F.lit("- OK: "), F.col("ok_count").cast("string")),
        F.concat(F.lit("- Warning: "), F.col("warning_count").cast("string")),
        F.concat(F.lit("- Critical: "), F.col("critical_count").cast("string")),
        F.concat(F.lit("- Current posture: "), F.col("latest_level")),
        F.when(F.col("latest_summary") != "", F.concat(F.lit("- Latest summary: "), F.col("latest_summary"))),
        F.when(F.col("latest_started_at") != "", F.concat(F.lit("- Latest run: "), F.col("latest_started_at"))),
        F.when(F.size(items) > 0, F.lit("- Recurring findings:")))
    lines = F.filter(F.concat(head, items, F.array(F.lit(""))), lambda x: x.isNotNull())
    return r.select("domain_order", F.posexplode(lines).alias("line_order", "line"))
