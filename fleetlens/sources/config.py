"""Rule and schedule configuration.

Rules and schedules are small, fixed configuration - they are read on the driver once and become
either compiled Column expressions (first-match) or tiny DataFrames. Optional YAML files with the
same shape can be loaded with :func:`load_rules_yaml` / :func:`load_schedules_yaml`.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# FIXED VALUES - the rule set: order, name, match, action type, chain step names (with retries and
# `when` analysis levels), cooldown seconds. Rule order is evaluation order (first match wins).
_AUDIT_TAIL = [
    {"name": "generate_ai_ops_brief", "analysis_level_in": ["warning", "critical"]},
    {"name": "copy_file_to_mac", "analysis_level_in": ["warning", "critical"]},
    {"name": "notify_tg", "analysis_level_in": ["warning", "critical"]},
]
RULES: list[dict[str, Any]] = [
    {
        "name": "backup_missing_chain",
        "match": {"alertname": "BackupMissing", "status": "firing", "severity": "critical"},
        "action_type": "chain",
        "steps": [
            {"name": "run_backup"},
            {"name": "verify_backup"},
            {"name": "notify_tg", "retries": 3, "retry_delay_seconds": 2,
             "message": "[{{ chain_status|upper }}] {{ alertname }} on {{ instance }}"},
        ],
        "cooldown_seconds": 3600,
    },
    {
        "name": "mac_memory_pressure_warning_notify",
        "match": {"alertname": "MacMemoryPressure", "status": "firing", "severity": "warning"},
        "action_type": "chain",
        "steps": [{"name": "notify_tg", "retries": 3, "retry_delay_seconds": 2,
                   "message": "[MAC][WARNING] {{ instance }} memory pressure"}],
        "cooldown_seconds": 900,
    },
    {
        "name": "mac_memory_pressure_critical_escalate",
        "match": {"alertname": "MacMemoryPressure", "status": "firing", "severity": "critical"},
        "action_type": "chain",
        "steps": [{"name": "notify_tg", "message": "[MAC][CRITICAL] {{ instance }} memory pressure"},
                  {"name": "enqueue_mac_action"}],
        "cooldown_seconds": 300,
    },
    {
        "name": "host_reboot_detected_ignore",
        "match": {"alertname": "HostRebootDetected", "status": "firing"},
        "action_type": "ignore",
        "steps": [],
        "cooldown_seconds": 0,
    },
    {
        "name": "vps_host_audit_daily",
        "match": {"alertname": "VpsHostAuditDaily", "status": "firing", "severity": "info"},
        "action_type": "chain",
        "steps": [{"name": "run_vps_host_audit"}, {"name": "verify_vps_host_audit"},
                  {"name": "analyze_vps_host_audit"}] + _AUDIT_TAIL,
        "cooldown_seconds": 3600,
    },
    {
        "name": "admin_host_audit_daily",
        "match": {"alertname": "AdminHostAuditDaily", "status": "firing", "severity": "info"},
        "action_type": "chain",
        "steps": [{"name": "run_admin_host_audit"}, {"name": "verify_admin_host_audit"},
                  {"name": "analyze_admin_host_audit"}] + _AUDIT_TAIL,
        "cooldown_seconds": 3600,
    },
    {
        "name": "weekly_ops_review_generate",
        "match": {"alertname": "WeeklyOpsReview", "status": "firing", "severity": "info"},
        "action_type": "chain",
        "steps": [{"name": "generate_weekly_ops_review"}, {"name": "copy_file_to_mac"},
                  {"name": "notify_tg", "message": "[WEEKLY] ops review generated"}],
        "cooldown_seconds": 3600,
    },
    {
        "name": "monitoring_stack_audit_daily",
        "match": {"alertname": "MonitoringStackAuditDaily", "status": "firing", "severity": "info"},
        "action_type": "chain",
        "steps": [{"name": "run_monitoring_stack_audit"}, {"name": "verify_monitoring_stack_audit"},
                  {"name": "analyze_monitoring_stack_audit"}] + _AUDIT_TAIL,
        "cooldown_seconds": 3600,
    },
    {
        "name": "mac_host_audit_daily",
        "match": {"alertname": "MacHostAuditDaily", "status": "firing", "severity": "info"},
        "action_type": "chain",
        "steps": [{"name": "verify_mac_host_audit"}, {"name": "analyze_mac_host_audit"}] + _AUDIT_TAIL,
        "cooldown_seconds": 3600,
    },
]

# FIXED VALUES - schedules: name, weekdays (Monday=0; `daily` = all seven), hour, minute, signal.
_DAILY = [0, 1, 2, 3, 4, 5, 6]
SCHEDULES: list[dict[str, Any]] = [
    {"name": "admin_host_audit_daily", "weekdays": _DAILY, "hour": 4, "minute": 0,
     "signal": {"alertname": "AdminHostAuditDaily", "status": "firing", "severity": "info", "instance": "admin",
                "job": "scheduler", "summary": "scheduled daily admin host audit"}},
    {"name": "vps_host_audit_daily", "weekdays": _DAILY, "hour": 4, "minute": 15,
     "signal": {"alertname": "VpsHostAuditDaily", "status": "firing", "severity": "info", "instance": "vps",
                "job": "scheduler", "summary": "scheduled daily vps host audit"}},
    {"name": "monitoring_stack_audit_daily", "weekdays": _DAILY, "hour": 4, "minute": 30,
     "signal": {"alertname": "MonitoringStackAuditDaily", "status": "firing", "severity": "info", "instance": "vps",
                "job": "scheduler", "summary": "scheduled daily monitoring stack audit"}},
    {"name": "mac_host_audit_daily", "weekdays": _DAILY, "hour": 4, "minute": 45,
     "signal": {"alertname": "MacHostAuditDaily", "status": "firing", "severity": "info", "instance": "mba",
                "job": "scheduler", "summary": "scheduled mac host audit"}},
    {"name": "weekly_ops_review", "weekdays": [6], "hour": 5, "minute": 0,
     "signal": {"alertname": "WeeklyOpsReview", "status": "firing", "severity": "info", "instance": "vps",
                "job": "scheduler", "summary": "scheduled weekly ops review"}},
]

STEP_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("retries", T.IntegerType()),
    T.StructField("retry_delay_seconds", T.IntegerType()),
    T.StructField("analysis_level_in", T.ArrayType(T.StringType())),
])
RULE_SCHEMA = T.StructType([
    T.StructField("rule_order", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("match", T.MapType(T.StringType(), T.StringType())),
    T.StructField("action_type", T.StringType()),
    T.StructField("steps", T.ArrayType(STEP_SCHEMA)),
    T.StructField("cooldown_seconds", T.LongType()),
])
SCHEDULE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("weekdays", T.ArrayType(T.IntegerType())),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("signal", T.MapType(T.StringType(), T.StringType())),
])


def normalized_rules(rules: list[dict[str, Any]] | None = None) -> list[dict[str, Any]]:
    """Apply loader defaults: enabled=True, cooldown=0, retries=0, retry_delay=0."""
    out = []
    for i, r in enumerate(rules if rules is not None else RULES):
        steps = [
            {"name": s["name"], "retries": int(s.get("retries", 0)),
             "retry_delay_seconds": int(s.get("retry_delay_seconds", 0)),
             "analysis_level_in": s.get("analysis_level_in"), "message": s.get("message"),
             "payload": s.get("payload") or {}}
            for s in r.get("steps", [])
        ]
        out.append({
            "rule_order": i, "name": r["name"], "enabled": bool(r.get("enabled", True)),
            "match": {str(k): str(v) for k, v in r.get("match", {}).items()},
            "action_type": r["action_type"], "action_name": r.get("action_name"),
            "payload": r.get("payload") or {}, "steps": steps, "cooldown_seconds": int(r.get("cooldown_seconds", 0)),
        })
    return out


def rules_table(spark: SparkSession, rules: list[dict[str, Any]] | None = None) -> DataFrame:
    """The rule list as a tiny DataFrame (bounded by configuration size)."""
    rows = [
        (r["rule_order"], r["name"], r["enabled"], r["match"], r["action_type"],
         [(s["name"], s["retries"], s["retry_delay_seconds"], s["analysis_level_in"]) for s in r["steps"]],
         r["cooldown_seconds"])
        for r in normalized_rules(rules)
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def schedules_table(spark: SparkSession, schedules: list[dict[str, Any]] | None = None) -> DataFrame:
    """Schedules; weekday lists de-duplicated keeping order."""
    rows = []
    for s in schedules if schedules is not None else SCHEDULES:
        days = list(dict.fromkeys(int(d) for d in s["weekdays"]))
        rows.append((s["name"], bool(s.get("enabled", True)), days, int(s["hour"]), int(s["minute"]),
                     {str(k): str(v) for k, v in s.get("signal", {}).items()}))
    return spark.createDataFrame(rows, SCHEDULE_SCHEMA)


def _step_levels(rule: str, at: int, when: Any) -> list[str] | None:
    """The levels of a step's ``when``; anything but ``analysis_level_in`` with at least one level is an error."""
    if when is None:
        return None
    if not isinstance(when, dict) or set(when) - {"analysis_level_in"}:
        raise ValueError(f"rule {rule!r}, step {at}: only analysis_level_in is supported in when")
    if "analysis_level_in" not in when:
        return None
    given = when["analysis_level_in"]
    levels = [str(x).strip() for x in given if str(x).strip()] if isinstance(given, list) else []
    if not levels:
        raise ValueError(f"rule {rule!r}, step {at}: analysis_level_in needs a list of levels")
    return levels


def load_rules_yaml(path: str) -> list[dict[str, Any]]:
    """Read a rules YAML file (``rules: [...]``) into the normalized rule list; conditions and payloads stay."""
    import yaml

    with open(path, encoding="utf-8") as fh:
        doc = yaml.safe_load(fh) or {}
    rules = []
    for r in doc.get("rules", []):
        action = r.get("action", {})
        steps = [{**s, "analysis_level_in": _step_levels(r["name"], i, s.get("when"))} for i, s in enumerate(action.get("steps", []), 1)]
        rules.append({
            "name": r["name"], "enabled": r.get("enabled", True), "match": r.get("match", {}),
            "action_type": action.get("type"), "action_name": action.get("name"), "payload": action.get("payload"),
            "steps": steps, "cooldown_seconds": r.get("cooldown_seconds", 0),
        })
    return normalized_rules(rules)


def _weekdays(s: dict[str, Any]) -> list[int]:
    """Exactly one of ``daily``, ``weekdays`` and ``weekday``; days from 0 (Monday) to 6, each once."""
    modes = [bool(s.get("daily", False)), "weekdays" in s, "weekday" in s]
    if sum(modes) != 1:
        raise ValueError(f"schedule {s.get('name')!r} needs one of daily, weekdays and weekday")
    days = list(range(7)) if modes[0] else s["weekdays"] if modes[1] else [s["weekday"]]
    if not isinstance(days, list) or not days or not all(str(d).lstrip("-").isdigit() and 0 <= int(d) <= 6 for d in days):
        raise ValueError(f"schedule {s.get('name')!r}: weekdays are numbers from 0 to 6")
    return list(dict.fromkeys(int(d) for d in days))


def load_schedules_yaml(path: str) -> list[dict[str, Any]]:
    import yaml

    with open(path, encoding="utf-8") as fh:
        doc = yaml.safe_load(fh) or {}
    return [{"name": s["name"], "enabled": s.get("enabled", True), "weekdays": _weekdays(s),
             "hour": s["hour"], "minute": s["minute"], "signal": s.get("signal", {})} for s in doc.get("schedules", [])]
