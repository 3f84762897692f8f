"""Queries over the configured registries: audit handlers (U1) and rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators import registry as REG
from fleetlens.plans import admin_queries, audit_queries, mac_queries  # noqa: F401  the oracles of the domains
from fleetlens.plans.registry import ORACLE, query
from fleetlens.plans.signal_queries import FIRST_MATCH_CTE, decided
from fleetlens.sources import fixtures as fx
from fleetlens.sources.config import RULES, rules_table

#: Audit domain -> its records, id column and level column.
_RECORDS = {"vps_host_audit": (fx.kv_logs, "log_id", "level"), "monitoring_stack_audit": (fx.kv_logs, "log_id", "level"),
            "admin_host_audit": (fx.admin_logs, "log_id", "overall"), "mac_host_audit": (fx.snapshots, "snapshot_id", "level")}
_LEVELS = {"vps_host_audit": "vps_levels", "monitoring_stack_audit": "stack_levels", "admin_host_audit": "admin_levels", "mac_host_audit": "mac_levels"}


@query("fleet_levels", " UNION ALL ".join(
    f"SELECT '{d}' AS domain, {_RECORDS[d][1]} AS record_id, {_RECORDS[d][2]} AS level, findings_count FROM ({ORACLE[name]}) {name}" for d, name in _LEVELS.items()))
def q_fleet_levels(spark, sf_dir):
    """Every domain's records through its registered handler."""
    parts = [REG.analyze(d, read(spark, sf_dir)).select(F.lit(d).alias("domain"), F.col(key).alias("record_id"), F.col(level).alias("level"), "findings_count")
             for d, (read, key, level) in _RECORDS.items()]
    return reduce(DataFrame.unionByName, parts)


_RULE_ROWS = ", ".join(f"({i}, '{r['name']}', {bool(r.get('enabled', True))}, {int(r.get('cooldown_seconds', 0))})" for i, r in enumerate(RULES))


@query("rule_usage", f"""WITH {FIRST_MATCH_CTE},
r(rule_order, name, enabled, cooldown_seconds) AS (VALUES {_RULE_ROWS})
SELECT r.rule_order, r.name, r.enabled, r.cooldown_seconds, count(d.signal_id) AS signals, count(DISTINCT d.alert_key) AS keys
FROM r LEFT JOIN d ON d.rule_name = r.name GROUP BY ALL
""", ctes=("sig0", "signals"))
def q_rule_usage(spark, sf_dir):
    """The rule table with how many signals and alert keys each rule matched, unused ones too."""
    used = decided(spark, sf_dir).groupBy("rule_name").agg(F.count(F.lit(1)).alias("signals"), F.count_distinct("alert_key").alias("keys"))
    rules = rules_table(spark).select("rule_order", "name", "enabled", F.col("cooldown_seconds").cast("int").alias("cooldown_seconds"))
    out = rules.join(used, rules["name"] == used["rule_name"], "left")
    return out.select("rule_order", "name", "enabled", "cooldown_seconds", F.coalesce("signals", F.lit(0)).alias("signals"), F.coalesce("keys", F.lit(0)).alias("keys"))
