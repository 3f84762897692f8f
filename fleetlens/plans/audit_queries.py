"""Audit queries over key=value logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import audits as AU
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

# ------------------------------------------------------------------ DuckDB side: facts, then checks


def _facts_keys() -> list[str]:
    keys = []
    for spec in fx.KV_LINES:
        s = spec[2] if spec[0] == "opt" else spec
        if s[0] == "lit":
            if "=" in s[1] and not s[1].startswith("==="):
                keys.append(s[1].split("=", 1)[0].strip())
        elif s[0] == "raw_mod":
            keys.append(s[1].split("=", 1)[0].strip())
        else:
            keys.append(s[1])
    extra = ["unit_caddy_service_active", "container_loki_exists", "prometheus_target_action_runner_up",
             "container_loki_health", "container_promtail_health", "container_tg_relay_status",
             "container_alertmanager_status", "container_grafana_status", "container_loki_status",
             "container_promtail_status", "container_demo_app_status", "container_tg_relay_status"]
    out = []
    for k in keys + extra + AU.STACK_REQUIRED_VERIFY_KEYS:
        if k not in out:
            out.append(k)
    return out


FACT_KEYS = _facts_keys()

FACTS_SQL = """
kvl AS (
  SELECT k.log_id, k.host, trim(l.raw) AS line, l.pos
  FROM kv_logs k, unnest(string_split(k.text, chr(10))) WITH ORDINALITY AS l(raw, pos)
),
kvp AS (
  SELECT log_id, host, trim(substr(line, 1, strpos(line, '=') - 1)) AS key,
         trim(substr(line, strpos(line, '=') + 1)) AS value, pos
  FROM kvl WHERE line <> '' AND NOT starts_with(line, '===') AND strpos(line, '=') > 0
),
facts AS (SELECT log_id, host, key, arg_max(value, pos) AS value FROM kvp GROUP BY log_id, host, key),
fw AS (
  SELECT l.log_id, l.host, """ + ",\n    ".join(
    f"max(f.value) FILTER (WHERE f.key = '{k}') AS \"{k}\"" for k in FACT_KEYS) + """
  FROM kv_logs l LEFT JOIN facts f ON f.log_id = l.log_id GROUP BY l.log_id, l.host
)"""


def _q(k):
    return f'"{k}"'


def _is(k, v):
    return f"coalesce({_q(k)} = '{v}', false)"


def _in(k, vals):
    lits = ", ".join(f"'{x}'" for x in vals if x is not None)
    cond = f"coalesce({_q(k)} IN ({lits}), false)"
    return f"({cond} OR {_q(k)} IS NULL)" if None in vals else cond


def _unk(k):
    return f"coalesce(nullif({_q(k)}, ''), 'unknown')"


def _flt(k):
    return f"TRY_CAST({_q(k)} AS DOUBLE)"


def _int(k):
    return f"CAST(trunc(TRY_CAST({_q(k)} AS DOUBLE)) AS BIGINT)"


def _s(x):
    return "'" + x.replace("'", "''") + "'"


def _vps_checks() -> list[tuple[str, str, str, str]]:
    """(condition, severity, kind expr, message expr) in source order."""
    c = []
    for unit, label in AU.VPS_CRITICAL_UNITS:
        key = "unit_" + unit.replace("-", "_").replace(".", "_") + "_active"
        c.append((f"NOT {_is(key, 'active')}", "critical", _s(f"{label}_unit"),
                  f"'systemd unit {unit} is ' || {_unk(key)}"))
    c.append((f"NOT {_is('unit_fail2ban_service_active', 'active')}", "warning", "'fail2ban_inactive'",
              "'fail2ban inactive'"))
    c.append(("coalesce(\"docker_reachable\", 'no') <> 'yes'", "critical", "'docker_daemon_down'",
              "'docker daemon unreachable'"))
    for p in AU.VPS_CRITICAL_PROBES:
        c.append((f"NOT {_is(p, 'ok')}", "critical", _s(p), _s(p.replace("_probe", "") + " probe failed")))
    c.append((f"NOT {_is('tg_relay_probe', 'ok')}", "warning", "'tg_relay_probe'", "'tg-relay probe failed'"))
    for key, kind, text, unit in (("root_used_percent", "root_disk_high", "root disk used ", "%"),
                                  ("root_inode_used_percent", "root_inode_high", "root inode used ", "%"),
                                  ("swap_used_mb", "swap_high", "swap used ", "MB")):
        crit, warn = (2048, 1024) if key == "swap_used_mb" else (92, 85)
        msg = f"'{text}' || printf('%.0f', {_flt(key)}) || '{unit}'"
        c.append((f"{_flt(key)} >= {crit}", "critical", _s(kind), msg))
        c.append((f"{_flt(key)} < {crit} AND {_flt(key)} >= {warn}", "warning", _s(kind), msg))
    c.append((f"{_int('journal_p3_count')} >= 100", "warning", "'journal_errors'",
              f"'journal priority<=3 count ' || CAST({_int('journal_p3_count')} AS VARCHAR)"))
    c.append((_is("reboot_required", "yes"), "warning", "'reboot_required'", "'reboot required'"))
    u = f"coalesce({_int('docker_unhealthy_containers')}, 0)"
    r = f"coalesce({_int('docker_restarting_containers')}, 0)"
    c.append((f"{u} >= 2", "critical", "'docker_unhealthy'", f"CAST({u} AS VARCHAR) || ' unhealthy containers'"))
    c.append((f"{u} = 1", "warning", "'docker_unhealthy'", f"CAST({u} AS VARCHAR) || ' unhealthy containers'"))
    c.append((f"{r} >= 1", "warning", "'docker_restarting'", f"CAST({r} AS VARCHAR) || ' restarting containers'"))
    for name in AU.VPS_CRITICAL_CONTAINERS:
        b = "container_" + name.replace("-", "_")
        miss = _is(b + "_exists", "no")
        run = _in(b + "_state", ["running"])
        c.append((miss, "critical", _s(f"{name}_missing"), _s(f"container {name} missing")))
        c.append((f"NOT {miss} AND NOT {run}", "critical", _s(f"{name}_state"),
                  f"'container {name} state ' || {_unk(b + '_state')}"))
        c.append((f"NOT {miss} AND {run} AND NOT {_in(b + '_health', AU.HEALTHY_HEALTH)}", "critical",
                  _s(f"{name}_health"), f"'container {name} health ' || {_q(b + '_health')}"))
    demo = _is("container_demo_app_exists", "yes")
    drun = _in("container_demo_app_state", ["running"])
    c.append((f"{demo} AND NOT {drun}", "warning", "'demo_app_state'",
              f"'container demo-app state ' || {_unk('container_demo_app_state')}"))
    c.append((f"{demo} AND {drun} AND NOT {_in('container_demo_app_health', AU.HEALTHY_HEALTH)}", "warning",
              "'demo_app_health'", "'container demo-app health ' || \"container_demo_app_health\""))
    unk = _is("ufw_status", "unknown")
    c.append((unk, "warning", "'ufw_status_unavailable'", "'ufw status unavailable for audit'"))
    c.append((f"NOT {unk} AND NOT {_is('ufw_status', 'active')}", "critical", "'ufw_inactive'",
              f"'ufw status is ' || {_unk('ufw_status')}"))
    c.append((f"NOT {unk} AND NOT {_in('ufw_default_incoming', ['deny'])}", "critical", "'ufw_default_incoming'",
              f"'ufw incoming default is ' || {_unk('ufw_default_incoming')}"))
    for key, label in AU.VPS_UFW_PORTS:
        c.append((f"NOT {unk} AND {_is(key, 'no')}", "warning", _s(f"{label}_ufw_missing"),
                  _s(f"ufw rule missing for {label}")))
    ts = _in("tailscale_serve_status", ["ok"])
    c.append((f"NOT {ts}", "warning", "'tailscale_serve_status'", "'tailscale serve status unavailable'"))
    for port in AU.VPS_TAILSCALE_PORTS:
        c.append((f"{ts} AND NOT {_is('tailscale_serve_port_' + port, 'yes')}", "warning",
                  _s(f"tailscale_serve_{port}"), _s(f"tailscale serve missing port {port}")))
    return c


def _probe_ok(k):
    vals = ", ".join(f"'{v}'" for v in AU.PROBE_OK_VALUES)
    return f"coalesce(lower(trim({_q(k)})), '') IN ({vals})"


def _stack_checks() -> list[tuple[str, str, str, str]]:
    c = []
    failed = " + ".join(f"CAST({_is(f'container_{n}_status', 'inspect_failed')} AS INTEGER)"
                        for n in AU.STACK_ALL_CONTAINERS)
    c.append((f"({failed}) > 0", "critical", "'docker_inspect_unavailable'",
              f"'docker inspect failed for ' || CAST(({failed}) AS VARCHAR) || ' containers'"))
    for sev, names in (("critical", AU.STACK_CORE_CONTAINERS), ("warning", AU.STACK_WARNING_CONTAINERS)):
        for n in names:
            b = f"container_{n}"
            live = f"NOT {_is(b + '_status', 'inspect_failed')}"
            no, yes = _is(b + "_exists", "no"), _is(b + "_exists", "yes")
            run = _in(b + "_state", ["running"])
            c.append((f"{live} AND {no}", sev, _s(f"{n}_missing"), _s(f"container {n} missing")))
            c.append((f"{live} AND NOT {no} AND NOT {yes}", sev, _s(f"{n}_unknown"), _s(f"container {n} state unknown")))
            c.append((f"{live} AND {yes} AND NOT {run}", sev, _s(f"{n}_state"),
                      f"'container {n} state ' || {_unk(b + '_state')}"))
            c.append((f"{live} AND {yes} AND {run} AND NOT {_in(b + '_health', AU.HEALTHY_HEALTH)}", sev,
                      _s(f"{n}_health"), f"'container {n} health ' || {_unk(b + '_health')}"))
    for sev, probes in (("critical", AU.STACK_CORE_PROBES), ("warning", AU.STACK_WARNING_PROBES)):
        for key, kind, message in probes:
            c.append((f"NOT {_probe_ok(key)}", sev, _s(kind), _s(message)))
    c.append((f"NOT {_probe_ok('prometheus_query_api')}", "critical", "'prometheus_query_api'",
              "'prometheus query API unavailable'"))
    for sev, adj, targets in (("critical", "required", AU.STACK_REQUIRED_TARGETS),
                              ("warning", "optional", AU.STACK_OPTIONAL_TARGETS)):
        for t in targets:
            v = _flt(f"prometheus_target_{t}_up")
            c.append((f"{v} IS NULL", sev, _s(f"{t}_target_unknown"), _s(f"{adj} target {t} missing from audit")))
            c.append((f"{v} < 1", sev, _s(f"{t}_target_down"), _s(f"{adj} target {t} down")))
    req, tot = _int("prometheus_required_targets_down"), _int("prometheus_total_targets_down")
    c.append((f"{req} > 0", "critical", "'required_targets_down'",
              f"CAST({req} AS VARCHAR) || ' required prometheus targets down'"))
    c.append((f"{tot} > 0 AND coalesce({req}, 0) = 0", "warning", "'targets_down'",
              f"CAST({tot} AS VARCHAR) || ' prometheus targets down'"))
    r5, p95 = _flt("demo_app_5xx_rate"), _flt("demo_app_p95_latency_seconds")
    c.append((f"{r5} > 0", "warning", "'demo_app_5xx'", f"'demo-app 5xx rate ' || printf('%.4f', {r5}) || '/s'"))
    c.append((f"{p95} > 0.5", "warning", "'demo_app_latency'",
              f"'demo-app p95 latency ' || printf('%.3f', {p95}) || 's'"))
    rs = _int("containers_restarting_total")
    c.append((f"{rs} > 0", "warning", "'containers_restarting'", f"CAST({rs} AS VARCHAR) || ' containers restarting'"))
    return c


def _findings_sql(checks) -> str:
    parts = [f"SELECT log_id, host, {i} AS ord, '{sev}' AS severity, {kind} AS kind, {msg} AS message "
             f"FROM fw WHERE coalesce({cond}, false)" for i, (cond, sev, kind, msg) in enumerate(checks)]
    return ("fnd0 AS (\n" + "\n  UNION ALL\n".join(parts) + "\n),\n"
            "fnd AS (SELECT log_id, host, CAST(row_number() OVER (PARTITION BY log_id ORDER BY ord) - 1 AS INTEGER) "
            "AS pos, severity, kind, message FROM fnd0)")


def _levels_sql() -> str:
    return """
lv AS (
  SELECT l.log_id, l.host,
    CASE WHEN count(f.pos) FILTER (WHERE f.severity = 'critical') > 0 THEN 'critical'
         WHEN count(f.pos) > 0 THEN 'warning' ELSE 'ok' END AS level,
    count(f.pos) AS findings_count,
    count(f.pos) FILTER (WHERE f.severity = 'warning') AS warning_count,
    count(f.pos) FILTER (WHERE f.severity = 'critical') AS critical_count,
    coalesce(string_agg(f.severity || ':' || f.message, '; ' ORDER BY f.pos), 'ok:no findings') AS summary
  FROM kv_logs l LEFT JOIN fnd f ON f.log_id = l.log_id GROUP BY l.log_id, l.host
)"""


VPS_SQL = FACTS_SQL + ",\n" + _findings_sql(_vps_checks())
STACK_SQL = FACTS_SQL + ",\n" + _findings_sql(_stack_checks())


# ------------------------------------------------------------------ Spark side


def _vps(spark, sf_dir):
    return AU.analyze(fx.kv_logs(spark, sf_dir), AU.vps_findings)


def _stack(spark, sf_dir):
    return AU.analyze(fx.kv_logs(spark, sf_dir), AU.stack_findings)


@query("kv_facts", f"WITH {FACTS_SQL} SELECT log_id, host, key, value FROM facts", ctes=("kv_logs",))
def q_kv_facts(spark, sf_dir):
    return AU.kv_facts(fx.kv_logs(spark, sf_dir))


@query("vps_findings", f"WITH {VPS_SQL} SELECT log_id, host, pos, severity, kind, message FROM fnd", ctes=("kv_logs",))
def q_vps_findings(spark, sf_dir):
    return AU.explode_findings(_vps(spark, sf_dir))


@query("vps_levels", f"WITH {VPS_SQL}, {_levels_sql()} SELECT * FROM lv", ctes=("kv_logs",))
def q_vps_levels(spark, sf_dir):
    return _vps(spark, sf_dir).select("log_id", "host", "level", "findings_count", "warning_count",
                                      "critical_count", "summary")


@query("stack_findings", f"WITH {STACK_SQL} SELECT log_id, host, pos, severity, kind, message FROM fnd",
       ctes=("kv_logs",))
def q_stack_findings(spark, sf_dir):
    return AU.explode_findings(_stack(spark, sf_dir))


@query("stack_levels", f"WITH {STACK_SQL}, {_levels_sql()} SELECT * FROM lv", ctes=("kv_logs",))
def q_stack_levels(spark, sf_dir):
    return _stack(spark, sf_dir).select("log_id", "host", "level", "findings_count", "warning_count",
                                        "critical_count", "summary")


@query("missing_keys", f"""WITH {FACTS_SQL}
SELECT l.log_id, CAST(count(r.k) FILTER (WHERE f.key IS NULL) AS BIGINT) AS missing_count,
  coalesce(string_agg(r.k, ',' ORDER BY r.ord) FILTER (WHERE f.key IS NULL), '') AS missing_keys
FROM kv_logs l
CROSS JOIN (SELECT unnest({[k for k in AU.STACK_REQUIRED_VERIFY_KEYS]!r}) AS k,
                   unnest(range({len(AU.STACK_REQUIRED_VERIFY_KEYS)})) AS ord) r
LEFT JOIN facts f ON f.log_id = l.log_id AND f.key = r.k
GROUP BY l.log_id
""", ctes=("kv_logs",))
def q_missing_keys(spark, sf_dir):
    return AU.missing_keys(fx.kv_logs(spark, sf_dir))


_COMPONENTS_VALUES = ", ".join(f"('{n}', '{p}')" for n, p in AU.STACK_COMPONENTS)


@query("component_health", f"""WITH {FACTS_SQL}
SELECT l.log_id, c.component, CAST(
  coalesce(max(f.value) FILTER (WHERE f.key = 'container_' || c.component || '_exists') = 'yes', false)
  AND coalesce(max(f.value) FILTER (WHERE f.key = 'container_' || c.component || '_state') = 'running', false)
  AND coalesce(lower(trim(max(f.value) FILTER (WHERE f.key = c.probe))), '') IN
      ({', '.join(repr(v) for v in AU.PROBE_OK_VALUES)}) AS INTEGER) AS healthy
FROM kv_logs l CROSS JOIN (VALUES {_COMPONENTS_VALUES}) c(component, probe)
LEFT JOIN facts f ON f.log_id = l.log_id
GROUP BY l.log_id, c.component, c.probe
""", ctes=("kv_logs",))
def q_component_health(spark, sf_dir):
    return AU.component_health(fx.kv_logs(spark, sf_dir))


@query("targets_down", f"""WITH {FACTS_SQL}
SELECT log_id, coalesce({_int('prometheus_required_targets_down')}, 0) AS core_targets_down,
  greatest(coalesce({_int('prometheus_total_targets_down')}, 0)
           - coalesce({_int('prometheus_required_targets_down')}, 0), 0) AS noncore_targets_down,
  coalesce({_int('containers_restarting_total')}, 0) AS containers_restarting
FROM fw
""", ctes=("kv_logs",))
def q_targets_down(spark, sf_dir):
    return AU.targets_down(fx.kv_logs(spark, sf_dir))


@query("finding_presence", f"""WITH {STACK_SQL}
SELECT DISTINCT log_id, regexp_replace(regexp_replace(lower(trim(kind)), '[^a-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g')
  AS kind, severity FROM fnd
""", ctes=("kv_logs",))
def q_finding_presence(spark, sf_dir):
    """A21 / U-3: distinct (kind, severity) presence per log, kind sanitised for a label (P5)."""
    from fleetlens.functions.text import sanitize_label

    f = AU.explode_findings(_stack(spark, sf_dir))
    return f.select("log_id", sanitize_label("kind").alias("kind"), "severity").distinct()


def exposition_sql(key: str, gauges: str, helps: dict[str, str], always: str | None = None) -> str:
    """Lines of exposition texts from long-form gauges: samples, and the header of each metric that a text has."""
    sql = f"SELECT {key}, metric || '{{' || labels || '}} ' || value AS line FROM ({gauges}) s"
    if helps:
        rows = ", ".join(f"('{m}', '{h}')" for m, h in helps.items())
        have = f"SELECT DISTINCT {key}, metric FROM ({gauges}) a" + (f" UNION SELECT DISTINCT {key}, '{always}' FROM ({gauges}) c" if always else "")
        for kind in ("'# HELP ' || b.metric || ' ' || help", "'# TYPE ' || b.metric || ' gauge'"):
            sql += f"\nUNION ALL SELECT {key}, {kind} FROM ({have}) b JOIN (VALUES {rows}) h(metric, help) ON h.metric = b.metric"
    return sql


def lines_of(texts, key: str):
    """One row per line of the texts (which end with a line break)."""
    return texts.select(key, F.explode(F.split(F.regexp_replace("text", "\n$", ""), "\n")).alias("line"))


def _gauge_sql() -> str:
    parts = [
        "SELECT log_id, 'vps_host_audit_status' AS metric, 'host=\"' || host || '\"' AS labels, "
        "CAST(CASE level WHEN 'ok' THEN 0 WHEN 'warning' THEN 1 WHEN 'critical' THEN 2 ELSE 3 END AS VARCHAR) AS value FROM lv",
        "SELECT log_id, 'vps_host_audit_findings_count', 'host=\"' || host || '\"', CAST(findings_count AS VARCHAR) FROM lv",
        "SELECT log_id, 'vps_host_audit_findings_count_by_severity', 'host=\"' || host || '\",severity=\"warning\"', "
        "CAST(warning_count AS VARCHAR) FROM lv",
        "SELECT log_id, 'vps_host_audit_findings_count_by_severity', 'host=\"' || host || '\",severity=\"critical\"', "
        "CAST(critical_count AS VARCHAR) FROM lv",
    ]
    for metric, kind, key, arg in AU.VPS_GAUGE_FAMILIES:
        val = (f"coalesce(nullif({_q(key)}, ''), '{arg}')" if kind == "raw"
               else f"CASE WHEN {_is(key, arg)} THEN '1' ELSE '0' END")
        parts.append(f"SELECT log_id, '{metric}', 'host=\"' || host || '\"', {val} FROM fw")
    parts.append("SELECT log_id, 'vps_host_audit_finding_present', 'host=\"' || host || '\",kind=\"' || "
                 "replace(replace(kind, '\"', ''), '\\', '_') || '\",severity=\"' || severity || '\"', '1' FROM fnd")
    return "\nUNION ALL\n".join(parts)


@query("vps_gauges", f"WITH {VPS_SQL}, {_levels_sql()}\n" + _gauge_sql(), ctes=("kv_logs",))
def q_vps_gauges(spark, sf_dir):
    """VPS audit gauges in long form (feeds the exposition sink)."""
    return AU.vps_gauges(_vps(spark, sf_dir))


def _pyfloat_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'NaN' WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) || '.0' "
            f"ELSE CAST({x} AS VARCHAR) END")


def _stack_gauge_sql() -> str:
    h = "host=\"' || host || '\""
    parts = [
        f"SELECT log_id, 'monitoring_stack_audit_status' AS metric, '{h}' AS labels, "
        "CAST(CASE level WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END AS VARCHAR) AS value FROM lv",
        f"SELECT log_id, 'monitoring_stack_audit_findings_count', '{h}', CAST(findings_count AS VARCHAR) FROM lv",
        f"SELECT log_id, 'monitoring_stack_audit_findings_count_by_severity', '{h},severity=\"warning\"', "
        "CAST(warning_count AS VARCHAR) FROM lv",
        f"SELECT log_id, 'monitoring_stack_audit_findings_count_by_severity', '{h},severity=\"critical\"', "
        "CAST(critical_count AS VARCHAR) FROM lv",
    ]
    for comp, probe in AU.STACK_COMPONENTS:
        ok = f"{_is(f'container_{comp}_exists', 'yes')} AND {_is(f'container_{comp}_state', 'running')} AND {_probe_ok(probe)}"
        parts.append(f"SELECT log_id, 'monitoring_stack_{comp}_healthy', '{h}', CASE WHEN {ok} THEN '1' ELSE '0' END FROM fw")
    req = f"coalesce({_int('prometheus_required_targets_down')}, 0)"
    tot = f"coalesce({_int('prometheus_total_targets_down')}, 0)"
    parts.append(f"SELECT log_id, 'monitoring_stack_core_targets_down', '{h}', CAST({req} AS VARCHAR) FROM fw")
    parts.append(f"SELECT log_id, 'monitoring_stack_noncore_targets_down', '{h}', "
                 f"CAST(greatest({tot} - {req}, 0) AS VARCHAR) FROM fw")
    for metric, key in (("monitoring_stack_demo_app_5xx_rate", "demo_app_5xx_rate"),
                        ("monitoring_stack_demo_app_p95_latency_seconds", "demo_app_p95_latency_seconds")):
        v = f"(CASE WHEN {_flt(key)} IS NULL OR {_flt(key)} = 0 THEN CAST(0 AS DOUBLE) ELSE {_flt(key)} END)"
        parts.append(f"SELECT log_id, '{metric}', '{h}', {_pyfloat_sql(v)} FROM fw")
    parts.append(f"SELECT log_id, 'monitoring_stack_audit_finding_present', '{h},kind=\"' || "
                 "regexp_replace(regexp_replace(lower(trim(kind)), '[^a-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g') || "
                 "'\",severity=\"' || severity || '\"', '1' FROM fnd")
    return "\nUNION ALL\n".join(parts)


@query("stack_gauges", f"WITH {STACK_SQL}, {_levels_sql()}\n" + _stack_gauge_sql(), ctes=("kv_logs",))
def q_stack_gauges(spark, sf_dir):
    """Monitoring stack gauges in long form."""
    return AU.stack_gauges(_stack(spark, sf_dir))


@query("vps_exposition", f"WITH {VPS_SQL}, {_levels_sql()}\n" + exposition_sql("log_id", _gauge_sql(), AU.VPS_HELP), ctes=("kv_logs",))
def q_vps_exposition(spark, sf_dir):
    """K5 (VPS): the lines of every log's text."""
    return lines_of(AU.vps_exposition(_vps(spark, sf_dir)), "log_id")


@query("stack_exposition", f"WITH {STACK_SQL}, {_levels_sql()}\n" + exposition_sql("log_id", _stack_gauge_sql(), {}), ctes=("kv_logs",))
def q_stack_exposition(spark, sf_dir):
    """K5 (monitoring stack): the lines of every log's text."""
    return lines_of(AU.stack_exposition(_stack(spark, sf_dir)), "log_id")
