"""Host audits for a whole fleet.

A log is one row (``log_id, host, text``). Parsing it into facts is map-side: the text is split into
lines, each ``key=value`` line becomes a map entry, and ``map_from_entries`` under the LAST_WIN policy
keeps the last duplicate - no shuffle. Checks are evaluated per row as an ordered array of
``when(cond, finding)`` filtered for non-null, so the findings keep the source order the summary needs.

Null trap: the reference tests ``value != "x"`` on possibly-missing keys (true when missing); every
such test here is null-safe (``NOT (v <=> 'x')``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.numeric import fmt_num, safe_float, safe_int
from fleetlens.functions.text import escape_label, finding_text, py_strip

# Python str.splitlines() boundaries.
LINE_BREAK = r"[\n-\r\u001C-\u001E\u0085\u2028\u2029]"  # where an empty line between \r and \n does no harm
LINE_BREAKS = r"\r\n|" + LINE_BREAK
NOT_PLAIN = r"[^ -~\n]"

FINDING = "struct<severity:string,kind:string,message:string>"


# ----------------------------------------------------------------------------- S3

def _stripped(x: Column) -> Column:
    """``py_strip``, which walks the whole text, only where the first or last character can be whitespace: below
    ``!`` or not ASCII."""
    def odd(c):
        return (c < "!") | (c >= "\u0080")

    return F.when(odd(x) | odd(F.substring(x, -1, 1)), py_strip(x)).otherwise(x)


def _entries(t: Column, line_break: str, strip) -> Column:
    kept = F.filter(F.split(t, line_break), lambda x: x.contains("=") & ~(x.contains("===") & strip(x).startswith("===")))
    pairs = F.transform(kept, lambda x: F.split(x, "=", 2))
    return F.transform(pairs, lambda p: F.struct(strip(p[0]).alias("key"), strip(p[1]).alias("value")))


def kv_facts_map(text) -> Column:
    """S3: ``key=value`` lines -> map<string,string>. Lines are stripped; blank lines, lines starting
    with '===' and lines without '=' are skipped; split on the first '='; the last duplicate wins. Key and value are
    stripped, so a line itself needs it only to tell a leading '==='. A text of printable ASCII and line feeds has no
    other line break, and no whitespace in a line but the space: it needs neither pattern nor ``py_strip``."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.map_from_entries(F.when(t.rlike(NOT_PLAIN), _entries(t, LINE_BREAK, _stripped)).otherwise(_entries(t, "\n", F.trim)))


def kv_facts(logs: DataFrame) -> DataFrame:
    """S3 long form: one row per (log_id, key) with the winning value."""
    return logs.select("log_id", "host", F.explode(kv_facts_map("text")).alias("key", "value"))


# ----------------------------------------------------------------------------- helpers

class Fields:
    """Facts as plain columns: remembers which keys the checks read, and under which name."""

    def __init__(self) -> None:
        self.names: dict[str, str] = {}

    def __getitem__(self, key: str) -> Column:
        return F.col(self.names.setdefault(key, f"_fact{len(self.names)}"))


def _g(facts, key: str) -> Column:
    return facts[key] if isinstance(facts, Fields) else F.try_element_at(facts, F.lit(key))


def _is(v: Column, value: str) -> Column:
    return F.coalesce(v == F.lit(value), F.lit(False))


def _in(v: Column, values) -> Column:
    vals = [x for x in values if x is not None]
    cond = F.coalesce(v.isin(*vals), F.lit(False))
    if None in values:
        cond = cond | v.isNull()
    return cond


def _f(sev: str, kind, message) -> Column:
    k = F.lit(kind) if isinstance(kind, str) else kind
    m = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(sev).alias("severity"), k.alias("kind"), m.alias("message"))


def _or_unknown(v: Column) -> Column:
    return F.coalesce(F.nullif(v, F.lit("")), F.lit("unknown"))


def _msg(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _checks(items: list[tuple[Column, Column]]) -> Column:
    """Findings whose condition holds, in order (compiled code throughout: a lambda would be interpreted)."""
    none = F.array().cast(f"array<{FINDING}>")
    return F.concat(*[F.when(cond, F.array(finding)).otherwise(none) for cond, finding in items])


def level_of(findings) -> Column:
    """Critical if any critical finding, warning if any finding, else ok."""
    f = F.col(findings) if isinstance(findings, str) else findings
    return (F.when(F.exists(f, lambda x: x["severity"] == "critical"), F.lit("critical"))
            .when(F.size(f) > 0, F.lit("warning")).otherwise(F.lit("ok")))


def count_severity(findings, sev: str) -> Column:
    """A12."""
    f = F.col(findings) if isinstance(findings, str) else findings
    return F.size(F.filter(f, lambda x: x["severity"] == sev)).cast("long")


# ----------------------------------------------------------------------------- D2 VPS

# FIXED VALUES - VPS audit: critical systemd units (unit -> label), probes, containers, ports.
VPS_CRITICAL_UNITS = [
    ("docker.service", "docker"),
    ("prometheus-node-exporter.service", "node_exporter"),
    ("action-runner.service", "action_runner"),
    ("caddy.service", "caddy"),
]
VPS_CRITICAL_PROBES = ["prometheus_probe", "alertmanager_probe", "grafana_probe", "action_runner_probe",
                       "node_exporter_probe"]
VPS_CRITICAL_CONTAINERS = ["prometheus", "alertmanager", "grafana", "tg-relay"]
VPS_UFW_PORTS = [("ufw_rule_22_present", "ssh"), ("ufw_rule_80_present", "http"), ("ufw_rule_443_present", "https")]
VPS_TAILSCALE_PORTS = ["3000", "3100", "9080", "9090", "9093"]
HEALTHY_HEALTH = ["healthy", "none", "", None]


def _threshold(v: Column, crit: float, warn: float, kind: str, text: str, unit: str, strict=False):
    hi = (v > crit) if strict else (v >= crit)
    lo = (v > warn) if strict else (v >= warn)
    msg = _msg(text, fmt_num(v, 0), unit)
    return [(v.isNotNull() & hi, _f("critical", kind, msg)),
            (v.isNotNull() & ~hi & lo, _f("warning", kind, msg))]


def vps_findings(facts: Column) -> Column:
    """Ordered VPS findings from a facts map."""
    g = lambda k: _g(facts, k)
    items: list[tuple[Column, Column]] = []
    for unit, label in VPS_CRITICAL_UNITS:
        key = "unit_" + unit.replace("-", "_").replace(".", "_") + "_active"
        v = g(key)
        items.append((~_is(v, "active"), _f("critical", f"{label}_unit", _msg(f"systemd unit {unit} is ", _or_unknown(v)))))
    items.append((~_is(g("unit_fail2ban_service_active"), "active"), _f("warning", "fail2ban_inactive", "fail2ban inactive")))
    items.append((F.coalesce(g("docker_reachable"), F.lit("no")) != "yes",
                  _f("critical", "docker_daemon_down", "docker daemon unreachable")))
    for probe in VPS_CRITICAL_PROBES:
        items.append((~_is(g(probe), "ok"), _f("critical", probe, f"{probe[:-len('_probe')]} probe failed")))
    items.append((~_is(g("tg_relay_probe"), "ok"), _f("warning", "tg_relay_probe", "tg-relay probe failed")))
    items += _threshold(safe_float(g("root_used_percent")), 92, 85, "root_disk_high", "root disk used ", "%")
    items += _threshold(safe_float(g("root_inode_used_percent")), 92, 85, "root_inode_high", "root inode used ", "%")
    items += _threshold(safe_float(g("swap_used_mb")), 2048, 1024, "swap_high", "swap used ", "MB")
    j = safe_int(g("journal_p3_count"))
    items.append((j.isNotNull() & (j >= 100),
                  _f("warning", "journal_errors", _msg("journal priority<=3 count ", j.cast("string")))))
    items.append((_is(g("reboot_required"), "yes"), _f("warning", "reboot_required", "reboot required")))
    unhealthy = F.coalesce(safe_int(g("docker_unhealthy_containers")), F.lit(0))
    restarting = F.coalesce(safe_int(g("docker_restarting_containers")), F.lit(0))
    um = _msg(unhealthy.cast("string"), " unhealthy containers")
    items.append((unhealthy >= 2, _f("critical", "docker_unhealthy", um)))
    items.append(((unhealthy < 2) & (unhealthy >= 1), _f("warning", "docker_unhealthy", um)))
    items.append((restarting >= 1, _f("warning", "docker_restarting", _msg(restarting.cast("string"),
                                                                            " restarting containers"))))
    for name in VPS_CRITICAL_CONTAINERS:
        base = "container_" + name.replace("-", "_")
        exists, state, health = g(base + "_exists"), g(base + "_state"), g(base + "_health")
        missing = _is(exists, "no")
        bad_state = ~missing & ~_in(state, ["running"])
        bad_health = ~missing & _in(state, ["running"]) & ~_in(health, HEALTHY_HEALTH)
        items.append((missing, _f("critical", f"{name}_missing", f"container {name} missing")))
        items.append((bad_state, _f("critical", f"{name}_state", _msg(f"container {name} state ", _or_unknown(state)))))
        items.append((bad_health, _f("critical", f"{name}_health", _msg(f"container {name} health ", health))))
    d_exists, d_state, d_health = (g("container_demo_app_exists"), g("container_demo_app_state"),
                                   g("container_demo_app_health"))
    demo = _is(d_exists, "yes")
    items.append((demo & ~_in(d_state, ["running"]),
                  _f("warning", "demo_app_state", _msg("container demo-app state ", _or_unknown(d_state)))))
    items.append((demo & _in(d_state, ["running"]) & ~_in(d_health, HEALTHY_HEALTH),
                  _f("warning", "demo_app_health", _msg("container demo-app health ", d_health))))
    ufw, incoming = g("ufw_status"), g("ufw_default_incoming")
    unknown = _is(ufw, "unknown")
    items.append((unknown, _f("warning", "ufw_status_unavailable", "ufw status unavailable for audit")))
    items.append((~unknown & ~_is(ufw, "active"),
                  _f("critical", "ufw_inactive", _msg("ufw status is ", _or_unknown(ufw)))))
    items.append((~unknown & ~_in(incoming, ["deny"]),
                  _f("critical", "ufw_default_incoming", _msg("ufw incoming default is ", _or_unknown(incoming)))))
    for key, label in VPS_UFW_PORTS:
        items.append((~unknown & _is(g(key), "no"), _f("warning", f"{label}_ufw_missing", f"ufw rule missing for {label}")))
    ts_ok = _in(g("tailscale_serve_status"), ["ok"])
    items.append((~ts_ok, _f("warning", "tailscale_serve_status", "tailscale serve status unavailable")))
    for port in VPS_TAILSCALE_PORTS:
        items.append((ts_ok & ~_is(g(f"tailscale_serve_port_{port}"), "yes"),
                      _f("warning", f"tailscale_serve_{port}", f"tailscale serve missing port {port}")))
    return _checks(items)


# ----------------------------------------------------------------------------- D3 monitoring stack

# FIXED VALUES - monitoring stack audit: containers, probes, targets, accepted probe values.
STACK_ALL_CONTAINERS = ["prometheus", "alertmanager", "grafana", "loki", "promtail", "tg_relay", "demo_app"]
STACK_CORE_CONTAINERS = ["prometheus", "alertmanager", "grafana", "loki", "tg_relay"]
STACK_WARNING_CONTAINERS = ["promtail", "demo_app"]
STACK_CORE_PROBES = [
    ("probe_prometheus_ready", "prometheus_ready_probe", "prometheus ready probe failed"),
    ("probe_alertmanager_ready", "alertmanager_ready_probe", "alertmanager ready probe failed"),
    ("probe_grafana_health", "grafana_health_probe", "grafana health probe failed"),
    ("probe_loki_ready", "loki_ready_probe", "loki ready probe failed"),
    ("probe_tg_relay_ready", "tg_relay_ready_probe", "tg-relay ready probe failed"),
]
STACK_WARNING_PROBES = [
    ("probe_promtail_ready", "promtail_ready_probe", "promtail ready probe failed"),
    ("probe_demo_app_health", "demo_app_health_probe", "demo-app health probe failed"),
]
STACK_REQUIRED_TARGETS = ["nodes_vps", "nodes_admin", "action_runner"]
STACK_OPTIONAL_TARGETS = ["demo_app"]
PROBE_OK_VALUES = ["ok", "healthy", "up", "true", "1"]
STACK_REQUIRED_VERIFY_KEYS = [
    "container_prometheus_exists",
    "container_alertmanager_exists",
    "container_grafana_exists",
    "container_loki_exists",
    "container_promtail_exists",
    "container_tg_relay_exists",
    "container_demo_app_exists",
    "probe_prometheus_ready",
    "probe_alertmanager_ready",
    "probe_grafana_health",
    "probe_loki_ready",
    "probe_promtail_ready",
    "probe_tg_relay_ready",
    "probe_demo_app_health",
    "prometheus_query_api",
    "prometheus_target_nodes_vps_up",
    "prometheus_target_nodes_admin_up",
    "prometheus_target_action_runner_up",
    "prometheus_target_demo_app_up",
    "prometheus_required_targets_down",
    "prometheus_total_targets_down",
]
STACK_COMPONENTS = [
    ("prometheus", "probe_prometheus_ready"),
    ("alertmanager", "probe_alertmanager_ready"),
    ("grafana", "probe_grafana_health"),
    ("loki", "probe_loki_ready"),
    ("promtail", "probe_promtail_ready"),
    ("tg_relay", "probe_tg_relay_ready"),
    ("demo_app", "probe_demo_app_health"),
]


def probe_ok(v: Column) -> Column:
    """stripped, lower-cased value in the accepted set."""
    return F.coalesce(F.lower(py_strip(v)), F.lit("")).isin(*PROBE_OK_VALUES)


def stack_findings(facts: Column) -> Column:
    """D3: ordered monitoring-stack findings from a facts map."""
    g = lambda k: _g(facts, k)
    items: list[tuple[Column, Column]] = []
    failed = sum((F.when(_is(g(f"container_{n}_status"), "inspect_failed"), 1).otherwise(0)
                  for n in STACK_ALL_CONTAINERS), F.lit(0))
    items.append((failed > 0, _f("critical", "docker_inspect_unavailable",
                                 _msg("docker inspect failed for ", failed.cast("string"), " containers"))))
    for sev, names in (("critical", STACK_CORE_CONTAINERS), ("warning", STACK_WARNING_CONTAINERS)):
        for n in names:
            base = f"container_{n}"
            exists, state, health = g(base + "_exists"), g(base + "_state"), g(base + "_health")
            live = ~_is(g(base + "_status"), "inspect_failed")
            c1 = live & _is(exists, "no")
            c2 = live & ~_is(exists, "no") & ~_is(exists, "yes")
            c3 = live & _is(exists, "yes") & ~_in(state, ["running"])
            c4 = live & _is(exists, "yes") & _in(state, ["running"]) & ~_in(health, HEALTHY_HEALTH)
            items.append((c1, _f(sev, f"{n}_missing", f"container {n} missing")))
            items.append((c2, _f(sev, f"{n}_unknown", f"container {n} state unknown")))
            items.append((c3, _f(sev, f"{n}_state", _msg(f"container {n} state ", _or_unknown(state)))))
            items.append((c4, _f(sev, f"{n}_health", _msg(f"container {n} health ", _or_unknown(health)))))
    for sev, probes in (("critical", STACK_CORE_PROBES), ("warning", STACK_WARNING_PROBES)):
        for key, kind, message in probes:
            items.append((~probe_ok(g(key)), _f(sev, kind, message)))
    items.append((~probe_ok(g("prometheus_query_api")),
                  _f("critical", "prometheus_query_api", "prometheus query API unavailable")))
    for sev, adj, targets in (("critical", "required", STACK_REQUIRED_TARGETS),
                              ("warning", "optional", STACK_OPTIONAL_TARGETS)):
        for t in targets:
            v = safe_float(g(f"prometheus_target_{t}_up"))
            items.append((v.isNull(), _f(sev, f"{t}_target_unknown", f"{adj} target {t} missing from audit")))
            items.append((v.isNotNull() & (v < 1), _f(sev, f"{t}_target_down", f"{adj} target {t} down")))
    req = safe_int(g("prometheus_required_targets_down"))
    tot = safe_int(g("prometheus_total_targets_down"))
    items.append((req.isNotNull() & (req > 0), _f("critical", "required_targets_down",
                                                   _msg(req.cast("string"), " required prometheus targets down"))))
    items.append((tot.isNotNull() & (tot > 0) & (F.coalesce(req, F.lit(0)) == 0),
                  _f("warning", "targets_down", _msg(tot.cast("string"), " prometheus targets down"))))
    r5 = safe_float(g("demo_app_5xx_rate"))
    items.append((r5.isNotNull() & (r5 > 0), _f("warning", "demo_app_5xx", _msg("demo-app 5xx rate ", fmt_num(r5, 4), "/s"))))
    p95 = safe_float(g("demo_app_p95_latency_seconds"))
    items.append((p95.isNotNull() & (p95 > 0.5),
                  _f("warning", "demo_app_latency", _msg("demo-app p95 latency ", fmt_num(p95, 3), "s"))))
    rs = safe_int(g("containers_restarting_total"))
    items.append((rs.isNotNull() & (rs > 0), _f("warning", "containers_restarting",
                                                 _msg(rs.cast("string"), " containers restarting"))))
    return _checks(items)


# ----------------------------------------------------------------------------- per-log analysis

def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable (one-element ``transform``)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def materialize(df: DataFrame, keep: list[str], **cols: Column) -> DataFrame:
    """Compute ``cols`` once per row and expose them as plain columns.

    The optimizer inlines a projected expression into every later reference when the references only
    extract fields; a facts map read by ~80 checks would then be parsed ~80 times per row. A generator
    (``inline`` of a one-element array) is a plan node the projections cannot be merged through. The array is a
    projection of its own: a generator interprets its input, repeated parts included, a projection is compiled.
    """
    return inline_rows(df.select(*keep, F.array(F.struct(*[c.alias(n) for n, c in cols.items()])).alias("_rows")), keep, "_rows")


def inline_rows(df: DataFrame, keep: list[str], rows: str) -> DataFrame:
    """``keep`` and the fields of the structs in ``rows``, one row each. For a plain column the optimizer would add the filter
    ``size(rows) > 0`` and move it below the projection, which then builds the rows twice; not for a slice."""
    return df.select(*keep, F.inline(F.slice(rows, 1, F.lit(2 ** 31 - 1))))


def analyze(logs: DataFrame, checks) -> DataFrame:
    """Facts -> findings -> level / counts / summary, one row per log (map-side, no shuffle)."""
    from fleetlens.session import cached_expr, small_methods

    small_methods(logs.sparkSession)

    def judged():
        fields = Fields()
        return checks(fields), fields.names

    keep = [c for c in logs.columns if c != "text"]  # log_id, host and any other passthrough columns
    a = materialize(logs, keep, facts=cached_expr(("kv_facts_map", "text"), lambda: kv_facts_map("text")))
    found, names = cached_expr((checks.__name__, "fields"), judged)
    # the keys that checks read become columns once per row; then the checks run as compiled projections
    a = a.select(*keep, "facts", *(F.try_element_at("facts", F.lit(k)).alias(n) for k, n in names.items()))
    a = a.select(*keep, "facts", found.alias("findings"))
    f = F.col("findings")
    return a.select(
        *keep, "facts", "findings", level_of(f).alias("level"),
        F.size(f).cast("long").alias("findings_count"), count_severity(f, "warning").alias("warning_count"),
        count_severity(f, "critical").alias("critical_count"), finding_text(f).alias("summary"))


def explode_findings(analysis: DataFrame) -> DataFrame:
    """One row per finding with its position; ``inline`` avoids nested-field re-evaluation."""
    rows = F.transform("findings", lambda x, i: F.struct(i.alias("pos"), x["severity"].alias("severity"),
                                                         x["kind"].alias("kind"), x["message"].alias("message")))
    return analysis.select("log_id", "host", F.inline(rows))


def missing_keys(logs: DataFrame, required=STACK_REQUIRED_VERIFY_KEYS) -> DataFrame:
    """P36 / U-2: required keys absent from each log's facts."""
    req = F.array(*[F.lit(k) for k in required])
    return logs.select("log_id", F.array_except(req, F.map_keys(kv_facts_map("text"))).alias("missing")).select(
        "log_id", F.size("missing").cast("long").alias("missing_count"),
        F.array_join("missing", ",").alias("missing_keys"))


def component_health(logs: DataFrame) -> DataFrame:
    """exists=yes and state=running and probe ok, per component (long form)."""
    x = materialize(logs, ["log_id"], facts=kv_facts_map("text"))
    g = lambda key: _g(F.col("facts"), key)

    def health(name: str, probe: str) -> Column:
        ok = _is(g(f"container_{name}_exists"), "yes") & _is(g(f"container_{name}_state"), "running") & probe_ok(g(probe))
        return F.struct(F.lit(name).alias("component"), ok.cast("int").alias("healthy"))

    return x.select("log_id", F.inline(F.array(*[health(n, p) for n, p in STACK_COMPONENTS])))


def targets_down(logs: DataFrame) -> DataFrame:
    """Core and non-core targets down; restarting containers."""
    x = materialize(logs, ["log_id"], facts=kv_facts_map("text"))
    req = F.coalesce(safe_int(_g(F.col("facts"), "prometheus_required_targets_down")), F.lit(0))
    tot = F.coalesce(safe_int(_g(F.col("facts"), "prometheus_total_targets_down")), F.lit(0))
    return x.select("log_id", req.alias("core_targets_down"),
                    F.greatest(tot - req, F.lit(0)).alias("noncore_targets_down"),
                    F.coalesce(safe_int(_g(F.col("facts"), "containers_restarting_total")), F.lit(0))
                    .alias("containers_restarting"))


# ----------------------------------------------------------------------------- D7 gauges

# FIXED VALUES - VPS gauge families: (metric, kind, source key or rule). kinds: "raw" = the fact text
# (missing/empty -> default), "flag" = 1 when the fact equals the value, else 0.
VPS_GAUGE_FAMILIES = [
    ("vps_host_root_disk_used_percent", "raw", "root_used_percent", "NaN"),
    ("vps_host_root_inode_used_percent", "raw", "root_inode_used_percent", "NaN"),
    ("vps_host_swap_used_mb", "raw", "swap_used_mb", "NaN"),
    ("vps_host_docker_running_containers", "raw", "docker_running_containers", "0"),
    ("vps_host_docker_unhealthy_containers", "raw", "docker_unhealthy_containers", "0"),
    ("vps_host_docker_restarting_containers", "raw", "docker_restarting_containers", "0"),
    ("vps_host_reboot_required", "flag", "reboot_required", "yes"),
    ("vps_host_fail2ban_healthy", "flag", "unit_fail2ban_service_active", "active"),
    ("vps_host_docker_daemon_healthy", "flag", "docker_reachable", "yes"),
    ("vps_host_action_runner_healthy", "flag", "action_runner_probe", "ok"),
    ("vps_host_prometheus_healthy", "flag", "prometheus_probe", "ok"),
    ("vps_host_alertmanager_healthy", "flag", "alertmanager_probe", "ok"),
    ("vps_host_grafana_healthy", "flag", "grafana_probe", "ok"),
    ("vps_host_tg_relay_healthy", "flag", "tg_relay_probe", "ok"),
    ("vps_host_node_exporter_healthy", "flag", "node_exporter_probe", "ok"),
    ("vps_host_ufw_active", "flag", "ufw_status", "active"),
    ("vps_host_tailscale_serve_ok", "flag", "tailscale_serve_status", "ok"),
] + [(f"vps_host_tailscale_serve_port_{p}", "flag", f"tailscale_serve_port_{p}", "yes") for p in VPS_TAILSCALE_PORTS]


def host_label(host) -> Column:
    """``host="..."`` of a row, escaped."""
    return F.concat(F.lit('host="'), escape_label(F.col(host) if isinstance(host, str) else host), F.lit('"'))


def exposition_text(rows: Column, helps: dict[str, str], always: str | None = None) -> Column:
    """K5: gauge rows (metric, labels, value) in order -> text: HELP and TYPE before a metric's first sample, one
    line per sample. Metrics without a help text have no header; ``always``: a metric whose header comes even
    where it has no sample."""
    known = F.create_map(*[x for m, h in helps.items() for x in (F.lit(m), F.lit(f"# HELP {m} {h}\n# TYPE {m} gauge\n"))]) if helps else None

    def line(x, i):
        sample = F.concat(x["metric"], F.lit("{"), x["labels"], F.lit("} "), x["value"])
        if known is None:
            return sample
        first = (i == 0) | (F.get(rows, i - 1)["metric"] != x["metric"])
        return F.concat(F.when(first, F.coalesce(F.try_element_at(known, x["metric"]), F.lit(""))).otherwise(F.lit("")), sample)

    text = F.array_join(F.transform(rows, line), "\n")
    if always is not None:
        absent = ~F.exists(rows, lambda x: x["metric"] == F.lit(always))
        text = F.concat(text, F.when(absent, F.lit(f"\n# HELP {always} {helps[always]}\n# TYPE {always} gauge")).otherwise(F.lit("")))
    return F.concat(text, F.lit("\n"))


# FIXED VALUES - help texts of the VPS audit's metrics (finding_present has none).
VPS_HELP = {
    "vps_host_audit_status": "VPS host audit status (0=ok,1=warning,2=critical).",
    "vps_host_audit_findings_count": "Total findings count.",
    "vps_host_audit_findings_count_by_severity": "Findings count by severity.",
    "vps_host_root_disk_used_percent": "Root disk used percent.",
    "vps_host_root_inode_used_percent": "Root inode used percent.",
    "vps_host_swap_used_mb": "Swap used in MB.",
    "vps_host_docker_running_containers": "Running containers count.",
    "vps_host_docker_unhealthy_containers": "Unhealthy containers count.",
    "vps_host_docker_restarting_containers": "Restarting containers count.",
    "vps_host_reboot_required": "Reboot required flag.",
    "vps_host_fail2ban_healthy": "Fail2ban active flag.",
    "vps_host_docker_daemon_healthy": "Docker daemon reachable flag.",
    "vps_host_action_runner_healthy": "Action runner probe flag.",
    "vps_host_prometheus_healthy": "Prometheus probe flag.",
    "vps_host_alertmanager_healthy": "Alertmanager probe flag.",
    "vps_host_grafana_healthy": "Grafana probe flag.",
    "vps_host_tg_relay_healthy": "TG relay probe flag.",
    "vps_host_node_exporter_healthy": "Node exporter probe flag.",
    "vps_host_ufw_active": "UFW active flag.",
    "vps_host_tailscale_serve_ok": "Tailscale serve status flag.",
} | {f"vps_host_tailscale_serve_port_{p}": f"Tailscale serve port {p} present." for p in VPS_TAILSCALE_PORTS}


def vps_gauge_rows(analysis: DataFrame) -> Column:
    """D7 (VPS): status code, finding counts, per-fact gauges and one presence gauge per finding, for the row's host."""
    from fleetlens.functions.numeric import level_code
    from fleetlens.functions.text import drop_quotes_kind

    host = host_label("host")

    def row(metric, labels, value):
        return F.struct(F.lit(metric).alias("metric"), labels.alias("labels"), value.cast("string").alias("value"))

    fam = [row("vps_host_audit_status", host, level_code(F.col("level"))), row("vps_host_audit_findings_count", host, F.col("findings_count"))]
    fam += [row("vps_host_audit_findings_count_by_severity", F.concat(host, F.lit(f',severity="{sev}"')), F.col(f"{sev}_count"))
            for sev in ("warning", "critical")]
    for metric, kind, key, arg in VPS_GAUGE_FAMILIES:
        v = _g(F.col("facts"), key)
        fam.append(row(metric, host, F.coalesce(F.nullif(v, F.lit("")), F.lit(arg)) if kind == "raw"
                       else F.when(_is(v, arg), F.lit("1")).otherwise(F.lit("0"))))
    present = F.transform("findings", lambda f: row(
        "vps_host_audit_finding_present", F.concat(host, F.lit(',kind="'), drop_quotes_kind(f["kind"]), F.lit('",severity="'), f["severity"], F.lit('"')), F.lit("1")))
    return F.concat(F.array(*fam), present)


def vps_gauges(analysis: DataFrame) -> DataFrame:
    """Long form ``(log_id, metric, labels, value)`` of :func:`vps_gauge_rows` over an :func:`analyze` result."""
    return inline_rows(analysis.select("log_id", vps_gauge_rows(analysis).alias("rows")), ["log_id"], "rows")


def vps_exposition(analysis: DataFrame) -> DataFrame:
    """K5 (VPS): one text per log."""
    rows = analysis.select("log_id", vps_gauge_rows(analysis).alias("rows"))
    return rows.select("log_id", exposition_text(F.col("rows"), VPS_HELP).alias("text"))


def py_float_text(x: Column) -> Column:
    """``str(float(x))`` for the values gauges carry: integral values as ``N.0``; missing -> ``NaN``."""
    return (F.when(x.isNull(), F.lit("NaN"))
            .when((x == F.floor(x)) & (F.abs(x) < F.lit(1e15)), F.concat(x.cast("long").cast("string"), F.lit(".0")))
            .otherwise(x.cast("string")))


def stack_gauge_rows(analysis: DataFrame) -> Column:
    """D7 (monitoring stack): status, counts, component health, target counts, demo-app numbers and one
    presence gauge per finding, for the row's host; labels sorted by key."""
    from fleetlens.functions.numeric import safe_float
    from fleetlens.functions.text import sanitize_label

    h = host_label("host")
    fx_ = F.col("facts")
    status = F.when(F.col("level") == "critical", 2).when(F.col("level") == "warning", 1).otherwise(0)
    rows = [
        ("monitoring_stack_audit_status", h, status.cast("string")),
        ("monitoring_stack_audit_findings_count", h, F.col("findings_count").cast("string")),
        ("monitoring_stack_audit_findings_count_by_severity", F.concat(h, F.lit(',severity="warning"')),
         F.col("warning_count").cast("string")),
        ("monitoring_stack_audit_findings_count_by_severity", F.concat(h, F.lit(',severity="critical"')),
         F.col("critical_count").cast("string")),
    ]
    for comp, probe in STACK_COMPONENTS:
        ok = (_is(_g(fx_, f"container_{comp}_exists"), "yes") & _is(_g(fx_, f"container_{comp}_state"), "running")
              & probe_ok(_g(fx_, probe)))
        rows.append((f"monitoring_stack_{comp}_healthy", h, F.when(ok, F.lit("1")).otherwise(F.lit("0"))))
    req = F.coalesce(safe_int(_g(fx_, "prometheus_required_targets_down")), F.lit(0))
    tot = F.coalesce(safe_int(_g(fx_, "prometheus_total_targets_down")), F.lit(0))
    rows.append(("monitoring_stack_core_targets_down", h, req.cast("string")))
    rows.append(("monitoring_stack_noncore_targets_down", h, F.greatest(tot - req, F.lit(0)).cast("string")))
    for metric, key in (("monitoring_stack_demo_app_5xx_rate", "demo_app_5xx_rate"),
                        ("monitoring_stack_demo_app_p95_latency_seconds", "demo_app_p95_latency_seconds")):
        v = safe_float(_g(fx_, key))
        v = F.when(v.isNull() | (v == 0), F.lit(0.0)).otherwise(v)
        rows.append((metric, h, py_float_text(v)))
    fam = [F.struct(F.lit(m).alias("metric"), lb.alias("labels"), v.alias("value")) for m, lb, v in rows]
    present = F.transform("findings", lambda f: F.struct(
        F.lit("monitoring_stack_audit_finding_present").alias("metric"),
        F.concat(h, F.lit(',kind="'), sanitize_label(f["kind"]), F.lit('",severity="'), f["severity"], F.lit('"'))
        .alias("labels"), F.lit("1").alias("value")))
    return F.concat(F.array(*fam), present)


def stack_gauges(analysis: DataFrame) -> DataFrame:
    """Long form ``(log_id, metric, labels, value)`` of :func:`stack_gauge_rows`."""
    return inline_rows(analysis.select("log_id", stack_gauge_rows(analysis).alias("rows")), ["log_id"], "rows")


def stack_exposition(analysis: DataFrame) -> DataFrame:
    """K5 (monitoring stack): one text per log; these metrics have no header lines."""
    rows = analysis.select("log_id", stack_gauge_rows(analysis).alias("rows"))
    return rows.select("log_id", exposition_text(F.col("rows"), {}).alias("text"))
