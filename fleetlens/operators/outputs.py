"""Records the signal pipeline writes: decision views, task payloads, notifications
(S1, K2, K10, K13, K14, K15, K16, J8, P3, P39, U5, A15, U-1..U-4).

Everything is a per-row projection (``to_json`` / ``concat`` / higher-order functions) over decided
signals or recorded tasks - no shuffle beyond the joins named in each function.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import context_pick, fingerprint
from fleetlens.functions.numeric import severity_priority
from fleetlens.functions.text import pick_str, py_strip
from fleetlens.sources.config import normalized_rules

TEMPLATE_TOKEN = r"\{\{\s*([a-zA-Z0-9_]+)(\|upper|\|lower)?\s*\}\}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def render_template(template, context) -> Column:
    """``{{ name }}``, ``{{ name|upper }}``, ``{{ name|lower }}``; a missing key renders ''."""
    tpl = _c(template)
    ctx = _c(context)
    literals = F.split(tpl, TEMPLATE_TOKEN)
    tokens = F.regexp_extract_all(tpl, F.lit(TEMPLATE_TOKEN), F.lit(0))

    def rendered(tok):
        key = F.regexp_extract(tok, TEMPLATE_TOKEN, 1)
        how = F.regexp_extract(tok, TEMPLATE_TOKEN, 2)
        val = F.coalesce(F.try_element_at(ctx, key), F.lit(""))
        val = F.when(how == "|upper", F.upper(val)).when(how == "|lower", F.lower(val)).otherwise(val)
        return val

    # one pass: text between tokens and values alternate, so a value that looks like a token stays as it is
    return F.array_join(F.zip_with(literals, F.transform(tokens, rendered), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def sorted_map(m) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(_c(m))))


def rule_actions(spark, rules=None) -> DataFrame:
    """What each rule does, as text: action_name and payload_json of ``execute`` rules, steps_json of chains
    (name, payload, retries, retry_delay_seconds and, where set, ``when``). Bounded by the configuration."""
    def text(x) -> str:
        return json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))

    rows = []
    for r in normalized_rules(rules):
        steps = [{"name": x["name"], "payload": {**x["payload"], **({"message": x["message"]} if x["message"] else {})}, "retries": x["retries"],
                  "retry_delay_seconds": x["retry_delay_seconds"],
                  **({"when": {"analysis_level_in": x["analysis_level_in"]}} if x["analysis_level_in"] else {})} for x in r["steps"]]
        rows.append((r["name"], r["action_name"], text(r["payload"]), text(steps)))
    return spark.createDataFrame(rows, "rule_name string, action_name string, payload_json string, steps_json string")


def _json_string(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", ""), F.lit("null"))


def decision_tasks(decided: DataFrame, actions: DataFrame) -> DataFrame:
    """K2 + P39: the task that a decision creates. ``execute``: an ``action`` task with ``{action, alert_key,
    payload}``. ``execute_chain``: a ``chain`` task with ``{alert_key, chain_context, steps}``; chain_context holds
    the base signal fields overlaid by the signal's own context (later keys win) plus ``context`` (the signal
    context as an object). Payloads are compact JSON with sorted keys; ``actions`` from :func:`rule_actions`."""
    ctx = context_pick(F.col("labels"), F.col("annotations"))
    base = F.create_map(
        F.lit("alertname"), F.col("alertname"), F.lit("alert_status"), F.col("status"),
        F.lit("severity"), F.col("severity"), F.lit("instance"), F.col("instance"), F.lit("job"), F.col("job"),
        F.lit("summary"), F.col("summary"), F.lit("description"), F.coalesce("description", F.lit("")),
        F.lit("fingerprint"), F.col("fingerprint"), F.lit("rule_name"), F.coalesce("rule_name", F.lit("")),
        F.lit("context"), F.lit(_CTX_SLOT))
    d = decided.where(F.col("decision").isin("execute", "execute_chain")).join(F.broadcast(actions), "rule_name")
    merged = F.to_json(sorted_map(F.map_concat(base, ctx)))
    # the context object goes where its placeholder sorted (a map holds only string values)
    context_json = F.replace(merged, F.lit('"' + _CTX_SLOT + '"'), F.to_json(sorted_map(ctx)))
    key_json = _json_string(F.col("alert_key"))
    chain = F.concat(F.lit('{"alert_key":'), key_json, F.lit(',"chain_context":'), context_json, F.lit(',"steps":'), F.col("steps_json"), F.lit("}"))
    action = F.concat(F.lit('{"action":'), _json_string(F.col("action_name")), F.lit(',"alert_key":'), key_json, F.lit(',"payload":'), F.col("payload_json"), F.lit("}"))
    is_chain = F.col("decision") == "execute_chain"
    return d.select(F.col("signal_id").alias("decision_id"), F.when(is_chain, F.lit("chain")).otherwise(F.lit("action")).alias("task_type"),
                    severity_priority("severity").alias("priority"), F.when(is_chain, chain).otherwise(action).alias("payload"), "alert_key")


_CTX_SLOT = "@@signal-context@@"


def decision_view(decided: DataFrame, actions: DataFrame) -> DataFrame:
    """The response row per signal - signal fields, decision, reason, rule, action (the action's name, or
    chain), the chain's steps and the context."""
    ctx = context_pick(F.col("labels"), F.col("annotations"))
    known = decided.join(F.broadcast(actions), "rule_name", "left")
    is_chain = F.col("decision") == "execute_chain"
    return known.select(
        F.col("signal_id").alias("decision_id"), "alertname", "status", "severity", "instance", "job", "summary",
        "fingerprint", "decision", "reason", "rule_name",
        F.when(is_chain, F.lit("chain")).when(F.col("decision") == "execute", F.col("action_name")).alias("action"),
        F.when(is_chain, F.col("steps_json")).alias("steps_json"),
        F.to_json(sorted_map(ctx)).alias("context_json"))


def with_task_ids(view: DataFrame, tasks: DataFrame) -> DataFrame:
    """The decision view with ``task_id``, the task that an executed decision has queued (the first one, by id)."""
    queued = tasks.where(F.col("decision_id").isNotNull()).groupBy("decision_id").agg(F.min("id").alias("_task"))
    out = view.join(queued, "decision_id", "left")
    return out.withColumn("task_id", F.when(F.col("decision").isin("execute", "execute_chain"), F.col("_task"))).drop("_task")


def remediation_tasks(decided: DataFrame, action: str = "soft_quit_allowlisted_candidate") -> DataFrame:
    """The critical memory rule's ``enqueue_mac_action`` step -> a ``mac_action`` task
    (payload ``{action, instance}``, priority from the step's severity, default critical)."""
    d = decided.where((F.col("decision") == "execute_chain")
                      & (F.col("rule_name") == "mac_memory_pressure_critical_escalate"))
    sev = F.lower(py_strip(F.coalesce(F.nullif(F.col("severity"), F.lit("")), F.lit("critical"))))
    payload = F.to_json(F.struct(F.lit(action).alias("action"), py_strip("instance").alias("instance")))
    return d.select(F.col("signal_id").alias("source_decision_id"), F.lit(None).cast("long").alias("decision_id"),
                    F.lit("mac_action").alias("task_type"), payload.alias("payload"),
                    severity_priority(sev).alias("priority"))


def remediation_results(steps: DataFrame) -> DataFrame:
    """K13 from step payloads (columns ``action, severity, instance``; null counts as absent): the result of the
    step and, where it succeeds, the ``mac_action`` task. A payload without an action fails."""
    action = py_strip(F.coalesce("action", F.lit("")))
    sev = F.lower(py_strip(F.coalesce("severity", F.lit("critical"))))
    ok = action != ""
    return steps.withColumn("result_status", F.when(ok, F.lit("success")).otherwise(F.lit("failed"))) \
        .withColumn("exit_code", F.when(ok, F.lit(0)).otherwise(F.lit(1))) \
        .withColumn("error", F.when(~ok, F.lit(MISSING_ACTION))) \
        .withColumn("task_payload", F.when(ok, F.to_json(F.struct(action.alias("action"), py_strip(F.coalesce("instance", F.lit(""))).alias("instance"))))) \
        .withColumn("task_priority", F.when(ok, severity_priority(sev)))


# FIXED VALUES - the error of a remediation step without an action.
MISSING_ACTION = "missing field: action"


def failed_remediation_notices(tasks: DataFrame) -> DataFrame:
    """A failed ``mac_action`` completion queues a critical notify task built from the task payload and
    result (missing fields -> ``unknown``; target line only when present)."""
    t = tasks.where((F.col("task_type") == "mac_action") & (F.col("status") == "failed"))
    p = F.from_json("payload", "map<string,string>")
    r = F.from_json("result_json", "map<string,string>")
    t = t.select("id", "decision_id", p.alias("p"), r.alias("r"))
    instance = F.coalesce(F.nullif(py_strip(F.coalesce(F.col("p")["instance"], F.lit("unknown"))), F.lit("")),
                          F.lit("unknown"))
    action = F.coalesce(F.nullif(py_strip(F.coalesce(F.col("p")["action"], F.lit("unknown"))), F.lit("")),
                        F.lit("unknown"))
    target = py_strip(F.coalesce(F.col("r")["target"], F.col("p")["target"], F.lit("")))
    err = py_strip(F.coalesce(F.col("r")["error"], F.lit("unknown remediation failure")))
    desc = F.concat_ws("\n", F.lit("Remote mac remediation failed"), F.lit(""),
                       F.concat(F.lit("task_id: "), F.col("id").cast("string")),
                       F.concat(F.lit("instance: "), instance), F.concat(F.lit("action: "), action),
                       F.when(target != "", F.concat(F.lit("target: "), target)),
                       F.concat(F.lit("error: "), err))
    return t.select(F.col("id").alias("task_id"), "decision_id", F.lit("notify").alias("task_type"),
                    F.lit(100).alias("priority"), F.lit("critical").alias("severity"),
                    F.concat(F.lit("[MAC][REMEDIATION FAILED] "), action, F.lit(" on "), instance).alias("message"),
                    desc.alias("description"), F.lit("mac_remediation_failed").alias("event"))


def notification_outbox(notes: DataFrame) -> DataFrame:
    """K10 (message format): title / details from a notify payload with ``title, message, body,
    description, facts array<struct<key,value>>, event, source, severity, status`` columns; facts without a
    non-blank key and value are dropped; the body follows a blank line."""
    def s(col, default=""):
        return pick_str(F.col(col), default=default)

    title = F.coalesce(F.nullif(pick_str(F.col("title")), F.lit("")),
                       pick_str(F.col("message"), default="Notification from action-runner"))
    body = F.coalesce(F.nullif(pick_str(F.col("body")), F.lit("")), pick_str(F.col("description")))
    facts = F.filter(F.transform(F.coalesce("facts", F.array().cast("array<struct<key:string,value:string>>")),
                                 lambda f: F.struct(pick_str(f["key"]).alias("k"), pick_str(f["value"]).alias("v"))),
                     lambda f: (f["k"] != "") & (f["v"] != ""))
    lines = F.transform(facts, lambda f: F.concat(f["k"], F.lit(": "), f["v"]))
    detail = F.when(body != "", F.when(F.size(lines) > 0, F.concat(lines, F.array(F.lit(""), body)))
                    .otherwise(F.array(body))).otherwise(lines)
    details = py_strip(F.array_join(detail, "\n"))
    return notes.select("*", title.alias("out_title"), details.alias("out_details"),
                        s("event", "action_runner_event").alias("out_event"),
                        s("source", "action-runner").alias("out_source"), s("severity", "info").alias("out_severity"),
                        s("status", "firing").alias("out_status"))


def _alert_payload(status: Column, event: Column, severity: Column, source: Column, job: str, summary: Column, description: Column) -> Column:
    """An alert-shaped notification as compact JSON, keys sorted."""
    labels = F.struct(event.alias("alertname"), F.lit("vps").alias("instance"), F.lit(job).alias("job"), severity.alias("severity"), source.alias("service"))
    alert = F.struct(F.struct(description.alias("description"), summary.alias("summary")).alias("annotations"), labels.alias("labels"), status.alias("status"))
    return F.to_json(F.struct(F.array(alert).alias("alerts"), F.struct(summary.alias("summary")).alias("commonAnnotations"),
                              F.struct(severity.alias("severity"), source.alias("service")).alias("commonLabels"),
                              F.struct(event.alias("alertname")).alias("groupLabels"), F.lit("action-runner").alias("receiver"), status.alias("status")))


def message_payloads(notes: DataFrame) -> DataFrame:
    """What is sent for notes in message format: title and details of :func:`notification_outbox` as an alert."""
    out = notification_outbox(notes)
    return out.withColumn("payload", _alert_payload(F.col("out_status"), F.col("out_event"), F.col("out_severity"), F.col("out_source"), "control-plane",
                                                    F.col("out_title"), F.col("out_details")))


def alert_payloads(notes: DataFrame) -> DataFrame:
    """What is sent for notes in alert format (``message, description, event, source, severity, status``; a missing
    description is the message)."""
    s = lambda col, default: pick_str(F.col(col), default=default)
    message = s("message", "Notification from action-runner")
    said = F.coalesce(F.nullif(pick_str(F.col("description")), F.lit("")), message)
    return notes.withColumn("payload", _alert_payload(s("status", "firing"), s("event", "action_runner_event"), s("severity", "info"), s("source", "action-runner"),
                                                      "action-runner", message, said))


def kv_log_lines(facts: DataFrame) -> DataFrame:
    """Facts map -> ``key=value`` lines of all facts, in key order (a null value is empty); inverse of the parser."""
    pairs = F.array_sort(F.map_entries("facts"))
    return facts.select("log_id", F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "\n").alias("text"))


def analysis_trailer(line: Column, fields: dict[str, Column]) -> Column:
    """Summary line + ``RESULT_JSON:`` + sorted-key JSON of the analysis fields."""
    return F.concat(line, F.lit("\nRESULT_JSON:"), F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])))


def alerts_from_webhook(payloads: DataFrame, body_col: str = "body") -> DataFrame:
    """Webhook JSON ``{alerts: [...]}`` -> one signal row per object alert. A non-list ``alerts`` gives
    no rows; non-object items are skipped; text fields are picked and stripped; fingerprint from labels. Labels and
    annotations stay, so the rows feed rules (J1) and tasks (K2) as they are."""
    arr = F.from_json(F.get_json_object(F.col(body_col), "$.alerts"), "array<string>")
    items = payloads.select("*", F.posexplode_outer(arr).alias("pos", "item")).where(
        F.col("item").isNotNull() & F.col("item").startswith("{"))
    a = F.from_json("item", "struct<status:string,labels:map<string,string>,annotations:map<string,string>,"
                            "fingerprint:string>")
    x = items.select("*", a.alias("a"))
    labels = F.coalesce(F.col("a.labels"), F.create_map().cast("map<string,string>"))
    ann = F.coalesce(F.col("a.annotations"), F.create_map().cast("map<string,string>"))
    return x.select(
        *[c for c in payloads.columns if c != body_col], "pos",
        F.lower(pick_str(F.col("a.status"))).alias("status"),
        pick_str(labels["alertname"]).alias("alertname"), pick_str(labels["severity"]).alias("severity"),
        pick_str(labels["instance"]).alias("instance"), pick_str(labels["job"]).alias("job"),
        pick_str(ann["summary"]).alias("summary"), pick_str(ann["description"]).alias("description"),
        fingerprint(labels, F.col("a.fingerprint")).alias("fingerprint"),
        labels.alias("labels"), ann.alias("annotations"), F.lit("alertmanager").alias("source"),
        context_pick(labels, ann).alias("context"))


BRIEF_SCHEMA = ("struct<brief_status:string,executive_summary:string,top_risks:array<string>,"
                "recommended_actions:array<string>,operator_note:string>")


def render_brief_markdown(briefs: DataFrame) -> Column:
    """K8: brief markdown from columns ``generated_at, source, analysis_level, analysis_findings_count,
    analysis_log_path, analysis_summary, brief (BRIEF_SCHEMA struct), facts (map)``; facts sorted by key,
    the facts section only when facts exist; the text is stripped and ends with one newline."""
    b = F.col("brief")

    def items(arr):
        return F.transform(F.coalesce(arr, F.array().cast("array<string>")), lambda x: F.concat(F.lit("- "), x))

    head = F.array(
        F.lit("# Ops incident brief"), F.lit(""),
        F.concat(F.lit("- Generated at: "), F.col("generated_at")),
        F.concat(F.lit("- Source: "), F.col("source")),
        F.concat(F.lit("- Analysis level: "), F.col("analysis_level")),
        F.concat(F.lit("- Findings count: "), F.col("analysis_findings_count").cast("string")),
        F.concat(F.lit("- Log path: "), F.col("analysis_log_path")),
        F.concat(F.lit("- Brief status: "), F.coalesce(b["brief_status"], F.lit(""))), F.lit(""),
        F.lit("## Analyzer summary"), F.lit(""), F.col("analysis_summary"), F.lit(""),
        F.lit("## Executive summary"), F.lit(""), F.coalesce(b["executive_summary"], F.lit("")), F.lit(""),
        F.lit("## Top risks"), F.lit(""))
    mid = F.array(F.lit(""), F.lit("## Recommended actions"), F.lit(""))
    tail = F.array(F.lit(""), F.lit("## Operator note"), F.lit(""), F.coalesce(b["operator_note"], F.lit("")), F.lit(""))
    facts = F.array_sort(F.map_entries(F.coalesce(F.col("facts"), F.create_map().cast("map<string,string>"))))
    fact_lines = F.when(F.size(facts) > 0, F.concat(
        F.array(F.lit("## Facts"), F.lit("")),
        F.transform(facts, lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"])), F.array(F.lit("")))
    ).otherwise(F.array().cast("array<string>"))
    lines = F.concat(head, items(b["top_risks"]), mid, items(b["recommended_actions"]), tail, fact_lines)
    return F.concat(py_strip(F.array_join(lines, "\n")), F.lit("\n"))
