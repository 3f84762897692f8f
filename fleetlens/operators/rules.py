"""Signal classification: first-match rules (J1/F1), greedy cooldown (W9), as-of cooldown.

First match is compiled from the (small, fixed) rule list into one ``CASE`` chain: no join, no
shuffle, short-circuit per row, inside whole-stage codegen.

The greedy cooldown is sequential per key: an execution restarts the clock, a suppressed signal does
not. One exact plan for keys of any size:

* a candidate that comes at least the cooldown after the candidate before it is always executed, so each key
  falls apart into islands that don't depend on each other (gaps are found range by range, skew-safe);
* inside an island, ``succ(i)`` = first candidate at or after ``trunc_sec(t_i) + cooldown`` (skew-safe as-of,
  :mod:`fleetlens.operators.asof`); the executions are the orbit of the island's first candidate, enumerated
  by pointer doubling: as many rounds as the logarithm of the longest orbit, each written under the shared
  checkpoint directory and deleted when the next one replaces it.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import py_strip
from fleetlens.operators.asof import next_at_or_after, prev_at_or_before
from fleetlens.operators.scan import previous_value
from fleetlens.session import discard, materialize, ranged
from fleetlens.sources.config import normalized_rules

US = 1_000_000


def rule_matches(match: dict[str, str], columns: list[str]) -> Column:
    """every match pair equals the stripped signal field; an absent field counts as ''."""
    cond = F.lit(True)
    for key, expected in match.items():
        actual = F.coalesce(py_strip(F.col(key).cast("string")), F.lit("")) if key in columns else F.lit("")
        cond = cond & (actual == F.lit(expected))
    return cond


def first_match(signals: DataFrame, rules: list[dict[str, Any]] | None = None) -> DataFrame:
    """Attach the first enabled matching rule (or the no-match default) to each signal.

    Adds: rule_name, action_type, decision, reason, alert_key, cooldown_seconds.
    ``decision`` here is the rule outcome before cooldown (execute / execute_chain / ignore).
    """
    from fleetlens.session import cached_expr

    cols = signals.columns
    key = ("first_match", tuple(cols), repr(rules) if rules is not None else "configured")
    idx, outputs = cached_expr(key, lambda: _first_match_exprs(cols, rules))
    out = signals.withColumn("_rule_idx", idx)
    # the rule outputs come out of a generator: a later filter on ``decision`` cannot be pushed below it
    # (it would drag the whole rule chain into the scan and evaluate it twice)
    gen = F.inline(F.array(F.struct(*[e.alias(n) for n, e in outputs.items()])))
    return out.select(*cols, "_rule_idx", gen).drop("_rule_idx")


def _first_match_exprs(cols: list[str], rules: list[dict[str, Any]] | None):
    rules = [r for r in normalized_rules(rules) if r["enabled"]]
    idx = None
    for i, r in enumerate(rules):
        cond = rule_matches(r["match"], cols)
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    idx = idx if idx is not None else F.lit(None)

    def pick(values: list, otherwise) -> Column:
        m = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(i), F.lit(v))]) if values else None
        got = F.try_element_at(m, F.col("_rule_idx")) if m is not None else F.lit(None)
        return F.coalesce(got, F.lit(otherwise)) if otherwise is not None else got

    fp = py_strip(F.coalesce(F.col("fingerprint").cast("string"), F.lit("")))
    fallback = F.coalesce(F.nullif(py_strip(F.coalesce(F.col("alertname"), F.lit(""))), F.lit("")),
                          F.lit("unknown-alert"))
    key_suffix = F.when(fp != "", fp).otherwise(fallback)
    action_type = pick([r["action_type"] for r in rules], None)
    rule_name = pick([r["name"] for r in rules], None)
    decision = (F.when(action_type == "chain", F.lit("execute_chain"))
                .when(action_type == "execute", F.lit("execute"))
                .otherwise(F.lit("ignore")))
    reason = (
        F.when(F.col("_rule_idx").isNull(), F.lit("no matching action rule"))
        .when(action_type == "ignore", F.concat(F.lit("matched ignore rule: "), rule_name))
        .when(action_type == "execute", F.concat(F.lit("matched execute rule: "), rule_name))
        .otherwise(F.concat(F.lit("matched chain rule: "), rule_name))
    )
    outputs = {
        "rule_name": rule_name,
        "action_type": F.coalesce(action_type, F.lit("none")),
        "decision": decision,
        "reason": reason,
        "alert_key": F.when(F.col("_rule_idx").isNull(), key_suffix).otherwise(F.concat(rule_name, F.lit(":"), key_suffix)),
        "cooldown_seconds": pick([r["cooldown_seconds"] for r in rules], 0).cast("long"),
    }
    return idx, outputs


def _cooldown_reason(rule_name: Column) -> Column:
    return F.concat(F.lit("matched rule '"), rule_name, F.lit("' but action recently executed"))


def _executions(cands: DataFrame) -> DataFrame:
    """Executed signal ids (``sid``) among candidates (alert_key, t, sid, cd_us)."""
    rows = previous_value(ranged(cands, ["alert_key", "t", "sid"], "cooldown-ranged"), ["alert_key"], ["t", "sid"], "t", "prev_t")
    second = lambda t: t - F.pmod(t, F.lit(US))
    first = F.col("prev_t").isNull() | (F.col("t") - second(F.col("prev_t")) >= F.col("cd_us"))
    marked = materialize(rows.select("alert_key", "t", "sid", "cd_us", first.alias("first")), "cooldown-islands")
    heads = marked.where("first").select("sid")
    probes = marked.select("alert_key", (second(F.col("t")) + F.col("cd_us")).alias("p"), F.col("sid").alias("pid"))
    succ = next_at_or_after(marked.select("alert_key", "t", F.col("sid").alias("eid")), probes, ["alert_key"])
    jump = succ.where(F.col("m_id").isNotNull()).select(F.col("pid").alias("src"), F.col("m_id").alias("dst"))
    # the next island's head is executed anyway
    jump = materialize(jump.join(heads, jump["dst"] == heads["sid"], "left_anti"), "cooldown-jump")
    execs = heads
    while not jump.isEmpty():  # execs: everything within 2^k steps of a head; jump: 2^k steps at once
        ahead = execs.join(jump, execs["sid"] == jump["src"]).select(F.col("dst").alias("sid"))
        execs, old = materialize(execs.unionByName(ahead), "cooldown-execs"), execs
        twice = jump.alias("a").join(jump.alias("b"), F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst"))
        jump, used = materialize(twice, "cooldown-jump"), jump
        discard(used, *([old] if old is not heads else []))
    return execs


def greedy_cooldown(decided: DataFrame) -> DataFrame:
    """Batch replay assuming every execution succeeds (the clock restarts at each execution).

    ``decided`` is the output of :func:`first_match` with ``signal_id`` and ``ts``. Signals of rules
    with ``cooldown_seconds > 0`` that come less than the cooldown after the previous *execution* of
    the same ``alert_key`` become ``cooldown``. The stored execution time has second precision (the
    reference stores text), so elapsed = ts - trunc_to_second(last_execution).
    """
    is_cand = (F.col("decision") != "ignore") & (F.col("cooldown_seconds") > 0)
    execs = _executions(decided.where(is_cand).select(
        "alert_key", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"),
        F.col("signal_id").alias("sid"), (F.col("cooldown_seconds") * F.lit(US)).alias("cd_us")))
    flagged = execs.select("sid", F.lit(True).alias("_exec"))
    out = decided.join(flagged, decided["signal_id"] == flagged["sid"], "left").drop("sid")
    suppressed = is_cand & F.col("_exec").isNull()
    return (
        out.withColumn("reason", F.when(suppressed, _cooldown_reason(F.col("rule_name"))).otherwise(F.col("reason")))
        .withColumn("decision", F.when(suppressed, F.lit("cooldown")).otherwise(F.col("decision")))
        .drop("_exec")
    )


def successful_executions(decided: DataFrame, tasks: DataFrame) -> DataFrame:
    """Cooldown clock is stamped when the decision's task finished with ``success``.

    Returns (alert_key, exec_ts) - one row per successful execution.
    """
    d = decided.where(F.col("decision").isin("execute", "execute_chain")).select("signal_id", "alert_key")
    t = tasks.where((F.col("status") == "success") & F.col("finished_at").isNotNull()).select(
        "decision_id", "finished_at")
    return d.join(t, d["signal_id"] == t["decision_id"]).select("alert_key", F.col("finished_at").alias("exec_ts"))


def cooldown_asof(decided: DataFrame, tasks: DataFrame) -> DataFrame:
    """Decide cooldown from *recorded* executions (as-of backward, keyed by alert_key).

    For each candidate signal the last successful execution at or before its time is looked up;
    elapsed < cooldown (and cooldown > 0) -> ``cooldown``. Adds ``last_executed_at``.
    The narrow columns the lookup needs are written once under the shared checkpoint directory, so
    the executions and the probes read them instead of re-running the upstream plan.
    """
    narrow = materialize(decided.select("signal_id", "ts", "alert_key", "decision", "cooldown_seconds"),
                         "cooldown-asof-narrow")
    execs = successful_executions(narrow, tasks)
    ev = execs.select("alert_key", F.unix_micros(F.date_trunc("second", "exec_ts")).alias("t"),
                      F.monotonically_increasing_id().alias("eid"))
    is_cand = (F.col("decision") != "ignore") & (F.col("cooldown_seconds") > 0)
    probes = narrow.where(is_cand).select("alert_key", F.unix_micros(F.col("ts").cast("timestamp")).alias("p"),
                                          F.col("signal_id").alias("pid"))
    last = prev_at_or_before(ev, probes, ["alert_key"])
    last = last.select(F.col("pid").alias("_sid"), F.col("m_t").alias("_last_us"))
    out = decided.join(last, decided["signal_id"] == last["_sid"], "left").drop("_sid")
    elapsed = F.unix_micros(F.col("ts").cast("timestamp")) - F.col("_last_us")
    suppressed = is_cand & F.col("_last_us").isNotNull() & (elapsed < F.col("cooldown_seconds") * F.lit(US))
    return (
        out.withColumn("reason", F.when(suppressed, _cooldown_reason(F.col("rule_name"))).otherwise(F.col("reason")))
        .withColumn("decision", F.when(suppressed, F.lit("cooldown")).otherwise(F.col("decision")))
        .withColumn("last_executed_at", F.timestamp_micros(F.col("_last_us")))
        .drop("_last_us")
    )


def decisions_by_type(decisions: DataFrame) -> DataFrame:
    """A1: count by decision."""
    return decisions.groupBy("decision").agg(F.count(F.lit(1)).alias("count"))
