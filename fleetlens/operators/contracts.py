"""Contracts of model-written JSON, compiled to column checks over VARIANT.

A contract is a nested description: an object with its members (all required, no others allowed), an array with the contract
of its items, or a string, possibly with its allowed values. :func:`violations` compiles it into one column: the path and
rule of each violation, in the order of the contract. No Python runs per row; items of arrays are checked by
higher-order functions, so a document may hold any number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT = {"type": "string"}
TEXTS = {"type": "array", "items": TEXT}

# FIXED VALUES - members and status values of the brief's and the weekly review's answers.
BRIEF = {"type": "object", "members": {
    "brief_status": {"type": "string", "values": ["stable", "watch", "risky"]},
    "executive_summary": TEXT, "top_risks": TEXTS, "recommended_actions": TEXTS, "operator_note": TEXT}}
WEEKLY = {"type": "object", "members": {
    "week_status": {"type": "string", "values": ["quiet", "stable", "watch", "risky"]},
    "executive_summary": TEXT,
    "top_issues": {"type": "array", "items": {"type": "object", "members": {"title": TEXT, "severity": TEXT, "evidence": TEXT}}},
    "recurring_patterns": TEXTS, "noise_or_expected": TEXTS,
    "recommended_actions": {"type": "array", "items": {"type": "object", "members": {"priority": TEXT, "action": TEXT, "why": TEXT}}}}}


def _none() -> Column:
    return F.array().cast("array<string>")


def _said(path: Column, what: str) -> Column:
    return F.array(F.concat(path, F.lit(f": {what}")))


def _kind(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _checks(value: Column, contract: dict, path: Column) -> Column:
    """Violations of a present value (a VARIANT) against a contract."""
    kind = contract["type"]
    if kind == "string":
        allowed = contract.get("values")
        text = F.try_variant_get(value, "$", "string")
        wrong = F.when(~text.isin(*allowed), _said(path, f"not one of {', '.join(allowed)}")).otherwise(_none()) if allowed else _none()
        return F.when(~_kind(value, "STRING"), _said(path, "not a string")).otherwise(wrong)
    if kind == "array":
        items = F.try_variant_get(value, "$", "array<variant>")
        each = F.flatten(F.transform(items, lambda x, i: _checks(x, contract["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        return F.when(~_kind(value, "ARRAY"), _said(path, "not an array")).otherwise(each)
    members = contract["members"]
    held = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
    extra = F.transform(F.array_sort(F.array_except(held, F.array(*(F.lit(m) for m in members)))), lambda k: F.concat(path, F.lit("."), k, F.lit(": not allowed")))
    parts = []
    for name, own in members.items():
        at = F.concat(path, F.lit(f".{name}"))
        parts.append(F.when(F.array_contains(held, name), _checks(F.try_variant_get(value, f"$.{name}", "variant"), own, at)).otherwise(_said(at, "missing")))
    return F.when(~_kind(value, "OBJECT"), _said(path, "not an object")).otherwise(F.concat(*parts, extra))


def violations(text: str | Column, contract: dict) -> Column:
    """Violations of a JSON text, ``path: rule`` each; empty where it keeps the contract."""
    value = F.try_parse_json(text)
    return F.when(value.isNull(), F.array(F.lit("$: no JSON"))).otherwise(_checks(value, contract, F.lit("$")))


def checked(df: DataFrame, text: str, contract: dict) -> DataFrame:
    """``df`` with ``violations``."""
    return df.withColumn("violations", violations(F.col(text), contract))


def route(df: DataFrame, text: str, contract: dict, accepted: str, quarantine: str) -> None:
    """Append rows that keep the contract to one sink, the others with their violations to another (both from one pass)."""
    from fleetlens.session import discard, materialize

    judged = materialize(checked(df, text, contract), "contract")
    judged.where(F.size("violations") == 0).drop("violations").write.mode("append").parquet(accepted)
    judged.where(F.size("violations") > 0).write.mode("append").parquet(quarantine)
    discard(judged)
