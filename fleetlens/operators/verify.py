"""Audit verification per host (D6): the newest artifact is chosen, then an ordered table of guards gives exit code and error.

A domain's guards are data: (what is wrong, exit code, error text), in order; they compile to one cascade over plain columns, so
verification adds no shuffle to the choice of the newest artifact. Artifacts are rows (host, name, mtime_unix, size, text); a
host without one has nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.audits import STACK_REQUIRED_VERIFY_KEYS, kv_facts_map

# FIXED VALUES - guards of the four audits: condition, exit code, error text ({} is filled in).
GUARDS = {
    "vps": [("no_log", 10, "no vps audit logs found"), ("too_old", 14, "latest vps audit log is too old")],
    "admin": [("no_log", 12, "verify command failed: NO_LOG"), ("empty", 13, "verify command failed: EMPTY_LOG|{name}"), ("too_old", 14, "latest audit log is too old")],
    "stack": [("no_log", 11, "no monitoring stack audit log found"), ("no_stat", 12, "failed to stat audit log"),
              ("too_old", 13, "latest monitoring stack audit log is too old"), ("unreadable", 14, "failed to parse audit log"),
              ("keys", 15, "monitoring stack audit log missing required keys: {missing}")],
    "mac": [("no_log", 1, "no mac host audit snapshot found"), ("too_old", 2, "mac host audit snapshot too old: {age}s")],
}
MAC_POINTER = "latest.json"


def newest_by_time(files: DataFrame) -> DataFrame:
    """The newest artifact of each host; ties by name."""
    return _newest(files, "mtime_unix", "name")


def newest_snapshot(files: DataFrame) -> DataFrame:
    """Mac: what the host's pointer file names (``target``), whether it is the newest or not; without a pointer the last
    ``audit_*.json`` by name."""
    named = files.where(F.col("name").rlike(r"^audit_.*\.json$"))
    points = files.where((F.col("name") == MAC_POINTER) & F.col("target").isNotNull()).groupBy("host").agg(F.max("target").alias("target"))
    last = _newest(named.drop("target"), "name")
    followed = points.join(named.drop("target"), (points["host"] == named["host"]) & (points["target"] == named["name"])).select(
        points["host"], "name", "mtime_unix", "size", "text")
    return followed.unionByName(last.join(points.select("host"), "host", "left_anti"))


def _newest(files: DataFrame, *order: str) -> DataFrame:
    columns = [c for c in files.columns if c != "host"]
    return files.groupBy("host").agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("x")).select("host", "x.*")


def verify(latest: DataFrame, domain: str, as_of_unix: int, max_age_seconds: int) -> DataFrame:
    """(host, name, age_seconds, exit_code, status, error) of each host's newest artifact."""
    age = F.lit(as_of_unix) - F.col("mtime_unix")
    missing = F.array_except(F.array(*(F.lit(k) for k in STACK_REQUIRED_VERIFY_KEYS)), F.map_keys(kv_facts_map("text"))) if domain == "stack" else F.array()
    wrong: dict[str, Column] = {
        "no_log": F.col("name").isNull(), "no_stat": F.col("mtime_unix").isNull(), "empty": F.coalesce(F.col("size"), F.lit(0)) == 0,
        "too_old": age > max_age_seconds, "unreadable": F.col("text").isNull(), "keys": F.size("_missing") > 0}
    filled = {"name": F.col("name"), "missing": F.array_join("_missing", ", "), "age": age.cast("string")}
    code = error = None
    for what, number, text in GUARDS[domain]:
        said = F.lit(text)
        for k, v in filled.items():
            if f"{{{k}}}" in text:
                said = F.replace(said, F.lit(f"{{{k}}}"), F.coalesce(v, F.lit("")))
        code = F.when(wrong[what], number) if code is None else code.when(wrong[what], number)
        error = F.when(wrong[what], said) if error is None else error.when(wrong[what], said)
    out = latest.withColumn("_missing", missing.cast("array<string>")).withColumn("exit_code", code.otherwise(0)).withColumn("error", error)
    return out.select("host", "name", age.alias("age_seconds"), "exit_code", F.when(F.col("exit_code") == 0, "success").otherwise("failed").alias("status"), "error")
