"""Verification of the four audits (D6) over logs of a fleet, each guard hit by some host."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import audits as AU
from fleetlens.operators import verify as VF
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

# FIXED VALUES - the time of verification (30 hours and 10 minutes into the logs) and the longest age.
AS_OF, MAX_AGE = 1704067200 + 30 * 3600 + 600, 9000

# One file per log written before the verification; some are empty, unreadable or can't be looked at.
_FILES_SQL = f"""
files AS (
  SELECT host, 'audit_' || lpad(CAST(log_id AS VARCHAR), 9, '0') || '.log' AS name, CASE WHEN log_id % 23 = 0 THEN NULL ELSE mtime_unix END AS mtime_unix,
    CASE WHEN log_id % 7 = 0 THEN 0 ELSE length(text) END AS size, CASE WHEN log_id % 29 = 0 THEN NULL ELSE text END AS text
  FROM kv_logs WHERE mtime_unix <= {AS_OF}),
hosts AS (SELECT DISTINCT host FROM kv_logs),
last AS (SELECT host, arg_max(name, (coalesce(mtime_unix, -1), name)) AS name FROM files GROUP BY host),
l AS (SELECT h.host, f.name, f.mtime_unix, {AS_OF} - f.mtime_unix AS age_seconds, f.size, f.text FROM hosts h LEFT JOIN last USING (host) LEFT JOIN files f ON f.host = h.host AND f.name = last.name)"""


def _verdict_sql(cases: str, errors: str) -> str:
    return (f"v AS (SELECT *, CASE {cases} ELSE 0 END AS exit_code, CASE {errors} END AS error FROM l) "
            "SELECT host, name, age_seconds, exit_code, CASE WHEN exit_code = 0 THEN 'success' ELSE 'failed' END AS status, error FROM v")


def _files(spark, sf_dir):
    k = F.col("log_id")
    logs = fx.kv_logs(spark, sf_dir).where(F.col("mtime_unix") <= AS_OF)
    return logs.select("host", F.concat(F.lit("audit_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".log")).alias("name"),
                       F.when(k % 23 != 0, F.col("mtime_unix")).alias("mtime_unix"), F.when(k % 7 == 0, 0).otherwise(F.length("text")).alias("size"),
                       F.when(k % 29 != 0, F.col("text")).alias("text"))


def _of_all_hosts(spark, sf_dir, latest):
    return fx.kv_logs(spark, sf_dir).select("host").distinct().join(latest, "host", "left")


@query("verify_vps", f"WITH {_FILES_SQL}, " + _verdict_sql(
    f"WHEN name IS NULL THEN 10 WHEN age_seconds > {MAX_AGE} THEN 14", f"WHEN name IS NULL THEN 'no vps audit logs found' WHEN age_seconds > {MAX_AGE} THEN 'latest vps audit log is too old'"),
    ctes=("kv_logs",))
def q_verify_vps(spark, sf_dir):
    return VF.verify(_of_all_hosts(spark, sf_dir, VF.newest_by_time(_files(spark, sf_dir))), "vps", AS_OF, MAX_AGE)


@query("verify_admin", f"WITH {_FILES_SQL}, " + _verdict_sql(
    f"WHEN name IS NULL THEN 12 WHEN size = 0 THEN 13 WHEN age_seconds > {MAX_AGE} THEN 14",
    f"WHEN name IS NULL THEN 'verify command failed: NO_LOG' WHEN size = 0 THEN 'verify command failed: EMPTY_LOG|' || name WHEN age_seconds > {MAX_AGE} THEN 'latest audit log is too old'"),
    ctes=("kv_logs",))
def q_verify_admin(spark, sf_dir):
    return VF.verify(_of_all_hosts(spark, sf_dir, VF.newest_by_time(_files(spark, sf_dir))), "admin", AS_OF, MAX_AGE)


@query("verify_stack", f"""WITH {_FILES_SQL},
req AS (SELECT unnest({AU.STACK_REQUIRED_VERIFY_KEYS!r}) AS key, unnest(range({len(AU.STACK_REQUIRED_VERIFY_KEYS)})) AS i),
have AS (SELECT DISTINCT host, trim(split_part(x, '=', 1)) AS key FROM (SELECT host, unnest(string_split(text, chr(10))) AS x FROM l) y WHERE strpos(x, '=') > 0 AND NOT starts_with(trim(x), '===')),
miss AS (SELECT l.host, count(*) AS n, string_agg(req.key, ', ' ORDER BY i) AS missing FROM l CROSS JOIN req LEFT JOIN have ON have.host = l.host AND have.key = req.key WHERE have.key IS NULL GROUP BY l.host),
m AS (SELECT l.*, n, missing FROM l LEFT JOIN miss USING (host)), """ + _verdict_sql(
    f"WHEN name IS NULL THEN 11 WHEN mtime_unix IS NULL THEN 12 WHEN age_seconds > {MAX_AGE} THEN 13 WHEN text IS NULL THEN 14 WHEN n > 0 THEN 15",
    f"WHEN name IS NULL THEN 'no monitoring stack audit log found' WHEN mtime_unix IS NULL THEN 'failed to stat audit log' WHEN age_seconds > {MAX_AGE} THEN "
    "'latest monitoring stack audit log is too old' WHEN text IS NULL THEN 'failed to parse audit log' WHEN n > 0 THEN 'monitoring stack audit log missing required keys: ' || missing").replace("FROM l)", "FROM m)"),
    ctes=("kv_logs",))
def q_verify_stack(spark, sf_dir):
    return VF.verify(_of_all_hosts(spark, sf_dir, VF.newest_by_time(_files(spark, sf_dir))), "stack", AS_OF, MAX_AGE)


_SNAPS = f"""
s AS (SELECT host, 'audit_' || strftime(to_timestamp(timestamp_unix) AT TIME ZONE 'UTC', '%Y%m%d_%H%M%S') || '.json' AS name, timestamp_unix AS mtime_unix
  FROM snapshots WHERE timestamp_unix <= {AS_OF} AND host NOT IN ('host-5', 'host-6')),
hosts AS (SELECT DISTINCT host FROM snapshots),
ends AS (SELECT host, min(name) AS oldest, max(name) AS newest FROM s GROUP BY host),
l AS (SELECT h.host, s.name, s.mtime_unix, {AS_OF} - s.mtime_unix AS age_seconds
  FROM hosts h LEFT JOIN ends USING (host) LEFT JOIN s ON s.host = h.host AND s.name = CASE WHEN right(h.host, 1) IN ('0', '3') THEN oldest ELSE newest END)"""


@query("verify_mac", f"WITH {_SNAPS}, " + _verdict_sql(
    f"WHEN name IS NULL THEN 1 WHEN age_seconds > {MAX_AGE} THEN 2", f"WHEN name IS NULL THEN 'no mac host audit snapshot found' WHEN age_seconds > {MAX_AGE} THEN 'mac host audit snapshot too old: ' || age_seconds || 's'"),
    ctes=("snapshots",))
def q_verify_mac(spark, sf_dir):
    """Hosts whose number ends in 0 or 3 have a pointer file, which still names their oldest snapshot; two hosts have none at all."""
    all_of = fx.snapshots(spark, sf_dir)
    snaps = all_of.where((F.col("timestamp_unix") <= AS_OF) & ~F.col("host").isin("host-5", "host-6"))
    name = F.concat(F.lit("audit_"), F.date_format(F.timestamp_seconds("timestamp_unix"), "yyyyMMdd_HHmmss"), F.lit(".json"))
    files = snaps.select("host", name.alias("name"), F.col("timestamp_unix").alias("mtime_unix"), F.lit(1).alias("size"), F.lit("{}").alias("text"), F.lit(None).cast("string").alias("target"))
    oldest = files.where(F.col("host").rlike("[03]$")).groupBy("host").agg(F.min("name").alias("target"))
    files = files.unionByName(oldest.withColumn("name", F.lit(VF.MAC_POINTER)), allowMissingColumns=True)
    latest = VF.newest_snapshot(files)
    return VF.verify(all_of.select("host").distinct().join(latest, "host", "left"), "mac", AS_OF, MAX_AGE)
