"""Files, backups, inspect output, collector text, agent logs, model responses
(S11, S13, S14, S16, S17, S18, J9, W6, D6, F13, U6, U7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import artifacts as AR
from fleetlens.operators import audits as AU
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

# FIXED VALUES - backup retention, audit freshness limit and report time point for logs.
BACKUP_KEEP = 7
AS_OF_UNIX = 1706659200  # 2024-01-31 00:00:00 UTC
MAX_AGE_SECONDS = 86400
AGENT_EVENT_PREFIXES = ["remediation_", "candidate_", "worker_"]
AGENT_TAIL = 80

_KIND_SQL = ("CASE WHEN regexp_matches(name, '^vps-backup-.*\\.tar\\.gz\\.sha256$') THEN 'checksum' "
             "WHEN regexp_matches(name, '^vps-backup-.*\\.tar\\.gz$') THEN 'archive' ELSE 'other' END")

# The fixture's files are all unpaired; checksums are added for every fourth archive so both the
# paired and the unpaired case occur.
FILES_PAIRED_SQL = """
fp AS (
  SELECT name, host, mtime_unix FROM files
  UNION ALL
  SELECT name || '.sha256', host, mtime_unix FROM files
  WHERE ends_with(name, '.tar.gz') AND CAST(regexp_extract(name, '(\\d+)', 1) AS BIGINT) % 4 = 0
)"""


def _files_paired(spark, sf_dir):
    f = fx.files(spark, sf_dir)
    extra = f.where(F.col("name").endswith(".tar.gz")
                    & (F.regexp_extract("name", r"(\d+)", 1).cast("long") % 4 == 0)).select(
        F.concat("name", F.lit(".sha256")).alias("name"), "host", "mtime_unix")
    return f.unionByName(extra)


@query("backup_inventory", f"""WITH {FILES_PAIRED_SQL},
k AS (SELECT *, {_KIND_SQL} AS kind FROM fp)
SELECT host, kind, name, mtime_unix,
  name = arg_max(name, (mtime_unix, name)) OVER (PARTITION BY host, kind) AS is_newest
FROM k WHERE kind <> 'other'
""", ctes=("files",))
def q_backup_inventory(spark, sf_dir):
    return AR.backup_inventory(_files_paired(spark, sf_dir))


@query("archive_pairs", f"""WITH {FILES_PAIRED_SQL},
k AS (SELECT *, {_KIND_SQL} AS kind FROM fp),
a AS (SELECT host, name AS base FROM k WHERE kind = 'archive'),
s AS (SELECT host, regexp_replace(name, '\\.sha256$', '') AS base FROM k WHERE kind = 'checksum')
SELECT coalesce(a.host, s.host) AS host, coalesce(a.base, s.base) AS base,
  a.base IS NOT NULL AS has_archive, s.base IS NOT NULL AS has_checksum
FROM a FULL OUTER JOIN s ON a.host = s.host AND a.base = s.base
""", ctes=("files",))
def q_archive_pairs(spark, sf_dir):
    return AR.archive_pairs(_files_paired(spark, sf_dir))


@query("pair_counts", f"""WITH {FILES_PAIRED_SQL},
k AS (SELECT *, {_KIND_SQL} AS kind FROM fp)
SELECT host, count(*) FILTER (WHERE kind = 'archive') AS tar_count, count(*) FILTER (WHERE kind = 'checksum') AS sha_count,
  count(*) FILTER (WHERE kind = 'archive') = count(*) FILTER (WHERE kind = 'checksum') AS pairs_match
FROM k GROUP BY host
""", ctes=("files",))
def q_pair_counts(spark, sf_dir):
    return AR.pair_counts(_files_paired(spark, sf_dir))


@query("retention_rank", f"""WITH {FILES_PAIRED_SQL},
k AS (SELECT *, {_KIND_SQL} AS kind FROM fp),
r AS (SELECT *, row_number() OVER (PARTITION BY host, kind ORDER BY mtime_unix DESC, name DESC) AS rn
      FROM k WHERE kind <> 'other')
SELECT host, kind, name, mtime_unix, CASE WHEN rn <= {BACKUP_KEEP} THEN CAST(rn AS INTEGER) END AS rank,
  rn > {BACKUP_KEEP} AS prune
FROM r
""", ctes=("files",))
def q_retention_rank(spark, sf_dir):
    return AR.retention_rank(_files_paired(spark, sf_dir), BACKUP_KEEP)


@query("latest_artifact", """
SELECT host, arg_max(log_id, (mtime_unix, log_id)) AS log_id, max(mtime_unix) AS mtime_unix FROM kv_logs GROUP BY host
""", ctes=("kv_logs",))
def q_latest_artifact(spark, sf_dir):
    return AR.latest_artifact(fx.kv_logs(spark, sf_dir), "host", "mtime_unix", "log_id")


@query("verify_audit", f"""
WITH lg AS (
  SELECT host, arg_max(log_id, (mtime_unix, log_id)) AS log_id, max(mtime_unix) AS mtime_unix
  FROM kv_logs WHERE mtime_unix <= {AS_OF_UNIX} GROUP BY host
),
hosts AS (SELECT DISTINCT host FROM kv_logs),
kv AS (
  SELECT k.log_id, trim(substr(trim(l.raw), 1, strpos(trim(l.raw), '=') - 1)) AS key
  FROM kv_logs k, unnest(string_split(k.text, chr(10))) AS l(raw)
  WHERE trim(l.raw) <> '' AND NOT starts_with(trim(l.raw), '===') AND strpos(trim(l.raw), '=') > 0
),
req AS (SELECT unnest({AU.STACK_REQUIRED_VERIFY_KEYS!r}) AS key),
miss AS (
  SELECT lg.log_id, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM kv WHERE kv.log_id = lg.log_id
                                                      AND kv.key = req.key)) AS missing
  FROM lg CROSS JOIN req GROUP BY lg.log_id
)
SELECT h.host, lg.log_id, lg.mtime_unix, {AS_OF_UNIX} - lg.mtime_unix AS age_seconds,
  CASE WHEN lg.mtime_unix IS NULL THEN 11 WHEN {AS_OF_UNIX} - lg.mtime_unix > {MAX_AGE_SECONDS} THEN 13
       WHEN m.missing > 0 THEN 15 ELSE 0 END AS exit_code
FROM hosts h LEFT JOIN lg ON lg.host = h.host LEFT JOIN miss m ON m.log_id = lg.log_id
""", ctes=("kv_logs",))
def q_verify_audit(spark, sf_dir):
    """D6 (stack variant) per host: latest log at or before as_of -> exists / fresh / required keys."""
    logs = fx.kv_logs(spark, sf_dir)
    hosts = logs.select("host").distinct()
    latest = AR.latest_artifact(logs.where(F.col("mtime_unix") <= AS_OF_UNIX), "host", "mtime_unix", "log_id")
    mk = AU.missing_keys(logs.join(latest.select("log_id"), "log_id", "left_semi")).select("log_id", "missing_count")
    j = hosts.join(latest, "host", "left").join(mk, "log_id", "left")
    v = AR.verify_audit(j, AS_OF_UNIX, MAX_AGE_SECONDS, "missing_count")
    return v.select("host", "log_id", "mtime_unix", "age_seconds", "exit_code")


@query("container_facts", """
SELECT inspect_id, container,
  CASE WHEN gone THEN 'no' WHEN failed THEN 'unknown' WHEN ok THEN 'yes' ELSE 'unknown' END AS exists,
  CASE WHEN gone THEN 'missing' WHEN failed THEN 'unknown' WHEN ok THEN coalesce(nullif(st, ''), 'unknown') ELSE 'unknown' END AS state,
  CASE WHEN failed THEN 'unknown' WHEN ok THEN coalesce(nullif(hl, ''), 'none') ELSE 'unknown' END AS health,
  CASE WHEN ok AND NOT failed THEN coalesce(img, '') ELSE '' END AS image,
  CASE WHEN gone THEN 'missing' WHEN failed THEN 'inspect_failed' WHEN ok THEN coalesce(nullif(st, ''), 'unknown') ELSE 'inspect_failed' END AS status,
  CASE WHEN gone THEN 'Error: No such object: x' WHEN failed THEN 'docker inspect failed' WHEN ok THEN ''
    WHEN valid THEN 'docker inspect returned unexpected payload' ELSE 'invalid docker inspect json' END AS error
FROM (
  SELECT inspect_id, container, inspect_id % 10 IN (7, 8) AS failed, inspect_id % 10 = 7 AS gone, coalesce(json_valid(raw), false) AS valid,
    coalesce(CASE WHEN json_valid(raw) THEN json_type(raw) = 'ARRAY' AND json_array_length(raw) > 0
             AND json_type(raw, '$[0]') = 'OBJECT' ELSE false END, false) AS ok,
    CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$[0].State.Status') END AS st,
    CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$[0].State.Health.Status') END AS hl,
    CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$[0].Config.Image') END AS img
  FROM inspect) x
""", ctes=("inspect",))
def q_container_facts(spark, sf_dir):
    """S18 with failed calls: every tenth container is gone, every tenth call fails without a word."""
    kind = F.col("inspect_id") % 10
    i = fx.inspect(spark, sf_dir).withColumn("exit_code", F.when(kind.isin(7, 8), 1).otherwise(0)).withColumn(
        "stderr", F.when(kind == 7, F.lit(" Error: No such object: x\n")).otherwise(F.lit("")))
    return i.select("inspect_id", "container", AR.flatten_container_inspect("raw", "exit_code", "stderr").alias("c")).select(
        "inspect_id", "container", "c.*")


@query("collector_facts", """
SELECT sample_id,
  TRY_CAST(nullif(regexp_extract(memory_text, 'System-wide memory free percentage:\\s+(\\d+)%', 1), '') AS DOUBLE)
    AS memory_free_percent,
  CASE WHEN regexp_extract(swap_text, 'used = ([0-9.]+)([MG])', 2) = 'G'
       THEN TRY_CAST(nullif(regexp_extract(swap_text, 'used = ([0-9.]+)([MG])', 1), '') AS DOUBLE) * CAST(1024 AS DOUBLE)
       ELSE TRY_CAST(nullif(regexp_extract(swap_text, 'used = ([0-9.]+)([MG])', 1), '') AS DOUBLE) END AS swap_used_mb,
  CASE WHEN regexp_extract(uptime_text, 'up\\s+(\\d+)\\s+days?,\\s+(\\d+):(\\d+)', 1) <> '' THEN
         CAST(CAST(regexp_extract(uptime_text, 'up\\s+(\\d+)\\s+days?,\\s+(\\d+):(\\d+)', 1) AS BIGINT) AS DOUBLE)
         + CAST(regexp_extract(uptime_text, 'up\\s+(\\d+)\\s+days?,\\s+(\\d+):(\\d+)', 2) AS BIGINT) / CAST(24 AS DOUBLE)
         + CAST(regexp_extract(uptime_text, 'up\\s+(\\d+)\\s+days?,\\s+(\\d+):(\\d+)', 3) AS BIGINT) / CAST(1440 AS DOUBLE)
       WHEN regexp_extract(uptime_text, 'up\\s+(\\d+):(\\d+),', 1) <> '' THEN
         CAST(0 AS DOUBLE)
         + CAST(regexp_extract(uptime_text, 'up\\s+(\\d+):(\\d+),', 1) AS BIGINT) / CAST(24 AS DOUBLE)
         + CAST(regexp_extract(uptime_text, 'up\\s+(\\d+):(\\d+),', 2) AS BIGINT) / CAST(1440 AS DOUBLE)
  END AS uptime_days,
  TRY_CAST(regexp_extract(disk_text, '100Gi ([0-9]+)% /', 1) AS INTEGER) AS disk_used_percent,
  CASE battery_kind WHEN 0 THEN 93 WHEN 1 THEN 41 END AS battery_percent,
  CASE battery_kind WHEN 0 THEN 'ac' WHEN 1 THEN 'battery' ELSE 'unknown' END AS power_source,
  CASE WHEN installed_kind <> 0 THEN CASE outdated_kind WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END END AS outdated,
  CASE backup_kind WHEN 0 THEN '/Volumes/tm/2024-01-31-235959.backup' WHEN 1 THEN '/Volumes/tm/2024-13-31-235959.backup'
    WHEN 2 THEN '/Volumes/tm/latest' END AS latest_backup,
  CASE WHEN backup_kind = 0 THEN greatest(0, 1706832000 - CAST(epoch(TIMESTAMP '2024-01-31 23:59:59') AS BIGINT)) END AS backup_age_seconds,
  CASE launchd_kind WHEN 4 THEN NULL ELSE launchd_kind IN (0, 1) END AS launchd_loaded,
  CASE launchd_kind WHEN 4 THEN NULL ELSE launchd_kind IN (0, 2) END AS launchd_running
FROM collector
""", ctes=("collector",))
def q_collector_facts(spark, sf_dir):
    c = fx.collector(spark, sf_dir)
    launchd = AR.parse_launchd_state("launchd_text", ["memory-worker", "memory-report"])
    return c.select("sample_id", AR.parse_memory_free("memory_text").alias("memory_free_percent"),
                    AR.parse_swap_used_mb("swap_text").alias("swap_used_mb"),
                    AR.parse_uptime_days("uptime_text").alias("uptime_days"),
                    AR.parse_disk_used_percent("disk_text").alias("disk_used_percent"), AR.parse_battery_percent("battery_text").alias("battery_percent"),
                    AR.parse_power_source("battery_text").alias("power_source"), AR.parse_outdated_count("installed_text", "outdated_text").alias("outdated"),
                    AR.parse_latest_backup("backup_text").alias("latest_backup"),
                    AR.parse_backup_age_seconds("backup_text", F.lit(1706832000).cast("long")).alias("backup_age_seconds"),
                    launchd["loaded"].alias("launchd_loaded"), launchd["running"].alias("launchd_running"))


_AGENT_SQL = """
al AS (
  SELECT line_no, regexp_extract(line, '^\\[([^\\]]*)\\] level=(\\S+) event=(\\S+)(.*)$', 1) AS ts_text,
    regexp_extract(line, '^\\[([^\\]]*)\\] level=(\\S+) event=(\\S+)(.*)$', 2) AS level,
    regexp_extract(line, '^\\[([^\\]]*)\\] level=(\\S+) event=(\\S+)(.*)$', 3) AS event,
    regexp_extract(line, '^\\[([^\\]]*)\\] level=(\\S+) event=(\\S+)(.*)$', 4) AS rest
  FROM agent_log
)"""


def _field_sql(key: str) -> str:
    raw = f"regexp_extract(rest, '(?:^|\\s){key}=(\"[^\"]*\"|\\S+)', 1)"
    return (f"CASE WHEN {raw} = '' OR {raw} = 'null' THEN NULL "
            f"WHEN starts_with({raw}, '\"') AND ends_with({raw}, '\"') AND length({raw}) >= 2 "
            f"THEN substr({raw}, 2, length({raw}) - 2) ELSE {raw} END")


@query("agent_log_fields", f"""WITH {_AGENT_SQL}
SELECT line_no, ts_text, level, event, {_field_sql('task_id')} AS task_id, {_field_sql('reason')} AS reason,
  {_field_sql('error')} AS error FROM al
""", ctes=("agent_log",))
def q_agent_log_fields(spark, sf_dir):
    p = AR.parse_agent_log(fx.agent_log(spark, sf_dir))
    return p.select("line_no", "ts_text", "level", "event", F.col("fields")["task_id"].alias("task_id"),
                    F.col("fields")["reason"].alias("reason"), F.col("fields")["error"].alias("error"))


@query("agent_event_search", f"""WITH {_AGENT_SQL}
SELECT line_no, event FROM al
WHERE {' OR '.join(f"starts_with(event, '{p}')" for p in AGENT_EVENT_PREFIXES)}
ORDER BY line_no DESC LIMIT {AGENT_TAIL}
""", ctes=("agent_log",))
def q_agent_event_search(spark, sf_dir):
    p = AR.parse_agent_log(fx.agent_log(spark, sf_dir))
    return AR.agent_event_search(p, AGENT_EVENT_PREFIXES, AGENT_TAIL, ["line_no"]).select("line_no", "event")


@query("response_text", """
SELECT response_id,
  CASE WHEN NOT json_valid(response) THEN ''
       WHEN trim(coalesce(json_extract_string(response, '$.output_text'), '')) <> ''
         THEN trim(json_extract_string(response, '$.output_text'))
       WHEN json_type(response, '$.output') = 'ARRAY' THEN coalesce(trim(array_to_string(
         list_transform(list_filter(CAST(json_extract_string(response, '$.output[*].content[*].text') AS VARCHAR[]),
                                    lambda t: t IS NOT NULL AND trim(t) <> ''), lambda t: trim(t)), chr(10))), '')
       ELSE '' END AS text
FROM responses
""", ctes=("responses",))
def q_response_text(spark, sf_dir):
    r = fx.responses(spark, sf_dir)
    return r.select("response_id", AR.extract_output_text("response").alias("text"))


@query("review_validation", f"""
SELECT response_id,
  coalesce(json_valid(review) AND json_type(review) = 'OBJECT'
    AND len(list_filter({AR.BRIEF_KEYS!r}, lambda k: NOT list_contains(json_keys(review), k))) = 0
    AND len(list_filter(json_keys(review), lambda k: NOT list_contains({AR.BRIEF_KEYS!r}, k))) = 0
    AND json_extract_string(review, '$.brief_status') IN {tuple(AR.BRIEF_STATUS)!r}, false) AS valid,
  array_to_string(list_filter({AR.BRIEF_KEYS!r}, lambda k: NOT coalesce(list_contains(
    CASE WHEN json_valid(review) AND json_type(review) = 'OBJECT' THEN json_keys(review) END, k), false)), ',')
    AS missing_keys,
  coalesce(array_to_string(list_sort(list_filter(
    CASE WHEN json_valid(review) AND json_type(review) = 'OBJECT' THEN json_keys(review) END,
    lambda k: NOT list_contains({AR.BRIEF_KEYS!r}, k))), ','), '') AS extra_keys
FROM responses
""", ctes=("responses",))
def q_review_validation(spark, sf_dir):
    r = fx.responses(spark, sf_dir)
    return r.select("response_id", AR.validate_review("review").alias("v")).select("response_id", "v.*")


@query("weekly_retention", """
WITH f AS (
  SELECT DISTINCT host, 'weekly-' || strftime(strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC'), '%Y-%m-%d_%H-%M') || x.s AS name, x.s[2:] AS suffix
  FROM snapshots, (VALUES ('.json'), ('.md'), ('.txt')) x(s)
  UNION SELECT DISTINCT host, 'weekly-latest' || x.s, x.s[2:] FROM snapshots, (VALUES ('.json'), ('.md')) x(s)),
r AS (SELECT *, row_number() OVER (PARTITION BY host, suffix ORDER BY name DESC) AS rn FROM f WHERE suffix IN ('json', 'md'))
SELECT host, suffix, name, CASE WHEN rn <= 12 THEN CAST(rn AS INTEGER) END AS rank,
  rn > 12 AND name NOT LIKE 'weekly-latest.%' AS prune
FROM r
""", ctes=("snapshots",))
def q_weekly_retention(spark, sf_dir):
    """Weekly reports of every host, the latest link among them; other suffixes don't count."""
    s = fx.snapshots(spark, sf_dir).select("host", F.regexp_replace(F.regexp_replace(F.substring("timestamp_utc", 1, 16), " ", "_"), ":", "-").alias("t"))
    dated = s.select("host", F.explode(F.array(*[F.concat(F.lit("weekly-"), "t", F.lit(x)) for x in (".json", ".md", ".txt")])).alias("name"))
    latest = s.select("host", F.explode(F.array(F.lit("weekly-latest.json"), F.lit("weekly-latest.md"))).alias("name"))
    return AR.weekly_retention(dated.unionByName(latest), 12)


_OBJECT_TEXT = "CASE response_id % 5 WHEN 0 THEN '[1,2]' WHEN 1 THEN '{{bad' WHEN 2 THEN '5' WHEN 3 THEN review ELSE '{{\"a\":\"1\",\"b\":\"x y\"}}' END".replace("{{", "{").replace("}}", "}")


@query("safe_json_objects", f"""
SELECT response_id, CAST(CASE WHEN json_valid(t) AND json_type(t) = 'OBJECT' THEN len(json_keys(t)) ELSE 0 END AS INTEGER) AS n_keys,
  CASE WHEN json_valid(t) THEN json_extract_string(t, '$.b') END AS b
FROM (SELECT response_id, {_OBJECT_TEXT} AS t FROM responses) x
""", ctes=("responses",))
def q_safe_json_objects(spark, sf_dir):
    """Objects become maps; bad JSON, lists and numbers an empty map."""
    from fleetlens.functions.maps import safe_json_object

    k = F.col("response_id") % 5
    t = F.when(k == 0, F.lit("[1,2]")).when(k == 1, F.lit("{bad")).when(k == 2, F.lit("5")).when(k == 3, F.col("review")).otherwise(F.lit('{"a":"1","b":"x y"}'))
    m = safe_json_object(F.col("t"))
    return fx.responses(spark, sf_dir).select("response_id", t.alias("t")).select("response_id", F.size(m).alias("n_keys"), F.try_element_at(m, F.lit("b")).alias("b"))
