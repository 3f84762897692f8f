"""Files, backups, captured command output and agent logs (S11, S13, S14, S16, S17, S18, J9, W6, D6,
F13, P29, P30, U6, U7).

All per-row parsing is expression-based. The per-group choices are aggregates (``max_by``) or
top-k limits (``row_number() <= n``, planned with a partial group limit before the shuffle), so a
host or kind holding most of the files is reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.text import py_strip
from fleetlens.functions.timefn import uptime_days


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ----------------------------------------------------------------------------- backups

def file_kind(name) -> Column:
    n = _c(name)
    return (F.when(n.rlike(r"^vps-backup-.*\.tar\.gz\.sha256$"), F.lit("checksum"))
            .when(n.rlike(r"^vps-backup-.*\.tar\.gz$"), F.lit("archive")).otherwise(F.lit("other")))


def backup_inventory(files: DataFrame) -> DataFrame:
    """Archives and checksums by name pattern, newest flagged (max mtime per host and kind)."""
    f = files.withColumn("kind", file_kind("name")).where(F.col("kind") != "other")
    newest = f.groupBy("host", "kind").agg(F.max_by("name", F.struct("mtime_unix", "name")).alias("newest_name"))
    return f.join(newest, ["host", "kind"]).select(
        "host", "kind", "name", "mtime_unix", (F.col("name") == F.col("newest_name")).alias("is_newest"))


def archive_pairs(files: DataFrame) -> DataFrame:
    """Full outer join of archives and checksums on (host, archive name)."""
    f = files.withColumn("kind", file_kind("name"))
    a = f.where(F.col("kind") == "archive").select("host", F.col("name").alias("base"), F.lit(True).alias("a"))
    s = f.where(F.col("kind") == "checksum").select(
        "host", F.regexp_replace("name", r"\.sha256$", "").alias("base"), F.lit(True).alias("s"))
    j = a.join(s, ["host", "base"], "full_outer")
    return j.select("host", "base", F.coalesce("a", F.lit(False)).alias("has_archive"),
                    F.coalesce("s", F.lit(False)).alias("has_checksum"))


def pair_counts(files: DataFrame) -> DataFrame:
    """J9 per host: archive and checksum counts; pairs match when equal."""
    f = files.withColumn("kind", file_kind("name"))
    g = f.groupBy("host").agg(F.count_if(F.col("kind") == "archive").alias("tar_count"),
                              F.count_if(F.col("kind") == "checksum").alias("sha_count"))
    return g.withColumn("pairs_match", F.col("tar_count") == F.col("sha_count"))


def retention_rank(files: DataFrame, keep: int, order_col: str = "mtime_unix") -> DataFrame:
    """The newest ``keep`` files per (host, kind) are kept, older ones flagged for pruning
    (reported, never deleted). The keep-th newest key per group is found with a top-k limit;
    everything older than it is pruned."""
    f = files.withColumn("kind", file_kind("name")).where(F.col("kind") != "other")
    w = Window.partitionBy("host", "kind").orderBy(F.col(order_col).desc(), F.col("name").desc())
    topk = f.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)
    kept = topk.select("host", "kind", "name", "rank")
    out = f.join(kept, ["host", "kind", "name"], "left")
    return out.select("host", "kind", "name", order_col, "rank", F.col("rank").isNull().alias("prune"))


def weekly_retention(files: DataFrame, keep: int) -> DataFrame:
    """W6, weekly reports: per (host, suffix) the first ``keep`` names in descending order stay (at least one).
    ``weekly-latest`` sorts first, so it takes one of the places, and is never pruned. Only dated and latest
    ``weekly-*.json`` / ``weekly-*.md`` files count."""
    suffix = F.regexp_extract("name", r"^weekly-.*\.(json|md)$", 1)
    f = files.select("host", "name", suffix.alias("suffix")).where(F.col("suffix") != "").distinct()
    w = Window.partitionBy("host", "suffix").orderBy(F.col("name").desc())
    kept = f.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max(keep, 1))
    out = f.join(kept, ["host", "suffix", "name"], "left")
    latest = F.col("name") == F.concat(F.lit("weekly-latest."), F.col("suffix"))
    return out.select("host", "suffix", "name", "rank", (F.col("rank").isNull() & ~latest).alias("prune"))


# ----------------------------------------------------------------------------- audit artifacts

def latest_artifact(files: DataFrame, by: str, order_col: str, name_col: str) -> DataFrame:
    """Newest artifact per ``by`` (ties: larger name)."""
    return files.groupBy(by).agg(F.max_by(F.struct(name_col, order_col), F.struct(order_col, name_col)).alias("x")) \
        .select(by, F.col("x." + name_col).alias(name_col), F.col("x." + order_col).alias(order_col))


def verify_audit(latest: DataFrame, as_of_unix: int, max_age_seconds: int, missing_col: str | None = None,
                 codes=(11, 13, 15)) -> DataFrame:
    """Latest log per host -> exit code: none 11, too old 13 (age > max_age), missing keys 15, else 0.
    (VPS uses 10/14 for the first two; pass ``codes``.)"""
    none_c, old_c, miss_c = codes
    age = F.lit(as_of_unix) - F.col("mtime_unix")
    code = (F.when(F.col("mtime_unix").isNull(), F.lit(none_c)).when(age > max_age_seconds, F.lit(old_c)))
    if missing_col is not None:
        code = code.when(F.col(missing_col) > 0, F.lit(miss_c))
    code = code.otherwise(F.lit(0))
    return latest.withColumn("age_seconds", age).withColumn("exit_code", code).withColumn(
        "status", F.when(F.col("exit_code") == 0, F.lit("success")).otherwise(F.lit("failed")))


def is_fresh(age_seconds, max_age_seconds: int) -> Column:
    """age <= max_age is fresh; strictly greater fails."""
    return _c(age_seconds) <= F.lit(max_age_seconds)


# ----------------------------------------------------------------------------- S18

# FIXED VALUES: errors of an inspect call that says nothing, of an answer that is no list with an object, and of
# one that is no JSON (there without the parser's own words).
INSPECT_FAILED = "docker inspect failed"
INSPECT_ODD = "docker inspect returned unexpected payload"
INSPECT_BAD = "invalid docker inspect json"
INSPECT_SCHEMA = ("array<struct<State:struct<Status:string,Health:struct<Status:string>>,"
                  "Config:struct<Image:string>>>")


def flatten_container_inspect(raw, exit_code=None, stderr=None) -> Column:
    """Container inspect JSON -> struct(exists, state, health, image, status, error).

    A failed call (``exit_code`` not 0) is a missing container where its message says so, else inspect_failed
    with the message. Bad JSON / empty list / non-object first item -> inspect_failed too.
    """
    parsed = F.from_json(_c(raw), INSPECT_SCHEMA, {"mode": "PERMISSIVE"})
    first = F.try_element_at(parsed, F.lit(1))
    state = F.coalesce(F.nullif(first["State"]["Status"], F.lit("")), F.lit("unknown"))
    failed = F.lit(False) if exit_code is None else F.coalesce(_c(exit_code) != 0, F.lit(False))
    said = F.lit("") if stderr is None else py_strip(F.coalesce(_c(stderr), F.lit("")))
    gone = F.lower(said).contains("no such object") | F.lower(said).contains("no such container")
    none, unknown = F.lit(""), F.lit("unknown")

    def outcome(exists, state_, health, image, status, error):
        return F.struct(exists.alias("exists"), state_.alias("state"), health.alias("health"), image.alias("image"), status.alias("status"), error.alias("error"))

    return (F.when(failed & gone, outcome(F.lit("no"), F.lit("missing"), unknown, none, F.lit("missing"), said))
            .when(failed, outcome(unknown, unknown, unknown, none, F.lit("inspect_failed"), F.coalesce(F.nullif(said, none), F.lit(INSPECT_FAILED))))
            .when(first.isNotNull(), outcome(F.lit("yes"), state, F.coalesce(F.nullif(first["State"]["Health"]["Status"], none), F.lit("none")),
                                             F.coalesce(first["Config"]["Image"], none), state, none))
            .otherwise(outcome(unknown, unknown, unknown, none, F.lit("inspect_failed"),
                               F.when(F.get_json_object(_c(raw), "$").isNotNull(), F.lit(INSPECT_ODD)).otherwise(F.lit(INSPECT_BAD)))))


# ----------------------------------------------------------------------------- S17

def _words(line) -> Column:
    return F.filter(F.split(py_strip(line), r"\s+"), lambda w: w != "")


def parse_disk_used_percent(text) -> Column:
    """Fifth word of the second line of a disk listing, without its percent signs; null where it is no number."""
    words = _words(F.try_element_at(F.split(F.coalesce(_c(text), F.lit("")), "\n"), F.lit(2)))
    bare = F.regexp_replace(F.try_element_at(words, F.lit(5)), "%+$", "")
    return F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("int"))


def parse_battery_percent(text) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(_c(text), F.lit("")), r"([0-9]+)%", 1), F.lit("")).try_cast("int")


def parse_power_source(text) -> Column:
    """ac / battery / unknown, from the first line of the battery report."""
    first = F.substring_index(F.coalesce(_c(text), F.lit("")), "\n", 1)
    return (F.when(first.contains("AC Power"), F.lit("ac")).when(first.contains("Battery Power"), F.lit("battery"))
            .otherwise(F.lit("unknown")))


def parse_outdated_count(installed, listing) -> Column:
    """Non-blank lines of the outdated listing; null where the package manager isn't installed."""
    lines = F.filter(F.split(F.coalesce(_c(listing), F.lit("")), "\n"), lambda x: py_strip(x) != "")
    return F.when(F.coalesce(_c(installed), F.lit("")) != "", F.size(lines))


def parse_latest_backup(text) -> Column:
    return F.nullif(py_strip(F.coalesce(_c(text), F.lit(""))), F.lit(""))


def parse_backup_age_seconds(text, as_of_unix) -> Column:
    """Seconds since the ``YYYY-MM-DD-HHMMSS`` (UTC) in the latest backup's path, at least 0."""
    at = F.nullif(F.regexp_extract(F.coalesce(_c(text), F.lit("")), r"([0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{6})", 1), F.lit(""))
    taken = F.unix_timestamp(F.try_to_timestamp(at, F.lit("yyyy-MM-dd-HHmmss")))
    return F.when(taken.isNotNull(), F.greatest(F.lit(0), _c(as_of_unix) - taken))


def parse_launchd_state(text, labels: list[str]) -> Column:
    """struct(loaded, running): whether all expected labels are listed, and whether one of them has a process.
    Both null without a listing. Lines are ``pid status label``."""
    rows = F.filter(F.transform(F.split(F.coalesce(_c(text), F.lit("")), "\n"), _words), lambda w: (F.size(w) >= 3) & F.get(w, 2).isin(*labels))
    return F.when(F.coalesce(_c(text), F.lit("")) != "", F.struct(
        (F.size(rows) == len(labels)).alias("loaded"), F.exists(rows, lambda w: F.get(w, 0) != "-").alias("running")))


def parse_memory_free(text) -> Column:
    g = F.regexp_extract(F.coalesce(_c(text), F.lit("")), r"System-wide memory free percentage:\s+(\d+)%", 1)
    return F.nullif(g, F.lit("")).try_cast("double")


def parse_swap_used_mb(text) -> Column:
    t = F.coalesce(_c(text), F.lit(""))
    v = F.nullif(F.regexp_extract(t, r"used = ([0-9.]+)([MG])", 1), F.lit("")).try_cast("double")
    u = F.regexp_extract(t, r"used = ([0-9.]+)([MG])", 2)
    return F.when(u == "G", v * F.lit(1024.0)).otherwise(v)


def parse_uptime_days(text) -> Column:
    t = F.coalesce(_c(text), F.lit(""))
    dpat = r"up\s+(\d+)\s+days?,\s+(\d+):(\d+)"
    hpat = r"up\s+(\d+):(\d+),"
    d = F.regexp_extract(t, dpat, 1)
    h = F.regexp_extract(t, hpat, 1)
    with_days = uptime_days(d.try_cast("long"), F.regexp_extract(t, dpat, 2).try_cast("long"),
                            F.regexp_extract(t, dpat, 3).try_cast("long"))
    hours_only = uptime_days(F.lit(0), h.try_cast("long"), F.regexp_extract(t, hpat, 2).try_cast("long"))
    return F.when(d != "", with_days).when(h != "", hours_only)


# ----------------------------------------------------------------------------- S13, S14

AGENT_LINE = r"^\[([^\]]*)\] level=(\S+) event=(\S+)(.*)$"
AGENT_FIELD = r"(\w+)=(\"[^\"]*\"|\S+)"


def parse_agent_log(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``[ts] level=L event=E k=v ...`` -> ts text, level, event, fields map (quoted values unquoted,
    ``null`` -> null, ``""`` -> empty)."""
    ln = F.col(line_col)
    rest = F.regexp_extract(ln, AGENT_LINE, 4)
    pairs = F.regexp_extract_all(rest, F.lit(AGENT_FIELD), F.lit(0))

    def kv(p):
        k = F.substring_index(p, "=", 1)
        v = F.substr(p, F.instr(p, "=") + 1)
        quoted = v.startswith('"') & v.endswith('"') & (F.length(v) >= 2)
        v = F.when(v == "null", F.lit(None)).when(quoted, F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)
        return F.struct(k.alias("key"), v.alias("value"))

    return lines.select(
        "*", F.regexp_extract(ln, AGENT_LINE, 1).alias("ts_text"), F.regexp_extract(ln, AGENT_LINE, 2).alias("level"),
        F.regexp_extract(ln, AGENT_LINE, 3).alias("event"),
        F.map_from_entries(F.transform(pairs, kv)).alias("fields"))


def agent_event_search(parsed: DataFrame, prefixes: list[str], n: int, order_cols: list[str]) -> DataFrame:
    """Lines whose event starts with any prefix, the last ``n`` by log order (top-k)."""
    cond = F.exists(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.col("event").startswith(p))
    return parsed.where(cond).orderBy(*[F.col(c).desc() for c in order_cols]).limit(n)


# ----------------------------------------------------------------------------- U6, U7

RESPONSE_SCHEMA = "struct<output_text:string,output:array<struct<content:array<struct<text:string>>>>>"


def extract_output_text(resp) -> Column:
    """``output_text`` when non-blank, else every non-blank ``output[].content[].text`` joined by newline."""
    r = F.from_json(_c(resp), RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})
    ot = py_strip(r["output_text"])
    texts = F.flatten(F.transform(F.coalesce(r["output"], F.array().cast(
        "array<struct<content:array<struct<text:string>>>>")),
        lambda item: F.coalesce(F.transform(item["content"], lambda p: p["text"]), F.array().cast("array<string>"))))
    chunks = F.transform(F.filter(texts, lambda t: t.isNotNull() & (py_strip(t) != "")), lambda t: py_strip(t))
    joined = py_strip(F.array_join(chunks, "\n"))
    return F.when(F.coalesce(ot, F.lit("")) != "", ot).otherwise(F.coalesce(joined, F.lit("")))


# FIXED VALUES - brief response contract: required keys and brief_status values.
BRIEF_KEYS = ["brief_status", "executive_summary", "top_risks", "recommended_actions", "operator_note"]
BRIEF_STATUS = ["stable", "watch", "risky"]


def validate_review(review) -> Column:
    """struct(valid, missing_keys, extra_keys) against the brief contract (no extra keys allowed)."""
    keys = F.json_object_keys(_c(review))
    req = F.array(*[F.lit(k) for k in BRIEF_KEYS])
    missing = F.when(keys.isNull(), req).otherwise(F.array_except(req, keys))
    extra = F.coalesce(F.array_except(keys, req), F.array().cast("array<string>"))
    status_ok = F.coalesce(F.get_json_object(_c(review), "$.brief_status").isin(*BRIEF_STATUS), F.lit(False))
    valid = keys.isNotNull() & (F.size(missing) == 0) & (F.size(extra) == 0) & status_ok
    return F.struct(valid.alias("valid"), F.array_join(missing, ",").alias("missing_keys"),
                    F.array_join(F.array_sort(extra), ",").alias("extra_keys"))
