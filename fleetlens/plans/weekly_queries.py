"""Weekly rollup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.text import split_findings
from fleetlens.operators import rules as R
from fleetlens.operators import weekly as W
from fleetlens.plans.registry import query
from fleetlens.plans.signal_queries import COOLDOWN_CTES, decided, decisions
from fleetlens.sources import fixtures as fx

# FIXED VALUES - report time points of the fixtures (FIXTURES.md section 4).
AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_RUNS = "2001-08-02 00:00:00"
DAYS = 7

_FMT = "'%Y-%m-%d %H:%M:%S UTC'"


def _rng(as_of: str, days: int = DAYS) -> tuple[str, str]:
    """The closed window as text bounds, for scan-level pruning."""
    from datetime import datetime, timedelta

    hi = datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S")
    return ((hi - timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S"), as_of)


RUN_WINDOW = _rng(AS_OF_RUNS)
EVENT_WINDOW = _rng(AS_OF_EVENTS)


def _win(col: str, as_of: str, days: int = DAYS) -> str:
    return (f"date_trunc('second', {col}) BETWEEN TIMESTAMP '{as_of}' - INTERVAL {days} DAY "
            f"AND TIMESTAMP '{as_of}'")


def _sql_list(xs) -> str:
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


@query("window_totals", f"""
SELECT (SELECT count(*) FROM signals WHERE {_win('ts', AS_OF_EVENTS)}) AS decisions,
       (SELECT count(*) FROM tasks WHERE {_win('created_at', AS_OF_EVENTS)}) AS tasks,
       (SELECT count(*) FROM runs WHERE {_win('started_at', AS_OF_RUNS)}) AS runs
""", ctes=("sig0", "signals", "tasks", "runs"))
def q_window_totals(spark, sf_dir):
    return W.window_totals(R.first_match(fx.signals(spark, sf_dir, EVENT_WINDOW)), fx.tasks(spark, sf_dir, EVENT_WINDOW),
                           fx.runs(spark, sf_dir, RUN_WINDOW),
                           AS_OF_EVENTS, AS_OF_RUNS, DAYS)


_EXCL = (f"(alertname = '' OR severity IN {_sql_list(W.EXCLUDED_SEVERITIES)} "
         f"OR alertname IN {_sql_list(W.EXCLUDED_ALERTNAMES)} OR starts_with(alertname, 'Demo'))")


@query("top_alerts", f"""
SELECT alertname, severity, count FROM (
  SELECT alertname, severity, count(*) AS count FROM signals WHERE {_win('ts', AS_OF_EVENTS)}
  GROUP BY alertname, severity) g
WHERE NOT {_EXCL}
ORDER BY count DESC, alertname, severity LIMIT 10
""", ctes=("sig0", "signals"))
def q_top_alerts(spark, sf_dir):
    return W.top_alerts(R.first_match(fx.signals(spark, sf_dir, EVENT_WINDOW)), AS_OF_EVENTS, DAYS)


@query("weekly_task_status", f"""
SELECT task_type, status, count(*) AS count FROM tasks
WHERE {_win('created_at', AS_OF_EVENTS)} AND status <> 'running' GROUP BY task_type, status
""", ctes=("tasks",))
def q_weekly_task_status(spark, sf_dir):
    return W.weekly_task_status(fx.tasks(spark, sf_dir, EVENT_WINDOW), AS_OF_EVENTS, DAYS)


@query("weekly_run_status", f"""
SELECT action, status, count(*) AS count FROM runs
WHERE {_win('started_at', AS_OF_RUNS)} AND status NOT IN ('running', 'skipped')
  AND coalesce(action, '') NOT IN {_sql_list(W.EXCLUDED_FAILURE_ACTIONS)}
GROUP BY action, status
""", ctes=("runs",))
def q_weekly_run_status(spark, sf_dir):
    return W.weekly_run_status(fx.runs(spark, sf_dir, RUN_WINDOW), AS_OF_RUNS, DAYS)


_RUN_COLS = (f"id, action, status, strftime(started_at, {_FMT}) AS started_at, "
             f"strftime(finished_at, {_FMT}) AS finished_at, exit_code, coalesce(error, '') AS error")


@query("backup_runs", f"""
SELECT {_RUN_COLS} FROM runs
WHERE action IN ('run_backup', 'verify_backup') AND {_win('started_at', AS_OF_RUNS)}
  AND status NOT IN ('running', 'skipped')
ORDER BY started_at DESC, id DESC LIMIT 50
""", ctes=("runs",))
def q_backup_runs(spark, sf_dir):
    return W.backup_runs(fx.runs(spark, sf_dir, RUN_WINDOW), AS_OF_RUNS, DAYS)


@query("mac_alerts", f"""
WITH RECURSIVE {COOLDOWN_CTES}
SELECT id, severity, summary, decision, reason, created_at FROM (
  SELECT signal_id AS id, severity, summary, final_decision AS decision, final_reason AS reason,
         strftime(ts, {_FMT}) AS created_at
  FROM cd WHERE alertname = 'MacMemoryPressure' AND {_win('ts', AS_OF_EVENTS)}
  ORDER BY ts DESC, signal_id DESC LIMIT 80) h
WHERE coalesce(severity, '') <> 'ok' AND NOT contains(lower(coalesce(summary, '')), 'synthetic')
""", ctes=("sig0", "signals"))
def q_mac_alerts(spark, sf_dir):
    return W.mac_alerts(decisions(spark, sf_dir), AS_OF_EVENTS, DAYS)


@query("mac_actions", f"""
SELECT id, status, strftime(created_at, {_FMT}) AS created_at, strftime(finished_at, {_FMT}) AS finished_at,
  coalesce(error, '') AS error,
  coalesce(json_extract_string(result_json, '$.action'), '') AS action,
  coalesce(json_extract_string(result_json, '$.target'), '') AS target,
  coalesce(json_extract_string(result_json, '$.status'), '') AS result_status,
  TRY_CAST(json_extract_string(result_json, '$.rss_mb') AS DOUBLE) AS rss_mb
FROM (SELECT * FROM tasks WHERE task_type = 'mac_action' AND {_win('created_at', AS_OF_EVENTS)}
      AND status <> 'running' ORDER BY created_at DESC, id DESC LIMIT 50) h
""", ctes=("tasks",))
def q_mac_actions(spark, sf_dir):
    return W.mac_actions(fx.tasks(spark, sf_dir, EVENT_WINDOW), AS_OF_EVENTS, DAYS)


_FAILURES_SQL = f"""
failures AS (
  SELECT *, row_number() OVER (ORDER BY started_at DESC, id DESC) AS failure_rank FROM (
    SELECT * FROM runs WHERE {_win('started_at', AS_OF_RUNS)} AND status = 'failed'
    ORDER BY started_at DESC, id DESC LIMIT 50) h
  WHERE coalesce(action, '') <> '' AND action NOT IN {_sql_list(W.EXCLUDED_FAILURE_ACTIONS)}
    AND action IN {_sql_list(W.INCLUDED_OPERATIONAL_ACTIONS)}
  QUALIFY failure_rank <= 15
)
"""


@query("latest_failures", f"WITH {_FAILURES_SQL} SELECT {_RUN_COLS}, CAST(failure_rank AS INTEGER) AS failure_rank "
       "FROM failures", ctes=("runs",))
def q_latest_failures(spark, sf_dir):
    return W.latest_failures(fx.runs(spark, sf_dir, RUN_WINDOW), AS_OF_RUNS, DAYS).drop("_st")


@query("recent_failure_count", f"""
WITH {_FAILURES_SQL}
SELECT count(*) FILTER (WHERE started_at >= TIMESTAMP '{AS_OF_RUNS}' - INTERVAL 24 HOUR) AS recent_failure_count
FROM failures
""", ctes=("runs",))
def q_recent_failure_count(spark, sf_dir):
    return W.recent_failure_count(W.latest_failures(fx.runs(spark, sf_dir, RUN_WINDOW), AS_OF_RUNS, DAYS), AS_OF_RUNS)


@query("result_json_fields", """
SELECT id,
  json_extract_string(rj, '$.analysis_level') AS analysis_level,
  json_extract_string(rj, '$.analysis_summary') AS analysis_summary,
  json_extract_string(rj, '$.source') AS source,
  json_extract_string(rj, '$.markdown_path') AS markdown_path
FROM (SELECT id, nullif(regexp_extract(stdout, '(?s)RESULT_JSON:(\\{.*\\})', 1), '') AS rj FROM runs) x
""", ctes=("runs",))
def q_result_json_fields(spark, sf_dir):
    r = fx.runs(spark, sf_dir)
    m = W.result_json_map("stdout")
    return r.select("id", m.alias("rj")).select(
        "id", F.col("rj")["analysis_level"].alias("analysis_level"),
        F.col("rj")["analysis_summary"].alias("analysis_summary"), F.col("rj")["source"].alias("source"),
        F.col("rj")["markdown_path"].alias("markdown_path"))


# ---------------------------------------------------------------- audit reviews and their rollups

def _noise_sql(x: str) -> str:
    low = f"lower(trim({x}))"
    pats = " OR ".join(f"contains({low}, '{p}')" for p in W.WEEKLY_NOISE_PATTERNS)
    rx = "'^(warning|critical):(\\d+)\\s+upgradable packages?$'"
    return (f"({low} = '' OR {low} = 'ok:no findings' OR {pats} OR "
            f"(regexp_matches({low}, {rx}) AND TRY_CAST(regexp_extract({low}, {rx}, 2) AS BIGINT) <= "
            f"{W.UPGRADABLE_NOISE_THRESHOLD}))")


def _legacy_sql(x: str) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{p}')" for p in W.LEGACY_AUDIT_SUMMARY_PATTERNS) + ")"


_DOMAINS_VALUES = ", ".join(f"('{d}', '{a}', {str(c).upper()}, {n})" for d, a, c, n in W.AUDIT_DOMAINS)

def reviews_sql(days: int = DAYS, newest: str = "review_rank <= dom.max_reviews") -> str:
    """``newest``: which ranks count; ``true`` for every review."""
    return f"""
dom(domain, action, clean_legacy, max_reviews) AS (VALUES {_DOMAINS_VALUES}),
rv0 AS (
  SELECT dom.domain, dom.clean_legacy, r.*,
    row_number() OVER (PARTITION BY dom.domain ORDER BY r.started_at DESC, r.id DESC) AS review_rank,
    dom.max_reviews
  FROM runs r JOIN dom ON dom.action = r.action
  WHERE {_win('r.started_at', AS_OF_RUNS, days)} AND r.status <> 'running'
  QUALIFY {newest}
),
rv1 AS (
  SELECT *, nullif(regexp_extract(stdout, '(?s)RESULT_JSON:(\\{{.*\\}})', 1), '') AS rj FROM rv0
),
rv2 AS (
  SELECT *,
    list_filter(list_transform(string_split(coalesce(json_extract_string(rj, '$.analysis_summary'), ''), ';'),
                               lambda x: trim(x)), lambda x: x <> '') AS parts
  FROM rv1
),
rv3 AS (
  SELECT *, array_to_string(list_filter(
      CASE WHEN clean_legacy THEN list_filter(parts, lambda x: NOT {_legacy_sql('x')}) ELSE parts END,
      lambda x: NOT {_noise_sql('x')}), '; ') AS cleaned
  FROM rv2
),
reviews AS (
  SELECT domain, CAST(review_rank AS INTEGER) AS review_rank, id, status, strftime(started_at, {_FMT}) AS started_at,
    strftime(finished_at, {_FMT}) AS finished_at, exit_code, coalesce(error, '') AS error,
    CASE WHEN cleaned = '' AND status = 'success' THEN 'ok'
         WHEN coalesce(json_extract_string(rj, '$.analysis_level'), '') <> '' THEN json_extract_string(rj, '$.analysis_level')
         WHEN status = 'failed' THEN 'critical' WHEN cleaned <> '' THEN 'warning' ELSE 'ok' END AS analysis_level,
    CAST(CASE WHEN cleaned = '' THEN 0 ELSE len(list_filter(list_transform(string_split(cleaned, ';'),
         lambda x: trim(x)), lambda x: x <> '')) END AS BIGINT) AS analysis_findings_count,
    CASE WHEN cleaned = '' THEN 'ok:no findings' ELSE cleaned END AS analysis_summary,
    coalesce(json_extract_string(rj, '$.analysis_log_path'), '') AS analysis_log_path,
    coalesce(json_extract_string(rj, '$.metrics_path'), '') AS metrics_path
  FROM rv3 WHERE status IN ('failed', 'success') OR cleaned <> ''
)
"""

def rollup_sql(days: int = DAYS) -> str:
    return reviews_sql(days) + """,
rollup AS (
  SELECT dom.domain,
    CAST(count(r.id) AS BIGINT) AS total_runs,
    CAST(count(r.id) FILTER (WHERE r.analysis_level = 'ok') AS BIGINT) AS ok_count,
    CAST(count(r.id) FILTER (WHERE r.analysis_level = 'warning') AS BIGINT) AS warning_count,
    CAST(count(r.id) FILTER (WHERE r.analysis_level = 'critical') AS BIGINT) AS critical_count,
    coalesce(arg_min(r.analysis_level, r.review_rank), 'unknown') AS latest_level,
    coalesce(arg_min(r.analysis_summary, r.review_rank), '') AS latest_summary,
    coalesce(arg_min(r.started_at, r.review_rank), '') AS latest_started_at,
    arg_min(r.id, r.review_rank) FILTER (WHERE r.analysis_level IN ('warning', 'critical')) AS latest_non_ok_id,
    arg_min(r.analysis_level, r.review_rank) FILTER (WHERE r.analysis_level IN ('warning', 'critical'))
      AS latest_non_ok_level
  FROM dom LEFT JOIN reviews r ON r.domain = dom.domain
  GROUP BY dom.domain
)
"""


def _reviews(spark, sf_dir):
    return W.audit_reviews(fx.runs(spark, sf_dir, RUN_WINDOW), AS_OF_RUNS, DAYS)


@query("audit_reviews", f"WITH {reviews_sql()} SELECT * FROM reviews", ctes=("runs",))
def q_audit_reviews(spark, sf_dir):
    return _reviews(spark, sf_dir)


@query("domain_rollup", f"WITH {rollup_sql()} SELECT * FROM rollup", ctes=("runs",))
def q_domain_rollup(spark, sf_dir):
    return W.domain_rollup(_reviews(spark, sf_dir))


@query("latest_posture", f"""WITH {rollup_sql()}
SELECT domain, latest_level, latest_started_at, latest_non_ok_id FROM rollup""", ctes=("runs",))
def q_latest_posture(spark, sf_dir):
    return W.domain_rollup(_reviews(spark, sf_dir)).select("domain", "latest_level", "latest_started_at",
                                                           "latest_non_ok_id")


@query("all_domains_ok", f"""WITH {rollup_sql()}
SELECT coalesce(bool_and(latest_level = 'ok'), false) AND count(*) > 0 AS all_domains_ok FROM rollup""",
       ctes=("runs",))
def q_all_domains_ok(spark, sf_dir):
    return W.all_domains_ok(W.domain_rollup(_reviews(spark, sf_dir)))


@query("recurring_findings", f"""WITH {reviews_sql()},
ex AS (
  SELECT domain, review_rank, trim(f.finding) AS finding, f.pos
  FROM reviews, unnest(string_split(analysis_summary, ';')) WITH ORDINALITY AS f(finding, pos)
),
ex2 AS (
  SELECT domain, review_rank, finding,
    row_number() OVER (PARTITION BY domain, review_rank ORDER BY pos) - 1 AS pos
  FROM ex WHERE finding <> ''
),
g AS (
  SELECT domain, finding, count(*) AS count, min(review_rank * 100000 + pos) AS first_seen
  FROM ex2 WHERE NOT {_noise_sql('finding')} GROUP BY domain, finding
)
SELECT domain, CAST(rank AS INTEGER) AS rank, finding, count FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY count DESC, first_seen) AS rank FROM g) x
WHERE rank <= 5
""", ctes=("runs",))
def q_recurring_findings(spark, sf_dir):
    return W.recurring_findings(_reviews(spark, sf_dir))


def briefs_sql(days: int = DAYS) -> str:
    return f"""
bh AS (
  SELECT * FROM runs WHERE action = 'generate_ai_ops_brief' AND {_win('started_at', AS_OF_RUNS, days)}
    AND status = 'success' ORDER BY started_at DESC, id DESC LIMIT 30
),
b1 AS (
  SELECT *, nullif(regexp_extract(stdout, '(?s)RESULT_JSON:(\\{{.*\\}})', 1), '') AS rj FROM bh
),
b2 AS (
  SELECT id, status, started_at, finished_at, exit_code,
    coalesce(nullif(trim(coalesce(json_extract_string(rj, '$.source'), '')), ''), 'unknown') AS source,
    coalesce(json_extract_string(rj, '$.markdown_path'), '') AS markdown_path,
    coalesce(json_extract_string(rj, '$.json_path'), '') AS json_path,
    coalesce(json_extract_string(rj, '$.brief_status'), '') AS brief_status,
    coalesce(json_extract_string(rj, '$.executive_summary'), '') AS executive_summary
  FROM b1 WHERE rj IS NOT NULL AND json_type(rj) = 'OBJECT' AND rj <> '{{}}'
),
briefs AS (
  SELECT * FROM b2 WHERE markdown_path <> '' OR json_path <> ''
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, id DESC) = 1
)
"""
REVIEWS_SQL = reviews_sql()
ROLLUP_SQL = rollup_sql()

_BRIEF_COLS = ("id", "source", "markdown_path", "json_path", "brief_status", "executive_summary")


def _brief_out(df):
    return df.select(*_BRIEF_COLS, F.date_format("started_at", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("started_at"))


@query("latest_briefs", f"WITH {briefs_sql()} SELECT {', '.join(_BRIEF_COLS)}, strftime(started_at, {_FMT}) "
       "AS started_at FROM briefs", ctes=("runs",))
def q_latest_briefs(spark, sf_dir):
    return _brief_out(W.latest_briefs(fx.runs(spark, sf_dir, RUN_WINDOW), AS_OF_RUNS, DAYS))


@query("fresh_briefs", f"""WITH {rollup_sql()}, {briefs_sql()}
SELECT {', '.join('b.' + c for c in _BRIEF_COLS)}, strftime(b.started_at, {_FMT}) AS started_at
FROM briefs b LEFT JOIN rollup r ON r.domain = b.source
WHERE b.source NOT IN {_sql_list(W.BRIEF_SOURCES_WITH_AUDIT_DOMAINS)}
   OR (r.latest_level IS NOT NULL AND NOT coalesce(r.latest_level = 'ok' AND (
        b.started_at IS NULL OR r.latest_started_at = '' OR
        b.started_at < strptime(r.latest_started_at, '%Y-%m-%d %H:%M:%S UTC')), false))
""", ctes=("runs",))
def q_fresh_briefs(spark, sf_dir):
    runs = fx.runs(spark, sf_dir, RUN_WINDOW)
    roll = W.domain_rollup(W.audit_reviews(runs, AS_OF_RUNS, DAYS))
    return _brief_out(W.fresh_briefs(W.latest_briefs(runs, AS_OF_RUNS, DAYS), roll))


@query("review_findings", f"""WITH {reviews_sql()}
SELECT domain, id, CAST(len(list_filter(list_transform(string_split(analysis_summary, ';'), lambda x: trim(x)),
  lambda x: x <> '')) AS INTEGER) AS n_parts FROM reviews""", ctes=("runs",))
def q_review_findings(spark, sf_dir):
    """P10 over the cleaned review summaries."""
    return _reviews(spark, sf_dir).select("domain", "id", F.size(split_findings("analysis_summary")).alias("n_parts"))


# Whole-history variants of the brief parts (the 7-day window of the fixture holds no brief runs).
HISTORY_DAYS = 3650


@query("latest_briefs_history", f"WITH {briefs_sql(HISTORY_DAYS)} SELECT {', '.join(_BRIEF_COLS)}, "
       f"strftime(started_at, {_FMT}) AS started_at FROM briefs", ctes=("runs",))
def q_latest_briefs_history(spark, sf_dir):
    return _brief_out(W.latest_briefs(fx.runs(spark, sf_dir, _rng(AS_OF_RUNS, HISTORY_DAYS)), AS_OF_RUNS,
                                      HISTORY_DAYS))


@query("fresh_briefs_history", f"""WITH {rollup_sql(HISTORY_DAYS)}, {briefs_sql(HISTORY_DAYS)}
SELECT {', '.join('b.' + c for c in _BRIEF_COLS)}, strftime(b.started_at, {_FMT}) AS started_at
FROM briefs b LEFT JOIN rollup r ON r.domain = b.source
WHERE b.source NOT IN {_sql_list(W.BRIEF_SOURCES_WITH_AUDIT_DOMAINS)}
   OR (r.latest_level IS NOT NULL AND NOT coalesce(r.latest_level = 'ok' AND (
        b.started_at IS NULL OR r.latest_started_at = '' OR
        b.started_at < strptime(r.latest_started_at, '%Y-%m-%d %H:%M:%S UTC')), false))
""", ctes=("runs",))
def q_fresh_briefs_history(spark, sf_dir):
    runs = fx.runs(spark, sf_dir, _rng(AS_OF_RUNS, HISTORY_DAYS))
    roll = W.domain_rollup(W.audit_reviews(runs, AS_OF_RUNS, HISTORY_DAYS))
    return _brief_out(W.fresh_briefs(W.latest_briefs(runs, AS_OF_RUNS, HISTORY_DAYS), roll))


@query("domain_rollup_history", f"WITH {rollup_sql(HISTORY_DAYS)} SELECT * FROM rollup", ctes=("runs",))
def q_domain_rollup_history(spark, sf_dir):
    return W.domain_rollup(W.audit_reviews(fx.runs(spark, sf_dir), AS_OF_RUNS, HISTORY_DAYS))


_TITLES = ", ".join(f"({i}, '{d}', '{t}')" for i, (d, t) in enumerate(W.AUDIT_DOMAIN_TITLES))


@query("report_lines", f"""WITH {rollup_sql(HISTORY_DAYS)},
ex AS (
  SELECT domain, review_rank, trim(f.finding) AS finding, f.pos
  FROM reviews, unnest(string_split(analysis_summary, ';')) WITH ORDINALITY AS f(finding, pos)
),
ex2 AS (
  SELECT domain, review_rank, finding, row_number() OVER (PARTITION BY domain, review_rank ORDER BY pos) - 1 AS pos
  FROM ex WHERE finding <> ''
),
g AS (
  SELECT domain, finding, count(*) AS count, min(review_rank * 100000 + pos) AS first_seen
  FROM ex2 WHERE NOT {_noise_sql('finding')} GROUP BY domain, finding
),
rec AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY count DESC, first_seen) AS rnk FROM g) x
  WHERE rnk <= 5
),
t(domain_order, domain, title) AS (VALUES {_TITLES}),
l AS (
  SELECT t.domain_order, 0 AS k, '### ' || t.title AS line FROM rollup r JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 1, '' FROM rollup r JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 2, '- Runs: ' || CAST(total_runs AS VARCHAR) FROM rollup r JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 3, '- OK: ' || CAST(ok_count AS VARCHAR) FROM rollup r JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 4, '- Warning: ' || CAST(warning_count AS VARCHAR) FROM rollup r JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 5, '- Critical: ' || CAST(critical_count AS VARCHAR) FROM rollup r JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 6, '- Current posture: ' || latest_level FROM rollup r JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 7, '- Latest summary: ' || latest_summary FROM rollup r JOIN t USING (domain)
    WHERE latest_summary <> ''
  UNION ALL SELECT t.domain_order, 8, '- Latest run: ' || latest_started_at FROM rollup r JOIN t USING (domain)
    WHERE latest_started_at <> ''
  UNION ALL SELECT DISTINCT t.domain_order, 9, '- Recurring findings:' FROM rec JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 10 + rnk, '  - ' || finding || ' (' || CAST(count AS VARCHAR) || ')'
    FROM rec JOIN t USING (domain)
  UNION ALL SELECT t.domain_order, 1000, '' FROM rollup r JOIN t USING (domain)
)
SELECT domain_order, CAST(row_number() OVER (PARTITION BY domain_order ORDER BY k) - 1 AS INTEGER) AS line_order, line
FROM l
""", ctes=("runs",))
def q_report_lines(spark, sf_dir):
    """K7 (audit-domain section of the weekly document) as an ordered line table."""
    runs = fx.runs(spark, sf_dir, _rng(AS_OF_RUNS, HISTORY_DAYS))
    reviews = W.audit_reviews(runs, AS_OF_RUNS, HISTORY_DAYS)
    return W.audit_domain_report_lines(W.domain_rollup(reviews), W.recurring_findings(reviews))
