"""Queries over labelled samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators import series as SR
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

# FIXED VALUES - grid and lookback of instant vectors, rate windows, quantile, the required targets.
STEP, LOOKBACK, WINDOW, QUANTILE = 1800, 2700, 7200, 0.95
REQUIRED = {
    "nodes_vps": [("job", "=", "nodes"), ("node", "=", "vps")],
    "nodes_admin": [("job", "=", "nodes"), ("node", "=", "admin")],
    "action_runner": [("job", "=", "action-runner")],
}
SELECTORS = {
    "equal": ("up", [("job", "=", "nodes")]),
    "absent": ("up", [("node", "=", "")]),
    "unequal": ("up", [("node", "!=", "vps"), ("job", "!=", "demo-app")]),
    "like": ("http_requests_total", [("status", "=~", "5.."), ("service", "=~", "demo-app|rel")]),
    "unlike": ("http_request_duration_seconds_bucket", [("le", "!~", "[0-9.]+"), ("zone", "!~", ".+")]),
}
_FMT = "'%Y-%m-%d %H:%M:%S UTC'"
_GRID = f"""
seen AS (
  SELECT *, unnest(range(CAST(ceil(epoch_us(ts) / {STEP * 10 ** 6}.0) AS BIGINT), CAST(floor((epoch_us(ts) + {LOOKBACK * 10 ** 6} - 1) / {STEP * 10 ** 6}.0) AS BIGINT) + 1)) AS k
  FROM labelled WHERE name = 'up'),
vec AS (
  SELECT k, strftime(to_timestamp(k * {STEP}) AT TIME ZONE 'UTC', {_FMT}) AS instant, labels['job'] AS job, labels['node'] AS node, labels['instance'] AS instance,
    arg_max(value, (ts, sample_id)) AS value FROM seen GROUP BY ALL)"""


def _up(spark, sf_dir):
    return SR.instant_vectors(SR.select_series(fx.labelled_samples(spark, sf_dir), "up"), STEP, LOOKBACK)


@query("series_selectors", """
WITH s AS (SELECT *, name || '{' || array_to_string([k || '="' || labels[k] || '"' for k in list_sort(map_keys(labels))], ',') || '}' AS series FROM labelled),
p AS (
  SELECT 'equal' AS selector, * FROM s WHERE name = 'up' AND labels['job'] = 'nodes'
  UNION ALL SELECT 'absent', * FROM s WHERE name = 'up' AND coalesce(labels['node'], '') = ''
  UNION ALL SELECT 'unequal', * FROM s WHERE name = 'up' AND coalesce(labels['node'], '') <> 'vps' AND labels['job'] <> 'demo-app'
  UNION ALL SELECT 'like', * FROM s WHERE name = 'http_requests_total' AND labels['status'] >= '500' AND labels['service'] = 'demo-app'
  UNION ALL SELECT 'unlike', * FROM s WHERE name = 'http_request_duration_seconds_bucket' AND labels['le'] = '+Inf')
SELECT selector, series, count(*) AS samples, sum(value) AS total, max(value) AS top FROM p GROUP BY selector, series
""", ctes=("labelled",))
def q_series_selectors(spark, sf_dir):
    """Each kind of matcher, on missing labels too."""
    samples, out = fx.labelled_samples(spark, sf_dir), None
    for name, (metric, matchers) in SELECTORS.items():
        own = SR.select_series(samples, metric, matchers).select(F.lit(name).alias("selector"), "series", "value")
        out = own if out is None else out.unionByName(own)
    return out.groupBy("selector", "series").agg(F.count(F.lit(1)).alias("samples"), F.sum("value").alias("total"), F.max("value").alias("top"))


@query("series_up", f"""WITH {_GRID}
SELECT instant, job, max(value) AS value, count(*) AS series FROM vec WHERE regexp_full_match(job, 'nodes|demo-app') GROUP BY instant, job
""", ctes=("labelled",))
def q_series_up(spark, sf_dir):
    """Max by (job) (up{job=~"nodes|demo-app"}) at each instant."""
    s = SR.select_series(fx.labelled_samples(spark, sf_dir), "up", [("job", "=~", "nodes|demo-app")])
    out = SR.max_by_label(SR.instant_vectors(s, STEP, LOOKBACK), ["job"])
    return out.select(fmt_utc("at").alias("instant"), "job", "value", "series")


@query("series_down", f"WITH {_GRID} SELECT instant, count(*) FILTER (WHERE value = 0) AS down, count(*) AS series FROM vec GROUP BY instant", ctes=("labelled",))
def q_series_down(spark, sf_dir):
    """count(up == 0) at each instant."""
    return SR.count_down(_up(spark, sf_dir)).select(fmt_utc("at").alias("instant"), "down", "series")


def _increase_sql(keys: str, where: str) -> str:
    return f"""
w AS (SELECT *, CAST(floor(epoch(ts) / {WINDOW}) AS BIGINT) AS k, labels['instance'] AS instance, labels['status'] AS status, labels['le'] AS le FROM labelled WHERE {where}),
l AS (SELECT *, lag(value) OVER (PARTITION BY {keys}, k ORDER BY ts, sample_id) AS prev FROM w),
inc AS (SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS d FROM l)"""


@query("series_error_rate", f"""WITH {_increase_sql("instance, status", "name = 'http_requests_total' AND labels['service'] = 'demo-app' AND labels['status'] LIKE '5__'")}
SELECT strftime(to_timestamp(k * {WINDOW}) AT TIME ZONE 'UTC', {_FMT}) AS window_start, status, sum(d) / CAST({WINDOW} AS DOUBLE) AS rate FROM inc GROUP BY k, status
""", ctes=("labelled",))
def q_series_error_rate(spark, sf_dir):
    """Sum by (status) (rate(http_requests_total{service="demo-app",status=~"5.."}))."""
    s = SR.select_series(fx.labelled_samples(spark, sf_dir), "http_requests_total", [("service", "=", "demo-app"), ("status", "=~", "5..")])
    return SR.rates(s, ["status"], WINDOW).select(fmt_utc("window_start").alias("window_start"), "status", "rate")


@query("series_p95", f"""WITH {_increase_sql("instance, le", "name = 'http_request_duration_seconds_bucket' AND labels['service'] = 'demo-app'")},
per_le AS (SELECT k, CASE le WHEN '+Inf' THEN CAST('inf' AS DOUBLE) ELSE CAST(le AS DOUBLE) END AS le, sum(d) / CAST({WINDOW} AS DOUBLE) AS n FROM inc GROUP BY ALL),
mono AS (SELECT k, le, max(n) OVER (PARTITION BY k ORDER BY le) AS n, max(n) OVER (PARTITION BY k) AS total, count(*) OVER (PARTITION BY k) AS c,
  max(le) OVER (PARTITION BY k) AS top, row_number() OVER (PARTITION BY k ORDER BY le) AS i FROM per_le),
pick AS (SELECT *, lag(n, 1, 0) OVER (PARTITION BY k ORDER BY le) AS under, lag(le, 1, 0) OVER (PARTITION BY k ORDER BY le) AS low FROM mono),
best AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY le) AS r FROM pick WHERE n >= CAST({QUANTILE} AS DOUBLE) * total)
SELECT strftime(to_timestamp(k * {WINDOW}) AT TIME ZONE 'UTC', {_FMT}) AS window_start, total,
  CASE WHEN total = 0 OR c < 2 OR top < CAST('inf' AS DOUBLE) THEN NULL WHEN i = c THEN low
    ELSE low + (le - low) * (CAST({QUANTILE} AS DOUBLE) * total - under) / (n - under) END AS quantile
FROM best WHERE r = 1
""", ctes=("labelled",))
def q_series_p95(spark, sf_dir):
    """p95 from le counters that restart, one of them without its 0.5 bucket."""
    s = SR.select_series(fx.labelled_samples(spark, sf_dir), "http_request_duration_seconds_bucket", [("service", "=", "demo-app")])
    return SR.bucket_quantile(SR.rates(s, ["le"], WINDOW), QUANTILE).select(fmt_utc("window_start").alias("window_start"), "total", "quantile")


_TARGETS = f"""{_GRID},
wanted AS (SELECT DISTINCT k, instant, target FROM vec CROSS JOIN (VALUES ('nodes_vps'), ('nodes_admin'), ('action_runner')) t(target)),
own AS (
  SELECT k, CASE WHEN job = 'action-runner' THEN 'action_runner' ELSE 'nodes_' || node END AS target, max(value) AS value
  FROM vec WHERE job IN ('nodes', 'action-runner') GROUP BY ALL),
req AS (SELECT w.k, w.instant, w.target, value, coalesce(value < 1, true) AS down FROM wanted w LEFT JOIN own USING (k, target))"""


@query("required_targets", f"WITH {_TARGETS} SELECT instant, target, value, down FROM req", ctes=("labelled",))
def q_required_targets(spark, sf_dir):
    """Each required target at each instant; null is not 0."""
    return SR.required_targets(_up(spark, sf_dir), REQUIRED).select(fmt_utc("at").alias("instant"), "target", "value", "down")


@query("target_summary", f"""WITH {_TARGETS},
d AS (SELECT k, count(*) FILTER (WHERE value = 0) AS total_down FROM vec GROUP BY k)
SELECT instant, count(*) FILTER (WHERE down) AS required_down, any_value(total_down) AS total_down,
  greatest(any_value(total_down) - count(*) FILTER (WHERE down), 0) AS other_down FROM req JOIN d USING (k) GROUP BY instant
""", ctes=("labelled",))
def q_target_summary(spark, sf_dir):
    up = _up(spark, sf_dir)
    return SR.target_summary(SR.required_targets(up, REQUIRED), SR.count_down(up)).select(fmt_utc("at").alias("instant"), "required_down", "total_down", "other_down")


@query("containers_restarting", """
SELECT container, count(*) FILTER (WHERE inspect_id % 4 = 1) AS restarting, count(*) FILTER (WHERE inspect_id % 4 > 1) AS failed, count(*) AS containers
FROM inspect GROUP BY container
""", ctes=("inspect",))
def q_containers_restarting(spark, sf_dir):
    """Restarting containers counted from inspect output."""
    return SR.restarting(fx.inspect(spark, sf_dir), ["container"])
