"""Metric-sample queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.timefn import as_of_lit, fmt_utc
from fleetlens.operators import timeseries as TS
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

# FIXED VALUES - report time point of the samples, rate/quantile window, quantile.
AS_OF = "2024-01-31 00:00:00"
WINDOW_SECONDS = 3600
QUANTILE = 0.95
_FMT = "'%Y-%m-%d %H:%M:%S UTC'"


@query("latest_up", f"""
WITH last AS (
  SELECT instance, service, arg_max(up_value, (ts, sample_id)) AS v FROM samples
  WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY instance, service
)
SELECT service, max(v) AS max_up, count(*) AS series FROM last GROUP BY service
""", ctes=("samples",))
def q_latest_up(spark, sf_dir):
    out = TS.latest_up(fx.samples(spark, sf_dir), "service", ["instance", "service"], as_of_lit(AS_OF))
    return out.select("service", "max_up", "series")


@query("count_down", f"""
WITH last AS (
  SELECT instance, service, arg_max(up_value, (ts, sample_id)) AS v FROM samples
  WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY instance, service
)
SELECT service, count(*) FILTER (WHERE v = 0) AS down_series FROM last GROUP BY service
""", ctes=("samples",))
def q_count_down(spark, sf_dir):
    out = TS.latest_up(fx.samples(spark, sf_dir), "service", ["instance", "service"], as_of_lit(AS_OF))
    return out.select("service", "down_series")


_WSTART = f"to_timestamp(floor(epoch(ts) / {WINDOW_SECONDS}) * {WINDOW_SECONDS})"


@query("counter_rate", f"""
WITH s AS (
  SELECT instance, service, ts, sample_id, counter_value AS v,
    strftime({_WSTART} AT TIME ZONE 'UTC', {_FMT}) AS window_start FROM samples
),
d AS (
  SELECT *, lag(v) OVER (PARTITION BY instance, service, window_start ORDER BY ts, sample_id) AS prev FROM s
)
SELECT service, window_start,
  sum(CASE WHEN prev IS NULL THEN CAST(0 AS DOUBLE) WHEN v < prev THEN v ELSE v - prev END) AS increase,
  sum(CASE WHEN prev IS NULL THEN CAST(0 AS DOUBLE) WHEN v < prev THEN v ELSE v - prev END)
    / CAST({WINDOW_SECONDS} AS DOUBLE) AS rate
FROM d GROUP BY service, window_start
""", ctes=("samples",))
def q_counter_rate(spark, sf_dir):
    r = TS.counter_rate(fx.samples(spark, sf_dir), ["service"], ["instance", "service"], "counter_value",
                        WINDOW_SECONDS)
    return r.select("service", fmt_utc("window_start").alias("window_start"), "increase", "rate")


_B = [f"CAST({b} AS DOUBLE)" for b in fx.LATENCY_BUCKETS]


@query("latency_p95", f"""
WITH a AS (
  SELECT service, strftime({_WSTART} AT TIME ZONE 'UTC', {_FMT}) AS window_start,
    [{', '.join(f'count(*) FILTER (WHERE latency_seconds <= {b})' for b in _B)}, count(latency_seconds)] AS cum
  FROM samples GROUP BY 1, 2
),
b AS (
  SELECT *, cum[{len(_B) + 1}] AS total, CAST({QUANTILE} AS DOUBLE) * cum[{len(_B) + 1}] AS rnk,
    [{', '.join(_B)}] AS ub FROM a
),
c AS (
  SELECT *, list_filter(range(1, {len(_B) + 2}), lambda i: cum[i] >= rnk)[1] AS idx FROM b
)
SELECT service, window_start, total AS observations,
  CASE WHEN total = 0 THEN NULL
       WHEN idx = {len(_B) + 1} THEN ub[{len(_B)}]
       ELSE (CASE WHEN idx > 1 THEN ub[idx - 1] ELSE CAST(0 AS DOUBLE) END)
            + (ub[idx] - (CASE WHEN idx > 1 THEN ub[idx - 1] ELSE CAST(0 AS DOUBLE) END))
              * ((rnk - (CASE WHEN idx > 1 THEN cum[idx - 1] ELSE 0 END))
                 / (cum[idx] - (CASE WHEN idx > 1 THEN cum[idx - 1] ELSE 0 END)))
  END AS quantile
FROM c
""", ctes=("samples",))
def q_latency_p95(spark, sf_dir):
    s = fx.samples(spark, sf_dir)
    h = TS.histogram_quantile(s, ["service"], "latency_seconds", list(fx.LATENCY_BUCKETS), QUANTILE, WINDOW_SECONDS)
    return h.select("service", fmt_utc("window_start").alias("window_start"), "observations", "quantile")


@query("metric_samples", """
SELECT instance, count(*) AS samples, sum(up_value) AS up_sum FROM samples
WHERE service = 'error' AND regexp_full_match(instance, 'host-[0-3]') GROUP BY instance
""", ctes=("samples",))
def q_metric_samples(spark, sf_dir):
    """Select series by label matchers (``service="error"``, ``instance=~"host-[0-3]"``)."""
    s = fx.samples(spark, sf_dir)
    m = TS.series_matcher({"service": "error"}, {"instance": "host-[0-3]"})
    return s.where(m).groupBy("instance").agg(F.count(F.lit(1)).alias("samples"), F.sum("up_value").alias("up_sum"))


@query("windowed_signal_rate", f"""
WITH w AS (
  SELECT s.alertname, to_timestamp(floor(epoch(s.ts) / 60) * 60) - INTERVAL (k.k * 60) SECOND AS wstart
  FROM signals s CROSS JOIN range(0, 5) k(k)
)
SELECT alertname, strftime(wstart AT TIME ZONE 'UTC', {_FMT}) AS window_start, count(*) AS events,
  count(*) / CAST(300 AS DOUBLE) AS per_second
FROM w GROUP BY 1, 2
""", ctes=("sig0", "signals"))
def q_windowed_signal_rate(spark, sf_dir):
    """T8 batch twin: signals per alertname in 5-minute windows sliding by 1 minute."""
    s = fx.signals(spark, sf_dir)
    r = TS.windowed_rate(s, ["alertname"], "5 minutes", "1 minute")
    return r.select("alertname", fmt_utc("window_start").alias("window_start"), "events", "per_second")
