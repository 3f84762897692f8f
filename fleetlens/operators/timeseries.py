"""Metric-sample analytics that the reference delegates to PromQL.

Samples are rows ``(ts, series labels..., value)``. Definitions (ours, stated because the metrics
server's exact extrapolation is out of scope):

* ``latest_per_series`` - last sample at or before ``as_of`` per series (optionally within a
  lookback); ``max`` over series gives ``max(up{...})`` (A17), ``count_if(v == 0)`` gives
  ``count(up == 0)`` (A18). Both are aggregations (partial + final), so hot series combine map-side.
* ``counter_increase`` - per tumbling window and series, the sum of positive deltas between
  consecutive samples inside the window; after a reset (value drops) the delta is the new value.
  ``rate`` = increase / window seconds, no extrapolation (A19). Deltas are computed in a window
  partitioned by (series, window) - bounded by one window of one series.
* ``histogram_quantile`` - per window, cumulative bucket counts with the given ``le`` bounds (+Inf
  last), first bucket whose cumulative count reaches ``q * total``, linear interpolation inside it;
  the +Inf bucket answers the highest finite bound (A20). One aggregation per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.operators.scan import previous_value
from fleetlens.session import ranged


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def series_matcher(labels: dict[str, str] | None = None, regex: dict[str, str] | None = None) -> Column:
    """Label matchers ``=`` and ``=~`` (regexes fully anchored, as in PromQL)."""
    cond = F.lit(True)
    for k, v in (labels or {}).items():
        cond = cond & (F.col(k) == F.lit(v))
    for k, v in (regex or {}).items():
        cond = cond & F.col(k).rlike(f"^(?:{v})$")
    return cond


def latest_per_series(samples: DataFrame, series: list[str], value: str, as_of: Column,
                      lookback_seconds: int | None = None, ts: str = "ts", tiebreak: str = "sample_id") -> DataFrame:
    s = samples.where(F.col(ts) <= as_of)
    if lookback_seconds is not None:
        s = s.where(F.col(ts) > as_of - F.make_dt_interval(secs=F.lit(lookback_seconds)))
    return s.groupBy(*series).agg(
        F.max_by(F.col(value), F.struct(F.col(ts), F.col(tiebreak))).alias("last_value"),
        F.max(ts).alias("last_ts"))


def latest_up(samples: DataFrame, by: str, series: list[str], as_of: Column) -> DataFrame:
    """A17 ``max(up{..})`` per ``by`` group, and A18 ``count(up == 0)`` (0 when no series is down)."""
    last = latest_per_series(samples, series, "up_value", as_of)
    return last.groupBy(by).agg(F.max("last_value").alias("max_up"),
                                F.count_if(F.col("last_value") == 0).alias("down_series"),
                                F.count(F.lit(1)).alias("series"))


def counter_increase(samples: DataFrame, series: list[str], value: str, window_seconds: int,
                     ts: str = "ts", tiebreak: str = "sample_id") -> DataFrame:
    """Per (series, window): increase with counter-reset handling; windows are tumbling."""
    w_start = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / window_seconds) * window_seconds)
    s = samples.select(*series, ts, tiebreak, value, w_start.alias("window_start"))
    s = ranged(s, [*series, "window_start", ts, tiebreak], "counter")
    s = previous_value(s, [*series, "window_start"], [ts, tiebreak], value, "_prev")
    prev = F.col("_prev")
    delta = F.when(prev.isNull(), F.lit(0.0)).when(F.col(value) < prev, F.col(value)).otherwise(F.col(value) - prev)
    return s.withColumn("delta", delta).groupBy(*series, "window_start").agg(F.sum("delta").alias("increase"))


def counter_rate(samples: DataFrame, by: list[str], series: list[str], value: str, window_seconds: int) -> DataFrame:
    """A19 ``sum by (by) (rate(x[window]))`` per tumbling window."""
    inc = counter_increase(samples, series, value, window_seconds)
    return inc.groupBy(*by, "window_start").agg(F.sum("increase").alias("increase")).withColumn(
        "rate", F.col("increase") / F.lit(float(window_seconds)))


def histogram_quantile(observations: DataFrame, by: list[str], value: str, bounds: list[float], q: float,
                       window_seconds: int, ts: str = "ts") -> DataFrame:
    """Q-quantile per (by, window) from cumulative ``le`` bucket counts (+Inf appended)."""
    w_start = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / window_seconds) * window_seconds)
    cums = [F.count_if(F.col(value) <= F.lit(b)) for b in bounds] + [F.count(F.col(value))]
    agg = observations.groupBy(*by, w_start.alias("window_start")).agg(F.array(*cums).alias("cum"))
    nb = len(bounds) + 1
    ub = F.array(*[F.lit(float(b)) for b in bounds])
    total = F.element_at("cum", nb)
    rank = F.lit(q) * total
    idx = F.element_at(F.filter(F.sequence(F.lit(1), F.lit(nb)), lambda i: F.element_at("cum", i) >= rank), 1)
    prev = F.when(idx > 1, F.element_at("cum", idx - 1)).otherwise(F.lit(0))
    lower = F.when(idx > 1, F.element_at(ub, idx - 1)).otherwise(F.lit(0.0))
    upper = F.element_at(ub, F.least(idx, F.lit(nb - 1)))
    count = F.element_at("cum", idx) - prev
    interp = lower + (upper - lower) * ((rank - prev) / count)
    quant = (F.when(total == 0, F.lit(None).cast("double"))
             .when(idx == nb, F.element_at(ub, nb - 1))
             .otherwise(interp))
    return agg.select(*by, "window_start", total.alias("observations"), quant.alias("quantile"))


def windowed_rate(events: DataFrame, by: list[str], window: str, slide: str, ts: str = "ts") -> DataFrame:
    """T8 (batch form): event counts per sliding window, per second."""
    w = F.window(ts, window, slide)
    secs = (F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))).cast("double")
    return events.groupBy(*by, w.alias("w")).agg(F.count(F.lit(1)).alias("events")).select(
        *by, F.col("w.start").alias("window_start"), "events", (F.col("events") / secs).alias("per_second"))
