"""Labelled metric samples: ``(ts, sample_id, name, labels map, value)`` and what is asked of them.

* A series is a name with its labels; :func:`series_id` writes it in one canonical form, labels sorted by name.
* Matchers are ``(label, op, value)`` with ``=``, ``!=``, ``=~`` and ``!~``; a missing label counts as empty, regular expressions
  are anchored at both ends. Samples are stored by name, so a selector reads the folders of its name only.
* An instant vector holds the last value of each series within the lookback before each instant of a grid. A sample is copied to
  the instants that can see it (lookback / step, a constant); the reduction to one value is an aggregate with map-side partials, so a hot
  series doesn't meet in a task. Rates work per series and window (see ``timeseries.counter_increase``).
* Quantiles come from rates per ``le``, summed over series, made monotone (a missing bucket of one series would make
  the sums fall), +Inf last. Without an +Inf bucket, with fewer than two buckets or no events the quantile is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.artifacts import flatten_container_inspect
from fleetlens.operators.timeseries import counter_increase

Matcher = tuple[str, str, str]


def series_id(name: str = "name", labels: str = "labels") -> Column:
    """``name{a="x",b="y"}``: labels sorted, backslashes, quotes and line ends escaped."""
    quoted = lambda v: F.replace(F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit('="'), quoted(e["value"]), F.lit('"')))
    return F.concat(F.col(name), F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def matches(matchers: list[Matcher], labels: str = "labels") -> Column:
    """Whether a series' labels pass all matchers."""
    cond = F.lit(True)
    for label, op, value in matchers:
        own = F.coalesce(F.try_element_at(labels, F.lit(label)), F.lit(""))
        if op not in ("=", "!=", "=~", "!~"):
            raise ValueError(f"unknown matcher {op}")
        hit = own == F.lit(value) if op in ("=", "!=") else own.rlike(f"\\A(?:{value})\\z")
        cond = cond & (~hit if op.startswith("!") else hit)
    return cond


def select_series(samples: DataFrame, name: str, matchers: list[Matcher] = ()) -> DataFrame:
    """Samples of a name whose labels match, with their ``series``."""
    return samples.where((F.col("name") == name) & matches(list(matchers))).withColumn("series", series_id())


def store_samples(samples: DataFrame, path: str) -> None:
    """Append samples, one folder per name."""
    samples.write.mode("append").partitionBy("name").parquet(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def label(name: str) -> Column:
    return F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit("")).alias(name)


# instant vectors -----------------------------------------------------------------------------------------

def instant_vectors(selected: DataFrame, step_seconds: int, lookback_seconds: int) -> DataFrame:
    """(at, series, labels, value): last sample of each series in (at - lookback, at], for all instants of a grid."""
    us, step = F.unix_micros("ts"), step_seconds * 1_000_000
    first = F.ceil(us / F.lit(step)).cast("long")
    last = F.floor((us + lookback_seconds * 1_000_000 - 1) / F.lit(step)).cast("long")
    seen = selected.where(first <= last).withColumn("_k", F.explode(F.sequence(first, last)))
    newest = F.max_by(F.struct("labels", "value"), F.struct("ts", "sample_id"))
    return seen.groupBy((F.col("_k") * step_seconds).alias("_s"), "series").agg(newest.alias("x")).select(
        F.timestamp_seconds("_s").alias("at"), "series", "x.labels", "x.value")


def max_by_label(vectors: DataFrame, by: list[str]) -> DataFrame:
    """Max over the series of a group, per instant."""
    return vectors.groupBy("at", *(label(b) for b in by)).agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("series"))


def count_down(vectors: DataFrame) -> DataFrame:
    """Series whose last value is 0, per instant (0 where all are up)."""
    return vectors.groupBy("at").agg(F.count_if(F.col("value") == 0).alias("down"), F.count(F.lit(1)).alias("series"))


# rates ---------------------------------------------------------------------------------------------------

def rates(selected: DataFrame, by: list[str], window_seconds: int) -> DataFrame:
    """(window_start, by..., rate): increase per second with resets, summed over the series of a group."""
    rows = selected.select("series", *(label(b) for b in by), "ts", "sample_id", "value")
    grown = counter_increase(rows, ["series", *by], "value", window_seconds)
    return grown.groupBy("window_start", *by).agg((F.sum("increase") / F.lit(float(window_seconds))).alias("rate"))


def bucket_quantile(bucket_rates: DataFrame, q: float, by: list[str] = ()) -> DataFrame:
    """(window_start, by..., total, quantile) from rates per ``le``; a group's buckets are as many as bounds exist."""
    le = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").try_cast("double"))
    found = bucket_rates.withColumn("_le", le).where(F.col("_le").isNotNull())
    rows = found.groupBy("window_start", *by).agg(F.array_sort(F.collect_list(F.struct(F.col("_le").alias("le"), F.col("rate").alias("n")))).alias("b"))
    # a bucket holds at least what those below it hold
    rising = F.transform("b", lambda x, i: F.struct(x["le"].alias("le"), F.array_max(F.transform(F.slice("b", 1, i + 1), lambda y: y["n"])).alias("n")))
    rows = rows.withColumn("b", rising).withColumn("k", F.size("b")).withColumn("total", F.element_at("b", -1)["n"])
    rank = F.lit(q) * F.col("total")
    at = F.array_position(F.transform("b", lambda x: x["n"] >= rank), F.lit(True)).cast("int")
    rows = rows.withColumn("rank", rank).withColumn("i", at)
    here, below = F.get("b", F.col("i") - 1), F.get("b", F.col("i") - 2)
    low, under = F.coalesce(below["le"], F.lit(0.0)), F.coalesce(below["n"], F.lit(0.0))
    inside = low + (here["le"] - low) * (F.col("rank") - under) / (here["n"] - under)
    whole = (F.element_at("b", -1)["le"] == F.lit(float("inf"))) & (F.col("k") >= 2) & (F.col("total") > 0)
    value = F.when(F.col("i") == F.col("k"), F.get("b", F.col("k") - 2)["le"]).when((F.col("i") == 1) & (here["le"] <= 0), here["le"]).otherwise(inside)
    return rows.select("window_start", *by, "total", F.when(whole, value).alias("quantile"))


# targets -------------------------------------------------------------------------------------------------

def required_targets(vectors: DataFrame, targets: dict[str, list[Matcher]]) -> DataFrame:
    """(at, target, value, down) for each required target and instant; a target without a series has no value, which isn't 0
    but is down all the same. ``targets`` is configuration; instants are those at which any series was seen."""
    hits = [F.when(matches(m), F.lit(name)) for name, m in targets.items()]
    seen = vectors.select("at", F.explode(F.array_compact(F.array(*hits))).alias("target"), "value").groupBy("at", "target").agg(F.max("value").alias("value"))
    wanted = vectors.select("at").distinct().withColumn("target", F.explode(F.array(*(F.lit(t) for t in targets))))
    out = wanted.join(seen, ["at", "target"], "left")
    return out.withColumn("down", F.coalesce(F.col("value") < 1, F.lit(True)))


def target_summary(required: DataFrame, down: DataFrame) -> DataFrame:
    """A16 / P21 per instant: required targets down, all series down, and those beyond the required ones."""
    core = required.groupBy("at").agg(F.count_if("down").alias("required_down"))
    out = core.join(down.select("at", F.col("down").alias("total_down")), "at", "left")
    total = F.coalesce("total_down", F.lit(0))
    return out.select("at", "required_down", total.alias("total_down"), F.greatest(total - F.col("required_down"), F.lit(0)).alias("other_down"))


def restarting(inspects: DataFrame, by: list[str], raw: str = "raw") -> DataFrame:
    """Containers whose inspect output says restarting, and calls that failed, per group."""
    state = inspects.withColumn("_c", flatten_container_inspect(raw))
    return state.groupBy(*by).agg(F.count_if(F.col("_c.state") == "restarting").alias("restarting"),
                                  F.count_if(F.col("_c.status") == "inspect_failed").alias("failed"), F.count(F.lit(1)).alias("containers"))
