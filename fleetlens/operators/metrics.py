"""Metric families over decisions / tasks / runs (A1-A6, J6) and the exposition sink.

Every family is a plain ``groupBy`` (partial + final aggregation, so hot groups are combined map-side).
The families are unioned into one long table ``(family, labels map, value)`` and rendered to text
lines with the labels sorted by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.maps import json_path
from fleetlens.functions.text import format_labels
from fleetlens.sources.fixtures import TASK_TYPES

# FIXED VALUES - family name, help text, type; in exposition order.
FAMILIES = [
    ("action_runner_decisions_total", "Total decisions by decision type.", "counter"),
    ("action_runner_tasks_total", "Total tasks by type and status.", "counter"),
    ("action_runner_runs_total", "Total action runs by action and status.", "counter"),
    ("action_runner_mac_remediation_total", "Total remote mac remediation results.", "counter"),
    ("action_runner_queue_depth", "Current pending and running tasks by type.", "gauge"),
    ("action_runner_last_decision_unixtime", "Latest decision timestamp in unix seconds.", "gauge"),
    ("action_runner_last_task_unixtime", "Latest task timestamp in unix seconds.", "gauge"),
    ("action_runner_last_run_unixtime", "Latest run timestamp in unix seconds.", "gauge"),
]


def tasks_by_type_status(tasks: DataFrame) -> DataFrame:
    """A2."""
    return tasks.groupBy("task_type", "status").agg(F.count(F.lit(1)).alias("count"))


def runs_by_action_status(runs: DataFrame) -> DataFrame:
    """A3."""
    return runs.groupBy("action", "status").agg(F.count(F.lit(1)).alias("count"))


def remediation_by_action_status(tasks: DataFrame) -> DataFrame:
    """A4: mac_action tasks by payload action (JSON field, '' when absent) and status."""
    return (tasks.where(F.col("task_type") == "mac_action")
            .groupBy(json_path("payload", "$.action").alias("action"), "status")
            .agg(F.count(F.lit(1)).alias("count")))


def queue_depth(tasks: DataFrame, known_types=TASK_TYPES) -> DataFrame:
    """A5 + J6: pending+running per known task type, zero-filled; unknown types dropped."""
    counts = (tasks.where(F.col("status").isin("pending", "running"))
              .groupBy("task_type").agg(F.count(F.lit(1)).alias("depth")))
    dim = tasks.sparkSession.createDataFrame([(t,) for t in known_types], "task_type string")
    return (F.broadcast(dim).join(counts, "task_type", "left")
            .select("task_type", F.coalesce("depth", F.lit(0)).cast("long").alias("depth")))


def last_activity(decisions: DataFrame, tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """Latest decision / task / run time in unix seconds (0 when none). One row: the three
    sources are tagged, unioned and reduced by one aggregation (no join of single-row frames)."""
    d = decisions.select(F.lit(0).alias("src"), F.col("ts").alias("x"))
    t = tasks.select(F.lit(1).alias("src"), F.coalesce("finished_at", "started_at", "created_at").alias("x"))
    r = runs.select(F.lit(2).alias("src"), F.coalesce("finished_at", "started_at").alias("x"))
    u = d.unionByName(t).unionByName(r)

    def last(i, name):
        return F.coalesce(F.unix_timestamp(F.max(F.when(F.col("src") == i, F.col("x")))), F.lit(0)).cast("long").alias(name)

    return u.agg(last(0, "last_decision_unixtime"), last(1, "last_task_unixtime"), last(2, "last_run_unixtime"))


def metric_table(decisions: DataFrame, tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """Long form: family, labels (map), value (long), order_key, one row per sample.

    Each source is aggregated once into a small table (decisions by decision; tasks by type, status
    and remediation action; runs by action and status, each with its latest time); every family is
    derived from those aggregates, so the base tables are scanned once per scrape (the aggregates'
    exchanges are reused). ``order_key`` reproduces the source query's ORDER BY.
    """
    def fam(df, name, label_cols, value_col, order=None):
        labels = F.create_map(*[x for c in label_cols for x in (F.lit(c), F.col(c).cast("string"))]) \
            if label_cols else F.create_map().cast("map<string,string>")
        okey = order if order is not None else F.concat_ws("\u0001", *[F.col(c).cast("string") for c in label_cols])
        return df.select(F.lit(name).alias("family"), labels.alias("labels"),
                         F.col(value_col).cast("long").alias("value"), okey.alias("order_key"))

    from fleetlens.session import materialize

    # the three aggregates are tiny (bounded by label combinations); writing them once under the shared
    # checkpoint directory makes every family read them instead of re-scanning the base tables (the
    # families prune and filter differently, so the optimizer would not share the scans)
    d_agg = materialize(decisions.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last")),
                        "metrics-decisions")
    t_agg = materialize(tasks.groupBy(
        "task_type", "status",
        F.when(F.col("task_type") == "mac_action", json_path("payload", "$.action")).alias("mac_action")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce("finished_at", "started_at", "created_at")).alias("last")),
        "metrics-tasks")
    r_agg = materialize(runs.groupBy("action", "status").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce("finished_at", "started_at")).alias("last")), "metrics-runs")

    tasks_fam = t_agg.groupBy("task_type", "status").agg(F.sum("n").alias("count"))
    remed = (t_agg.where(F.col("task_type") == "mac_action").groupBy(F.col("mac_action").alias("action"), "status")
             .agg(F.sum("n").alias("count")))
    counts = (t_agg.where(F.col("status").isin("pending", "running")).groupBy("task_type")
              .agg(F.sum("n").alias("depth")))
    dim = tasks.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(TASK_TYPES)], "_o int, task_type string")
    depth = F.broadcast(dim).join(counts, "task_type", "left").select(
        "task_type", "_o", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))

    def last(agg, name):
        return agg.agg(F.coalesce(F.unix_timestamp(F.max("last")), F.lit(0)).cast("long").alias(name))

    parts = [
        fam(d_agg, FAMILIES[0][0], ["decision"], "n"),
        fam(tasks_fam, FAMILIES[1][0], ["task_type", "status"], "count"),
        fam(r_agg, FAMILIES[2][0], ["action", "status"], "n"),
        fam(remed, FAMILIES[3][0], ["action", "status"], "count"),
        fam(depth, FAMILIES[4][0], ["task_type"], "depth", F.format_string("%05d", F.col("_o"))),
        fam(last(d_agg, "v"), FAMILIES[5][0], [], "v"),
        fam(last(t_agg, "v"), FAMILIES[6][0], [], "v"),
        fam(last(r_agg, "v"), FAMILIES[7][0], [], "v"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def exposition_lines(metrics: DataFrame, families=FAMILIES) -> DataFrame:
    """K5: text lines ``family_order, line_order, line``: HELP, TYPE, then samples sorted by labels.

    The input is already aggregated (one row per label set), so the ordering window is small.
    """
    spark = metrics.sparkSession
    fdim = spark.createDataFrame([(i, n, h, t) for i, (n, h, t) in enumerate(families)],
                                 "family_order int, family string, help string, type string")
    m = metrics.join(F.broadcast(fdim), "family")
    lbl = format_labels("labels")
    w = Window.partitionBy("family_order").orderBy("order_key")
    samples = m.select("family_order", (F.row_number().over(w) + 1).alias("line_order"),
                       F.concat(F.col("family"), lbl, F.lit(" "), F.col("value").cast("string")).alias("line"))
    heads = fdim.select("family_order", F.lit(-1).alias("line_order"),
                        F.concat(F.lit("# HELP "), F.col("family"), F.lit(" "), F.col("help")).alias("line")).unionByName(
        fdim.select("family_order", F.lit(0).alias("line_order"),
                    F.concat(F.lit("# TYPE "), F.col("family"), F.lit(" "), F.col("type")).alias("line")))
    return heads.unionByName(samples)
