"""Sinks written and read back: append, versioned upsert, insert-or-ignore, reports, latest view, snapshot
store, state tables (K1, K3, K4, K6, K9, K11, S7). Each query writes to a folder of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators import rules as R
from fleetlens.operators import schedule as SC
from fleetlens.plans.registry import query
from fleetlens.plans.schedule_queries import FIRED_SQL
from fleetlens.plans.signal_queries import FIRST_MATCH_CTE
from fleetlens.session import checkpoint_dir
from fleetlens.sources import fixtures as fx
from fleetlens.sources import sinks as SK
from fleetlens.sources.config import schedules_table

_FMT = "'%Y-%m-%d %H:%M:%S UTC'"


def _root(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/sinks/{name}-{uuid.uuid4().hex}"


@query("sink_append", f"WITH {FIRST_MATCH_CTE} SELECT signal_id, decision, strftime(ts, '%Y-%m-%d') AS day FROM d",
       ctes=("sig0", "signals"))
def q_sink_append(spark, sf_dir):
    """K1: decisions appended in two batches, partitioned by day."""
    root = _root(spark, "decisions")
    d = R.first_match(fx.signals(spark, sf_dir)).select("signal_id", "decision", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    for odd in (0, 1):
        SK.append_rows(d.where(F.col("signal_id") % 2 == odd), root, ["day"])
    return spark.read.schema(d.schema).parquet(root).select("signal_id", "decision", "day")


@query("sink_upsert", f"""WITH {FIRST_MATCH_CTE}
SELECT alert_key, strftime(max(ts), {_FMT}) AS last_executed_at FROM d WHERE decision <> 'ignore' GROUP BY alert_key
""", ctes=("sig0", "signals"))
def q_sink_upsert(spark, sf_dir):
    """K3: last execution per alert key, upserted in three batches; the newest time wins whatever the order."""
    root = _root(spark, "cooldowns")
    d = R.first_match(fx.signals(spark, sf_dir)).where(F.col("decision") != "ignore").select("alert_key", "signal_id", F.col("ts").alias("exec_ts"))
    for part in (1, 0, 2):
        SK.upsert_cooldowns(d.where(F.col("signal_id") % 3 == part), root)
    return SK.read_latest(spark, root).select("alert_key", fmt_utc("last_executed_at").alias("last_executed_at"))


@query("sink_slots", f"""WITH {FIRED_SQL}
SELECT schedule_name, slot_key, strftime(triggered_at, {_FMT}) AS triggered_at FROM fired
""")
def q_sink_slots(spark, sf_dir):
    """K4: a slot that is there already is ignored, so a later replay changes nothing."""
    root = _root(spark, "slots")
    ev = fx.read_table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    fired = SC.fired_slots(ev, schedules_table(spark)).select("schedule_name", "slot_key", "triggered_at")
    SK.insert_or_ignore_slots(fired.where(F.col("schedule_name") < "n"), root)
    SK.insert_or_ignore_slots(fired.withColumn("triggered_at", F.when(F.col("schedule_name") < "n", F.col("triggered_at") + F.expr("INTERVAL 1 DAY"))
                                               .otherwise(F.col("triggered_at"))), root)
    return SK.read_latest(spark, root).select("schedule_name", "slot_key", fmt_utc("triggered_at").alias("triggered_at"))


@query("sink_report", """
SELECT strftime(date_trunc('day', strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC')), '%Y-%m-%d_%H-%M-%S') AS stamp, count(*) AS reports,
  min(host) AS first_host
FROM snapshots GROUP BY 1
""", ctes=("snapshots",))
def q_sink_report(spark, sf_dir):
    """K6: daily reports in folders named by their UTC stamp."""
    root = _root(spark, "reports")
    s = fx.snapshots(spark, sf_dir).where(F.col("timestamp_utc").isNotNull())
    day = s.select(F.col("host").alias("json_text"), F.concat(F.lit("# "), "host").alias("markdown"),
                   F.date_trunc("day", F.to_timestamp(F.regexp_replace("timestamp_utc", " UTC$", ""))).alias("generated_at"))
    SK.write_report(day.repartition("generated_at"), root)
    return spark.read.parquet(root).groupBy(F.col("stamp").cast("string").alias("stamp")).agg(
        F.count(F.lit(1)).alias("reports"), F.min("json_text").alias("first_host"))


@query("sink_latest", """
SELECT host, max(snapshot_id) AS snapshot_id FROM snapshots GROUP BY host
""", ctes=("snapshots",))
def q_sink_latest(spark, sf_dir):
    """K9: the newest row per host over what two appends wrote."""
    root = _root(spark, "latest")
    s = fx.snapshots(spark, sf_dir).select("host", "snapshot_id")
    for odd in (1, 0):
        SK.append_rows(s.where(F.col("snapshot_id") % 2 == odd).withColumn("version", F.col("snapshot_id")), root)
    return SK.latest_view(spark, root, "host", "version").select("host", "snapshot_id")


@query("sink_snapshots", """
SELECT host, snapshot_id, 'audit_' || strftime(strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC'), '%Y%m%d_%H%M%S') AS stem,
  strftime(strptime(timestamp_utc, '%Y-%m-%d %H:%M:%S UTC'), '%Y%m%d') AS day
FROM snapshots
""", ctes=("snapshots",))
def q_sink_snapshots(spark, sf_dir):
    """The snapshot store, partitioned by day; the file stem is a column."""
    root = _root(spark, "snapshots")
    SK.store_snapshots(fx.snapshots(spark, sf_dir), root)
    return spark.read.parquet(root).select("host", "snapshot_id", "stem", F.col("day").cast("string").alias("day"))


@query("state_tables", """
SELECT 'runs' AS name, count(*) AS n FROM runs UNION ALL SELECT 'tasks', count(*) FROM tasks
UNION ALL SELECT 'cooldowns', count(DISTINCT action) FROM runs
""", ctes=("runs", "tasks"))
def q_state_tables(spark, sf_dir):
    """The operational tables under one root; plain tables and the newest version of versioned ones."""
    root = _root(spark, "state")
    SK.append_rows(fx.runs(spark, sf_dir).select("id", "action"), f"{root}/runs")
    SK.append_rows(fx.tasks(spark, sf_dir).select("id", "status"), f"{root}/tasks")
    SK.upsert_cooldowns(fx.runs(spark, sf_dir).select(F.col("action").alias("alert_key"), F.col("started_at").alias("exec_ts")), f"{root}/cooldowns")
    out = None
    for name, df in SK.read_state(spark, root).items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.unionByName(row)
    return out
