"""Streaming twins, run to completion (availableNow) and compared with the batch oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.plans.registry import ORACLE, query
from fleetlens.plans.signal_queries import COOLDOWN_CTES, FIRST_MATCH_CTE
from fleetlens.sources.config import schedules_table
from fleetlens.streaming import twins as TW

_FMT = "'%Y-%m-%d %H:%M:%S UTC'"


@query("stream_decisions", f"WITH {FIRST_MATCH_CTE} SELECT signal_id, decision, rule_name, reason, alert_key, "
       "cooldown_seconds FROM d", ctes=("sig0", "signals"))
def q_stream_decisions(spark, sf_dir):
    d = TW.stream_decisions(spark, sf_dir).select("signal_id", "decision", "rule_name", "reason", "alert_key",
                                                  "cooldown_seconds")
    return TW.run_append(d, "decisions")


@query("stream_cooldown", f"WITH RECURSIVE {COOLDOWN_CTES} SELECT signal_id, final_decision AS decision, "
       "false AS late FROM cd", ctes=("sig0", "signals"))
def q_stream_cooldown(spark, sf_dir):
    return TW.stream_cooldown(spark, sf_dir)


@query("stream_decision_counts", f"WITH RECURSIVE {COOLDOWN_CTES} SELECT final_decision AS decision, count(*) AS count "
       "FROM cd GROUP BY final_decision", ctes=("sig0", "signals"))
def q_stream_decision_counts(spark, sf_dir):
    """Counters after cooldown, over what the stateful cooldown stream has written."""
    return TW.decision_counts(TW.stream_cooldown(spark, sf_dir))


@query("stream_slot_dedup", None)
def q_stream_slot_dedup(spark, sf_dir):
    out = TW.run_append(TW.stream_slot_dedup(spark, sf_dir, schedules_table(spark)), "slot_dedup")
    return out.select("schedule_name", "slot_key")


@query("stream_snapshot_latest", None)
def q_stream_snapshot_latest(spark, sf_dir):
    out = TW.run_update(TW.stream_snapshot_latest(spark, sf_dir), "snapshot_latest", "host")
    return out.select("host", "snapshot_id", "timestamp_unix", "timestamp_utc", "memory_free_percent",
                      "disk_used_percent")


@query("stream_signal_rate", None)
def q_stream_signal_rate(spark, sf_dir):
    out = TW.stream_signal_rate(spark, sf_dir)
    return out.select("alertname", fmt_utc("w.start").alias("window_start"), "events",
                      (F.col("events") / F.lit(300.0)).alias("per_second"))


@query("stream_task_lifecycle", None)
def q_stream_task_lifecycle(spark, sf_dir):
    out = TW.stream_task_lifecycle(spark, sf_dir)
    return out.select("task_id", "status", fmt_utc("started_at").alias("started_at"),
                      fmt_utc("finished_at").alias("finished_at"), "n_events")


@query("stream_webhook_tasks", None)
def q_stream_webhook_tasks(spark, sf_dir):
    from fleetlens.plans.output_queries import EXECUTE_RULES

    return TW.run_append(TW.stream_webhook_tasks(spark, sf_dir, EXECUTE_RULES), "webhook_tasks")


# The twins share the batch oracles: the stream must produce exactly the batch result.
def _share(stream_name: str, batch_name: str) -> None:
    if batch_name in ORACLE:
        ORACLE[stream_name] = ORACLE[batch_name]


def register_shared_oracles() -> None:
    for s, b in (("stream_slot_dedup", "_fired_slot_keys"), ("stream_snapshot_latest", "snapshot_latest"),
                 ("stream_signal_rate", "windowed_signal_rate"), ("stream_task_lifecycle", "task_latest_state"),
                 ("stream_stale_hosts", "stale_hosts"), ("stream_webhook_tasks", "webhook_to_tasks")):
        _share(s, b)


@query("stream_stale_hosts", None)
def q_stream_stale_hosts(spark, sf_dir):
    from fleetlens.plans.mac_queries import AS_OF_UNIX, MAX_AGE_SECONDS

    out = TW.stream_stale_hosts(spark, sf_dir, AS_OF_UNIX, MAX_AGE_SECONDS)
    return out.select("host", "last_unix", (F.lit(AS_OF_UNIX) - F.col("last_unix")).alias("age_seconds"), "stale")


def broken_log(log):
    """A task log with gaps: some starts are lost, some come after the end, some tasks are created twice."""
    k, start = F.col("task_id"), F.col("seq") == 1
    out = log.where(~(start & (k % 11 == 0)))
    out = out.withColumn("event_ts", F.when(start & (k % 13 == 0), F.col("event_ts") + F.expr("INTERVAL 6 MINUTES")).otherwise(F.col("event_ts")))
    return out.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when((F.col("seq") == 0) & (k % 17 == 0), 2).otherwise(1)))).drop("copy")


@query("stream_task_faults", f"""
WITH f AS (
  SELECT id AS task_id, status, finished_at, id % 17 = 0 AS twice, id % 11 = 0 AS no_start, id % 11 <> 0 AND id % 13 = 0 AS late_start
  FROM tasks WHERE finished_at IS NOT NULL)
SELECT task_id, CASE WHEN late_start THEN 'running' ELSE status END AS status, strftime(finished_at, {_FMT}) AS finished_at,
  concat_ws(', ', CASE WHEN twice THEN 'created again' END, CASE WHEN no_start THEN 'finished without a start' END,
    CASE WHEN late_start THEN 'finished before the start' END) AS faults
FROM f WHERE twice OR no_start OR late_start
""", ctes=("tasks",))
def q_stream_task_faults(spark, sf_dir):
    """Illegal transitions of a log with lost, late and repeated events."""
    out = TW.stream_task_lifecycle(spark, sf_dir, broken_log).where(F.size("faults") > 0)
    return out.select("task_id", "status", fmt_utc("finished_at").alias("finished_at"), F.array_join("faults", ", ").alias("faults"))


@query("stream_decision_sink", f"WITH {FIRST_MATCH_CTE} SELECT signal_id, decision, alert_key FROM d", ctes=("sig0", "signals"))
def q_stream_decision_sink(spark, sf_dir):
    """K1 from a stream, exactly once: every micro-batch is handed to the sink twice, as after a lost commit."""
    return TW.replayed_sink(TW.stream_decisions(spark, sf_dir).select("signal_id", "decision", "alert_key")).drop("batch")
