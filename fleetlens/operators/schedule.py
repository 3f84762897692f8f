"""Scheduled signals.

The reference polls every 30 s and fires a schedule when the current minute is due, once per
``(schedule, minute)`` slot. Two batch forms:

* ``due_slots`` - backfill: every due slot in ``[start, end]``. Due minutes are fixed per day by
  (hour, minute), so the expansion is days x schedules (never minutes), each day on its own row;
* ``fired_slots`` - replay of observed poll times: the polls that fall in a due minute fire, and the
  first poll of a slot wins (insert-or-ignore = ``min(poll_ts)`` per slot, a partial aggregation).

``unfired_slots`` is the left-anti join of the two (J4): due slots no poll fired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.timefn import slot_key


def schedule_due(ts, weekdays, hour, minute):
    """weekday (Monday=0) in the schedule's set and hour/minute equal."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.array_contains(F.col(weekdays), F.weekday(t)) & (F.hour(t) == F.col(hour))
            & (F.minute(t) == F.col(minute)))


def due_slots(schedules: DataFrame, start, end) -> DataFrame:
    """T4 backfill: (schedule_name, slot_ts) for every due minute in [start, end] (Columns or literals).

    Days are joined to the schedules' weekdays by an equi-join on the weekday (schedules exploded to
    one row per allowed weekday - configuration, broadcast)."""
    s = schedules.where(F.col("enabled")).select("name", "hour", "minute", "signal",
                                                 F.explode(F.array_distinct("weekdays")).alias("wd"))
    bounds = s.sparkSession.range(1).select(F.to_date(start).alias("d0"), F.to_date(end).alias("d1"),
                                            start.alias("t0"), end.alias("t1"))
    days = bounds.select(F.explode(F.sequence("d0", "d1")).alias("day"), "t0", "t1").withColumn("wd", F.weekday("day"))
    slots = days.join(F.broadcast(s), "wd")
    slot_ts = F.make_timestamp(F.year("day"), F.month("day"), F.dayofmonth("day"), F.col("hour"), F.col("minute"),
                               F.lit(0))
    out = slots.select(F.col("name").alias("schedule_name"), slot_ts.alias("slot_ts"), "signal", "t0", "t1")
    return out.where((F.col("slot_ts") >= F.date_trunc("minute", "t0")) & (F.col("slot_ts") <= F.col("t1"))).drop(
        "t0", "t1")


def schedule_signals(slots: DataFrame) -> DataFrame:
    """Signals emitted for slots: the schedule's signal map plus fingerprint ``schedule:<name>:<slot>``."""
    sk = slot_key("slot_ts")
    sig = F.col("signal")
    return slots.select(
        "schedule_name", sk.alias("slot_key"), F.col("slot_ts").alias("ts"),
        F.lit("scheduler").alias("source"),
        F.coalesce(sig["status"], F.lit("")).alias("status"),
        F.coalesce(sig["alertname"], F.lit("")).alias("alertname"),
        F.coalesce(sig["severity"], F.lit("")).alias("severity"),
        F.coalesce(sig["instance"], F.lit("")).alias("instance"),
        F.coalesce(sig["job"], F.lit("")).alias("job"),
        F.coalesce(sig["summary"], F.lit("")).alias("summary"),
        F.concat(F.lit("schedule:"), F.col("schedule_name"), F.lit(":"), sk).alias("fingerprint"),
    )


def fired_slots(polls: DataFrame, schedules: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Replay of polls: a poll in a due minute fires its schedule; first poll per slot is recorded (K4).

    Polls meet the (broadcast) schedule configuration by an equi-join on (hour, minute); the weekday
    set is checked after the join."""
    s = schedules.where(F.col("enabled")).select("name", "weekdays", "hour", "minute")
    p = polls.select(F.col(ts_col).alias("poll_ts")).withColumn("hour", F.hour("poll_ts")).withColumn(
        "minute", F.minute("poll_ts"))
    due = p.join(F.broadcast(s), ["hour", "minute"]).where(F.array_contains("weekdays", F.weekday("poll_ts")))
    return due.groupBy(F.col("name").alias("schedule_name"), slot_key("poll_ts").alias("slot_key")).agg(
        F.min("poll_ts").alias("triggered_at"))


def unfired_slots(due: DataFrame, fired: DataFrame) -> DataFrame:
    """Due slots without a recorded firing (left anti on the composite key)."""
    d = due.select("schedule_name", slot_key("slot_ts").alias("slot_key"))
    return d.join(fired.select("schedule_name", "slot_key"), on=["schedule_name", "slot_key"], how="left_anti")
