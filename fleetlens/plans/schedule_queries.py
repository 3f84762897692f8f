"""Schedule expansion and slot de-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators import rules as R
from fleetlens.operators import schedule as SC
from fleetlens.plans.registry import query
from fleetlens.plans.signal_queries import _sql_first_match
from fleetlens.sources import fixtures as fx
from fleetlens.sources.config import SCHEDULES, schedules_table

_SCHED_VALUES = ", ".join(
    f"('{s['name']}', {list(s['weekdays'])}, {s['hour']}, {s['minute']}, '{s['signal']['alertname']}', "
    f"'{s['signal']['severity']}', '{s['signal']['instance']}', '{s['signal']['job']}', '{s['signal']['status']}')"
    for s in SCHEDULES)
SCHED_CTE = (f"sched(name, weekdays, hour, minute, alertname, severity, instance, job, status) AS "
             f"(VALUES {_SCHED_VALUES})")

DUE_SQL = f"""{SCHED_CTE},
rng AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM events),
days AS (SELECT unnest(generate_series(CAST(t0 AS DATE), CAST(t1 AS DATE), INTERVAL 1 DAY)) AS day, t0, t1 FROM rng),
due AS (
  SELECT s.*, CAST(d.day AS TIMESTAMP) + to_hours(s.hour) + to_minutes(s.minute) AS slot_ts, d.t0, d.t1
  FROM days d CROSS JOIN sched s WHERE list_contains(s.weekdays, isodow(d.day) - 1)
),
due2 AS (SELECT * FROM due WHERE slot_ts >= date_trunc('minute', t0) AND slot_ts <= t1)
"""

FIRED_SQL = f"""{SCHED_CTE},
fired AS (
  SELECT s.name AS schedule_name, strftime(date_trunc('minute', e.ts), '%Y-%m-%d %H:%M') AS slot_key,
         min(e.ts) AS triggered_at
  FROM events e JOIN sched s ON list_contains(s.weekdays, isodow(e.ts) - 1) AND hour(e.ts) = s.hour
       AND minute(e.ts) = s.minute
  GROUP BY 1, 2
)
"""


def _range(spark, sf_dir):
    ev = fx.read_table(spark, sf_dir, "events")
    r = ev.agg(F.min(F.col("ts").cast("timestamp")).alias("t0"), F.max(F.col("ts").cast("timestamp")).alias("t1"))
    return r


def _due(spark, sf_dir):
    r = _range(spark, sf_dir).first()  # two scalars (the data's time range), not data
    return SC.due_slots(schedules_table(spark), F.lit(r["t0"]), F.lit(r["t1"]))


@query("schedule_ticks", f"""WITH {DUE_SQL},
sig AS (
  SELECT name AS schedule_name, strftime(slot_ts, '%Y-%m-%d %H:%M') AS slot_key, slot_ts AS ts, status, alertname,
    severity, instance, job, 'schedule:' || name || ':' || strftime(slot_ts, '%Y-%m-%d %H:%M') AS fingerprint
  FROM due2
),
m AS ({_sql_first_match('sig')})
SELECT schedule_name, slot_key, fingerprint, alertname, decision, rule_name, alert_key FROM m
""", ctes=())
def q_schedule_ticks(spark, sf_dir):
    """T4 backfill over the events' time range, classified by the rules (no cooldown can apply:
    every slot has its own fingerprint)."""
    sig = SC.schedule_signals(_due(spark, sf_dir))
    d = R.first_match(sig)
    return d.select("schedule_name", "slot_key", "fingerprint", "alertname", "decision", "rule_name", "alert_key")


@query("scheduler_firings", f"""WITH {FIRED_SQL}
SELECT schedule_name, slot_key, strftime(triggered_at, '%Y-%m-%d %H:%M:%S UTC') AS triggered_at FROM fired
""", ctes=())
def q_scheduler_firings(spark, sf_dir):
    """Replay of observed poll times (event timestamps): first poll per due slot fires (K4)."""
    ev = fx.read_table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    f = SC.fired_slots(ev, schedules_table(spark))
    return f.select("schedule_name", "slot_key", fmt_utc("triggered_at").alias("triggered_at"))


@query("unfired_slots", f"""WITH {DUE_SQL}, {FIRED_SQL.replace(SCHED_CTE + ',', '')}
SELECT d.name AS schedule_name, strftime(d.slot_ts, '%Y-%m-%d %H:%M') AS slot_key FROM due2 d
WHERE NOT EXISTS (SELECT 1 FROM fired f WHERE f.schedule_name = d.name
                  AND f.slot_key = strftime(d.slot_ts, '%Y-%m-%d %H:%M'))
""", ctes=())
def q_unfired_slots(spark, sf_dir):
    ev = fx.read_table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    fired = SC.fired_slots(ev, schedules_table(spark))
    return SC.unfired_slots(_due(spark, sf_dir), fired)
