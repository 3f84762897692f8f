"""Sinks round-trip (stateful streams: test_stateful_streams.py)."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetlens.operators import rules as R
from fleetlens.session import checkpoint_dir
from fleetlens.sources import fixtures as fx
from fleetlens.sources import sinks


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/tests/{name}-{uuid.uuid4().hex}"


def test_upsert_cooldowns_keeps_max(spark):
    root = _scratch(spark, "cooldowns")
    a = spark.createDataFrame([("k1", "2024-01-01 00:00:00"), ("k2", "2024-01-01 00:00:00")], "alert_key string, t string")
    b = spark.createDataFrame([("k1", "2024-01-02 00:00:00"), ("k1", "2023-01-01 00:00:00")], "alert_key string, t string")
    for df in (a, b):
        sinks.upsert_cooldowns(df.select("alert_key", F.col("t").cast("timestamp").alias("exec_ts")), root)
    got = {r["alert_key"]: str(r["last_executed_at"]) for r in sinks.read_latest(spark, root).collect()}
    assert got == {"k1": "2024-01-02 00:00:00", "k2": "2024-01-01 00:00:00"}


def test_insert_or_ignore_first_wins(spark):
    root = _scratch(spark, "slots")
    mk = lambda rows: spark.createDataFrame(rows, "schedule_name string, slot_key string, t string").select(
        "schedule_name", "slot_key", F.col("t").cast("timestamp").alias("triggered_at"))
    sinks.insert_or_ignore_slots(mk([("a", "2024-01-01 04:00", "2024-01-01 04:00:10")]), root)
    sinks.insert_or_ignore_slots(mk([("a", "2024-01-01 04:00", "2024-01-01 04:00:40"),
                                     ("b", "2024-01-01 04:15", "2024-01-01 04:15:05")]), root)
    got = {(r["schedule_name"], r["slot_key"]): str(r["triggered_at"]) for r in sinks.read_latest(spark, root).collect()}
    assert got == {("a", "2024-01-01 04:00"): "2024-01-01 04:00:10", ("b", "2024-01-01 04:15"): "2024-01-01 04:15:05"}


def test_append_and_latest_view(spark):
    root = _scratch(spark, "decisions")
    d = R.first_match(fx.signals(spark, SF_SMALL)).select("signal_id", "alertname", "ts", "decision")
    sinks.append_rows(d.withColumn("day", F.to_date("ts")), root, ["day"])
    back = spark.read.parquet(root)
    assert back.count() == d.count()
    latest = sinks.latest_view(spark, root, "alertname", "ts")
    assert latest.count() == d.select("alertname").distinct().count()
