"""Audit golden rows (docs examples) and level = max finding severity."""

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetlens.operators import audits as AU
from fleetlens.operators import mac as MAC
from fleetlens.sources import fixtures as fx


def test_kv_parse_last_duplicate_wins(spark):
    logs = spark.createDataFrame([(1, "h", "=== x ===\n a = 1 \nnoise\nb=2=3\na=4\n\n")], "log_id long, host string, text string")
    facts = {r["key"]: r["value"] for r in AU.kv_facts(logs).collect()}
    assert facts == {"a": "4", "b": "2=3"}


def test_level_is_worst_severity(spark):
    a = AU.analyze(fx.kv_logs(spark, SF_SMALL), AU.vps_findings).toPandas()
    for r in a.itertuples():
        sev = {f["severity"] for f in r.findings}
        expected = "critical" if "critical" in sev else ("warning" if sev else "ok")
        assert r.level == expected
        assert r.findings_count == r.warning_count + r.critical_count


def test_golden_mac_snapshot_texts(spark):
    snap = spark.createDataFrame(pd.DataFrame([{
        "snapshot_id": 1, "host": "mba", "timestamp_unix": 0, "memory_free_percent": 8.0, "swap_used_mb": 5000.0,
        "disk_used_percent": 50.0, "battery_percent": 90, "power_source": "ac", "tm_latest_backup": "/x",
        "brew_outdated_count": 1, "agent_launchd_loaded": True}]))
    s = MAC.analyze_snapshots(snap).first()
    assert s["summary"] == "warning:memory free 8%; warning:swap used 5000MB"


def test_golden_stack_5xx_text(spark):
    logs = spark.createDataFrame([(1, "vps", "demo_app_5xx_rate=0.0231")], "log_id long, host string, text string")
    f = AU.explode_findings(AU.analyze(logs, AU.stack_findings)).where(F.col("kind") == "demo_app_5xx").first()
    assert f["message"] == "demo-app 5xx rate 0.0231/s"
