"""Rules and cooldown: golden rows from the docs and properties of the greedy replay."""

import random

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from fleetlens.operators import rules as R
from fleetlens.sources import fixtures as fx


def _signal_df(spark, rows):
    cols = ["signal_id", "ts", "status", "alertname", "severity", "instance", "job", "fingerprint"]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=cols))
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def test_golden_backup_missing_is_chain(spark):
    d = R.first_match(_signal_df(spark, [(1, "2024-01-01 00:00:00", "firing", "BackupMissing", "critical", "vps",
                                          "backup", "")])).first()
    assert d["decision"] == "execute_chain" and d["rule_name"] == "backup_missing_chain"
    assert d["alert_key"] == "backup_missing_chain:BackupMissing"


def test_golden_reboot_is_ignored_by_rule(spark):
    d = R.first_match(_signal_df(spark, [(1, "2024-01-01 00:00:00", "firing", "HostRebootDetected", "info", "x",
                                          "y", "fp")])).first()
    assert d["decision"] == "ignore" and d["reason"] == "matched ignore rule: host_reboot_detected_ignore"


def test_no_match_uses_fingerprint_key(spark):
    d = R.first_match(_signal_df(spark, [(1, "2024-01-01 00:00:00", "resolved", "BackupMissing", "critical", "x",
                                          "y", " fp1 ")])).first()
    assert d["decision"] == "ignore" and d["reason"] == "no matching action rule" and d["alert_key"] == "fp1"


def test_cooldown_equals_bruteforce(spark):
    d = R.first_match(fx.signals(spark, SF_SMALL))
    a = {r["signal_id"]: r["decision"] for r in R.greedy_cooldown(d).collect()}
    pdf = d.select("signal_id", "ts", "alert_key", "decision", "cooldown_seconds").toPandas().sort_values(
        ["ts", "signal_id"])
    last, brute = {}, {}
    for r in pdf.itertuples():
        if r.decision == "ignore" or r.cooldown_seconds <= 0:
            brute[r.signal_id] = r.decision
            continue
        prev = last.get(r.alert_key)
        if prev is not None and (r.ts - prev.floor("s")).total_seconds() < r.cooldown_seconds:
            brute[r.signal_id] = "cooldown"
        else:
            brute[r.signal_id] = r.decision
            last[r.alert_key] = r.ts
    assert a == brute


def test_cooldown_gap_property(spark):
    """Between two executions of one key at least the cooldown passes; each signal has one decision."""
    d = R.greedy_cooldown(R.first_match(fx.signals(spark, SF_ORACLE)))
    pdf = d.select("signal_id", "ts", "alert_key", "decision", "cooldown_seconds").toPandas()
    assert pdf.signal_id.is_unique
    ex = pdf[pdf.decision.isin(["execute", "execute_chain"]) & (pdf.cooldown_seconds > 0)].sort_values("ts")
    for _, g in ex.groupby("alert_key"):
        gaps = (g.ts - g.ts.shift().dt.floor("s")).dt.total_seconds().dropna()
        assert (gaps >= g.cooldown_seconds.iloc[0]).all()


def test_one_key_holds_every_candidate(spark):
    """Islands and long orbits of one hot key against a plain replay."""
    rng = random.Random(4)
    secs, t = [], 0
    for _ in range(600):
        t += rng.choice([1, 3, 7, 7, 20, 200])
        secs.append(t)
    rows = [(i, f"2024-01-01 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", "firing", "BackupMissing", "critical", "h", "j", "fp")
            for i, s in enumerate(secs)]
    d = R.first_match(_signal_df(spark, rows)).withColumn("cooldown_seconds", F.lit(60).cast("long"))
    got = sorted(r["signal_id"] for r in R.greedy_cooldown(d).where("decision = 'execute_chain'").collect())
    want, last = [], None
    for i, s in enumerate(secs):
        if last is None or s - last >= 60:
            want.append(i)
            last = s
    assert got == want and len(want) > 100
