"""File readers: logs as whole texts, snapshots with a fixed schema, inventories from metadata."""

import json
import os
import uuid

from pyspark.sql import functions as F

from fleetlens.operators import audits as AU
from fleetlens.operators import artifacts as AR
from fleetlens.session import checkpoint_dir
from fleetlens.sources import readers


def _dir(spark, name):
    d = f"{checkpoint_dir(spark).rstrip('/')}/tests/{name}-{uuid.uuid4().hex}".replace("file:", "")
    os.makedirs(d)
    return d


def test_kv_log_files_to_findings(spark):
    d = _dir(spark, "kvlogs")
    with open(os.path.join(d, "audit_1.log"), "w") as fh:
        fh.write("=== vps ===\nroot_used_percent=93\nreboot_required=yes\n")
    with open(os.path.join(d, "audit_2.log"), "w") as fh:
        fh.write("root_used_percent=10\n")
    logs = readers.read_text_files(spark, d, "audit_*.log").withColumn("log_id", F.monotonically_increasing_id()) \
        .withColumn("host", F.lit("vps"))
    a = AU.analyze(logs, AU.vps_findings).select("log_path", "summary").collect()
    by = {os.path.basename(r["log_path"]): r["summary"] for r in a}
    assert "critical:root disk used 93%" in by["audit_1.log"] and "warning:reboot required" in by["audit_1.log"]
    assert "root disk" not in by["audit_2.log"]


def test_snapshot_reader_quarantines_non_objects(spark):
    d = _dir(spark, "snaps")
    with open(os.path.join(d, "audit_a.json"), "w") as fh:
        fh.write(json.dumps({"host": "mba", "timestamp_unix": 5, "memory_free_percent": 8,
                             "top_processes": [{"pid": 1, "rss_kb": 2048, "mem_percent": 1.0, "command": "x"}]}) + "\n")
        fh.write("[1, 2]\n")
    rows = readers.read_snapshots(spark, d).collect()
    good = [r for r in rows if r["host"] == "mba"]
    assert len(good) == 1 and good[0]["top_processes"][0]["rss_kb"] == 2048
    assert any(r["_corrupt_record"] for r in rows if r["host"] is None)


def test_inventory_metadata_only(spark):
    d = _dir(spark, "backups")
    for name in ["vps-backup-1.tar.gz", "vps-backup-1.tar.gz.sha256", "vps-backup-2.tar.gz", "other.txt"]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write("x")
    inv = readers.read_file_inventory(spark, d).withColumn("host", F.lit("h"))
    pairs = {r["base"]: (r["has_archive"], r["has_checksum"]) for r in AR.archive_pairs(inv).collect()}
    assert pairs == {"vps-backup-1.tar.gz": (True, True), "vps-backup-2.tar.gz": (True, False)}


def test_agent_log_reader(spark):
    d = _dir(spark, "agentlog")
    with open(os.path.join(d, "guard.log"), "w") as fh:
        for i in range(100):
            fh.write(f'[2024-01-01 00:00:00 UTC] level=INFO event={"worker_tick" if i % 2 else "report"} n={i} '
                     f'note="a b" gone=null\n')
    p = AR.parse_agent_log(readers.read_agent_log_lines(spark, d))
    last = AR.agent_event_search(p, ["worker_"], 10, ["line_no"]).collect()
    assert len(last) == 10 and all(r["event"] == "worker_tick" for r in last)
    assert max(int(r["fields"]["n"]) for r in last) == 99
    one = p.where(F.col("fields")["n"] == "1").first()
    assert one["fields"]["note"] == "a b" and one["fields"]["gone"] is None
