"""Sinks and state tables on plain Parquet.

Plain Parquet has no MERGE, so keyed state is kept as *versions*: an upsert reads the newest
version, combines it with the new rows by key, and writes the next version directory. Readers take
the newest complete version (a version is complete once its ``_SUCCESS`` marker exists), so a failed
writer never leaves a half-written table behind. Paths must be on shared storage (the cluster's
``spark.checkpoint.dir`` or a table location), never a machine-local folder.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timefn import stamp

_VERSION = re.compile(r"^v(\d{8})$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """Newest complete version of a versioned table (None when there is none)."""
    v = _versions(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/v{v[-1]:08d}") if v else None


def _write_next(df: DataFrame, root: str) -> str:
    v = _versions(df.sparkSession, root)
    path = f"{root.rstrip('/')}/v{(v[-1] + 1 if v else 1):08d}"
    df.write.mode("overwrite").parquet(path)  # what stands there, if anything, was never completed
    return path


# ----------------------------------------------------------------------------- micro-batches, exactly once

_BATCH = re.compile(r"^batch=(\d+)$")


def committed(spark: SparkSession, root: str) -> list[int]:
    """Ids of the micro-batches that a sink holds: a batch folder counts once its ``_SUCCESS`` marker stands."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    found = ((_BATCH.match(st.getPath().getName()), st.getPath()) for st in fs.listStatus(p))
    return sorted(int(m.group(1)) for m, path in found if m and fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")))


def append_batch(df: DataFrame, root: str, batch_id: int) -> bool:
    """K1 from ``foreachBatch``: append a micro-batch once. Its folder is the ledger entry: a batch id that is
    committed is skipped, one whose writer died before the commit is written anew. Tells whether it wrote."""
    if batch_id in committed(df.sparkSession, root):
        return False
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch={batch_id}")
    return True


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """All committed micro-batches, with their id in ``batch``."""
    root = root.rstrip("/")
    return spark.read.option("basePath", root).parquet(*(f"{root}/batch={i}" for i in committed(spark, root)))


def newest_by_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of each key of an update-mode sink: by micro-batch, then by ``order``."""
    columns = [c for c in rows.columns if c not in (key, "batch")]
    newest = F.max_by(F.struct(*columns), F.struct("batch", *order))
    return rows.groupBy(key).agg(newest.alias("x")).select(key, "x.*")


def upsert_batch(executions: DataFrame, root: str, batch_id: int) -> bool:
    """K3 from ``foreachBatch``: the version of a batch id is made of the newest version before it, so a replayed batch
    finds its version complete, and one whose writer died is merged again from the same start."""
    spark, path = executions.sparkSession, f"{root.rstrip('/')}/v{batch_id + 1:08d}"
    done = _versions(spark, root)
    if batch_id + 1 in done:
        return False
    before = [v for v in done if v <= batch_id]
    new = executions.select("alert_key", F.col("exec_ts").alias("last_executed_at"))
    if before:
        new = new.unionByName(spark.read.parquet(f"{root.rstrip('/')}/v{before[-1]:08d}"))
    new.groupBy("alert_key").agg(F.max("last_executed_at").alias("last_executed_at")).write.mode("overwrite").parquet(path)
    return True


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append decisions or run events (partitioned by date for pruning when asked)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def upsert_cooldowns(executions: DataFrame, root: str) -> str:
    """K3: ``alert_key -> last_executed_at`` keeps the max per key (INSERT ... ON CONFLICT DO UPDATE)."""
    spark = executions.sparkSession
    new = executions.groupBy("alert_key").agg(F.max("exec_ts").alias("last_executed_at"))
    cur = read_latest(spark, root)
    merged = new if cur is None else cur.unionByName(new).groupBy("alert_key").agg(
        F.max("last_executed_at").alias("last_executed_at"))
    return _write_next(merged, root)


def insert_or_ignore_slots(slots: DataFrame, root: str) -> str:
    """K4: record (schedule_name, slot_key) pairs not yet present (INSERT OR IGNORE; first wins)."""
    spark = slots.sparkSession
    new = slots.groupBy("schedule_name", "slot_key").agg(F.min("triggered_at").alias("triggered_at"))
    cur = read_latest(spark, root)
    if cur is not None:
        new = cur.unionByName(new.join(cur.select("schedule_name", "slot_key"), ["schedule_name", "slot_key"],
                                       "left_anti"))
    return _write_next(new, root)


def write_report(parts: DataFrame, path: str, generated_at_col: str = "generated_at") -> None:
    """K6: report rows (json text, markdown text) partitioned by a ``YYYY-MM-DD_HH-MM-SS`` stamp."""
    parts.withColumn("stamp", stamp(generated_at_col)).write.mode("append").partitionBy("stamp").parquet(path)


def latest_view(spark: SparkSession, path: str, key: str, order_col: str) -> DataFrame:
    """K9: the ``*-latest`` link as a view - newest row per key (no symlinks)."""
    df = spark.read.parquet(path)
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("x")).select(key, "x.*")


def store_snapshots(snaps: DataFrame, path: str) -> None:
    """Snapshots partitioned by day (one folder a day, whatever the number of hosts), with the
    ``audit_<stamp>`` file stem as a column."""
    from fleetlens.operators.mac import snapshot_stamp

    named = snaps.withColumn("stem", snapshot_stamp(F.col("timestamp_utc")))
    named.withColumn("day", F.regexp_extract("stem", "^audit_([0-9]{8}|unknown)", 1)).write.mode("append").partitionBy("day").parquet(path)


def read_state(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The operational tables stored under ``root`` (one directory per table)."""
    out = {}
    for name in ("runs", "tasks", "decisions", "cooldowns", "slots"):
        p = os.path.join(root, name)
        fs, hp, _ = _fs(spark, p)
        if fs.exists(hp):
            latest = read_latest(spark, p)
            out[name] = latest if latest is not None else spark.read.parquet(p)
    return out
