"""File readers for what the reference reads from disk.

* key=value / sectioned audit logs: one row per file (``wholetext``), with path and modification time
  from the file metadata; parsing is then the same Column expressions as for any text column.
* host snapshots: JSON objects with a fixed schema (no inference), malformed records kept in
  ``_corrupt_record`` for quarantine instead of failing the job.
* agent logs: one row per line with the file path and a per-file line order.
* backup inventories: file metadata only (the content column of ``binaryFile`` is never selected,
  so it is never read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.session import ensure_session

PROCESS_SCHEMA = T.StructType([
    T.StructField("pid", T.LongType()), T.StructField("rss_kb", T.LongType()),
    T.StructField("mem_percent", T.DoubleType()), T.StructField("command", T.StringType()),
])
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("timestamp_utc", T.StringType()),
    T.StructField("timestamp_unix", T.LongType()),
    T.StructField("memory_free_percent", T.DoubleType()),
    T.StructField("swap_used_mb", T.DoubleType()),
    T.StructField("uptime_days", T.DoubleType()),
    T.StructField("disk_used_percent", T.DoubleType()),
    T.StructField("battery_percent", T.IntegerType()),
    T.StructField("power_source", T.StringType()),
    T.StructField("tm_latest_backup", T.StringType()),
    T.StructField("timemachine_age_seconds", T.LongType()),
    T.StructField("brew_outdated_count", T.IntegerType()),
    T.StructField("agent_launchd_loaded", T.BooleanType()),
    T.StructField("agent_launchd_running", T.BooleanType()),
    T.StructField("top_processes", T.ArrayType(PROCESS_SCHEMA)),
    T.StructField("_corrupt_record", T.StringType()),
])


def read_text_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """S3 / S4 input: one row per file - ``log_path``, ``mtime`` (file modification time), ``text``."""
    ensure_session(spark)
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("log_path"),
                     F.col("_metadata.file_modification_time").alias("mtime"), F.col("value").alias("text"))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot JSON documents (one object per file, or JSON lines) with the fixed schema; a record that
    is not an object lands in ``_corrupt_record``."""
    ensure_session(spark)
    return (spark.read.schema(SNAPSHOT_SCHEMA).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def read_agent_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """S13 input: agent log lines with file path and line order (``line_no`` ascending within a file)."""
    ensure_session(spark)
    df = spark.read.text(path)
    return df.select(F.col("_metadata.file_path").alias("log_path"), F.monotonically_increasing_id().alias("line_no"),
                     F.col("value").alias("line"))


def read_file_inventory(spark: SparkSession, path: str, glob: str = "vps-backup-*") -> DataFrame:
    """S16 / S11 input: names and modification times of files (content is not read)."""
    ensure_session(spark)
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path",
                     F.unix_timestamp("modificationTime").alias("mtime_unix"), "length")
