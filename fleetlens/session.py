"""Session helpers.

``ensure_session`` sets the few runtime settings every operator relies on
(UTC session time, last-wins map keys) and makes sure a *shared* checkpoint
directory is known. On a cluster ``spark.checkpoint.dir`` is provided by the
cluster and is used as is; only when it is unset (tests, local runs) a
scratch directory is created.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # map_concat / map_from_entries: later keys overlay earlier ones, like dict.update
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: intermediates need a folder that all executors share")
        # one JVM (tests, local runs): any folder is shared
        configured = tempfile.mkdtemp(prefix="fleetlens-ckpt-", dir=os.environ.get("FLEETLENS_SCRATCH", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ensure_session(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def small_methods(spark: SparkSession) -> None:
    """Let a stage whose generated method exceeds 8000 bytes of bytecode run as one projection per operator. HotSpot
    never compiles such a method, so every row of it would be interpreted; a projection is split into small ones. A limit that
    the session has been given stays."""
    if spark.conf.get(_METHOD_LIMIT[0], "65535") == "65535":
        spark.conf.set(*_METHOD_LIMIT)


def get_spark(master: str | None = None, app: str = "fleetlens", shuffle_partitions: int | None = None) -> SparkSession:
    """Build a session with the settings the library is tuned for.

    AQE re-plans joins and coalesces shuffle partitions at run time; skew-join
    splitting is on. The UI is off (no server is started).
    """
    master = master or os.environ.get("FLEETLENS_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.driver.memory", os.environ.get("FLEETLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    checkpoint_dir(spark)
    return spark


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared checkpoint directory and read it back.

    Cuts lineage like ``checkpoint()`` but in one job (a reliable RDD checkpoint recomputes its input
    for the write) and keeps columnar pruning for the readers. The folder lives on the cluster's
    shared checkpoint storage, so a lost executor never loses it.
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def discard(*frames) -> None:
    """Delete materialized tables that nothing reads any more (best used as soon as a newer one replaces them)."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranged(df, cols, name: str):
    """``df`` range-partitioned and sorted by ``cols``, written once, with ``_part``: the number of the row's
    range, ascending in ``cols``. Ranges hold about equally many rows whatever the keys are: rows / ranges, with
    ``spark.sql.shuffle.partitions`` ranges (to be set so that a range fits a task, as for any shuffle of the session). A window
    over (key, _part) is bounded by that, and per-(key, _part) summaries by the number of ranges."""
    from pyspark.sql import functions as F

    return materialize(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_part", F.spark_partition_id()), name)


_EXPR_CACHE: dict = {}


def cached_expr(key, build):
    """Build a (large, name-based) Column expression once per SparkContext and reuse it.

    The audit checks are thousands of expression nodes; constructing them goes through one JVM call
    per node. They depend only on column names, so a query run again in the same session reuses them.
    """
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    held = _EXPR_CACHE.get(key)
    if held is None or held[0] is not sc:
        held = _EXPR_CACHE[key] = (sc, build())
    return held[1]
