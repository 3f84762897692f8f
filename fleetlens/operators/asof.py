"""Keyed as-of lookups that stay exact and skew-safe.

``next_at_or_after`` / ``prev_at_or_before`` find, for every probe row, the first event at or after
(last event at or before) the probe's time among events of the same key. A plain window over the key
would put a hot key (one third of all rows) into a single task, so events and probes are cut into ranges
of about equally many rows:

1. events and probes are unioned, range-partitioned by (key, time) and written once; a running
   ``last(... ignorenulls)`` inside each (key, range) answers every probe whose match lies in its range;
2. probes left unanswered look at the first/last event of each (key, range) (a partial aggregation) and take
   the nearest range that has one. That window holds one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.session import ranged


def _lookup(events: DataFrame, probes: DataFrame, keys: list[str], forward: bool) -> DataFrame:
    """events: keys + ``t`` (long) + ``eid`` (long). probes: keys + ``p`` (long) + ``pid``.

    Returns probes' ``pid`` with ``m_t``, ``m_id`` (null when nothing qualifies).
    Order of events is ``(t, eid)``.
    """
    rows = events.select(*keys, F.col("t").alias("tt"), F.lit(1).alias("kind"), "eid", F.lit(None).cast("long").alias("pid")).unionByName(
        probes.select(*keys, F.col("p").alias("tt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("eid"), F.col("pid").cast("long")))
    # at equal times, a probe's matches lie on the side that it looks to
    rows = rows.withColumn("side", F.col("kind") if forward else 1 - F.col("kind"))
    union = ranged(rows, [*keys, "tt", "side", "eid"], "asof")

    # walking towards a probe, events (kind 1) at its own time come first
    order = ([F.col("tt").desc(), F.col("kind").desc(), F.col("eid").desc()] if forward
             else [F.col("tt").asc(), F.col("kind").desc(), F.col("eid").asc()])
    w = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    event = F.when(F.col("kind") == 1, F.struct(F.col("tt").alias("t"), F.col("eid").alias("eid")))
    local = union.withColumn("hit", F.last(event, ignorenulls=True).over(w)).where(F.col("kind") == 0)
    pick = F.min if forward else F.max
    summary = union.where(F.col("kind") == 1).groupBy(*keys, "_part").agg(pick(F.struct(F.col("tt").alias("t"), "eid")).alias("edge"))
    parts = union.select(*keys, "_part").distinct().join(summary, [*keys, "_part"], "left")
    # beyond a probe's own range: the nearest other range of the key that has an event
    beyond = Window.partitionBy(*keys).orderBy(F.col("_part").desc() if forward else F.col("_part").asc()).rowsBetween(Window.unboundedPreceding, -1)
    near = parts.withColumn("near", F.last("edge", ignorenulls=True).over(beyond)).select(*keys, "_part", "near")
    found = local.join(near, [*keys, "_part"], "left").withColumn("m", F.coalesce("hit", "near"))
    return found.select("pid", F.col("m.t").alias("m_t"), F.col("m.eid").alias("m_id"))


def next_at_or_after(events: DataFrame, probes: DataFrame, keys: list[str]) -> DataFrame:
    return _lookup(events, probes, keys, True)


def prev_at_or_before(events: DataFrame, probes: DataFrame, keys: list[str]) -> DataFrame:
    return _lookup(events, probes, keys, False)
