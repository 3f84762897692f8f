"""Skew-safe keyed prefix (running) aggregates.

A window ``partitionBy(key).orderBy(t)`` runs a whole key in one task; with one key holding a third
of the rows that task becomes the job. The prefix is split in two levels instead:

1. rows are range-partitioned by (key, order) and written once; a running window inside each (key, range)
   gives the local prefix;
2. per (key, range) totals (a partial aggregation) give, by a window over ranges only, the carry-in from
   all earlier ranges;
3. prefix = combine(carry-in, local prefix).

Used for "max finished time of earlier runs" (J7), counter deltas (A19) and cooldown islands (W9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.session import ranged


def _before(df: DataFrame, keys: list[str], order_cols: list[str], local_agg, total_agg, merge, out: str) -> DataFrame:
    """``df`` is ranged by keys and order. Adds ``out``: ``merge(carry, local)`` over the rows strictly before."""
    w_local = Window.partitionBy(*keys, "_part").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", local_agg.over(w_local))
    totals = df.groupBy(*keys, "_part").agg(total_agg.alias("_total"))
    w_parts = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("_carry", merge[1]("_total").over(w_parts)).drop("_total")
    joined = local.join(carry.select(*[F.col(k).alias(f"_k_{k}") for k in [*keys, "_part"]], "_carry"),
                        [local[k].eqNullSafe(F.col(f"_k_{k}")) for k in [*keys, "_part"]], "left")
    return joined.withColumn(out, merge[0](F.col("_carry"), F.col("_local"))).drop("_carry", "_local", *[f"_k_{k}" for k in [*keys, "_part"]])


def prefix_max_before(df: DataFrame, keys: list[str], order_cols: list[str], value: str, out: str = "prefix_max") -> DataFrame:
    """Adds ``out`` = max(``value``) over rows of the same key strictly before this row in ``order_cols`` order."""
    rows = ranged(df, [*keys, *order_cols], "prefix")
    return _before(rows, keys, order_cols, F.max(value), F.max(value), (lambda c, x: F.greatest(c, x), F.max), out).drop("_part")


def previous_value(rows: DataFrame, keys: list[str], order_cols: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: ``value`` of the row before (null for the first of a key); ``rows`` from :func:`ranged`.

    ``value`` travels in a struct, so that a null value of the row before stays null.
    """
    box = F.struct(F.col(value).alias("v"))
    last = F.max_by(box, F.struct(*order_cols))
    return _before(rows, keys, order_cols, F.last(box), last, (lambda c, x: F.coalesce(x, c)["v"], lambda t: F.last(t, ignorenulls=True)), out)
