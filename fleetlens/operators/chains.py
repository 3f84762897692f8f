"""Chain replay over recorded step attempts.

The reference runs a chain step by step: a step whose ``when`` levels do not contain the current
``analysis_level`` is skipped; a notify step is queued, not run; any other step is attempted up to
``retries + 1`` times until an attempt ends ``success`` or ``skipped``; a final status outside those
two stops the chain with that status; a step without any attempt fails the chain. Results carried
forward: first / last run id, every run id, queued steps, ``analysis_level`` taken from the final
attempt's result trailer.

As data: attempts ``(chain_id, step_index, attempt_order, status, run_id, analysis_level)``.

* ``attempt_collapse`` (U3): per (chain, step) the attempts in order, cut at ``retries + 1`` and at the
  first continuing status. ``row_number() <= max_attempts`` (a literal bound) lets Spark apply a
  partial group limit before the shuffle, so a step with millions of attempts is cut map-side; the
  per-step list that remains is at most ``max_attempts`` long.
* ``chain_outcome`` (U2/W10): per chain an ``aggregate`` over the configured step list (a handful of
  entries) with the collapsed step results - bounded per chain by the chain's length.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.text import py_strip
from pyspark.sql import types as T

CONTINUE_STATUSES = ["success", "skipped"]
QUEUED_ACTIONS = ["notify_tg"]

TEMPLATE_SCHEMA = T.StructType([
    T.StructField("template", T.StringType()),
    T.StructField("steps", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("retries", T.IntegerType()),
        T.StructField("analysis_level_in", T.ArrayType(T.StringType())),
    ]))),
])


def templates_table(spark, templates: dict[str, list[dict[str, Any]]]) -> DataFrame:
    rows = [(name, [(s["name"], int(s.get("retries", 0)), s.get("analysis_level_in")) for s in steps])
            for name, steps in templates.items()]
    return spark.createDataFrame(rows, TEMPLATE_SCHEMA)


def step_when(levels, current_level) -> F.Column:
    """no condition -> true; else the stripped, lower-cased level is in the lower-cased list."""
    cur = F.lower(py_strip(F.coalesce(current_level, F.lit(""))))
    return levels.isNull() | F.exists(levels, lambda x: F.lower(py_strip(x)) == cur)


def chain_continue(status) -> F.Column:
    """F10."""
    return status.isin(*CONTINUE_STATUSES)


def attempt_collapse(attempts: DataFrame, chains: DataFrame, templates: DataFrame, max_attempts: int) -> DataFrame:
    """One row per (chain, step) with final status, attempts used and run ids in order.

    ``chains`` maps chain_id -> template; ``max_attempts`` bounds retries + 1 over all templates.
    """
    cfg = templates.select("template", F.posexplode("steps").alias("pos", "s")).select(
        "template", (F.col("pos") + 1).alias("step_index"), F.col("s.retries").alias("retries"))
    w = Window.partitionBy("chain_id", "step_index").orderBy("attempt_order")
    a = (attempts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_attempts)
         .join(chains, "chain_id").join(F.broadcast(cfg), ["template", "step_index"])
         .where(F.col("rn") <= F.col("retries") + 1))
    g = a.groupBy("chain_id", "step_index").agg(
        F.array_sort(F.collect_list(F.struct("rn", "status", "run_id", "analysis_level"))).alias("xs"))
    first_ok = F.try_element_at(F.filter("xs", lambda x: chain_continue(x["status"])), F.lit(1))["rn"]
    kept = F.filter("xs", lambda x: x["rn"] <= F.coalesce(first_ok, F.lit(max_attempts)))
    last = F.try_element_at(kept, F.lit(-1))
    runs = F.filter(F.transform(kept, lambda x: x["run_id"]), lambda r: r.isNotNull())
    return g.select(
        "chain_id", "step_index", F.size(kept).alias("attempts_used"), last["status"].alias("final_status"),
        runs.alias("run_ids"), last["analysis_level"].alias("analysis_level"))


_STATE = ("struct<status:string,stopped:boolean,first_run_id:bigint,last_run_id:bigint,run_ids:array<bigint>,"
          "queued:int,recorded:int,last_step_status:string,analysis_level:string,summary:array<string>>")


def chain_outcome(collapsed: DataFrame, chains: DataFrame, templates: DataFrame) -> DataFrame:
    """Fold each chain's configured steps over its collapsed step results."""
    per_chain = collapsed.groupBy("chain_id").agg(F.collect_list(F.struct(
        "step_index", "final_status", "run_ids", "analysis_level")).alias("results"))
    c = chains.join(per_chain, "chain_id", "left").join(F.broadcast(templates), "template")
    init = F.struct(
        F.lit("success").alias("status"), F.lit(False).alias("stopped"),
        F.lit(None).cast("bigint").alias("first_run_id"), F.lit(None).cast("bigint").alias("last_run_id"),
        F.array().cast("array<bigint>").alias("run_ids"), F.lit(0).alias("queued"), F.lit(0).alias("recorded"),
        F.lit(None).cast("string").alias("last_step_status"), F.lit(None).cast("string").alias("analysis_level"),
        F.array().cast("array<string>").alias("summary"),
    ).cast(_STATE)
    steps = F.transform("steps", lambda s, i: F.struct(s.alias("cfg"), (i + 1).alias("idx")))

    def step(acc, st):
        cfg, idx = st["cfg"], st["idx"]
        res = F.try_element_at(F.filter(F.coalesce(F.col("results"), F.array().cast(
            "array<struct<step_index:int,final_status:string,run_ids:array<bigint>,analysis_level:string>>")),
            lambda r: r["step_index"] == idx), F.lit(1))
        skip = ~step_when(cfg["analysis_level_in"], acc["analysis_level"])
        queued = ~skip & cfg["name"].isin(*QUEUED_ACTIONS)
        ran = ~skip & ~queued
        final = F.coalesce(res["final_status"], F.lit("failed"))
        new_runs = F.when(ran, F.coalesce(res["run_ids"], F.array().cast("array<bigint>"))).otherwise(
            F.array().cast("array<bigint>"))
        all_runs = F.concat(acc["run_ids"], new_runs)
        step_status = F.when(skip, F.lit("skipped")).when(queued, F.lit("queued")).otherwise(final)
        stop = ran & ~chain_continue(final)
        executed = F.struct(
            F.when(stop, final).otherwise(acc["status"]).alias("status"),
            stop.alias("stopped"),
            F.coalesce(acc["first_run_id"], F.try_element_at(new_runs, F.lit(1))).alias("first_run_id"),
            F.when(F.size(all_runs) > 0, F.try_element_at(all_runs, F.lit(-1))).alias("last_run_id"),
            all_runs.alias("run_ids"),
            (acc["queued"] + F.when(queued, 1).otherwise(0)).alias("queued"),
            (acc["recorded"] + 1).alias("recorded"),
            step_status.alias("last_step_status"),
            F.when(ran & res["analysis_level"].isNotNull(), res["analysis_level"])
            .otherwise(acc["analysis_level"]).alias("analysis_level"),
            F.concat(acc["summary"], F.array(F.concat(idx.cast("string"), F.lit(":"), step_status))).alias("summary"),
        ).cast(_STATE)
        return F.when(acc["stopped"], acc).otherwise(executed)

    out = c.select("chain_id", "template", F.aggregate(steps, init, step).alias("o"))
    o = F.col("o")
    return out.select(
        "chain_id", "template", o["status"].alias("status"), o["first_run_id"].alias("first_run_id"),
        o["last_run_id"].alias("last_run_id"), F.size(o["run_ids"]).alias("run_count"),
        o["queued"].alias("queued"), o["recorded"].alias("steps_recorded"),
        o["last_step_status"].alias("last_step_status"), o["analysis_level"].alias("analysis_level"),
        F.array_join(o["summary"], ",").alias("summary"))


# FIXED VALUES - exit code normalisation of action results.
BACKUP_EXIT_STATUS = {10: "blocked", 11: "skipped"}


def normalize_result(action, exit_code) -> F.Column:
    """U4: exit 0 -> success; run_backup exit 10 -> blocked, 11 -> skipped; other -> failed."""
    a, e = F.col(action) if isinstance(action, str) else action, F.col(exit_code) if isinstance(exit_code, str) \
        else exit_code
    expr = F.when(e == 0, F.lit("success"))
    for code, status in BACKUP_EXIT_STATUS.items():
        expr = expr.when((a == "run_backup") & (e == code), F.lit(status))
    return expr.otherwise(F.lit("failed"))
