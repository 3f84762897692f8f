"""Audits share their work out: rows of one row group go to many tasks, and a text is parsed once."""

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import audits as AU
from fleetlens.plans.catalog import QUERIES
from fleetlens.sources import fixtures as fx


@pytest.fixture(scope="module")
def one_group(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("one_group"))
    spark.range(200).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{root}/customer.parquet")
    spark.range(200).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).coalesce(1).write.parquet(f"{root}/part.parquet")
    return root


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("read", [fx.kv_logs, fx.admin_logs, fx.snapshots])
def test_rows_of_one_row_group_go_to_many_tasks(spark, one_group, read):
    dealt = read(spark, one_group).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in dealt) == 200
    assert len(dealt) > 1 and max(r["count"] for r in dealt) <= 200 // len(dealt) + 8


def test_facts_are_parsed_before_rows_multiply(spark, one_group):
    lines = plan(QUERIES["component_health"](spark, one_group)).splitlines()
    parsed = [i for i, line in enumerate(lines) if "map_from_entries" in line]
    assert len(parsed) == 1 and not any("Generate" in line for line in lines[parsed[0] + 1:])


def test_marker_and_findings_are_computed_once(spark, one_group):
    assert plan(QUERIES["section_marker"](spark, one_group)).count("split(") == 1
    assert plan(QUERIES["mac_gauges"](spark, one_group)).count("disk_high") <= 2


def test_component_health_of_odd_logs(spark):
    text = "container_loki_exists=yes\ncontainer_loki_state=running\nprobe_loki_ready= UP \ncontainer_grafana_exists=no"
    logs = spark.createDataFrame([(1, "h", text), (1, "h", text), (None, "h", None)], "log_id long, host string, text string")
    got = sorted((r.log_id or 0, r.component, r.healthy) for r in AU.component_health(logs).collect())
    want = [(i, n, int(i == 1 and n == "loki")) for i in (0, 1, 1) for n, _ in AU.STACK_COMPONENTS]
    assert got == sorted(want)


def test_marker_lines(spark):
    from fleetlens.operators import admin as AD

    outs = ["LOG_PATH: /a \r\n  __AUDIT_BODY_BEGIN__ \nx\n\ny\n", "LOG_PATH:/b\nx __AUDIT_BODY_BEGIN__", "__AUDIT_BODY_BEGIN__", "x\n__AUDIT_BODY_BEGIN__\nLOG_PATH:/late", None]
    rows = spark.createDataFrame([(i, o) for i, o in enumerate(outs)], "log_id int, output string")
    got = {r.log_id: (r.log_path, r.body) for r in AD.strip_body_marker(rows).collect()}
    assert got == {0: ("/a", "x\n\ny"), 1: ("/b", ""), 2: (None, ""), 3: (None, "LOG_PATH:/late"), 4: (None, "")}


def test_gauge_rows_are_built_once_and_compiled(spark, one_group):
    for query, metric in (("vps_gauges", "vps_host_audit_status"), ("stack_gauges", "monitoring_stack_audit_status"),
                          ("admin_gauges", "admin_host_audit_last_run_unixtime")):
        lines = [line for line in plan(QUERIES[query](spark, one_group)).splitlines() if metric in line]
        assert len(lines) == 1 and "Generate" not in lines[0] and "Filter" not in lines[0], query


def test_admin_facts_are_compiled_and_sections_not_interpreted(spark, one_group):
    lines = [line for line in plan(QUERIES["admin_findings"](spark, one_group)).splitlines() if "SMB SERVICES" in line and "regexp_extract" in line]
    assert lines and not any("Generate" in line for line in lines)


def test_checks_leave_methods_that_hotspot_compiles(spark, one_group):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit, "65535")
    try:
        spark.conf.unset(limit)
        QUERIES["vps_findings"](spark, one_group)
        assert int(spark.conf.get(limit)) == 8000
        spark.conf.set(limit, "4000")
        QUERIES["stack_findings"](spark, one_group)
        assert spark.conf.get(limit) == "4000"
    finally:
        spark.conf.set(limit, before)


def test_facts_of_odd_lines(spark):
    def facts(text):
        out = {}
        for line in (text or "").splitlines():
            line = line.strip()
            if line and not line.startswith("===") and "=" in line:
                key, value = line.split("=", 1)
                out[key.strip()] = value.strip()
        return out

    texts = ["a=1\r\nb = 2 \r\x0bc=\x1d=3", " === x=1\n===\n= ==y\n==z\n\u3000===q=1", "=\n=v\nk=", "\u2003k\u2003=\u2003v\u2003\x85k=w\u2028é=é\n\tt=\tu\t",
             "a===b\na = === b\nno line\n\n", "x=\x00\ny=~\nz=\x7f\n\x1f p=q\x1f", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").select("id", AU.kv_facts_map("text").alias("m"))
    assert {r.id: r.m for r in rows.collect()} == {i: facts(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("query", ["kv_facts", "analysis_trailer", "stack_levels"])
def test_plain_texts_are_parsed_without_patterns(spark, one_group, query):
    """Printable ASCII with line feeds is split at the line feed and stripped of spaces; text and facts are built once."""
    text = plan(QUERIES[query](spark, one_group))
    assert text.count("\n, -1)") == 1 and text.count("noise line") == 1 and text.count("map_from_entries") == 1


def test_facts_of_plain_and_other_texts(spark):
    """One odd character at a time, at the edges of lines, keys and values, and texts with spaces only."""
    from fleetlens.functions.text import PY_WHITESPACE

    def facts(text):
        out = {}
        for line in text.splitlines():
            line = line.strip()
            if line and not line.startswith("===") and "=" in line:
                key, value = line.split("=", 1)
                out[key.strip()] = value.strip()
        return out

    shape = "{0}a{0}={0}1{0}\n{0}==={0}b=2\nc{0}d=3{0}4\na = 5\n{0}\n{0}=6{0}=7\n e= \n  === f=8\n=\nno pair{0}\n===\ng====9\n a=10"
    texts = [shape.format(c) for c in ["", " ", "  ", "\n", "\x00", "\x08", "\x7f", "\xe9", "\u200b", "~", "=", "=="] + list(PY_WHITESPACE)]
    texts += ["\n", " ", " = ", "= =", "a=1", "\na=1\n", " ===", "===x=1", " a b = c d "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").select("id", AU.kv_facts_map("text").alias("m"))
    assert {r.id: r.m for r in rows.collect()} == {i: facts(t) for i, t in enumerate(texts)}
