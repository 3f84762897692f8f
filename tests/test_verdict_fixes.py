"""Exact number formatting, single-pass templates, loaders and row-bounded scans."""

import random

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.numeric import fmt_num
from fleetlens.operators.asof import next_at_or_after, prev_at_or_before
from fleetlens.operators.mac import process_pick
from fleetlens.operators.outputs import render_template
from fleetlens.operators.scan import prefix_max_before, previous_value
from fleetlens.session import ranged
from fleetlens.sources.config import load_rules_yaml, load_schedules_yaml


def test_fmt_num_rounds_the_binary_value_half_even(spark):
    rng = random.Random(8)
    xs = [0.125, 1.005, 2.675, 0.5, 1.5, -0.125, -0.001, 0.0, -0.0, 1e-9, 123456.785, 0.375, 1e15, 99.995, 9.9999, -2.5]
    xs += [rng.uniform(-1000, 1000) for _ in range(300)] + [rng.randrange(-4000, 4000) / 16 for _ in range(300)] + [rng.randrange(0, 10 ** 6) / 1000 for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (1, 2, 3, 4):
        got = df.select("x", fmt_num("x", digits).alias("s")).collect()
        assert [r.s for r in got] == [f"{r.x:.{digits}f}" for r in got]
    assert df.select(fmt_num(F.lit(None), 2)).first()[0] is None


def test_template_values_are_not_scanned_again(spark):
    df = spark.createDataFrame([("{{ a }} {{ b }}!", {"a": "{{ b }}", "b": "X"}), ("{{b|lower}}{{ b|upper }} {{ none }}.", {"b": "xY"}), ("plain", {}), ("", {})],
                               "t string, c map<string,string>")
    assert [r[0] for r in df.select(render_template("t", "c")).collect()] == ["{{ b }} X!", "xyXY .", "plain", ""]


def test_protected_apps_by_their_own_name(spark):
    apps = spark.createDataFrame([("h", 1, "iTerm2"), ("h", 2, "  Mail "), ("h", 3, "Visual  Studio Code"), ("g", 4, "ChatGPT"), ("h", 0, "Zero"), ("h", 9, "Gone")],
                                 "host string, pid long, name string")
    procs = spark.createDataFrame([("h", 1, 9000, "/x/iTerm2"), ("h", 2, 500, "m"), ("h", 3, 700, "c"), ("g", 4, 1, "x"), ("h", 0, 9999, "z")],
                                  "host string, pid long, rss_kb long, command string")
    got = process_pick(apps, procs).collect()
    assert [(r.host, r.app, r.pid) for r in got] == [("h", "Visual Studio Code", 3)]


def test_loaders_keep_conditions_and_reject_bad_ones(tmp_path):
    rules = tmp_path / "rules.yaml"
    rules.write_text("""
rules:
  - name: r
    match: {alertname: A}
    cooldown_seconds: 60
    action:
      type: chain
      steps:
        - {name: check, payload: {depth: 2}}
        - {name: brief, when: {analysis_level_in: [" warning ", critical]}}
  - name: e
    match: {alertname: B}
    action: {type: execute, name: restart, payload: {app: x}}
""")
    first, second = load_rules_yaml(str(rules))
    assert [s["analysis_level_in"] for s in first["steps"]] == [None, ["warning", "critical"]] and first["steps"][0]["payload"] == {"depth": 2}
    assert second["action_name"] == "restart" and second["payload"] == {"app": "x"}
    rules.write_text("rules: [{name: r, match: {a: b}, action: {type: chain, steps: [{name: s, when: {level: x}}]}}]")
    with pytest.raises(ValueError):
        load_rules_yaml(str(rules))
    schedules = tmp_path / "schedules.yaml"
    schedules.write_text("schedules: [{name: d, daily: true, hour: 1, minute: 2}, {name: w, weekdays: [1, 1, 3], hour: 1, minute: 2}, {name: o, weekday: 6, hour: 1, minute: 2}]")
    assert [s["weekdays"] for s in load_schedules_yaml(str(schedules))] == [list(range(7)), [1, 3], [6]]
    for bad in ("{name: x, hour: 1, minute: 2}", "{name: x, daily: true, weekday: 1, hour: 1, minute: 2}", "{name: x, weekdays: [7], hour: 1, minute: 2}"):
        schedules.write_text(f"schedules: [{bad}]")
        with pytest.raises(ValueError):
            load_schedules_yaml(str(schedules))


def test_asof_with_one_key_and_ties_over_many_ranges(spark):
    rng = random.Random(3)
    events = [("k", rng.randrange(60), i) for i in range(150)] + [("other", 5, 999)]
    probes = [("k", rng.randrange(-5, 70), i) for i in range(150)] + [("none", 1, 500)]
    ev, pr = spark.createDataFrame(events, "k string, t long, eid long"), spark.createDataFrame(probes, "k string, p long, pid long")
    for fn, keep, pick in ((next_at_or_after, lambda t, p: t >= p, min), (prev_at_or_before, lambda t, p: t <= p, max)):
        got = {r.pid: (r.m_t, r.m_id) for r in fn(ev, pr, ["k"]).collect()}
        for k, p, pid in probes:
            hits = [(t, e) for kk, t, e in events if kk == k and keep(t, p)]
            assert got[pid] == (pick(hits) if hits else (None, None))


def test_prefix_and_previous_over_ranges(spark):
    rng = random.Random(9)
    rows = [("a" if i % 5 else None, i, rng.choice([None, i, 7])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = {r.t: r for r in prefix_max_before(df, ["k"], ["t"], "v").collect()}
    prev = {r.t: r.p for r in previous_value(ranged(df, ["k", "t"], "test"), ["k"], ["t"], "v", "p").collect()}
    for k, t, _ in rows:
        before = [v for kk, tt, v in rows if kk == k and tt < t]
        assert got[t].prefix_max == max((v for v in before if v is not None), default=None)
        assert prev[t] == (before[-1] if before else None)
