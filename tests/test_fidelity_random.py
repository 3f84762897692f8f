"""Randomised fidelity: Column expressions vs Python's own semantics on many generated strings
(one Spark job per property, not one per example)."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions import numeric, text

WS = [" ", "\t", "\n", "\r", "\x0b", "\x0c", " ", " ", "　"]
PIECES = ["1", "2.5", "-3", "1e3", "_", "abc", ";", " ; ", "x", ".5", "1_000", "nan", "inf", "1d", "", "0x1"]


def _strings(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        s = "".join(rnd.choice(PIECES + WS) for _ in range(rnd.randint(0, 6)))
        out.append(s)
    return out


def _py_float(s):
    try:
        return float(s.strip()) if s.strip() else None
    except ValueError:
        return None


def test_strip_float_int_split_match_python(spark):
    values = _strings(600, 7)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", text.py_strip("v").alias("strip"), numeric.safe_float("v").alias("f"),
                     numeric.safe_int("v").alias("n"), text.split_findings("v").alias("parts")).collect()
    for r in rows:
        v = values[r["i"]]
        assert r["strip"] == v.strip(), repr(v)
        pf = _py_float(v)
        if pf is None or pf != pf:  # nan compares unequal
            assert r["f"] is None or r["f"] != r["f"], repr(v)
        else:
            assert r["f"] == pf, repr(v)
        # safe_int is a 64-bit bigint: beyond +-9.2e18 it is null (Python's int has no bound)
        pi = int(pf) if pf is not None and pf == pf and abs(pf) < 9.2e18 else None
        assert r["n"] == pi, repr(v)
        assert r["parts"] == [p.strip() for p in v.split(";") if p.strip()], repr(v)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab=; \t") + [" "]), max_size=12), min_size=1, max_size=40))
def test_kv_parse_matches_python(spark, lines):
    from fleetlens.operators.audits import kv_facts

    body = "\n".join(lines)
    expected = {}
    for raw in body.splitlines():
        line = raw.strip()
        if not line or line.startswith("===") or "=" not in line:
            continue
        k, v = line.split("=", 1)
        expected[k.strip()] = v.strip()
    logs = spark.createDataFrame([(1, "h", body)], "log_id long, host string, text string")
    got = {r["key"]: r["value"] for r in kv_facts(logs).collect()}
    assert got == expected
