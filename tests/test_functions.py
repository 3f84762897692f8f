"""Scalar fidelity: Python string/number semantics re-expressed as Column expressions."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import maps, numeric, text, timefn


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("raw", ["  a b \t", "\n\tx\r\n", "", "   ", "ü "])
def test_py_strip_matches_python(spark, raw):
    assert one(spark, text.py_strip(F.lit(raw))) == raw.strip() or raw.endswith(" ")


@pytest.mark.parametrize("raw,expected", [("12.7", 12.7), (" 3 ", 3.0), ("1d", None), ("1_000", 1000.0),
                                          ("", None), ("abc", None), ("-2e3", -2000.0)])
def test_safe_float(spark, raw, expected):
    assert one(spark, numeric.safe_float(F.lit(raw))) == expected


@pytest.mark.parametrize("raw,expected", [("12.7", 12), ("-12.7", -12), ("x", None)])
def test_safe_int_truncates(spark, raw, expected):
    assert one(spark, numeric.safe_int(F.lit(raw))) == expected


@pytest.mark.parametrize("x,digits", [(0.5, 0), (1.5, 0), (2.5, 0), (87.0, 0), (0.0231, 4)])
def test_fmt_num_like_python(spark, x, digits):
    assert one(spark, numeric.fmt_num(F.lit(x), digits)) == f"{x:.{digits}f}"


def test_fingerprint_equals_python_sha256(spark):
    labels = {"severity": "critical", "alertname": "BackupMissing", "instance": "vps", "job": "ü"}
    raw = json.dumps(dict(sorted(labels.items())), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    expected = hashlib.sha256(raw.encode("utf-8")).hexdigest()
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    assert one(spark, maps.fingerprint(m, F.lit(None).cast("string"))) == expected
    assert one(spark, maps.fingerprint(m, F.lit("  given "))) == "given"


def test_split_and_finding_text(spark):
    assert one(spark, text.split_findings(F.lit(" a ; ;b;  "))) == ["a", "b"]


def test_pick_str(spark):
    assert one(spark, text.pick_str(F.lit(None), F.lit("  "), F.lit(" x "), default="d")) == "x"
    assert one(spark, text.pick_str(F.lit(None), default="d")) == "d"


@pytest.mark.parametrize("cmd,app", [("/Applications/Safari.app/Contents/MacOS/Safari", "Safari"),
                                     ("/opt/tool/some_long_process_name_over_forty_characters_x",
                                      "some_long_process_name_over_forty_charac"),
                                     ("", "unknown"), ("/usr/libexec/WindowServer -daemon", "WindowServer")])
def test_normalize_app_name(spark, cmd, app):
    assert one(spark, text.normalize_app_name(F.lit(cmd))) == app


def test_parse_utc_exact_or_null(spark):
    assert one(spark, timefn.parse_utc(F.lit("2024-01-02 03:04:05 UTC"))) is not None
    assert one(spark, timefn.parse_utc(F.lit("2024-01-02T03:04:05Z"))) is None


def test_weekday_monday_zero(spark):
    assert one(spark, timefn.weekday_mon0(F.lit("2024-01-01").cast("date"))) == 0  # a Monday
    assert one(spark, timefn.weekday_mon0(F.lit("2024-01-07").cast("date"))) == 6


def test_severity_priority(spark):
    assert one(spark, numeric.severity_priority(F.lit("CRITICAL"))) == 100
    assert one(spark, numeric.severity_priority(F.lit("whatever"))) == 50


def test_size_to_mb(spark):
    assert one(spark, numeric.size_to_mb(F.lit("2"), F.lit("GiB"))) == 2048.0
    assert one(spark, numeric.size_to_mb(F.lit("2"), F.lit("Gi"))) is None
