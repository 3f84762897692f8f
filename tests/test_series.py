"""Labelled samples: identity, matchers, storage by name, monotone buckets, targets without series."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetlens.operators import series as SR
from fleetlens.session import checkpoint_dir
from fleetlens.sources import fixtures as fx

SCHEMA = "ts string, sample_id long, name string, labels map<string,string>, value double"


def samples(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))


def test_series_have_one_form(spark):
    rows = [("2024-01-01 00:00:00", 1, "up", {"b": 'q"\\', "a": "x\ny"}, 1.0), ("2024-01-01 00:00:01", 2, "up", {"a": "x\ny", "b": 'q"\\'}, 1.0), ("2024-01-01 00:00:01", 3, "up", {}, 1.0)]
    got = {r[0] for r in samples(spark, rows).select(SR.series_id()).collect()}
    assert got == {'up{a="x\\ny",b="q\\"\\\\"}', "up{}"}


@pytest.mark.parametrize("matcher, ids", [
    (("job", "=", "a"), {1}), (("job", "!=", "a"), {2, 3}), (("job", "=", ""), {3}), (("job", "=~", "a|b.*"), {1, 2}), (("job", "=~", "b"), set()),
    (("job", "!~", "b"), {1, 2, 3}), (("job", "=~", ".*"), {1, 2, 3}), (("job", "!~", ".+"), {3})])
def test_matchers(spark, matcher, ids):
    rows = [("2024-01-01 00:00:00", 1, "up", {"job": "a"}, 1.0), ("2024-01-01 00:00:00", 2, "up", {"job": "bc\nd"[:2]}, 1.0), ("2024-01-01 00:00:00", 3, "up", {"x": "y"}, 1.0)]
    assert {r.sample_id for r in SR.select_series(samples(spark, rows), "up", [matcher]).collect()} == ids
    with pytest.raises(ValueError):
        SR.matches([("job", "~", "a")])


def test_a_selector_reads_its_name_only(spark):
    path = f"{checkpoint_dir(spark).rstrip('/')}/tests/samples-{uuid.uuid4().hex}"
    SR.store_samples(fx.labelled_samples(spark, SF_SMALL), path)
    one = SR.select_series(SR.read_samples(spark, path), "up", [("job", "=", "nodes")])
    assert "PartitionFilters: [isnotnull(name" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == SR.select_series(fx.labelled_samples(spark, SF_SMALL), "up", [("job", "=", "nodes")]).count() > 0


def test_instants_see_the_lookback_only(spark):
    rows = [("2024-01-01 00:00:00", 1, "up", {"i": "a"}, 1.0), ("2024-01-01 00:04:59", 2, "up", {"i": "a"}, 0.0), ("2024-01-01 00:05:00", 3, "up", {"i": "b"}, 1.0)]
    got = SR.instant_vectors(SR.select_series(samples(spark, rows), "up"), 300, 300).select(F.unix_timestamp("at") % 86400, "series", "value").collect()
    # (at - lookback, at]: the sample at 00:00 is seen at 00:00 only, that of 00:05:00 not at 00:10:00
    assert {tuple(r) for r in got} == {(0, 'up{i="a"}', 1.0), (300, 'up{i="a"}', 0.0), (300, 'up{i="b"}', 1.0)}


@pytest.mark.parametrize("buckets, quantile", [
    ([("0.1", 10), ("0.5", 60), ("1", 90), ("+Inf", 100)], 1.0), ([("0.1", 10), ("0.5", 60), ("1", 96), ("+Inf", 100)], 0.5 + 0.5 * 35 / 36),
    ([("0.1", 10), ("0.5", 4), ("1", 100), ("+Inf", 100)], 0.5 + 0.5 * 85 / 90),  # 0.5 falls below 0.1: counts as 10
    ([("0.1", 100), ("+Inf", 100)], 0.095), ([("0.1", 10), ("1", 100)], None), ([("+Inf", 100)], None), ([("0.1", 0), ("+Inf", 0)], None),
    ([("0", 100), ("1", 100), ("+Inf", 100)], 0.0), ([("10", 100), ("2", 50), ("+Inf", 100), ("odd", 1000)], 2 + 8 * 45 / 50)])
def test_bucket_quantiles(spark, buckets, quantile):
    df = spark.createDataFrame([("w", le, float(n)) for le, n in buckets], "window_start string, le string, rate double")
    got = SR.bucket_quantile(df, 0.95).first()
    assert (got.quantile is None) if quantile is None else math.isclose(got.quantile, quantile)


def test_targets_without_a_series_are_down_but_not_zero(spark):
    rows = [("2024-01-01 00:00:00", 1, "up", {"job": "nodes", "i": "a"}, 0.0), ("2024-01-01 00:00:00", 2, "up", {"job": "nodes", "i": "b"}, 1.0), ("2024-01-01 00:00:00", 3, "up", {"job": "x"}, 0.0)]
    vec = SR.instant_vectors(SR.select_series(samples(spark, rows), "up"), 300, 300)
    req = SR.required_targets(vec, {"nodes": [("job", "=", "nodes")], "x": [("job", "=", "x")], "gone": [("job", "=", "gone")]})
    assert {(r.target, r.value, r.down) for r in req.collect()} == {("nodes", 1.0, False), ("x", 0.0, True), ("gone", None, True)}
    assert tuple(SR.target_summary(req, SR.count_down(vec)).drop("at").first()) == (2, 2, 0)
