"""Order-insensitive comparison of a Spark result and a DuckDB result (column names sorted)."""

from __future__ import annotations

import math

import pandas as pd


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, dict, str)):
        try:
            v = v.item()
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return float(f"{v:.12g}")
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tzinfo else v)
    if isinstance(v, (int, str, bool)):
        return v
    return str(v)


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        vals = []
        for x in rec:
            if x is pd.NaT or (not isinstance(x, (list, dict, str, bytes)) and pd.isna(x) is True):
                vals.append(None)
            else:
                vals.append(_norm(x))
        out.append(tuple(vals))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def assert_same(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame):
    c1, r1 = rows(spark_pdf)
    c2, r2 = rows(duck_pdf)
    assert c1 == c2, (c1, c2)
    assert len(r1) == len(r2), (len(r1), len(r2))
    diff = [(a, b) for a, b in zip(r1, r2) if a != b][:3]
    assert not diff, diff
