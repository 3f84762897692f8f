"""Math / conversion scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.text import py_strip

# Python float() accepts these shapes (after strip); Spark's cast also accepts 'd'/'f' suffixes,
# Python accepts '_' separators - so the text is checked first.
_FLOAT_RE = r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _strip(c: Column) -> Column:
    return py_strip(c)


def safe_float(c) -> Column:
    """Python ``float(str(v).strip())`` or null (empty / bad text)."""
    t = F.lower(_strip(_c(c).cast("string")))
    ok = t.rlike(_FLOAT_RE)
    return F.when(ok, F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def safe_int(c) -> Column:
    """``int(float(v))`` - truncation toward zero; null when not a finite number or outside the
    64-bit range (Python's int is unbounded; the values it reads are counts)."""
    f = safe_float(c)
    return F.when(~F.isnan(f) & (F.abs(f) < F.lit(9.2e18)), f.cast("long"))


def safe_int_strict(c, default=None) -> Column:
    """P15 (``default`` variant): Python ``int(text)`` - integers only, else ``default``."""
    t = _strip(_c(c).cast("string"))
    ok = t.rlike(r"^[+-]?\d+(_\d+)*$")
    v = F.when(ok, F.replace(t, F.lit("_"), F.lit("")).try_cast("long"))
    return v if default is None else F.coalesce(v, F.lit(default))


def extract_first_int(text, pattern: str) -> Column:
    """First regex group as integer (IGNORECASE + MULTILINE); null if no match."""
    g = F.regexp_extract(F.coalesce(_c(text), F.lit("")), "(?im)" + pattern, 1)
    return F.nullif(g, F.lit("")).try_cast("long")


def extract_nonneg_int(text, pattern: str) -> Column:
    """Like ``extract_first_int`` but negative -> null."""
    v = extract_first_int(text, pattern)
    return F.when(v >= 0, v)


# FIXED VALUES - size unit -> MiB factor.
SIZE_UNIT_TO_MB = {
    "kib": 1.0 / 1024.0,
    "kb": 1.0 / 1000.0,
    "mib": 1.0,
    "mb": 1.0,
    "gib": 1024.0,
    "gb": 1000.0,
    "tib": 1024.0 * 1024.0,
    "tb": 1000.0 * 1000.0,
}


def size_to_mb(number, unit) -> Column:
    """Number x unit factor; unknown unit -> null."""
    m = F.create_map(*[x for k, v in SIZE_UNIT_TO_MB.items() for x in (F.lit(k), F.lit(v))])
    factor = F.try_element_at(m, F.lower(_strip(_c(unit))))
    return safe_float(number) * factor


def max_of_two_counts(a, b) -> Column:
    """Max of two optional counts, missing -> 0."""
    return F.greatest(F.coalesce(_c(a), F.lit(0)), F.coalesce(_c(b), F.lit(0)))


# FIXED VALUES - level -> code used by gauges.
LEVEL_CODES = {"ok": 0, "warning": 1, "critical": 2}


def level_code(level, default: int = 3) -> Column:
    """P20: ok 0, warning 1, critical 2, else ``default`` (3; the stack gauge uses 0)."""
    m = F.create_map(*[x for k, v in LEVEL_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, _c(level)), F.lit(default))


def bool_int(c) -> Column:
    """P20: True -> 1, False / null -> 0."""
    return F.when(_c(c) == F.lit(True), F.lit(1)).otherwise(F.lit(0))


def num_or_nan(c) -> Column:
    """P20: missing -> NaN (rendered only at the exposition sink)."""
    return F.coalesce(_c(c).cast("double"), F.lit(float("nan")))


def clamp_diff(a, b) -> Column:
    """``max(a - b, 0)``."""
    return F.greatest(_c(a) - _c(b), F.lit(0))


# FIXED VALUES - severity -> task priority, default 50.
SEVERITY_PRIORITY = {"critical": 100, "warning": 70, "info": 50, "test": 10}
DEFAULT_PRIORITY = 50


def severity_priority(severity) -> Column:
    """Lower-cased severity mapped to a priority; unknown -> 50."""
    m = F.create_map(*[x for k, v in SEVERITY_PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.lower(F.coalesce(_c(severity), F.lit("")))), F.lit(DEFAULT_PRIORITY))


def rss_mb(rss_kb, digits: int | None = None) -> Column:
    """kB -> MiB, optionally rounded half-even to ``digits``."""
    v = _c(rss_kb) / F.lit(1024.0)
    return v if digits is None else F.bround(v, digits)


def fmt_num(c, digits: int) -> Column:
    """Python ``f"{x:.{digits}f}"``: half-even on the exact binary value, not on its printed digits.

    ``x * 10^digits`` is taken as the exact sum of a product and its rounding error (Dekker's two-product),
    so a tie is seen as one only where the binary value is one. Values of 2^52 and more after scaling have
    no digits to round and are printed as they are.
    """
    x = _c(c).cast("double")
    if digits == 0:
        return F.bround(x, 0).cast("long").cast("string")
    scale = float(10 ** digits)
    a = F.abs(x)
    p = a * F.lit(scale)
    big = a * F.lit(134217729.0)
    hi = big - (big - a)
    lo = a - hi
    scale_big = scale * 134217729.0
    scale_hi = scale_big - (scale_big - scale)
    scale_lo = scale - scale_hi
    err = ((hi * F.lit(scale_hi) - p) + hi * F.lit(scale_lo) + lo * F.lit(scale_hi)) + lo * F.lit(scale_lo)
    whole = F.floor(p).cast("double")
    past = p - whole - F.lit(0.5)
    up = (past > 0) | ((past == 0) & ((err > 0) | ((err == 0) & (whole % 2 == 1))))
    n = whole.cast("long") + up.cast("long")
    unit = F.lit(10 ** digits).cast("long")
    sign = F.when(F.startswith(x.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    text = F.concat(sign, ((n - n % unit) / unit).cast("long").cast("string"), F.lit("."), F.lpad((n % unit).cast("string"), digits, "0"))
    plain = F.when(F.isnan(x), F.lit("nan")).when(a == float("inf"), F.concat(sign, F.lit("inf"))).when(
        p >= 2.0 ** 52, F.format_string(f"%.{digits}f", x))
    return F.when(x.isNotNull(), F.coalesce(plain, text))
