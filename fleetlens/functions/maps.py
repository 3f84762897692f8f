"""Array / map / JSON / hash scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.text import py_strip

# FIXED VALUES - annotation/label keys copied into a signal's context, in this order.
CONTEXT_KEYS = [
    "top_app",
    "top_rss_mb",
    "swap_used_mb",
    "memory_free_percent",
    "uptime_days",
    "disk_used_percent",
    "suggested_action",
    "reason_text",
    "timestamp_utc",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _strip(c: Column) -> Column:
    return py_strip(c)


def canonical_json(labels) -> Column:
    """Sorted-key compact JSON of a string map (what the fingerprint hashes)."""
    m = _c(labels)
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def fingerprint(labels, explicit) -> Column:
    """Explicit fingerprint when non-blank, else SHA-256 hex of the canonical label JSON."""
    exp = F.nullif(_strip(F.coalesce(_c(explicit), F.lit(""))), F.lit(""))
    return F.coalesce(exp, F.sha2(canonical_json(labels), 256))


def context_pick(labels, annotations, keys=tuple(CONTEXT_KEYS)) -> Column:
    """For each key, annotation value else label value, stripped; blank values dropped."""
    ann, lab = _c(annotations), _c(labels)
    karr = F.array(*[F.lit(k) for k in keys])
    vals = F.transform(karr, lambda k: _strip(F.coalesce(F.try_element_at(ann, k), F.try_element_at(lab, k))))
    return F.map_filter(F.map_from_arrays(karr, vals), lambda k, v: v.isNotNull() & (v != F.lit("")))


def json_path(payload, path: str) -> Column:
    """``coalesce(json_extract(payload, path), '')``."""
    return F.coalesce(F.get_json_object(_c(payload), path), F.lit(""))


def safe_json_object(c) -> Column:
    """Parse a JSON object into map<string,string>; bad JSON / non-object -> empty map."""
    parsed = F.from_json(_c(c), "map<string,string>", {"mode": "PERMISSIVE"})
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def missing_keys(facts, required) -> Column:
    """Required keys (in given order) not present in the facts map."""
    req = F.array(*[F.lit(k) for k in required])
    return F.array_except(req, F.map_keys(_c(facts)))


def enabled_active_pair(lines) -> Column:
    """Consecutive non-blank lines 'enabled' then 'active' (stripped, lower-cased)."""
    cleaned = F.filter(F.transform(_c(lines), lambda x: F.lower(_strip(x))), lambda x: x != F.lit(""))
    joined = F.concat(F.lit("\n"), F.array_join(cleaned, "\n"), F.lit("\n"))
    return joined.contains("\nenabled\nactive\n")


def contains_any(text, patterns) -> Column:
    """Case-insensitive substring any-of."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    found = F.lit(False)
    for p in patterns:  # compiled, with one lower-cased text; a lambda would make one per pattern
        found = found | t.contains(p.lower())
    return found


def overlay_maps(*maps) -> Column:
    """P39 helper: later maps overlay earlier ones (needs mapKeyDedupPolicy=LAST_WIN)."""
    return F.map_concat(*[_c(m) for m in maps])
