"""String scalars (P1-P14). All are built-in Column expressions (codegen, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes every whitespace character; Spark's trim only spaces. The set is
# built by rule (every code point Python calls whitespace) and stripped with btrim (no regex).
PY_WHITESPACE = "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(c) -> Column:
    """Python ``strip()`` - remove leading/trailing whitespace of any kind."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def pick_str(*cols, default: str = "") -> Column:
    """First non-null value whose stripped text is non-empty, stripped; else ``default``."""
    parts = [F.nullif(py_strip(_c(x).cast("string")), F.lit("")) for x in cols]
    return F.coalesce(*parts, F.lit(default))


def escape_label(c) -> Column:
    """Exposition label escaping - backslash, newline, double quote."""
    x = F.replace(_c(c), F.lit("\\"), F.lit("\\\\"))
    x = F.replace(x, F.lit("\n"), F.lit("\\n"))
    return F.replace(x, F.lit('"'), F.lit('\\"'))


def format_labels(labels) -> Column:
    """``{k="v",...}`` sorted by key; empty map -> ''."""
    entries = F.array_sort(F.map_entries(_c(labels)))
    body = F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit('="'), escape_label(e["value"]), F.lit('"'))), ","
    )
    return F.when(F.size(entries) > 0, F.concat(F.lit("{"), body, F.lit("}"))).otherwise(F.lit(""))


def sanitize_label(c) -> Column:
    """P5: strip, lower, every char that is not a letter/digit/underscore -> '_', strip '_'."""
    x = F.regexp_replace(F.lower(py_strip(_c(c))), r"[^\p{L}\p{N}_]", "_")
    return F.regexp_replace(x, r"^_+|_+$", "")


def safe_name(c) -> Column:
    """Keep letters, digits, '-', '_'; others -> '_'; strip '_'; empty -> 'unknown'."""
    x = F.regexp_replace(_c(c), r"[^\p{L}\p{N}_-]", "_")
    x = F.regexp_replace(x, r"^_+|_+$", "")
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("unknown"))


def drop_quotes_kind(c) -> Column:
    """VPS gauge label clean-up: drop '"', backslash -> '_'."""
    return F.replace(F.replace(_c(c), F.lit('"'), F.lit("")), F.lit("\\"), F.lit("_"))


# FIXED VALUES - ordered substring -> application name map used to label processes.
APP_NAME_PATTERNS = [
    ("ChatGPT.app", "ChatGPT"),
    ("Obsidian.app", "Obsidian"),
    ("iTerm.app", "iTerm"),
    ("iTerm2", "iTerm"),
    ("Music.app", "Music"),
    ("Safari.app", "Safari"),
    ("AppleSpell.service", "AppleSpell"),
    ("WindowServer", "WindowServer"),
    ("Notes.app", "Notes"),
    ("Telegram.app", "Telegram"),
    ("Cursor.app", "Cursor"),
    ("Code.app", "VSCode"),
]


def normalize_app_name(c) -> Column:
    """First substring hit of the ordered map; else the last '/' part of the stripped
    command cut to 40 chars; else the first 40 chars of the command; else 'unknown'."""
    cmd = py_strip(F.coalesce(_c(c), F.lit("")))
    expr = None
    for needle, name in APP_NAME_PATTERNS:
        cond = cmd.contains(needle)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.element_at(F.split(cmd, "/"), -1)
    fallback = (
        F.when(last != "", F.left(last, F.lit(40)))
        .when(cmd != "", F.left(cmd, F.lit(40)))
        .otherwise(F.lit("unknown"))
    )
    return expr.otherwise(fallback)


def squash_spaces(c) -> Column:
    """Collapse whitespace runs to one space and strip."""
    return py_strip(F.regexp_replace(_c(c), r"\s+", " "))


def split_findings(c) -> Column:
    """P10: split on ';', strip each part, drop empties -> array<string>."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ";"), lambda x: py_strip(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def tail_lines(c, n: int) -> Column:
    """Last ``n`` non-blank lines (as an array)."""
    lines = F.filter(F.split(F.coalesce(_c(c), F.lit("")), r"\r?\n"), lambda x: py_strip(x) != F.lit(""))
    return F.when(F.size(lines) <= n, lines).otherwise(F.slice(lines, -n, n))


def last_prefixed_line(c, prefix: str = "Saved: ") -> Column:
    """Remainder of the last line starting (after spaces) with ``prefix``; null if none."""
    hits = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(r"(?m)^\s*" + prefix + r"(.*)$"), F.lit(1))
    return F.when(F.size(hits) > 0, py_strip(F.element_at(hits, -1)))


def finding_text(findings, empty: str = "ok:no findings") -> Column:
    """``severity:message`` joined by '; '; empty -> ``empty``."""
    f = _c(findings)
    joined = F.array_join(F.transform(f, lambda x: F.concat(x["severity"], F.lit(":"), x["message"])), "; ")
    return F.when(F.size(f) == 0, F.lit(empty)).otherwise(joined)


def render_summary(host, level, findings_text, log_path=None, details=None) -> Column:
    """``host=<h> audit_analyze=<level> findings=<text> [log_path=..] [details=..]``."""
    parts = [
        F.concat(F.lit("host="), _c(host)),
        F.concat(F.lit("audit_analyze="), _c(level)),
        F.concat(F.lit("findings="), _c(findings_text)),
    ]
    if log_path is not None:
        parts.append(F.when(F.coalesce(_c(log_path), F.lit("")) != "", F.concat(F.lit("log_path="), _c(log_path))))
    if details is not None:
        parts.append(F.when(F.coalesce(_c(details), F.lit("")) != "", F.concat(F.lit("details="), _c(details))))
    return F.concat_ws(" ", *parts)
