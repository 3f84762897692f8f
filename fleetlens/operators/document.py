"""Weekly documents (K7): a union of ordered section tables, one document per key.

Every section is a table ``(doc, section, pos, line)``; a document is their union in order. Numbering and joining lines works per
document, which is bounded by what the sections were cut to (top lists), so thousands of documents are written by one job, each by
one sorted group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.operators.weekly import AUDIT_DOMAIN_TITLES

# FIXED VALUES - members of the review, headings of the document.
REVIEW_SCHEMA = ("struct<week_status:string,executive_summary:string,top_issues:array<struct<title:string,severity:string,evidence:string>>,"
                 "recurring_patterns:array<string>,noise_or_expected:array<string>,recommended_actions:array<struct<priority:string,action:string,why:string>>>")


def _lines(df: DataFrame, section: int, lines: list[Column], *tables: Column) -> DataFrame:
    """Fixed lines, then the lines of arrays, as a section."""
    held = F.concat(F.array(*lines), *(F.coalesce(t, F.array().cast("array<string>")) for t in tables))
    return df.select("doc", F.lit(section).alias("section"), F.posexplode(held).alias("pos", "line"))


def _text(x) -> Column:
    return F.coalesce(x, F.lit(""))


def review_sections(reviews: DataFrame) -> list[DataFrame]:
    """Sections 0 to 5 of (doc, since_utc, until_utc, review): header, summary, issues, patterns, noise, actions."""
    r = reviews.withColumn("r", F.from_json("review", REVIEW_SCHEMA)).select("doc", "since_utc", "until_utc", "r.*")
    lit = F.lit
    pairs = lambda items, first, second: F.flatten(F.transform(items, lambda x: F.array(first(x), second(x))))
    issues = pairs(F.col("top_issues"), lambda x: F.concat(lit("- **"), _text(x["title"]), lit("** ["), _text(x["severity"]), lit("]")),
                   lambda x: F.concat(lit("  - evidence: "), _text(x["evidence"])))
    actions = pairs(F.col("recommended_actions"), lambda x: F.concat(lit("- **"), _text(x["priority"]), lit("**: "), _text(x["action"])),
                    lambda x: F.concat(lit("  - why: "), _text(x["why"])))
    bullets = lambda c: F.transform(c, lambda x: F.concat(lit("- "), x))
    head = [lit("# Weekly ops review"), lit(""), F.concat(lit("- Window start: "), "since_utc"), F.concat(lit("- Window end: "), "until_utc"),
            F.concat(lit("- Week status: "), F.coalesce("week_status", lit("unknown"))), lit("")]
    titled = lambda t: [lit(""), lit(f"## {t}"), lit("")]
    return [_lines(r, 0, head), _lines(r, 1, [lit("## Executive summary"), lit(""), _text("executive_summary"), lit("")]),
            _lines(r, 2, [lit("## Top issues"), lit("")], issues), _lines(r, 3, titled("Recurring patterns"), bullets("recurring_patterns")),
            _lines(r, 4, titled("Noise or expected"), bullets("noise_or_expected")), _lines(r, 5, titled("Recommended actions"), actions)]


def domain_section(rollups: DataFrame) -> DataFrame:
    """Section 6 of (doc, domain, total_runs, ok_count, warning_count, critical_count, latest_level, latest_summary, latest_started_at,
    recurring: array of (finding, count)); documents without a domain have no such section."""
    order = {d: i for i, (d, _) in enumerate(AUDIT_DOMAIN_TITLES)}
    place = reduce(lambda a, d: a.when(F.col("domain") == d, order[d]), list(order)[1:], F.when(F.col("domain") == list(order)[0], 0))
    title = reduce(lambda a, x: a.when(F.col("domain") == x[0], x[1]), AUDIT_DOMAIN_TITLES[1:], F.when(F.col("domain") == AUDIT_DOMAIN_TITLES[0][0], AUDIT_DOMAIN_TITLES[0][1]))
    said = lambda name, c: F.concat(F.lit(f"- {name}: "), F.col(c).cast("string"))
    some = lambda name, c: F.when(_text(F.col(c)) != "", F.concat(F.lit(f"- {name}: "), c))
    findings = F.transform(F.filter("recurring", lambda x: _text(x["finding"]) != ""), lambda x: F.concat(F.lit("  - "), x["finding"], F.lit(" ("), x["count"].cast("string"), F.lit(")")))
    head = F.array(F.concat(F.lit("### "), title), F.lit(""), said("Runs", "total_runs"), said("OK", "ok_count"), said("Warning", "warning_count"), said("Critical", "critical_count"),
                   said("Current posture", "latest_level"), some("Latest summary", "latest_summary"), some("Latest run", "latest_started_at"),
                   F.when(F.size("recurring") > 0, F.lit("- Recurring findings:")))
    whole = F.concat(F.filter(head, lambda x: x.isNotNull()), findings, F.array(F.lit("")))
    rows = rollups.where(place.isNotNull()).select("doc", F.struct(place.alias("place"), whole.alias("lines")).alias("x"))
    docs = rows.groupBy("doc").agg(F.array_sort(F.collect_list("x")).alias("x"))  # as many as there are domains
    return _lines(docs, 6, [F.lit(""), F.lit("## Audit domains"), F.lit("")], F.flatten(F.transform("x", lambda x: x["lines"])))


def brief_section(briefs: DataFrame) -> DataFrame:
    """Section 7 of (doc, rank, source, brief_status, executive_summary, markdown_path, json_path), newest brief of each source."""
    some = lambda name, c: F.when(_text(F.col(c)) != "", F.concat(F.lit(f"  - {name}: "), c))
    one = F.array(F.concat(F.lit("- **"), "source", F.lit("** ["), "brief_status", F.lit("]")), some("summary", "executive_summary"), some("markdown", "markdown_path"), some("json", "json_path"))
    rows = briefs.select("doc", F.struct("rank", F.filter(one, lambda x: x.isNotNull()).alias("lines")).alias("x"))
    docs = rows.groupBy("doc").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return _lines(docs, 7, [F.lit(""), F.lit("## Recent AI briefs"), F.lit("")], F.flatten(F.transform("x", lambda x: x["lines"])))


def counter_section(totals: DataFrame) -> DataFrame:
    """Section 8 of (doc, decisions, tasks, runs)."""
    said = [F.concat(F.lit(f"- {n.capitalize()}: "), F.col(n).cast("string")) for n in ("decisions", "tasks", "runs")]
    return _lines(totals, 8, [F.lit(""), F.lit("## Raw counters"), F.lit(""), *said])


def document_lines(sections: list[DataFrame]) -> DataFrame:
    """(doc, section, line_no, line): all sections of each document in order."""
    rows = reduce(DataFrame.unionByName, sections)
    in_doc = Window.partitionBy("doc").orderBy("section", "pos")
    return rows.select("doc", "section", (F.row_number().over(in_doc) - 1).alias("line_no"), "line")


def document_text(lines: DataFrame) -> DataFrame:
    """(doc, markdown): lines joined, without blank ends, closed by a line end."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("doc").agg(F.concat(F.btrim(text, F.lit(" \n\t\r")), F.lit("\n")).alias("markdown"))

