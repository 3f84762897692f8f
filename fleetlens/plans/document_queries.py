"""Weekly documents of many sites, posture adjusted in both ways."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.functions.timefn import fmt_utc
from fleetlens.operators import document as DOC
from fleetlens.operators import weekly as W
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

# FIXED VALUES - window of the documents, sites, the domain of an event by its number.
SINCE, UNTIL, SITES = "2024-01-24 00:00:00 UTC", "2024-01-31 00:00:00 UTC", 40
DOMAINS = [d for d, _ in W.AUDIT_DOMAIN_TITLES]
_FMT = "'%Y-%m-%d %H:%M:%S UTC'"


def _reviews_of(spark, sf_dir):
    """Audit reviews: site, domain and level of every event; some sites have no review of a domain."""
    ev = fx.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    k = F.col("event_id")
    level = F.when(k % 9 < 7, "ok").when(k % 9 == 7, "warning").otherwise("critical")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % SITES).alias("doc"),
                     F.element_at(F.array(*(F.lit(d) for d in DOMAINS)), (k % 4 + 1).cast("int")).alias("domain"), level.alias("level"), "event_type")


_REVIEWS_SQL = f"""
ev AS (SELECT event_id, ts, user_id % {SITES} AS doc, {DOMAINS!r}[event_id % 4 + 1] AS domain, event_type,
  CASE WHEN event_id % 9 < 7 THEN 'ok' WHEN event_id % 9 = 7 THEN 'warning' ELSE 'critical' END AS level FROM events),
roll AS (SELECT doc, domain, count(*) AS total_runs, count(*) FILTER (WHERE level = 'ok') AS ok_count, count(*) FILTER (WHERE level = 'warning') AS warning_count,
  count(*) FILTER (WHERE level = 'critical') AS critical_count, arg_max(level, (ts, event_id)) AS latest_level,
  strftime(max(ts), {_FMT}) AS latest_started_at, max(event_id) AS last_id FROM ev GROUP BY doc, domain),
flag AS (SELECT doc, count(*) = 4 AND bool_and(latest_level = 'ok') AS all_ok FROM roll GROUP BY doc),
said AS (SELECT DISTINCT doc, CASE doc % 3 WHEN 0 THEN 'risky' WHEN 1 THEN 'watch' ELSE 'stable' END AS week_status,
  CASE WHEN doc % 11 = 0 THEN '' WHEN doc % 5 = 0 THEN 'Before.' || '{W.RECOVERED_NOTE}' ELSE 'Site ' || CAST(doc AS VARCHAR) || ' had a week.  ' END AS executive_summary FROM ev),
posture AS (SELECT doc, all_ok, CASE WHEN all_ok AND week_status = 'risky' THEN 'watch' ELSE week_status END AS week_status,
  CASE WHEN all_ok AND executive_summary <> '' AND doc % 5 <> 0 THEN rtrim(executive_summary) || '{W.RECOVERED_NOTE}' ELSE executive_summary END AS executive_summary
  FROM said JOIN flag USING (doc))"""


def _rollups(reviews):
    newest = F.max_by(F.struct("level", "event_id"), F.struct("ts", "event_id"))
    r = reviews.groupBy("doc", "domain").agg(
        F.count(F.lit(1)).alias("total_runs"), *(F.count_if(F.col("level") == x).alias(f"{n}_count") for x, n in (("ok", "ok"), ("warning", "warning"), ("critical", "critical"))),
        newest.alias("x"), F.max("ts").alias("latest_ts"), F.max("event_id").alias("last_id"))
    return r.select("doc", "domain", "total_runs", "ok_count", "warning_count", "critical_count", F.col("x.level").alias("latest_level"),
                    fmt_utc("latest_ts").alias("latest_started_at"), "last_id")


def _posture(reviews, rollups):
    d = F.col("doc")
    summary = F.when(d % 11 == 0, "").when(d % 5 == 0, "Before." + W.RECOVERED_NOTE).otherwise(F.concat(F.lit("Site "), d.cast("string"), F.lit(" had a week.  ")))
    said = reviews.select("doc").distinct().withColumn("s", F.element_at(F.array(F.lit("risky"), F.lit("watch"), F.lit("stable")), (d % 3 + 1).cast("int"))).withColumn("e", summary)
    flagged = said.join(W.all_domains_ok_by(rollups, "doc", DOMAINS), "doc", "left")
    status, text = W.posture_adjust(F.col("s"), F.col("e"), F.coalesce("all_domains_ok", F.lit(False)))
    return flagged.select("doc", F.coalesce("all_domains_ok", F.lit(False)).alias("all_ok"), status.alias("week_status"), text.alias("executive_summary"))


@query("site_posture", f"WITH {_REVIEWS_SQL} SELECT doc, all_ok, week_status, executive_summary FROM posture")
def q_site_posture(spark, sf_dir):
    """A14 / A15 per site: some sites have recovered, some haven't; the note is appended once and only to a text."""
    reviews = _reviews_of(spark, sf_dir)
    return _posture(reviews, _rollups(reviews))


_PARTS_SQL = _REVIEWS_SQL + """,
kinds AS (SELECT doc, event_type, count(*) AS n, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, event_type) AS r FROM ev GROUP BY doc, event_type),
briefs AS (SELECT doc, event_type AS source, max(event_id) AS id FROM ev WHERE event_id % 20 = 0 GROUP BY doc, event_type)"""


def _parts(spark, sf_dir):
    reviews = _reviews_of(spark, sf_dir)
    rollups = _rollups(reviews)
    kinds = reviews.groupBy("doc", "event_type").agg(F.count(F.lit(1)).alias("n"))
    by_count = Window.partitionBy("doc").orderBy(F.col("n").desc(), "event_type")
    kinds = kinds.withColumn("r", F.row_number().over(by_count))
    listed = kinds.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("r", "event_type", "n"))).alias("k"))
    issues = F.transform(F.slice("k", 1, 3), lambda x: F.struct(x["event_type"].alias("title"), F.when(x["r"] == 1, "high").otherwise("low").alias("severity"),
                                                                F.concat(x["n"].cast("string"), F.lit(" events")).alias("evidence")))
    actions = F.array(F.struct(F.lit("1").alias("priority"), F.concat(F.lit("look at "), F.get("k", F.lit(0))["event_type"]).alias("action"), F.lit("most frequent").alias("why")))
    noise = F.when(F.col("doc") % 2 == 0, F.array(F.lit("nightly job"))).otherwise(F.array().cast("array<string>"))
    review = F.to_json(F.struct("week_status", "executive_summary", issues.alias("top_issues"), F.array_sort(F.transform("k", lambda x: x["event_type"])).alias("recurring_patterns"),
                                noise.alias("noise_or_expected"), actions.alias("recommended_actions")))
    answers = _posture(reviews, rollups).join(listed, "doc").select("doc", F.lit(SINCE).alias("since_utc"), F.lit(UNTIL).alias("until_utc"), review.alias("review"))
    found = F.when(F.col("critical_count") > 0, F.array(F.struct(F.lit("disk; full").alias("finding"), F.col("critical_count").alias("count")))).otherwise(F.array().cast("array<struct<finding:string,count:bigint>>"))
    rolled = rollups.withColumn("latest_summary", F.when(F.col("latest_level") != "ok", F.concat(F.lit("run "), F.col("last_id").cast("string"))).otherwise("")).withColumn("recurring", found)
    briefs = reviews.where(F.col("event_id") % 20 == 0).groupBy("doc", F.col("event_type").alias("source")).agg(F.max("event_id").alias("id"))
    briefs = briefs.select("doc", (-F.col("id")).alias("rank"), "source", F.lit("watch").alias("brief_status"), F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("brief "), F.col("id").cast("string"))).alias("executive_summary"),
                           F.concat(F.lit("/b/"), F.col("id").cast("string"), F.lit(".md")).alias("markdown_path"), F.lit("").alias("json_path"))
    totals = reviews.groupBy("doc").agg(F.count(F.lit(1)).alias("decisions"), F.count_if(F.col("event_id") % 3 == 0).alias("tasks"), F.count_if(F.col("event_id") % 5 == 0).alias("runs"))
    return answers, rolled, briefs, totals, kinds


def _sections(spark, sf_dir):
    answers, rolled, briefs, totals, _ = _parts(spark, sf_dir)
    return [*DOC.review_sections(answers), DOC.domain_section(rolled), DOC.brief_section(briefs), DOC.counter_section(totals)]


_TITLE_ROWS = ", ".join(f"({i}, '{d}', '{t}')" for i, (d, t) in enumerate(W.AUDIT_DOMAIN_TITLES))


def _fixed(section: int, lines: list[str], source: str = "posture") -> str:
    return " UNION ALL ".join(f"SELECT doc, {section} AS section, {i} AS a, 0 AS b, {line} AS line FROM {source}" for i, line in enumerate(lines))


_LINES_SQL = f"""
t(o, domain, title) AS (VALUES {_TITLE_ROWS}),
rt AS (SELECT roll.*, o, title FROM roll JOIN t USING (domain)),
l(doc, section, a, b, line) AS (
{_fixed(0, ["'# Weekly ops review'", "''", f"'- Window start: {SINCE}'", f"'- Window end: {UNTIL}'", "'- Week status: ' || week_status", "''"])}
UNION ALL {_fixed(1, ["'## Executive summary'", "''", "executive_summary", "''"])}
UNION ALL {_fixed(2, ["'## Top issues'", "''"])}
UNION ALL SELECT doc, 2, 10 + r, 0, '- **' || event_type || '** [' || CASE WHEN r = 1 THEN 'high' ELSE 'low' END || ']' FROM kinds WHERE r <= 3
UNION ALL SELECT doc, 2, 10 + r, 1, '  - evidence: ' || CAST(n AS VARCHAR) || ' events' FROM kinds WHERE r <= 3
UNION ALL {_fixed(3, ["''", "'## Recurring patterns'", "''"])}
UNION ALL SELECT doc, 3, 9 + row_number() OVER (PARTITION BY doc ORDER BY event_type), 0, '- ' || event_type FROM kinds
UNION ALL {_fixed(4, ["''", "'## Noise or expected'", "''"])}
UNION ALL SELECT doc, 4, 9, 0, '- nightly job' FROM posture WHERE doc % 2 = 0
UNION ALL {_fixed(5, ["''", "'## Recommended actions'", "''"])}
UNION ALL SELECT doc, 5, 9, 0, '- **1**: look at ' || event_type FROM kinds WHERE r = 1
UNION ALL SELECT doc, 5, 10, 0, '  - why: most frequent' FROM kinds WHERE r = 1
UNION ALL {_fixed(6, ["''", "'## Audit domains'", "''"])}
UNION ALL SELECT doc, 6, 10 + o, 0, '### ' || title FROM rt
UNION ALL SELECT doc, 6, 10 + o, 1, '' FROM rt
UNION ALL SELECT doc, 6, 10 + o, 2, '- Runs: ' || CAST(total_runs AS VARCHAR) FROM rt
UNION ALL SELECT doc, 6, 10 + o, 3, '- OK: ' || CAST(ok_count AS VARCHAR) FROM rt
UNION ALL SELECT doc, 6, 10 + o, 4, '- Warning: ' || CAST(warning_count AS VARCHAR) FROM rt
UNION ALL SELECT doc, 6, 10 + o, 5, '- Critical: ' || CAST(critical_count AS VARCHAR) FROM rt
UNION ALL SELECT doc, 6, 10 + o, 6, '- Current posture: ' || latest_level FROM rt
UNION ALL SELECT doc, 6, 10 + o, 7, '- Latest summary: run ' || CAST(last_id AS VARCHAR) FROM rt WHERE latest_level <> 'ok'
UNION ALL SELECT doc, 6, 10 + o, 8, '- Latest run: ' || latest_started_at FROM rt
UNION ALL SELECT doc, 6, 10 + o, 9, '- Recurring findings:' FROM rt WHERE critical_count > 0
UNION ALL SELECT doc, 6, 10 + o, 10, '  - disk; full (' || CAST(critical_count AS VARCHAR) || ')' FROM rt WHERE critical_count > 0
UNION ALL SELECT doc, 6, 10 + o, 11, '' FROM rt
UNION ALL {_fixed(7, ["''", "'## Recent AI briefs'", "''"], "(SELECT DISTINCT doc FROM briefs)")}
UNION ALL SELECT doc, 7, 10 - id, 0, '- **' || source || '** [watch]' FROM (SELECT doc, source, id - 1000000000 AS id FROM briefs)
UNION ALL SELECT doc, 7, 1000000010 - id, 1, '  - summary: brief ' || CAST(id AS VARCHAR) FROM briefs WHERE id % 3 <> 0
UNION ALL SELECT doc, 7, 1000000010 - id, 2, '  - markdown: /b/' || CAST(id AS VARCHAR) || '.md' FROM briefs
UNION ALL {_fixed(8, ["''", "'## Raw counters'", "''"])}
UNION ALL SELECT doc, 8, 9, 0, '- Decisions: ' || CAST(count(*) AS VARCHAR) FROM ev GROUP BY doc
UNION ALL SELECT doc, 8, 10, 0, '- Tasks: ' || CAST(count(*) FILTER (WHERE event_id % 3 = 0) AS VARCHAR) FROM ev GROUP BY doc
UNION ALL SELECT doc, 8, 11, 0, '- Runs: ' || CAST(count(*) FILTER (WHERE event_id % 5 = 0) AS VARCHAR) FROM ev GROUP BY doc)"""


@query("weekly_documents", f"""WITH {_PARTS_SQL}, {_LINES_SQL}
SELECT doc, section, CAST(row_number() OVER (PARTITION BY doc ORDER BY section, a, b) - 1 AS INTEGER) AS line_no, line FROM l""")
def q_weekly_documents(spark, sf_dir):
    """K7: all nine sections of each site's weekly document, line by line."""
    return DOC.document_lines(_sections(spark, sf_dir))


@query("weekly_document_text", f"""WITH {_PARTS_SQL}, {_LINES_SQL}
SELECT doc, trim(string_agg(line, chr(10) ORDER BY section, a, b), chr(10) || ' ') || chr(10) AS markdown FROM l GROUP BY doc""")
def q_weekly_document_text(spark, sf_dir):
    return DOC.document_text(DOC.document_lines(_sections(spark, sf_dir)))
