"""Queries of the review contracts (U7): answers with one broken rule each, spread over the events."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fleetlens.operators import contracts as CT
from fleetlens.plans.registry import query
from fleetlens.sources import fixtures as fx

_ISSUE = {"title": "t", "severity": "high", "evidence": "e"}
_ACTION = {"priority": "1", "action": "a", "why": "w"}
_WEEK = {"week_status": "quiet", "executive_summary": "s", "top_issues": [_ISSUE, _ISSUE], "recurring_patterns": ["p"], "noise_or_expected": [], "recommended_actions": [_ACTION]}
_BRIEF = {"brief_status": "watch", "executive_summary": "s", "top_risks": ["r"], "recommended_actions": [], "operator_note": "n"}


def _broken(base: dict, *, drop=(), **change) -> str:
    return json.dumps({k: v for k, v in {**base, **change}.items() if k not in drop})


# FIXED VALUES - answers: whole ones and one for each rule.
WEEK_CASES = [
    _broken(_WEEK), _broken(_WEEK, drop=("week_status",)), _broken(_WEEK, more=1, also=2), _broken(_WEEK, week_status="calm"), _broken(_WEEK, week_status=3),
    _broken(_WEEK, executive_summary=None), _broken(_WEEK, executive_summary=["s"]), _broken(_WEEK, top_issues="none"), _broken(_WEEK, top_issues=[_ISSUE, "x"]),
    _broken(_WEEK, top_issues=[{"title": "t", "severity": "s"}]), _broken(_WEEK, top_issues=[_ISSUE, {**_ISSUE, "owner": "o"}]),
    _broken(_WEEK, top_issues=[{**_ISSUE, "title": 1.5}, {**_ISSUE, "evidence": True}]), _broken(_WEEK, recurring_patterns=["a", 2, None]),
    _broken(_WEEK, noise_or_expected={"a": "b"}), _broken(_WEEK, recommended_actions=[{**_ACTION, "why": ["w"]}, {}]),
    _broken(_WEEK, recommended_actions=None, drop=("top_issues", "noise_or_expected")), "{bad", "", "[1]", '"text"', "null", _broken(_WEEK, top_issues=[]),
]
BRIEF_CASES = [
    _broken(_BRIEF), _broken(_BRIEF, drop=("operator_note", "top_risks")), _broken(_BRIEF, x="y"), _broken(_BRIEF, brief_status="quiet"), _broken(_BRIEF, brief_status=None),
    _broken(_BRIEF, top_risks=[1, "r", {}]), _broken(_BRIEF, top_risks="r"), _broken(_BRIEF, recommended_actions={"a": 1}), _broken(_BRIEF, operator_note=0), "7", "{}", "nothing",
]


def answers(spark, sf_dir, cases):
    ev = fx.read_table(spark, sf_dir, "events").select("event_id")
    pick = F.element_at(F.array(*(F.lit(c) for c in cases)), (F.col("event_id") % len(cases) + 1).cast("int"))
    return ev.select(F.col("event_id").alias("review_id"), pick.alias("review"))


def _cases_sql(cases) -> str:
    listed = ", ".join("'" + c.replace("'", "''") + "'" for c in cases)
    return f"SELECT event_id AS review_id, [{listed}][event_id % {len(cases)} + 1] AS r FROM events"


def _violations_sql(cases, status, values, strings, lists, tables) -> str:
    """All violations, rule by rule (JSON functions of the other engine)."""
    names = [status, *strings, *lists, *tables]
    member = "SELECT review_id, '$.' || m.k AS path, json_extract(r, '$.' || m.k) AS v, m.k FROM o, (SELECT unnest({0!r}) AS k) m WHERE list_contains(json_keys(r), m.k)"
    sql = f"""
t AS MATERIALIZED ({_cases_sql(cases)}),
j AS (SELECT * FROM t WHERE json_valid(r)),
o AS MATERIALIZED (SELECT * FROM j WHERE json_type(r) = 'OBJECT'),
s AS ({member.format([status, *strings])}),
l AS ({member.format([*lists, *tables])}),
e AS MATERIALIZED (SELECT review_id, path || '[' || CAST(i AS VARCHAR) || ']' AS path, json_extract(v, '$[' || CAST(i AS VARCHAR) || ']') AS v, k
  FROM (SELECT *, unnest(range(CAST(json_array_length(v) AS BIGINT))) AS i FROM l WHERE json_type(v) = 'ARRAY')),
found AS (
  SELECT review_id, '$: no JSON' AS violation FROM t WHERE NOT json_valid(r)
  UNION ALL SELECT review_id, '$: not an object' FROM j WHERE json_type(r) <> 'OBJECT'
  UNION ALL SELECT review_id, '$.' || k || ': missing' FROM (SELECT review_id, r, unnest({names!r}) AS k FROM o) x WHERE NOT list_contains(json_keys(r), k)
  UNION ALL SELECT review_id, '$.' || k || ': not allowed' FROM (SELECT review_id, unnest(json_keys(r)) AS k FROM o) x WHERE k NOT IN {tuple(names)!r}
  UNION ALL SELECT review_id, path || ': not a string' FROM s WHERE json_type(v) <> 'VARCHAR'
  UNION ALL SELECT review_id, path || ': not one of {", ".join(values)}' FROM s WHERE k = '{status}' AND json_type(v) = 'VARCHAR' AND json_extract_string(v, '$') NOT IN {tuple(values)!r}
  UNION ALL SELECT review_id, path || ': not an array' FROM l WHERE json_type(v) <> 'ARRAY'
  UNION ALL SELECT review_id, path || ': not a string' FROM e WHERE k IN {tuple([*lists, ""])!r} AND json_type(v) <> 'VARCHAR'"""
    for name, columns in tables.items():
        own = f"(SELECT * FROM e WHERE k = '{name}' AND json_type(v) = 'OBJECT')"
        sql += f"""
  UNION ALL SELECT review_id, path || ': not an object' FROM e WHERE k = '{name}' AND json_type(v) <> 'OBJECT'
  UNION ALL SELECT review_id, path || '.' || c || ': missing' FROM (SELECT *, unnest({columns!r}) AS c FROM {own} y) x WHERE NOT list_contains(json_keys(v), c)
  UNION ALL SELECT review_id, path || '.' || c || ': not allowed' FROM (SELECT *, unnest(json_keys(v)) AS c FROM {own} y) x WHERE c NOT IN {tuple(columns)!r}
  UNION ALL SELECT review_id, path || '.' || c || ': not a string' FROM (SELECT *, unnest({columns!r}) AS c FROM {own} y) x
    WHERE list_contains(json_keys(v), c) AND json_type(json_extract(v, '$.' || c)) <> 'VARCHAR'"""
    return sql + ")"


_WEEK_SQL = _violations_sql(WEEK_CASES, "week_status", ["quiet", "stable", "watch", "risky"], ["executive_summary"], ["recurring_patterns", "noise_or_expected"],
                            {"top_issues": ["title", "severity", "evidence"], "recommended_actions": ["priority", "action", "why"]})
_BRIEF_SQL = _violations_sql(BRIEF_CASES, "brief_status", ["stable", "watch", "risky"], ["executive_summary", "operator_note"], ["top_risks", "recommended_actions"], {})


def _listed(spark, sf_dir, cases, contract):
    return CT.checked(answers(spark, sf_dir, cases), "review", contract).select("review_id", F.explode("violations").alias("violation"))


@query("weekly_contract", f"WITH {_WEEK_SQL} SELECT review_id, violation FROM found")
def q_weekly_contract(spark, sf_dir):
    """Paths of all violations of the weekly review's contract."""
    return _listed(spark, sf_dir, WEEK_CASES, CT.WEEKLY)


@query("brief_contract", f"WITH {_BRIEF_SQL} SELECT review_id, violation FROM found")
def q_brief_contract(spark, sf_dir):
    return _listed(spark, sf_dir, BRIEF_CASES, CT.BRIEF)


@query("review_quarantine", f"""WITH {_WEEK_SQL},
n AS (SELECT t.review_id, count(violation) AS n FROM t LEFT JOIN found USING (review_id) GROUP BY t.review_id)
SELECT review_id, CASE WHEN n = 0 THEN 'accepted' ELSE 'quarantine' END AS sink, n AS violations FROM n
""")
def q_review_quarantine(spark, sf_dir):
    """Answers that keep the contract and those that don't, read back from their sinks."""
    import uuid

    from fleetlens.session import checkpoint_dir

    root = f"{checkpoint_dir(spark).rstrip('/')}/tables/reviews-{uuid.uuid4().hex}"
    CT.route(answers(spark, sf_dir, WEEK_CASES), "review", CT.WEEKLY, f"{root}/accepted", f"{root}/quarantine")
    good = spark.read.parquet(f"{root}/accepted").select("review_id", F.lit("accepted").alias("sink"), F.lit(0).cast("long").alias("violations"))
    bad = spark.read.parquet(f"{root}/quarantine").select("review_id", F.lit("quarantine").alias("sink"), F.size("violations").cast("long").alias("violations"))
    return good.unionByName(bad)
