"""Quality rules with host-level verdicts.

Per document: plain counts over the whole text (one Arrow pass, no shuffle). Per host: rule failures
are summed, the failure rate is shrunk by a beta prior that is fitted to all hosts by moments, and the
host's verdict is joined back to its documents. A host is rejected when, by its posterior (the fitted prior and its own
counts), its documents surely fail more often than not: the posterior mean lies over ``HOST_RATE`` by ``SURE`` standard
deviations. Below that, most of its passing documents are good ones, and rejecting them would cost more than it saves; a small
host is held to the other hosts' rate by the prior and needs more failures. Only counts are shuffled, never texts; a host that holds
a third of all rows is pre-aggregated before the shuffle and split by AQE in the join.

Defined cases: a null or empty text has no words (and fails for having too few); a null host is a host
of its own; a repeated row is judged and returned once per row; an empty table gives an empty result;
columns other than the three named are ignored; very long texts are counted whole; hosts that tie are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import byte_values, keep, prepare, table, window_hashes
from fleetlens.llm.registry import query

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: A host is rejected when its posterior failure rate lies over this by so many of its standard deviations.
HOST_RATE, SURE = 0.5, 3.0
SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))

_STATS = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], k: int = WINDOW) -> int:
    """Words inside k-word windows that occur twice or more in the text, first occurrences included."""
    n = len(words)
    if n <= k:
        return 0
    w = window_hashes(np.fromiter(map(hash, words), np.int64, n).view(np.uint64), k)
    order = np.argsort(w, kind="stable")
    s = w[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(w), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(n + 1, np.int32)
    starts = order[twice]
    edge[starts] += 1
    np.subtract.at(edge, starts + k, 1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for t in byte_values(b.column(2)):
            words = t.split()
            rows.append((len(words), len(t.translate(None, _NOT_COUNTED)), len(t) - len(t.translate(None, SYMBOLS)),
                         duplicate_lines(t), repeated_words(words)))
        counts = np.array(rows, np.int64).reshape(-1, 5).T
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1).cast(pa.string()), *(pa.array(c) for c in counts)],
            names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def document_stats(docs: DataFrame, host: str = "source") -> DataFrame:
    """Rule counts per document, with base_failed. Words and lines of the whole text."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), "text")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return narrow.mapInArrow(_stats, _STATS).withColumn("base_failed", failed)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Alpha and beta by moments of the hosts' failure rates (one row comes to the driver).

    The spread of rates that binomial sampling alone explains is taken off first. Where hosts don't
    differ beyond that, the prior counts as 1000 documents; with no spread and no mean, it is flat.
    """
    p = F.col("failed") / F.col("n")
    m = hosts.where(F.col("n") > 0).agg(
        F.sum("failed").alias("f"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.avg(p).alias("p"), F.var_pop(p).alias("v"), F.avg(1 / F.col("n")).alias("inv")).first()
    if not m["k"] or not m["n"]:
        return 1.0, 1.0
    mean = (m["f"] + 1) / (m["n"] + 2)
    room = mean * (1 - mean)
    spread = max(m["v"] - room * m["inv"], 0.0) if m["k"] > 1 else 0.0
    strength = min(max(room / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0
    return mean * strength, (1 - mean) * strength


def host_verdicts(stats: DataFrame, max_rate: float = HOST_RATE, sure: float = SURE) -> DataFrame:
    """host, host_docs, host_failed, host_rate (posterior mean), host_spread (its standard deviation), host_rejected."""
    hosts = stats.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failed"))
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    spread = F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(alpha + beta + 1)))
    return hosts.select("host", F.col("n").alias("host_docs"), F.col("failed").alias("host_failed"), rate.alias("host_rate"),
                        spread.alias("host_spread"), (rate - F.lit(sure) * spread > F.lit(max_rate)).alias("host_rejected"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = HOST_RATE, sure: float = SURE) -> DataFrame:
    """Each document's counts with base_failed, its host's shrunk rate and the verdict ``kept``."""
    prepare(docs.sparkSession)
    stats = keep(document_stats(docs, host), "quality-stats")
    verdict = host_verdicts(stats, max_rate, sure).withColumnRenamed("host", "_host")
    out = stats.join(verdict, stats["host"].eqNullSafe(verdict["_host"]), "left").drop("_host")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False)))


@query("op3_quality_rules", r"""
WITH w AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t,
    [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS ws,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
v AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 7], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS s FROM w WHERE len(ws) >= 8)),
r AS (SELECT doc_id, s FROM v QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 8)) AS p FROM r) GROUP BY doc_id),
d AS (
  SELECT w.doc_id, host, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM d),
h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM b GROUP BY host),
m AS (SELECT (sum(f) + 1) / (sum(n) + 2.0) AS mean, count(*) AS k, var_pop(f / n) AS v, avg(1.0 / n) AS inv FROM h),
q AS (SELECT mean, mean * (1 - mean) AS room, CASE WHEN k > 1 THEN greatest(v - mean * (1 - mean) * inv, 0) ELSE 0 END AS spread FROM m),
z AS (SELECT mean, CASE WHEN spread > 0 THEN least(greatest(room / spread - 1, 1), 1000) ELSE 1000 END AS strength FROM q),
y AS (SELECT host, n, strength, (f + mean * strength) / (n + strength) AS rate FROM h CROSS JOIN z),
j AS (SELECT host, rate - 3 * sqrt(rate * (1 - rate) / (n + strength + 1)) > 0.5 AS rejected FROM y)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept, b.host
FROM b JOIN j ON j.host IS NOT DISTINCT FROM b.host
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host")
