"""Importance resampling towards a target distribution by hashed word n-grams.

* Features are all runs of 1 to ``order`` consecutive words, joined by a space; a feature's bucket is the crc32 of
  its UTF-8 bytes mod ``buckets``. Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
* Batch concatenation: the texts of a batch are joined with a sentinel between them, one regular expression runs over
  the joined bytes, ``searchsorted`` on the texts' offsets tells each word's text, n-grams whose first and last word
  lie in different texts are masked, and the rest is counted by ``bincount``. Words come in blocks of ``BLOCK``
  (the last ``order - 1`` words of a block are carried over), so a very long text never stands as a list of words.
* Counts: every task sums its texts into one table of ``buckets`` numbers, so the shuffle holds at most that many rows
  of a task, whatever the texts hold. A bucket's gain is the logarithm of the smoothed ratio of target and raw share.
* Draw: scores are weight plus Gumbel noise from a hash of the id, so the highest scores are a sample without
  replacement. Rows of (score, doc_id) are sorted by range; a row's rank is its place in its range plus the
  rows of the ranges before, so no task holds more than a range. Only the sizes of ranges come to the driver.

Defined cases: a null text has no words, weight 0, and is never drawn for having too few words; a null doc_id has
noise of an empty id and comes before other ids in a tie; repeated rows are rows of their own, each with a
rank of its own; empty documents give an empty result, an empty target has no features (T = 0);
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import MEMO_WORD_BYTES, MEMO_WORDS, byte_values, id_or_least, keep, parts_for, prepare, table, worker_memo
from fleetlens.llm.registry import query

BUCKETS, ORDER = 10_000, 1
MIN_WORDS, PERCENT, SEED = 20, 10, 2024
#: A batch's texts are joined up to this many bytes (a longer text stands alone); words of a block.
JOINED_BYTES, BLOCK = 4_000_000, 100_000
ROWS_PER_RANGE = 1_000_000
SENTINEL = b"\x00"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of at most JOINED_BYTES together, with the number of the first."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > JOINED_BYTES:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, texts[at:]


def hashed(words: list[bytes], n: int, buckets: int, memo: dict) -> np.ndarray:
    """Bucket of each run of n words."""
    crc = zlib.crc32
    if n > 1:
        return np.fromiter((crc(b" ".join(words[i:i + n])) % buckets for i in range(len(words) - n + 1)), np.int64)
    get, room = memo.get, len(memo) < MEMO_WORDS
    out = np.empty(len(words), np.int64)
    for i, w in enumerate(words):
        b = get(w)
        if b is None:
            b = crc(w) % buckets
            if room and len(w) <= MEMO_WORD_BYTES:
                memo[w] = b
        out[i] = b
    return out


def features(texts: list[bytes], order: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in a feature, text, bucket) of every feature, in blocks: one scan over the joined texts of each group."""
    memo = worker_memo(f"crc-buckets-{buckets}", large=True)
    for first, group in _groups(texts):
        joined = SENTINEL.join(group).lower()
        starts = np.cumsum([0] + [len(t) + 1 for t in group[:-1]])
        found, words, at = _WORD.finditer(joined), [], []
        while block := list(islice(found, BLOCK)):
            carried = len(words)
            words += [m[0] for m in block]
            at += [m.start() for m in block]
            text = np.searchsorted(starts, np.array(at, np.int64), side="right") - 1
            for n in range(1, min(order, len(words)) + 1):
                ahead = text[n - 1:]
                # runs that end in this block and don't reach into another text
                whole = (text[:len(ahead)] == ahead) & (np.arange(n - 1, len(words)) >= carried)
                yield n, first + ahead[whole], hashed(words, n, buckets, memo)[whole]
            words, at = (words[1 - order:], at[1 - order:]) if order > 1 else ([], [])


def _counts(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, found in features(byte_values(b.column(0)), order, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> list[int]:
    """How many features of all texts fall into each bucket (``buckets`` numbers come to the driver)."""
    found = texts.select("text").mapInArrow(_counts(order, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for r in found.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln) of each bucket's smoothed share in the target over its share in the raw texts."""
    s_all, t_all, k = float(sum(raw)), float(sum(target)), float(len(raw))
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(raw, target)]


def noise(doc_id: int | None, seed: int) -> int:
    """floor(-1000 ln(-ln u)), u from the first 8 hex digits of a SHA-256 of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weights(gain, order: int, buckets: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(gain.value, np.float64)
        for b in batches:
            n = b.num_rows
            count, words, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for length, text, found in features(byte_values(b.column(1)), order, buckets):
                own = np.bincount(text, minlength=n)
                count += own
                if length == 1:
                    words += own
                weight += np.bincount(text, weights=value[found], minlength=n).astype(np.int64)  # whole numbers: exact
            gumbel = np.fromiter((noise(i, seed) for i in b.column(0).to_pylist()), np.int64, n)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (count, words, weight, weight + gumbel))],
                                             names=["doc_id", "n_features", "n_words", "weight", "score"])

    return run


def weigh(docs: DataFrame, gain: list[int], order: int = ORDER, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, n_words, weight and score of every document."""
    spark = prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    run = _weights(spark.sparkContext.broadcast(gain), order, len(gain), seed)
    return narrow.mapInArrow(run, "doc_id long, n_features long, n_words long, weight long, score long")


def ranked(rows: DataFrame, keys: list[Column], size: int) -> DataFrame:
    """``rows`` with ``rank`` (from 1) in the order of ``keys``: sorted by range, then numbered within ranges."""
    numbered = keep(rows.withColumn("_salt", F.monotonically_increasing_id())  # rows that tie in all keys may be parted
                    .repartitionByRange(parts_for(size, ROWS_PER_RANGE), *keys, F.col("_salt")).sortWithinPartitions(*keys, F.col("_salt"))
                    .withColumn("_at", F.monotonically_increasing_id()).drop("_salt"), "resample-order")
    part = F.shiftright(F.col("_at"), 33).cast("int")
    before, offsets = 0, {}
    for r in sorted(numbered.groupBy(part.alias("part")).count().collect()):
        offsets[r["part"]] = before
        before += r["count"]
    start = numbered.sparkSession.createDataFrame([(p, n) for p, n in offsets.items()], "_part int, _before long")
    joined = numbered.withColumn("_part", part).join(F.broadcast(start), "_part")  # one row of a range
    return joined.withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_before", "_at")


def resample(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_features, weight and score; ``rank`` for those drawn: floor(percent * N / 100) of the
    N documents with at least ``min_words`` words."""
    prepare(docs.sparkSession)
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    rows = keep(weigh(docs, gain, order, seed), "resample-weights")
    able = F.col("n_words") >= min_words
    n = rows.where(able).count()
    drawn = percent * n // 100
    out = ranked(rows.where(able), [F.col("score").desc(), id_or_least("doc_id"), F.col("weight"), F.col("n_features")], n)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    few = rows.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return out.withColumn("rank", rank).unionByName(few).select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_resampling", r"""
WITH RECURSIVE table_step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM table_step WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS of FROM table_step WHERE k = 8),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, text FROM documents),
words AS (
  SELECT id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM numbered),
targets AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM benchmark),
distinct_words AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM words UNION SELECT x FROM targets)),
coded AS (
  SELECT x, xor(list_reduce([CAST(('0x' || h[2 * i - 1:2 * i]) AS BIGINT) FOR i IN range(1, CAST(length(h) / 2 AS BIGINT) + 1)],
    lambda c, b: xor(c >> 8, of[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM distinct_words, crc),
raw AS (SELECT bucket, count(*) AS s FROM words JOIN coded USING (x) GROUP BY bucket),
aim AS (SELECT bucket, count(*) AS t FROM targets JOIN coded USING (x) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM raw) AS s_all, (SELECT coalesce(sum(t), 0) FROM aim) AS t_all),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM raw LEFT JOIN aim USING (bucket) CROSS JOIN sums),
weights AS (SELECT id, count(*) AS n, sum(g) AS w FROM words JOIN coded USING (x) JOIN gain USING (bucket) GROUP BY id),
noise AS (
  SELECT doc_id, id, CAST(('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8]) AS BIGINT) AS h FROM numbered),
scored AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(w, 0) AS BIGINT) AS weight,
    CAST(coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS BIGINT) AS score
  FROM noise LEFT JOIN weights USING (id)),
drawn AS (
  SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS able_docs FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * able_docs // 100 THEN place END AS rank FROM drawn
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
