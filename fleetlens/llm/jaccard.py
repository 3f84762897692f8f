"""Similarity join on word 5-grams (Jaccard >= 0.8) with Bayesian candidate pruning.

1. Every text gives its set of 5-word shingles (shorter texts: one shingle of all words), 128 MinHash values
   and 32 bands of 4 of them. Texts with equal sets are one node that counts its copies. A pair at similarity
   0.8 shares no band with probability 5e-8.
2. Buckets (texts that share a band) are linked up, not paired up: leaders are picked, and a text is linked
   to each leader that the Bayesian test can't rule out at 0.5. Two texts at 0.8 are then linked through a
   leader, since a text is within 0.2 of its leader; a bucket gives fewer links than it has texts. Buckets
   beyond ``BUCKET_ROWS`` are dealt to salted tasks, whose leaders are linked in a second step at 0.3.
3. Connected components of these links hold all similar pairs. Large components are cut into blocks, and
   each pair of blocks is a task of bounded size: MinHash values are compared 16 at a time, a pair is dropped
   as soon as the posterior probability of reaching 0.8 (uniform prior) falls below 1e-6, and what remains is
   verified exactly on the shingles. Tasks return each text's number of links and a spanning forest, so no
   row is made per pair.
4. The components of the exact links are the classes.

Defined cases: a text without a word (or null) has no shingle: a class of its own, no links; a null doc_id
counts as smaller than any other and is returned as null; repeated rows are copies of each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from fleetlens.llm.common import NULL_ID, byte_values, discard, free_names, id_or_least, keep, map_whole, mix, own_columns, prepare, table, window_hashes, word_hashes, worker_memo
from fleetlens.llm.components import components
from fleetlens.llm.registry import query

SHINGLE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BUCKET_ROWS = 4096
BLOCK = 256


def shingles(text: bytes) -> np.ndarray:
    """Distinct hashes of the text's 5-word shingles, sorted."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words, worker_memo("word hashes", large=True)), min(SHINGLE, len(words)), seed=min(len(words), SHINGLE) % SHINGLE))


def _factors() -> np.ndarray:
    memo = worker_memo("minhash factors")
    if HASHES not in memo:
        memo[HASHES] = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
    return memo[HASHES]


def minhash(s: np.ndarray) -> np.ndarray:
    """Least 32-bit value of the shingles under each of HASHES multiplicative hashes."""
    f, out = _factors()[:, None], None
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 2048):
            low = ((s[at:at + 2048][None, :] * f) >> np.uint64(32)).min(axis=1)
            out = low if out is None else np.minimum(out, low)
    return out.astype(np.uint32)


def band_keys(m: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    with np.errstate(over="ignore"):
        k = np.arange(1, BANDS + 1, dtype=np.uint64)
        for j in range(ROWS):
            k = mix(k * np.uint64(0x9E3779B97F4A7C15) + m[j::ROWS][:BANDS].astype(np.uint64))
    return k.view(np.int64)


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For 16, 32, ... compared values: the fewest matches at which a pair still has a chance.

    Posterior of the similarity after c matches of n: Beta(c + 1, n - c + 1); the tail above the threshold
    is integrated numerically.
    """
    memo, key = worker_memo("least matches"), (threshold, tolerance, HASHES, STEP)
    if key in memo:
        return memo[key]
    x = (np.arange(20000) + 0.5) / 20000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for c in range(n + 1):
            log = c * np.log(x) + (n - c) * np.log1p(-x)
            p = np.exp(log - log.max())
            if p[x >= threshold].sum() >= tolerance * p.sum():
                break
        out.append(c)
    memo[key] = tuple(out)
    return memo[key]


def survivors(one: np.ndarray, many: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``many`` that incremental comparison with ``one`` doesn't rule out, and their matches."""
    alive, matches = np.arange(len(many)), np.zeros(len(many), np.int64)
    for at, least in zip(range(0, HASHES, STEP), least_matches(threshold)):
        matches = matches + (many[alive, at:at + STEP] == one[at:at + STEP]).sum(axis=1)
        ok = matches >= least
        if not ok.all():
            alive, matches = alive[ok], matches[ok]
        if not len(alive):
            break
    return alive, matches


class Union:
    """Disjoint sets over positions."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def link_up(signs: np.ndarray, threshold: float) -> tuple[list[tuple[int, int]], list[int]]:
    """Links (positions) that connect all similar members of a bucket, and the leaders."""
    n = len(signs)
    free, links, leaders, sets = np.ones(n, bool), [], [], Union(n)
    for i in range(n):
        if not free[i]:
            continue
        leaders.append(i)
        near, matches = survivors(signs[i], signs, threshold)
        free[near[matches >= 0.85 * HASHES]] = False
        for j in near.tolist():
            if j != i and sets.join(i, j):
                links.append((i, j))
    return links, leaders


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sid, sign, bands = [], [], []
        for t in byte_values(b.column(1)):
            s = shingles(t)
            if len(s):
                m = minhash(s)
                sid.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sign.append(m.astype(np.uint16).tobytes())
                bands.append(band_keys(m))
            else:
                sid.append(None)
                sign.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sid, pa.binary()), pa.array(sign, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                         names=["did", "sid", "sign", "bands"])


def _groups(batches: Iterator[pa.RecordBatch], width: int):
    """(key, rows) of a partition sorted by its first ``width`` columns; one group is held at a time."""
    key, rows = None, []
    for b in batches:
        for r in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
            if r[:width] != key:
                if rows:
                    yield key, rows
                key, rows = r[:width], []
            rows.append(r[width:])
    if rows:
        yield key, rows


def _matrix(signs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signs), np.uint16).reshape(-1, HASHES)


def _link_buckets(threshold: float):
    """Rows (key, salt, salts, node, sign) -> links (a, b), and the leaders (a, key) of salted buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (key, _, salts), rows in _groups(batches, 3):
            if len(rows) == 1 and salts == 1:
                continue
            links, leaders = link_up(_matrix([r[1] for r in rows]), threshold)
            out += [(rows[i][0], rows[j][0], None) for i, j in links]
            if salts > 1:
                out += [(rows[i][0], None, key) for i in leaders]
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "key"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "key"])

    return run


def verify(sets: list[np.ndarray], signs: np.ndarray, copies: list[int], left: int, threshold: float, ratio: tuple[int, int]):
    """Exact links among the members, or (if ``left``) between the first ``left`` members and the rest.

    Returns each member's number of linked documents and a spanning forest. ratio: the threshold as a fraction.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    codes = [codes[e - k:e] for e, k in zip(ends, sizes)]
    marked, counts, forest, tree = np.zeros(max(len(c) and c.max() for c in codes) + 1, bool), np.zeros(n, np.int64), Union(n), []
    weight = np.array(copies, np.int64)
    for i in range(left or n):
        lo = left or i + 1
        near = lo + survivors(signs[i], signs[lo:], threshold)[0]
        near = near[np.minimum(sizes[near], sizes[i]) * ratio[1] >= np.maximum(sizes[near], sizes[i]) * ratio[0]]
        if not len(near):
            continue
        marked[codes[i]] = True
        common = np.array([np.count_nonzero(marked[codes[j]]) for j in near])
        marked[codes[i]] = False
        linked = near[common * ratio[1] >= ratio[0] * (sizes[near] + sizes[i] - common)]
        counts[i] += weight[linked].sum()
        counts[linked] += weight[i]
        tree += [(i, j) for j in linked.tolist() if forest.join(i, j)]
    return counts, tree


def _verify_blocks(threshold: float, ratio: tuple[int, int]):
    """Rows (root, i, j, side, node, copies, sid, sign, text) -> (node, links, null) and (a, null, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in _groups(batches, 3):
            seen: dict = {}
            for side, node, copies, sid, sign, text in rows:
                if node not in seen:
                    s = shingles((text or "").encode())
                    if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == sid:  # rows may share an id
                        seen[node] = (side, copies, sign, s)
            if len(seen) < 2:
                continue
            nodes = sorted(seen, key=lambda x: seen[x][0])
            left = 0 if i == j else sum(seen[x][0] == 0 for x in nodes)
            if i != j and left in (0, len(nodes)):
                continue
            counts, tree = verify([seen[x][3] for x in nodes], _matrix([seen[x][2] for x in nodes]), [seen[x][1] for x in nodes], left, threshold, ratio)
            out = [(nodes[x], int(c), None) for x, c in enumerate(counts.tolist()) if c] + [(nodes[a], None, nodes[b]) for a, b in tree]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "links", "b"])

    return run


def set_classes(docs: DataFrame, threshold: float = 0.8, ratio: tuple[int, int] = (4, 5)) -> tuple[DataFrame, DataFrame]:
    """A table of rows (did, sid) and, per distinct set sid, its class.

    The second holds sid, first_did (smallest id with this set), class_did (smallest id of the class), head
    (whether this set stands for its class) and n_links. Texts without a word have no sid.
    """
    prepare(docs.sparkSession)
    rows = docs.select(id_or_least(F.col("doc_id").cast("long")).alias("did"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    described = keep(rows.mapInArrow(_describe, "did long, sid binary, sign binary, bands array<long>"), "join-texts")
    distinct = described.where(F.col("sid").isNotNull()).groupBy("sid").agg(F.min(F.struct("did", "sign", "bands")).alias("x"), F.count(F.lit(1)).alias("copies"))
    nodes = keep(distinct.select(F.monotonically_increasing_id().alias("node"), "sid", "copies", "x.did", "x.sign", "x.bands"), "join-nodes")

    member = nodes.select("node", F.explode("bands").alias("key"))
    shared = member.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("salts"))
    bucketed = member.join(shared, "key").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    signed = bucketed.join(nodes.select("node", "sign"), "node").select("key", "salt", "salts", "node", "sign")
    linked = keep(signed.repartition("key", "salt").sortWithinPartitions("key", "salt", "node").mapInArrow(_link_buckets(0.5), "a long, b long, key long"), "join-links")
    leaders = linked.where(F.col("key").isNotNull()).select("key", F.col("a").alias("node")).join(nodes.select("node", "sign"), "node")
    across = leaders.select("key", F.lit(0).alias("salt"), F.lit(1).alias("salts"), "node", "sign").repartition("key").sortWithinPartitions(
        "key", "node").mapInArrow(_link_buckets(0.3), "a long, b long, key long")
    rough = components(linked.where(F.col("b").isNotNull()).unionByName(across).select("a", "b"), "join-rough")

    cuts = rough.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("cuts"))
    placed = rough.join(cuts, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    texts = nodes.drop("bands").join(placed, "node").join(rows, "did")
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    dealt = texts.withColumn("other", other).select(
        "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node", "copies", "sid", "sign", "text")
    exact = keep(dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "node").mapInArrow(
        _verify_blocks(threshold, ratio), "a long, links long, b long"), "join-exact")
    discard(linked)
    counts = exact.where(F.col("links").isNotNull()).groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(exact.where(F.col("b").isNotNull()).select("a", "b"), "join-classes")

    known = nodes.select("node", "sid", "copies", "did").join(classes, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min(F.struct("did", "sid")).alias("first"))
    per_set = known.join(least, "root").select(F.col("sid"), F.col("did").alias("first_did"), F.col("first.did").alias("class_did"), (F.col("sid") == F.col("first.sid")).alias("head"),
                                               (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return described.select("did", "sid"), per_set


def similar_classes(docs: DataFrame, threshold: float = 0.8, ratio: tuple[int, int] = (4, 5)) -> DataFrame:
    """Per input row: doc_id, class_id (smallest doc_id of its class), n_links (documents at the threshold
    or above, copies included), first_copy (smallest doc_id with the same shingles)."""
    described, per_set = set_classes(docs, threshold, ratio)
    out = described.join(per_set, "sid", "left")
    shown = lambda c: F.nullif(c, F.lit(NULL_ID))
    return out.select(shown(F.col("did")).alias("doc_id"), shown(F.coalesce("class_did", "did")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), shown(F.coalesce("first_did", "did")).alias("first_copy"))


def one_of_each(docs: DataFrame, threshold: float = 0.8, ratio: tuple[int, int] = (4, 5)) -> DataFrame:
    """The documents without all but the first (by doc_id) of each class; texts without a word all stay."""
    _, per_set = set_classes(docs, threshold, ratio)
    sid, head, cls = free_names(docs, "_sid", "_head", "_class")
    heads = per_set.where("head").select(F.col("sid").alias(head), F.col("class_did").alias(cls))
    at = docs.columns.index("text")

    def add_sid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in byte_values(b.column(at))]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(digests, pa.binary())], names=[*b.schema.names, sid])

    named = map_whole(docs, add_sid, (StructField(sid, BinaryType()),))
    worded = named.where(F.col(sid).isNotNull())
    kept = worded.join(heads, (F.col(sid) == F.col(head)) & (id_or_least(F.col("doc_id").cast("long")) == F.col(cls)))
    # repeated rows of a kept document are copies of it; rows of a set are together after the join
    kept = kept.dropDuplicates([sid, cls])
    return kept.select(*own_columns(docs)).unionByName(named.where(F.col(sid).isNull()).select(*own_columns(docs)))


@query("op8_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[s:s + 4], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS s FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 5 * c.c >= 4 * (x.n + y.n - c.c)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a),
k AS (SELECT doc_id, min(other) AS class_id FROM r GROUP BY doc_id),
s AS (SELECT doc_id, md5(string_agg(k, '' ORDER BY k)) AS h FROM g GROUP BY doc_id),
f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS first_copy FROM s)
SELECT k.doc_id, k.class_id, CAST((SELECT count(*) FROM l WHERE l.a = k.doc_id) AS BIGINT) AS n_links, coalesce(f.first_copy, k.doc_id) AS first_copy
FROM k LEFT JOIN f ON f.doc_id = k.doc_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents"))
