"""Quality classifier from weak labels.

1. Heuristic labellers each vote good, bad or abstain on a document, from shares of its text: marks, case and
   repetition, alone and in combination. They overlap, and none of them is trusted.
2. Votes are counted per pattern over all documents (at most 3^labellers patterns, pre-aggregated per task).
   Expectation-maximisation over the patterns estimates each labeller's behaviour on good and bad documents
   and the posterior of every pattern; no true label is read.
3. A linear scorer on hashed features of word shapes learns the posteriors (logistic loss). It is fitted on
   at most ``TRAIN_DOCS`` documents (the documented bound), those with the smallest hash of their id, taken
   evenly from patterns that lean to good and to bad.
4. Every document is scored over its whole text in one Arrow pass; the model is bounded by ``DIMS``.

Defined cases: a null or empty text has no word, gets score 0 and is rejected; repeated rows are scored
once per row; where no text has a word, there is nothing to learn and texts score 0.5 (kept); rows with
a null doc_id are scored but not learned from; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import MEMO_WORD_BYTES, byte_values, keep, map_whole, prepare, table, worker_memo
from fleetlens.llm.registry import query

TRAIN_DOCS = 4000
DIMS = 1 << 13
#: Documents whose score is below this are rejected.
LEAST_SCORE = 0.5
#: Labellers abstain on texts with fewer words, and scores of short texts are drawn to the share of good texts:
#: the scorer's logit counts n, the prior's counts FEW_WORDS.
FEW_WORDS = 8
#: Words whose facts a Python worker remembers, about 130 bytes each.
MEMO_FACTS = 700_000
GOOD, BAD, ABSTAIN = "1", "0", "-"

#: Shares of a text: at most the first is ordinary, at least the second is junk, between them unclear.
SHARES = {
    "symbols": (0.005, 0.03),
    "odd_ends": (0.02, 0.20),
    "unlettered": (0.08, 0.15),
    "bare_marks": (0.02, 0.15),
    "capitals": (0.10, 0.40),
    "shouts": (0.01, 0.20),
    "repeats": (0.05, 0.25),
    "few_distinct": (0.55, 0.80),
    "same_lines": (0.25, 0.50),
}
_MARKS, _CASE, _REPETITION = ("symbols", "odd_ends", "unlettered", "bare_marks"), ("capitals", "shouts"), ("repeats", "few_distinct", "same_lines")
#: Labellers and the shares they look at: bad if any is junk, good if all known ones are ordinary, else no vote.
LABELLERS = (_MARKS, _CASE, _REPETITION, _MARKS + _CASE, _CASE + _REPETITION, _MARKS + _REPETITION, _MARKS + _CASE + _REPETITION)
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\r\n\x0b\x0c"
_LATER_BYTES = bytes(range(0x80, 0xC0))
_ASCII_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
#: What an ordinary word may end with besides letters and digits.
_ENDS = ".,;:?!)]}'\"\u2019\u201d\u00bb\u2026"
#: Words of a stretch in which repeated words are counted.
STRETCH = 100
_REPEATS, _AGAIN, _CONSTANT = DIMS - 64, DIMS - 63, DIMS - 62


def _shape(word: str) -> str:
    """Letters as a or A, digits as 0, other characters as they are; runs collapsed."""
    out, last = [], ""
    for c in word:
        s = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if s != last:
            out.append(s)
            last = s
    return "".join(out[:12])


def _word_facts(word: bytes) -> int:
    """Hashed shape, and above it: shouts, bare mark, odd end, number of capitals."""
    s = word.decode("utf-8", "replace")
    core = s.rstrip(".,;:?!")
    if core.isalpha() and (core.islower() or core[1:].islower()):  # most words: letters, then marks
        capitals = int(not core.islower())
        tails, tail = worker_memo("word ends"), s[len(core):]
        if tail not in tails and len(tails) < 10_000:
            tails[tail] = _shape(tail)
        shape = ("a" if not capitals else "Aa" if len(core) > 1 else "A") + (tails[tail] if tail in tails else _shape(tail))
        bare = False
    else:
        capitals, shape, bare = sum(c.isupper() for c in s), _shape(s), not any(c.isalnum() for c in s)
    shouts = word.endswith(b"!!")
    odd = shouts or not (s[-1].isalnum() or s[-1] in _ENDS)
    return zlib.crc32(shape.encode()) % (DIMS - 64) | shouts << 16 | bare << 17 | odd << 18 | capitals << 20


def _facts(words: list[bytes]) -> np.ndarray:
    memo = worker_memo("word shapes", large=True)
    try:
        return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
    except KeyError:
        own = {w: _word_facts(w) for w in set(words).difference(memo)}
        if len(memo) + len(own) <= MEMO_FACTS:
            memo.update((w, f) for w, f in own.items() if len(w) <= MEMO_WORD_BYTES)
        return np.array([own[w] if (f := memo.get(w)) is None else f for w in words], np.int64)


def examine(text: bytes) -> tuple[str, np.ndarray | None]:
    """The labellers' votes and the feature vector of a text; no vector without a word."""
    words = text.split()
    n = len(words)
    if not n:
        return ABSTAIN * len(LABELLERS), None
    facts = _facts(words)
    chars = len(text.translate(None, _SPACE + _LATER_BYTES))
    marks = len(text) - len(text.translate(None, _ASCII_MARKS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    # distinct words within stretches, so that a long text isn't taken for a repetitive one
    distinct = sum(len(set(words[i:i + STRETCH])) for i in range(0, n, STRETCH))
    shares = {
        "symbols": (len(text) - len(text.translate(None, _SYMBOLS))) / chars,
        "odd_ends": (facts >> 18 & 1).sum() / n,
        "unlettered": marks / chars,
        "capitals": (facts >> 20).sum() / max(chars - marks, 1),
        "repeats": same / n,
        "shouts": (facts >> 16 & 1).sum() / n,
        "bare_marks": (facts >> 17 & 1).sum() / n,
        "few_distinct": 1 - distinct / n if n >= 20 else None,
        "same_lines": 1 - len(set(lines)) / len(lines) if len(lines) >= 4 else None,
    }
    shares = shares if n >= FEW_WORDS else {}
    seen = {k: 0 if x <= SHARES[k][0] else 2 if x >= SHARES[k][1] else 1 for k, x in shares.items() if x is not None}
    worst = [max((seen[k] for k in keys if k in seen), default=1) for keys in LABELLERS]
    votes = "".join((GOOD, ABSTAIN, BAD)[w] for w in worst)
    counts = np.bincount(facts & 0xFFFF, minlength=DIMS).astype(np.float32)
    counts[_REPEATS] = same
    counts[_AGAIN] = n - distinct if n >= 20 else 0
    x = np.sqrt(counts / np.float32(n))
    x[_CONSTANT] = 1.0
    return votes, x


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([examine(t)[0] for t in byte_values(b.column(1))], pa.string())], names=["h", "votes"])


def posteriors(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """Probability of good for each vote pattern, by expectation-maximisation over labeller accuracies.

    A labeller that votes says good with one probability on good documents and with another on bad ones (with
    pseudo-counts); labellers are independent given the class and no worse than a coin, and an abstention says nothing. Starts from the
    share of good votes, which also fixes what good means.
    """
    keys = sorted(patterns)
    if not keys:
        return {}
    weight = np.array([patterns[k] for k in keys], np.float64)
    cast = np.array([[[c == GOOD, c == BAD] for c in k] for k in keys], np.float64)  # pattern x labeller x vote
    q = (1 + cast[:, :, 0].sum(1)) / (2 + cast[:, :, 0].sum(1) + 3 * cast[:, :, 1].sum(1))
    for _ in range(rounds):
        prior = ((weight * q).sum() + 1) / (weight.sum() + 2)
        log = []
        for w, lean in ((weight * q, (4.0, 1.0)), (weight * (1 - q), (1.0, 4.0))):
            t = np.einsum("p,plv->lv", w, cast) + np.array(lean)
            says = t / t.sum(axis=1, keepdims=True)
            # a labeller is no worse than a coin on either class, so good and bad can't change places
            own = 0 if lean[0] > lean[1] else 1
            says[:, own] = np.maximum(says[:, own], 0.5)
            says[:, 1 - own] = 1 - says[:, own]
            log.append(np.einsum("plv,lv->p", cast, np.log(np.maximum(says, 1e-9))))
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0] + np.log((1 - prior) / prior), -500, 500)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return dict(zip(keys, new.tolist()))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, values, votes = [], [], []
        for t in byte_values(b.column(0)):
            v, x = examine(t)
            if x is not None:
                k = np.flatnonzero(x).astype(np.int32)
                votes.append(v)
                at.append(k.tobytes())
                values.append(x[k].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(votes, pa.string()), pa.array(at, pa.binary()), pa.array(values, pa.binary())], names=["votes", "at", "x"])


def train_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], steps: int = 400, rate: float = 1.0, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by full gradients with momentum; sparse rows (places, values, target)."""
    w = np.zeros(DIMS)
    if not rows:
        return w
    at = np.concatenate([r[0] for r in rows])
    x = np.concatenate([r[1] for r in rows]).astype(np.float64)
    ends = np.cumsum([len(r[0]) for r in rows])
    first = ends - np.array([len(r[0]) for r in rows])
    row = np.repeat(np.arange(len(rows)), ends - first)
    target = np.array([r[2] for r in rows])
    share = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1))
    velocity = np.zeros(DIMS)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(w[at] * x, first), -50, 50)))
        gradient = np.bincount(at, x * ((p - target) * share)[row], minlength=DIMS) + decay * w
        velocity = 0.9 * velocity - rate * gradient
        w += velocity
    return w


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, float, dict[str, float]]:
    """The scorer's weights, the logit of the share of good documents, and the posterior of each vote pattern."""
    spark = prepare(docs.sparkSession)
    usable = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "text")
    voted = keep(usable.mapInArrow(_vote, "h long, votes string"), "weak-votes")
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the number of patterns
    belief = posteriors({r["votes"]: r["n"] for r in patterns if set(r["votes"]) != {ABSTAIN}})
    if not belief:
        return np.zeros(DIMS), 0.0, belief
    count = {r["votes"]: r["n"] for r in patterns}
    good = sum(count[v] * q for v, q in belief.items())
    prior = float(np.log((good + 1) / (sum(count[v] for v in belief) - good + 1)))
    sides = F.broadcast(spark.createDataFrame([(v, q >= 0.5) for v, q in belief.items()], "votes string, good boolean"))
    # a threshold on the hash leaves about twice the sample of each side, so no task ranks all documents
    n_good = sum(count[v] for v, q in belief.items() if q >= 0.5)
    share = [min(1.0, (train_docs + 100) / max(n, 1)) for n in (n_good, sum(count[v] for v in belief) - n_good)]
    part = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    order = Window.partitionBy("good").orderBy(part, "h")
    few = voted.join(sides, "votes").where(part <= F.when(F.col("good"), F.lit(share[0])).otherwise(F.lit(share[1])))
    chosen = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= train_docs // 2).select("h").distinct()
    sample = usable.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"])  # at most train_docs hashes
    rows = sorted((r["at"], r["x"], belief.get(r["votes"], 0.5)) for r in sample.select("text").mapInArrow(_features, "votes string, at binary, x binary").collect())
    return train_scorer([(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32), y) for a, x, y in rows]), prior, belief


def score_texts(weights: np.ndarray, prior: float, texts: list[bytes]) -> tuple[list[float], list[str]]:
    """Scores and votes. prior: logit of the share of good texts, all that is known of a text of no words."""
    scores, votes = [], []
    for t in texts:
        v, x = examine(t)
        if x is None:
            scores.append(0.0)
        else:
            trust = (n := len(t.split())) / (n + FEW_WORDS)
            scores.append(float(1 / (1 + np.exp(-np.clip(trust * (x @ weights) + (1 - trust) * prior, -50, 50)))))
        votes.append(v)
    return scores, votes


def classify(docs: DataFrame, weights: np.ndarray, prior: float, belief: dict[str, float], least: float = LEAST_SCORE) -> DataFrame:
    """doc_id, votes, weak_label (posterior, null without any vote), score and kept for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), prior, belief))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, p, known = shared.value
        for b in batches:
            scores, votes = score_texts(w, p, byte_values(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(votes, pa.string()), pa.array([known.get(v) for v in votes], pa.float64()),
                                              pa.array(scores, pa.float64())], names=["doc_id", "votes", "weak_label", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, votes string, weak_label double, score double").withColumn("kept", F.col("score") >= least)


def keep_good(docs: DataFrame, weights: np.ndarray, prior: float, least: float = LEAST_SCORE) -> DataFrame:
    """The documents that the classifier keeps; all columns stay."""
    shared, at = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), prior)), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores, _ = score_texts(*m, byte_values(b.column(at)))
            yield b.filter(pa.array([s >= least for s in scores], pa.bool_()))

    return map_whole(docs, run)


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, *train(docs))
