"""Language identification in two levels: family first, then one-versus-one linear SVMs inside it.

Features are relative frequencies (square roots, so every vector has length 1) of hashed letter 1- to
3-grams of the whole lower-cased text; everything that is no letter counts as a space. A one-versus-rest
SVM per family picks the family; within it each pair of languages has an SVM and the votes decide (ties:
the sum of margins, then the name). All documents are scored in one Arrow pass without a shuffle.

Learning uses at most ``PER_LANGUAGE`` labelled documents of each language, those with the smallest
hash of their id (the documented bound of the sample); each is used whole. Languages join a family by
the table of fixed values or, where they aren't in it, the family whose profile is most similar.

Defined cases: a null text and a text without a letter give ``und`` with score 0; without any learned
language every document does; with one learned language it is the only answer; a null lang is never
learned; repeated rows are scored once per row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import byte_values, map_whole, prepare, table, worker_memo
from fleetlens.llm.registry import query

PER_LANGUAGE = 300
DIMS = 1 << 14
BLOCK = 1 << 20
#: Margins are turned into scores between 0 and 1 by a logistic function with this slope.
SLOPE = 4.0
UNDETERMINED = "und"
#: A filter lets go what is less certain.
LEAST_SCORE = 0.25

# FIXED VALUES: language families of common language codes.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tk"),
    "indo-aryan": ("hi", "ur", "bn", "pa", "mr", "gu", "ne", "si"),
    "semitic": ("ar", "he", "am", "mt"),
    "sinitic": ("zh", "yue", "wuu"),
}


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter (filled once per worker)."""
    memo = worker_memo("letters")
    if "is" not in memo:
        memo["is"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return memo["is"]


def features(text: bytes) -> np.ndarray | None:
    """Feature vector of a text; None without a letter. Long texts are counted block by block."""
    s = text.decode("utf-8", "replace").lower()
    is_letter, total = _letters(), np.zeros(DIMS, np.float64)
    for at in range(0, len(s), BLOCK):
        c = np.frombuffer(s[max(0, at - 2):at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        own = 2 if at else 0
        c[~is_letter[c]] = 32
        letter = c != 32
        if not letter.any():
            continue
        with np.errstate(over="ignore"):
            one = c * np.uint32(2654435761)
            two = (c[:-1] * np.uint32(40503) + c[1:]) * np.uint32(2246822519)
            three = ((c[:-2] * np.uint32(40503) + c[1:-1]) * np.uint32(40503) + c[2:]) * np.uint32(3266489917)
        one, two, three = one[own:][letter[own:]], two[max(own - 1, 0):], three
        mid = letter[max(own - 1, 0):]
        two = two[mid[:-1] | mid[1:]] if len(mid) > 1 else two[:0]
        three = three[letter[:-2] | letter[1:-1] | letter[2:]] if len(letter) > 2 else three[:0]
        idx = np.concatenate([one, two, three]) >> np.uint32(18)
        total += np.bincount(idx.astype(np.int64), minlength=DIMS)
    n = total.sum()
    return np.sqrt(total / n).astype(np.float32) if n else None


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, at, values = [], [], []
        for lang, t in zip(b.column(0).to_pylist(), byte_values(b.column(1))):
            x = features(t)
            if x is not None:
                k = np.flatnonzero(x).astype(np.int32)
                langs.append(lang)
                at.append(k.tobytes())
                values.append(x[k].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(at, pa.binary()), pa.array(values, pa.binary())],
                                         names=["lang", "at", "x"])


def examples(docs: DataFrame, learnable, per_language: int = PER_LANGUAGE) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, feature places, values) of the bounded sample. ``learnable``: condition on doc_id."""
    ids = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learnable).select("doc_id", "lang")
    h = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30))
    sizes = ids.groupBy("lang").count().collect()  # a row per language
    if not sizes:
        return []
    # a threshold on the hash leaves about twice the sample, so no task ranks all documents of a language
    limit = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, (2 * per_language + 50) / r["count"]) * (1 << 30)))])
    few = ids.withColumn("_h", h).where(F.col("_h") <= limit[F.col("lang")])
    w = Window.partitionBy("lang").orderBy("_h", "doc_id")
    picked = few.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= per_language).select("doc_id").distinct()
    # the picked ids are bounded by per_language x languages
    sample = docs.where(F.col("lang").isNotNull() & learnable).select("doc_id", "lang", "text").join(F.broadcast(picked), "doc_id", "left_semi")
    rows = sample.select("lang", "text").mapInArrow(_example_rows, "lang string, at binary, x binary").orderBy("lang", F.md5("x")).collect()
    return [(r["lang"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32)) for r in rows]


def train_svm(gram: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Dual coordinate descent for the L1-loss linear SVM; returns alpha * y. gram: inner products."""
    n = len(y)
    weight = np.where(y > 0, c * n / (2 * max((y > 0).sum(), 1)), c * n / (2 * max((y < 0).sum(), 1)))
    alpha, margin = np.zeros(n), np.zeros(n)
    diagonal = np.maximum(gram.diagonal(), 1e-12)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(n):
            new = min(max(alpha[i] - (y[i] * margin[i] - 1) / diagonal[i], 0.0), weight[i])
            step = (new - alpha[i]) * y[i]
            if step:
                margin += step * gram[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return alpha * y


def families_of(profiles: dict[str, np.ndarray]) -> dict[str, str]:
    """Language -> family: by the fixed table, else the family with the most similar mean profile."""
    known = {code: name for name, codes in FAMILIES.items() for code in codes}
    out = {lang: known[key] for lang in profiles if (key := lang.lower().replace("_", "-").split("-")[0]) in known}
    if not out:
        return {lang: "all" for lang in profiles}
    means = {f: np.mean([profiles[x] for x in out if out[x] == f], axis=0) for f in set(out.values())}
    for lang, p in profiles.items():
        if lang not in out:
            out[lang] = max(sorted(means), key=lambda f: float(means[f] @ p))
    return out


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> dict:
    """The model: families, their one-versus-rest weights and, inside each, one-versus-one weights."""
    langs = sorted({r[0] for r in rows})
    n = len(rows)
    x = np.zeros((n, DIMS), np.float32)
    for i, (_, at, v) in enumerate(rows):
        x[i, at] = v
    gram = (x @ x.T).astype(np.float64)
    own = np.array([langs.index(r[0]) for r in rows], np.int64)
    family = families_of({lang: x[own == i].mean(axis=0) for i, lang in enumerate(langs)})
    names = sorted(set(family.values()))
    of = np.array([names.index(family[lang]) for lang in langs], np.int64)
    columns, pairs = [], []
    if len(names) > 1:
        for f in range(len(names)):
            columns.append(train_svm(gram, np.where(of[own] == f, 1.0, -1.0)) @ x)
    for f in range(len(names)):
        inside = [i for i in range(len(langs)) if of[i] == f]
        for a_at, a in enumerate(inside):
            for b in inside[a_at + 1:]:
                rows_ab = np.flatnonzero((own == a) | (own == b))
                y = np.where(own[rows_ab] == a, 1.0, -1.0)
                pairs.append((a, b))
                columns.append(train_svm(gram[np.ix_(rows_ab, rows_ab)], y) @ x[rows_ab])
    w = np.array(columns, np.float32).T if columns else np.zeros((DIMS, 0), np.float32)
    return {"langs": langs, "families": len(names), "family_of": of.tolist(), "pairs": pairs, "weights": w}


def decide(model: dict, margins: np.ndarray) -> tuple[str, float]:
    """Language and score from one document's margins: family first, then the pairs inside it."""
    langs, k = model["langs"], model["families"]
    first = k if k > 1 else 0
    f, score = 0, 1.0
    if k > 1:
        f = int(np.argmax(margins[:k]))
        score = 1 / (1 + np.exp(-SLOPE * min(max(float(margins[f]), -50), 50)))
    inside = [i for i in range(len(langs)) if model["family_of"][i] == f]
    if len(inside) == 1:
        return langs[inside[0]], float(score)
    votes, total, least = {i: 0 for i in inside}, {i: 0.0 for i in inside}, {i: np.inf for i in inside}
    for (a, b), m in zip(model["pairs"], margins[first:]):
        if a in votes:
            m = float(m)
            votes[a if m >= 0 else b] += 1
            for i, own in ((a, m), (b, -m)):
                total[i] += own
                least[i] = min(least[i], own)
    best = min(inside, key=lambda i: (-votes[i], -total[i], langs[i]))
    return langs[best], float(score / (1 + np.exp(-SLOPE * min(max(least[best], -50), 50))))


def predict_texts(model: dict, texts: list[bytes]) -> tuple[list[str], list[float]]:
    found, scores = [], []
    for t in texts:
        x = features(t) if model["langs"] else None
        lang, score = (UNDETERMINED, 0.0) if x is None else decide(model, x @ model["weights"])
        found.append(lang)
        scores.append(score)
    return found, scores


def train(docs: DataFrame, learnable=None, per_language: int = PER_LANGUAGE) -> dict:
    prepare(docs.sparkSession)
    return fit(examples(docs, F.lit(True) if learnable is None else learnable, per_language))


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score for every row. The model's size is bounded by DIMS and its languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found, scores = predict_texts(m, byte_values(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict, least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is determined with at least ``least``; all columns stay."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found, scores = predict_texts(m, byte_values(b.column(at)))
            yield b.filter(pa.array([x != UNDETERMINED and s >= least for x, s in zip(found, scores)], pa.bool_()))

    return map_whole(docs, run)


def remainder(col: str, m: int):
    """crc32 of the id's text, mod m; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % m


def held_out(doc_id, m: int = 4, r: int = 2) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m == r


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, remainder("doc_id", 4) != 2)
    return predict(docs, model).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
