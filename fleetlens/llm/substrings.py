"""Removal of passages that an earlier document already has, by suffix automata of reference shards.

A window is ``window`` consecutive words. It is redundant where its word sequence also starts in a document
with a smaller doc_id; every word that a redundant window covers is removed.

1. Exact copies (equal word sequences) are settled by their checksum; only one text of each goes on.
2. Anchors: each window is represented by its minimizer, the smallest hash among its k-word grams. Equal
   windows have equal minimizers, so only windows whose minimizer occurs in two documents can be redundant.
   Minimizers are counted with map-side combining, so a passage that a third of all documents hold is one
   row per task before the shuffle.
3. Reference shards: the owner of an anchor is the smallest doc_id that has it. An owner's passages form its
   shard, and documents are streamed against the suffix automaton of exactly the shards whose anchors they
   hold: the matching statistics give, for each word, the longest match that ends there, and spans of at
   least ``window`` words are removed. An automaton never goes to documents that can't match it (a broadcast
   of all automata would have no size bound); where many documents meet one shard, its passages are copied
   to as many salted tasks as needed.
4. Windows that share an anchor with their owner, but not the whole sequence, remain. They go through step 2
   and 3 once more with the whole window as anchor, which leaves none: the result is exact.

Only documents with a shared anchor have their text moved. Words are compared as such; hashes only route.

Defined cases: a null or empty text has no words; a null doc_id counts as smaller than any other; rows that
share a doc_id are parts of one document and don't remove each other's words; a repeated row gives its row
again; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import (
    byte_values,
    discard,
    free_names,
    id_or_least,
    keep,
    own_columns,
    prepare,
    table,
    window_hashes,
    word_hashes,
    worker_memo,
)
from fleetlens.llm.registry import query

WINDOW, GRAM = 50, 25
#: Anchors of candidates that one salted copy of a shard takes.
SHARD_ROWS = 20_000


def minimizers(words: list[bytes], window: int, gram: int) -> np.ndarray:
    """For each window start: the smallest hash among the window's grams (as signed longs)."""
    if len(words) < window:
        return np.empty(0, np.int64)
    low = window_hashes(word_hashes(words, worker_memo("word hashes", large=True)), gram)
    span, have = window - gram + 1, 1
    while have < span:  # minima over 1, 2, 4, ... grams, then exactly over span
        step = min(have, span - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    return low.view(np.int64)


class SuffixAutomaton:
    """Suffix automaton of word sequences; each sequence is closed by a symbol of its own."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0
        self.sequences = 0

    def add(self, words: list) -> None:
        for w in words:
            self._extend(w)
        self._extend(self.sequences)  # an int: equal to no word
        self.sequences += 1

    def _extend(self, w) -> None:
        nxt, link, length = self.next, self.link, self.length
        cur, p = len(nxt), self.last
        nxt.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self.last = cur

    def statistics(self, words: list) -> list[int]:
        """For each word, the length of the longest match that ends with it."""
        nxt, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            state = nxt[state].get(w, 0)
            n = n + 1 if state else 0
            out.append(n)
        return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """[from, to) of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _describe(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha, anchors = [], [], []
            for t in byte_values(b.column(2)):
                words = t.split()
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                anchors.append(np.unique(minimizers(words, window, gram)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(anchors, pa.list_(pa.int64()))],
                names=["did", "sign", "n_words", "sha", "anchors"])

    return run


def _anchors_of(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(minimizers(t.split(), window, gram)) for t in byte_values(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["did", "anchors"])

    return run


def _passages(window: int, gram: int):
    """Rows of text with their anchors' owners -> passages: as reference (side 0) and as candidates (side 1)."""
    kind = pa.schema([("owner", pa.int64()), ("salt", pa.int32()), ("side", pa.int32()), ("did", pa.int64()), ("sign", pa.int64()),
                      ("base", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            texts = byte_values(col["text"])
            for i, (did, sign, base) in enumerate(zip(col["did"].to_pylist(), col["sign"].to_pylist(), col["base"].to_pylist())):
                words = texts[i].split()
                m = minimizers(words, window, gram)
                rows = []
                own = np.array(col["owned"][i].as_py() or [], np.int64)
                for lo, hi in runs(np.isin(m, own)):
                    text = b" ".join(words[lo:hi + window - 1]).decode("utf-8", "replace")
                    rows += [(did, s, 0, did, sign, base + lo, text) for s in range(col["owned_salts"][i].as_py())]
                asked = sorted((x["h"], x["owner"], x["salts"]) for x in (col["asked"][i].as_py() or []))
                if asked and len(m):
                    keys = np.array([x[0] for x in asked], np.int64)
                    at = np.minimum(np.searchsorted(keys, m), len(keys) - 1)
                    who = np.where(keys[at] == m, np.array([x[1] for x in asked], np.int64)[at], np.int64(did))
                    salts = {x[1]: x[2] for x in asked}
                    for owner in np.unique(who).tolist():
                        if owner != did:
                            salt = sign % salts[owner]
                            rows += [(owner, salt, 1, did, sign, base + lo, b" ".join(words[lo:hi + window - 1]).decode("utf-8", "replace"))
                                     for lo, hi in runs(who == owner)]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in rows], kind)

    return run


def _match(window: int):
    """Sorted passages of whole shards -> removed spans (rest null) and passages that still have open windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, None
        for b in batches:
            out = []
            c = [b.column(i).to_pylist() for i in range(6)]
            for owner, salt, side, did, sign, base, text in zip(*c, byte_values(b.column(6))):
                if (owner, salt) != shard:
                    shard, automaton = (owner, salt), SuffixAutomaton()
                words = text.split()
                if side == 0:
                    automaton.add(words)
                    continue
                matched = np.array(automaton.statistics(words)[window - 1:]) >= window
                out += [(did, sign, base + lo, base + hi + window - 1, None) for lo, hi in runs(matched)]
                out += [(did, sign, base + lo, base + hi + window - 1, b" ".join(words[lo:hi + window - 1]).decode("utf-8", "replace"))
                        for lo, hi in runs(~matched)]
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in cols[:4]), pa.array(cols[4], pa.string())],
                                                 names=["did", "sign", "lo", "hi", "rest"])

    return run


_SPANS = "did long, sign long, lo long, hi long, rest string"


def _round(anchored: DataFrame, source: DataFrame, window: int, gram: int, name: str) -> tuple[DataFrame, DataFrame]:
    """One round: anchored (did, anchors) gives the owners, source (did, sign, base, text) the passages.

    Returns the spans table (see ``_match``) and the table of texts that hold a candidate.
    """
    pairs = anchored.select("did", F.explode("anchors").alias("h"))
    owners = pairs.groupBy("h").agg(F.min("did").alias("owner"), F.max("did").alias("last")).where("owner < last").select("h", "owner")
    asked = keep(pairs.join(owners, "h").where("did <> owner"), f"{name}-asked")
    salts = asked.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("salts"))
    asking = asked.join(salts, "owner").groupBy("did").agg(F.collect_list(F.struct("h", "owner", "salts")).alias("asked"))
    owning = asked.select("owner", "h").distinct().groupBy("owner").agg(F.collect_list("h").alias("owned")).join(salts, "owner").select(
        F.col("owner").alias("did"), "owned", F.col("salts").alias("owned_salts"))
    involved = keep(source.join(asking.join(owning, "did", "full"), "did"), f"{name}-texts")
    passages = involved.select("did", "sign", "base", "text", "asked", "owned", "owned_salts").mapInArrow(
        _passages(window, gram), "owner long, salt int, side int, did long, sign long, base long, text string")
    key = ["owner", "salt"]
    spans = keep(passages.repartition(*key).sortWithinPartitions(*key, "side", "did", "base").mapInArrow(_match(window), _SPANS), f"{name}-spans")
    discard(asked)
    return spans, involved


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        removed, sha, texts = [], [], []
        for t, spans in zip(byte_values(b.column(2)), b.column(3).to_pylist()):
            words = t.split()
            edge = np.zeros(len(words) + 1, np.int64)
            for s in spans:
                edge[s["lo"]] += 1
                edge[s["hi"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            text = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(text).hexdigest())
            texts.append(text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(texts, pa.string())],
                                         names=["did", "sign", "n_removed", "kept_sha256", "kept_text"])


def keys() -> list[Column]:
    """did and sign, which name a row's text: the doc_id and a hash of the text."""
    return [id_or_least(F.col("doc_id").cast("long")).alias("did"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("sign")]


def redundant(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """What to remove. Returns

    * a table with a row per input row: did, sign, n_words, sha, copied (an exact copy of an earlier document
      with at least ``window`` words: all of it goes);
    * did, sign, n_removed, kept_sha256, kept_text for the other texts that lose some words.
    """
    prepare(docs.sparkSession)
    rows = docs.select(*keys(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    described = keep(rows.mapInArrow(_describe(window, gram), "did long, sign long, n_words long, sha string, anchors array<long>"), "dedup-texts")
    first = described.where(F.col("n_words") >= window).groupBy("sha").agg(F.min("did").alias("first_did"))
    judged = described.join(first, "sha", "left").withColumn("copied", F.coalesce(F.col("first_did") < F.col("did"), F.lit(False)))
    originals = judged.where(~F.col("copied") & (F.col("n_words") >= window)).select("did", "anchors")
    spans, involved = _round(originals, rows.withColumn("base", F.lit(0).cast("long")), window, gram, "dedup-1")
    rest = spans.where(F.col("rest").isNotNull()).select("did", "sign", F.col("lo").alias("base"), F.col("rest").alias("text"))
    again, texts = _round(rest.select("did", "text").mapInArrow(_anchors_of(window, window), "did long, anchors array<long>"), rest, window, window, "dedup-2")
    discard(texts)
    cut = spans.unionByName(again).where(F.col("rest").isNull()).groupBy("did", "sign").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    losing = involved.where(F.col("asked").isNotNull()).select("did", "sign", "text").dropDuplicates(["did", "sign"]).join(cut, ["did", "sign"])
    changed = losing.mapInArrow(_remove, "did long, sign long, n_removed long, kept_sha256 string, kept_text string")
    return judged.select("did", "sign", "n_words", "sha", "copied"), changed


def removal_digest(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256."""
    judged, changed = redundant(docs, window, gram)
    nothing = hashlib.sha256(b"").hexdigest()
    out = judged.join(changed.drop("kept_text"), ["did", "sign"], "left")
    return out.select(
        F.nullif(F.col("did"), F.lit(-(2 ** 63))).alias("doc_id"), "n_words",
        F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copied"), F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def without_redundant(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents with redundant words removed (kept words joined by one space, n_chars renewed where the
    column exists). Texts that lose nothing stay as they are; documents that lose every word go."""
    judged, changed = redundant(docs, window, gram)
    did, sign, kept, row_did, row_sign = free_names(docs, "_did", "_sign", "_kept", "_row_did", "_row_sign")
    copied = judged.where("copied").select(F.col("did").alias(did), F.col("sign").alias(sign)).distinct()
    new = changed.select(F.col("did").alias(did), F.col("sign").alias(sign), F.col("kept_text").alias(kept)).unionByName(
        copied.withColumn(kept, F.lit("")))
    named = docs.withColumns(dict(zip((row_did, row_sign), keys())))
    out = named.join(new, (F.col(row_did) == F.col(did)) & (F.col(row_sign) == F.col(sign)), "left")
    out = out.where(F.col(kept).isNull() | (F.col(kept) != "")).withColumn("text", F.coalesce(kept, "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(kept).isNotNull(), F.length(kept).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*own_columns(docs))


@query("op5_substring_dedup", r"""
WITH w AS (
  SELECT doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS ws FROM documents),
h AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM w WHERE len(ws) >= 50)),
f AS (SELECT k, min(doc_id) AS first_id FROM h GROUP BY k),
g AS (
  SELECT doc_id, list(DISTINCT p) AS gone
  FROM (SELECT doc_id, unnest(range(s, s + 50)) AS p FROM h JOIN f USING (k) WHERE doc_id > first_id) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string([x for x, i in ws if gone IS NULL OR NOT list_contains(gone, i)], ' '), '')) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(table(spark, sf_dir, "documents"))
