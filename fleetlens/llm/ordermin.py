"""Document fingerprints by Order MinHash, in DataFrame functions alone (no Python workers).

* A text is cut into tokens that cover it whole: at most ``TOKEN`` non-space characters with the space after them, or
  a space alone. Its k-mers are all runs of ``K`` tokens (those at the end are shorter); each is numbered by its occurrence in
  the text, so that repeats count.
* In each of ``GROUPS`` hash orders, ``SLOTS`` evenly spaced starting points select the ``TUPLE`` minimal k-mers at or
  after the point (the order is a circle, so short texts fill every slot as well). The selected k-mers are put back into
  their order in the text, and the tuple's hash is one part of the signature. Likeness is the share of equal parts: a
  moved or changed passage breaks tuples of k-mers that it parts or reorders, so likeness follows edit distance, not
  only the set of k-mers.
* All steps are sorts of one text's numbers and index look-ups (occurrences and starting points by binary search),
  so a text costs n log n and nothing of it is shuffled.
* Neighbours: documents are dealt into ranges of about ``ROWS_PER_RANGE`` rows of the order (doc_id, text's hash) and a
  window gives each its successor; whole texts are shuffled once. The last row of each range is settled afterwards
  against the first of the next. The bounds of ranges (at most ``MAX_RANGES`` keys) pass the driver.

Defined cases: a null text is an empty one; an empty text has a constant fingerprint, equal to other empty texts'; a null
doc_id comes before all others; documents with the same doc_id follow each other by their text's hash, repeated rows
directly after each other; the only document of a table is its own successor; an empty table gives an empty result; other
columns are ignored; a very long text takes arrays of its own size in one row, as any row must fit its task.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import id_or_least, keep, parts_for, prepare, table
from fleetlens.llm.registry import query

K, TUPLE, GROUPS, SLOTS, TOKEN = 2, 2, 2, 32, 16
ROWS_PER_RANGE, MAX_RANGES = 500, 50_000
#: Numbers of a k-mer pack its hash (upper 33 bits) and its place in the text (lower 31 bits).
_PLACE = (1 << 31) - 1
_EMPTY = 0xFFFF


def _search(n: Column, bits: Column, fits) -> Column:
    """Largest x in 0..n with fits(x), where fits holds up to some x: one binary digit after another."""
    def step(x, b):
        y = x + b
        return F.when((y <= n) & fits(y), y).otherwise(x)

    return F.aggregate(bits, F.lit(0), step)


def _digits(n: Column) -> Column:
    """Powers of two that make up the numbers to n, from the largest."""
    return F.transform(F.sequence(F.floor(F.log2(n + 1)).cast("int"), F.lit(0), F.lit(-1)), lambda e: F.call_function("shiftleft", F.lit(1), e))


def _kmer_hash(tokens: Column, first: Column, at: Column) -> Column:
    return F.xxhash64(first, *(F.get(tokens, at + d) for d in range(1, K)))


def with_signatures(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``df`` with a signature (array of numbers below 65536) for each text column: {text column: signature column}.

    The columns are built step by step, as a step's array is looked up inside the next one's lambdas.
    """
    kept = df.columns
    hash_of = lambda v: F.shiftright(v, 31)
    place_of = lambda v: v.bitwiseAND(F.lit(_PLACE))
    pack = lambda h, place: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long"))
    names = [(t, f"_{i}_signature_step") for i, t in enumerate(texts)]
    pattern = f"[^\\x20\\x09-\\x0D]{{1,{TOKEN}}}[\\x20\\x09-\\x0D]?|[\\x20\\x09-\\x0D]"
    out = df.withColumns({f"{s}_w": F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(pattern), F.lit(0)) for t, s in names})

    def kmers(s):
        return F.sort_array(F.transform(f"{s}_w", lambda x, i: pack(_kmer_hash(F.col(f"{s}_w"), x, i), i)))

    def numbered(s):
        p, bits = F.col(f"{s}_p"), F.col(f"{s}_b")

        def one(x, i):  # equal k-mers stand side by side in text order: the occurrence is how far back they reach
            same = lambda y: hash_of(F.get(p, i - y)) == hash_of(x)
            back = F.when(same(F.lit(2)), _search(i, bits, same)).otherwise(F.lit(1))
            occurrence = F.when((i > 0) & same(F.lit(1)), back).otherwise(F.lit(0))
            return pack(F.xxhash64(hash_of(x), occurrence.cast("long")), place_of(x))

        return F.transform(p, one)

    def in_order(s, g):
        return F.sort_array(F.transform(f"{s}_o", lambda v: pack(F.xxhash64(hash_of(v), F.lit(g).cast("long")), place_of(v))))

    def firsts(s, g):
        h, bits = F.col(f"{s}_h{g}"), F.col(f"{s}_b")
        starts = F.array(*(F.lit(-(1 << 63) + j * ((1 << 64) // SLOTS)) for j in range(SLOTS)))
        return F.transform(starts, lambda start: _search(F.size(h), bits, lambda y: F.get(h, y - 1) < start))

    def parts(s, g):
        h = F.col(f"{s}_h{g}")
        n = F.size(h)
        in_text = lambda v: F.shiftleft(v, 33).bitwiseOR(F.shiftrightunsigned(v, 31))  # noqa: E731  the place leads

        def part(first):
            chosen = F.sort_array(F.array(*(in_text(F.get(h, (first + e) % n)) for e in range(TUPLE))))
            return F.xxhash64(F.transform(chosen, lambda v: v.bitwiseAND(F.lit((1 << 33) - 1)))).bitwiseAND(F.lit(0xFFFF)).cast("int")

        return F.when(n > 0, F.transform(firsts(s, g), part)).otherwise(F.array_repeat(F.lit(_EMPTY), SLOTS))

    out = out.withColumns({f"{s}_p": kmers(s) for _, s in names} | {f"{s}_b": _digits(F.size(f"{s}_w")) for _, s in names})
    out = out.withColumns({f"{s}_o": numbered(s) for _, s in names})
    out = out.withColumns({f"{s}_h{g}": in_order(s, g) for _, s in names for g in range(GROUPS)})
    out = out.withColumns({texts[t]: F.concat(*(parts(s, g) for g in range(GROUPS))) for t, s in names})
    return out.select(*kept, *texts.values())


def as_text(signature: str | Column) -> Column:
    """A signature as a string of four hex digits a part."""
    return F.array_join(F.transform(signature, lambda v: F.lpad(F.lower(F.hex(v)), 4, "0")), "")


def likeness(a: str | Column, b: str | Column) -> Column:
    """Share of equal parts of two signatures."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(GROUPS * SLOTS))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``signature`` and its string form ``fingerprint``."""
    prepare(docs.sparkSession)
    out = with_signatures(docs.drop("signature", "fingerprint"), {text: "signature"})
    return out.withColumn("fingerprint", as_text("signature"))


def _bounds(keys: DataFrame, ranges: int) -> list[tuple[int, int, int]]:
    """The least key of each range but the first."""
    least = keys.repartitionByRange(ranges, *keys.columns).groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*keys.columns)).alias("key"))
    return sorted(tuple(r["key"]) for r in least.collect())[1:]


def in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, _id, _tie, _salt, _range) dealt by range of (doc_id, text's hash), and the number of ranges."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # the salt parts rows that are equal; which of them comes first makes no difference
    keys = {"_id": id_or_least("doc_id"), "_tie": F.xxhash64("text"), "_salt": F.monotonically_increasing_id()}
    n = docs.count()
    ranges = parts_for(n, max(ROWS_PER_RANGE, n // MAX_RANGES))
    bounds = _bounds(rows.select(*(c.alias(k) for k, c in keys.items())), ranges) if ranges > 1 else []
    held = F.from_json(F.lit(json.dumps([dict(zip(keys, b)) for b in bounds])), "array<struct<_id:bigint,_tie:bigint,_salt:bigint>>")
    digits = F.array(*(F.lit(1 << b) for b in reversed(range(max(1, len(bounds).bit_length())))))
    here = F.struct(*keys)
    rows = rows.withColumns(keys)
    if bounds:
        rows = rows.withColumn("_range", _search(F.lit(len(bounds)), digits, lambda y: F.get(held, y - 1) <= here))
    else:
        rows = rows.withColumn("_range", F.lit(0))
    return rows.repartition(ranges, "_range"), ranges


def _edit(df: DataFrame) -> DataFrame:
    """``edited``: the last half of ``text`` replaced by as much of the start of ``next_text``."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return df.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))


def with_successors(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, signature, edited_sha256, edited_signature and next_signature (that of the next document).

    The edited text is the text with its last half replaced by the start of the next document, so it lies half the
    text away by edits.
    """
    prepare(docs.sparkSession)
    rows, _ = in_ranges(docs)
    order = Window.partitionBy("_range").orderBy("_id", "_tie", "_salt")
    edges = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("first", F.row_number().over(order) == 1)
    edges = edges.withColumn("n_chars", F.length("text").cast("long")).withColumn("last", F.col("next_text").isNull())
    signed = with_signatures(_edit(edges), {"text": "signature", "edited": "edited_signature"})
    signed = signed.select("doc_id", "_range", "_id", "_tie", "_salt", "n_chars", "first", "last", "signature", "edited_signature",
                           F.sha2("edited", 256).alias("edited_sha256"), F.when(F.col("first") | F.col("last"), F.col("text")).alias("edge_text"))
    done = keep(signed.withColumn("next_signature", F.lead("signature").over(order)).drop("_id", "_tie", "_salt"), "signatures")
    columns = ["doc_id", "n_chars", "signature", "edited_sha256", "edited_signature", "next_signature"]
    return done.where(~F.col("last")).select(*columns).unionByName(_across(done).select(*columns))


def _across(done: DataFrame) -> DataFrame:
    """The last row of each range, with the first row of the next range that holds rows as its successor."""
    held = sorted(r[0] for r in done.where("first").select("_range").collect())  # one number of a range
    follows = done.sparkSession.createDataFrame([(a, b) for a, b in zip(held, held[1:] + held[:1])], "_range int, _next int")
    heads = done.where("first").select(F.col("_range").alias("_next"), F.col("edge_text").alias("next_text"), F.col("signature").alias("next_signature"))
    lasts = done.where("last").select("_range", "doc_id", "n_chars", "signature", F.col("edge_text").alias("text"))
    pairs = _edit(lasts.join(F.broadcast(follows), "_range").join(heads, "_next"))
    return with_signatures(pairs, {"edited": "edited_signature"}).withColumn("edited_sha256", F.sha2("edited", 256))


@query("op12_fingerprints")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_successors(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", as_text("signature").alias("fingerprint"), as_text("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"), likeness("signature", "next_signature").alias("near_next"))
