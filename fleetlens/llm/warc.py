"""WARC archives: writing, and reading back with boundary-chain verification.

Writing goes through Spark's text writer (a record is a row, the record's closing blank lines are the line
separator), so archives land in whatever store the folder names and a lost task is simply written again.
Of equal payloads of at least ``MIN_REVISIT`` bytes one record is the response and the others revisit it.
Payloads move only where a copy may exist: a bitmap of a fixed size marks hash buckets that hold a repeated
digest, and pages of other buckets go straight to their archive.

Reading splits archives at every occurrence of the record magic, so payloads that contain the magic give
false candidates:

1. each task turns its segments into candidates (offset -> offset of the successor, from Content-Length);
   offsets are prefix sums over segments of a split and over splits of a file;
2. chains are contracted within buckets of a file (candidate -> first offset that it reaches outside);
3. pointer jumping from the start of each file, doubling its reach every round over the contracted edges,
   finds the one entry of each bucket; from it the records of the bucket are marked;
4. only reached records count. One whose payload holds the magic is put together again from its segments,
   by rereading just the files that have such records.

Defined cases: a null payload is empty; a null url is an empty target; line breaks in a url are percent-
encoded; a null page_id gives a record without a number (never referred to); rows that repeat the largest
page_id of a payload are all responses; a file that doesn't start with the magic has no records; reading
stops at the first broken link of a file; an empty table gives no record.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import keep, prepare, table
from fleetlens.llm.registry import query
from fleetlens.session import checkpoint_dir

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
MIN_REVISIT = 1000
#: Bits of the bitmap of repeated digests: 32768 per row, so 256 rows of 4 kB at most are broadcast.
BITMAP_BITS = 1 << 23
#: Bytes of an archive whose chain is contracted in one step.
BUCKET = 1 << 22
DATE = "2024-01-01T00:00:00Z"


def _repeated_buckets(digests: DataFrame) -> DataFrame:
    """(bucket, bits): which hash buckets hold a digest that occurs twice or more."""
    repeated = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    at = F.pmod(F.xxhash64("digest"), F.lit(BITMAP_BITS))
    return repeated.select(F.floor(at / 32768).alias("bucket"), (at % 32768).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"))


def record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload (string), digest, n_bytes, refers_to (null for a response)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"))
    large = base.where(F.col("n_bytes") >= min_revisit)
    marked = F.broadcast(_repeated_buckets(large.select("digest")))
    at = F.pmod(F.xxhash64("digest"), F.lit(BITMAP_BITS))
    byte = F.conv(F.hex(F.substring("bits", (F.floor((at % 32768) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.expr("shiftright(_byte, _bit)").bitwiseAND(F.lit(1)) == 1, F.lit(False)) & (F.col("n_bytes") >= min_revisit)
    tested = (base.join(marked, F.floor(at / 32768) == marked["bucket"], "left").withColumn("_byte", byte)
              .withColumn("_bit", (at % 8).cast("int")).withColumn("_maybe", hit).drop("bucket", "bits", "_byte", "_bit"))
    alone = tested.where(~F.col("_maybe")).drop("_maybe").withColumn("refers_to", F.lit(None).cast("long"))
    first = large.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    shared = tested.where("_maybe").drop("_maybe").join(first, "digest", "left")
    again = shared.withColumn("refers_to", F.when(F.coalesce(F.col("page_id") != F.col("first_id"), F.col("first_id").isNotNull()), F.col("first_id")))
    return alone.unionByName(again.drop("first_id"))


def _record_id(col: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(col.cast("string"), F.lit("")), F.lit(">"))


def records(typed: DataFrame) -> DataFrame:
    """One column ``value``: the record without its closing blank lines."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit(GAP))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("page_id")), F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                                 _record_id(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit(GAP))
    return typed.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    records(record_types(pages, min_revisit)).write.option("lineSep", GAP).text(path)


def segments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, split, at (order within the split), value: what stands between occurrences of the magic."""
    return spark.read.option("lineSep", MAGIC).text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value")


def with_offsets(rows: DataFrame) -> DataFrame:
    """Adds ``offset``, where the segment's magic starts in its file; ``size`` is the segment's bytes.

    A split holds a bounded number of bytes, and a file a bounded number of splits. What precedes the
    first magic of a file gets a negative offset.
    """
    step = F.col("size") + len(MAGIC)
    splits = rows.groupBy("file", "split").agg(F.sum(step).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = splits.select("file", "split", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("local", F.coalesce(F.sum(step).over(inside), F.lit(0)))
    return local.join(base, ["file", "split"]).withColumn("offset", F.col("base") + F.col("local") - len(MAGIC)).drop("base", "local")


def _header(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1), F.lit(""))


def parsed(value: Column, rows: DataFrame) -> DataFrame:
    """Header fields, declared sizes and the payload's checksum of a record that starts at each row."""
    head = F.substring_index(value, GAP, 1)
    out = rows.withColumn("head", head).withColumn("size", F.octet_length(value).cast("long"))
    out = (out.withColumn("head_size", F.octet_length("head").cast("long"))
           .withColumn("block_size", _header("Content-Length").try_cast("long"))
           .withColumn("record_type", _header("WARC-Type")).withColumn("record_id", _header("WARC-Record-ID"))
           .withColumn("refers_to", _header("WARC-Refers-To")).withColumn("target", _header("WARC-Target-URI"))
           .withColumn("declared_digest", F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", "")))
    out = out.withColumn("whole", F.coalesce(F.col("block_size") >= 0, F.lit(False))
                         & (F.col("size") >= F.col("head_size") + len(GAP) + F.col("block_size")))
    block = F.when(F.col("whole"), F.substring(value.cast("binary"), (F.col("head_size") + len(GAP) + 1).cast("int"), F.col("block_size").cast("int")))
    http = F.octet_length(F.substring_index(block.cast("string"), GAP, 1))
    payload = F.substring(block, http + len(GAP) + 1, F.octet_length(block))
    return out.withColumn("payload", payload)


_CANDIDATE = ["file", "offset", "next", "whole", "record_type", "record_id", "refers_to", "target", "declared_digest", "payload_bytes", "payload_digest"]


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per occurrence of the magic, with the offset that its Content-Length leads to."""
    rows = parsed(F.col("value"), segments(spark, path))
    narrow = rows.select("file", "split", "at", "size", "head_size", "block_size", "whole", "record_type", "record_id", "refers_to", "target",
                         "declared_digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    end = F.col("offset") + len(MAGIC) + F.col("head_size") + len(GAP) + F.col("block_size") + len(GAP)
    return with_offsets(keep(narrow, "warc-segments")).where("offset >= 0").withColumn("next", F.when(F.col("block_size") >= 0, end)).select(*_CANDIDATE)


def contract(offsets: list[int], following: list, limit: int) -> list[int]:
    """For ascending candidates of one bucket: the first offset at or beyond ``limit`` each leads to, or -1."""
    out: dict[int, int] = {}
    for o, n in zip(reversed(offsets), reversed(following)):
        out[o] = -1 if n is None or n != n else int(n) if n >= limit else out.get(int(n), -1)
    return [out[o] for o in offsets]


def _contract(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("offset")
    exits = contract(g["offset"].tolist(), g["next"].tolist(), (int(key[1]) + 1) * BUCKET)
    out = pd.DataFrame({"file": g["file"], "offset": g["offset"], "leaves_to": exits})
    return out[out["leaves_to"] >= 0]


def _walk(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    """Marks what the bucket's entry reaches; ``owner`` is the reached record that a segment lies in."""
    g = g.sort_values("offset")
    entry, owners, reached = g["entry"].iloc[0], [], []
    expected, owner = (None if entry != entry else int(entry)), None
    for o, n in zip(g["offset"].tolist(), g["next"].tolist()):
        if expected is not None and o == expected:
            owner, expected = o, (None if n != n else int(n))
            reached.append(True)
        else:
            reached.append(False)
        owners.append(owner)
    return pd.DataFrame({"file": g["file"], "offset": g["offset"], "reached": reached, "owner": pd.array(owners, "Int64")})


def reachable(links: DataFrame) -> DataFrame:
    """(file, offset, next) -> file, offset, reached, owner."""
    links = links.select("file", "offset", "next", F.floor(F.col("offset") / BUCKET).alias("bucket"))
    edges = keep(links.groupBy("file", "bucket").applyInPandas(_contract, "file string, offset long, leaves_to long"), "warc-edges")
    targets = edges.select("file", F.col("leaves_to").alias("offset")).distinct()
    start = links.where("offset = 0").select("file", "offset")
    jump = keep(edges.join(targets.unionByName(start).distinct(), ["file", "offset"], "left_semi"), "warc-jump")
    seen = keep(start, "warc-seen")
    while not jump.isEmpty():  # after k rounds: everything within 2^k links of the start
        ahead = seen.join(jump, ["file", "offset"]).select("file", F.col("leaves_to").alias("offset"))
        seen = keep(seen.unionByName(ahead).distinct(), "warc-seen")
        then = jump.select("file", F.col("offset").alias("leaves_to"), F.col("leaves_to").alias("further"))
        jump = keep(jump.join(then, ["file", "leaves_to"]).select("file", "offset", F.col("further").alias("leaves_to")), "warc-jump")
    entry = seen.select("file", F.floor(F.col("offset") / BUCKET).alias("bucket"), F.col("offset").alias("entry"))
    entered = links.join(entry, ["file", "bucket"], "left")
    marked = keep(entered.groupBy("file", "bucket").applyInPandas(_walk, "file string, offset long, reached boolean, owner long"), "warc-marked")
    # segments at a bucket's beginning belong to the last record of the buckets before
    bucket = F.floor(F.col("offset") / BUCKET)
    last = marked.groupBy("file", bucket.alias("bucket")).agg(F.max("owner").alias("last"))
    before = Window.partitionBy("file").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "bucket", F.max("last").over(before).alias("carried"))
    return (marked.withColumn("bucket", bucket).join(carried, ["file", "bucket"])
            .withColumn("owner", F.coalesce("owner", "carried")).drop("carried", "bucket"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The verified records: record_type, record_id, refers_to, target, declared_digest, payload_bytes, payload_digest."""
    found = keep(candidates(spark, path), "warc-candidates")
    marks = keep(reachable(found), "warc-reached")
    fields = [c for c in _CANDIDATE if c not in ("file", "offset", "next", "whole")]
    chained = found.join(marks.where("reached").select("file", "offset"), ["file", "offset"])
    out = chained.where("whole").select(*fields)
    torn = keep(chained.where("NOT whole").select("file", "offset", "next"), "warc-torn")
    files = [r["file"] for r in torn.select("file").distinct().collect()]
    if not files:
        return out
    inside = marks.join(torn.select("file", F.col("offset").alias("owner"), F.col("next").alias("stop")), ["file", "owner"]).where("offset < stop")
    again = with_offsets(segments(spark, files).withColumn("size", F.octet_length("value").cast("long")))
    parts = again.join(inside.select("file", "offset", "owner"), ["file", "offset"])
    value = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]), MAGIC)
    joined = parts.groupBy("file", "owner").agg(value.alias("value"))
    mended = parsed(F.col("value"), joined).where("whole").withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))
    return out.unionByName(mended.select(*fields))


def resolved(records_: DataFrame) -> DataFrame:
    """Revisits get size and checksum of the payload of the response that they refer to. Only revisits are
    joined, so the null references of all other records don't meet in one partition."""
    full = records_.where("record_type = 'response'").groupBy(F.col("record_id").alias("_id")).agg(
        F.max(F.struct("payload_digest", "payload_bytes")).alias("_full"))
    revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    again = records_.where(revisit).drop("payload_bytes", "payload_digest")
    again = again.join(full, again["refers_to"] == full["_id"], "left").withColumn("payload_bytes", F.col("_full.payload_bytes")).withColumn(
        "payload_digest", F.col("_full.payload_digest"))
    out = records_.where(~revisit).unionByName(again.select(*records_.columns))
    return out.withColumn("digest_ok", F.col("payload_digest") == F.col("declared_digest"))


def page_number(col: str) -> Column:
    return F.regexp_extract(col, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


@query("op1_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM m
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    return resolved(read_archives(spark, path)).select(
        page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_number("refers_to").alias("refers_to"))
