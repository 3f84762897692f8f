"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Tokens: one Arrow pass turns each whole text into ids (BPE words between ASCII white space are
independent, so a worker encodes each distinct word once) and cuts only documents longer than the
capacity. From there on only lengths move.

Packing keeps two sets, the unplaced units and the gaps of open sequences. A round

1. range-sorts units and gaps together by (size, units before gaps, id) - a hot length splits by id;
2. sweeps every range from small to large: a gap takes the largest free unit that precedes it, so each
   gap gets its best fit and no unit is left that a gap of the same range could have held. While the next
   units are small (eight fit in a sequence) and still fit, the gap takes them as well;
3. resolves what ranges leave over by rank: the k-th gap left in a range takes the k-th largest unit left
   in the nearest smaller ranges, or of small units as many in a row as any gap there can hold. Only
   counts and limits of each range come to the driver;
4. updates the gaps and opens new sequences for the largest units left, as many as the volume left over
   makes necessary (at least one when nothing matched).

Rounds go on until every unit is placed, so no gap that could hold a unit is given up.

Each round's state is a written table in the shared checkpoint folder, so a lost executor costs one
round's task at most. Units of up to 32 tokens are first put together in bundles of at most 128, within
their task, which bounds the rounds for tables of tiny documents.

Defined cases: a null text is an empty one and gives the one end id; repeated rows are packed once per
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import (
    MEMO_WORD_BYTES,
    byte_values,
    keep,
    parts_for,
    prepare,
    table,
    worker_memo,
)
from fleetlens.llm.registry import query

CAPACITY = 4096
END_ID = 1
TINY, BUNDLE = 32, 128
ROWS_PER_RANGE = 250_000
#: Words whose ids a Python worker remembers, about 200 bytes each.
MEMO_IDS = 700_000
#: A gap takes several units in one round where so many of them fit in a sequence.
SMALL_FIT = 8
_MARK = b"\x01"

_PIECES = "pid long, doc_id long, piece int, start long, length long, ids_crc32 long, unit long, unit_at long"
_SWEPT = "kind string, part int, idx long, uid long, size long, seq long, free long, room long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_encoder(path: str):
    """bytes of a text -> its ids as little-endian uint32 bytes, without special tokens."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    memo = worker_memo(f"ids:{path}", large=True)
    tools = worker_memo("tokenizers")
    if path not in tools:
        tools[path] = Tokenizer.from_file(path)
    tokenizer = tools[path]
    mark = tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids[0]

    def ids_of(words: list[bytes]) -> dict[bytes, bytes]:
        """Fresh words, encoded together: a mark between them shows where each word's ids end."""
        out = {w: np.array(tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes() for w in words if _MARK in w}
        words = [w for w in words if _MARK not in w]
        for at in range(0, len(words), 500):
            part = words[at:at + 500]
            text = (b" " + _MARK + b" ").join(part).decode("utf-8", "replace")
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts, raw = np.flatnonzero(ids == mark).tolist(), ids.tobytes()
            out.update((w, raw[4 * lo:4 * hi]) for w, lo, hi in zip(part, [0, *(c + 1 for c in cuts)], [*cuts, len(ids)], strict=True))
        return out

    def encode(texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        fresh = list(set().union(*split).difference(memo))
        if not fresh:
            return [b"".join(map(memo.__getitem__, words)) for words in split]
        ids = ids_of(fresh)
        if len(memo) + len(ids) <= MEMO_IDS:
            memo.update((w, x) for w, x in ids.items() if len(w) <= MEMO_WORD_BYTES)
        get = memo.get
        return [b"".join([ids[w] if (x := get(w)) is None else x for w in words]) for words in split]

    return encode


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = id_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 40
        made, bundle, filled = 0, None, 0
        for b in batches:
            texts = byte_values(b.column(1))
            rows = []
            for lo in range(0, len(texts), 100):
                ids = encode(texts[lo:lo + 100])
                for doc_id, x in zip(b.column(0).slice(lo, 100).to_pylist(), ids):
                    x += end
                    for piece, at in enumerate(range(0, len(x), 4 * capacity)):
                        own = x[at:at + 4 * capacity]
                        n, pid = len(own) // 4, base + made
                        made += 1
                        unit, unit_at = pid, 0
                        if n <= TINY:
                            if bundle is None or filled + n > min(BUNDLE, capacity):
                                bundle, filled = pid, 0
                            unit, unit_at = bundle, filled
                            filled += n
                        rows.append((pid, doc_id, piece, at // 4, n, zlib.crc32(own), unit, unit_at))
            cols = list(zip(*rows)) or [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(cols)],
                names=["pid", "doc_id", "piece", "start", "length", "ids_crc32", "unit", "unit_at"])

    return run


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of each document's ids (end id included), as a written table."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keep(narrow.mapInArrow(_cut(tokenizer or default_tokenizer(), capacity, end_id), _PIECES), "pieces")


def sweep(kinds: np.ndarray, sizes: np.ndarray, small: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One range in ascending order: each gap (kind 1) takes the nearest unit (kind 0) before it.

    Further units of at most ``small`` tokens follow into the same gap while they fit. Returns positions of
    matched units, of the gaps that hold them (a gap's units one after the other), of units left and of gaps left.
    """
    units, gaps, stack, left, size = [], [], [], [], sizes.tolist()
    for i, k in enumerate(kinds.tolist()):
        if not k:
            stack.append(i)
        elif stack:
            room, most = size[i], size[i]
            while stack and size[stack[-1]] <= min(room, most):
                units.append(stack.pop())
                gaps.append(i)
                room, most = room - size[units[-1]], small
        else:
            left.append(i)
    return tuple(np.array(x, np.int64) for x in (units, gaps, stack, left))


def _sweep_ranges(small: int):
    """Rows (kind, size, id) of one sorted range -> matched pairs, units left and gaps left.

    ``free`` is a gap's room before the unit, ``room`` what its last unit leaves (null at the others).
    The range's rows are held as numbers: 17 bytes a row, and ranges have a bounded number of rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        kinds, sizes, ids = (t.column(i).to_numpy() for i in range(3))
        part = TaskContext.get().partitionId()
        u, g, open_u, open_g = sweep(kinds, sizes, small)
        open_u = open_u[::-1]  # the largest first
        before = np.cumsum(sizes[u]) - sizes[u]
        first = np.flatnonzero(np.diff(g, prepend=-1))
        before -= np.repeat(before[first], np.diff(first, append=len(g)))
        free = sizes[g] - before
        room = pa.array(free - sizes[u], pa.int64(), mask=np.diff(g, append=-1) == 0)

        def rows(kind, idx, uid, size, seq, free, room=None):
            n = len(idx)
            fill = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(x, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.string()), pa.array(np.full(n, part, np.int32)), pa.array(idx, pa.int64()),
                 fill(uid), fill(size), fill(seq), fill(free), fill(room)],
                names=["kind", "part", "idx", "uid", "size", "seq", "free", "room"])

        yield rows("placed", np.arange(len(u)), ids[u], sizes[u], ids[g], free, room)
        yield rows("unit", np.arange(len(open_u)), ids[open_u], sizes[open_u], None, None)
        yield rows("gap", np.arange(len(open_g)), None, None, ids[open_g], sizes[open_g])

    return run


def across(counts: list[tuple[int, int, int]], times: Callable[[int, int], int] = lambda gap_part, unit_part: 1) -> list[tuple[int, int, int, int, int]]:
    """Matches between ranges. counts: (range, units left, gaps left) in ascending order of size.

    ``times`` tells how many units of a range each gap of another takes. Returns (gap range, first gap,
    unit range, first unit, how many units); units count from the largest.
    """
    out, stack = [], []
    for part, units, gaps in counts:
        at = 0
        while gaps and stack:
            p, first, n = stack.pop()
            m = times(part, p)
            k = min(n, gaps * m)
            out.append((part, at, p, first, k))
            at, gaps = at + -(-k // m), gaps - -(-k // m)
            if n > k:
                stack.append((p, first + k, n - k))
        if units:
            stack.append((part, 0, units))
    return out


def volumes(tally, unit_rows: DataFrame, gaps: DataFrame, crossed: bool) -> tuple[int, int, int]:
    """Tokens of the units left, free room of all gaps, size of the smallest unit left."""
    if not crossed:
        return sum(r["s"] for r in tally), sum(r["f"] + r["pf"] for r in tally), min(r["lo"] for r in tally if r["u"])
    size, least = unit_rows.agg(F.sum("size"), F.min("size")).first()
    return size, gaps.agg(F.coalesce(F.sum("free"), F.lit(0))).first()[0], least


def _spans(rows: list[tuple], schema: str, spark: SparkSession) -> DataFrame:
    """A few rows per range (so bounded by the number of ranges), for a broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def pack(units: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, size) -> (uid, seq, at): the sequence of each unit and its place there, gapless from 0."""
    spark = units.sparkSession
    total, n, big = units.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("size") * 2 > capacity)).first()
    waiting, gaps, placed, next_seq = units.select("uid", "size"), None, [], 0
    want, n_gaps = max(-(-total // capacity), big), 0
    while n:
        rows = waiting.select(F.lit(0).alias("kind"), "size", F.col("uid").alias("id"))
        if gaps is not None:
            rows = rows.unionByName(gaps.select(F.lit(1).alias("kind"), F.col("free").alias("size"), F.col("seq").alias("id")))
        ranges = parts_for(n + n_gaps, ROWS_PER_RANGE)
        # at most ROWS_PER_RANGE rows are one range, which needs no exchange
        dealt = rows.repartitionByRange(ranges, "size", "kind", "id") if ranges > 1 else rows.coalesce(1)
        swept = keep(dealt.sortWithinPartitions("size", "kind", "id")
                     .mapInArrow(_sweep_ranges(capacity // SMALL_FIT), _SWEPT), "swept")
        tally = swept.groupBy("part").agg(
            F.count_if(F.col("kind") == "placed").alias("p"), F.count_if(F.col("kind") == "unit").alias("u"),
            F.count_if(F.col("kind") == "gap").alias("g"), F.coalesce(F.sum(F.when(F.col("kind") == "unit", F.col("size"))), F.lit(0)).alias("s"),
            F.coalesce(F.sum(F.when(F.col("kind") == "gap", F.col("free"))), F.lit(0)).alias("f"),
            F.coalesce(F.sum("room"), F.lit(0)).alias("pf"), F.min(F.when(F.col("kind") == "gap", F.col("free"))).alias("tight"),
            F.max(F.when(F.col("kind") == "unit", F.col("size"))).alias("hi"), F.min(F.when(F.col("kind") == "unit", F.col("size"))).alias("lo"),
        ).orderBy("part").collect()
        hi, tight = ({r["part"]: r[k] for r in tally} for k in ("hi", "tight"))
        times = lambda gp, up: tight[gp] // hi[up] if hi[up] * SMALL_FIT <= capacity else 1
        pairs = across([(r["part"], r["u"], r["g"]) for r in tally], times)
        done = swept.where(F.col("kind") == "placed").select("uid", "size", "seq", "free", "room")
        unit_rows, gap_rows = (swept.where(F.col("kind") == k).drop("kind", "room") for k in ("unit", "gap"))
        if pairs:
            schema = "part int, lo long, hi long, gap_part int, at long, times long"
            by_unit = _spans([(up, uf, uf + k, gp, gf, times(gp, up)) for gp, gf, up, uf, k in pairs], schema, spark)
            by_gap = _spans([(gp, gf, gf + -(-k // times(gp, up)), gp, gf, 1) for gp, gf, up, _, k in pairs], schema, spark)
            on = lambda x, s: (x["part"] == s["part"]) & (x["idx"] >= s["lo"]) & (x["idx"] < s["hi"])
            spot = [F.col("gap_part").alias("gp"), F.expr("at + (idx - lo) div times").alias("gi")]
            u2 = unit_rows.join(by_unit, on(unit_rows, by_unit), "left").select("uid", "size", unit_rows["part"].alias("part"), "idx", *spot)
            g2 = gap_rows.join(by_gap, on(gap_rows, by_gap), "left").select("seq", "free", *spot)
            met = u2.where(F.col("gp").isNotNull()).join(g2.where(F.col("gp").isNotNull()), ["gp", "gi"])
            if any(times(gp, up) > 1 for gp, _, up, _, _ in pairs):
                in_gap = Window.partitionBy("gp", "gi").orderBy("idx")
                before = F.coalesce(F.sum("size").over(in_gap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                met = met.withColumn("free", F.col("free") - before).withColumn("more", F.lead("idx").over(in_gap).isNotNull())
            else:
                met = met.withColumn("more", F.lit(False))
            room = F.when(~F.col("more"), F.col("free") - F.col("size"))
            done = keep(done.unionByName(met.select("uid", "size", "seq", "free", room.alias("room"))), "met")
            unit_rows = u2.where(F.col("gp").isNull()).select("part", "idx", "uid", "size")
            gap_rows = g2.where(F.col("gp").isNull()).select("seq", "free")
        crossed = {}
        for _, _, up, _, k in pairs:
            crossed[up] = crossed.get(up, 0) + k
        matched = sum(r["p"] for r in tally) + sum(crossed.values())
        n_left = n - matched
        placed.append(done.select("uid", "seq", (F.lit(capacity) - F.col("free")).alias("at")))
        gaps_now = gap_rows.select("seq", "free").unionByName(
            done.select("seq", F.col("room").alias("free"))).where(F.col("free") > 0)
        opened = 0
        if n_left:
            # what no open gap can hold; at first, every unit over half a sequence too
            size_left, free_left, least = volumes(tally, unit_rows, gaps_now, bool(pairs))
            need = -(-max(size_left - free_left, 0) // capacity)
            opened = min(n_left, want if want else max(need, 0 if matched else 1))
            want = 0
        if opened:
            # ranks from the largest unit down: ranges in descending order, then idx
            shift, ranks = 0, []
            for r in reversed(tally):
                ranks.append((r["part"], shift - crossed.get(r["part"], 0)))
                shift += r["u"] - crossed.get(r["part"], 0)
            ranked = unit_rows.join(_spans(ranks, "part int, before long", spark), "part").withColumn("rank", F.col("before") + F.col("idx"))
            new = ranked.where(F.col("rank") < opened).select("uid", "size", (F.col("rank") + next_seq).alias("seq"))
            placed.append(new.select("uid", "seq", F.lit(0).cast("long").alias("at")))
            gaps_now = gaps_now.unionByName(new.select("seq", (F.lit(capacity) - F.col("size")).alias("free")).where(F.col("free") > 0))
            waiting = ranked.where(F.col("rank") >= opened).select("uid", "size")
            next_seq += opened
        else:
            waiting = unit_rows.select("uid", "size")
        n = n_left - opened
        if n:
            gaps = keep(gaps_now.where(F.col("free") >= least), "gaps")
            n_gaps = gaps.count()  # open ones: full sequences need no range
    if not placed:
        return units.select("uid", F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("at"))
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def packed_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece with its ids' checksum, its sequence and its place there."""
    prepare(docs.sparkSession)
    pieces = token_pieces(docs, tokenizer, capacity, end_id)
    units = pieces.groupBy(F.col("unit").alias("uid")).agg(F.sum("length").alias("size"))
    spots = pack(keep(units, "units"), capacity)
    return pieces.join(spots, pieces["unit"] == spots["uid"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"),
        (F.col("at") + F.col("unit_at")).alias("offset"))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))
