"""Conversation structure repair by a rank-convergence parallel Viterbi search.

Rows of a conversation, by turn, are brought into the order (s)(ua)+ of role initials (or to nothing) by the cheapest
edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only edit of blank and duplicate rows), Insert an empty user
or assistant row 2; a truncated row that isn't deleted costs 1 more. Of equally cheap audits the ASCII-least wins.

* Rows are sorted by range of (conversation, turn), so a range, and with it a chunk (the rows of a conversation in one
  range), is bounded by rows whatever the conversations are. A chunk's rows become one letter each.
* The search runs from the end: for each row the cheapest cost to finish from each of the four states. Every chunk starts at once from
  a speculative cost vector (as if the conversation ended there); vectors of the possible starts are carried along until they
  differ only by constants, from where on the speculative costs are right whatever follows. Boundary vectors are
  stitched from the last chunk to the first; where a vector never converges (say, a chunk of blank rows), the carried vectors are the
  chunk's cost matrix, so stitching never takes more than one sweep over a conversation's chunks.
* Fix-up: a chunk whose true boundary vector isn't parallel to the speculative one is rerun from its end until the rerun's vector
  and the stored one differ only by a constant; the rows before keep their costs.
* Least audit: forward, each state takes the least letter among the edits that the stitched costs allow. Chunks give their exit state
  for every entry state, entry states are stitched, then each chunk writes its part of the audit.
* Costs are differences within a vector, so few vectors exist; a row's step is a look-up in a memo.

The repaired text's SHA-256 is sequential by definition: rows of one conversation are streamed, sorted, through one
task that holds one row, one chunk's audit and the hash state. Everything else is bounded by rows of a range.

Defined cases: nulls count as one space (a null turn comes first and takes no part in gaps; a null conv_id is a conversation);
rows of one turn are ordered by role, the text's first 32 characters, then its SHA-256; repeated rows are rows of
their own (a duplicate from the second on); a conversation without rows has zeros, an empty audit and the hash of the empty
string; an empty table gives an empty result; very long texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import keep, parts_for, prepare, table
from fleetlens.llm.registry import query

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
#: Rows of a range (and so of a chunk), and most ranges of a table.
ROWS_PER_RANGE, MAX_RANGES = 4000, 50_000
#: States: start, after system, after user, after assistant. The state after an inserted or reroled row, by state before.
TURN_TO = (2, 2, 3, 2)
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
#: Letters of rows: the initial (o: any other), in upper case for truncated rows; x: blank or duplicate.
MUST_GO = "x"
FAR = 1 << 40
SPACES = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def _inserts(costs: list[int]) -> list[int]:
    """Costs once empty rows may be inserted first."""
    out = list(costs)
    for _ in range(3):
        out = [min(c, INSERT + out[t]) for c, t in zip(costs, TURN_TO)]
    return out


def _level(costs: list[int]) -> Vector:
    """The vector up to a constant."""
    least = min(costs)
    return tuple(min(c - least, FAR) if c < FAR else FAR for c in costs)


#: Cost to finish from each state when no row is left, and the vectors of a single possible state.
END: Vector = _level(_inserts([0, FAR, FAR, 0]))
SINGLE: tuple[Vector, ...] = tuple(_level(_inserts([0 if q == j else FAR for q in range(4)])) for j in range(4))


def _options(code: str, q: int, after: Vector) -> Iterator[tuple[str, int, int]]:
    """(edit, state after, cost to finish) of the edits that use up the row, in the order of their letters."""
    yield "D", q, DELETE + after[q]
    if code != MUST_GO:
        short = CUT_SHORT if code.isupper() else 0
        own = NEXT[code.lower()].get(q)
        if own is not None:
            yield "K", own, KEEP + short + after[own]
        yield "R", TURN_TO[q], REROLE + short + after[TURN_TO[q]]


class Search:
    """Steps of the search with memos: vectors before a row, and the edits that the costs choose."""

    def __init__(self) -> None:
        self.before: dict = {}
        self.chosen: dict = {}

    def costs(self, after: Vector, code: str) -> tuple[Vector, int]:
        """The vector before a row and the constant taken off it."""
        got = self.before.get((after, code))
        if got is None:
            all_costs = _inserts([min(c for _, _, c in _options(code, q, after)) for q in range(4)])
            got = self.before[(after, code)] = (_level(all_costs), min(all_costs))
        return got

    def vectors(self, codes: str, last: Vector) -> list[Vector]:
        """The vector after each row; the one before the first row comes at the end."""
        out, v, costs = [last], last, self.costs
        for c in reversed(codes):
            v = costs(v, c)[0]
            out.append(v)
        out.reverse()
        return out[1:] + out[:1]

    def converge(self, codes: str) -> tuple[Vector, list[list[int]] | None]:
        """Speculative vector before the chunk; None if it is right whatever follows, else the chunk's cost matrix."""
        v, tracks, shifts = END, list(SINGLE), [0] * 4
        for c in reversed(codes):
            v = self.costs(v, c)[0]
            if tracks:
                steps = [self.costs(t, c) for t in tracks]
                tracks, shifts = [t for t, _ in steps], [s + d for s, (_, d) in zip(shifts, steps)]
                if len(set(tracks)) == 1:
                    tracks = []
        return v, [[min(x + s, FAR) for x in t] for t, s in zip(tracks, shifts)] if tracks else None

    def rerun(self, codes: str, vectors: list[Vector], last: Vector) -> list[Vector]:
        """``vectors`` of the speculation, run again from the chunk's end with its true vector until both are parallel."""
        out, v = list(vectors), last
        for i in range(len(codes) - 1, -1, -1):
            if out[i] == v:
                return out
            out[i] = v
            v = self.costs(v, codes[i])[0]
        out[-1] = v
        return out

    def edits(self, after: Vector, code: str, q: int) -> tuple[str, int, int]:
        """Least cheapest edits from state q through a row: letters, state after, their cost."""
        got = self.chosen.get((after, code, q))
        if got is None:
            costs = _inserts([min(c for _, _, c in _options(code, s, after)) for s in range(4)])
            letters, at, paid = "", q, 0
            while not letters or letters[-1] == "I":
                options = sorted([*_options(code, at, after), ("I", TURN_TO[at], INSERT + costs[TURN_TO[at]])])
                edit, to, _ = next(o for o in options if o[2] == costs[at])
                paid += {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[edit] + (CUT_SHORT if edit in "KR" and code.isupper() else 0)
                letters, at = letters + edit, to
            got = self.chosen[(after, code, q)] = (letters, at, paid)
        return got

    def audit(self, codes: str, vectors: list[Vector], q: int, ends: bool) -> tuple[str, int, int]:
        """Audit of a chunk from state q, its exit state and cost; ``ends``: the conversation ends with it."""
        out, paid = [], 0
        for c, after in zip(codes, vectors):
            letters, q, cost = self.edits(after, c, q)
            out.append(letters)
            paid += cost
        while ends and q in (1, 2):
            out.append("I")
            q, paid = TURN_TO[q], paid + INSERT
        return "".join(out), q, paid


def through(matrix: list[list[int]], last: Vector) -> Vector:
    """The vector before a chunk from its cost matrix and the vector after it."""
    return _level([min(matrix[j][q] + last[j] for j in range(4)) for q in range(4)])


# the rows ------------------------------------------------------------------------------------------------

_EVENT = "part long, rid long, first boolean, conv_id long, turn long, initial string, blank boolean, cut boolean, dropped boolean"
_CHUNK = ("rid long, part long, conv_id long, edge boolean, codes string, n_turns long, low long, high long, head long, tail long, "
          "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation and turn, written in ranges; ``rid``'s upper bits number the range, the lower ones the row in it."""
    rows = rows.withColumn("_salt", F.monotonically_increasing_id())  # equal rows may be parted
    order = ["conv_id", "turn", "role", "_lead", "digest", "_salt"]
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("_lead", F.substring("text", 1, 32))
    n = rows.count()
    ranges = parts_for(n, max(ROWS_PER_RANGE, n // MAX_RANGES))
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("rid", F.monotonically_increasing_id())
    return keep(rows.select("rid", "conv_id", "turn", "role", "text", "digest", "dropped"), "conversation-rows")


def _events(rows: DataFrame) -> DataFrame:
    """Narrow rows, each first of its (conversation, role, text) with a mark before it, by range."""
    stripped = F.rtrim("text", F.lit(SPACES))
    facts = rows.select("rid", F.lit(False).alias("first"), "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), (stripped == "").alias("blank"),
                        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"), "dropped")
    firsts = rows.where(~F.col("dropped")).groupBy("conv_id", "role", "digest").agg(F.min("rid").alias("rid")).select("rid", F.lit(True).alias("first"))
    both = facts.unionByName(firsts, allowMissingColumns=True)
    return both.withColumn("part", F.shiftright("rid", 33)).select(*(c.split()[0] for c in _EVENT.split(", ")))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted events -> one row per conversation and range, with a letter for each of its rows."""
    names = [c.split()[0] for c in _CHUNK.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in _CHUNK.split(", ")])
    done: list[dict] = []

    def rows():
        marked = None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[2]:
                    marked = r[1]
                else:
                    yield r, r[1] == marked

    def chunk(part, conv, members):
        out = dict.fromkeys(names, 0) | {"part": part, "conv_id": conv, "edge": False, "low": None, "high": None, "head": None, "tail": None,
                                         "first_initial": None, "last_initial": None, "rid": None}
        codes = []
        for (_, rid, _, _, turn, initial, blank, cut, dropped), is_first in members:
            out["rid"] = rid if out["rid"] is None else out["rid"]
            if dropped:
                continue
            if out["last_initial"] is None:
                out["first_initial"] = initial
            else:
                out["illegal"] += out["last_initial"] + initial not in ("su", "ua", "au")
            out["last_initial"] = initial
            if turn is not None:
                out["n_turns"] += turn != out["tail"]
                out["head"] = turn if out["head"] is None else out["head"]
                out["tail"] = turn
            fault = "blank" if blank else "duplicate" if not is_first else "truncated" if cut else None
            if fault:
                out[fault] += 1
            code = initial if initial in ("s", "u", "a") else "o"
            codes.append(MUST_GO if fault in ("blank", "duplicate") else code.upper() if fault else code)
        return out | {"codes": "".join(codes), "low": out["head"], "high": out["tail"]}

    def batch():
        out = pa.RecordBatch.from_pylist(done, schema=schema)
        done.clear()
        return out

    for part, own in groupby(rows(), key=lambda x: x[0][0]):
        held, n = None, 0  # the newest chunk of the part: the first and the last are at its edges
        for conv, members in groupby(own, key=lambda x: x[0][3]):
            if held is not None:
                done.append(held | {"edge": n == 1})
                if len(done) >= 1000:
                    yield batch()
            held, n = chunk(part, conv, members), n + 1
        if held is not None:
            done.append(held | {"edge": True})
    if done:
        yield batch()


def chunks(rows: DataFrame, parts: int) -> DataFrame:
    return keep(_events(rows).repartition(parts, "part").sortWithinPartitions("part", "rid", F.col("first").desc()).mapInArrow(_chunks, _CHUNK), "conversation-chunks")


# the search ----------------------------------------------------------------------------------------------

def _by_row(fn, schema: pa.Schema):
    """A function of one row's values -> a tuple, over Arrow batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search()
        for b in batches:
            got = [fn(search, *r) for r in zip(*(c.to_pylist() for c in b.columns))]
            columns = list(zip(*got)) if got else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _along(fold, schema: pa.Schema):
    """Rows sorted by conversation (column 1), folded with a state that starts anew in each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held, any_yet = None, None, False
        for b in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if not any_yet or r[1] != held:
                    state, held, any_yet = None, r[1], True
                state, row = fold(state, *r)
                out.append(row)
            columns = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


_VECTOR, _LONGS = pa.list_(pa.int64()), pa.list_(pa.int64())


def _speculate(search, rid, conv, codes):
    before, matrix = search.converge(codes)
    return rid, conv, list(before), None if matrix is None else [x for row in matrix for x in row]


def _stitch(state, rid, conv, before, matrix):
    """From a conversation's last chunk to its first: the vector after each chunk."""
    need = END if state is None else state
    before = tuple(before) if matrix is None else through([matrix[j:j + 4] for j in range(0, 16, 4)], need)
    return before, (rid, list(need), state is None)


def _fixed(search, codes, need) -> list[Vector]:
    vectors = search.vectors(codes, END)
    return vectors if need is None else search.rerun(codes, vectors, tuple(need))


def _exits(search, rid, conv, codes, need):
    vectors = _fixed(search, codes, need)
    return rid, conv, [search.audit(codes, vectors, q, False)[1] for q in range(4)]


def _enter(state, rid, conv, exits):
    entry = 0 if state is None else state
    return exits[entry], (rid, entry)


def _trace(search, rid, codes, need, entry, ends):
    letters, _, cost = search.audit(codes, _fixed(search, codes, need), entry or 0, ends is None or ends)
    return rid, letters, cost, entry or 0


def audits(pieces: DataFrame) -> DataFrame:
    """``pieces`` (chunks) with the ``audit`` of each, its ``cost`` and the state ``entry`` before its first row."""
    longs, boundary = pa.int64(), pieces.where("edge")
    spec = boundary.select("rid", "conv_id", "codes").mapInArrow(
        _by_row(_speculate, pa.schema([("rid", longs), ("conv_id", longs), ("before", _VECTOR), ("matrix", _LONGS)])), "rid long, conv_id long, before array<long>, matrix array<long>")
    needs = keep(spec.repartition("conv_id").sortWithinPartitions("conv_id", F.col("rid").desc()).mapInArrow(
        _along(_stitch, pa.schema([("rid", longs), ("need", _VECTOR), ("ends", pa.bool_())])), "rid long, need array<long>, ends boolean"), "conversation-needs")
    exits = boundary.join(needs, "rid").select("rid", "conv_id", "codes", "need").mapInArrow(
        _by_row(_exits, pa.schema([("rid", longs), ("conv_id", longs), ("exits", _LONGS)])), "rid long, conv_id long, exits array<long>")
    entries = exits.repartition("conv_id").sortWithinPartitions("conv_id", "rid").mapInArrow(
        _along(_enter, pa.schema([("rid", longs), ("entry", longs)])), "rid long, entry long")
    known = needs.join(entries, "rid")
    traced = pieces.join(known, "rid", "left").select("rid", "codes", "need", "entry", "ends").mapInArrow(
        _by_row(_trace, pa.schema([("rid", longs), ("audit", pa.string()), ("cost", longs), ("entry", longs)])), "rid long, audit string, cost long, entry long")
    return pieces.drop("codes").join(traced, "rid")


# the repaired text ---------------------------------------------------------------------------------------

_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Repair:
    """One conversation: chunks' audits and rows come in order, sums and the hash of the repaired text come out."""

    def __init__(self, conv) -> None:
        self.conv, self.hash, self.lines = conv, hashlib.sha256(), 0
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.low = self.high = self.tail = self.initial = None
        self.turns, self.letters, self.at, self.state, self.audits = 0, "", 0, 0, []

    def line(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + role.encode() + b":" + text.encode())
        self.lines += 1

    def turn(self, text: str) -> None:
        self.line("assistant" if self.state == 2 else "user", text)
        self.state = TURN_TO[self.state]

    def inserts(self) -> None:
        while self.letters[self.at:self.at + 1] == "I":
            self.turn("")
            self.at += 1

    def chunk(self, letters: str, p: dict) -> None:
        self.inserts()
        self.letters, self.at = letters, 0
        self.audits.append(letters)
        for k in self.sums:
            self.sums[k] += p[k]
        if p.get("head") is not None:
            self.turns += p["n_turns"] - (p["head"] == self.tail)
            self.low = p["low"] if self.low is None else self.low
            self.high = self.tail = p["high"]
        if p.get("first_initial") is not None:
            self.sums["illegal"] += self.initial is not None and self.initial + p["first_initial"] not in ("su", "ua", "au")
            self.initial = p["last_initial"]

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.letters[self.at]
        self.at += 1
        if edit == "K":
            self.line(role, text)
            self.state = NEXT[role[0]][self.state]
        elif edit == "R":
            self.turn(text)

    def result(self) -> tuple:
        self.inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        s = self.sums
        return self.conv, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"], "".join(self.audits), self.hash.hexdigest()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _RESULT.split(", ")])
    now, done = None, []

    def batch():
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        done.clear()
        return out

    for b in batches:
        for conv, _, is_row, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.result())
                now = _Repair(conv)
            if is_row:
                now.row(role, text)
            else:
                now.chunk(role, json.loads(text))
        if len(done) >= 1000:
            yield batch()
    if now is not None:
        done.append(now.result())
    if done:
        yield batch()


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the repaired text's hash of each conversation of (conv_id, turn, role, text[, dropped]).

    Rows with ``dropped`` only tell that their conversation exists.
    """
    prepare(rows.sparkSession)
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    held = ordered(rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), some("role"), some("text"), dropped.alias("dropped")))
    parts = max(1, held.agg(F.max(F.shiftright("rid", 33))).first()[0] or 0) + 1
    plans = audits(chunks(held, parts))
    facts = [c for c in plans.columns if c not in ("rid", "conv_id", "audit")]
    plans = plans.select("conv_id", "rid", F.lit(False).alias("is_row"), F.col("audit").alias("role"), F.to_json(F.struct(*facts)).alias("text"))
    texts = held.where(~F.col("dropped")).select("conv_id", "rid", F.lit(True).alias("is_row"), "role", "text")
    both = plans.unionByName(texts).repartition(parts, "conv_id").sortWithinPartitions("conv_id", "rid", "is_row")
    return both.mapInArrow(_finish, _RESULT)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults planted by crc32(`conv_id:turn`) % 20: 0 drops (kept as ``dropped``), 1 empties, 2 takes the ends of
    sentences, 3 repeats, 4 sets role user."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", some("conv_id"), some("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(some("text"), ".!?", "")).otherwise(some("text"))
    out = rows.select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(some("role")).alias("role"), text.alias("text"),
                      (fault == 0).alias("dropped"), F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"))
    return out.drop("copy")


_SQL = r"""
WITH RECURSIVE table_step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM table_step WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS of FROM table_step WHERE k = 8),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations),
faulted AS (
  SELECT raw.*, xor(list_reduce([CAST(('0x' || h[2 * i - 1:2 * i]) AS BIGINT) FOR i IN range(1, CAST(length(h) / 2 AS BIGINT) + 1)],
    lambda c, b: xor(c >> 8, of[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 20 AS f FROM raw, crc),
hit AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM faulted),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text[1:32], sha256(text), copy) AS i FROM hit),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM placed),
judged AS (
  SELECT *, CASE WHEN s = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(s, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair FROM seen),
facts AS (
  SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list({'c': role[1:1], 'gone': fault IN ('blank', 'duplicate') AND fault IS NOT NULL, 'cut': CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END,
      'role': role, 'text': text} ORDER BY i) AS rows FROM judged GROUP BY conv_id),
-- cheapest (cost, audit) of the rows so far by state, as text that sorts like it: six digits and the letters
paths(conv_id, n, q0, q1, q2, q3) AS (
  SELECT conv_id, 0, '000000', CAST(NULL AS VARCHAR), '000002I', '000004II' FROM facts
  UNION ALL SELECT conv_id, n, n0, n1, least(n2, lpad(CAST(CAST(n0[1:6] AS INT) + 2 AS VARCHAR), 6, '0') || n0[7:] || 'I',
      lpad(CAST(CAST(n1[1:6] AS INT) + 2 AS VARCHAR), 6, '0') || n1[7:] || 'I', lpad(CAST(CAST(n3[1:6] AS INT) + 2 AS VARCHAR), 6, '0') || n3[7:] || 'I'),
    least(n3, lpad(CAST(CAST(n2[1:6] AS INT) + 2 AS VARCHAR), 6, '0') || n2[7:] || 'I',
      lpad(CAST(CAST(n0[1:6] AS INT) + 4 AS VARCHAR), 6, '0') || n0[7:] || 'II', lpad(CAST(CAST(n1[1:6] AS INT) + 4 AS VARCHAR), 6, '0') || n1[7:] || 'II')
  FROM (
    SELECT p.conv_id, n + 1 AS n,
      lpad(CAST(CAST(q0[1:6] AS INT) + 3 AS VARCHAR), 6, '0') || q0[7:] || 'D' AS n0,
      least(lpad(CAST(CAST(q1[1:6] AS INT) + 3 AS VARCHAR), 6, '0') || q1[7:] || 'D',
        CASE WHEN NOT r.gone AND r.c = 's' THEN lpad(CAST(CAST(q0[1:6] AS INT) + r.cut AS VARCHAR), 6, '0') || q0[7:] || 'K' END) AS n1,
      least(lpad(CAST(CAST(q2[1:6] AS INT) + 3 AS VARCHAR), 6, '0') || q2[7:] || 'D',
        CASE WHEN NOT r.gone AND r.c = 'u' THEN least(lpad(CAST(CAST(q0[1:6] AS INT) + r.cut AS VARCHAR), 6, '0') || q0[7:] || 'K',
          lpad(CAST(CAST(q1[1:6] AS INT) + r.cut AS VARCHAR), 6, '0') || q1[7:] || 'K', lpad(CAST(CAST(q3[1:6] AS INT) + r.cut AS VARCHAR), 6, '0') || q3[7:] || 'K') END,
        CASE WHEN NOT r.gone THEN least(lpad(CAST(CAST(q0[1:6] AS INT) + 2 + r.cut AS VARCHAR), 6, '0') || q0[7:] || 'R',
          lpad(CAST(CAST(q1[1:6] AS INT) + 2 + r.cut AS VARCHAR), 6, '0') || q1[7:] || 'R', lpad(CAST(CAST(q3[1:6] AS INT) + 2 + r.cut AS VARCHAR), 6, '0') || q3[7:] || 'R') END) AS n2,
      least(lpad(CAST(CAST(q3[1:6] AS INT) + 3 AS VARCHAR), 6, '0') || q3[7:] || 'D',
        CASE WHEN NOT r.gone AND r.c = 'a' THEN lpad(CAST(CAST(q2[1:6] AS INT) + r.cut AS VARCHAR), 6, '0') || q2[7:] || 'K' END,
        CASE WHEN NOT r.gone THEN lpad(CAST(CAST(q2[1:6] AS INT) + 2 + r.cut AS VARCHAR), 6, '0') || q2[7:] || 'R' END) AS n3
    FROM (SELECT paths.*, rows[n + 1] AS r FROM paths JOIN facts ON facts.conv_id IS NOT DISTINCT FROM paths.conv_id WHERE n < len(rows)) p)),
best AS (SELECT f.*, least(q0, q3) AS path FROM paths JOIN facts f ON f.conv_id IS NOT DISTINCT FROM paths.conv_id WHERE n = len(rows)),
letters AS (SELECT conv_id, rows, unnest(range(1, length(path) - 5)) AS p, path[7:] AS audit FROM best),
used AS (SELECT *, audit[p:p] AS e, rows[len(replace(audit[1:p], 'I', ''))] AS r FROM letters),
left_over AS (SELECT *, row_number() OVER w AS place, first_value(e = 'K' AND r.c = 's') OVER w AS system
  FROM used WHERE e <> 'D' WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
lines AS (SELECT conv_id, p, CASE WHEN e = 'K' THEN r.role WHEN (place - CASE WHEN system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN e = 'I' THEN '' ELSE r.text END AS line FROM left_over),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS whole FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(path[1:6], '0') AS BIGINT) AS cost, coalesce(path[7:], '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op11_conversation_repair", _SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))
