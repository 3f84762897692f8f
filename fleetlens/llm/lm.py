"""Language-model scores: a Brown class-based bigram model, next to an add-one unigram baseline.

P(text) is the product over tokens of P(class | class before) * P(word | class). Tokens are the words,
with A-Z in lower case, and one end per text.

* Texts are read once: a word becomes a number (58 bits of its hash, 6 bits for the group of its ending). Once words are counted,
  a second table holds codes: the rank of a frequent word, else the group of its ending with the number aside. All
  later passes run over these arrays, where a word's unit, class or count is one look-up by index.
* Word counts are summed over the whole training part of the corpus, one row per distinct word.
* Exchange clustering, first on a bounded core: units are the ``UNITS`` most frequent words and, for all other words, ``SUFFIXES``
  groups by hashed ending. A unit moves to the class that raises the likelihood of the class bigrams most, until no unit moves.
* Then on every word that occurs twice or more: its classes before and after, over all its training tokens, are brought
  together in one row per word and sweep, and it moves to the class with the largest exchange gain (to first order: classes
  keep their counts within a sweep). Class bigrams are counted anew after each of the ``REST_SWEEPS`` sweeps. Endings only stand for
  words that are unseen or occur once. So what the model gathers - counts, contexts and classes of words - grows with the corpus.
* Emission is (c + 1) / (tokens of the class + words of the class + 1): it sums to one with one unseen word.
  Transitions are smoothed towards the classes' frequencies.
* The ``HEAD`` most frequent words with their classes and counts are broadcast (a bounded table). Tokens of other words take their class
  and count from a join by number, and rows of a document's such tokens, in order, complete its transitions. As a context of another
  word and in the counts of transitions, such a token counts by its ending's class.

Defined cases: a null text is an empty one (one end token); a null doc_id counts as an empty id in the split;
repeated rows are scored once per row; words that tie in their counts are ordered by their number; with no training text every word is
unseen (N = V = 0); an empty table gives an empty result; other columns are ignored; a very long text is one array of numbers,
8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import MEMO_WORD_BYTES, byte_values, discard, keep, prepare, table, worker_memo
from fleetlens.llm.language import remainder
from fleetlens.llm.registry import query

UNITS, SUFFIXES, CLASSES, HEAD = 512, 64, 64, 1 << 18
SUFFIX_BYTES = 3
SWEEPS, REST_SWEEPS = 8, 2
#: Pseudo-counts of a class before a transition, and of a cell of class bigrams in the gain of a rarer word.
PRIOR, CELL = 8.0, 0.5
MEMO = 400_000
#: Tokens whose contexts a task brings together before it hands them on; words per partition of such rows.
BLOCK, WORDS_PER_PART = 3_000_000, 200_000


# words as numbers ----------------------------------------------------------------------------------------

def number(word: bytes) -> int:
    """The word's number: its hash, with the group of its ending in the lowest bits."""
    import xxhash

    h = xxhash.xxh64_intdigest(word) & -SUFFIXES | xxhash.xxh64_intdigest(word[-SUFFIX_BYTES:]) % SUFFIXES
    return h - (1 << 64) if h >> 63 else h


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = worker_memo("lm-numbers", large=True)
    for b in batches:
        flat, sizes = [], []
        for t in byte_values(b.column(1)):
            words = t.lower().split()
            flat += words
            sizes.append(len(words))
        if len(memo) > MEMO:
            memo.clear()
        long_words = {}
        for w in set(flat).difference(memo):
            (memo if len(w) <= MEMO_WORD_BYTES else long_words)[w] = number(w)
        if long_words:
            ids = np.fromiter((memo[w] if w in memo else long_words[w] for w in flat), np.int64, len(flat))
        else:
            ids = np.fromiter(map(memo.__getitem__, flat), np.int64, len(flat))
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=["doc_id", "train", "ids"])


def encode(docs: DataFrame, train=None) -> DataFrame:
    """(rid, doc_id, train, ids) as a written table: the numbers of each text's words."""
    prepare(docs.sparkSession)
    train = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", train.alias("train"))
    return keep(rows.mapInArrow(_encode, "doc_id long, train boolean, ids array<long>").withColumn("rid", F.monotonically_increasing_id()), "lm-numbers")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a batch, and where each text's begin (with the end of the last)."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes)))


def _recode(head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ranks = head.value
        for b in batches:
            flat, starts = _flat(b.column(3))
            if len(ids):
                place = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
                found = ids[place] == flat
                codes = np.where(found, ranks[place], -1 - (flat & (SUFFIXES - 1)))
            else:
                found, codes = np.zeros(len(flat), bool), -1 - (flat & (SUFFIXES - 1))
            others = np.concatenate(([0], np.cumsum(~found)))[starts]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(codes.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(others.astype(np.int32)), pa.array(flat[~found]))], names=["rid", "doc_id", "train", "codes", "others"])

    return run


def recode(coded: DataFrame, head_ids: np.ndarray) -> DataFrame:
    """(rid, doc_id, train, codes, others), written: a word's place in ``head_ids``, or -1 less the group of its ending;
    ``others`` are the numbers of the latter words, in order."""
    order = np.argsort(head_ids)
    head = coded.sparkSession.sparkContext.broadcast((head_ids[order], order.astype(np.int32)))
    rows = coded.select("rid", "doc_id", "train", "ids").mapInArrow(_recode(head), "rid long, doc_id long, train boolean, codes array<int>, others array<long>")
    return keep(rows, "lm-codes")


def by_code(of_head: np.ndarray, of_endings: np.ndarray) -> np.ndarray:
    """A table to be indexed by codes: endings count from its end."""
    return np.concatenate([of_head, of_endings[::-1]])


def _steps(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value before and after each token of the texts; the end (value 0) stands before and after a text."""
    before, after = np.zeros_like(values), np.zeros_like(values)
    before[1:], after[:-1] = values[:-1], values[1:]
    full = np.diff(starts) > 0
    before[starts[:-1][full]] = 0
    after[starts[1:][full] - 1] = 0
    return before, after


def _bigrams(table_of, width: int):
    """Counts of (value, next value) over all texts, with their ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for b in batches:
            flat, starts = _flat(b.column(0))
            values = table_of.value[flat].astype(np.int64)
            before, _ = _steps(values, starts)
            total += np.bincount(before * width + values, minlength=width * width)
            full = np.diff(starts) > 0
            total += np.bincount(values[starts[1:][full] - 1] * width, minlength=width * width)  # to the end
            total[0] += (~full).sum()
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 100_000):
            part = at[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])

    return run


def bigrams(coded: DataFrame, values: np.ndarray, width: int) -> np.ndarray:
    """The table of counts (width squared numbers come to the driver)."""
    spark = coded.sparkSession
    rows = coded.select("codes").mapInArrow(_bigrams(spark.sparkContext.broadcast(values), width), "pair long, n long")
    pairs = rows.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(width * width)
    counts[pairs["pair"].to_numpy(np.int64)] = pairs["n"].to_numpy(np.float64)
    return counts.reshape(width, width)


# classes -------------------------------------------------------------------------------------------------

def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit. counts[a, b]: how often unit b follows unit a. Unit 0 (the end) keeps class 0.

    Units start dealt out by frequency; a unit moves to the class with the highest likelihood of class bigrams.
    """
    def xlog(x):
        return x * np.log(np.maximum(x, 1))

    u = len(counts)
    total = counts.sum(axis=0) + counts.sum(axis=1)
    own = np.zeros(u, np.int64)
    order = [i for i in np.argsort(-total, kind="stable").tolist() if i]
    for rank, i in enumerate(order):
        own[i] = 1 + rank % (classes - 1)
    member = np.zeros((u, classes))
    member[np.arange(u), own] = 1
    n = member.T @ counts @ member
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not total[w]:
                continue
            k, self_n = own[w], counts[w, w]
            member[w, k] = 0
            after, before = counts[w] @ member, counts[:, w] @ member
            n[k] -= after
            n[:, k] -= before
            n[k, k] -= self_n
            rows, cols = n.sum(axis=1) + before, n.sum(axis=0) + after  # what the unit adds to others' margins in any class
            gain = (xlog(n + after[None, :]) - xlog(n)).sum(axis=1) + (xlog(n + before[:, None]) - xlog(n)).sum(axis=0)
            d = np.diag(n)
            gain += xlog(d + after + before + self_n) - xlog(d + after) - xlog(d + before) + xlog(d)
            gain -= xlog(rows + after.sum() + self_n) - xlog(rows) + xlog(cols + before.sum() + self_n) - xlog(cols)
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[k] + 1e-9:
                best = k
            moved += best != k
            own[w] = best
            member[w, best] = 1
            n[best] += after
            n[:, best] += before
            n[best, best] += self_n
        if not moved:
            break
    return own


def frequent(words: DataFrame, most: int):
    """The ``most`` most frequent words as a frame (id, n, ...), in order; ties by number.

    The count at which the answer ends is narrowed down by counting words in ever smaller intervals of counts, and a tie there by
    intervals of numbers, so only words of the answer (and at most twice as many) come to the driver, whatever the counts look like.
    """
    total, top = words.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    taken = words
    if total > 2 * most:
        def cut(value, lo: int, hi: int, above: int, inside: int) -> tuple[int, int, int, int]:
            """Narrow [lo, hi) to a part so that the values from it on are at least ``most``, those beyond it fewer."""
            while hi - lo > 1 and above + inside > 2 * most:
                width = max(1, -(-(hi - lo) // 256))
                part = F.floor((value - F.lit(lo)) / F.lit(width)).cast("long")
                found = {r["part"]: r["count"] for r in words.where((value >= F.lit(lo)) & (value < F.lit(hi))).groupBy(part.alias("part")).count().collect()}
                for p in sorted(found, reverse=True):
                    if above + found[p] >= most:
                        lo, hi, inside = lo + p * width, min(hi, lo + (p + 1) * width), found[p]
                        break
                    above += found[p]
            return lo, hi, above, inside

        lo, hi, above, inside = cut(F.col("n"), 1, int(top) + 1, 0, total)
        taken = words.where(F.col("n") >= lo)
        if above + inside > 2 * most:  # one count with very many words: those with the least numbers
            tied = F.when(F.col("n") == lo, -F.shiftright("id", 16)).otherwise(F.lit(-(1 << 50)))
            least, _, _, _ = cut(tied, -(1 << 47), (1 << 47) + 1, above, inside)
            taken = words.where((F.col("n") > lo) | ((F.col("n") == lo) & (tied >= F.lit(least))))
    found = taken.toPandas()
    return found.sort_values(["n", "id"], ascending=[False, True], ignore_index=True).head(most)


def _contexts(classes_of, head_ids, core: int):
    """Tasks' blocks of tokens -> one row per word and block: its classes before and after as bytes, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def rows():
            ids, before, after = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(ids)
            ids, sides = ids[order], []
            starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            word = np.cumsum(np.concatenate(([0], ids[1:] != ids[:-1])), dtype=np.int32) * np.int32(CLASSES)
            bounds = pa.py_buffer(np.append(starts, len(ids)).astype(np.int32).tobytes())
            for side in (before[order], after[order]):
                ranked = np.sort(word + side).astype(np.uint8) % np.uint8(CLASSES)  # 256 is a multiple of the classes
                sides.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(ranked.tobytes())]))
            whole = pa.RecordBatch.from_arrays([pa.array(ids[starts]), *sides], names=["id", "before", "after"])
            for lo in range(0, whole.num_rows, 20_000):
                yield whole.slice(lo, 20_000)

        for b in batches:
            flat, starts = _flat(b.column(0))
            before, after = _steps(classes_of.value[flat], starts)
            ids = np.empty(len(flat), np.int64)
            ids[flat >= 0], ids[flat < 0] = head_ids.value[flat[flat >= 0]], _flat(b.column(1))[0]
            rest = (flat >= core) | (flat < 0)
            held.append((ids[rest], before[rest], after[rest]))
            size += int(rest.sum())
            if size > BLOCK:
                yield from rows()
                size = 0
        if size:
            yield from rows()

    return run


def gains(before: np.ndarray, after: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """Exchange gain (to first order) of each word in each class, from its counts of classes before and after.

    Classes keep the counts of ``follow``; the word's own bigrams are added to one class's row and column."""
    cells = np.log(follow + CELL)
    rows, cols = np.log(follow.sum(axis=1) + CELL * CLASSES), np.log(follow.sum(axis=0) + CELL * CLASSES)
    out = after @ (cells - rows[:, None]).T + before @ (cells - cols[None, :])
    out[:, 0] = -np.inf  # the end's class
    return out


def _in_groups(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Batches joined up to so many rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and the length of each value (no copies)."""
    bounds = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[bounds[0]:bounds[-1]], np.diff(bounds)


def _assign(follow):
    """Rows sorted by word -> (id, class) of words that occur twice or more; one word's counts are held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of = follow.value
        last, carry = None, np.zeros((2, CLASSES))

        def judged(ids, sides):
            able = sides[0].sum(axis=1) >= 2
            best = np.argmax(np.round(gains(sides[0][able], sides[1][able], table_of), 9), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(ids[able], pa.int64()), pa.array(best, pa.int32())], names=["id", "cls"])

        for b in _in_groups(batches):
            ids = b.column(0).to_numpy()
            if not len(ids):
                continue
            starts = np.concatenate(([True], ids[1:] != ids[:-1]))
            word, unique = np.cumsum(starts) - 1, ids[starts]
            sides = []
            for column in (b.column(1), b.column(2)):
                data, lengths = _bytes(column)
                sides.append(np.bincount(np.repeat(word, lengths) * CLASSES + data, minlength=len(unique) * CLASSES).reshape(-1, CLASSES).astype(np.float64))
            if last is not None and unique[0] == last:
                for side, more in zip(sides, carry):
                    side[0] += more
            elif last is not None:
                yield judged(np.array([last]), carry[:, None, :])
            last, carry = unique[-1], np.stack([side[-1] for side in sides])
            yield judged(unique[:-1], np.stack([side[:-1] for side in sides]))
        if last is not None:
            yield judged(np.array([last]), carry[:, None, :])

    return run


def train_on(coded: DataFrame) -> tuple[dict, DataFrame, DataFrame]:
    """Of :func:`encode`: the bounded part of the model (for a broadcast), the table (id, n, cls) of all words, and the codes of all texts,
    which replace the table of numbers (it is deleted)."""
    spark = prepare(coded.sparkSession)
    cast = spark.sparkContext.broadcast
    words = keep(coded.where("train").select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")), "lm-words")
    ends = coded.where("train").count()
    in_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = frequent(words, max(HEAD, UNITS))
    ids = head["id"].to_numpy(np.int64)
    codes = recode(coded, ids)
    discard(coded)
    learn = codes.where("train")
    # the core: units 1.. are the most frequent words, then the endings; unit 0 is the end
    width, core = UNITS + 1 + SUFFIXES, ids[:UNITS]
    endings = np.arange(UNITS + 1, width)
    unit = np.where(np.arange(len(ids)) < UNITS, np.arange(len(ids)) + 1, endings[ids & (SUFFIXES - 1)])
    counts = bigrams(learn, by_code(unit, endings), width)
    own = exchange(counts)
    ending_class = own[endings].astype(np.uint8)
    seed = np.zeros((width, CLASSES))
    seed[np.arange(width), own] = 1
    follow = seed.T @ counts @ seed
    # every other word
    fixed = spark.createDataFrame([(int(i), int(own[u + 1])) for u, i in enumerate(core)], "id long, cls int")
    head_ids, parts = cast(ids), max(1, -(-distinct // WORDS_PER_PART))
    classed, head_class = words.join(fixed, "id", "left"), own[unit].astype(np.uint8)
    for _ in range(REST_SWEEPS):
        rows = learn.select("codes", "others").mapInArrow(_contexts(cast(by_code(head_class, ending_class)), head_ids, len(core)), "id long, before binary, after binary")
        moved = rows.repartition(parts, "id").sortWithinPartitions("id").mapInArrow(_assign(cast(follow)), "id long, cls int")
        classed = keep(words.join(moved.unionByName(fixed), "id", "left"), "lm-classes")
        known = frequent(classed, max(HEAD, UNITS))["cls"].fillna(-1).to_numpy(np.int64)
        head_class = np.where(known < 0, ending_class[ids & (SUFFIXES - 1)], known).astype(np.uint8)
        follow = bigrams(learn, by_code(head_class, ending_class), CLASSES)
    by_ending = F.get(F.array(*(F.lit(int(c)) for c in ending_class)), F.col("id").bitwiseAND(F.lit(SUFFIXES - 1)).cast("int"))
    classed = classed.withColumn("cls", F.coalesce("cls", by_ending))
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classed.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        tokens[r["cls"]], kinds[r["cls"]] = r["n"], r["v"]
    tokens[0], kinds[0] = ends, min(ends, 1)
    share = (tokens + 1) / (tokens.sum() + CLASSES)
    step = (follow + PRIOR * share[None, :]) / (follow.sum(axis=1, keepdims=True) + PRIOR)
    model = {"n": int(in_words) + ends, "v": int(distinct) + min(ends, 1), "ends": ends, "ids": ids, "classes": head_class,
             "logs": np.log10(head["n"].to_numpy(np.float64) + 1), "log_step": np.log10(step), "log_room": np.log10(tokens + kinds + 1), "ending_class": ending_class}
    return model, classed, codes


def train_model(train: DataFrame) -> tuple[dict, DataFrame]:
    """The model and its words, from training texts."""
    return train_on(encode(train))[:2]


# scores --------------------------------------------------------------------------------------------------

_DOC = "rid long, doc_id long, n_tokens long, known long, logs double, steps double, rare array<struct<id:bigint,before:int,after:int>>"


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        log_step, log_room = m["log_step"], m["log_room"]
        class_of = by_code(m["classes"].astype(np.int64), np.full(SUFFIXES, 255))  # 255: by the join
        log_of = by_code(m["logs"], np.zeros(SUFFIXES))
        end_known, end_log = int(m["ends"] > 0), float(np.log10(m["ends"] + 1))
        kind = pa.struct([("id", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])
        for b in batches:
            flat, starts = _flat(b.column(2))
            sizes = np.diff(starts)
            text = np.repeat(np.arange(len(sizes)), sizes)
            found, classes = flat >= 0, class_of[flat]
            before, after = _steps(classes, starts)
            seen = found & (before < CLASSES)
            steps = np.bincount(text[seen], weights=log_step[before[seen], classes[seen]], minlength=len(sizes)).astype(np.float64)  # whole numbers where nothing is seen
            steps -= np.bincount(text[found], weights=log_room[classes[found]], minlength=len(sizes))
            logs = np.bincount(text[found], weights=log_of[flat[found]], minlength=len(sizes)).astype(np.float64)
            # the end of each text
            last = np.zeros(len(sizes), np.int64)
            full = sizes > 0
            last[full] = classes[starts[1:][full] - 1]
            steps += np.where(last < CLASSES, log_step[np.minimum(last, CLASSES - 1), 0], 0.0) - log_room[0]
            rare = ~found
            offsets = np.concatenate(([0], np.cumsum(np.bincount(text[rare], minlength=len(sizes))))).astype(np.int32)
            ahead = np.where(after[rare] < CLASSES, after[rare], -1)
            rows = pa.StructArray.from_arrays([pa.array(_flat(b.column(3))[0]), pa.array(np.where(before[rare] < CLASSES, before[rare], -1).astype(np.int32)),
                                               pa.array(ahead.astype(np.int32))], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes + 1, pa.int64()), pa.array(np.bincount(text[found], minlength=len(sizes)) + end_known, pa.int64()),
                 pa.array(logs + end_log), pa.array(steps), pa.ListArray.from_arrays(pa.array(offsets), rows)],
                names=["rid", "doc_id", "n_tokens", "known", "logs", "steps", "rare"])

    return run


def _complete(model):
    """Tokens of words outside the head, by text and in order, with their joined class and count -> sums per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        last = 0
        for b in batches:
            rid, ids, before, after, n, cls = (b.column(i) for i in range(6))
            if not b.num_rows:
                continue
            rid, ids = rid.to_numpy(), ids.to_numpy()
            known, n = n.is_valid().to_numpy(zero_copy_only=False), n.fill_null(0).to_numpy()
            classes = np.where(known, cls.fill_null(0).to_numpy(), m["ending_class"][ids & (SUFFIXES - 1)]).astype(np.int64)
            before, after = before.to_numpy(), after.to_numpy()
            # -1: the token before is the row before, a token of the same kind
            from_class = np.where(before < 0, np.concatenate(([last], classes[:-1])), before)
            last = int(classes[-1])
            steps = m["log_step"][from_class, classes] - m["log_room"][classes]
            steps += np.where(after < 0, 0.0, m["log_step"][classes, np.maximum(after, 0)])
            starts = np.flatnonzero(np.concatenate(([True], rid[1:] != rid[:-1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[starts]), pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(np.log10(n + 1.0), starts)),
                 pa.array(np.add.reduceat(steps, starts))], names=["rid", "more_known", "more_logs", "more_steps"])

    return run


def score(docs: DataFrame, model: dict, words: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) for every row."""
    return score_codes(recode(encode(docs), model["ids"]), model, words)


def score_codes(coded: DataFrame, model: dict, words: DataFrame) -> DataFrame:
    """Scores from the codes of :func:`train_on` or :func:`recode`."""
    spark = prepare(coded.sparkSession)
    held = spark.sparkContext.broadcast({k: v for k, v in model.items() if k != "ids"})
    per_doc = keep(coded.select("rid", "doc_id", "codes", "others").mapInArrow(_score(held), _DOC), "lm-docs")
    rare = per_doc.select("rid", F.posexplode("rare").alias("place", "x")).select("rid", "place", "x.*")
    joined = rare.join(words, "id", "left").repartition("rid").sortWithinPartitions("rid", "place").select("rid", "id", "before", "after", "n", "cls")
    more = joined.mapInArrow(_complete(held), "rid long, more_known long, more_logs double, more_steps double")
    more = more.groupBy("rid").agg(*(F.sum(c).alias(c) for c in ("more_known", "more_logs", "more_steps")))
    rows = per_doc.drop("rare").join(more, "rid", "left")
    logs, steps = (F.col(c) + F.coalesce(f"more_{c}", F.lit(0.0)) for c in ("logs", "steps"))
    return rows.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(model["n"]).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(model["n"] + model["v"] + 1)))).alias("base_score"), (logs + steps).alias("score"))


@query("op7_lm_scoring")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = remainder("doc_id", 7) == 2
    coded = encode(table(spark, sf_dir, "documents"), ~held)
    model, words, codes = train_on(coded)
    return score_codes(codes, model, words).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
