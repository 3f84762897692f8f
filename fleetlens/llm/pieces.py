"""SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary's pieces and scores come from a model file (a path). A text is prefixed with a space, spaces
become U+2581, and the segmentation with the highest sum of scores wins; ties go to the longer last piece.
Characters without a piece cost ten less than the lowest score and become byte pieces.

The search goes through the text from left to right. It keeps the scores of a window of the longest piece's
length, and back pointers only of what isn't settled: as soon as all surviving paths run through one boundary,
the ids before it are committed. Where no piece of the vocabulary can cross (before a space that follows
another character, and around a line break), every path has to pass, so such stretches are committed one by
one, and a worker remembers the ids of short ones. Memory doesn't grow with the length of a text.

A model trained by merges gives ranks as scores; they are used as scores here, so its own merge order isn't
imitated (the result is the best-scoring segmentation, which tests compare with the library's).

Defined cases: a null or empty text has no ids and decodes to an empty text; U+2581 in a text counts as a
space and is decoded as one (``round_trip`` is false); repeated rows are encoded once per row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import MEMO_WORD_BYTES, byte_values, prepare, table, worker_memo
from fleetlens.llm.registry import query

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Unsettled characters beyond which convergence is looked for at every step, not only where one path is left;
#: a stretch of at most this length is settled at once.
PATIENCE = 64
#: Stretches whose ids a Python worker remembers, about 200 bytes each.
MEMO_STRETCHES = 700_000
_STRETCH = re.compile(" +[^ \n]*|[^ \n]+|\n")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces of a model file as a trie, byte pieces and the decoding table."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.trie: dict = {}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        size = sp.get_piece_size()
        self.decoded: list[bytes] = [b""] * size
        least, self.longest, crossing = 0.0, 1, False
        for i in range(size):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            piece, score = sp.id_to_piece(i), sp.get_score(i)
            if sp.is_byte(i):
                self.decoded[i] = bytes([int(piece[3:5], 16)])
                continue
            self.decoded[i] = piece.replace(SPACE, " ").encode()
            least, self.longest = min(least, score), max(self.longest, len(piece))
            crossing |= SPACE in piece.lstrip(SPACE) or "\n" in piece
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (i, score)
        self.unknown = least - UNKNOWN_PENALTY
        #: Whether every piece keeps within a stretch (a run of spaces and what follows it).
        self.stretches = not crossing

    def viterbi(self, s: str) -> tuple[list[int], int]:
        """Ids of a text whose spaces are U+2581, and the most characters that were unsettled at a time."""
        n, ids = len(s), []
        if n <= PATIENCE:
            return self._at_once(s), n
        best, back = {0: 0.0}, {}
        settled, most = 0, 0
        for i in range(n):
            base = best.pop(i, None)
            if base is not None:
                node, j, single = self.trie, i, False
                while j < n:
                    node = node.get(s[j])
                    if node is None:
                        break
                    j += 1
                    hit = node.get("")
                    if hit is not None:
                        single |= j == i + 1
                        if base + hit[1] > best.get(j, -np.inf):
                            best[j] = base + hit[1]
                            back[j] = (i, hit[0])
                if not single and base + self.unknown > best.get(i + 1, -np.inf):
                    best[i + 1] = base + self.unknown
                    back[i + 1] = (i, -1)
            most = max(most, i + 1 - settled)
            if len(best) == 1 or i + 1 - settled > PATIENCE:
                ends = set(best)  # the surviving paths; trace the furthest back until they meet
                while len(ends) > 1:
                    last = max(ends)
                    ends.discard(last)
                    ends.add(back[last][0])
                meet = ends.pop()
                if meet > settled:
                    self._commit(s, back, settled, meet, ids)
                    back = {k: v for k, v in back.items() if k > meet}
                    settled = meet
        if settled < n:
            self._commit(s, back, settled, n, ids)
        return ids, most

    def _at_once(self, s: str) -> list[int]:
        """The search for a stretch that fits in what may be unsettled: nothing needs to be committed early."""
        n, trie, unknown = len(s), self.trie, self.unknown
        best, back = [-1e300] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            base, node, single = best[i], trie, False
            for j in range(i, n):
                node = node.get(s[j])
                if node is None:
                    break
                hit = node.get("")
                if hit is not None:
                    single |= j == i
                    total = base + hit[1]
                    if total > best[j + 1]:
                        best[j + 1] = total
                        back[j + 1] = (i, hit[0])
            if not single and base + unknown > best[i + 1]:
                best[i + 1] = base + unknown
                back[i + 1] = (i, -1)
        ids: list[int] = []
        self._commit(s, back, 0, n, ids)
        return ids

    def _commit(self, s: str, back: dict | list, start: int, end: int, ids: list[int]) -> None:
        path = []
        while end > start:
            at, piece = back[end]
            if piece < 0:
                path += [self.byte_ids[b] for b in reversed(s[at:end].encode("utf-8", "surrogatepass"))]
            else:
                path.append(piece)
            end = at
        ids += reversed(path)

    def encode(self, text: str, memo: dict) -> bytes:
        """Ids as little-endian uint32 bytes."""
        if not text:
            return b""
        if not self.stretches:
            return np.array(self.viterbi(SPACE + text.replace(" ", SPACE))[0], "<u4").tobytes()
        out = []
        for x in _STRETCH.findall(" " + text.replace(SPACE, " ")):
            got = memo.get(x)
            if got is None:
                got = np.array(self.viterbi(x.replace(" ", SPACE))[0], "<u4").tobytes()
                if len(memo) < MEMO_STRETCHES and len(x) <= MEMO_WORD_BYTES:
                    memo[x] = got
            out.append(got)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        text = b"".join(map(self.decoded.__getitem__, ids.tolist()))
        return text[1:] if text[:1] == b" " else text


def load(path: str) -> PieceModel:
    models = worker_memo("piece models")
    if path not in models:
        models[path] = PieceModel(path)
    return models[path]


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) for every row."""
    prepare(docs.sparkSession)
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, memo = load(path), worker_memo(f"pieces:{path}", large=True)
        for b in batches:
            ids = [np.frombuffer(pieces.encode(t.decode("utf-8", "replace"), memo), "<u4").astype(np.int32) for t in byte_values(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids)."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for b in batches:
            texts = [pieces.decode(np.array(x or [], np.int32)).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of little-endian uint32), text_sha256 of the decoded text, round_trip.

    One pass, so neither ids nor texts are kept: each text is encoded, decoded and compared.
    """
    prepare(docs.sparkSession)
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, memo = load(path), worker_memo(f"pieces:{path}", large=True)
        for b in batches:
            rows = []
            for t in byte_values(b.column(1)):
                ids = pieces.encode(t.decode("utf-8", "replace"), memo)
                back = pieces.decode(np.frombuffer(ids, "<u4"))
                rows.append((len(ids) // 4, zlib.crc32(ids), hashlib.sha256(back).hexdigest(), back == t))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.bool_())],
                                             names=["doc_id", "n_ids", "ids_crc32", "text_sha256", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, text_sha256 string, round_trip boolean")


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
