"""Helpers shared by the operators: Arrow batches, word hashes, written intermediates.

Words are ``[^\\x20\\x09-\\x0D]+``: what ``bytes.split()`` gives on UTF-8 text.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fleetlens.session import ensure_session, materialize

#: What a null doc_id counts as where ids are compared: smaller than any other id.
NULL_ID = -(2 ** 63)
#: Odd factor of the polynomial word-window hashes (mod 2^64).
FACTOR = 0x9E3779B97F4A7C15
#: Rows and words a Python worker may keep in its memo of words.
MEMO_WORDS = 400_000
#: Longer words are never kept in a memo.
MEMO_WORD_BYTES = 64


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; batches to Python are bounded in rows."""
    ensure_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate under the shared checkpoint folder and read it back (cuts the lineage)."""
    return materialize(df, f"llm-{name}")


def discard(*frames: DataFrame) -> None:
    """Delete written intermediates that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (Spark's names ignore case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def map_whole(df: DataFrame, run, extra: tuple[StructField, ...] = ()) -> DataFrame:
    """``mapInArrow`` over all columns of ``df`` (by place; their names may hold any character), plus ``extra`` ones."""
    plain = [StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(df.schema.fields)]
    out = df.toDF(*(f.name for f in plain)).mapInArrow(run, StructType([*plain, *extra]))
    return out.toDF(*df.columns, *(f.name for f in extra))


def worker_memo(name: str, large: bool = False) -> dict:
    """A dict that lives as long as the Python worker does, so later tasks find it filled.

    A worker keeps one ``large`` dict at a time: asking for another drops the one before, so the memory of a
    worker that serves several operators stays that of one.
    """
    holder = sys.modules.setdefault("_fleetlens_llm_memo", types.ModuleType("_fleetlens_llm_memo")).__dict__
    if large and holder.get("_large") != name:
        holder.pop(holder.get("_large"), None)
        holder["_large"] = name
    return holder.setdefault(name, {})


def byte_values(column: pa.ChunkedArray | pa.Array, null: bytes | None = b"") -> list:
    """A string column as UTF-8 bytes; nulls become ``null``."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    values = column.to_pylist()
    return values if null is None or not column.null_count else [null if v is None else v for v in values]


def word_hashes(words: list[bytes], memo: dict) -> np.ndarray:
    """64-bit hash of each word (xxh64, the same in every task); frequent words come from the memo."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    try:
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    except KeyError:
        pass
    out = np.empty(len(words), np.uint64)
    get, room = memo.get, len(memo) < MEMO_WORDS
    for i, w in enumerate(words):
        h = get(w)
        if h is None:
            h = digest(w)
            if room and len(w) <= MEMO_WORD_BYTES:
                memo[w] = h
        out[i] = h
    return out


def window_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every k consecutive values: a polynomial over mod 2^64, then a mixer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    f = np.uint64(FACTOR ^ (seed << 1))
    with np.errstate(over="ignore"):
        if k <= 12:
            for j in range(k):
                out *= f
                out += h[j:j + n]
        else:  # doubling: hashes of 2m values from hashes of m
            m, part, power = 1, h, f
            done = 0
            rest = k
            while rest:
                if rest & 1:
                    out *= power
                    out += part[done:done + n]
                    done += m
                rest >>= 1
                if rest:
                    part = part[:len(part) - m] * power + part[m:]
                    power = power * power
                    m *= 2
        return mix(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def id_or_least(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(NULL_ID))


def parts_for(rows: int, per_part: int) -> int:
    """Partitions so that each holds about ``per_part`` rows."""
    return max(1, -(-rows // per_part))
