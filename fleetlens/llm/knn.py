"""Exact top-k by inner product: a Voronoi kNN join.

1. Pivots (k-means centres of a bounded sample) divide all vectors; each vector keeps its group and its
   distance d to the pivot. Groups are cut into rings of d, so a cell is (group, ring).
2. Summaries: rows and largest distance of each cell (at most PIVOTS x RINGS rows come to the driver).
3. Each query is first solved inside its own group; its k-th score there is a lower bound.
4. For every other cell, score(q, x) = q.p + q.(x - p) <= q.p + |q| * largest distance. Only where that
   reaches the query's bound, the query is copied to the cell. Queries are the small side, so they are what
   is replicated; data vectors move once, to their cell.
5. Cells are solved locally by matrix products, and the best k of all cells are merged per query.

Cells with many rows are split by a salt of the id (a vector that a third of all rows share makes many
tasks, not one), and query sets beyond QUERY_BLOCK go to the cells in blocks.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a null id, take
no part; of rows that share an id, the largest vector (in array order) takes part; shorter vectors count as
padded with zeros; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import keep, parts_for, prepare, table
from fleetlens.llm.registry import query

SCALE = 1024
PIVOTS, RINGS, SAMPLE = 32, 8, 2048
CELL_ROWS, QUERY_BLOCK = 40_000, 50_000
#: Room for rounding in bounds that are computed with doubles.
SLACK = 1e-6


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components floor(scale * x), for the rows that take part."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    usable = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.max("v").alias("v"))


def _matrix(column, dims: int, dtype=np.float64) -> np.ndarray:
    """List column as rows of a matrix, padded with zeros."""
    out = np.zeros((len(column), dims), dtype)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def centres(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's k-means from evenly spaced rows of the sample."""
    distinct = np.unique(sample, axis=0)
    c = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        own = np.argmin((c * c).sum(1) - 2 * (sample @ c.T), axis=1)
        c = np.array([sample[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
    return c


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, in order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _solver(dims: int, k: int, exact_float: bool):
    kind = np.float64 if exact_float else np.int64

    def run(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(data) and len(queries):
            x, ids = _matrix(data["v"], dims, kind), data["vec_id"].to_numpy()
            for at in range(0, len(queries), 64):
                part = queries.iloc[at:at + 64]
                scores = (_matrix(part["v"], dims, kind) @ x.T).astype(np.int64)
                for q, floor, s in zip(part["query_id"].to_numpy(), part["floor"].to_numpy(), scores):
                    can = np.flatnonzero((s >= floor) & (ids != q))
                    top = can[best(s[can], ids[can], k)]
                    out.append(pd.DataFrame({"query_id": q, "vec_id": ids[top], "score": s[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score). ``vectors``: (vec_id, v long array); is_query: condition on vec_id."""
    spark = prepare(vectors.sparkSession)
    v = keep(vectors, "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n, n_queries, dims, widest = v.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.max(F.size("v")),
        F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))).first()
    if not n or not n_queries:
        return empty
    dims = max(dims, 1)
    exact_float = dims * float(widest or 0) ** 2 < 2.0 ** 53
    # pivots need no exact number: a threshold on the hash takes about SAMPLE rows (all, if fewer)
    sample = v.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) < SAMPLE).orderBy("vec_id").limit(2 * SAMPLE).select("v").toPandas()
    c = spark.sparkContext.broadcast(centres(_matrix(sample["v"], dims), pivots))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = c.value
        for b in batches:
            x = _matrix(b.column(1).to_pylist(), dims)
            own = np.argmin((p * p).sum(1) - 2 * (x @ p.T), axis=1) if len(x) else np.zeros(0, np.int64)
            d = np.sqrt(((x - p[own]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own.astype(np.int32)), pa.array(d)],
                                             names=["vec_id", "v", "cell_group", "d"])

    placed = keep(v.mapInArrow(assign, "vec_id long, v array<long>, cell_group int, d double"), "placed")
    reach = {r["cell_group"]: r["d"] for r in placed.groupBy("cell_group").agg(F.max("d").alias("d")).collect()}
    width = F.element_at(F.create_map(*[x for g, d in reach.items() for x in (F.lit(g), F.lit(d / RINGS or 1.0))]), F.col("cell_group"))
    ringed = placed.withColumn("ring", F.least(F.floor(F.col("d") / width), F.lit(RINGS - 1)).cast("int"))
    cells = ringed.groupBy("cell_group", "ring").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).collect()
    summary = [(r["cell_group"], r["ring"], float(r["d"]), parts_for(r["n"], CELL_ROWS)) for r in cells]
    blocks = parts_for(n_queries, QUERY_BLOCK)
    salts = F.element_at(F.create_map(*[x for g, r, _, s in summary for x in (F.lit(g * RINGS + r), F.lit(s))]),
                         F.col("cell_group") * RINGS + F.col("ring"))
    data = (ringed.withColumn("salt", F.pmod(F.xxhash64("vec_id"), salts).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    queries = placed.where(is_query).select(F.col("vec_id").alias("query_id"), "v", "cell_group")
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    key = ["cell_group", "ring", "salt", "block"]
    solve = _solver(dims, k, exact_float)
    result = "query_id long, vec_id long, score long"

    def visits(own: bool):
        """Copies of each query for the cells that it must visit."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = c.value
            for b in batches:
                x = _matrix(b.column(1).to_pylist(), dims)
                home, floor = b.column(2).to_numpy(), b.column(3).to_numpy()
                to_pivot, length = x @ p.T, np.sqrt((x * x).sum(1))
                rows = []
                for g, ring, d, salt_n in summary:
                    bound = to_pivot[:, g] + length * d
                    bound += SLACK * (1 + np.abs(bound))
                    for i in np.flatnonzero(home == g if own else (home != g) & (bound >= floor)):
                        rows += [(int(i), g, ring, s) for s in range(salt_n)]
                at = np.array([r[0] for r in rows], np.int64)
                for lo in range(0, len(rows), 1000):
                    part, take = rows[lo:lo + 1000], pa.array(at[lo:lo + 1000])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(take), b.column(1).take(take), b.column(3).take(take),
                         *(pa.array([r[j] for r in part], pa.int32()) for j in (1, 2, 3))],
                        names=["query_id", "v", "floor", "cell_group", "ring", "salt"])

        return run

    def solved(asking: DataFrame, own: bool) -> DataFrame:
        sent = asking.select("query_id", "v", "cell_group", "floor").mapInArrow(
            visits(own), "query_id long, v array<long>, floor long, cell_group int, ring int, salt int").withColumn("block", block)
        return data.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(lambda a, b: solve(a, b), result)

    least = -(2 ** 63)
    first = keep(solved(queries.withColumn("floor", F.lit(least)), True), "own-cells")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    asking = queries.join(kth, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(least)))
    found = first.unionByName(solved(asking, False))
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op10_knn", """
WITH v AS (
  SELECT vec_id, max([floor(1024 * x::DOUBLE) for x in embedding]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)
