"""Exact top-k by inner product over an impact-ordered index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.llm.common import stored

K = 20
SCALE = 64
# Vectors of one index block and of one query block. They bound what a task
# holds; every query meets every block.
INDEX_BLOCK = 16_384
QUERY_BLOCK = 2_048
# Queries whose accumulators a task holds at once.
_STEP = 128
# Shares of a block's largest impact at which its posting segments are cut.
_CUTS = (0.3, 0.1, 0.0)
# Once so few of a block's vectors may belong, they are scored exactly.
_FEW = 0.04


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; null where any is null or not finite."""
    def bad(x: Column) -> Column:
        wide = x.cast("double")
        return wide.isNull() | F.isnan(wide) | (F.abs(wide) == float("inf"))

    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(vector.isNotNull() & ~F.exists(vector, bad), whole)


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class _Index:
    """Posting segments of one block, by descending quantised impact.

    Segment s of the block holds, for every dimension, the postings (vector,
    impact) whose impact size lies between two cuts; a vector has each of its
    dimensions in exactly one segment. ``rest`` is the norm of what a vector
    has in later segments, the proof's bound on what is still to come.
    """

    def __init__(self, rows: np.ndarray, ids: np.ndarray, impacts: np.ndarray):
        self.rows, self.ids, self.impacts = rows, ids, impacts
        size = np.abs(impacts.astype(np.float64))
        top = size.max(initial=0.0)
        # Single precision does while squares stay in range; the margin covers its error.
        self.kind, self.margin = (np.float32, 1e-5) if top < 1e9 else (np.float64, 1e-12)
        self.norms = np.sqrt((size * size).sum(1))
        self.segments, self.rest, high = [], [], np.inf
        for cut in _CUTS:
            inside = (size >= cut * top) & (size < high)
            high = cut * top
            self.segments.append(np.where(inside, impacts, 0).astype(self.kind).T.copy())
            later = np.where(size < high, size, 0.0)
            self.rest.append(np.sqrt((later * later).sum(1)))

    def search(self, query_rows: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
        wide = queries.astype(np.float64)
        norms = np.sqrt((wide * wide).sum(1))
        wide = wide.astype(self.kind)
        own = query_rows[:, None] == self.rows[None, :]
        have = np.zeros(own.shape, self.kind)
        # With fewer vectors than places nothing can be ruled out.
        place = len(self.ids) - k - 1
        alive = ~own
        for segment, rest in zip(self.segments, self.rest):
            have += wide @ segment
            if place < 0:
                break
            # What is to come is at most the product of the norms (Cauchy-Schwarz).
            bound = np.outer(norms, rest + self.margin * self.norms).astype(self.kind) * self.kind(1.0001)
            low = have - bound
            low[own] = -np.inf
            # The query's own row may take a place below, so look one further.
            floor = np.partition(low, place, axis=1)[:, place]
            alive = (have + bound >= floor[:, None]) & ~own
            if alive.sum() <= max(2 * k, _FEW * len(self.ids)) * len(queries):
                break
        for i in range(len(queries)):
            rows = np.flatnonzero(alive[i])
            exact = self.impacts[rows] @ queries[i]
            best = np.lexsort((self.ids[rows], -exact))[:k]
            yield pd.DataFrame(
                {"query": query_rows[i], "vec_id": self.ids[rows[best]], "score": exact[best]}
            )


def _search(k: int):
    def run(key, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: np.array([], np.int64) for c in ("query", "vec_id", "score")})
        if index.empty or queries.empty:
            return empty
        width = max(index["impacts"].map(len).max(), queries["impacts"].map(len).max())
        own, ids = index["row"].to_numpy(np.int64), index["vec_id"].to_numpy(np.int64)
        block = _Index(own, ids, _matrix(index["impacts"], width))
        ids, rows = queries["row"].to_numpy(np.int64), _matrix(queries["impacts"], width)
        parts = [
            found
            for at in range(0, len(ids), _STEP)
            for found in block.search(ids[at : at + _STEP], rows[at : at + _STEP], k)
        ]
        return pd.concat(parts, ignore_index=True) if parts else empty

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    index_block: int = INDEX_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k highest scores of each query: query_id, rank (from 1), vec_id, score.

    ``vectors`` has vec_id and embedding. Components become floor(scale * x),
    the impacts; a score is their inner product, an integer. Queries are the
    rows where ``is_query`` holds, candidates all rows but the query's own; ties
    go to the smaller vec_id, and fewer than k candidates are returned all.

    Vectors are dealt by hash into index blocks of about ``index_block`` rows
    and queries into blocks of ``query_block``; each pair of blocks is a task of
    its own, of bounded size. A task works posting segments off by descending
    impact, stops when what is left cannot change the members, and scores those
    that may belong exactly. Each block gives k rows for a query, of which a
    window keeps k; Spark limits each partition's groups before the shuffle.

    Vectors that are null or hold null or non-finite components take no part;
    rows without vec_id neither. Shorter vectors count as ending in zeros. Rows
    with one vec_id are queries and candidates each, of each other too; a query
    then has its k ranks for every such row. Scores must fit a long. No rows: no
    rows.
    """
    impacts = quantised(F.col("embedding"), scale)
    rows = stored(
        vectors.where(F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), impacts.alias("impacts"), is_query.alias("asks"))
        .where(F.col("impacts").isNotNull())
        # Written down, so that a row keeps its number.
        .withColumn("row", F.monotonically_increasing_id()),
        "impacts",
    )
    n, asked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    n_index = max(1, math.ceil(n / index_block))
    n_query = max(1, math.ceil(asked / query_block))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        return df.select("row", "vec_id", "impacts", mine, every)

    index = dealt(rows, "_i", n_index, "_q", n_query)
    asking = rows.where("asks")
    queries = dealt(asking, "_q", n_query, "_i", n_index)
    found = (
        index.groupBy("_i", "_q")
        .cogroup(queries.groupBy("_i", "_q"))
        .applyInPandas(_search(k), "query long, vec_id long, score long")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ids = asking.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .join(ids, "query")
        .select("query_id", "rank", "vec_id", "score")
    )
