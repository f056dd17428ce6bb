"""Exact top-k search by aggregation without random access.

Each dimension of a block of vectors is a list sorted by value. For a query the
list is read from the end its weight favours. At some depth the entries read
give every vector a lower and an upper score: what is unread in a list lies
between its last value and the value read last. Reading goes deeper until no
vector outside can reach the best ones, and their scores are then resolved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tradeloom.llm.common import col, one_by_one, single_threaded
from tradeloom.operators.stage import staged

#: Shares of the lists that are read one after the other.
DEPTHS = (0.06, 0.25, 0.6, 1.0)


class SortedLists:
    """A block of vectors (rows), as one sorted list for each dimension.

    ``rank[i, d]`` is the place of vector i in the list of dimension d, from
    the largest value on.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values.astype(np.float64)
        order = np.argsort(-self.values, axis=0, kind="stable")
        self.lists = np.take_along_axis(self.values, order, axis=0)
        self.rank = np.empty(order.shape, np.int32)
        np.put_along_axis(self.rank, order, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)

    def bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper scores, queries by vectors, after ``depth`` entries
        of each list from its favourable end."""
        n = len(self.ids)
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        lower, upper = np.zeros((len(queries), n)), np.zeros((len(queries), n))
        for weights, read, last, worst in (
            (plus, self.rank < depth, self.lists[depth - 1], self.lists[-1]),
            (minus, self.rank >= n - depth, self.lists[n - depth], self.lists[0]),
        ):
            seen = weights @ np.where(read, self.values, 0).T
            lower += seen + weights @ np.where(read, 0, worst).T
            upper += seen + weights @ np.where(read, 0, last).T
        return lower, upper


class Best:
    """The ``k`` best vectors of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids = np.concatenate([self.ids[query], ids])
        scores = np.concatenate([self.scores[query], scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids[query], self.scores[query] = ids[order], scores[order]


def search_block(block: SortedLists, query_ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """Add the block's best vectors to ``best``."""
    n, k = len(block.ids), best.k
    open_, depths = np.arange(len(queries)), sorted({min(n, max(1, round(n * share))) for share in DEPTHS})
    for depth in depths:
        for part in np.array_split(open_, max(1, len(open_) * n // 4_000_000)):
            lower, upper = block.bounds(queries[part], depth)
            lower[block.ids[None, :] == query_ids[part, None]] = -np.inf
            upper[block.ids[None, :] == query_ids[part, None]] = -np.inf
            # The k-th best lower score, over this block and all before it.
            floor = best.scores[part, -1]
            if n >= k:
                floor = np.maximum(floor, np.partition(lower, n - k, axis=1)[:, n - k])
            able = upper >= floor[:, None]
            able &= np.isfinite(upper)
            few = able.sum(axis=1) <= max(4 * k, n // 50) if depth < n else np.ones(len(part), bool)
            for row in np.flatnonzero(few):
                mine = np.flatnonzero(able[row])
                if len(mine):
                    best.add(part[row], block.ids[mine], block.values[mine] @ queries[part[row]])
            open_ = np.setdiff1d(open_, part[few], assume_unique=True)
        if not len(open_):
            return


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, v``: vectors as whole numbers, without those that take no part."""
    v = col(vector_col).cast("array<double>")
    sound = v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.filter(sound & col(id_col).isNotNull()).select(
        col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v")
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    queries_at_once: int = 8192,
    block_rows: int = 8192,
) -> DataFrame:
    """The ``k`` vectors of the highest inner product for each query.

    Components become ``floor(scale * x)``. Returns ``query_id, rank, vec_id,
    score``, ranks from 1, ties to the smaller id; fewer than ``k`` if there are
    not as many. A query never finds its own id. Vectors that are null or hold
    null or non-finite components, and rows of null id, take no part; vectors of
    another length than the query's are not compared with it. Rows repeated
    with the same id and vector count once in the result of a query, and so do
    repeated queries. No queries or no vectors: an empty table. Scores must
    stay below 2**53.

    At scale: queries are sent to the tasks in blocks of ``queries_at_once``
    (8,192 vectors of 64 components are 4 MB), each block a pass over all
    vectors; the driver holds one block at a time. A task keeps one block of ``block_rows`` vectors and the best ``k``
    of each query, and hands on only the latter.
    """
    spark = vectors.sparkSession
    whole = staged(whole_vectors(vectors, id_col, vector_col, scale).distinct(), "vectors")
    asked = staged(
        whole_vectors(queries, id_col, vector_col, scale).distinct().repartitionByRange("id").sortWithinPartitions("id"), "queries"
    )
    sizes = asked.groupBy(F.size("v").alias("width")).count().collect()

    def passes() -> Iterator[DataFrame]:
        for size in sizes:
            same = asked.filter(F.size("v") == size.width)
            blocks = -(-size["count"] // queries_at_once)
            for number in range(blocks if size.width else 0):
                part = same if blocks == 1 else same.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number)
                if rows := part.collect():
                    ids, values = np.array([r.id for r in rows], np.int64), np.array([r.v for r in rows], np.float64)
                    yield whole.filter(F.size("v") == size.width).mapInPandas(
                        searcher(ids, values, k, block_rows), "query_id bigint, vec_id bigint, score bigint"
                    )

    found = one_by_one(passes(), "found-vectors")
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def searcher(query_ids: np.ndarray, queries: np.ndarray, k: int, block_rows: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_threaded()
        best, waiting, rows = Best(len(queries), k), [], 0

        def flush() -> None:
            ids = np.concatenate([b["id"].to_numpy(np.int64) for b in waiting])
            values = np.concatenate([np.stack(b["v"].to_numpy()) for b in waiting])
            search_block(SortedLists(ids, values), query_ids, queries, best)

        for batch in batches:
            if len(batch):
                waiting.append(batch)
                rows += len(batch)
            if rows >= block_rows:
                flush()
                waiting, rows = [], 0
        if waiting:
            flush()
        query, place = np.nonzero(np.isfinite(best.scores))
        yield pd.DataFrame(
            {
                "query_id": query_ids[query],
                "vec_id": best.ids[query, place],
                "score": best.scores[query, place].astype(np.int64),
            }
        )

    return search
