"""Shared by the vector searches: which vectors take part, blocks of queries, and merging what blocks found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

QUERY_BLOCK = 2048  # queries sent to the executors at once


def usable(rows: DataFrame, vector: str, *, nonzero: bool) -> DataFrame:
    """(vec_id, vec) of rows with an id whose vector is not null and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite
    if nonzero:
        fine = fine & F.exists(vector, lambda x: x != 0)
    return rows.where(fine).select("vec_id", F.col(vector).cast("array<double>").alias("vec"))


def blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> Iterator[tuple[np.ndarray, list]]:
    """Ids and vectors of at most ``size`` queries at a time; the driver holds one block."""
    ids, vecs = [], []
    for row in queries.toLocalIterator():
        ids.append(row["vec_id"])
        vecs.append(np.asarray(row["vec"], dtype=np.float64))
        if len(ids) == size:
            yield np.array(ids, dtype=np.int64), vecs
            ids, vecs = [], []
    if ids:
        yield np.array(ids, dtype=np.int64), vecs


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, best first."""
    if len(ids) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of what all blocks found."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
