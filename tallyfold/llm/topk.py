"""Exact top-k by inner product over a bit-sliced index.

Each block of rows stores a bitmap for every bit of every quantised attribute. A query adds the bitmaps, weighted by its
own attributes, with full adders on whole bitmaps: the result is the score of all rows as slices. The highest rows are
then picked from the most significant slice downward, and rows that tie at the boundary are resolved by their id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import Scratch
from tallyfold.llm.vectors import best, blocks, ranked, usable

BLOCK_ROWS = 1 << 15  # rows of one index
SCALE = 256.0
_OUT = "query_id long, vec_id long, score long"


def quantised(vectors, dims: int | None = None) -> np.ndarray:
    """floor(256 x) as integers; shorter vectors are filled with zeros, longer ones cut no query can see beyond."""
    width = max(map(len, vectors), default=0) if dims is None else dims
    out = np.zeros((len(vectors), width), dtype=np.float64)
    for row, vector in zip(out, vectors):
        n = min(width, len(vector))
        row[:n] = vector[:n]
    with np.errstate(over="ignore"):
        scaled = np.floor(out * SCALE)
    if not scaled.size or np.abs(scaled).max() < 1 << 28:
        return scaled.astype(np.int64)
    # Python's integers, for components whose products may not fit 64 bits. Beyond 2 ** 60 a double is a whole number.
    wide = np.empty(out.shape, dtype=object)
    wide.flat = [math.floor(x * SCALE) if abs(x) < 1 << 60 else int(x) * int(SCALE) for x in out.ravel().tolist()]
    return wide


def signed_digits(weight: int) -> list[tuple[int, int]]:
    """(place, +1 or -1) digits of a weight, no two of them adjacent."""
    out, place = [], 0
    while weight:
        if weight & 1:
            digit = 2 - (weight & 3)
            out.append((place, digit))
            weight -= digit
        weight >>= 1
        place += 1
    return out


class BitSlices:
    """The index of one block; rows are held in the order of their ids."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.low = self.values.min(axis=0, initial=0)
        above = self.values - self.low
        self.width = [int(m).bit_length() for m in above.max(axis=0, initial=0)]
        self.all = self._bitmap(np.ones(len(ids), dtype=bool))
        self.slices = [[self._bitmap((above[:, d] >> b) & 1) for b in range(w)] for d, w in enumerate(self.width)]
        self.others = [[self.all & ~s for s in one] for one in self.slices]

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(np.asarray(bits, dtype=np.uint8), bitorder="little")
        return np.concatenate([packed, np.zeros(-len(packed) % 8, dtype=np.uint8)]).view(np.uint64)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def scores(self, query: np.ndarray) -> list[np.ndarray | None]:
        """Slices, least significant first, of every row's inner product up to a constant; None has no bit set.

        A negative digit adds the complement of the attribute, which differs from its negative by a constant.
        """
        columns: list[list[np.ndarray]] = []

        def at(place):
            while len(columns) <= place:
                columns.append([])
            return columns[place]

        for d, weight in enumerate(query.tolist()):
            for place, digit in signed_digits(weight) if d < len(self.slices) else ():
                for b, bitmap in enumerate(self.slices[d] if digit > 0 else self.others[d]):
                    at(place + b).append(bitmap)
        out, place = [], 0
        while place < len(columns):
            column = columns[place]
            while len(column) > 2:
                a, b, c = column.pop(), column.pop(), column.pop()
                half = a ^ b
                column.insert(0, half ^ c)
                at(place + 1).append((a & b) | (half & c))
            if len(column) == 2:
                a, b = column
                at(place + 1).append(a & b)
                column[:] = [a ^ b]
            out.append(column[0] if column else None)
            place += 1
        return out

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k highest rows but the query's own, ties to smaller ids."""
        open_rows = self.all & ~self._bitmap(self.ids == query_id)
        sure = np.zeros_like(open_rows)
        held = 0
        for bitmap in reversed(self.scores(query)):
            if bitmap is None:
                continue
            high = open_rows & bitmap
            n = int(np.bitwise_count(high).sum())
            if held + n > k:
                open_rows = high
            else:
                sure |= high
                held += n
                open_rows &= ~bitmap
                if held == k:
                    open_rows[:] = 0
                    break
        rows = np.concatenate([self._rows(sure), self._rows(open_rows)[:k - held]])
        # A few rows, so that Python's integers hold any product.
        exact = self.values[rows][:, :len(query)].astype(object) @ query[:self.values.shape[1]].astype(object)
        exact = np.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in exact], dtype=np.int64)
        return self.ids[rows], exact


def search(rows: DataFrame, queries: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest; ``rows`` and ``queries`` have vec_id and vec.

    Queries go to all rows block by block; each task keeps k rows per query.
    """
    parts = []
    for number, (ids, vecs) in enumerate(blocks(queries)):
        sent = rows.sparkSession.sparkContext.broadcast((ids, [quantised([v])[0] for v in vecs]))

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            query_ids, query_vecs = sent.value
            held: list = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in query_ids]

            def add(index):
                for q, (query_id, query) in enumerate(zip(query_ids, query_vecs)):
                    found, scores = (np.append(a, b) for a, b in zip(held[q], index.top(query_id, query, k)))
                    top = best(found, scores, k)
                    held[q] = found[top], scores[top]

            waiting: list[pd.DataFrame] = []
            for batch in batches:
                waiting.append(batch)
                if sum(map(len, waiting)) >= BLOCK_ROWS:
                    add(_index(waiting))
                    waiting = []
            if any(map(len, waiting)):
                add(_index(waiting))
            sizes = [len(f) for f, _ in held]
            if sum(sizes):
                yield pd.DataFrame({"query_id": np.repeat(query_ids, sizes),
                                    "vec_id": np.concatenate([f for f, _ in held]),
                                    "score": np.concatenate([s for _, s in held])})

        parts.append(scratch.keep(ranked(rows.mapInPandas(run, _OUT), k), f"found/block={number}"))
        sent.unpersist()
    if not parts:
        return ranked(rows.sparkSession.createDataFrame([], _OUT), k)
    return rows.sparkSession.read.schema(parts[0].schema).parquet(f"{scratch.folder}/found").drop("block")


def _index(frames: list[pd.DataFrame]) -> BitSlices:
    rows = pd.concat(frames)
    values = quantised(rows["vec"].tolist())
    return BitSlices(rows["vec_id"].to_numpy(), values)


def highest(table: DataFrame, *, every: int = 50, k: int = 5, vector: str = "embedding") -> DataFrame:
    """The k rows of the highest integer inner product for each row whose vec_id is divisible by ``every``.

    Rows without vec_id and vectors that are null or hold a null or non-finite component take no part. Vectors of
    different lengths meet as if the shorter one ended in zeros. A row is no candidate of its own vec_id; rows that repeat a
    vec_id are candidates one by one, and the smallest vector of them is the query. Scores beyond 64 bits are
    told, and ranked, as the nearest 64-bit integer. Other columns are not read.
    """
    scratch = Scratch(table.sparkSession, "topk")
    rows = scratch.keep(usable(table, vector, nonzero=False), "rows")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    # Small bitmaps cost as much as large ones: input partitions are joined up to the rows of one index.
    few = max(1, -(-rows.count() // BLOCK_ROWS))
    return search(rows.coalesce(few), asked, k, scratch)
