"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

A rotation learned on a bounded sample turns vectors into 64 bits. The code is cut into substrings, each with its own
buckets. A code within radius r of the query agrees with it, in at least one substring, up to a share of r: so probing
the buckets within that share finds every code within r. Those are reranked by the inner product of the vectors. The
radius is learned too, as the distance within which the sample's own neighbours lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import Scratch
from tallyfold.llm.vectors import best, blocks, ranked, usable

BITS = 64
PARTS = 8  # substrings of a code, of 8 bits each
#: Bounds of the sample that rotation and radius are learned on, and of the queries among it.
SAMPLE_ROWS, SAMPLE_QUERIES = 8192, 256
#: Share of the sample's neighbours that the radius must cover.
COVER = 0.97

_OUT = "query_id long, vec_id long, score double"
_WEIGHT = np.array([bin(v).count("1") for v in range(256)], dtype=np.uint8)


@dataclass
class Model:
    dims: int
    mean: np.ndarray
    turn: np.ndarray  # dims x BITS
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One unsigned 64-bit code per row."""
        bits = (vectors - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def learn(rows: DataFrame, k: int, *, sample_rows: int = SAMPLE_ROWS, steps: int = 30) -> Model | None:
    """Rotation and radius from the rows of the smallest hash of vec_id; None if there are no rows.

    The vectors' length is the most common one of the sample.
    """
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    if not picked:
        return None
    lengths = np.array([len(r["vec"]) for r in picked])
    dims = int(np.bincount(lengths).argmax())
    x = np.array([r["vec"] for r in picked if len(r["vec"]) == dims])
    rng = np.random.default_rng(0)
    mean = x.mean(axis=0)
    centred = x - mean
    main = np.linalg.svd(centred.T @ centred)[0]
    # As many directions as bits: the main ones, turned at random for every further set.
    sets = [main if s == 0 else main @ np.linalg.qr(rng.normal(size=(dims, dims)))[0] for s in range(-(-BITS // dims))]
    project = np.concatenate(sets, axis=1)[:, :BITS]
    flat = centred @ project
    turn = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
    for _ in range(steps):
        left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
        turn = (left @ right).T
    model = Model(dims, mean, project @ turn, BITS)
    asked = min(SAMPLE_QUERIES, len(x))
    scores = x[:asked] @ x.T
    scores[np.arange(asked), np.arange(asked)] = -np.inf
    near = np.argsort(-scores, axis=1)[:, :min(k, len(x) - 1)]
    codes = model.codes(x)
    apart = np.bitwise_count(codes[:asked, None] ^ codes[near])
    model.radius = int(np.quantile(apart, COVER, method="higher")) if apart.size else BITS
    return model


class Index:
    """Buckets of every substring over one block of rows."""

    def __init__(self, model: Model, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, model.codes(vectors)
        parts = self.codes.view(np.uint8).reshape(-1, PARTS)
        self.order = [np.argsort(parts[:, j], kind="stable") for j in range(PARTS)]
        self.starts = [np.concatenate(([0], np.cumsum(np.bincount(parts[:, j], minlength=256)))) for j in range(PARTS)]

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` of ``code``."""
        share, more = divmod(radius, PARTS)
        seen = np.zeros(len(self.ids), dtype=bool)
        for j, value in enumerate(np.array([code]).view(np.uint8).tolist()):
            reach = share if j <= more else share - 1
            if reach < 0:
                continue
            probes = np.flatnonzero(_WEIGHT <= reach) ^ value
            first, size = self.starts[j][probes], np.diff(self.starts[j])[probes]
            place = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            seen[self.order[j][place]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]

    def nearest(self, query_id: int, query: np.ndarray, code: np.uint64, radius: int, k: int):
        """Ids and scores of the k best within the radius, which widens until there are k."""
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != query_id]
            if len(rows) >= k or radius >= BITS:
                break
            radius = min(BITS, radius + PARTS // 2)
        scores = np.einsum("ij,j->i", self.vectors[rows], query)
        top = best(self.ids[rows], scores, k)
        return self.ids[rows][top], scores[top]


def search(rows: DataFrame, queries: DataFrame, k: int, *, model: Model | None, scratch: Scratch) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found; ``rows`` and ``queries`` have vec_id and vec.

    Queries go to all rows block by block. Each task indexes its rows as they come and keeps k of them per query.
    """
    empty = rows.sparkSession.createDataFrame([], _OUT)
    if model is None:
        return ranked(empty, k)
    parts = []
    same = F.size("vec") == model.dims
    for number, (ids, vecs) in enumerate(blocks(queries.where(same))):
        sent = rows.sparkSession.sparkContext.broadcast((model, ids, np.array(vecs)))

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            model, query_ids, query_vecs = sent.value
            codes = model.codes(query_vecs)
            held: list = [None] * len(query_ids)
            for batch in batches:
                if not len(batch):
                    continue
                index = Index(model, batch["vec_id"].to_numpy(), np.stack(batch["vec"].to_numpy()))
                for q, (query_id, query, code) in enumerate(zip(query_ids, query_vecs, codes)):
                    found, scores = index.nearest(query_id, query, code, model.radius, k)
                    if held[q] is not None:
                        found, scores = np.append(held[q][0], found), np.append(held[q][1], scores)
                        top = best(found, scores, k)
                        found, scores = found[top], scores[top]
                    held[q] = found, scores
            some = [(q, *h) for q, h in zip(query_ids, held) if h is not None]
            if some:
                yield pd.DataFrame({"query_id": np.repeat([q for q, _, _ in some], [len(f) for _, f, _ in some]),
                                    "vec_id": np.concatenate([f for _, f, _ in some]),
                                    "score": np.concatenate([s for _, _, s in some])})

        parts.append(scratch.keep(ranked(rows.where(same).mapInPandas(run, _OUT), k), f"found/block={number}"))
        sent.unpersist()
    if not parts:
        return ranked(empty, k)
    return rows.sparkSession.read.schema(parts[0].schema).parquet(f"{scratch.folder}/found").drop("block")


def nearest(table: DataFrame, *, every: int = 20, k: int = 20, vector: str = "embedding") -> DataFrame:
    """The k nearest rows, by inner product, of each row whose vec_id is divisible by ``every``.

    Rows without vec_id, vectors that are null, zero or hold a null or non-finite component, and vectors of another
    length than most of the sample take no part. A row is no candidate of its own vec_id; of rows that repeat a vec_id the
    smallest vector is the query. Other columns are not read.
    """
    scratch = Scratch(table.sparkSession, "ann")
    rows = scratch.keep(usable(table, vector, nonzero=True), "rows")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    return search(rows, asked, k, model=learn(rows, k), scratch=scratch)
