"""Hard-negative mining with exact scores by Four-Russians tables.

Candidates are stored as packed bit planes: for every bit of the two's complement, and every group of eight dimensions, one
byte per candidate. For an anchor, the sums of all 256 subsets of each group of eight components are worked out once; a
candidate's byte then looks up what its plane adds in that group, and planes are added by shifts. That is the full inner
product, not an estimate. Anchors and candidates meet block by block: blocks of both sides are keyed by their numbers and
joined, so neither side passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import Scratch
from tallyfold.llm.vectors import best, usable

GROUP = 8  # dimensions of a table
SCALE = 256.0
#: Rows of a block of candidates and of anchors. Smaller tables are cut into up to SPREAD blocks of candidates.
CANDIDATES, ANCHORS, SPREAD = 16384, 4096, 48
LANES = 64  # anchors whose tables are looked up together
PAIRS = 4  # pairs of blocks that go to Python at once
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x): 64-bit integers, or Python's where those do not hold them."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * SCALE)
    if not scaled.size or np.abs(scaled).max() < 1 << 62:
        return scaled.astype(np.int64)
    out = np.empty(vectors.shape, dtype=object)
    # Beyond 2 ** 60 a double is a whole number.
    out.flat = [math.floor(x * SCALE) if abs(x) < 1 << 60 else int(x) * int(SCALE) for x in vectors.ravel().tolist()]
    return out


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bytes of shape (planes, groups, rows): bit d of a byte is the plane's bit of dimension d of the group.

    The planes are the two's complement, least significant first; the last one is the sign.
    """
    rows, dims = values.shape
    width = max((int(v).bit_length() for v in (values.min(), values.max())), default=0) + 1 if values.size else 1
    groups = -(-dims // GROUP)
    out = np.zeros((width, groups, rows), dtype=np.uint8)
    for plane in range(width):
        bits = ((values >> plane) & 1).astype(np.uint8)
        out[plane] = np.packbits(bits, axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray, groups: int) -> np.ndarray:
    """Tables of shape (groups, 256, anchors): the sum of every subset of the eight components of a group."""
    n, dims = anchors.shape
    padded = np.zeros((n, groups * GROUP), dtype=anchors.dtype)
    padded[:, :min(dims, groups * GROUP)] = anchors[:, :groups * GROUP]
    columns = padded.reshape(n, groups, GROUP)
    tables = np.zeros((groups, 1 << GROUP, n), dtype=anchors.dtype)
    for bit in range(GROUP):
        tables[:, 1 << bit:2 << bit] = tables[:, :1 << bit] + columns[:, :, bit].T[:, None, :]
    return tables


def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of shape (candidates, anchors); beyond 64 bits the nearest 64-bit integer."""
    width, groups, rows = planes.shape
    # The tables' sums, shifted by all planes, bound every number on the way.
    most = max((int(x) for x in np.abs(anchors).sum(axis=1)), default=0) << width
    if most < 1 << 62:
        anchors = anchors.astype(np.int32 if most < 1 << 30 else np.int64)
    else:
        anchors = anchors.astype(object)
    tables = subset_sums(anchors, groups)
    total = np.zeros((rows, len(anchors)), dtype=tables.dtype)
    for plane in range(width - 1, -1, -1):
        added = np.zeros_like(total)
        for group in range(groups):
            added += tables[group][planes[plane, group]]
        total = total * 2 + (-added if plane == width - 1 else added)
    if total.dtype == object:
        total = np.array([min(max(x, _LOW), _HIGH) for x in total.ravel()], dtype=np.int64).reshape(total.shape)
    return total.astype(np.int64)


def _filled(vectors) -> np.ndarray:
    """Vectors side by side; shorter ones end in zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for row, vector in zip(out, vectors):
        row[:len(vector)] = vector
    return out


def candidate_blocks(rows: DataFrame, count: int) -> DataFrame:
    """(block, ids, labels, planes, shape): candidates in ``count`` blocks, each in the order of its ids."""
    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("vec_id")
        planes = bit_planes(whole(_filled(block["vec"].tolist())))
        return pd.DataFrame({"block": block["block"].iloc[:1].to_numpy(), "ids": [block["vec_id"].to_numpy().tobytes()],
                             "labels": [block["label"].to_numpy().tobytes()], "planes": [planes.tobytes()],
                             "shape": [list(planes.shape)]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)))
    return dealt.groupBy("block").applyInPandas(
        pack, "block long, ids binary, labels binary, planes binary, shape array<int>")


def anchor_blocks(anchors: DataFrame, count: int) -> DataFrame:
    """(anchor_block, anchor_ids, anchor_labels, vecs, dims, owners, positives, positive_scores): anchors in blocks.

    ``anchors`` has an array ``positives`` of (positive_id, positive_score); owners says whose each one is.
    """
    def pack(block: pd.DataFrame) -> pd.DataFrame:
        vecs = _filled(block["vec"].tolist())
        lists = block["positives"].tolist()
        flat = [p for one in lists for p in one]
        owners = np.repeat(np.arange(len(block)), [len(one) for one in lists])
        return pd.DataFrame({
            "anchor_block": block["anchor_block"].iloc[:1].to_numpy(), "anchor_ids": [block["vec_id"].to_numpy().tobytes()],
            "anchor_labels": [block["label"].to_numpy().tobytes()], "vecs": [vecs.tobytes()], "dims": [vecs.shape[1]],
            "owners": [owners.astype(np.int64).tobytes()],
            "positives": [np.array([p["positive_id"] for p in flat], dtype=np.int64).tobytes()],
            "positive_scores": [np.array([p["positive_score"] for p in flat], dtype=np.int64).tobytes()]})

    dealt = anchors.withColumn("anchor_block", F.pmod(F.xxhash64("vec_id"), F.lit(count)))
    return dealt.groupBy("anchor_block").applyInPandas(
        pack, "anchor_block long, anchor_ids binary, anchor_labels binary, vecs binary, dims int, owners binary, "
              "positives binary, positive_scores binary")


def met(anchors: DataFrame, candidates: DataFrame, n_anchors: int, n_candidates: int) -> DataFrame:
    """Every block of anchors beside every block of candidates, joined by the numbers of both."""
    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = anchors.withColumn("block", numbers(n_candidates))
    return left.join(candidates.withColumn("anchor_block", numbers(n_anchors)), ["anchor_block", "block"])


def _scored(pair) -> Iterator[tuple]:
    """(first anchor, ids, labels, scores) of a pair of blocks, for LANES anchors at a time."""
    planes = np.frombuffer(pair.planes, dtype=np.uint8).reshape(pair.shape)
    own = np.frombuffer(pair.anchor_ids, dtype=np.int64)
    vecs = whole(np.frombuffer(pair.vecs, dtype=np.float64).reshape(len(own), pair.dims))
    ids, labels = (np.frombuffer(x, dtype=np.int64) for x in (pair.ids, pair.labels))
    for first in range(0, len(own), LANES):
        yield first, ids, labels, scores(vecs[first:first + LANES], planes)


def best_positives(pairs: DataFrame, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the k highest rows of the same label, of each pair of blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                own = np.frombuffer(pair.anchor_ids, dtype=np.int64)
                mine = np.frombuffer(pair.anchor_labels, dtype=np.int64)
                out = []
                for first, ids, labels, found in _scored(pair):
                    for lane in range(found.shape[1]):
                        at = np.flatnonzero((labels == mine[first + lane]) & (ids != own[first + lane]))
                        top = at[best(ids[at], found[at, lane], k)]
                        out.append((np.full(len(top), own[first + lane]), ids[top], found[top, lane]))
                yield pd.DataFrame(dict(zip(("anchor_id", "positive_id", "positive_score"), map(np.concatenate, zip(*out)))))

    return pairs.mapInPandas(run, "anchor_id long, positive_id long, positive_score long")


def best_negatives(pairs: DataFrame, k: int, least: int, most: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score): the k highest rows of another label whose
    score is between ``least`` and ``most`` hundredths of the positive's, of each pair of blocks."""
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                own = np.frombuffer(pair.anchor_ids, dtype=np.int64)
                mine = np.frombuffer(pair.anchor_labels, dtype=np.int64)
                owners, positives, reached = (
                    np.frombuffer(x, dtype=np.int64) for x in (pair.owners, pair.positives, pair.positive_scores))
                starts = np.searchsorted(owners, np.arange(len(own) + 1))
                out = []
                for first, ids, labels, found in _scored(pair):
                    for lane in range(found.shape[1]):
                        anchor = first + lane
                        other = np.flatnonzero(labels != mine[anchor])
                        told = found[other, lane]
                        for p in range(starts[anchor], starts[anchor + 1]):
                            high = int(reached[p])
                            at = other[(told >= -(-least * high // 100)) & (told <= most * high // 100)]
                            top = at[best(ids[at], found[at, lane], k)]
                            n = len(top)
                            out.append((np.full(n, own[anchor]), np.full(n, positives[p]), np.full(n, high), ids[top], found[top, lane]))
                if out:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))

    return pairs.mapInPandas(run, ", ".join(f"{c} long" for c in names))


def _highest(found: DataFrame, keys: list[str], score: str, row: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(table: DataFrame, *, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
         vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``. The score of a row is its inner product with the anchor
    over floor(256 x). An anchor's positives are its ``positives`` highest other rows of the same label; for each, the
    ``negatives`` highest rows of another label that reach between ``least`` and ``most`` hundredths of its score. Ties go
    to smaller ids; fewer rows than asked for are all given. Negative scores have no such range, so they get no row.

    Rows with a null vec_id, label or vector, or a null or non-finite component, take no part. Rows that repeat a vec_id are
    one row, that of the smallest label and then vector. Vectors of different lengths meet as if the shorter one ended in
    zeros. Scores beyond 64 bits count as the nearest 64-bit integer. Labels are whole numbers. Other columns are not read.
    """
    spark, scratch = table.sparkSession, Scratch(table.sparkSession, "negatives")
    plain = table.select("vec_id", F.col(label).cast("long").alias("label"), F.col(vector).alias("given"))
    known = plain.where("vec_id IS NOT NULL AND label IS NOT NULL").withColumn("vec_id", F.struct("vec_id", "label"))
    fine = usable(known, "given", nonzero=False).select("vec_id.*", "vec")
    rows = fine.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row")).select("vec_id", "row.*")
    rows = scratch.keep(rows, "rows")
    asked = rows.where(F.col("vec_id") % every == 0)
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("asked")).first()
    if not sizes["asked"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    n_candidates = max(-(-sizes["n"] // CANDIDATES), min(SPREAD, -(-sizes["n"] // (CANDIDATES // 16))))
    n_anchors = -(-sizes["asked"] // ANCHORS)
    index = scratch.keep(candidate_blocks(rows, n_candidates), "index")

    def pairs(with_positives):
        return met(anchor_blocks(with_positives, n_anchors), index, n_anchors, n_candidates)

    none = F.array().cast("array<struct<positive_id:bigint,positive_score:bigint>>")
    batch = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(PAIRS)}
    found = scratch.keep(best_positives(pairs(asked.withColumn("positives", none)), positives), "near", conf=batch)
    near = _highest(found, ["anchor_id"], "positive_score", "positive_id", positives)
    lists = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    found = best_negatives(pairs(asked.join(lists, "vec_id")), negatives, least, most)
    found = scratch.keep(found, "found", conf=batch)
    scratch.drop("rows", "index", "near")
    return _highest(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
