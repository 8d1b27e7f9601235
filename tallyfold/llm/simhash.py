"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct fingerprint is listed under all variants within half the distance. Two fingerprints within the whole
distance share a variant, and all fingerprints of one variant are within it of each other. A variant has at most as many
fingerprints as the small ball (65 for distance 2), so a group of copies of any size costs one fingerprint, and linking
each fingerprint of a variant to the smallest one there keeps every component without listing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import Scratch, text_bytes


#: Whole texts that a worker holds at once.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64 bits; one is set if set in over half the hashes of the shingles. No word gives 0, few words one shingle."""
    words = text_bytes(text).lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hash_of = xxhash.xxh64_intdigest
    if n == 1:
        return hash_of(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    pieces = map(slice, starts[:n].tolist(), ends[width - 1:].tolist())
    hashes = np.fromiter((hash_of(joined[p], seed) for p in pieces), np.uint64, n)
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[lo:lo + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, *, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and the fingerprint as a signed long ``fp``, one row per row, also for repeated and missing ids.

    Null and empty texts have fingerprint zero. Columns beyond doc_id and text are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t, width, seed) for t in batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": prints.view(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long")


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (lo, hi) of distinct fingerprints ``fp`` that give the same components as all pairs within ``max_bits``."""
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits must be even: then one variant holds only fingerprints within it of each other")
    masks = [sum(1 << k for k in bits) for r in range(max_bits // 2 + 1) for bits in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    variants = prints.select("fp", F.explode(F.array(*[F.lit(m) for m in signed])).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    met = variants.withColumn("lo", F.min("fp").over(Window.partitionBy("variant"))).where("fp <> lo")
    pairs = met.select("lo", F.col("fp").alias("hi")).distinct()
    return pairs.where(F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= max_bits)


def components(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``pairs`` (lo, hi) that is not the smallest of its component.

    Alternating stars: neighbours above a node move to its smallest neighbour, then those below do, until all point to
    the root. Each round aggregates before it joins, and is stored.
    """
    edges = scratch.keep(pairs.select("lo", "hi"), "edges-0")
    before, round_number = None, 0
    while True:
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first()
        if seen[0] == 0 or tuple(seen) == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = tuple(seen)
        ways = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi")).where("lo <> hi")
        after = small.unionByName(lowest.select(F.col("m").alias("lo"), "hi")).distinct()
        round_number += 1
        edges = scratch.keep(after, f"edges-{round_number}")
        scratch.drop(f"edges-{round_number - 1}")


def near_duplicates(docs: DataFrame, *, width: int = 3, seed: int = 42, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links.

    One row per input row. Null and empty texts have fingerprint zero and link like any other. Rows that share a doc_id
    are one document: it links to all that any of its rows links to. Rows without doc_id get no component. Columns other
    than doc_id and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.keep(with_fingerprints(docs, width=width, seed=seed), "rows", conf=SMALL_BATCHES)
    known = rows.where("doc_id IS NOT NULL")
    prints = known.groupBy("fp").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    prints = scratch.keep(prints, "prints")
    # A repeated doc_id joins the fingerprints of its rows.
    again = known.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("most")).where("lo <> most")
    tied = known.distinct().join(again.select("doc_id", "lo"), "doc_id").where("fp <> lo").select(
        "lo", F.col("fp").alias("hi")).distinct()
    star = components(links(prints, max_bits).unionByName(tied), scratch)
    rooted = prints.join(star, prints["fp"] == star["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        F.col("fp").alias("print"), "component_id")
    named = scratch.keep(named, "named")
    return rows.join(named, (F.col("fp") == F.col("print")) & F.col("doc_id").isNotNull(), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, width: int = 3, seed: int = 42, max_bits: int = 2) -> DataFrame:
    """``docs`` without documents that have a smaller doc_id in their component. Rows without doc_id stay."""
    found = near_duplicates(docs, width=width, seed=seed, max_bits=max_bits)
    goes = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    # Ids are hashed, so that texts are not sorted for the join.
    goes = goes.hint("shuffle_hash")
    return docs.join(goes, docs["doc_id"] == goes["gone"], "left_anti")
