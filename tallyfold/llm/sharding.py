"""Shards along a Hilbert curve over metadata, all in DataFrame functions.

Size, language and source are quantised to cells; a Hilbert curve through the cells orders the rows so that neighbours
on it are alike in all of them; the order is cut into runs of equal bytes. Files of one run then span few cells and can
be skipped by a filter on any of the columns. Equal texts stand together: they share the smallest cell of their group.
A group that is larger than a shard is cut like any other run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.llm.common import Scratch, free

SHARDS = 40
LEVEL = 4  # bits of each quantised dimension
FILE_BYTES = 128 << 20  # counted bytes of a written file, about
EXTRA_BYTES = 16  # counted for each row beside its text


def hilbert(axes: list[Column], bits: int) -> Column:
    """Place of a cell on the Hilbert curve; each axis is a whole number of ``bits`` bits.

    The transform works on all axes together: from the highest bit down, an axis whose bit is set flips the lower bits
    of the first axis, one whose bit is not set swaps them with it; a Gray code over the axes follows.
    """
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x, s):
        first, own, low = F.element_at(x, 1), F.element_at(x, s["i"] + 1), s["q"] - 1
        change = F.when(own.bitwiseAND(s["q"]) != 0, low).otherwise(first.bitwiseXOR(own).bitwiseAND(low))
        also = own.bitwiseAND(s["q"]) == 0
        return F.transform(x, lambda v, j: F.when((j == 0) | (also & (j == s["i"])), v.bitwiseXOR(change)).otherwise(v))

    turned = F.aggregate(steps, F.array(*[a.cast("long") for a in axes]), undo)
    none = F.array().cast("array<bigint>")
    gray = F.aggregate(turned, none, lambda done, v: F.concat(done, F.array(
        F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0).cast("long")).bitwiseXOR(v))))

    def flipped(x):
        last = F.element_at(x, -1)
        flip = F.lit(0).cast("long")
        for b in range(bits - 1, 0, -1):
            flip = flip.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
        return F.transform(x, lambda v: v.bitwiseXOR(flip))

    def woven(x):
        places = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
        return F.aggregate(places, F.lit(0).cast("long"), lambda done, b: F.aggregate(
            x, done, lambda d, v: d * 2 + F.pmod(F.floor(v / F.pow(F.lit(2.0), b)), F.lit(2)).cast("long")))

    return woven(flipped(gray))


def _cells(docs: DataFrame) -> DataFrame:
    """Slim rows: doc_id, size, text_crc32, body and the language and source cell."""
    text = F.coalesce("text", F.lit(""))
    cell = (1 << LEVEL) - 1
    return docs.select(
        "doc_id", (F.octet_length(text) + EXTRA_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("body"),
        (F.coalesce(F.crc32(F.col("lang").cast("binary")), F.lit(0)).bitwiseAND(F.lit(cell)) * (cell + 1)
         + F.coalesce(F.crc32(F.col("source").cast("binary")), F.lit(0)).bitwiseAND(F.lit(cell))).alias("kind"))


def assign(docs: DataFrame, *, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and curve, the place on the Hilbert curve.

    The law is ``bytes``: a row belongs to the shard in which the middle of its bytes falls when all are laid end to end.
    Sizes of shards differ from each other by less than the largest row. A null text has no bytes beyond the fixed ones;
    null languages and sources share a cell; rows without doc_id come first among equal texts. Repeated rows get slots of
    their own. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    rows = scratch.keep(_cells(docs), "cells")
    levels = 1 << LEVEL
    cuts = rows.agg(F.percentile_approx("size", [k / levels for k in range(1, levels)], 1000).alias("cuts")).first()[0]
    bucket = sum((F.when(F.col("size") > c, 1).otherwise(0) for c in cuts or []), F.lit(0))
    groups = rows.groupBy("body", "size").agg(F.min("kind").alias("kind"))
    place = groups.select("body", "size", bucket.alias("x"), F.floor(F.col("kind") / levels).alias("y"),
                          F.pmod("kind", F.lit(levels)).alias("z"))
    # The curve is followed once per cell, and there are at most 2 ** (3 * LEVEL) cells.
    axes = ["x", "y", "z"]
    cells = place.select(*axes).distinct()
    cells = cells.select(*axes, hilbert([F.col(c) for c in axes], LEVEL).alias("curve"))
    curve = scratch.keep(place.join(F.broadcast(cells), axes).select("body", "size", "curve"), "curve")
    laid = rows.drop("kind").join(curve, ["body", "size"])
    order = ["curve", "body", "doc_id"]
    sorted_rows = laid.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    sorted_rows = scratch.keep(sorted_rows, "sorted")
    scratch.drop("cells", "curve")
    # One row per partition: the bytes and rows before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sorted_rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    total = sorted_rows.agg(F.sum("size")).first()[0] or 1
    within = Window.partitionBy("part").orderBy(*order)
    placed = sorted_rows.join(starts, "part").select(
        "doc_id", "size", "text_crc32", "curve",
        (F.col("bytes_before") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))).alias("end"),
        (F.col("rows_before") + F.row_number().over(within) - 1).alias("number"))
    middle = (F.col("end").cast("decimal(38,0)") * 2 - F.col("size")) * shards
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle / (2 * total)).cast("int")))
    placed = scratch.keep(placed, "placed")
    scratch.drop("sorted")
    first = placed.groupBy("shard").agg(F.min("number").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("number") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS, file_bytes: int = FILE_BYTES) -> None:
    """Write ``docs`` as Parquet below ``path``, a folder per shard, rows of a file in the order of their slots.

    Tasks take ranges of (shard, slot), as many as the bytes ask for, so a large shard is several files, each a run of
    slots. All columns are written as they are; the new ones are named shard and slot, behind underscores where those
    names are taken.
    """
    shard, slot = free("shard", docs), free("slot", docs)
    names = docs.columns
    placed = assign(docs.select("doc_id", "text", "lang", "source"), shards=shards)
    parts = max(shards, -(-(placed.agg(F.sum("size")).first()[0] or 0) // file_bytes))
    # Repeated rows are paired with their slots one to one.
    found = placed.select(F.col("doc_id").alias("of"), F.col("text_crc32").alias("sum"), F.col("shard").alias("to"), F.col("slot").alias("at"))
    again = Window.partitionBy("of", "sum").orderBy("to", "at")
    found = found.withColumn("turn", F.row_number().over(again))
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs["doc_id"].alias("own"),
                       F.crc32(text.cast("binary")).alias("crc"))
    rows = rows.withColumn("time", F.row_number().over(Window.partitionBy("own", "crc").orderBy("crc")))
    same = rows["own"].eqNullSafe(found["of"]) & (rows["crc"] == found["sum"]) & (rows["time"] == found["turn"])
    out = rows.join(found, same).select("row.*", F.col("to").alias(shard), F.col("at").alias(slot))
    out.repartitionByRange(parts, shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
