"""Size checks in front of broadcasts."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfold.sources.store import use_checkpoints

PINNED_ROWS = 20_000
BROADCAST_ROWS = 500_000
CONTROL_ROWS = 10_000
# Bits of a key filter, and of one of its broadcast rows: 32 MB in rows of 4 KB.
FILTER_BITS = 1 << 28
_ROW_BITS = 1 << 15
# Types whose Python values mean the same in any time zone.
_PINNED_TYPES = (T.StringType, T.NumericType, T.BooleanType, T.DateType)


def small_side(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Prepare the smaller side of a join for a broadcast, if its size allows one.

    A few rows are evaluated once and kept as a local relation. More rows are counted (a distributed count)
    and get a broadcast hint up to ``max_rows``. A larger side comes back as it is: the join is then a
    shuffle join, whose hot keys adaptive execution splits.
    """
    if all(isinstance(f.dataType, _PINNED_TYPES) for f in side.schema.fields):
        rows = side.take(PINNED_ROWS + 1)
        if len(rows) <= PINNED_ROWS:
            return F.broadcast(local_frame(side, rows))
    return F.broadcast(side) if side.count() <= max_rows else side


def narrowed(rows: DataFrame, among: DataFrame, on: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key ``on`` may be in ``among``: all that are, and a few others. For the large side of a join, which then
    shuffles little more than what it matches.

    Keys are compared by hash, up to ``max_rows`` of them by a broadcast, more of them by a bit each of a broadcast bitmap of
    fixed size. ``among`` is evaluated once. Keys that are neither text nor whole numbers narrow nothing.
    """
    kinds = [frame.schema[on].dataType for frame in (rows, among)]
    whole = all(isinstance(kind, T.IntegralType) for kind in kinds)
    if not whole and not all(type(kind) is T.StringType for kind in kinds):
        return rows
    key = F.xxhash64(F.col(on).cast("long") if whole else F.col(on))
    use_checkpoints(rows.sparkSession)
    keys = among.where(F.col(on).isNotNull()).select(key.alias("_key")).distinct().checkpoint()
    if keys.count() <= max_rows:
        return rows.join(F.broadcast(keys), key == F.col("_key"), "left_semi")

    def place(hashed):
        return hashed.bitwiseAND(F.lit(FILTER_BITS - 1))

    # Words of 64 bits, those without a key too, so that a word is found by its place in the row.
    words = keys.select(F.shiftright(place(F.col("_key")), 6).alias("_word"),
                        F.expr("shiftleft(1L, CAST(_key & 63 AS INT))").alias("_bits"))
    empty = rows.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    words = words.unionByName(empty).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    bitmap = words.groupBy(F.expr(f"_word div {_ROW_BITS // 64}").alias("_row")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_word", "_bits"))), lambda w: w["_bits"]).alias("_words"))
    at = place(key)
    bits = F.get("_words", F.shiftright(at, 6).bitwiseAND(F.lit(_ROW_BITS // 64 - 1)).cast("int"))
    is_set = F.getbit(bits, at.bitwiseAND(F.lit(63)).cast("int")) == 1
    return rows.join(F.broadcast(bitmap), (F.shiftright(at, 15) == F.col("_row")) & is_set, "left_semi")


def local_frame(like: DataFrame, rows) -> DataFrame:
    """Rows with the schema of ``like`` as a local relation (exact size statistics for the optimizer)."""
    return local_rows(like.sparkSession, like.schema, rows)


def local_rows(spark: SparkSession, kinds: T.StructType, rows) -> DataFrame:
    """Rows of the given schema as a local relation."""
    columns = list(zip(*rows)) or [[] for _ in kinds]
    schema = to_arrow_schema(kinds)
    arrow = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return spark.createDataFrame(arrow, schema=kinds)
