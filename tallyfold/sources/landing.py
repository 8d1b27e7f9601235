"""Raw text files, inflated and split once, as a columnar table that knows which version of which file it holds.

A wave of files is written as one folder; the list of landed files then names the wave of each file and what the file is
made of. A wave that broke before it was listed is never read. Files are taken in waves of bounded size, so neither the
driver nor a scan holds all paths.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyfold.operators.sizing import small_side
from tallyfold.schema import RAW_CELLS, RAW_SCHEMA
from tallyfold.sources.raw import BAD, file_of, first_header, is_header, read_raw
from tallyfold.sources.store import clear_versions, delete_folder, exists, read_current, write_current

PER_WAVE = 1000  # files
_CELLS = T.StructType([*RAW_SCHEMA.fields, T.StructField(BAD, T.StringType()), T.StructField("file", T.StringType())])
_COUNTS = ["bad_records", "bad_data", "headers", "blanks", "records"]
_LIST = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("modified", T.TimestampType()), T.StructField("wave", T.StringType()),
    *RAW_SCHEMA.fields, *[T.StructField(c, T.LongType()) for c in _COUNTS]])


def describe_files(rows: DataFrame) -> DataFrame:
    """Header cells of each file, and how many of its records are what.

    ``bad_records`` have the wrong number of fields, ``bad_data`` are those of them that are no header either;
    ``headers`` are good ones with "code" or "year" in their text, ``blanks`` good ones without a first cell,
    ``records`` the good ones that remain.
    """
    bad, header = F.col(BAD).isNotNull(), is_header()
    blank = F.col(RAW_CELLS[0]).isNull()
    per_file = rows.groupBy("file").agg(
        F.min(F.when(~bad & header, first_header())).alias("_header"),
        F.count_if(bad).alias("bad_records"), F.count_if(bad & ~header).alias("bad_data"),
        F.count_if(~bad & header).alias("headers"), F.count_if(~bad & ~header & blank).alias("blanks"),
        F.count_if(~bad & ~header & ~blank).alias("records"))
    return per_file.select("file", *[F.col(f"_header.{c}").alias(c) for c in RAW_CELLS], *_COUNTS)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each landed file: the version and wave it is read from, its header cells and counts."""
    return read_current(spark, f"{path}/files") if exists(spark, f"{path}/files") else spark.createDataFrame([], _LIST)


def in_waves(paths: Iterable[str], size: int) -> Iterator[list[str]]:
    """At most ``size`` paths at a time."""
    held: list[str] = []
    for one in paths:
        held.append(one)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def land_files(spark: SparkSession, files: DataFrame, path: str, *, per_wave: int = PER_WAVE, **options) -> int:
    """Land the files of ``files`` (column ``file``) that ``path`` does not hold as they are now; how many were read.

    A file is known by its path and modification time. A changed one takes the place of its earlier version. ``options``
    go to the reader.
    """
    read = 0
    for paths in in_waves((r.file for r in files.select("file").distinct().toLocalIterator()), per_wave):
        held = landed_files(spark, path)
        now = spark.read.format("binaryFile").load(paths).select(
            file_of("path").alias("file"), F.col("modificationTime").alias("modified"))
        new = now.join(held.select("file", "modified"), ["file", "modified"], "left_anti").collect()  # at most a wave
        if not new:
            continue
        wave = uuid.uuid4().hex
        cells = read_raw(spark, [r.file for r in new], max_errors=None, **options)
        cells.write.parquet(f"{path}/waves/wave={wave}")
        described = describe_files(spark.read.schema(_CELLS).parquet(f"{path}/waves/wave={wave}"))
        versions = spark.createDataFrame(new, T.StructType(_LIST.fields[:2]))
        # A file without any record has a row of zeros.
        entries = versions.join(described, "file", "left").fillna(0, _COUNTS).withColumn("wave", F.lit(wave))
        kept = held.join(versions.select("file"), "file", "left_anti")
        write_current(kept.unionByName(entries).select(*_LIST.names), f"{path}/files")
        read += len(new)
    return read


def landed_rows(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Text cells of the landed version of each file of ``files`` (column ``file``), bad records marked, as ``read_raw``
    gives them with ``max_errors=None``. Only the waves that hold the files are read.

    Rows lie by file: the list of files is broadcast, and one too long for that shuffles the rows by file."""
    at = landed_files(spark, path).join(files.select("file").distinct(), "file").select("file", "wave")
    if not exists(spark, f"{path}/waves"):
        return spark.createDataFrame([], _CELLS)
    rows = spark.read.schema(T.StructType([*_CELLS.fields, T.StructField("wave", T.StringType())])).parquet(f"{path}/waves")
    return rows.join(small_side(at), ["file", "wave"]).select(*_CELLS.names)


def drop_stale_waves(spark: SparkSession, path: str) -> int:
    """Delete waves that the list does not name (broken or replaced ones) and older lists; how many waves went."""
    if not exists(spark, f"{path}/waves"):
        return 0
    clear_versions(spark, f"{path}/files")
    named = landed_files(spark, path).select("wave").distinct()
    folders = spark.read.schema("wave string").parquet(f"{path}/waves").select("wave").distinct()
    stale = folders.join(named, "wave", "left_anti")
    return sum(delete_folder(spark, f"{path}/waves/wave={r.wave}") for r in stale.toLocalIterator())
