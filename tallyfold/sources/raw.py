"""Raw headcount files (seven text columns, any column order) and table sources."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyfold.functions.codes import county_fips
from tallyfold.operators.sizing import small_side
from tallyfold.schema import RAW_CELLS, RAW_SCHEMA

BAD = "_bad_record"


#: Names of raw text files, in any case.
CSV_NAMES = "*.[cC][sS][vV]*"


def file_of(path) -> Column:
    """One form of a path, for comparing listings, scans and log locations: local ones plain, others whole URIs."""
    return F.regexp_replace(path, r"^file:/+", "/")


def folder_of(path: str) -> str:
    """The same form for a folder name."""
    return re.sub(r"^file:/+", "/", path)


def scanned_file() -> Column:
    """Path of the file that a row was read from. Scans state it with escaped blanks and the like."""
    return file_of(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def read_raw(spark: SparkSession, paths, *, fmt: str = "csv", sep: str = ",", quote: str = "", line_sep: str | None = None,
             first_row: int = 1, max_errors: int | None = 100, recursive: bool = False) -> DataFrame:
    """All raw files as text columns col1..col7 plus ``file``, one scan for any number of files.

    Compression follows from the file ending. Header rows stay in the data with ``first_row=1``; 2 skips the
    first line of each file. A record with too few or too many fields is bad: it is left out, and more than
    ``max_errors`` bad records in one file raise. With ``recursive`` only CSV files below the folders are read.
    Other formats must have exactly seven columns. ``max_errors=None`` leaves bad records in, marked in
    ``_bad_record``, for a later ``survey_files``.
    """
    if first_row not in (1, 2):
        raise ValueError("first_row must be 1 or 2")
    if fmt != "csv":
        rows = spark.read.format(fmt).load(paths)
        if len(rows.columns) != len(RAW_CELLS):
            raise ValueError(f"{len(rows.columns)} columns where {len(RAW_CELLS)} are expected: {rows.columns}")
        cells = [F.col(old).cast("string").alias(new) for old, new in zip(rows.columns, RAW_CELLS)]
        return rows.select(*cells, scanned_file().alias("file"))
    reader = spark.read.schema(T.StructType([*RAW_SCHEMA.fields, T.StructField(BAD, T.StringType())]))
    reader = reader.options(sep=sep, quote=quote, header=first_row == 2, mode="PERMISSIVE", enforceSchema=True,
                            columnNameOfCorruptRecord=BAD, recursiveFileLookup=recursive)
    if recursive:
        reader = reader.option("pathGlobFilter", CSV_NAMES)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    rows = reader.csv(paths).select(*RAW_CELLS, BAD, scanned_file().alias("file"))
    if max_errors is None:
        return rows
    check_errors(survey_files(rows), max_errors)
    return good_records(rows)


def good_records(rows: DataFrame) -> DataFrame:
    """Rows whose record had the right number of fields."""
    if BAD not in rows.columns:
        return rows
    # The marker is only right when all cells are read, also by a count that needs none of them. The second
    # test always holds and keeps the cells in the scan.
    return rows.where(F.col(BAD).isNull() & (F.length(F.concat_ws("", *RAW_CELLS)) >= 0)).drop(BAD)


def _text(rows) -> Column:
    return F.lower(F.concat_ws("", *RAW_CELLS))


def is_header() -> Column:
    """Whether a row has "code" or "year" somewhere in its text."""
    return _text(None).contains("code") | _text(None).contains("year")


def first_header() -> Column:
    """The cells of a header row behind its rank: the smallest one of a file is its header."""
    both = _text(None).contains("code") & _text(None).contains("year")
    return F.struct((~both).alias("rank"), *RAW_CELLS)


def marked_bad(rows: DataFrame) -> Column:
    """Whether a row is a bad record. The length keeps all cells in the scan, without which the mark is not right."""
    return F.col(BAD).isNotNull() & (F.length(_text(rows)) >= 0) if BAD in rows.columns else F.lit(False)


def survey_files(rows: DataFrame) -> DataFrame:
    """Header cells and number of bad records of each file, in one scan.

    A header is a row that has "code" or "year" somewhere in its text; rows with both words go first, and
    the smallest one in text order is taken when several remain. Only such rows and bad ones leave the scan.
    """
    bad = F.col(BAD).isNotNull() if BAD in rows.columns else F.lit(False)
    text = _text(rows)
    code, year = text.contains("code"), text.contains("year")
    picked = rows.where(code | year | bad).withColumns({"_is_bad": bad, "_any": code | year})
    header = F.when(F.col("_any") & ~F.col("_is_bad"), first_header())
    per_file = picked.groupBy("file").agg(F.min(header).alias("_header"), F.count_if("_is_bad").alias("bad_records"))
    return per_file.select("file", *[F.col(f"_header.{c}").alias(c) for c in RAW_CELLS], "bad_records")


def check_errors(survey: DataFrame, max_errors: int) -> None:
    """Raise when a file has more bad records than allowed."""
    over = survey.where(F.col("bad_records") > max_errors).select("file", "bad_records").take(5)
    if over:
        raise ValueError("too many bad records: " + ", ".join(f"{r.file} ({r.bad_records})" for r in over))


def detect_header(rows: DataFrame) -> DataFrame:
    """The header cells of each file, found in the data."""
    return survey_files(rows).select("file", *RAW_CELLS)


def _table_rows(table: DataFrame, years) -> DataFrame:
    """Rows of a table for some years with raw column names; the years are compared in the type of their column."""
    geo = [c for c in table.columns if "2" in c or c in ("County", "LEGDIST")]
    if not geo:
        raise ValueError("no geography column found")
    heads = [c for c in table.columns if "pop" in c.lower()]
    if not heads:
        raise ValueError("no headcount column found")
    race = F.col("RaceMars97").cast("string")
    kind = table.schema["Year"].dataType
    return table.where(F.col("Year").isin(*[F.lit(str(year)).cast(kind) for year in years])).select(
        F.col(geo[-1]).cast("string").alias("geo_id"),
        F.col(heads[0]).alias("pop"),
        F.col("AgeGroup").cast("string").alias("raw_agestr"),
        F.col("Gender").cast("string").alias("raw_gender"),
        F.when(F.length(race) < 5, F.lpad(race, 5, "0")).otherwise(race).alias("raw_racemars"),
        F.col("Hispanic").cast("string").alias("raw_hispanic"),
        F.col("Year").cast("string").alias("year"),
    )


_TABLE_CONSTANTS = ["geo_type", "geo_scope", "geo_year", "census_year", "r_type"]


def read_table_source(table: DataFrame, info: dict) -> DataFrame:
    """Rows of an existing table for one year in the raw layout.

    ``info`` is the log row of the batch. The geography column is the last one whose name contains 2 or is
    County or LEGDIST, the headcount column the first whose name contains "pop". Race codes are padded to five
    digits. The year is compared in the type of its column, so that the scan can skip by it.
    """
    rows = _table_rows(table, [info["year"]])
    fips = county_fips("geo_id") if info["geo_scope"] == "kps" else F.lit(None).cast("string")
    return rows.select(
        F.lit(info["id"]).alias("etl_batch_id"), *[c for c in rows.columns if c != "year"],
        *[F.lit(info[c]).alias(c) for c in _TABLE_CONSTANTS], "year", fips.alias("fips_co"))


def read_table_batches(table: DataFrame, batches: DataFrame) -> DataFrame:
    """Rows of an existing table in the raw layout for many batches: each log row of ``batches`` takes its year.

    All batches are read in one scan, which skips by the years they name. Columns are found as in
    ``read_table_source``; a batch whose year the table does not have gets no row.
    """
    years = sorted(row.year for row in batches.select("year").distinct().toLocalIterator() if row.year is not None)
    year = F.col("year").cast(table.schema["Year"].dataType).cast("string").alias("year")
    constants = batches.select(F.col("id").cast("long").alias("etl_batch_id"), *_TABLE_CONSTANTS, year)
    rows = _table_rows(table, years).withColumn("pop", F.col("pop").cast("double"))
    rows = rows.join(small_side(constants), "year")
    return rows.withColumn("fips_co", F.when(F.col("geo_scope") == "kps", county_fips("geo_id")))


def name_prefix(file_name: str) -> str:
    """Text of a file name before its first number, the geography word of its id column."""
    return re.split(r"[0-9]", file_name, maxsplit=1)[0]
