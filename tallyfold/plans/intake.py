"""Intake: describe new files by name and content and enter them in the log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.operators.clean import column_roles, drop_header_rows, project_roles, strip_cells
from tallyfold.operators.log import upsert_log
from tallyfold.schema import RAW_CELLS
from tallyfold.sources.landing import PER_WAVE, land_files, landed_files, landed_rows
from tallyfold.sources.logbook import LogBook
from tallyfold.sources.manifest import file_manifest, list_files, locate_files, profile_files
from tallyfold.sources.raw import check_errors, file_of, folder_of, good_records, is_header, marked_bad
from tallyfold.sources.store import shared_folder


def typed_rows(raw: DataFrame, survey: DataFrame, *, unreadable: str | None = None) -> DataFrame:
    """Raw cells as named columns, without header rows and bad records. ``unreadable`` names a column for headcounts that
    are no number."""
    body = strip_cells(drop_header_rows(good_records(raw)))
    return project_roles(body, column_roles(survey.select("file", *RAW_CELLS)), unreadable=unreadable)


def data_rows(raw: DataFrame, survey: DataFrame) -> DataFrame:
    """File and headcount of every row that is no header, also of bad records and of rows that a load leaves out."""
    rows = raw.withColumn("_is_bad", marked_bad(raw)).where(~is_header())
    typed = project_roles(strip_cells(rows), column_roles(survey.select("file", *RAW_CELLS)))
    return typed.select("file", F.when(~F.col("_is_bad"), F.col("pop")).alias("pop"))


def run_intake(spark: SparkSession, folder: str, log: DataFrame | LogBook, *, now, census_year: str,
               batch_name: str | None = None, base_url: str = "", base_path: str = "", final_folder: str = "",
               max_errors: int = 100, files: DataFrame | None = None, landing: str | None = None,
               per_wave: int = PER_WAVE) -> DataFrame:
    """The log with one row per file below ``folder``: name facts, rows, headcount, batch and location.

    A ``LogBook`` is changed where it lies, a frame is not.

    ``files`` (column ``file_path``) restricts the intake to some of the files. Files are inflated once, at most ``per_wave``
    at a time, into the table at ``landing``; a load that is given the same one does not open them again.
    """
    if files is None:
        files = list_files(spark, folder).select(file_of("file_path").alias("file_path"))
    landing = landing or f"{shared_folder(spark)}/landing-{uuid.uuid4().hex[:12]}"
    manifest = locate_files(file_manifest(files), batch_name=batch_name, base_url=base_url, base_path=base_path,
                            extract_folder=folder_of(folder), final_folder=folder_of(final_folder))
    named = files.select(F.col("file_path").alias("file"))
    land_files(spark, named, landing, per_wave=per_wave)
    held = landed_files(spark, landing).join(named.distinct(), "file")
    check_errors(held, max_errors)
    profile = profile_files(data_rows(landed_rows(spark, landing, named), held))
    found = manifest.join(profile.withColumnRenamed("file", "file_path"), "file_path", "left")
    found = found.fillna(0, ["rows_file", "pop_file"]).withColumn("census_year", F.lit(census_year))
    if isinstance(log, LogBook):
        log.upsert(found, now)
        return log.read()
    return upsert_log(log, found, now)
