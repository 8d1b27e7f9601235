"""New files of a folder, found by a file stream and taken through intake and load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyfold.plans.intake import run_intake
from tallyfold.plans.load import run_load
from tallyfold.sources.logbook import LogBook
from tallyfold.sources.raw import CSV_NAMES, file_of

_FILE_FIELDS = "path string, modificationTime timestamp, length long, content binary"


def arrived_files(spark: SparkSession, folder: str, pattern: str = CSV_NAMES, per_trigger: int = 1000) -> DataFrame:
    """Stream of the paths of files that arrive below ``folder``; contents are not read."""
    stream = spark.readStream.format("binaryFile").schema(_FILE_FIELDS)
    stream = stream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return stream.option("maxFilesPerTrigger", per_trigger).load(folder).select(file_of("path").alias("file_path"))


def load_arrivals(spark: SparkSession, folder: str, root: str, rules: DataFrame, *, clock, checkpoint: str,
                  census_year: str, **options) -> StreamingQuery:
    """Take all files not seen before through intake and load, then stop.

    The stream's checkpoint remembers the files. A trigger that is repeated after a failure changes nothing:
    intake updates its log rows and load replaces its batches. ``clock`` gives the time of a trigger, and
    ``options`` go to the intake (batch_name, base_url, base_path, final_folder).
    """
    def take(files: DataFrame, _epoch: int) -> None:
        if not files.take(1):
            return
        now = clock()
        run_intake(spark, folder, LogBook(spark, f"{root}/log"), files=files, now=now, census_year=census_year,
                   landing=f"{root}/landing", **options)
        run_load(spark, root, rules, now=now, census_year=census_year)

    stream = arrived_files(spark, folder).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()
