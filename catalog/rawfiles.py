"""Raw CSV files written from the driver tables, so that the raw readers have real files to read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.shapes import shape
from tallyfold.sources.landing import land_files, landed_rows
from tallyfold.sources.manifest import list_files
from tallyfold.sources.raw import file_of
from tallyfold.sources.store import shared_folder

# Column titles by race scheme: the two kinds of file differ in column order and spelling.
LAYOUTS = {
    97: ["year", "geo_id", "raw_agestr", "raw_gender", "raw_racemars", "raw_hispanic", "pop"],
    77: ["pop", "raw_gender", "raw_agestr", "geo_id", "raw_hispanic", "raw_racemars", "year"],
}
TITLES = {
    "year": "Year", "geo_id": "BlockCode2020", "raw_agestr": "AgeStr", "raw_gender": "Gender",
    "raw_racemars": "RaceMars", "raw_hispanic": "Hispanic", "pop": "Pop",
}


def scratch(spark: SparkSession) -> str:
    """A new folder of this run below the shared folder of the cluster."""
    return f"{shared_folder(spark)}/tallyfold-{uuid.uuid4().hex[:12]}"


def _named(spark, sf_dir):
    rows = shape(spark, sf_dir, "stamped")
    name = F.concat(F.lit("BlockCode2020RaceMars"), F.col("r_type").cast("string"), F.col("year"))
    return rows.withColumn("src", name)


def write_raw_lines(spark: SparkSession, sf_dir: str) -> str:
    """Text files of raw lines, one folder per logical file.

    Column order follows the race scheme, lines end in a carriage return, cells in blanks. The header
    lines stand anywhere in the data of their folder, twice, and one folder also has short lines.
    """
    rows = _named(spark, sf_dir)

    def line(order, cell):
        return F.concat(F.concat_ws(",", *[cell(c) for c in order]), F.lit("  \r"))

    def cells(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    body = F.when(F.col("r_type") == 97, line(LAYOUTS[97], cells)).otherwise(line(LAYOUTS[77], cells))
    titles = F.when(F.col("r_type") == 97, line(LAYOUTS[97], lambda c: F.lit(TITLES[c]))).otherwise(
        line(LAYOUTS[77], lambda c: F.lit(TITLES[c].upper())))
    headers = rows.select("src", "r_type").distinct().select(
        "src", F.explode(F.array(titles, titles)).alias("value"))
    short = spark.read.parquet(f"{sf_dir}/region.parquet").select(
        F.lit("BlockCode2020RaceMars972000").alias("src"), F.concat_ws(",", "r_name", F.lit("bad")).alias("value"))
    path = scratch(spark)
    (rows.select("src", body.alias("value")).unionByName(headers).unionByName(short)
     .write.partitionBy("src").option("compression", "gzip").text(path))
    return path


def by_folder(rows: DataFrame) -> DataFrame:
    """Make the folder of a part file its logical file name."""
    return rows.withColumn("file", F.regexp_extract("file", "src=([^/]+)/", 1))


#: Parts of each file, told apart by the last digit of the geography id.
PARTS = 4


def write_named_files(spark: SparkSession, sf_dir: str) -> str:
    """Gzip files under their full names, in one batch folder per part of a file; each has its header."""
    rows, path = _named(spark, sf_dir), scratch(spark)
    rows = rows.withColumn("part", F.right("geo_id", F.lit(1)).cast("int") % PARTS).repartition("src", "part")
    for scheme, order in LAYOUTS.items():
        part = rows.where(F.col("r_type") == scheme).select("src", "part", *[F.col(c).alias(TITLES[c]) for c in order])
        (part.write.partitionBy("src", "part").option("compression", "gzip")
         .option("header", "true").mode("append").csv(f"{path}/parts"))
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path
    files = path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.globStatus(path_of(f"{path}/parts/src=*/part=*/part-*.csv.gz")):
        at = status.getPath().getParent()
        number, name = int(at.getName().split("=")[1]), at.getParent().getName().split("=")[1]
        folder = path_of(f"{path}/in/2020{number + 1:02d}01part{number}/csv")
        files.mkdirs(folder)
        files.rename(status.getPath(), path_of(folder, f"{name}.csv.gz"))
    return f"{path}/in"


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the raw lines, inflated once; the folder of a part file is its logical file."""
    folder, landing = write_raw_lines(spark, sf_dir), scratch(spark)
    files = list_files(spark, folder, "part-*").select(file_of("file_path").alias("file"))
    land_files(spark, files, landing, per_wave=32)
    return by_folder(landed_rows(spark, landing, files))
