"""What a file name says: geography type, scope, years and race scheme; file locations; file profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyfold.functions.names import batch_date, remove_first
from tallyfold.operators.qa import exact_sum
from tallyfold.schema import GEO_SCOPES, GEO_TYPE_CODES
from tallyfold.sources.raw import CSV_NAMES


def list_files(spark: SparkSession, folder: str, pattern: str = CSV_NAMES) -> DataFrame:
    """Paths below a folder, without reading file contents."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return listed.load(folder).select(F.col("path").alias("file_path"))


def _lookup(values: dict[str, str]):
    return F.create_map(*[F.lit(item) for pair in values.items() for item in pair])


def file_manifest(files: DataFrame, path: str = "file_path") -> DataFrame:
    """Add ``file_name`` and the facts its name states to a listing of files.

    A name is ``<geo>[code]<geo_year>racemars<r_type><year>.csv[.gz]`` in any case. The years and scheme are
    taken by their places, the geography word is mapped to its code (unknown words stay), the scope follows
    from the code.
    """
    name = F.lower("file_name")
    name = F.when(name.contains(".gz"), F.substring(name, F.lit(1), F.length(name) - 3)).otherwise(name)
    rows = files.withColumn("file_name", F.substring_index(path, "/", -1)).withColumn("_name", name)
    rows = rows.withColumns({"_race": F.instr("_name", "racemars"), "_size": F.length("_name")})
    race, size = F.col("_race"), F.col("_size")
    rows = rows.withColumn("_word", F.when(race > 0, F.substring("_name", F.lit(1), race - 5)))
    rows = rows.withColumns({
        "_word": remove_first("_word", "code"),
        "geo_year": F.when(race > 0, F.substring("_name", race - 4, F.lit(4))),
        "year": F.substring("_name", size - 7, F.lit(4)),
        "r_type": F.substring("_name", size - 9, F.lit(2)).try_cast("smallint"),
    })
    rows = rows.withColumn("geo_type", F.coalesce(F.element_at(_lookup(GEO_TYPE_CODES), F.col("_word")), F.col("_word")))
    scope = F.element_at(_lookup(GEO_SCOPES), F.col("geo_type"))
    return rows.withColumn("geo_scope", scope).select(
        *files.columns, "file_name", "geo_type", "geo_scope", "geo_year", "year", "r_type")


def locate_files(manifest: DataFrame, *, batch_name: str | None = None, base_url: str = "", base_path: str = "",
                 extract_folder: str = "", final_folder: str = "", path: str = "file_path") -> DataFrame:
    """Add ``batch_name``, ``batch_date`` and ``file_loc`` and make sure that file names end in ``.gz``.

    Without ``batch_name`` the batch is the first folder below ``final_folder``. The location is the base,
    the batch and the folders of the file; a batch segment that would occur twice is left out once.
    """
    folder = F.substring(F.col(path), F.lit(1), F.length(path) - F.length("file_name"))
    rows = manifest.withColumn("_folder", folder)
    rows = rows.withColumns({"_inner": remove_first("_folder", extract_folder),
                             "_below": remove_first("_folder", f"{final_folder}/")})
    batch = F.lit(batch_name) if batch_name is not None else F.substring_index("_below", "/", 1)
    rows = rows.withColumns({"_inner": remove_first("_inner", final_folder), "batch_name": batch})
    rows = rows.withColumns({
        "_segment": F.concat(F.lit("/"), F.col("batch_name")),
        "_loc": F.concat(F.lit(f"{base_url}{base_path}/"), F.col("batch_name"), F.col("_inner")),
    })
    rows = rows.withColumn("_less", remove_first("_loc", F.col("_segment")))
    gz = F.when(F.col("file_name").contains(".gz"), F.col("file_name")).otherwise(F.concat("file_name", F.lit(".gz")))
    return rows.withColumns({
        "batch_date": batch_date("batch_name"),
        "file_loc": F.when(F.position(F.col("_segment"), F.col("_less")) > 0, F.col("_less")).otherwise(F.col("_loc")),
        "file_name": gz,
    }).drop("_folder", "_inner", "_below", "_segment", "_loc", "_less")


def profile_files(rows: DataFrame, file: str = "file") -> DataFrame:
    """Rows and headcount of each file; a missing headcount counts as 0."""
    kind = rows.schema["pop"].dataType
    total = F.coalesce(exact_sum(rows), F.lit(0).cast("double" if isinstance(kind, T.DoubleType) else "decimal(38,8)"))
    return rows.groupBy(file).agg(F.count("*").alias("rows_file"), total.alias("pop_file"))
