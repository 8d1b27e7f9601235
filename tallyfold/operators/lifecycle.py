"""Superseded versions: which batches go to the archive, which leave it, and the moves themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyfold.operators.sizing import small_side
from tallyfold.sources.store import drop_batches, exists, replace_batch, use_checkpoints

_SERIES = ["geo_type", "geo_year", "census_year", "r_type", "year"]


def _in_reference():
    return F.col("load_archive_datetime").isNull() & F.col("load_ref_datetime").isNotNull()


def _newest_ids(log: DataFrame) -> DataFrame:
    """Highest id of each series and date, which names the version that supersedes another."""
    return log.groupBy(*_SERIES, F.col("batch_date").alias("_newest")).agg(F.max("id").alias("ref_id"))


def archive_candidates(log: DataFrame) -> DataFrame:
    """Batches to move to the archive, as (archive_id, ref_id, r_type).

    In every series (and scope) with more than one version in the reference table, the rows of the oldest
    date go. The scope forms groups but does not join, as two scopes share their versions. One row per
    archived batch: when several newest versions tie, ``ref_id`` is the highest of them.
    """
    spans = log.where(_in_reference()).groupBy(*_SERIES, "geo_scope").agg(
        F.min("batch_date").alias("_oldest"), F.max("batch_date").alias("_newest"), F.count("id").alias("_n"))
    spans = spans.where(F.col("_n") > 1)
    named = spans.join(_newest_ids(log), [*_SERIES, "_newest"])
    oldest = named.groupBy(*_SERIES, F.col("_oldest").alias("batch_date")).agg(F.max("ref_id").alias("ref_id"))
    rows = log.select(F.col("id").alias("archive_id"), *_SERIES, "batch_date")
    return rows.join(oldest, [*_SERIES, "batch_date"]).select("archive_id", "ref_id", "r_type")


def direct_archive_candidates(log: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Batches not loaded yet that are older than the newest loaded version of their series.

    ``ids`` (column ``id``) restricts them to pending batches of interest. One row per batch, see
    ``archive_candidates``.
    """
    loaded = log.where(_in_reference()).groupBy(*_SERIES, "geo_scope").agg(F.max("batch_date").alias("_newest"))
    # A batch older than any scope's newest date qualifies, so the latest of them decides.
    newest = loaded.join(_newest_ids(log), [*_SERIES, "_newest"]).groupBy(*_SERIES).agg(
        F.max_by("ref_id", "_newest").alias("ref_id"), F.max("_newest").alias("_newest"))
    waiting = log.where(F.col("load_ref_datetime").isNull() & F.col("load_archive_datetime").isNull())
    if ids is not None:
        waiting = waiting.join(ids.select("id"), "id", "left_semi")
    rows = waiting.select(F.col("id").alias("archive_id"), *_SERIES, "batch_date")
    joined = rows.join(newest, _SERIES)
    return joined.where(F.col("batch_date") < F.col("_newest")).select("archive_id", "ref_id", "r_type")


def prune_candidates(log: DataFrame, max_archive: int = 2, *, exhaust: bool = False) -> DataFrame:
    """Archived batches to delete, as (id, r_type).

    In every series with more than ``max_archive`` kept versions the rows of the oldest kept date go; the
    row is found by its date and need not be archived itself. With ``exhaust`` all kept versions beyond the
    newest ``max_archive`` go at once.
    """
    series = [*_SERIES, "geo_scope"]
    kept = log.where(F.col("load_archive_datetime").isNotNull() & F.col("delete_archive_datetime").isNull())
    if exhaust:
        # One row per date, so the running count over a series is short however many batches it has.
        dates = kept.groupBy(*series, "batch_date").agg(F.count("id").alias("_n"))
        newer = Window.partitionBy(*series).orderBy(F.desc("batch_date")).rowsBetween(Window.unboundedPreceding, -1)
        old = dates.withColumn("_ahead", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
        old = old.where(F.col("_ahead") >= max_archive).select(*series, "batch_date")
        rows = kept
    else:
        spans = kept.groupBy(*series).agg(F.min("batch_date").alias("batch_date"), F.count("id").alias("_n"))
        old = spans.where(F.col("_n") > max_archive).drop("_n")
        rows = log
    return rows.join(old, [*series, "batch_date"]).select("id", "r_type")


def split_archive(rows: DataFrame, ids: DataFrame, id_column: str = "archive_id") -> tuple[DataFrame, DataFrame]:
    """Rows of the given batches, and the rows that remain. The list of batches is evaluated once."""
    use_checkpoints(rows.sparkSession)
    side = small_side(ids.select(F.col(id_column).alias("etl_batch_id")).distinct().checkpoint())
    return rows.join(side, "etl_batch_id", "left_semi"), rows.join(side, "etl_batch_id", "left_anti")


def archive_move(spark: SparkSession, reference: str, archive: str, candidates: DataFrame) -> int:
    """Move batches between two batch-partitioned datasets and return how many were moved.

    The archive is written first and the reference partitions are dropped after that; a repeated run writes
    nothing for batches that are already gone. Only the partitions of moved batches are read.
    """
    moved, _ = split_archive(spark.read.parquet(reference), candidates)
    replace_batch(moved, archive)
    return drop_batches(spark, reference, candidates.select("archive_id"))


def prune_archive(spark: SparkSession, archive: str, candidates: DataFrame) -> int:
    """Delete the partitions of pruned batches and return how many there were."""
    return drop_batches(spark, archive, candidates.select("id")) if exists(spark, archive) else 0


def current_batch(rows: DataFrame) -> DataFrame:
    """Lowest batch id that a table holds now, the one whose deletion is stamped when the table is replaced."""
    return rows.agg(F.min("etl_batch_id").alias("etl_batch_id"))


def stamp_events(ids: DataFrame, id_column: str, fields, now) -> DataFrame:
    """Log events that set the given stamp fields of all ids."""
    events = ids.select(F.col(id_column).cast("long").alias("id")).distinct()
    names = F.explode(F.array(*[F.lit(f) for f in fields]))
    return events.select("id", names.alias("field"), F.lit(now).cast("timestamp").alias("ts"),
                         F.lit(None).cast("double").alias("value"))
