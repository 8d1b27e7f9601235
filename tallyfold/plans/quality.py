"""Quality sums of the reference tables and their comparison with new data."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from tallyfold.operators.qa import qa_cells, qa_long, write_qa_report
from tallyfold.sources.batches import BatchStore
from tallyfold.sources.store import exists, read_current, use_checkpoints, write_current, write_table

CELLS = "quality_cells"
_VERSIONS = "etl_batch_id long, source string"


def run_qa(out: str, reference: DataFrame, reference_77: DataFrame | None = None, *, raw: DataFrame | None = None,
           report: str | None = None) -> DataFrame:
    """Write the long quality table of both reference tables; with recoded raw rows also the comparisons."""
    rows = reference if reference_77 is None else reference.unionByName(reference_77)
    write_table(qa_long(rows), out)
    sums = rows.sparkSession.read.parquet(out)
    if raw is not None and report is not None:
        write_qa_report(qa_long(raw), sums, report)
    return sums


def refresh_quality(store: BatchStore, datasets: tuple[str, ...] = ("ref", "ref_77")) -> DataFrame:
    """The long quality table of the datasets' batches, from stored sums of each batch.

    Only batches that came or were replaced since the last time are read; the sums of those that left are dropped.
    Sums of a batch are its cells: one row for each combination of file keys and values. A run that breaks is made good by
    the next one.
    """
    spark, path = store.spark, f"{store.root}/quality_of"
    use_checkpoints(spark)
    entries = store.live().where(F.col("dataset").isin(*datasets))
    # A batch lies in as many datasets as it has race schemes.
    now = entries.groupBy("etl_batch_id").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(
        "/", "dataset", "origin", "write"))), ";").alias("source")).checkpoint()
    known = read_current(spark, path) if exists(spark, path) else spark.createDataFrame([], _VERSIONS)
    changed = now.join(known, ["etl_batch_id", "source"], "left_anti").select("etl_batch_id").checkpoint()
    gone = known.join(now, "etl_batch_id", "left_anti").select("etl_batch_id").checkpoint()
    if changed.take(1) or gone.take(1):
        there = [d for d in datasets if entries.where(F.col("dataset") == d).take(1)] or list(datasets[:1])
        rows = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), [store.read(d, changed) for d in there])
        store.write(CELLS, qa_cells(rows), changed.unionByName(gone))
        write_current(now, path)
    return qa_long(store.read(CELLS))
