"""Load: pending files through raw and stage to the reference tables, then archive and prune."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.functions.codes import parse_age, zero_fill
from tallyfold.operators import sizing
from tallyfold.operators.clean import align_columns, route_by_scheme, scheme_table, stamp_manifest, valid_facts
from tallyfold.operators.lifecycle import archive_candidates, prune_candidates, stamp_events
from tallyfold.operators.log import pending
from tallyfold.operators.qa import exact_sum, fates, reconcile_hops, unbalanced
from tallyfold.operators.recode import recode_cascade
from tallyfold.plans.intake import typed_rows
from tallyfold.schema import RACE_FLAGS, STAGE_SCHEMA
from tallyfold.sources.batches import BatchStore
from tallyfold.sources.landing import PER_WAVE, land_files, landed_files, landed_rows
from tallyfold.sources.logbook import LogBook
from tallyfold.sources.raw import check_errors, file_of, read_table_batches
from tallyfold.sources.store import exists, read_current, use_checkpoints, write_current

HOPS = ["file", "raw", "stage", "ref"]
#: Column of the raw dataset that keeps the text of headcounts that are no number.
UNREADABLE = "pop_unreadable"
REFERENCE = ("ref", "ref_77")


def stage_rows(raw: DataFrame, rules: DataFrame | None) -> DataFrame:
    """Valid raw rows in stage layout, recoded by the first-match cascade when rules are given."""
    rows = valid_facts(raw)
    if rules is not None:
        rows = rows.withColumn("age", parse_age("raw_agestr"))
        rows = zero_fill(_with(recode_cascade(rows, rules), RACE_FLAGS))
    return align_columns(rows, STAGE_SCHEMA, add_missing=True)


def _with(rows, names):
    absent = [c for c in names if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("smallint") for c in absent}) if absent else rows


def hop_events(totals: DataFrame, hop: str, now) -> DataFrame:
    """Log events for a hop that ran: its load stamp, row count and headcount."""
    stamp = F.lit(now).cast("timestamp")
    entries = F.array(
        F.struct(F.lit(f"load_{hop}_datetime").alias("field"), F.lit(None).cast("double").alias("value")),
        F.struct(F.lit(f"qa_rows_{hop}").alias("field"), F.col("row_cnt").cast("double").alias("value")),
        F.struct(F.lit(f"qa_pop_{hop}").alias("field"), F.col("pop_tot").cast("double").alias("value")),
    )
    rows = totals.select(F.col("etl_batch_id").alias("id"), F.explode(entries).alias("entry"))
    return rows.select("id", "entry.field", stamp.alias("ts"), "entry.value")


def hop_counts(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of each batch of ``ids``: all, with a headcount, with an unreadable and without any, and the rounded total."""
    unreadable = F.col(UNREADABLE).isNotNull() if UNREADABLE in rows.columns else F.lit(False)
    found = rows.groupBy("etl_batch_id").agg(
        F.count("*").alias("rows"), F.count("pop").alias("row_cnt"), F.count_if(unreadable).alias("unreadable"),
        F.count_if(F.col("pop").isNull() & ~unreadable).alias("empty"), F.round(exact_sum(rows), 0).alias("pop_tot"))
    return ids.join(found, "etl_batch_id", "left").fillna(0)


def _read_back(store: BatchStore, hop: str, datasets: dict[str, int], ids: DataFrame) -> DataFrame:
    """Counts of what a hop wrote, read back from its datasets and compared with the rows counted on the way."""
    parts = [store.read(dataset, ids) for dataset in datasets]
    counts = hop_counts(reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts), ids).checkpoint()
    there = counts.agg(F.sum("rows")).first()[0]
    if there != sum(datasets.values()):
        raise RuntimeError(f"{hop}: {sum(datasets.values())} rows were written, {there} are there")
    return counts


def run_load(spark: SparkSession, root: str, rules: DataFrame, *, now, geo_types=(), census_year: str | None = None,
             min_year: int = 0, batch_name: str | None = None, folders=(), r_type: int | None = None,
             full: bool = True, max_errors: int = 100, max_archive: int = 2,
             tables: dict[str, DataFrame] | None = None, per_wave: int = PER_WAVE) -> DataFrame:
    """Load every pending file of the log below ``root`` in one plan per hop and return the new log.

    Batches with the location "ref" come from the table of ``tables`` that their file name names, each one the
    rows of its year; those whose table is not given stay pending.

    ``root`` holds ``log`` (a ``LogBook``), ``hops`` and ``reconciled`` (versioned), the ``landing`` table of raw cells and the datasets
    ``raw``, ``stage``, ``ref``, ``ref_77`` and their archives, to be read through ``BatchStore``. With ``full=False`` rows
    stop at the stage. Only hops that ran are stamped. A repeated run replaces the batches it writes.

    Every write is counted and read back. ``hops`` tells for each batch and hop how many rows went on and how many were
    left behind for which reason; rows that are neither raise. ``reconciled`` has the totals of all hops beside the file's.
    """
    use_checkpoints(spark)
    book = LogBook(spark, f"{root}/log")
    log = book.read()
    work = pending(log, "files", geo_types=geo_types, census_year=census_year, min_year=min_year,
                   batch_name=batch_name, folders=folders, r_type=r_type)
    tables = tables or {}
    in_table = F.col("file_loc") == "ref"
    given = in_table & F.col("file_name").isin(*tables) if tables else F.lit(False)
    work = work.where(~in_table | given).checkpoint()
    files = work.where(~in_table).withColumn("file", file_of(F.concat("file_loc", "file_name")))
    files = files.withColumnRenamed("id", "etl_batch_id")
    named = {r.file_name for r in work.where(in_table).select("file_name").distinct().toLocalIterator()}
    from_files = bool(files.take(1))
    if not from_files and not named:
        return log
    ids = work.select(F.col("id").alias("etl_batch_id"))
    store, found = BatchStore(spark, root), []

    parts = [read_table_batches(tables[name], work.where(in_table & (F.col("file_name") == name))) for name in sorted(named)]
    # Landed rows lie by file and so by batch; those of a table are gathered here.
    parts = [part.hint("rebalance", F.col("etl_batch_id")) for part in parts]
    if from_files:
        landing = f"{root}/landing"
        land_files(spark, files, landing, per_wave=per_wave)
        held = landed_files(spark, landing).join(files.select("file", "etl_batch_id"), "file")
        check_errors(held, max_errors)
        typed = typed_rows(landed_rows(spark, landing, files), held, unreadable=UNREADABLE)
        parts.append(stamp_manifest(typed, files).drop("file"))
        found.append(fates(held, "file", "records", bad_record="bad_records", no_first_cell="blanks", header="headers"))
    typed = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    written = {"raw": store.write("raw", typed, ids, gathered=True)}
    raw = store.read("raw", ids)
    counts = {"raw": _read_back(store, "raw", written, ids)}
    found.append(fates(counts["raw"], "raw", "row_cnt", unreadable_headcount="unreadable", no_headcount="empty"))
    # The raw rows lie by batch, and lookups that are broadcast leave them there.
    few_rules = not full or rules.count() <= sizing.PINNED_ROWS
    written = {"stage": store.write("stage", stage_rows(raw, rules if full else None), ids, gathered=few_rules)}
    stage = store.read("stage", ids)
    counts["stage"] = _read_back(store, "stage", written, ids)
    found.append(fates(counts["stage"], "stage", "rows"))

    if full:
        # The stage lies by batch, and a split by scheme moves no row.
        written = {table: store.write(table, rows, ids, gathered=True) for table, rows in route_by_scheme(stage, "ref").items()}
        counts["ref"] = _read_back(store, "ref", written, ids)
        found.append(fates(counts["ref"], "ref", "rows"))
    events = [hop_events(sums, hop, now) for hop, sums in counts.items()]
    _keep_fates(spark, root, reduce(DataFrame.unionByName, found), ids)
    book.apply(reduce(DataFrame.unionByName, events))
    own = book.read(ids.withColumnRenamed("etl_batch_id", "id"))
    write_current(reconcile_hops(own, counts), f"{root}/reconciled")
    return run_archive(spark, root, now=now, max_archive=max_archive) if full else book.read()


def _keep_fates(spark: SparkSession, root: str, found: DataFrame, ids: DataFrame) -> None:
    """Put the fates of this run in place of those that its batches had; rows that got lost raise."""
    found = found.checkpoint()
    lost = unbalanced(found, HOPS).take(5)
    if lost:
        raise RuntimeError("rows got lost: " + ", ".join(f"batch {r.etl_batch_id}: {r.sent} sent to {r.hop}, {r.arrived} there" for r in lost))
    if exists(spark, f"{root}/hops"):
        found = read_current(spark, f"{root}/hops").join(ids, "etl_batch_id", "left_anti").unionByName(found)
    write_current(found, f"{root}/hops")


def run_archive(spark: SparkSession, root: str, *, now, max_archive: int = 2) -> DataFrame:
    """Move superseded batches to the archives, prune the archives and return the new log.

    Both are one change of the list of live partitions each; no row is rewritten. The files of pruned batches go with
    ``BatchStore.vacuum``.
    """
    use_checkpoints(spark)
    book, store = LogBook(spark, f"{root}/log"), BatchStore(spark, root)
    # Only batches that a reference table holds are moved and stamped.
    held = store.live().where(F.col("dataset").isin(*REFERENCE)).select(F.col("etl_batch_id").alias("archive_id")).distinct()
    old = archive_candidates(book.read()).join(held, "archive_id", "left_semi").checkpoint()
    table = scheme_table("ref")
    store.move(old.select(F.col("archive_id").alias("etl_batch_id"), table.alias("dataset"), F.concat(F.lit("archive_"), table).alias("to")))
    moved = stamp_events(old, "archive_id", ["load_archive_datetime", "delete_ref_datetime"], now)
    book.apply(moved)

    surplus = prune_candidates(book.read(), max_archive).checkpoint()
    archives = F.explode(F.array(*[F.lit(f"archive_{table}") for table in REFERENCE]))
    store.drop(surplus.select(F.col("id").alias("etl_batch_id"), archives.alias("dataset")))
    book.apply(stamp_events(surplus, "id", ["delete_archive_datetime"], now))
    return book.read()
