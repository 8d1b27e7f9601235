"""The ETL log as a DataFrame: lookups, pending work, latest versions, upserts, stamps and notes.

The log is always handled as a distributed table. Times come in as values; nothing reads the clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.functions.names import contains_any, strip_prefixes
from tallyfold.operators.sizing import small_side
from tallyfold.schema import LOG_KEY, LOG_ROW_COUNTS, LOG_STAMPS, LOG_TOTALS
from tallyfold.sources.store import use_checkpoints

SERIES = ["geo_type", "geo_year", "census_year", "year"]
_LISTED = ["id", "batch_name", "batch_date", "geo_type", "geo_scope", "geo_year", "census_year", "year", "r_type"]


def get_log(log: DataFrame, etl_batch_id: int | None = None) -> DataFrame:
    """Identity columns of one log row, or of all rows in id order."""
    if etl_batch_id is not None:
        return log.where(F.col("id") == etl_batch_id).select(*_LISTED)
    return log.select(*_LISTED).orderBy("id")


def latest_batches(log: DataFrame, *, r_type: int | None = 97, census_year: str | None = "2020",
                   geo_year: str | None = "2020", any_year_types=("zip",), keys=tuple(SERIES),
                   require_loaded: bool = False) -> DataFrame:
    """Log rows dated like the newest loaded and undeleted batch of their series.

    All rows that tie on that date are kept. The newest date is found over both race schemes and the
    scheme filter comes after it, so a newer batch of the other scheme hides a series. The returned rows
    need not be loaded themselves unless ``require_loaded``.
    """
    loaded = F.col("load_ref_datetime").isNotNull() & F.col("delete_ref_datetime").isNull()
    newest = log.where(loaded).groupBy(*keys).agg(F.max("batch_date").alias("batch_date"))
    rows = log.where(loaded) if require_loaded else log
    if r_type is not None:
        rows = rows.where(F.col("r_type") == r_type)
    if census_year is not None:
        rows = rows.where(F.col("census_year") == census_year)
    if geo_year is not None:
        rows = rows.where((F.col("geo_year") == geo_year) | F.col("geo_type").isin(*any_year_types))
    # The grouped side has one row per series, so few series are broadcast and hot ones never shuffle.
    return rows.join(small_side(newest), [*keys, "batch_date"]).select(*log.columns)


# --- work lists -----------------------------------------------------------------------------------

def pending(log: DataFrame, mode: str = "files", *, geo_types=(), census_year: str | None = None,
            min_year: int = 0, batch_name: str | None = None, folders=(), table_source: bool = False,
            base_url: str = "", base_path: str = "", r_type: int | None = None) -> DataFrame:
    """Work not yet loaded to the reference table: ``batches``, ``folders`` of a batch or ``files`` of a batch.

    ``census_year=None`` and ``batch_name=None`` mean no restriction. Batches come newest first and are split
    by ``table_source`` (rows whose location is the word ref); folders are shown below the base path.
    """
    rows = log.where(F.col("load_ref_datetime").isNull() & (F.col("year").try_cast("int") >= min_year))
    if census_year is not None:
        rows = rows.where(F.col("census_year") == census_year)
    if geo_types:
        rows = rows.where(F.col("geo_type").isin(*geo_types))
    if r_type is not None:
        rows = rows.where(F.col("r_type") == r_type)
    if mode == "batches":
        in_table = F.col("file_loc") == "ref"
        rows = rows.where(in_table if table_source else ~in_table)
        return rows.select("batch_name", "batch_date").distinct().orderBy(F.desc("batch_date"), "batch_name")
    if batch_name is not None:
        rows = rows.where(F.col("batch_name") == batch_name)
    if mode == "folders":
        listed = rows.select("file_loc").distinct().orderBy("file_loc")
        base = f"{base_path}/" if base_path else ""
        return listed.select(strip_prefixes("file_loc", base_url, base).alias("folder"))
    if mode != "files":
        raise ValueError("mode must be 'batches', 'folders' or 'files'")
    columns = [*_LISTED, "qa_rows_file", "qa_pop_file", "file_name", "file_loc"]
    return rows.where(contains_any("file_loc", folders)).select(*columns).orderBy("id")


def load_status(files: DataFrame, log: DataFrame) -> DataFrame:
    """Status of every file of ``files`` against the log, as column ``status``.

    The id of a load that has not reached the reference table; the negative id of one that has; -9999 when
    two or more kept archive versions are all newer than the file; else 0.
    """
    key = [*LOG_KEY, "file_loc"]
    is_open = F.col("load_ref_datetime").isNull()
    ids = log.groupBy(*key).agg(
        F.max(F.when(is_open, F.col("id"))).alias("_open"),
        F.max(F.when(~is_open, F.col("id"))).alias("_done"),
    )
    versions = ["geo_type", "geo_scope", "geo_year", "year", "r_type", "census_year"]
    archived = log.where(F.col("load_archive_datetime").isNotNull() & F.col("delete_archive_datetime").isNull())
    archived = archived.groupBy(*versions).agg(F.count("id").alias("_kept"), F.min("batch_date").alias("_oldest"))
    archived = archived.where(F.col("_kept") >= 2)

    out = _null_safe_left(files, ids, key)
    out = out.join(archived, versions, "left")
    superseded = F.when(F.col("_oldest") > F.col("batch_date"), F.lit(-9999).cast("long"))
    status = F.coalesce(F.col("_open").cast("long"), -F.col("_done").cast("long"), superseded, F.lit(0).cast("long"))
    return out.select(*files.columns, status.alias("status"))


def _null_safe_left(rows, other, key, null_safe=("geo_scope",)):
    """Left join on ``key`` in which the ``null_safe`` columns treat null as a value."""
    right = other.select(*[F.col(c).alias(f"_k_{c}") if c in key else F.col(c) for c in other.columns])
    match = [rows[c].eqNullSafe(F.col(f"_k_{c}")) if c in null_safe else rows[c] == F.col(f"_k_{c}") for c in key]
    return rows.join(right, match, "left").drop(*[f"_k_{c}" for c in key])


# --- changes --------------------------------------------------------------------------------------

def upsert_log(log: DataFrame, files: DataFrame, now) -> DataFrame:
    """Log with ``files`` merged in on the natural file key; a null scope equals a null scope.

    Known files update their newest row, new files get ids that continue from the highest one, in order of
    batch, file name and the remaining key. The headcount is rounded for new rows only. A key that occurs
    more than once is taken from its last file location, as a later update would leave it.
    """
    known = matched_files(log, files)
    return updated_rows(log, known, now).unionByName(added_rows(log, known, now))


_DETAILS = {"batch_date": "_batch_date", "file_loc": "_file_loc", "qa_rows_file": "_rows_file", "qa_pop_file": "_pop_file"}


def matched_files(log: DataFrame, files: DataFrame) -> DataFrame:
    """One row per key of ``files`` with its details and, as ``_id``, the newest log row of that key, null for none."""
    details = ["batch_date", "file_loc", "rows_file", "pop_file"]
    incoming = files.groupBy(*LOG_KEY).agg(
        F.max_by(F.struct(*details), F.struct("file_loc", "rows_file")).alias("_new"), F.count("*").alias("_seen"))
    incoming = incoming.select(*LOG_KEY, *[F.col(f"_new.{c}").alias(f"_{c}") for c in details], "_seen")
    ids = log.groupBy(*LOG_KEY).agg(F.max("id").alias("_id"))
    # Updates, new rows and their number all come from this join, so it is evaluated once.
    use_checkpoints(log.sparkSession)
    return _null_safe_left(incoming, ids, LOG_KEY).checkpoint()


def updated_rows(log: DataFrame, known: DataFrame, now) -> DataFrame:
    """All rows of ``log``, those that matched files name with the files' details."""
    changed = known.where(F.col("_id").isNotNull()).select("_id", *_DETAILS.values())
    updated = log.join(changed, F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    kinds = {f.name: f.dataType for f in log.schema.fields}
    return updated.withColumns({
        **{name: F.when(hit, F.col(new).cast(kinds[name])).otherwise(F.col(name)) for name, new in _DETAILS.items()},
        "last_update_datetime": F.when(hit, F.lit(now).cast("timestamp")).otherwise(F.col("last_update_datetime")),
    }).select(*log.columns)


def added_rows(log: DataFrame, known: DataFrame, now) -> DataFrame:
    """Log rows of the matched files that the log does not have, with ids that continue its highest one."""
    kinds = {f.name: f.dataType for f in log.schema.fields}
    fresh = known.where(F.col("_id").isNull()).drop("_id")
    highest = log.agg(F.max("id")).first()[0] or 0
    fresh = continue_ids(fresh, LOG_KEY, highest)
    pop = F.when(F.col("_seen") == 1, F.round("_pop_file", 0)).otherwise(F.col("_pop_file"))
    values = {**{name: F.col(new) for name, new in _DETAILS.items()}, "qa_pop_file": pop,
              "last_update_datetime": F.lit(now).cast("timestamp"), "id": F.col("id"), **{c: F.col(c) for c in LOG_KEY}}
    return fresh.select(*[values.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in log.columns])


def continue_ids(rows: DataFrame, order, start: int, *, per_task: int = 1_000_000) -> DataFrame:
    """Number rows with unique ``order`` values start+1, start+2, ... as column ``id``.

    The rows are sorted into ranges and checkpointed, so that their places are fixed; an id is then the place
    within the range plus the sizes of the ranges before it, and no task sees more than one range.
    """
    total = rows.count()
    use_checkpoints(rows.sparkSession)
    ranges = max(1, 2 * -(-total // per_task))
    placed = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).checkpoint()
    # The upper bits of the generated id are the partition, the lower 33 bits the row within it.
    place = F.monotonically_increasing_id()
    placed = placed.withColumn("_place", place).withColumns({
        "_range": F.shiftright("_place", 33), "_row": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(small_side(offsets), "_range")
    return numbered.withColumn("id", (F.lit(start) + F.col("_before") + F.col("_row") + 1).cast("long")).drop(
        "_place", "_range", "_row", "_before")


def apply_log_events(log: DataFrame, events: DataFrame) -> DataFrame:
    """Fold events ``(id, field, ts, value)`` into the log.

    A stamp field takes the latest ``ts`` of its events; a count or total field takes the ``value`` of its
    latest event and does not touch the update time, a stamp does.
    """
    kinds = {f.name: f.dataType for f in log.schema.fields}
    stamps = [c for c in LOG_STAMPS if c in kinds]
    values = [c for c in [*LOG_ROW_COUNTS, *LOG_TOTALS] if c in kinds]
    is_field = {c: F.col("field") == c for c in [*stamps, *values]}
    folded = events.groupBy("id").agg(
        *[F.max(F.when(is_field[c], F.col("ts"))).alias(f"_{c}") for c in stamps],
        *[F.max_by("value", F.when(is_field[c], F.col("ts"))).alias(f"_{c}") for c in values],
        F.max(F.when(F.col("field").isin(*stamps), F.col("ts"))).alias("_touched"),
    )
    out = log.join(folded, "id", "left")
    new = {c: F.coalesce(F.col(f"_{c}").cast(kinds[c]), F.col(c)) for c in [*stamps, *values]}
    if "last_update_datetime" in kinds:
        touched = F.col("_touched").cast(kinds["last_update_datetime"])
        new["last_update_datetime"] = F.coalesce(touched, F.col("last_update_datetime"))
    return out.withColumns(new).select(*log.columns)


def append_notes(log: DataFrame, notes: DataFrame) -> DataFrame:
    """Append notes ``(id, seq, note, ts)`` in ``seq`` order, each as ``note (ts);`` behind the old notes.

    The notes of one id end up in one cell, so they have to fit into one string.
    """
    text = F.concat(F.coalesce("note", F.lit("")), F.lit(" ("), F.col("ts").cast("string"), F.lit(");"))
    entries = notes.groupBy("id").agg(
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("seq", text.alias("text")))),
                                    lambda entry: entry["text"])).alias("_added"),
        F.max("ts").alias("_touched"))
    kinds = {f.name: f.dataType for f in log.schema.fields}
    out = log.join(entries, "id", "left")
    new = {"etl_notes": F.when(F.col("_added").isNull(), F.col("etl_notes")).otherwise(
        F.concat_ws("", "etl_notes", "_added"))}
    if "last_update_datetime" in kinds:
        touched = F.col("_touched").cast(kinds["last_update_datetime"])
        new["last_update_datetime"] = F.coalesce(touched, F.col("last_update_datetime"))
    return out.withColumns(new).select(*log.columns)
