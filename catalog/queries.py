"""The registered queries. Each takes (spark, sf_dir) and reads whole driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from catalog.rawfiles import landed_lines, scratch, write_named_files
from catalog.shapes import shape, weights_of
from tallyfold.functions import (
    batch_date, contains_any, geo_parts, pad_code, parse_age, scope_filter, strip_prefixes, top_code, zero_fill,
)
from tallyfold.operators.clean import (
    align_columns, column_roles, route_by_scheme, scheme_table, stamp_manifest, valid_facts,
)
from tallyfold.operators.geo import (
    allocate, geo_direct, rollup_hierarchy, rollup_prefix,
)
from tallyfold.operators.lifecycle import (
    archive_candidates, archive_move, current_batch, direct_archive_candidates, prune_candidates, split_archive,
    stamp_events,
)
from tallyfold.operators.log import (
    append_notes, apply_log_events, get_log, latest_batches, load_status, pending, upsert_log,
)
from tallyfold.operators.qa import control_totals, qa_compare, qa_long, reconcile_hops, resume_points
from tallyfold.operators.recode import (
    attach_area, recode_cascade, recode_facts, recode_join, recode_override,
)
from tallyfold.plans.cleaning import clean_frame
from tallyfold.plans.geographies import area_tables, run_geographies, target_tables
from tallyfold.plans.intake import run_intake, typed_rows
from tallyfold.plans.load import run_load
from tallyfold.plans.quality import refresh_quality, run_qa
from tallyfold.schema import AGE_BANDS, GEO_TABLES, QA_COLUMNS, STAGE_SCHEMA
from tallyfold.sources.batches import BatchStore
from tallyfold.sources.logbook import LogBook
from tallyfold.sources.manifest import file_manifest, locate_files, profile_files
from tallyfold.sources.raw import check_errors, detect_header, read_raw, read_table_source, survey_files
from tallyfold.sources.store import copy_and_verify, read_current, replace_batch, use_checkpoints, write_table

NOW = dt.datetime(2024, 11, 5, 12, 0)
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    """Register a query under its function name; decimals leave as doubles, dates and times as text."""
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(run(Inputs(spark, sf_dir.rstrip("/"))))
    REGISTRY[run.__name__] = call
    return run


class Inputs:
    """Shapes and tables by attribute."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name) -> DataFrame:
        # Crosswalks are stored tables. Written once, their size is known and they are not derived again. The weights are
        # twelve for each block: their blocks are stored.
        if name == "weights":
            return weights_of(self.blocks)
        rows = shape(self.spark, self.sf_dir, name)
        if name in ("areas", "old_areas", "blocks"):
            path = scratch(self.spark)
            rows.write.parquet(path)
            return self.spark.read.parquet(path)
        return rows

    def table(self, name) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def plain(rows: DataFrame) -> DataFrame:
    out = {}
    for field in rows.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            out[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[field.name] = F.col(field.name).cast("string")
    return rows.withColumns(out) if out else rows


# --- versions and geographies ---------------------------------------------------------------------

@query
def latest(t):
    return latest_batches(t.log).select("id", "geo_type", "geo_year", "census_year", "year", "r_type", "batch_date")


@query
def latest_loaded_any_scheme(t):
    rows = latest_batches(t.log, r_type=None, census_year=None, geo_year=None, require_loaded=True)
    return rows.select("id", "geo_type", "geo_year", "census_year", "year", "r_type", "batch_date")


@query
def geo_block(t):
    return geo_direct(t.facts, latest_batches(t.log), t.rules, "blk")


@query
def geo_legislative(t):
    return geo_direct(t.facts, latest_batches(t.log), t.rules, "lgd")


@query
def geo_school(t):
    return geo_direct(t.facts, latest_batches(t.log), t.rules, "scd")


@query
def geo_zip(t):
    return geo_direct(t.facts, latest_batches(t.log), t.rules, "zip")


@query
def geo_county(t):
    return rollup_prefix(t.facts, latest_batches(t.log), t.rules)


@query
def geo_hra(t):
    return area_tables(t.facts, latest_batches(t.log), t.rules, t.areas, t.regions)[0]


@query
def geo_region(t):
    return area_tables(t.facts, latest_batches(t.log), t.rules, t.areas, t.regions)[1]


@query
def geo_allocated(t):
    return target_tables(t.facts, latest_batches(t.log), t.rules, t.weights)


@query
def hierarchy_of_recoded_blocks(t):
    blocks = geo_direct(t.facts, latest_batches(t.log), t.plain_rules, "blk")
    return rollup_hierarchy(blocks, t.areas, {"census_year": "blk_census_year", "geo_id": "blk_geo_id"}, "hra_geo_id",
                            "hra", parent_year="hra_census_year", geo_scope="kc")


@query
def allocation_of_recoded_blocks(t):
    blocks = geo_direct(t.facts, latest_batches(t.log), t.plain_rules, "blk")
    return allocate(blocks, t.weights, ["kccd", "tribal"])


def _write_geographies(t, **options):
    return run_geographies(t.spark, scratch(t.spark), facts=t.facts, log=t.log, rules=t.rules, areas=t.areas,
                           regions=t.regions, weights=t.weights, buckets=16, **options)


@query
def geographies(t):
    """All thirteen tables, summed by geography and year."""
    tables, out = _write_geographies(t), None
    for name in GEO_TABLES:
        sums = tables[name].groupBy("geo_id", "geo_year", "year").agg(F.count("*").alias("n"), F.sum("pop").alias("pop"))
        sums = sums.withColumns({"pop": F.col("pop").cast("double"), "table_name": F.lit(name)})
        out = sums if out is None else out.unionByName(sums)
    return out


@query
def copied_geographies(t):
    """How the copies of the thirteen tables went."""
    copies = scratch(t.spark)
    _write_geographies(t, copy_to=copies)
    return t.spark.read.parquet(f"{copies}/copied")


# --- recodes --------------------------------------------------------------------------------------

def _with_scheme(t):
    return t.facts.join(t.log.select(F.col("id").alias("etl_batch_id"), "r_type"), "etl_batch_id")


@query
def recode_exact(t):
    return recode_join(t.facts, t.rules, "raw_gender", "gender")


@query
def recode_range(t):
    rows = t.facts.withColumn("age", parse_age("raw_agestr"))
    for band in AGE_BANDS:
        rows = recode_join(rows, t.rules, "age", band, kind="range")
    return rows


@query
def recode_optional(t):
    return recode_join(t.facts, t.rules, "raw_hispanic", "race_hisp", how="left", default=0)


@query
def recode_by_scheme(t):
    rows = recode_join(_with_scheme(t), t.rules, "raw_racemars", "rcode", on_scheme=True)
    return recode_join(rows, t.rules, "rcode", "r1r3", kind="range", on_scheme=True)


@query
def recode_with_override(t):
    rows = recode_join(_with_scheme(t), t.rules, "raw_racemars", "rcode", on_scheme=True)
    rows = recode_join(rows, t.rules, "rcode", "r2r4", kind="range", on_scheme=True)
    return recode_override(rows, t.rules, "raw_hispanic", "r2r4", "r2r4")


@query
def recode_all(t):
    return recode_facts(_with_scheme(t), t.rules)


def _padded(t):
    rows = t.stamped.withColumn("raw_racemars", pad_code("raw_racemars", "r_type"))
    return rows.withColumn("age", parse_age("raw_agestr"))


@query
def cascade_first(t):
    return zero_fill(recode_cascade(_padded(t), t.rules, policy="first"))


@query
def cascade_last(t):
    return recode_cascade(_padded(t), t.rules, policy="last")


@query
def cascade_many_rules(t):
    """Two rules for every order, some without a new value; the newer form, on the code, overwrites the ranges."""
    exact = t.table("orders").selectExpr(
        "'code' AS old_column", "CAST(o_orderkey AS STRING) AS old_value_txt", "CAST(NULL AS INT) AS old_value_num_min",
        "CAST(NULL AS INT) AS old_value_num_max", "'grade' AS new_column",
        "CAST(IF(o_orderkey % 5 = 0, NULL, o_custkey % 100) AS INT) AS new_value_num", "CAST(NULL AS STRING) AS new_value_txt",
        "CAST(IF(o_orderkey % 2 = 0, NULL, 77) AS SMALLINT) AS r_type")
    spans = t.table("orders").selectExpr(
        "'number' AS old_column", "CAST(NULL AS STRING) AS old_value_txt", "CAST(o_orderkey AS INT) AS old_value_num_min",
        "CAST(o_orderkey + 3 AS INT) AS old_value_num_max", "'grade' AS new_column",
        "CAST(o_custkey % 50 AS INT) AS new_value_num", "CAST(NULL AS STRING) AS new_value_txt", "CAST(NULL AS SMALLINT) AS r_type")
    rows = t.table("lineitem").selectExpr("l_orderkey", "l_linenumber", "CAST(l_orderkey AS STRING) AS code",
                                 "CAST(l_orderkey AS INT) AS number", "CAST(IF(l_linenumber % 2 = 0, 77, 97) AS SMALLINT) AS r_type")
    return recode_cascade(rows, exact.unionByName(spans), policy="last").drop("code", "number")


@query
def area_of_block(t):
    return attach_area(t.facts, t.old_areas, "2020")


# --- scalar clean-up ------------------------------------------------------------------------------

@query
def block_id_parts(t):
    return geo_parts(t.facts.select("etl_batch_id", "geo_id", "pop"))


@query
def ages(t):
    rows = t.facts.select("etl_batch_id", "geo_id", "raw_agestr", "pop", parse_age("raw_agestr").alias("age"))
    return rows.withColumn("age_100", top_code("age"))


@query
def padded_codes(t):
    return t.stamped.select("geo_id", "r_type", "raw_agestr", pad_code("raw_racemars", "r_type").alias("raw_racemars"))


@query
def scope(t):
    return scope_filter(t.stamped, scope_column="geo_scope").select("geo_id", "geo_scope", "raw_agestr", "raw_gender")


@query
def block_scope(t):
    return scope_filter(t.facts).select("etl_batch_id", "geo_id", "raw_agestr", "pop")


@query
def zero_filled(t):
    rows = t.stamped.withColumn("fips_co", F.when(F.col("geo_scope") == "kps", F.substring("geo_id", 4, 2)))
    return zero_fill(rows.select("geo_id", "raw_agestr", "raw_gender", "fips_co", "pop"), every=True)


@query
def aligned(t):
    target = T.StructType([f for f in STAGE_SCHEMA.fields if f.name in (
        "etl_batch_id", "geo_id", "pop", "raw_agestr", "raw_hispanic", "fips_co")])
    rows = t.facts.withColumnRenamed("geo_id", "GEO_ID").withColumn("extra", F.lit(1))
    return align_columns(rows, target, add_missing=True)


@query
def batch_dates(t):
    return t.log.select("id", "batch_name", batch_date("batch_name").alias("named_date"))


@query
def folder_matches(t):
    rows = t.log.where(contains_any("file_loc", ["csv_1997/", "/2000"]))
    return rows.select("id", strip_prefixes("file_loc", "https://store", "/pop/").alias("folder"))


@query
def valid(t):
    rows = valid_facts(t.stamped, batches=[19971, 19981, 19992, 20001], where="geo_type = 'blk'")
    return rows.select("etl_batch_id", "geo_id", "raw_agestr", "raw_gender", "pop")


@query
def routed(t):
    rows = t.stamped.select("geo_id", "r_type", "raw_agestr", "raw_gender", scheme_table("pop").alias("table_name"))
    parts = route_by_scheme(rows, "pop")
    out = [part.withColumn("routed_to", F.lit(name)) for name, part in parts.items()]
    return out[0].unionByName(out[1])


# --- files ----------------------------------------------------------------------------------------

@query
def manifest(t):
    rows = locate_files(file_manifest(t.files), base_url="https://store", base_path="/pop",
                        extract_folder="/data/extract", final_folder="/data/extract")
    return rows.drop("l_partkey")


@query
def file_profiles(t):
    return profile_files(t.stamped.withColumn("file", F.concat_ws("-", "geo_type", "year", "r_type")))


@query
def header_roles(t):
    return column_roles(detect_header(landed_lines(t.spark, t.sf_dir)))


@query
def bad_records(t):
    return survey_files(landed_lines(t.spark, t.sf_dir)).select("file", "bad_records")


def _typed_lines(t):
    """Typed rows of the raw lines, and their files. The survey, a scan of all lines, is made once."""
    raw = landed_lines(t.spark, t.sf_dir)
    use_checkpoints(t.spark)
    survey = survey_files(raw).checkpoint()
    check_errors(survey, 100)
    return typed_rows(raw, survey), survey.select("file")


@query
def raw_rows(t):
    return _typed_lines(t)[0]


@query
def stamped_rows(t):
    # A file without data rows is in the survey, too, and meets no row.
    rows, files = _typed_lines(t)
    named = file_manifest(files.withColumn("file_path", F.concat(F.col("file"), F.lit(".csv"))))
    return stamp_manifest(rows, named.withColumn("census_year", F.lit("2020")))


@query
def table_source(t):
    rows = t.stamped.select(
        F.col("geo_id").alias("BlockCode2020"), F.col("pop").alias("Pop"), F.col("raw_agestr").alias("AgeGroup"),
        F.col("raw_gender").alias("Gender"), F.col("raw_racemars").cast("int").alias("RaceMars97"),
        F.col("raw_hispanic").alias("Hispanic"), F.col("year").cast("int").alias("Year"))
    info = {"id": 7, "geo_type": "blk", "geo_scope": "kps", "geo_year": "2020", "census_year": "2020", "year": "1998",
            "r_type": 97}
    return read_table_source(rows, info)


@query
def cleaned_frame(t):
    rows = t.facts.select(
        F.lit("2020").alias("Year"), F.col("geo_id").alias("BlockCode2020"), F.col("raw_agestr").alias("AgeStr"),
        F.col("raw_gender").alias("Gender"), F.col("raw_racemars").alias("RaceMars97"),
        F.col("raw_hispanic").alias("Hispanic"), F.col("pop").alias("Pop"))
    info = {"file_name": "BlockCode2020RaceMars972020.csv.gz", "geo_type": "blk", "geo_scope": "kps", "geo_year": "2020",
            "census_year": "2020", "r_type": 97}
    return clean_frame(rows, info, t.rules, t.old_areas)


@query
def replaced_batches(t):
    path = scratch(t.spark)
    rows = t.stamped.select("etl_batch_id", "geo_type", "r_type", "pop")
    replace_batch(rows, path)
    replace_batch(rows.where("geo_type = 'blk'").where(F.col("etl_batch_id") % 10 == 1), path)
    kept = t.spark.read.parquet(path).withColumn("etl_batch_id", F.col("etl_batch_id").cast("long"))
    return kept.groupBy("etl_batch_id", "geo_type").agg(F.count("*").alias("n"), F.sum("pop").alias("pop"))


@query
def written_formats(t):
    cells = ["geo_id", "raw_agestr", "raw_gender", "raw_racemars", "raw_hispanic", "pop", "year"]
    rows, path, out = t.stamped.select(*cells), scratch(t.spark), []
    for fmt in ("parquet", "orc"):
        write_table(rows, f"{path}/{fmt}", fmt=fmt, partition_by=["year"])
        back = read_raw(t.spark, f"{path}/{fmt}", fmt=fmt).toDF(*cells, "file").drop("file")
        out.append(back.withColumns({"format": F.lit(fmt), "pop": F.col("pop").cast("decimal(18,4)")}))
    return out[0].unionByName(out[1])


@query
def copied_tables(t):
    tables = {"log": t.log, "facts": t.facts, "areas": t.areas, "regions": t.regions, "rules": t.rules}
    return copy_and_verify(t.spark, tables, scratch(t.spark))


def _load_named_files(t):
    """Root and log of files on disk taken through intake, raw, stage and reference."""
    folder, root = write_named_files(t.spark, t.sf_dir), scratch(t.spark)
    run_intake(t.spark, folder, LogBook(t.spark, f"{root}/log"), now=NOW, census_year="2020", base_path=folder,
               final_folder=folder, landing=f"{root}/landing", per_wave=24)
    return root, run_load(t.spark, root, t.rules, now=NOW)


@query
def loaded_files(t):
    """The log's counts and totals of all hops, over the files of a year and scheme."""
    _, log = _load_named_files(t)
    return log.groupBy("geo_type", "geo_scope", "geo_year", "census_year", "year", "r_type").agg(
        *[F.sum(f"qa_rows_{hop}").alias(f"qa_rows_{hop}") for hop in ("file", "raw", "stage", "ref")],
        *[F.sum(f"qa_pop_{hop}").alias(f"qa_pop_{hop}") for hop in ("file", "raw", "stage", "ref")])


@query
def load_reconciled(t):
    """Rows that went on and rows left behind at every hop of a load, and whether its totals are those of the file."""
    root, log = _load_named_files(t)
    files = log.select(F.col("id").alias("etl_batch_id"), "year", "r_type")
    fates = read_current(t.spark, f"{root}/hops").where("fate <> 'header'")
    checked = read_current(t.spark, f"{root}/reconciled").unpivot(
        ["etl_batch_id"], ["raw_ok", "stage_ok", "ref_ok"], "hop", "agrees").withColumn("hop", F.regexp_replace("hop", "_ok", ""))
    both = fates.join(checked, ["etl_batch_id", "hop"], "left").join(files, "etl_batch_id")
    return both.groupBy("year", "r_type", "hop", "fate").agg(F.sum("rows").alias("n_rows"), F.bool_and("agrees").alias("agrees"))


@query
def loaded_table_batches(t):
    """Batches that an existing table holds, through raw, stage and reference: all hops of the log per batch."""
    root = scratch(t.spark)
    table = t.stamped.select(
        F.col("geo_id").alias("BlockCode2020"), F.col("pop").alias("Pop"), F.col("raw_agestr").alias("AgeGroup"),
        F.col("raw_gender").alias("Gender"), F.col("raw_racemars").cast("int").alias("RaceMars97"),
        F.col("raw_hispanic").alias("Hispanic"), F.col("year").cast("int").alias("Year"))
    path = f"{root}/headcounts"
    write_table(table, path)
    # One log row per year of the table; the year is its id.
    years = t.stamped.select("year").distinct()
    values = {"id": F.col("year").cast("long"), "batch_name": F.lit("tables"), "batch_date": F.lit("2024-03-01"),
              "file_name": F.lit("headcounts"), "file_loc": F.lit("ref"), "geo_type": F.lit("blk"),
              "geo_scope": F.lit("kps"), "geo_year": F.lit("2020"), "census_year": F.lit("2020"),
              "year": F.col("year"), "r_type": F.lit(97)}
    log = years.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _log_schema().fields])
    LogBook(t.spark, f"{root}/log").replace(log)
    log = run_load(t.spark, root, t.rules, now=NOW, tables={"headcounts": t.spark.read.parquet(path)})
    hops = ("raw", "stage", "ref")
    return log.select("id", "year", *[f"qa_rows_{hop}" for hop in hops], *[f"qa_pop_{hop}" for hop in hops],
                      F.col("load_ref_datetime").isNotNull().alias("loaded"))


def _log_schema():
    from tallyfold.schema import LOG_SCHEMA
    return LOG_SCHEMA


# --- log ------------------------------------------------------------------------------------------

@query
def log_rows(t):
    return get_log(t.log)


@query
def pending_batches(t):
    return pending(t.log, "batches", geo_types=["blk", "scd"], census_year="2020", min_year=1997)


@query
def pending_table_batches(t):
    return pending(t.log, "batches", table_source=True)


@query
def pending_folders(t):
    return pending(t.log, "folders", batch_name="19980401census2020", base_url="https://store", base_path="/pop")


@query
def pending_files(t):
    return pending(t.log, "files", census_year="2020", min_year=1996, folders=["csv_1996/", "csv_1998/"], r_type=97)


@query
def file_status(t):
    return load_status(t.incoming, t.versions).select("batch_name", "file_loc", "year", "r_type", "status")


@query
def upserted_log(t):
    out = upsert_log(t.versions, t.incoming, dt.datetime(2024, 1, 2))
    return out.select("id", "batch_name", "batch_date", "file_name", "file_loc", "geo_type", "geo_scope", "geo_year",
                      "census_year", "year", "r_type", "qa_rows_file", "qa_pop_file", "last_update_datetime")


@query
def log_events(t):
    field = F.when(F.col("l_linenumber") == 1, "load_ref_datetime").when(
        F.col("l_linenumber") == 2, "delete_ref_datetime").when(F.col("l_linenumber") == 3, "qa_rows_file").when(
        F.col("l_linenumber") == 4, "qa_pop_file").otherwise("load_archive_datetime")
    day = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.dayofmonth("l_shipdate")
    events = t.table("lineitem").select(F.col("l_orderkey").alias("id"), field.alias("field"),
                                        F.col("l_shipdate").alias("ts"), day.cast("double").alias("value"))
    return apply_log_events(t.log, events).select(
        "id", "load_ref_datetime", "delete_ref_datetime", "load_archive_datetime", "qa_rows_file", "qa_pop_file",
        "last_update_datetime")


@query
def log_notes(t):
    notes = t.table("lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("seq"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("note"), F.col("l_shipdate").alias("ts"))
    return append_notes(t.log, notes).select("id", "etl_notes", "last_update_datetime")


def _marked(book, before, *columns):
    """Columns of the log and whether the block of each row was written after ``before``."""
    same = before.withColumn("old", F.lit(True))
    blocks = book.blocks().join(same, ["block", "write"], "left").select("block", F.col("old").isNull().alias("rewritten"))
    rows = book.read().select(*columns).withColumn("block", F.expr(f"(id - 1) div {book.block_ids}"))
    return rows.join(blocks, "block").drop("block")


@query
def upserted_log_blocks(t):
    """The delivery of the newest day, entered in a log of blocks: all rows, and which blocks that rewrote."""
    book = LogBook(t.spark, scratch(t.spark), block_ids=1000)
    book.replace(t.versions)
    before, newest = book.blocks(), t.incoming.agg(F.max("batch_date").alias("batch_date"))
    book.upsert(t.incoming.join(newest, "batch_date"), dt.datetime(2024, 1, 2))
    return _marked(book, before, "id", "batch_name", "batch_date", "file_name", "file_loc", "geo_type", "geo_scope", "geo_year",
                   "census_year", "year", "r_type", "qa_rows_file", "qa_pop_file", "last_update_datetime")


@query
def stamped_log_blocks(t):
    """Stamps and notes of the newest shipping day in a log of blocks, and which blocks they rewrote."""
    book = LogBook(t.spark, scratch(t.spark), block_ids=1000)
    book.replace(t.log)
    before, lines = book.blocks(), t.table("lineitem")
    lines = lines.join(lines.agg(F.max("l_shipdate").alias("l_shipdate")), "l_shipdate")
    book.apply(lines.select(F.col("l_orderkey").alias("id"), F.lit("load_archive_datetime").alias("field"),
                            F.col("l_shipdate").alias("ts"), F.lit(None).cast("double").alias("value")))
    book.note(lines.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("seq"),
                           F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("note"), F.col("l_shipdate").alias("ts")))
    return _marked(book, before, "id", "load_archive_datetime", "etl_notes", "last_update_datetime")


# --- archive --------------------------------------------------------------------------------------

@query
def archive_list(t):
    return archive_candidates(t.versions)


@query
def direct_archive_list(t):
    return direct_archive_candidates(t.versions)


@query
def prune_list(t):
    return prune_candidates(t.versions, 1)


@query
def prune_list_exhausted(t):
    return prune_candidates(t.versions, 1, exhaust=True)


@query
def archive_split(t):
    moved, kept = split_archive(t.facts, archive_candidates(t.versions))
    both = moved.withColumn("place", F.lit("archive")).unionByName(kept.withColumn("place", F.lit("ref")))
    return both.groupBy("etl_batch_id", "place").agg(F.count("*").alias("n"), F.sum("pop").alias("pop"))


@query
def archive_moved(t):
    path = scratch(t.spark)
    replace_batch(t.stamped, f"{path}/ref")
    batches = t.stamped.groupBy("etl_batch_id").agg(F.count("*").alias("n"))
    old = batches.where(F.col("etl_batch_id") % 10 == 1).select(F.col("etl_batch_id").alias("archive_id"))
    archive_move(t.spark, f"{path}/ref", f"{path}/archive", old)
    out = [t.spark.read.parquet(f"{path}/{place}").withColumn("place", F.lit(place)) for place in ("ref", "archive")]
    return out[0].unionByName(out[1]).groupBy(F.col("etl_batch_id").cast("long").alias("etl_batch_id"), "place").agg(
        F.count("*").alias("n"), F.sum("pop").alias("pop"))


@query
def batches_moved_and_pruned(t):
    """A store whose older batches go to the archive, half of them on to nowhere; a write that broke before it was named
    and files that nothing names change nothing."""
    store = BatchStore(t.spark, scratch(t.spark))
    rows = t.stamped.select("etl_batch_id", "geo_type", "geo_id", "pop")
    store.write("ref", rows)
    batches = store.batches("ref")
    old = batches.where("etl_batch_id % 10 = 1")
    store.put("ref", rows.withColumn("geo_type", F.lit("broken")))
    store.move(old.select("etl_batch_id", F.lit("ref").alias("dataset"), F.lit("archive_ref").alias("to")))
    pruned = old.where("etl_batch_id % 20 = 1").select("etl_batch_id", F.lit("archive_ref").alias("dataset"))
    store.drop(pruned)
    store.write("ref", rows.where("etl_batch_id % 100 = 2 AND geo_type = 'blk'"))
    store.vacuum()
    parts = [store.read(dataset).withColumn("dataset", F.lit(dataset)) for dataset in ("ref", "archive_ref")]
    return parts[0].unionByName(parts[1]).groupBy("dataset", "etl_batch_id", "geo_type").agg(
        F.count("*").alias("n"), F.count_distinct("geo_id").alias("n_geo"), F.sum("pop").alias("pop"))


@query
def replaced_batch_stamp(t):
    """The log row of the batch that the facts begin with, stamped as deleted from the raw table."""
    events = stamp_events(current_batch(t.facts), "etl_batch_id", ["delete_ref_datetime"], NOW)
    log = apply_log_events(t.log, events)
    return log.select("id", "delete_ref_datetime", "load_ref_datetime")


# --- quality --------------------------------------------------------------------------------------

@query
def totals(t):
    return control_totals(t.stamped)


@query
def reconciled(t):
    log = t.stamped.groupBy(F.col("etl_batch_id").alias("id")).agg(
        F.count("*").alias("qa_rows_file"), F.sum("pop").cast("double").alias("qa_pop_file"))
    valid_rows = valid_facts(t.stamped)
    hops = {"raw": control_totals(t.stamped), "stage": control_totals(valid_rows),
            "ref": control_totals(scope_filter(valid_rows))}
    hops = {hop: sums.withColumn("pop_tot", F.col("pop_tot").cast("double")) for hop, sums in hops.items()}
    return reconcile_hops(log, hops)


def _quality_rows(t, share=None):
    rows = zero_fill(recode_cascade(_padded(t), t.rules))
    rows = rows.withColumn("fips_co", F.when(F.col("geo_scope") == "kps", F.substring("geo_id", 4, 2)))
    rows = rows.where(F.col("pop").isNotNull())
    if share is not None:
        rows = rows.withColumn("pop", F.when(F.substring("geo_id", 4, 2) == "77", F.col("pop")).otherwise(
            F.col("pop") * F.lit(share).cast("decimal(3,2)")).cast("decimal(20,4)"))
    return rows


@query
def quality_long(t):
    return qa_long(_quality_rows(t), QA_COLUMNS)


@query
def quality_against_current(t):
    return qa_compare(qa_long(_quality_rows(t)), qa_long(_quality_rows(t, "0.97")))


@query
def quality_against_previous(t):
    return qa_compare(qa_long(_quality_rows(t)), qa_long(_quality_rows(t, "0.97")), prior=True)


@query
def quality_run(t):
    """The stored quality table over both reference tables."""
    parts = route_by_scheme(_quality_rows(t), "ref")
    return run_qa(scratch(t.spark), parts["ref"], parts["ref_77"])


@query
def quality_refreshed(t):
    """The quality table after some batches were replaced and others left: stored sums of batches are merged."""
    store, rows = BatchStore(t.spark, scratch(t.spark)), _quality_rows(t, "1.00")
    for dataset, part in route_by_scheme(rows, "ref").items():
        store.write(dataset, part)
    refresh_quality(store)
    for dataset, part in route_by_scheme(_quality_rows(t, "0.97").where("etl_batch_id % 10 = 2"), "ref").items():
        store.write(dataset, part)
    batches = store.live().where("dataset LIKE 'ref%' AND etl_batch_id % 20 = 1")
    store.drop(batches.select("etl_batch_id", "dataset"))
    return refresh_quality(store)


@query
def quality_report(t):
    """Both comparisons of the written report, read back."""
    path = scratch(t.spark)
    run_qa(f"{path}/sums", _quality_rows(t, "0.97"), raw=_quality_rows(t), report=f"{path}/report")
    kinds = ("geo_type string, geo_scope string, geo_year string, r_type smallint, year string, col string, val smallint, "
             "raw_pop double, ref_pop double, diff double, perc double, comparison string")
    return t.spark.read.schema(kinds).option("header", "true").csv(f"{path}/report")


@query
def resume(t):
    return resume_points(t.versions, t.facts)
