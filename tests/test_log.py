"""Log operators and version lifecycle on hand-made logs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import rows_of
from tallyfold.operators.lifecycle import (
    archive_candidates, archive_move, direct_archive_candidates, prune_archive, prune_candidates, stamp_events,
)
from tallyfold.operators.log import (
    append_notes, apply_log_events, continue_ids, get_log, latest_batches, load_status, pending, upsert_log,
)
from tallyfold.operators.qa import qa_compare, qa_long, reconcile_hops, resume_points
from tallyfold.operators.sizing import small_side
from tallyfold.schema import LOG_SCHEMA, QA_SCHEMA
from tallyfold.sources.store import copy_and_verify, read_current, replace_batch, write_current

NOW = dt.datetime(2024, 5, 1, 12)
T1 = dt.datetime(2024, 1, 1)


def entry(id, date="2024-01-01", **changes):
    row = {"id": id, "batch_name": "b", "batch_date": dt.date.fromisoformat(date), "file_name": "f", "file_loc": "/p/",
           "geo_type": "blk", "geo_scope": "kps", "geo_year": "2020", "census_year": "2020", "year": "2020", "r_type": 97,
           "load_ref_datetime": T1, **changes}
    return tuple(row.get(f.name) for f in LOG_SCHEMA.fields)


def log_of(spark, *entries):
    return spark.createDataFrame(list(entries), LOG_SCHEMA)


def test_latest_keeps_ties_and_lets_the_other_scheme_hide(spark):
    log = log_of(
        spark, entry(1, "2024-01-01"), entry(2, "2024-02-01"), entry(3, "2024-02-01", load_ref_datetime=None),
        entry(4, "2024-03-01", delete_ref_datetime=T1), entry(5, "2024-01-01", year="2019"),
        entry(6, "2024-02-01", year="2019", r_type=77), entry(7, geo_type="zip", geo_year="2010"), entry(8, geo_year="2010"))
    assert rows_of(latest_batches(log), "id") == [(2,), (3,), (7,)]
    assert rows_of(latest_batches(log, require_loaded=True), "id") == [(2,), (7,)]
    by_scheme = latest_batches(log, keys=("geo_type", "geo_year", "census_year", "year", "r_type"))
    assert rows_of(by_scheme, "id") == [(2,), (3,), (5,), (7,)]


def incoming(spark, *rows):
    return spark.createDataFrame(
        [{"batch_name": "b", "batch_date": dt.date(2024, 4, 1), "file_name": "f", "file_loc": "/n/", "geo_type": "blk",
          "geo_scope": "kps", "geo_year": "2020", "census_year": "2020", "year": "2020", "r_type": 97, "rows_file": 5,
          "pop_file": 2.5, **r} for r in rows],
        "batch_name string, batch_date date, file_name string, file_loc string, geo_type string, geo_scope string, "
        "geo_year string, census_year string, year string, r_type smallint, rows_file long, pop_file double")


def test_upsert(spark):
    log = log_of(spark, entry(4), entry(9), entry(7, geo_scope=None, geo_type="xx"))
    files = incoming(spark, {}, {"geo_scope": None, "geo_type": "xx"}, {"file_name": "new"},
                     {"file_name": "new2", "file_loc": "/a/", "pop_file": 1.5}, {"file_name": "new2", "file_loc": "/b/", "pop_file": 3.5})
    out = upsert_log(log, files, NOW)
    assert rows_of(out, "id", "file_name", "file_loc", "qa_rows_file", "qa_pop_file", "last_update_datetime") == [
        (4, "f", "/p/", None, None, None), (7, "f", "/n/", 5, 2.5, NOW), (9, "f", "/n/", 5, 2.5, NOW),
        (10, "new", "/n/", 5, 3.0, NOW), (11, "new2", "/b/", 5, 3.5, NOW)]
    again = upsert_log(out, files, NOW)
    assert again.count() == 5 and rows_of(again.where("id = 10"), "qa_pop_file") == [(2.5,)]
    first = upsert_log(log.limit(0), incoming(spark, {}), NOW)
    assert rows_of(first, "id", "load_ref_datetime") == [(1, None)]


def test_ids_by_ranges_equal_ids_by_window(spark):
    rows = spark.range(5000).selectExpr("lpad(CAST((id * 7919) % 5000 AS STRING), 5, '0') AS k", "IF(id % 2 = 0, NULL, 'x') AS s")
    small = rows_of(continue_ids(rows, ["s", "k"], 100), "id", "k")
    assert rows_of(continue_ids(rows, ["s", "k"], 100, per_task=300), "id", "k") == small
    assert [r[0] for r in small] == list(range(101, 5101))


def test_pending(spark):
    log = log_of(
        spark, entry(1, load_ref_datetime=None, file_loc="u:/p/b1/csv/", batch_name="b1"),
        entry(2, "2024-02-01", load_ref_datetime=None, file_loc="u:/p/b2/csv/", batch_name="b2"),
        entry(3, load_ref_datetime=None, file_loc="ref", batch_name="b3"), entry(4),
        entry(5, load_ref_datetime=None, year="1999", batch_name="b1", r_type=77, file_loc="u:/p/b1/z/"))
    assert [r.batch_name for r in pending(log, "batches", min_year=2000).collect()] == ["b2", "b1"]
    assert [r.batch_name for r in pending(log, "batches", table_source=True).collect()] == ["b3"]
    assert rows_of(pending(log, "folders", batch_name="b1", base_url="u:", base_path="/p")) == [("b1/csv/",), ("b1/z/",)]
    assert [r.id for r in pending(log, "files", batch_name="b1").collect()] == [1, 5]
    assert [r.id for r in pending(log, "files", folders=["b2/", "/z/"], r_type=97).collect()] == [2]
    with pytest.raises(ValueError):
        pending(log, "all")


def test_status(spark):
    log = log_of(spark, entry(1), entry(2, file_name="g", load_ref_datetime=None), entry(3, file_name="g"),
                 entry(5, "2024-06-01", batch_name="c", year="2018", load_archive_datetime=T1),
                 entry(6, "2024-07-01", batch_name="d", year="2018", load_archive_datetime=T1))
    files = incoming(spark, {"file_loc": "/p/"}, {"file_loc": "/p/", "file_name": "g"}, {"year": "2018"}, {"file_name": "h"})
    assert rows_of(load_status(files, log), "file_name", "year", "status") == [
        ("f", "2018", -9999), ("f", "2020", -1), ("g", "2020", 2), ("h", "2020", 0)]


def test_events_and_notes(spark):
    log = log_of(spark, entry(1, etl_notes="old;"), entry(2))
    events = spark.createDataFrame(
        [(1, "load_raw_datetime", T1, None), (1, "load_raw_datetime", NOW, None), (1, "qa_rows_raw", T1, 3.0),
         (1, "qa_rows_raw", NOW, 4.0), (2, "qa_pop_raw", NOW, 1.5)], "id long, field string, ts timestamp, value double")
    out = apply_log_events(log, events)
    assert rows_of(out, "id", "load_raw_datetime", "qa_rows_raw", "qa_pop_raw", "last_update_datetime") == [
        (1, NOW, 4, None, NOW), (2, None, None, 1.5, None)]
    notes = spark.createDataFrame([(1, 2, "second", NOW), (1, 1, "first", T1)], "id long, seq int, note string, ts timestamp")
    assert rows_of(append_notes(log, notes), "id", "etl_notes") == [
        (1, "old;first (2024-01-01 00:00:00);second (2024-05-01 12:00:00);"), (2, None)]
    assert rows_of(get_log(log, 2), "id", "batch_name") == [(2, "b")]


def test_archive_lists(spark):
    log = log_of(spark, entry(1, "2023-01-01"), entry(2, "2023-06-01"), entry(3, "2024-01-01"), entry(4, "2024-01-01"),
                 entry(5, "2022-01-01", load_ref_datetime=None), entry(6, year="2011"), entry(7, "2021-01-01", geo_scope="wa"))
    assert rows_of(archive_candidates(log)) == [(1, 4, 97)]
    assert rows_of(direct_archive_candidates(log)) == [(5, 4, 97)]
    assert rows_of(direct_archive_candidates(log, spark.createDataFrame([(9,)], "id long"))) == []


def test_prune_lists(spark):
    kept = [entry(i, f"2020-0{i}-01", load_archive_datetime=T1) for i in range(1, 5)]
    log = log_of(spark, *kept, entry(9, "2019-01-01", load_archive_datetime=T1, delete_archive_datetime=T1),
                 entry(10, "2020-01-01"))
    assert rows_of(prune_candidates(log), "id") == [(1,), (10,)]
    assert rows_of(prune_candidates(log, 4), "id") == []
    assert rows_of(prune_candidates(log, 2, exhaust=True), "id") == [(1,), (2,)]


def batches(spark, *ids):
    return spark.createDataFrame([(i, f"g{n}", 1.0) for i in ids for n in range(3)], "etl_batch_id long, geo_id string, pop double")


def counts(spark, path):
    return {r[0]: r[1] for r in spark.read.parquet(path).groupBy("etl_batch_id").count().collect()}


def test_batches_are_replaced_and_moved_once(spark, tmp_path):
    ref, archive = str(tmp_path / "ref"), str(tmp_path / "archive")
    for _ in range(2):
        replace_batch(batches(spark, 1, 2, 3), ref)
    assert counts(spark, ref) == {1: 3, 2: 3, 3: 3}
    replace_batch(batches(spark, 3).limit(1), ref)
    old = spark.createDataFrame([(1, 3), (2, 3)], "archive_id long, ref_id long")
    assert archive_move(spark, ref, archive, old) == 2
    assert archive_move(spark, ref, archive, old) == 0
    assert counts(spark, ref) == {3: 1} and counts(spark, archive) == {1: 3, 2: 3}
    assert prune_archive(spark, archive, spark.createDataFrame([(1,), (8,)], "id long")) == 1
    assert counts(spark, archive) == {2: 3}


def test_versions_and_copies(spark, tmp_path):
    path = str(tmp_path / "log")
    write_current(spark.range(3), path)
    write_current(read_current(spark, path).where("id > 0"), path)
    assert rows_of(read_current(spark, path)) == [(1,), (2,)]
    with pytest.raises(FileNotFoundError):
        read_current(spark, str(tmp_path / "none"))
    report = copy_and_verify(spark, {"a": spark.range(5), "b": spark.range(0)}, str(tmp_path / "copy"))
    assert rows_of(report) == [("a", 5, 5, "PASS"), ("b", 0, 0, "PASS")]


def test_stamp_events(spark):
    events = stamp_events(spark.createDataFrame([(1,), (1,)], "k long"), "k", ["load_archive_datetime"], NOW)
    assert rows_of(events) == [(1, "load_archive_datetime", NOW, None)]


def test_reconcile_and_resume(spark):
    log = log_of(spark, entry(1, qa_rows_file=3, qa_pop_file=10.4), entry(2, qa_rows_file=1, qa_pop_file=1.0))
    sums = spark.createDataFrame([(1, 3, 10.0)], "etl_batch_id long, row_cnt long, pop_tot double")
    out = reconcile_hops(log, {"raw": sums})
    assert rows_of(out, "etl_batch_id", "rows_raw", "raw_ok") == [(1, 3, True), (2, 0, False)]
    assert rows_of(resume_points(log, batches(spark, 1))) == [(1, 3), (2, 0)]


def test_quality_rounding_and_zero_reference(spark):
    def sums(*rows):
        return spark.createDataFrame(rows, QA_SCHEMA)
    raw = sums(("zip", "wa", "2021", 97, "2021", "age", 1, 3.0), ("blk", "kps", "2020", 97, "2021", "age", 1, 1.00005),
               ("blk", "kps", "2020", 97, "2021", "age", 2, 5.0))
    ref = sums(("zip", "wa", "2020", 97, "2020", "age", 1, 2.0), ("blk", "kps", "2020", 97, "2020", "age", 1, 1.0),
               ("blk", "kps", "2020", 97, "2021", "age", 2, 0.0))
    assert rows_of(qa_compare(raw, ref), "val", "diff", "perc") == [(2, 5.0, None)]
    assert rows_of(qa_compare(raw, ref, prior=True), "geo_type", "diff", "perc") == [("blk", 0.00005, 0.0), ("zip", 1.0, 0.5)]


def test_quality_long_leaves_nulls_out(spark):
    rows = spark.createDataFrame([("blk", "kps", "2020", 97, "2020", 1, None, 2.0), ("blk", "kps", "2020", 97, "2020", 1, "33", 3.0)],
                                 "geo_type string, geo_scope string, geo_year string, r_type smallint, year string, age smallint, fips_co string, pop double")
    assert rows_of(qa_long(rows, ["age", "fips_co"]), "col", "val", "pop") == [("age", 1, 5.0), ("fips_co", 33, 3.0)]


def test_sizes(spark, monkeypatch):
    from tallyfold.operators import sizing

    def plan(frame):
        return frame._jdf.queryExecution().analyzed().toString()
    side = spark.range(50).withColumn("d", F.current_date())
    assert "LocalRelation" in plan(small_side(side))
    monkeypatch.setattr(sizing, "PINNED_ROWS", 10)
    assert "ResolvedHint (strategy=broadcast)" in plan(small_side(side)) and "Range" in plan(small_side(side))
    assert "strategy" not in plan(small_side(side, 20))
    assert "LocalRelation" not in plan(small_side(side.withColumn("t", F.current_timestamp())))
