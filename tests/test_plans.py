"""Files on disk through intake, load, archive, quality sums and cleaning."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from catalog.shapes import rules
from frames import rows_of
from tallyfold.operators.qa import qa_long
from tallyfold.plans.cleaning import clean_frame
from tallyfold.plans.intake import run_intake
from tallyfold.plans.load import run_archive, run_load
from tallyfold.plans.quality import refresh_quality, run_qa
from tallyfold.schema import LOG_SCHEMA, STAGE_SCHEMA
from tallyfold.streaming.arrivals import load_arrivals
from tallyfold.sources import landing
from tallyfold.sources.batches import BatchStore
from tallyfold.sources.logbook import LogBook
from tallyfold.sources.store import read_current
from test_raw import LINES_97, write_gz

MARCH, APRIL, MAY = (dt.datetime(2024, m, 1) for m in (3, 4, 5))
OLD = ["YEAR,BLOCKCODE,AGESTR,GENDER,RACE,HISPANIC,POP", "2020,530330001001000,030,1,10000,1,4"]


@pytest.fixture
def store(spark, tmp_path):
    return tmp_path / "in", str(tmp_path / "root")


def deliver(spark, folder, root, batch, now):
    write_gz(folder / batch / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    write_gz(folder / batch / "BlockCode2020RaceMars772020.csv.gz", OLD)
    run_intake(spark, str(folder), LogBook(spark, f"{root}/log"), now=now, census_year="2020", base_path=str(folder),
               final_folder=str(folder))


def test_two_deliveries(spark, store):
    folder, root = store
    deliver(spark, folder, root, "20240301final", MARCH)
    log = run_load(spark, root, rules(spark, False), now=MARCH)
    columns = ["id", "r_type", "qa_rows_file", "qa_rows_raw", "qa_rows_stage", "qa_rows_ref", "qa_pop_ref", "load_ref_datetime"]
    assert rows_of(log, *columns) == [(1, 77, 1, 1, 1, 1, 4.0, MARCH), (2, 97, 6, 2, 2, 2, 2.0, MARCH)]
    store = BatchStore(spark, root)
    ref = store.read("ref")
    assert set(ref.columns) == {f.name for f in STAGE_SCHEMA.fields}
    assert rows_of(ref, "age", "age_20", "gender", "rcode", "r2r4", "race_wht", "race_hisp", "pop") == [
        (34, 2, 1, 1, 1, 1, 0, 1.5), (105, 4, 2, 2, 6, 0, 1, 0.25)]

    # Nothing pending: nothing changes.
    assert rows_of(run_load(spark, root, rules(spark, False), now=APRIL), *columns) == rows_of(log, *columns)

    deliver(spark, folder, root, "20240401final", APRIL)
    log = run_load(spark, root, rules(spark, False), now=APRIL)
    assert rows_of(log, "id", "load_archive_datetime", "delete_ref_datetime") == [
        (1, APRIL, APRIL), (2, APRIL, APRIL), (3, None, None), (4, None, None)]
    assert rows_of(store.read("ref").select("etl_batch_id").distinct()) == [(4,)]
    assert rows_of(store.read("archive_ref").select("etl_batch_id").distinct()) == [(2,)]
    assert rows_of(store.read("archive_ref_77").select("etl_batch_id").distinct()) == [(1,)]

    deliver(spark, folder, root, "20240501final", MAY)
    log = run_load(spark, root, rules(spark, False), now=MAY, max_archive=1)
    assert rows_of(log.where("delete_archive_datetime IS NOT NULL"), "id") == [(1,), (2,)]
    assert rows_of(store.read("archive_ref").select("etl_batch_id").distinct()) == [(4,)]
    assert rows_of(run_archive(spark, root, now=MAY, max_archive=1)) == rows_of(log)


def test_arrivals(spark, store, tmp_path):
    folder, root = store
    folder.mkdir()
    times = iter([MARCH, APRIL])

    def run():
        query = load_arrivals(spark, str(folder), root, rules(spark, False), clock=lambda: next(times), census_year="2020",
                              checkpoint=str(tmp_path / "seen"), base_path=str(folder), final_folder=str(folder))
        query.awaitTermination()
        return rows_of(LogBook(spark, f"{root}/log").read(), "id", "r_type", "qa_rows_ref", "load_ref_datetime",
                       "load_archive_datetime")

    write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    assert run() == [(1, 97, 2, MARCH, None)]
    write_gz(folder / "20240401final" / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    assert run() == [(1, 97, 2, MARCH, APRIL), (2, 97, 2, APRIL, None)]
    # No new file: the clock is not asked again.
    assert len(run()) == 2


def test_stage_only(spark, store):
    folder, root = store
    deliver(spark, folder, root, "20240301final", MARCH)
    log = run_load(spark, root, rules(spark, False), now=MARCH, full=False, geo_types=["blk"], r_type=97)
    assert rows_of(log, "id", "load_raw_datetime", "load_stage_datetime", "load_ref_datetime") == [
        (1, None, None, None), (2, MARCH, MARCH, None)]
    stage = BatchStore(spark, root).read("stage")
    assert rows_of(stage, "raw_agestr", "age", "fips_co", "pop") == [("034", None, 33, 1.5), ("105", None, 33, 0.25)]


def test_quality_run(spark, store):
    folder, root = store
    deliver(spark, folder, root, "20240301final", MARCH)
    run_load(spark, root, rules(spark, False), now=MARCH)
    store = BatchStore(spark, root)
    ref, old = store.read("ref"), store.read("ref_77")
    sums = run_qa(f"{root}/qa", ref, old, raw=ref, report=f"{root}/report")
    assert rows_of(sums.where("col = 'age'"), "r_type", "val", "pop") == [(77, 30, 4.0), (97, 34, 1.5), (97, 105, 0.25)]
    assert rows_of(sums) == rows_of(qa_long(ref.unionByName(old)))
    report = spark.read.option("header", "true").csv(f"{root}/report/comparison=raw_vs_current_year")
    assert report.count() == qa_long(ref).count() and {r[0] for r in report.select("diff").collect()} == {"0.0"}


def test_refreshed_quality_reads_changed_batches_only(spark, store, monkeypatch):
    folder, root = store
    deliver(spark, folder, root, "20240301final", MARCH)
    run_load(spark, root, rules(spark, False), now=MARCH)
    held = BatchStore(spark, root)
    read, whole = [], BatchStore.read

    def seen(self, dataset, ids=None):
        if dataset.startswith("ref"):
            read.append((dataset, rows_of(ids)))
        return whole(self, dataset, ids)

    monkeypatch.setattr(BatchStore, "read", seen)
    both = whole(held, "ref").unionByName(whole(held, "ref_77"))
    assert rows_of(refresh_quality(held)) == rows_of(qa_long(both))
    assert read == [("ref", [(1,), (2,)]), ("ref_77", [(1,), (2,)])]
    refresh_quality(held)
    assert len(read) == 2
    old = whole(held, "ref_77").withColumn("pop", F.lit(40.0))
    held.write("ref_77", spark.createDataFrame(old.collect(), old.schema))
    del read[:]
    sums = refresh_quality(held)
    assert read == [("ref", [(1,)]), ("ref_77", [(1,)])]
    assert rows_of(sums.where("col = 'age'"), "r_type", "val", "pop") == [(77, 30, 40.0), (97, 34, 1.5), (97, 105, 0.25)]
    held.drop(spark.createDataFrame([(1, "ref_77")], "etl_batch_id long, dataset string"))
    assert rows_of(refresh_quality(held)) == rows_of(qa_long(whole(held, "ref")))


def test_clean_frame(spark):
    rows = spark.createDataFrame(
        [("2020", "530330001001000", "034 x", "1", "1000", "1", 2.0), ("2020", "530770001001000", "034", "1", "1000", "1", 2.0)],
        "Year string, BlockCode2020 string, AgeStr string, Gender string, RaceMars97 string, Hispanic string, Pop double")
    areas = spark.createDataFrame([("2020", "530330001001000", "h1")], "geo_year string, blk_geo_id string, hra_id string")
    info = {"file_name": "BlockCode2020RaceMars972020.csv.gz", "geo_type": "blk", "geo_scope": "kps", "geo_year": "2020",
            "census_year": "2020", "r_type": 97}
    out = clean_frame(rows, info, rules(spark, False), areas, etl_batch_id=5)
    assert rows_of(out, "etl_batch_id", "geo_id", "raw_racemars", "age", "rcode", "r2r4", "race_blk", "race_wht", "hra_id") == [
        (5, "530330001001000", "01000", 34, 2, 6, 1, 0, "h1")]
    assert "id" in out.columns
    assert clean_frame(rows, {**info, "geo_type": "trc"}, rules(spark, False), areas).count() == 0
    assert clean_frame(rows, {**info, "geo_type": "zip", "geo_scope": "wa"}, rules(spark, False), areas).where(
        F.col("fips_co") == "0").count() == 2


def intake(spark, folder, root):
    log = run_intake(spark, folder, spark.createDataFrame([], LOG_SCHEMA), now=MARCH, census_year="2020",
                     base_path=folder, final_folder=folder)
    LogBook(spark, f"{root}/log").replace(log)
    return log


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_odd_names_and_stray_files(spark, tmp_path, scheme):
    """Folders with blanks, URIs, endings in capitals and files that are no data."""
    folder, root = tmp_path / "my files+more", str(tmp_path / "root")
    write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.CSV.gz", LINES_97)
    (folder / "readme.txt").write_text("a,b\n" * 150)
    log = intake(spark, f"{scheme}{folder}", root)
    assert rows_of(log, "batch_name", "qa_rows_file", "qa_pop_file") == [("20240301final", 6, 6.0)]
    log = run_load(spark, root, rules(spark, False), now=MARCH)
    assert rows_of(log, "qa_rows_raw", "qa_rows_ref") == [(2, 2)]


def test_batch_without_valid_rows_is_stamped_and_replaced(spark, store):
    folder, root = store
    good = "BlockCode2020RaceMars772020.csv.gz"
    write_gz(folder / "20240301final" / good, OLD)
    intake(spark, str(folder), root)
    run_load(spark, root, rules(spark, False), now=MARCH)
    write_gz(folder / "20240301final" / good, [OLD[0], OLD[1].removesuffix("4"), OLD[1].removesuffix("4")])
    log = intake(spark, str(folder), root)
    assert rows_of(log, "id", "qa_rows_file", "qa_pop_file") == [(1, 2, 0.0)]
    log = run_load(spark, root, rules(spark, False), now=APRIL)
    assert rows_of(log, "qa_rows_raw", "qa_rows_stage", "qa_rows_ref", "qa_pop_ref", "load_ref_datetime") == [
        (0, 0, 0, 0.0, APRIL)]
    store = BatchStore(spark, root)
    assert [store.read(x).count() for x in ("raw", "stage", "ref", "ref_77")] == [2, 0, 0, 0]


def test_table_batches_are_loaded_beside_files(spark, store):
    folder, root = store
    write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    log = intake(spark, str(folder), root)
    row = {"id": 9, "batch_name": "tables", "batch_date": dt.date(2024, 3, 1), "file_name": "heads", "file_loc": "ref",
           "geo_type": "blk", "geo_scope": "kps", "geo_year": "2020", "census_year": "2020", "year": "2019", "r_type": 97}
    fields = [f.name for f in LOG_SCHEMA.fields]
    more = [tuple({**row, **change}.get(name) for name in fields)
            for change in ({}, {"id": 10, "year": "2018"}, {"id": 11, "file_name": "absent"})]
    LogBook(spark, f"{root}/log").replace(log.unionByName(spark.createDataFrame(more, LOG_SCHEMA)))
    heads = spark.createDataFrame(
        [("530330001001000", 2.0, "034", "1", 10000, "0", 2019), ("530330001001000", 5.0, "034", "1", 10000, "0", 2017)],
        "Block2020 string, Pop double, AgeGroup string, Gender string, RaceMars97 int, Hispanic string, Year int")
    log = run_load(spark, root, rules(spark, False), now=MARCH, tables={"heads": heads})
    assert rows_of(log, "id", "qa_rows_raw", "qa_rows_ref", "qa_pop_ref", "load_ref_datetime") == [
        (1, 2, 2, 2.0, MARCH), (9, 1, 1, 2.0, MARCH), (10, 0, 0, 0.0, MARCH), (11, None, None, None, None)]
    ref = BatchStore(spark, root).read("ref").where("etl_batch_id = 9")
    assert rows_of(ref, "year", "age", "gender", "fips_co", "pop") == [("2019", 34, 1, 33, 2.0)]


LOSSY = ["YEAR,BLOCKCODE,AGESTR,GENDER,RACE,HISPANIC,POP", "2020,530330001001000,030,1,10000,1,4", "2020,530330001001000,030,1,10000,1,",
         "2020,530330001001000,030,1,10000,1,many", "2020,530330001001000,030,1,10000,1, 1x ", ",530330001001000,030,1,10000,1,3", "2020,short"]


def test_every_row_of_a_file_is_accounted_for(spark, store):
    folder, root = store
    write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz", LOSSY)
    log = intake(spark, str(folder), root)
    assert rows_of(log, "qa_rows_file") == [(6,)]
    run_load(spark, root, rules(spark, False), now=MARCH)
    hops = rows_of(read_current(spark, f"{root}/hops"), "hop", "fate", "rows")
    assert hops == sorted([
        ("file", "kept", 4), ("file", "bad_record", 1), ("file", "no_first_cell", 1), ("file", "header", 1), ("raw", "kept", 1),
        ("raw", "no_headcount", 1), ("raw", "unreadable_headcount", 2), ("stage", "kept", 1), ("ref", "kept", 1)])
    assert rows_of(BatchStore(spark, root).read("raw"), "pop_unreadable") == [(None,), (None,), (" 1x",), ("many",)]
    assert rows_of(read_current(spark, f"{root}/reconciled"), "rows_file", "rows_raw", "raw_ok") == [(6, 1, False)]


def test_lost_rows_raise(spark, store, monkeypatch):
    folder, root = store
    write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    intake(spark, str(folder), root)
    from tallyfold.plans import load
    whole = load.stage_rows
    monkeypatch.setattr(load, "stage_rows", lambda raw, rules: whole(raw, rules).where("age < 100"))
    with pytest.raises(RuntimeError, match="2 sent to stage, 1 there"):
        run_load(spark, root, rules(spark, False), now=MARCH)
    assert rows_of(LogBook(spark, f"{root}/log").read(), "load_raw_datetime") == [(None,)]


def test_files_are_inflated_once_and_in_waves(spark, store, monkeypatch):
    folder, root = store
    for year in range(2015, 2021):
        write_gz(folder / "20240301final" / f"BlockCode2020RaceMars97{year}.csv.gz", LINES_97)
    read, whole = [], landing.read_raw
    monkeypatch.setattr(landing, "read_raw", lambda spark, paths, **more: read.append(len(paths)) or whole(spark, paths, **more))
    log = run_intake(spark, str(folder), spark.createDataFrame([], LOG_SCHEMA), now=MARCH, census_year="2020", base_path=str(folder),
                     final_folder=str(folder), landing=f"{root}/landing", per_wave=4)
    LogBook(spark, f"{root}/log").replace(log)
    assert read == [4, 2]
    log = run_load(spark, root, rules(spark, False), now=MARCH, per_wave=4)
    assert read == [4, 2] and rows_of(log, "qa_rows_file", "qa_rows_raw", "qa_rows_ref") == [(6, 2, 2)] * 6
    # A changed file is read again, alone, and stands in for its earlier version.
    changed = folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz"
    write_gz(changed, LINES_97[:3])
    os.utime(changed, (2e9, 2e9))
    files = spark.createDataFrame([(str(f),) for f in sorted(folder.rglob("*.gz"))], "file string")
    assert landing.land_files(spark, files, f"{root}/landing") == 1 and read == [4, 2, 1]
    assert landing.landed_rows(spark, f"{root}/landing", files).count() == 5 * 8 + 3
    assert landing.drop_stale_waves(spark, f"{root}/landing") == 0
    write_gz(changed, LINES_97[:2])
    os.utime(changed, (2.1e9, 2.1e9))
    assert landing.land_files(spark, files, f"{root}/landing") == 1
    assert landing.drop_stale_waves(spark, f"{root}/landing") == 1
    assert landing.landed_rows(spark, f"{root}/landing", files).count() == 5 * 8 + 2


def test_a_wave_that_broke_is_not_read(spark, store, monkeypatch):
    folder, root = store
    path = write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    files = spark.createDataFrame([(path,)], "file string")
    with monkeypatch.context() as broken:
        broken.setattr(landing, "write_current", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            landing.land_files(spark, files, f"{root}/landing")
    assert landing.landed_rows(spark, f"{root}/landing", files).count() == 0
    landing.land_files(spark, files, f"{root}/landing")
    assert landing.landed_rows(spark, f"{root}/landing", files).count() == 8
    assert landing.drop_stale_waves(spark, f"{root}/landing") == 1


def test_a_change_of_batches_that_broke_changes_nothing(spark, store, monkeypatch):
    root = store[1]
    held = BatchStore(spark, root)
    kind = "etl_batch_id long, x int"
    held.write("ref", spark.createDataFrame([(1, 1), (2, 2), (3, 3)], kind))
    move = spark.createDataFrame([(1, "ref", "archive_ref")], "etl_batch_id long, dataset string, to string")
    with monkeypatch.context() as broken:
        broken.setattr(BatchStore, "_swap", lambda *_: 1 / 0)
        for change in (lambda: held.write("ref", spark.createDataFrame([(1, 9)], kind)), lambda: held.move(move),
                       lambda: held.drop(move)):
            with pytest.raises(ZeroDivisionError):
                change()
    assert rows_of(held.read("ref"), "etl_batch_id", "x") == [(1, 1), (2, 2), (3, 3)]
    assert held.vacuum() == 1
    assert held.move(move) == 1 and held.move(move) == 0
    # A batch that the archive has already is replaced by a later one; a write may have more columns.
    held.write("ref", spark.createDataFrame([(1, 7, "new")], f"{kind}, y string"))
    assert held.move(move) == 1 and held.vacuum() == 1
    assert rows_of(held.read("archive_ref"), "etl_batch_id", "x", "y") == [(1, 7, "new")]
    assert rows_of(held.read("ref"), "etl_batch_id", "x", "y") == [(2, 2, None), (3, 3, None)]
    ids = spark.createDataFrame([(2,), (3,)], "etl_batch_id long")
    assert held.write("ref", spark.createDataFrame([(3, 4)], kind), ids) == 1
    assert rows_of(held.read("ref", ids), "etl_batch_id", "x") == [(3, 4)]
    assert held.drop(spark.createDataFrame([(3, "ref")], "etl_batch_id long, dataset string")) == 1
    assert held.read("ref").count() == 0 and held.vacuum() == 3
    with pytest.raises(FileNotFoundError):
        held.read("never")


def test_copies_are_compared_and_the_source_is_read_once(spark, tmp_path):
    from tallyfold.plans.geographies import copy_geographies
    from tallyfold.sources import store as files
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda x: seen.add(1) or x, "long").asNondeterministic()
    rows = spark.range(50).select(counted("id").alias("id"))
    assert rows_of(copy_geographies(spark, {"a": rows}, str(tmp_path / "one"))) == [("a", 50, 50, "PASS")]
    assert seen.value == 50
    kept = files.write_table
    def spoiled(rows, path, **more):
        kept(rows, path, **more)
        if path.endswith("/a"):
            spark.range(1, 51).write.mode("overwrite").parquet(path)
    files.write_table = spoiled
    try:
        with pytest.raises(RuntimeError, match="copies differ"):
            copy_geographies(spark, {"a": spark.range(50)}, str(tmp_path / "two"))
    finally:
        files.write_table = kept


def noted_writes(monkeypatch):
    """Whether each write of headcounts is to be shuffled by batch."""
    found, take = [], BatchStore.put.__globals__["observed"]

    def noted(rows, **more):
        if "raw_agestr" in rows.columns:
            found.append("Rebalance" in rows._jdf.queryExecution().optimizedPlan().toString())
        return take(rows, **more)

    monkeypatch.setitem(BatchStore.put.__globals__, "observed", noted)
    return found


def test_rows_of_files_are_loaded_without_a_shuffle(spark, store, monkeypatch):
    folder, root = store
    write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    run_intake(spark, str(folder), LogBook(spark, f"{root}/log"), now=MARCH, census_year="2020", base_path=str(folder),
               final_folder=str(folder), landing=f"{root}/landing")
    files = landing.landed_files(spark, f"{root}/landing").select("file")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = landing.landed_rows(spark, f"{root}/landing", files)
        assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = noted_writes(monkeypatch)
    run_load(spark, root, rules(spark, False), now=MARCH)
    assert shuffled == [False] * 4
    assert rows_of(BatchStore(spark, root).read("ref"), "age", "pop") == [(34, 1.5), (105, 0.25)]


def test_many_rules_have_the_stage_gathered(spark, store, monkeypatch):
    """Lookups that are too large for a broadcast may scatter rows."""
    from tallyfold.operators import sizing
    folder, root = store
    write_gz(folder / "20240301final" / "BlockCode2020RaceMars972020.csv.gz", LINES_97)
    intake(spark, str(folder), root)
    monkeypatch.setattr(sizing, "PINNED_ROWS", 5)
    shuffled = noted_writes(monkeypatch)
    run_load(spark, root, rules(spark, False), now=MARCH)
    assert shuffled == [False, True, False, False]
