"""The log in blocks of ids: same rows as the log as one frame, and only touched blocks written anew."""

import pytest

from frames import rows_of
from tallyfold.operators.log import append_notes, apply_log_events, upsert_log
from tallyfold.schema import LOG_SCHEMA
from tallyfold.sources.batches import BatchStore
from tallyfold.sources.logbook import LogBook
from tallyfold.sources.store import write_current
from test_log import NOW, T1, entry, incoming, log_of

EVENTS = "id long, field string, ts timestamp, value double"


@pytest.fixture
def book(spark, tmp_path):
    """Ids 1 to 10 in blocks of four, the last one not full; two share a key, one has no scope."""
    book = LogBook(spark, str(tmp_path / "log"), block_ids=4)
    rows = [entry(i, file_name=f"f{i}") for i in range(1, 9)]
    log = log_of(spark, *rows, entry(9, file_name="f2"), entry(10, file_name="none", geo_scope=None))
    assert book.replace(log) == 10
    return book


def written_anew(book, change):
    before = dict(rows_of(book.blocks()))
    change()
    return {block for block, write in rows_of(book.blocks()) if before.get(block) != write}


def test_upsert_writes_only_blocks_of_known_files_and_behind_the_last(spark, book):
    log = book.read()
    files = incoming(spark, {"file_name": "f2"}, {"file_name": "none", "geo_scope": None}, {"file_name": "g1"},
                     {"file_name": "g2"}, {"file_name": "g3"})
    whole = rows_of(upsert_log(log, files, NOW))
    # f2 is updated at its newest id, 9; 11 and 12 fill that block, 13 opens one.
    assert written_anew(book, lambda: book.upsert(files, NOW)) == {2, 3}
    assert rows_of(book.read()) == whole and len(whole) == 13
    assert written_anew(book, lambda: book.upsert(incoming(spark, {"file_name": "f5"}), NOW)) == {1}
    assert written_anew(book, lambda: book.upsert(files.limit(0), NOW)) == set()
    # What was read before a change can still be read.
    assert log.count() == 10
    assert book.vacuum() == 2 and book.read().count() == 13


def test_events_and_notes_write_only_their_blocks(spark, book):
    events = spark.createDataFrame([(5, "load_raw_datetime", NOW, None), (6, "qa_rows_raw", T1, 7.0), (99, "load_raw_datetime", NOW, None)],
                                   EVENTS)
    whole = rows_of(apply_log_events(book.read(), events))
    assert written_anew(book, lambda: book.apply(events)) == {1}
    assert rows_of(book.read()) == whole
    notes = spark.createDataFrame([(1, 2, "b", T1), (1, 1, "a", T1), (9, 1, None, NOW)], "id long, seq int, note string, ts timestamp")
    whole = rows_of(append_notes(book.read(), notes))
    assert written_anew(book, lambda: book.note(notes)) == {0, 2}
    assert rows_of(book.read()) == whole
    assert written_anew(book, lambda: book.apply(events.limit(0))) == set()
    assert written_anew(book, lambda: book.apply(events.where("id = 99"))) == set()


def test_a_change_that_breaks_leaves_the_log(spark, book, monkeypatch):
    before = rows_of(book.read())
    with monkeypatch.context() as broken:
        broken.setattr(BatchStore, "_swap", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            book.upsert(incoming(spark, {"file_name": "f1"}, {"file_name": "new"}), NOW)
    assert rows_of(book.read()) == before
    assert book.upsert(incoming(spark, {"file_name": "new"}), NOW) == 3  # 9, 10 and the new 11


def test_only_blocks_of_ids_are_read_and_the_width_stays(spark, book):
    again = LogBook(spark, book.root, block_ids=1000)
    assert again.block_ids == 4
    ids = spark.createDataFrame([(7,), (7,), (10,), (50,)], "id long")
    assert rows_of(again.read(ids), "id") == [(7,), (10,)]


def test_empty_absent_and_replaced_logs(spark, tmp_path):
    book = LogBook(spark, str(tmp_path / "log"), block_ids=2)
    with pytest.raises(FileNotFoundError):
        book.read()
    assert book.upsert(incoming(spark, {}, {"file_name": "g"}, {"file_name": "h"}), NOW) == 3
    assert rows_of(book.read(), "id", "file_name") == [(1, "f"), (2, "g"), (3, "h")]
    # Made from itself, with fewer blocks; a row without id is kept.
    assert book.replace(book.read().where("id < 3").unionByName(log_of(spark, entry(None)))) == 3
    assert rows_of(book.blocks(), "block") == [(-1,), (0,)] and rows_of(book.read(), "id") == [(None,), (1,), (2,)]
    assert book.replace(spark.createDataFrame([], LOG_SCHEMA)) == 0 and book.read().count() == 0


def test_narrow_blocks_share_folders(spark, book, tmp_path):
    def folders():
        return [f for f in (tmp_path / "log" / "data" / "log").glob("write=*/*") if f.is_dir()]

    # Three blocks of four ids, one folder for each write; a change of one block leaves the others where they are.
    assert len(folders()) == 1
    event = spark.createDataFrame([(5, "load_raw_datetime", NOW, None)], EVENTS)
    assert written_anew(book, lambda: book.apply(event)) == {1}
    assert len(folders()) == 2
    rows = rows_of(book.read())
    # The old block 1 goes; 0 and 2 lay beside it and are written anew.
    assert book.vacuum() == 1 and book.vacuum() == 0
    assert len(folders()) == 2 and rows_of(book.read()) == rows


def test_log_with_a_folder_for_each_block_is_read_on(spark, tmp_path):
    root = str(tmp_path / "log")
    write_current(spark.createDataFrame([(4,)], "block_ids long"), f"{root}/block_ids")
    old = LogBook(spark, root)
    old.replace(log_of(spark, *[entry(i, file_name=f"f{i}") for i in range(1, 9)]))
    assert sorted(f.name for f in (tmp_path / "log" / "data" / "log").glob("write=*/*=*")) == ["etl_batch_id=0", "etl_batch_id=1"]
    again = LogBook(spark, root)
    assert written_anew(again, lambda: again.apply(spark.createDataFrame([(5, "load_raw_datetime", NOW, None)], EVENTS))) == {1}
    assert again.vacuum() == 1 and rows_of(again.read(), "id") == [(i,) for i in range(1, 9)]
