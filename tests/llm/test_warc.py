import gzip
import hashlib

import pytest

from tallyfold.llm import warc
from tallyfold.llm.common import Scratch

KIND = "page_id long, url string, html string"


def brute(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        refers = max(same) if len(data) >= 1000 and same and max(same) != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), kind, refers))
    return sorted(out, key=str)


BIG = "<p>é big</p>" * 100
ROWS = [(1, "http://a/", BIG), (2, None, BIG), (7, "http://b\r\nX: y", BIG), (3, "u", "small"), (4, "u", "small"),
        (5, "u", None), (6, "u", ""), (None, "n", BIG), (None, "n", "q" * 2000), (8, "x", "z" * 999), (9, "x", "z" * 999),
        (10, "x", "y" * 1000), (11, "x", "y" * 1000), (11, "x", "y" * 1000), (11, "x", "other\r\n\r\nWARC/1.1\r\n"),
        (12, "long", "word " * 400_000)]


def test_round_trip(spark):
    frame = spark.createDataFrame(ROWS, KIND).selectExpr("*", "1 AS refers_to", "2 AS body", "3 AS digest").repartition(3)
    found = warc.round_trip(spark, frame)
    assert sorted(map(tuple, found.collect()), key=str) == brute(ROWS)
    assert warc.round_trip(spark, frame.limit(0)).count() == 0


def test_archives_are_valid_and_selected_reads_work(spark, tmp_path):
    scratch = Scratch(spark, "test")
    frame = spark.createDataFrame(ROWS, KIND).coalesce(1)
    index = warc.write_archives(frame, f"{tmp_path}/w", scratch=scratch)
    files = list((tmp_path / "w").iterdir())
    assert len(files) == 1 and index.count() == len(ROWS)
    data = gzip.decompress(files[0].read_bytes())  # members one after the other
    seen = 0
    while data:
        fields, payload, _ = warc.parse(data)
        head = data.index(b"\r\n\r\n") + 4
        end = head + int(fields["Content-Length"])
        assert data[end:end + 4] == b"\r\n\r\n"
        data, seen = data[end + 4:], seen + 1
    assert seen == len(ROWS)
    some = warc.read_records(index.where("page_id IN (3, 7, 12)"), f"{tmp_path}/w").collect()
    assert {r.page_id: bytes(r.payload).decode() for r in some} == {3: "small", 7: BIG, 12: "word " * 400_000}
    bad = index.where("page_id = 3").selectExpr("4L AS page_id", *[c for c in index.columns if c != "page_id"])
    with pytest.raises(Exception, match="not what the index says"):
        warc.read_records(bad, f"{tmp_path}/w").count()
