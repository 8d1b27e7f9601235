import itertools
import zlib

from pyspark.sql import functions as F

from tallyfold.llm import sharding


def test_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (3, 4)):
        cells = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=n)), [f"x{k}" for k in range(n)])
        rows = cells.select("*", sharding.hilbert([F.col(c) for c in cells.columns], bits).alias("h")).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(1 << bits * n))
        for a, b in itertools.pairwise(rows):
            assert sum(abs(a[k] - b[k]) for k in range(n)) == 1


def check(rows, found, shards):
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in found) == sorted(
        (r[0] is None, r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by.setdefault(r.shard, []).append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    total, largest = sum(r.size for r in found), max((r.size for r in found), default=0)
    for k in range(shards):
        assert abs(sum(r.size for r in by.get(k, [])) - total / shards) <= largest + 1
    line = [(r.curve, r.text_crc32) for k in sorted(by) for r in sorted(by[k], key=lambda r: r.slot)]
    assert [c for c, _ in line] == sorted(c for c, _ in line)
    assert len(list(itertools.groupby(line))) == len(set(line))  # equal texts stand together


def test_shards(docs_of):
    rows = [(k, "x" * (k * 7 % 300), ["en", "de", None][k % 3], f"src{k % 7}", 1) for k in range(400)]
    rows += [(1000 + k, "copy of all", "en", f"src{k % 5}", 1) for k in range(250)]
    rows += [(None, None), (None, ""), (2, None), (2, "x"), (2, "x"), (3, "y" * 5000)]
    frame = docs_of(*rows).selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size", "4 AS body", "5 AS curve")
    check(rows, sharding.assign(frame, shards=12).collect(), 12)


def test_few_rows(docs_of):
    assert sharding.assign(docs_of().limit(0)).count() == 0
    rows = [(1, "a"), (2, None)]
    check(rows, sharding.assign(docs_of(*rows)).collect(), 40)


def test_written_files_can_be_skipped(spark, docs_of, tmp_path):
    rows = [(k, f"{k:04}" + "x" * (k % 200), ["en", "de", "fr"][k % 3], f"src{k % 6}", k % 200) for k in range(600)]
    frame = docs_of(*rows, (5, "xx"), (5, "xx"))
    sharding.write_shards(frame, f"{tmp_path}/s", shards=16)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert sorted(map(str, back.select(*frame.columns).collect())) == sorted(map(str, frame.collect()))
    spans = back.groupBy("shard").agg((F.max("n_chars") - F.min("n_chars")).alias("span"),
                                      F.count_distinct("lang").alias("langs")).collect()
    assert sum(r.span for r in spans) / len(spans) < 120 and min(r.langs for r in spans) < 3


def test_a_large_shard_is_several_files(spark, docs_of, tmp_path):
    frame = docs_of(*[(k, f"{k:04}" + "x" * (k % 200), "en", "s", k) for k in range(600)])
    sharding.write_shards(frame, f"{tmp_path}/s", shards=2, file_bytes=8000)
    back = spark.read.parquet(f"{tmp_path}/s").groupBy("shard", F.input_file_name().alias("file"))
    files = back.agg(F.min("slot").alias("low"), F.max("slot").alias("high"), F.count("*").alias("n")).collect()
    assert all(r.high - r.low + 1 == r.n for r in files) and sum(r.n for r in files) == 600
    assert all(sum(r.shard == k for r in files) >= 3 for k in (0, 1))


def test_written_columns_keep_their_names_and_values(spark, docs_of, tmp_path):
    rows = [(k // 2, f"text {k // 3}") for k in range(40)] + [(None, None), (None, None)]
    frame = docs_of(*rows).selectExpr("*", "'2020' AS time", "7 AS crc", "8 AS turn", "9 AS of", "10 AS row", "11 AS Shard", "12 AS slot")
    sharding.write_shards(frame, f"{tmp_path}/s", shards=3)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert sorted(map(str, back.select(*frame.columns).collect())) == sorted(map(str, frame.collect()))
    assert {"_shard", "_slot"} <= set(back.columns)
    slots = sorted((r["_shard"], r["_slot"]) for r in back.collect())
    assert len(set(slots)) == 42 and {s for s, _ in slots} == {0, 1, 2}
