"""Work that is done once: surveys of raw lines, lists of batches, gathering of batches."""

from pyspark.sql import functions as F

from catalog import queries
from catalog.shapes import shape
from frames import rows_of
from tallyfold.operators.lifecycle import split_archive
from tallyfold.sources.batches import BatchStore


def test_lines_are_surveyed_once(spark, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(line):
        seen.add(1)
        return line

    cells = ["2020", "530330001001000", "034", "1", "10000", "0", "1.5"]
    titles = ["Year", "BlockCode2020", "AgeStr", "Gender", "RaceMars", "Hispanic", "Pop"]
    rows = [(*line, None, "BlockCode2020RaceMars972020") for line in (titles, cells)]
    names = [*[f"col{i}" for i in range(1, 8)], "_bad_record", "file"]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    raw = raw.withColumn("col1", F.udf(counted)("col1"))
    monkeypatch.setattr(queries, "landed_lines", lambda *_: raw)
    typed, files = queries._typed_lines(queries.Inputs(spark, str(tmp_path)))
    read = seen.value
    assert rows_of(files) == [("BlockCode2020RaceMars972020",)]
    # One survey: two rows in its filter, the header once more behind it.
    assert (read, seen.value) == (3, 3)
    assert rows_of(typed, "geo_id", "pop") == [("530330001001000", 1.5)]


def test_list_of_batches_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    ids = spark.createDataFrame([(1,), (2,), (2,)], "archive_id long").withColumn("archive_id", F.udf(counted, "long")("archive_id"))
    rows = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c")], "etl_batch_id long, v string")
    moved, kept = split_archive(rows.withColumn("t", F.lit(1)), ids)
    assert (rows_of(moved, "v"), rows_of(kept, "v")) == ([("a",)], [("b",), ("c",)])
    assert seen.value == 3


def test_gathered_rows_are_written_as_they_come(spark, tmp_path, monkeypatch):
    store = BatchStore(spark, str(tmp_path))
    store.write("stage", spark.range(20).select((F.col("id") % 2).alias("etl_batch_id"), F.col("id").alias("n")))
    plans = []
    take = BatchStore.put.__globals__["observed"]

    def noted(rows, **more):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return take(rows, **more)

    monkeypatch.setitem(BatchStore.put.__globals__, "observed", noted)
    assert store.write("ref", store.read("stage").where("n > 3"), gathered=True) == 16
    assert store.write("old", store.read("stage")) == 20
    assert "Rebalance" not in plans[0] and "Rebalance" in plans[1]
    assert rows_of(store.read("ref"), "n") == [(n,) for n in range(4, 20)]


def _tables(spark, folder):
    """Five lines on four blocks as the tables that the shapes need."""
    lines = spark.createDataFrame(
        [(1, 7, 3, 1, 5.0), (1, 7, 3, 2, 6.0), (2, 7, 4, 1, 7.0), (3, 8, 3, 1, 8.0), (4, 8, None, 7, 9.0)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double")
    more = {"l_quantity": F.lit(20.0), "l_discount": F.lit(0.01), "l_returnflag": F.lit("A"), "l_linestatus": F.lit("F"),
            "l_shipdate": F.expr("make_timestamp(1992 + l_orderkey, 3, 1, 0, 0, 0)")}
    lines.withColumns(more).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_weights_are_stored_as_their_blocks(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    weights = queries.Inputs(spark, folder).weights
    assert rows_of(weights) == rows_of(shape(spark, folder, "weights")) and weights.count() == 4 * 12
    assert spark.read.parquet(*weights.inputFiles()).count() == 4
