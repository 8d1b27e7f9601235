"""Large sides of joins are narrowed to about the keys that they meet, and lose none of those."""

import pytest
from pyspark.sql import functions as F

from frames import rows_of
from tallyfold.operators import sizing
from tallyfold.operators.geo import allocate, block_crosswalk, select_facts
from tallyfold.operators.sizing import narrowed


@pytest.mark.parametrize("max_rows", [1000, 1])
def test_every_row_with_a_key_stays(spark, max_rows):
    rows = spark.range(-5000, 5000).select(F.col("id").cast("int").alias("n"), F.concat(F.lit("b"), "id").alias("k"))
    few = rows.where("n % 97 = 0")
    for key in ("n", "k"):
        among = few.select(F.col("n").cast("long").alias("n"), "k").unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS n, '' AS k"))
        left = narrowed(rows.unionByName(spark.sql("SELECT CAST(NULL AS INT) AS n, CAST(NULL AS STRING) AS k")), among, key, max_rows)
        assert rows_of(left.join(few.select(key), key, "left_semi"), "k") == rows_of(few, "k")
        assert left.count() < few.count() + 10


def test_keys_of_other_kinds_narrow_nothing(spark):
    rows = spark.sql("SELECT CAST(id AS DECIMAL(9,2)) AS id FROM range(9)")
    assert narrowed(rows, spark.range(2), "id").count() == 9


def _few_blocks_of_many(spark):
    rows = spark.range(1).select(F.lit(1).alias("etl_batch_id"), F.lit("2020").alias("census_year"), F.lit("2020").alias("geo_year"),
                                 F.lit("2020").alias("year"), F.lit(97).alias("r_type"), F.lit("530330000017").alias("geo_id"),
                                 F.lit("33").alias("fips_co"), F.lit(2.0).alias("pop"))
    weights = spark.range(2000).select(
        F.lit("2020").alias("census_year"), F.lit("2020").alias("geo_year"), F.lit("CCL").alias("target_type"), F.lit("C1").alias("target_id"),
        F.concat(F.lit("53033"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("geo_id"), F.lit(0.5).alias("proportion"))
    return rows, weights


def test_weights_of_other_blocks_are_not_shuffled(spark, shuffle_only):
    rows, weights = _few_blocks_of_many(spark)
    shared = allocate(rows, weights, dimensions=["fips_co"])
    assert rows_of(shared, "geo_id", "pop") == [("C1", 1.0)]
    assert "LeftSemi" in shared._jdf.queryExecution().optimizedPlan().toString()


def test_crosswalk_has_the_given_blocks_only(spark):
    rows, weights = _few_blocks_of_many(spark)
    areas = weights.select(F.col("census_year").alias("blk_census_year"), F.col("geo_id").alias("blk_geo_id"),
                           F.col("census_year").alias("hra_census_year"), F.lit("H1").alias("hra_geo_id"))
    walk = block_crosswalk(areas, weights, blocks=rows)
    assert rows_of(walk, "geo_id") == [("530330000017",)]
    assert block_crosswalk(areas, weights).count() == 2000


def test_facts_of_batches_that_are_not_chosen_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(sizing, "PINNED_ROWS", -1)
    monkeypatch.setattr(sizing.small_side, "__defaults__", (-1,))
    facts = spark.range(3000).select((F.col("id") % 1000).alias("etl_batch_id"), F.lit("53033").alias("geo_id"), F.lit(1).alias("pop"),
                                     *[F.lit("1").alias(c) for c in ("raw_agestr", "raw_gender", "raw_racemars", "raw_hispanic")])
    log = spark.range(0, 1000, 100).select("id", *[F.lit("blk").alias(c) for c in ("geo_type", "geo_scope", "geo_year", "census_year", "year", "r_type")])
    picked = select_facts(facts, log, "blk")
    assert picked.count() == 30
    assert "LeftSemi" in picked._jdf.queryExecution().optimizedPlan().toString()
