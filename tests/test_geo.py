"""Geography rollups: totals that must agree, equal results of equal plans, shuffle fallbacks."""

import pytest
from pyspark.sql import functions as F

from catalog.shapes import shape
from frames import rows_of
from tallyfold.operators.geo import (
    CODE_DIMENSIONS, allocate, block_codes, geo_direct, recode_rollup, rollup_hierarchy, rollup_prefix, select_facts,
)
from tallyfold.operators.log import latest_batches
from tallyfold.plans.geographies import area_tables, region_table, target_tables
from tallyfold.schema import GEO_COLUMNS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    names = ["facts", "log", "rules", "plain_rules", "areas", "regions", "weights"]
    return {n: shape(spark, SF_DIR, n) for n in names}


@pytest.fixture(scope="module")
def chosen(inputs):
    return latest_batches(inputs["log"])


def total(frame):
    return frame.agg(F.sum("pop")).first()[0]


@pytest.mark.parametrize("rules", ["rules", "plain_rules"])
def test_rolling_up_codes_equals_rolling_up_recoded_rows(inputs, chosen, rules):
    blocks = geo_direct(inputs["facts"], chosen, inputs[rules], "blk")
    by_rows = allocate(blocks, inputs["weights"], ["CCL"]).select(*GEO_COLUMNS)
    by_codes = target_tables(inputs["facts"], chosen, inputs[rules], inputs["weights"], ["CCL"])
    assert rows_of(by_rows) == rows_of(by_codes)


def test_full_shares_keep_the_total(inputs, chosen):
    blocks = geo_direct(inputs["facts"], chosen, inputs["rules"], "blk").where(F.col("geo_year") == "2020")
    shares = allocate(blocks, inputs["weights"])
    totals = {r.geo_type: r.pop for r in shares.groupBy("geo_type").agg(F.sum("pop").alias("pop")).collect()}
    assert totals["CCL"] == totals["PUMA"] == total(blocks)
    assert totals["tribal"] == total(blocks) * 9 / 10


def test_region_total_equals_area_total(inputs, chosen):
    hra, reg = area_tables(inputs["facts"], chosen, inputs["rules"], inputs["areas"], inputs["regions"])
    assert total(hra) == total(reg)
    assert total(region_table(hra, inputs["regions"].limit(0))) is None


def test_county_has_all_counties_and_block_only_three(inputs, chosen):
    counties = rollup_prefix(inputs["facts"], chosen, inputs["rules"])
    blocks = geo_direct(inputs["facts"], chosen, inputs["rules"], "blk")
    assert {r[0] for r in counties.select("geo_id").distinct().collect()} == {"53033", "53053", "53061", "53077"}
    assert {r[0] for r in blocks.select("fips_co").distinct().collect()} == {"33", "53", "61"}
    assert {tuple(r) for r in counties.select("geo_scope", "fips_co").distinct().collect()} == {("wa", None)}


def test_shuffle_joins_give_the_same(inputs, chosen, spark, shuffle_only):
    expected = rows_of(target_tables(inputs["facts"], chosen, inputs["rules"], inputs["weights"], ["kccd"]))
    plan = target_tables(inputs["facts"], chosen, inputs["rules"], inputs["weights"], ["kccd"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan._jdf.queryExecution().executedPlan().toString()
        assert rows_of(plan) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_batch_is_split(spark, shuffle_only):
    """A batch with a third of all rows is spread over several tasks of the shuffle join."""
    rows = spark.range(120_000, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, 1, id % 1000) AS etl_batch_id", "CAST(id AS STRING) AS geo_id", "CAST(id AS DOUBLE) AS pop",
        "uuid() AS raw_agestr", "'1' AS raw_gender", "'1' AS raw_racemars", "'1' AS raw_hispanic")
    log = spark.range(1000).selectExpr("id", "'blk' AS geo_type", "'kps' AS geo_scope", "'2020' AS geo_year",
                                       "'2020' AS census_year", "'2020' AS year", "CAST(97 AS SMALLINT) AS r_type")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.shuffle.partitions": "50"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = select_facts(rows, log, "blk")
        assert len(joined.collect()) == 120_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_split_block_and_block_without_target(spark):
    blocks = spark.createDataFrame(
        [(1, "2020", "2020", "2020", 97, "b1", 10.0), (1, "2020", "2020", "2020", 97, "b2", 5.0)],
        "etl_batch_id long, census_year string, geo_year string, year string, r_type smallint, geo_id string, pop double")
    weights = spark.createDataFrame(
        [("2020", "2020", "b1", "CCL", "t1", 0.6), ("2020", "2020", "b1", "CCL", "t2", 0.4), ("2020", "2010", "b2", "CCL", "t1", 1.0)],
        "geo_year string, census_year string, geo_id string, target_type string, target_id string, proportion double")
    out = allocate(blocks, weights, dimensions=())
    assert rows_of(out, "geo_type", "geo_scope", "geo_id", "pop") == [("CCL", "kc", "t1", 6.0), ("CCL", "kc", "t2", 4.0)]


def test_county_rows_may_look_alike(spark):
    """A rule that says 0 and a missing rule stay two rows."""
    from tallyfold.schema import RULE_SCHEMA
    log = spark.createDataFrame([(1, "blk", "kps", "2020", "2020", "2020", 97)],
                                "id long, geo_type string, geo_scope string, geo_year string, census_year string, year string, r_type smallint")
    book = [("age", None, 0, 120, band, 1, None, None) for band in ("age_5", "age_11", "age_20")]
    book += [("raw_gender", "1", None, None, "gender", 1, None, None), ("rcode", None, 1, 1, "r1r3", 1, None, 97),
             ("rcode", None, 1, 1, "r2r4", 1, None, 97), ("raw_racemars", "1", None, None, "rcode", 1, None, 97),
             ("raw_racemars", "1", None, None, "race_wht", 0, None, 97), ("raw_racemars", "1", None, None, "race_wht", None, "x", 97)]
    facts = spark.createDataFrame([(1, "530330000000001", 2.0, "30", "1", "1", None), (1, "530330000000002", 3.0, "30", "1", "1", None)],
                                  "etl_batch_id long, geo_id string, pop double, raw_agestr string, raw_gender string, raw_racemars string, raw_hispanic string")
    out = rollup_prefix(facts, log, spark.createDataFrame(book, RULE_SCHEMA))
    assert rows_of(out, "geo_id", "race_wht", "pop") == [("53033", 0, 5.0), ("53033", 0, 5.0)]


def test_hierarchy_keeps_scope_and_year_when_not_given(inputs, chosen):
    codes = block_codes(inputs["facts"], chosen)
    rolled = rollup_hierarchy(codes, inputs["areas"], {"census_year": "blk_census_year", "geo_id": "blk_geo_id"}, "hra_geo_id",
                              "hra", dimensions=CODE_DIMENSIONS)
    assert {r[0] for r in recode_rollup(rolled, inputs["rules"]).select("geo_scope").distinct().collect()} == {"kps"}
