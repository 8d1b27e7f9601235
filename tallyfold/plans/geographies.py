"""The thirteen geography tables from facts, log, rules and geography crosswalks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.operators.geo import (
    CODE_DIMENSIONS, allocate, block_codes, block_crosswalk, block_table, geo_direct, recode_counties, recode_rollup,
    rollup_blocks, rollup_hierarchy,
)
from tallyfold.operators.log import latest_batches
from tallyfold.operators.recode import code_book
from tallyfold.schema import GEO_COLUMNS, TARGET_TYPES
from tallyfold.sources.store import Buckets, copy_and_verify, use_checkpoints, write_table

BUCKETS = 64  # of the block table and the crosswalk; more for larger blocks tables
_DIRECT = ("blk", "lgd", "scd", "zip")


def area_tables(facts: DataFrame, chosen: DataFrame, rules, areas: DataFrame, regions: DataFrame):
    """Small-area and region tables of the chosen block batches."""
    codes = block_codes(facts, chosen)
    rolled = rollup_hierarchy(codes, areas, {"census_year": "blk_census_year", "geo_id": "blk_geo_id"}, "hra_geo_id",
                              "hra", parent_year="hra_census_year", geo_scope="kc", dimensions=CODE_DIMENSIONS)
    hra = recode_rollup(rolled, rules)
    return hra, region_table(hra, regions)


def region_table(hra: DataFrame, regions: DataFrame) -> DataFrame:
    """Region table summed from the small-area table."""
    reg = rollup_hierarchy(hra, regions, {"geo_year": "census_year", "geo_id": "hra_geo_id"}, "reg_geo_id", "reg")
    return reg.select(*GEO_COLUMNS)


def target_tables(facts: DataFrame, chosen: DataFrame, rules, weights: DataFrame, targets=None) -> DataFrame:
    """All proportionally allocated tables in one frame, told apart by ``geo_type``."""
    return recode_rollup(allocate(block_codes(facts, chosen), weights, targets, dimensions=CODE_DIMENSIONS), rules)


def run_geographies(spark: SparkSession, out: str, *, facts: DataFrame, log: DataFrame, rules: DataFrame,
                    areas: DataFrame, regions: DataFrame, weights: DataFrame, census_year: str = "2020",
                    geo_year: str = "2020", copy_to: str | None = None, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """Write all geography tables below ``out`` and return them by name.

    The choice of batches and the code book are made once. Facts partitioned by batch are read once per direct table,
    each reading only its own batches, and once for all rollups of blocks: those sum a slim block table that is bucketed
    like the crosswalk of its blocks, so they meet without a shuffle. Areas and weights of blocks that it does not have are
    left out before they are shuffled.

    With ``copy_to`` all thirteen tables are copied there and compared with what was read; ``copied`` below it holds a
    PASS or FAIL row for each. A copy that differs raises after all are done.
    """
    use_checkpoints(spark)
    chosen = latest_batches(log, census_year=census_year, geo_year=geo_year).checkpoint()
    book = code_book(rules)
    for geo_type in _DIRECT:
        write_table(geo_direct(facts, chosen, book, geo_type), f"{out}/pop_geo_{geo_type}")
    with Buckets(spark, f"{out}/buckets", "geo_id", buckets) as kept:
        blocks = kept.keep(block_table(facts, chosen), "blocks")
        crosswalk = kept.keep(block_crosswalk(areas, weights, TARGET_TYPES, blocks), "crosswalk")
        write_table(rollup_blocks(blocks, crosswalk), f"{out}/sums", partition_by=["geo_type"])
    sums = spark.read.parquet(f"{out}/sums")
    write_table(recode_counties(sums.where("geo_type = 'cou'"), book), f"{out}/pop_geo_cou")
    write_table(recode_rollup(sums.where("geo_type = 'hra'"), book), f"{out}/pop_geo_hra")
    write_table(region_table(spark.read.parquet(f"{out}/pop_geo_hra"), regions), f"{out}/pop_geo_reg")
    shares = recode_rollup(sums.where(F.col("geo_type").isin(*TARGET_TYPES)), book)
    write_table(shares, f"{out}/targets", partition_by=["geo_type"])

    tables = {f"pop_geo_{t}": spark.read.parquet(f"{out}/pop_geo_{t}") for t in (*_DIRECT, "cou", "hra", "reg")}
    targets = spark.read.schema(shares.schema).parquet(f"{out}/targets")
    tables |= {f"pop_geo_{t}": targets.where(F.col("geo_type") == t).select(*GEO_COLUMNS) for t in TARGET_TYPES}
    if copy_to is not None:
        copy_geographies(spark, tables, copy_to)
    return tables


def copy_geographies(spark: SparkSession, tables: dict[str, DataFrame], copy_to: str) -> DataFrame:
    """Copy the tables below ``copy_to`` and return, and keep in ``copied`` there, how each one went. A bad copy raises."""
    write_table(copy_and_verify(spark, tables, copy_to), f"{copy_to}/copied")
    told = spark.read.parquet(f"{copy_to}/copied")
    bad = told.where("status <> 'PASS'").select("table_name").collect()
    if bad:
        raise RuntimeError(f"copies differ: {sorted(r.table_name for r in bad)}")
    return told
