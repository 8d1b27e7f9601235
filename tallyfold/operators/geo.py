"""Geography tables: direct, by code prefix, by hierarchy and by proportional allocation."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tallyfold.functions.codes import block_group_code, county_code, county_fips, scope_filter, tract_code
from tallyfold.operators.recode import CodeBook, code_book, fill_defaults, recode_facts
from tallyfold.operators.sizing import narrowed, small_side
from tallyfold.schema import COUNTIES, DIMENSIONS, GEO_COLUMNS, RAW_CODES

_FILE = ["etl_batch_id", "geo_scope", "geo_year", "census_year", "year", "r_type"]
_SUMMED = ["etl_batch_id", "census_year", "year", "r_type"]
_FLAT = [c for c in GEO_COLUMNS if c != "fips_co"]
_BLOCK = [*GEO_COLUMNS[:8], "geo_id_tract", "geo_id_blkgrp", *GEO_COLUMNS[8:]]


def select_facts(facts: DataFrame, chosen: DataFrame, geo_type: str) -> DataFrame:
    """Facts of the chosen log rows of one geography type, carrying the file constants of the log.

    Only the columns the rollups need are read. When few batches are chosen the log side is broadcast, and
    on facts partitioned by batch the scan is pruned at run time to the partitions of those batches. When many
    are chosen the facts are narrowed to about those of their batches before they are shuffled.
    """
    log = chosen.where(F.col("geo_type") == geo_type).select(F.col("id").alias("etl_batch_id"), *_FILE[1:])
    narrow = facts.select("etl_batch_id", "geo_id", "pop", *RAW_CODES)
    side = small_side(log)
    if side is log:
        narrow = narrowed(narrow, log, "etl_batch_id")
    return narrow.join(side, "etl_batch_id")


def geo_direct(facts: DataFrame, chosen: DataFrame, rules: DataFrame | CodeBook, geo_type: str) -> DataFrame:
    """Recoded rows of one directly loaded geography type.

    Block rows are limited to the three counties and get tract and block-group codes, and the county number
    where the scope is ``kps``; the other types have no county number.
    """
    rows = select_facts(facts, chosen, geo_type)
    if geo_type == "blk":
        rows = scope_filter(rows)
    rows = recode_facts(rows, rules).withColumn("geo_type", F.lit(geo_type))
    if geo_type != "blk":
        return rows.select(*_FLAT)
    rows = rows.withColumns({
        "geo_id_tract": tract_code("geo_id"),
        "geo_id_blkgrp": block_group_code("geo_id"),
        "fips_co": _block_fips(),
    })
    return rows.select(*_BLOCK)


def _block_fips():
    return F.when(F.col("geo_scope") == "kps", county_fips("geo_id"))


def rollup_prefix(facts: DataFrame, chosen: DataFrame, rules: DataFrame | CodeBook) -> DataFrame:
    """County table: block facts of every county summed by the five-character prefix of the block id.

    The facts are summed by their raw codes first and recoded after that, so the one shuffle moves narrow
    partial sums and the recode touches only result rows. Groups follow the rule values before defaults:
    two rows may look alike when a rule says 0 and a missing rule is shown as 0.
    """
    book = rules if isinstance(rules, CodeBook) else code_book(rules)
    rows = select_facts(facts, chosen, "blk").withColumn("geo_id", county_code("geo_id"))
    keys = [c for c in _FILE if c != "geo_scope"] + ["geo_id", *RAW_CODES]
    rows = recode_facts(_total(rows, keys), book, defaults=False)
    if book.fans_out:
        rows = _total(rows, [c for c in rows.columns if c != "pop"])
    rows = fill_defaults(rows).withColumns({
        "geo_type": F.lit("cou"),
        "geo_scope": F.lit("wa"),
        "fips_co": F.lit(None).cast("string"),
    })
    return rows.select(*GEO_COLUMNS)


def rollup_hierarchy(rows: DataFrame, parents: DataFrame, on: dict[str, str], parent_id: str, geo_type: str, *,
                     parent_year: str | None = None, geo_scope: str | None = None,
                     dimensions=tuple(DIMENSIONS)) -> DataFrame:
    """Sum rows into their parent areas.

    ``on`` maps columns of ``rows`` to columns of ``parents``; by the last one, the area, many parents are narrowed to those
    of the rows. ``parent_year`` names the parent column that
    becomes ``geo_year`` and ``geo_scope`` a fixed scope; without them both are kept from the rows.
    """
    needed = dict.fromkeys([*on.values(), parent_id, *filter(None, [parent_year])])
    lookup = parents.select(*[F.col(c).alias(f"_{c}") for c in needed])
    match = [rows[left] == F.col(f"_{right}") for left, right in on.items()]
    year = F.col(f"_{parent_year}") if parent_year else F.col("geo_year")
    scope = [] if geo_scope else ["geo_scope"]
    side = small_side(lookup)
    if side is lookup:
        left, right = next(reversed(on.items()))
        side = narrowed(lookup, rows.select(F.col(left).alias(f"_{right}")), f"_{right}")
    joined = rows.join(side, match)
    joined = joined.select(*_SUMMED, year.alias("geo_year"), *scope, F.col(f"_{parent_id}").alias("geo_id"),
                           *dimensions, "pop")
    summed = _total(joined, [c for c in joined.columns if c != "pop"])
    # Constants come after the sum: as grouping keys they would hide that a later sum needs no shuffle.
    fixed = {"geo_type": F.lit(geo_type)} | ({"geo_scope": F.lit(geo_scope)} if geo_scope else {})
    summed = summed.withColumns(fixed)
    return summed.select(*_ordered(summed, dimensions))


def allocate(rows: DataFrame, weights: DataFrame, targets=None, *, geo_scope: str = "kc",
             dimensions=tuple(DIMENSIONS)) -> DataFrame:
    """Share block headcounts out to target areas by the proportion of each block that lies in them.

    All target types are done in one join and one sum; ``geo_type`` is the target type. Proportions need not
    add up to 1, and blocks without a target vanish. Many weights are narrowed to about those of the blocks in ``rows``
    before they are shuffled.
    """
    if targets is not None:
        weights = weights.where(F.col("target_type").isin(*targets))
    keys = ["census_year", "geo_year", "geo_id"]
    weights = weights.select(*keys, "target_type", "target_id", "proportion")
    side = small_side(weights)
    if side is weights:
        side = narrowed(weights, rows, "geo_id")
    joined = rows.join(side, keys)
    joined = joined.select(*_SUMMED, "geo_year", F.col("target_type").alias("geo_type"),
                           F.col("target_id").alias("geo_id"), *dimensions,
                           (F.col("pop") * F.col("proportion")).alias("pop"))
    summed = _total(joined, [c for c in joined.columns if c != "pop"]).withColumn("geo_scope", F.lit(geo_scope))
    return summed.select(*_ordered(summed, dimensions))


def block_codes(facts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Block facts before recoding, ready for a rollup by raw code (see ``recode_rollup``)."""
    return scope_filter(select_facts(facts, chosen, "blk")).withColumn("fips_co", _block_fips())


def block_table(facts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Block facts of the chosen batches summed per block and raw codes: what every rollup of blocks reads."""
    rows = select_facts(facts, chosen, "blk")
    return _total(rows, [c for c in rows.columns if c != "pop"])


def block_crosswalk(areas: DataFrame, weights: DataFrame, targets=None, blocks: DataFrame | None = None) -> DataFrame:
    """(geo_id, areas, targets): one row for each block with all small areas and weighted targets that it belongs to.

    With ``blocks`` (column ``geo_id``) those of other blocks are left out before they are shuffled, but for a few.
    """
    if targets is not None:
        weights = weights.where(F.col("target_type").isin(*targets))
    areas = areas.withColumnRenamed("blk_geo_id", "geo_id")
    if blocks is not None:
        areas, weights = narrowed(areas, blocks, "geo_id"), narrowed(weights, blocks, "geo_id")
    small = areas.groupBy("geo_id").agg(
        F.collect_list(F.struct("blk_census_year", "hra_census_year", "hra_geo_id")).alias("areas"))
    shares = weights.groupBy("geo_id").agg(
        F.collect_list(F.struct("census_year", "geo_year", "target_type", "target_id", "proportion")).alias("targets"))
    return small.join(shares, "geo_id", "full")


def rollup_blocks(blocks: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Sums by raw code of counties, small areas and targets, told apart by ``geo_type``, in one pass over the blocks.

    ``blocks`` is a ``block_table`` and ``crosswalk`` a ``block_crosswalk``. Where both are bucketed by ``geo_id`` their
    join needs no shuffle; the sum is the only one. Counties take all blocks, the others those of the three counties.
    """
    joined = blocks.join(crosswalk, "geo_id", "left")
    inside = county_fips("geo_id").isin(*COUNTIES)
    no_share = F.lit(None).cast(crosswalk.schema["targets"].dataType.elementType["proportion"].dataType)

    def entry(geo_type, geo_id, geo_year, scope, share, fips):
        return F.struct(geo_type.alias("geo_type"), geo_id.alias("geo_id"), geo_year.alias("geo_year"), scope.alias("geo_scope"),
                        share.alias("share"), fips.alias("fips_co"))

    county = F.array(entry(F.lit("cou"), county_code("geo_id"), F.col("geo_year"), F.lit("wa"), no_share, F.lit(None).cast("string")))
    small = F.transform(
        F.filter("areas", lambda a: inside & (a["blk_census_year"] == F.col("census_year"))),
        lambda a: entry(F.lit("hra"), a["hra_geo_id"], a["hra_census_year"], F.lit("kc"), no_share, _block_fips()))
    shared = F.transform(
        F.filter("targets", lambda t: inside & (t["census_year"] == F.col("census_year")) & (t["geo_year"] == F.col("geo_year"))),
        lambda t: entry(t["target_type"], t["target_id"], t["geo_year"], F.lit("kc"), t["proportion"], _block_fips()))
    nothing = F.array().cast(T.ArrayType(blocks.select(county[0]).schema[0].dataType))
    every = F.concat(county, F.coalesce(small, nothing), F.coalesce(shared, nothing))
    rows = joined.select(*_SUMMED, *RAW_CODES, "pop", F.explode(every).alias("at")).select(*_SUMMED, *RAW_CODES, "pop", "at.*")
    part = F.when(F.col("share").isNull(), F.col("pop")).otherwise(F.col("pop") * F.col("share"))
    rows = rows.withColumn("pop", part).drop("share")
    return _total(rows, [c for c in rows.columns if c != "pop"])


def recode_counties(sums: DataFrame, rules: DataFrame | CodeBook) -> DataFrame:
    """County rows from sums by raw code; groups follow the rule values before defaults, see ``rollup_prefix``."""
    book = rules if isinstance(rules, CodeBook) else code_book(rules)
    rows = recode_facts(sums, book, defaults=False)
    if book.fans_out:
        rows = _total(rows, [c for c in rows.columns if c != "pop"])
    return fill_defaults(rows).select(*GEO_COLUMNS)


CODE_DIMENSIONS = ("fips_co", *RAW_CODES)


def recode_rollup(rolled: DataFrame, rules: DataFrame | CodeBook) -> DataFrame:
    """Recode a rollup that was summed by raw code.

    All analysis columns follow from the raw codes, which are part of every rollup key, so rolling up
    ``block_codes`` with ``dimensions=CODE_DIMENSIONS`` and recoding the sums gives the same table as rolling
    up recoded rows, with a shuffle of narrow rows. Only a rule table with overlapping rules needs a second sum.
    """
    book = rules if isinstance(rules, CodeBook) else code_book(rules)
    rows = recode_facts(rolled, book)
    if book.fans_out:
        rows = _total(rows, [c for c in rows.columns if c != "pop"])
    return rows.select(*GEO_COLUMNS)


def _total(rows: DataFrame, keys) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("pop").alias("pop"))


def _ordered(rows: DataFrame, dimensions):
    return [c for c in GEO_COLUMNS if c in rows.columns] + [c for c in dimensions if c not in GEO_COLUMNS]
