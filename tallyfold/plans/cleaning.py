"""Cleaning of one raw frame in one go, with the last-match cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.functions.codes import county_fips, pad_code, parse_age, zero_fill
from tallyfold.operators.clean import roles_from_names
from tallyfold.operators.recode import attach_area, recode_cascade
from tallyfold.schema import COUNTIES
from tallyfold.sources.raw import name_prefix


def clean_frame(rows: DataFrame, info: dict, rules: DataFrame, areas: DataFrame, *, etl_batch_id: int = 0) -> DataFrame:
    """Rename by column name, cut to scope, stamp, pad, recode, zero-fill and attach small areas.

    ``info`` states file_name, geo_type, geo_scope, geo_year, census_year and r_type. Only block rows have a
    county number, so a ``kps`` scope on another type leaves no rows. Small areas are attached after the
    zero fill and stay null without a match. With a batch id the rows also get a unique ``id``.
    """
    roles = roles_from_names(rows.columns, name_prefix(info["file_name"]))
    out = rows.select(*[F.col(name).alias(role) for name, role in roles.items()])
    out = out.withColumn("geo_id", F.col("geo_id").cast("string"))
    fips = county_fips("geo_id") if info["geo_type"] == "blk" else F.lit(None).cast("string")
    out = out.withColumn("fips_co", fips)
    if info["geo_scope"] == "kps":
        out = out.where(F.col("fips_co").isin(*COUNTIES))
    constants = {c: F.lit(info[c]) for c in ("geo_type", "geo_scope", "geo_year", "census_year")}
    out = out.withColumns({
        **constants,
        "r_type": F.lit(info["r_type"]).cast("smallint"),
        "year": F.col("year").cast("string"),
        "raw_agestr": F.substring(F.col("raw_agestr").cast("string"), 1, 3),
        "raw_gender": F.col("raw_gender").cast("string"),
        "raw_hispanic": F.col("raw_hispanic").cast("string"),
    })
    out = out.withColumn("raw_racemars", pad_code(F.col("raw_racemars").cast("string"), "r_type"))
    out = out.withColumn("age", parse_age("raw_agestr"))
    out = zero_fill(recode_cascade(out, rules, policy="last"), every=True)
    if info["geo_type"] == "blk":
        out = attach_area(out, areas, info["geo_year"])
    if etl_batch_id > 0:
        out = out.withColumns({"etl_batch_id": F.lit(etl_batch_id), "id": F.monotonically_increasing_id() + 1})
    return out
