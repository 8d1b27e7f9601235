"""Geography slices and raw-code clean-up, all as JVM-side column expressions."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyfold.schema import COUNTIES, RACE_FLAGS


def county_code(geo_id) -> Column:
    """State and county part of a block id."""
    return F.substring(geo_id, 1, 5)


def tract_code(geo_id) -> Column:
    return F.substring(geo_id, 1, 11)


def block_group_code(geo_id) -> Column:
    return F.substring(geo_id, 1, 12)


def county_fips(geo_id) -> Column:
    """Two-character county number. Text, so that odd ids never raise on a numeric cast."""
    return F.substring(geo_id, 4, 2)


def geo_parts(rows: DataFrame, geo_id: str = "geo_id") -> DataFrame:
    """Add the county, tract and block-group codes and the county number of a block id."""
    return rows.withColumns({
        "geo_id_county": county_code(geo_id),
        "geo_id_tract": tract_code(geo_id),
        "geo_id_blkgrp": block_group_code(geo_id),
        "fips_co": county_fips(geo_id),
    })


def parse_age(raw_age) -> Column:
    """Age from the first three characters; text that is not a number gives null."""
    return F.substring(raw_age, 1, 3).try_cast("smallint")


def top_code(age, top: int = 100) -> Column:
    """Ages above ``top`` become ``top``; a null age stays null (``least`` would hide it)."""
    age = F.col(age) if isinstance(age, str) else age
    return F.when(age > top, F.lit(top).cast("smallint")).otherwise(age)


def pad_code(code, r_type, width: int = 5, scheme: int = 97) -> Column:
    """Zero-pad codes of one race scheme. Longer codes are kept whole, which ``lpad`` would not do."""
    code = F.col(code) if isinstance(code, str) else code
    r_type = F.col(r_type) if isinstance(r_type, str) else r_type
    short = F.length(code) < width
    return F.when((r_type == scheme) & short, F.lpad(code, width, "0")).otherwise(code)


def strip_cell(cell) -> Column:
    """Remove carriage returns, then trailing blanks."""
    return F.rtrim(F.replace(F.col(cell) if isinstance(cell, str) else cell, F.lit("\r"), F.lit("")))


def zero_fill(rows: DataFrame, columns=None, *, every: bool = False) -> DataFrame:
    """Null to 0 in ``columns`` (the race flags by default) or, with ``every``, in all columns."""
    names = rows.columns if every else (columns or RACE_FLAGS)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    filled = {}
    for name in names:
        if isinstance(kinds[name], T.StringType):
            filled[name] = F.coalesce(F.col(name), F.lit("0"))
        elif isinstance(kinds[name], T.NumericType):
            filled[name] = F.coalesce(F.col(name), F.lit(0).cast(kinds[name]))
    return rows.withColumns(filled)


def scope_filter(rows: DataFrame, geo_id: str = "geo_id", counties=COUNTIES, scope_column: str | None = None,
                 scope: str = "kps") -> DataFrame:
    """Keep rows of the given counties; with ``scope_column`` only rows of that scope are tested."""
    inside = county_fips(geo_id).isin(*counties)
    if scope_column is None:
        return rows.where(inside)
    out_of_scope = ~F.col(scope_column).eqNullSafe(F.lit(scope))
    return rows.where(out_of_scope | inside)
