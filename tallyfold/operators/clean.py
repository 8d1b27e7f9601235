"""From raw text cells to typed columns: roles, header rows, stamping, column alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyfold.functions.codes import county_fips, strip_cell
from tallyfold.operators.sizing import small_side
from tallyfold.schema import RAW_CELLS, STAMPED

# Words looked for in a header cell, the first hit decides.
HEADER_WORDS = [
    ("year", "year"),
    ("pop", "pop"),
    ("race", "raw_racemars"),
    ("gender", "raw_gender"),
    ("age", "raw_agestr"),
    ("hispanic", "raw_hispanic"),
]
# The same for column names of a frame; the file's geography word also means geo_id.
NAME_WORDS = [
    ("pop", "pop"),
    ("racemars", "raw_racemars"),
    ("age", "raw_agestr"),
    ("code", "geo_id"),
    ("gender", "raw_gender"),
    ("hispanic", "raw_hispanic"),
]
ROLES = ["year", "pop", "raw_racemars", "raw_gender", "raw_agestr", "raw_hispanic", "geo_id"]


def column_roles(headers: DataFrame) -> DataFrame:
    """Role of every header cell, as (file, position, role); a cell without a known word is the geography id."""
    cells = headers.unpivot("file", RAW_CELLS, "cell", "title")
    title = F.lower("title")
    role = F.lit("geo_id")
    for word, meaning in reversed(HEADER_WORDS):
        role = F.when(title.contains(word), F.lit(meaning)).otherwise(role)
    return cells.select("file", F.substring("cell", 4, 1).cast("int").alias("position"), role.alias("role"))


def roles_from_names(names, geo_word: str) -> dict[str, str]:
    """Role of every column name of a frame (lower-cased), for names that have one."""
    words = NAME_WORDS[:3] + [NAME_WORDS[3], (geo_word.lower(), "geo_id")] + NAME_WORDS[4:]
    found = {}
    for name in names:
        lowered = name.lower()
        found[name] = next((role for word, role in words if word and word in lowered), lowered)
    return found


def drop_header_rows(rows: DataFrame) -> DataFrame:
    """Leave out rows with "code" or "year" in their text and rows without a first cell."""
    text = F.lower(F.concat_ws("", *RAW_CELLS))
    return rows.where(~text.contains("code") & ~text.contains("year") & F.col("col1").isNotNull())


def strip_cells(rows: DataFrame) -> DataFrame:
    """Remove carriage returns and trailing blanks from all seven cells."""
    return rows.withColumns({c: strip_cell(c) for c in RAW_CELLS})


def project_roles(rows: DataFrame, roles: DataFrame, *, unreadable: str | None = None) -> DataFrame:
    """Turn cells into named columns, file by file; text that is not a number gives a null headcount.

    Roles are one small row per file. When a role occurs twice in a header the last column has it. A column
    named by ``unreadable`` keeps the text that is no number.
    """
    places = roles.groupBy("file").agg(
        *[F.max(F.when(F.col("role") == role, F.col("position"))).alias(f"_{role}") for role in ROLES])
    cells = F.array(*RAW_CELLS)
    found = {role: F.get(cells, F.col(f"_{role}") - 1) for role in ROLES}
    text = found["pop"]
    found["pop"] = text.try_cast("double")
    if unreadable is not None:
        found[unreadable] = F.when(found["pop"].isNull() & (F.trim(text) != ""), text)
    rest = [c for c in rows.columns if c not in RAW_CELLS]
    joined = rows.join(small_side(places), "file")
    return joined.select(*rest, *[value.alias(role) for role, value in found.items()])


def stamp_manifest(rows: DataFrame, manifest: DataFrame, *, on: str = "file", columns=None) -> DataFrame:
    """Write the constants of a file on its rows, replacing columns of the same name, and the county number.

    The county number is set where the scope is ``kps``.
    """
    constants = [c for c in (columns or ["etl_batch_id", *STAMPED]) if c in manifest.columns]
    side = small_side(manifest.select(on, *constants))
    stamped = rows.drop(*constants).join(side, on)
    return stamped.withColumn("fips_co", F.when(F.col("geo_scope") == "kps", county_fips("geo_id")))


def valid_facts(rows: DataFrame, batches=None, where: Column | str | None = None) -> DataFrame:
    """Rows with a batch id and a headcount, of the given batch ids, that meet an extra condition."""
    rows = rows.where(F.col("etl_batch_id").isNotNull() & F.col("pop").isNotNull())
    if batches is not None:
        rows = rows.where(F.col("etl_batch_id").isin(*batches))
    return rows if where is None else rows.where(where)


def align_columns(rows: DataFrame, target: T.StructType, *, add_missing: bool = False) -> DataFrame:
    """Columns that ``rows`` and ``target`` share, by name in any case, in the target's order and types.

    With ``add_missing`` the target's other columns are added as nulls. A value that does not fit raises.
    """
    present = {c.lower(): c for c in rows.columns}
    picked = []
    for field in target.fields:
        source = present.get(field.name.lower())
        if source is not None:
            picked.append(F.col(source).cast(field.dataType).alias(field.name))
        elif add_missing:
            picked.append(F.lit(None).cast(field.dataType).alias(field.name))
    return rows.select(*picked)


def route_by_scheme(rows: DataFrame, table: str, *, r_type: int = 77) -> dict[str, DataFrame]:
    """Split rows into the main table and the ``_77`` table by race scheme; a null scheme goes to the main one."""
    old = F.col("r_type").eqNullSafe(F.lit(r_type))
    return {table: rows.where(~old), f"{table}_{r_type}": rows.where(old)}


def scheme_table(table: str, r_type: int = 77) -> Column:
    """Name of the table that a row belongs to, for one write that is partitioned by it."""
    old = F.col("r_type").eqNullSafe(F.lit(r_type))
    return F.when(old, F.lit(f"{table}_{r_type}")).otherwise(F.lit(table))
