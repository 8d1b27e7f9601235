"""Headcount-shaped inputs derived from the driver tables.

Each shape is one SQL text that Spark and the SQL check both run, so both sides see the same input. Table
names stand in braces. Flags are spread over rows by key arithmetic; no shape leaves rows of its table out.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfold.schema import RULE_SCHEMA, TARGET_TYPES

# --- log: one row per order -----------------------------------------------------------------------

_TYPE = """CASE o_orderstatus WHEN 'F' THEN 'blk' WHEN 'P' THEN 'zip'
            ELSE CASE WHEN o_custkey % 2 = 0 THEN 'scd' ELSE 'lgd' END END"""
_WORD = """CASE o_orderstatus WHEN 'F' THEN 'BlockCode' WHEN 'P' THEN 'zip'
            ELSE CASE WHEN o_custkey % 2 = 0 THEN 'SchoolDist' ELSE 'LegDistCode' END END"""
_GEO_YEAR = "CASE WHEN o_custkey % 5 = 0 THEN '2010' ELSE '2020' END"
_SCHEME = "CASE WHEN o_orderpriority LIKE '1%' THEN 77 ELSE 97 END"
_DATE = "CAST(date_trunc('quarter', o_orderdate) AS DATE)"
_YEAR = "CAST(year(o_orderdate) AS STRING)"
_BATCH = f"""CAST(year(o_orderdate) AS STRING) || CASE WHEN o_custkey % 3 = 0 THEN 'final'
            ELSE lpad(CAST(month({_DATE}) AS STRING), 2, '0') || '01census2020' END"""

LOG = f"""
SELECT o_orderkey AS id,
       {_BATCH} AS batch_name,
       {_DATE} AS batch_date,
       {_WORD} || {_GEO_YEAR} || 'RaceMars' || CAST({_SCHEME} AS STRING) || {_YEAR} || '.csv.gz' AS file_name,
       CASE WHEN o_custkey % 17 = 0 THEN 'ref' ELSE
         'https://store/pop/' || {_BATCH} || '/csv_' || {_YEAR} || '/' || CAST(o_custkey AS STRING) || '/' END AS file_loc,
       {_TYPE} AS geo_type,
       CASE WHEN o_orderstatus = 'F' THEN 'kps' WHEN o_custkey % 10 = 3 THEN NULL ELSE 'wa' END AS geo_scope,
       {_GEO_YEAR} AS geo_year,
       CASE WHEN o_custkey % 11 = 0 THEN '2010' ELSE '2020' END AS census_year,
       {_YEAR} AS year,
       CAST({_SCHEME} AS SMALLINT) AS r_type,
       o_custkey % 1000 AS qa_rows_file,
       o_totalprice AS qa_pop_file,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS load_ref_datetime,
       CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate END AS delete_ref_datetime,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS load_archive_datetime,
       CASE WHEN o_orderkey % 30 = 0 THEN o_orderdate END AS delete_archive_datetime,
       o_orderdate AS last_update_datetime,
       CASE WHEN o_orderkey % 4 = 0 THEN 'received;' END AS etl_notes
FROM {{orders}}
"""

# Versions: every customer and order status is a series with the order dates as its versions.
VERSIONS = f"""
SELECT o_orderkey AS id,
       CAST(year(o_orderdate) AS STRING) || 'v' || CAST(o_orderkey AS STRING) AS batch_name,
       {_WORD} || '2020RaceMars' || CAST({_SCHEME} AS STRING) || {_YEAR} || '.csv.gz' AS file_name,
       '/pop/' || CAST(o_custkey AS STRING) || '/' AS file_loc,
       CAST(o_orderdate AS DATE) AS batch_date,
       {_TYPE} AS geo_type,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 6 = 0 THEN 'kps' ELSE 'wa' END AS geo_scope,
       CAST(o_custkey AS STRING) AS geo_year,
       '2020' AS census_year,
       CASE WHEN o_orderkey % 5 = 0 THEN '2019' ELSE '2020' END AS year,
       CAST({_SCHEME} AS SMALLINT) AS r_type,
       CAST(0 AS BIGINT) AS qa_rows_file,
       CAST(0 AS DOUBLE) AS qa_pop_file,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS load_ref_datetime,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS load_archive_datetime,
       CASE WHEN o_orderkey % 30 = 0 THEN o_orderdate END AS delete_archive_datetime,
       o_orderdate AS last_update_datetime,
       CAST(NULL AS STRING) AS etl_notes
FROM {{orders}}
"""

# Incoming files: one per order and line status. F files are known to the log, O files are new.
INCOMING = """
SELECT v.batch_name || CASE WHEN l.l_linestatus = 'F' THEN '' ELSE 'revised' END AS batch_name,
       v.batch_date AS batch_date, v.file_name AS file_name, v.file_loc || CASE WHEN l.l_linestatus = 'F' THEN '' ELSE 'csv/' END AS file_loc, v.geo_type AS geo_type,
       v.geo_scope AS geo_scope, v.geo_year AS geo_year, v.census_year AS census_year, v.year AS year, v.r_type AS r_type,
       l.rows_file AS rows_file, l.pop_file AS pop_file
FROM (SELECT l_orderkey, l_linestatus, COUNT(*) AS rows_file,
             CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS pop_file
      FROM {lineitem} GROUP BY l_orderkey, l_linestatus) l
JOIN ({versions}) v ON l.l_orderkey = v.id
"""

# --- facts: one row per line ----------------------------------------------------------------------

GEO_ID = """'53' || CASE l_suppkey % 4 WHEN 0 THEN '033' WHEN 1 THEN '053' WHEN 2 THEN '061' ELSE '077' END
         || lpad(CAST(l_suppkey AS STRING), 6, '0') || lpad(CAST(l_partkey % 10000 AS STRING), 4, '0')"""
_AGE = "lpad(CAST(CAST(l_quantity * 2 + l_linenumber AS INT) AS STRING), 3, '0')"
_RACE = """CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN '10000' WHEN l_returnflag = 'A' AND l_linenumber = 2
            THEN '01000' WHEN l_returnflag = 'A' THEN '00100' WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN '00010'
            WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN '00001' WHEN l_returnflag = 'N' THEN '11000'
            WHEN l_linenumber = 7 THEN '99999' ELSE '10100' END"""

FACTS = f"""
SELECT l_orderkey AS etl_batch_id,
       {GEO_ID} AS geo_id,
       CASE WHEN l_partkey % 97 = 0 THEN '85+' WHEN l_partkey % 89 = 0 THEN {_AGE} || ' yrs' ELSE {_AGE} END AS raw_agestr,
       CASE WHEN l_linestatus = 'F' THEN '2' ELSE '1' END AS raw_gender,
       {_RACE} AS raw_racemars,
       CASE WHEN l_suppkey % 37 = 0 THEN NULL WHEN l_suppkey % 2 = 0 THEN '0' ELSE '1' END AS raw_hispanic,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS pop
FROM {{lineitem}}
"""

# Facts with the constants of their file, as after stamping: a coarse batch per ship year and status.
STAMPED = f"""
SELECT year(l_shipdate) * 10 + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS etl_batch_id,
       CASE WHEN l_returnflag = 'R' THEN 'zip' ELSE 'blk' END AS geo_type,
       CASE WHEN l_returnflag = 'R' THEN 'wa' ELSE 'kps' END AS geo_scope,
       CASE WHEN l_suppkey % 5 = 0 THEN '2010' ELSE '2020' END AS geo_year,
       '2020' AS census_year,
       CAST(year(l_shipdate) AS STRING) AS year,
       CAST(CASE WHEN l_linenumber = 7 THEN 77 ELSE 97 END AS SMALLINT) AS r_type,
       {GEO_ID} AS geo_id,
       {_AGE} AS raw_agestr,
       CASE WHEN l_linestatus = 'F' THEN '2' ELSE '1' END AS raw_gender,
       CASE WHEN l_returnflag = 'A' THEN '1000' WHEN l_returnflag = 'N' THEN '1' ELSE '101001' END AS raw_racemars,
       CASE WHEN l_suppkey % 2 = 0 THEN '0' ELSE '1' END AS raw_hispanic,
       CASE WHEN l_discount >= 0.095 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS pop
FROM {{lineitem}}
"""

# --- geography crosswalks -------------------------------------------------------------------------

BLOCKS = f"SELECT DISTINCT l_suppkey, {GEO_ID} AS geo_id FROM {{lineitem}}"

AREAS = f"""
SELECT CASE WHEN b.l_suppkey % 9 = 0 THEN '2010' ELSE '2020' END AS blk_census_year, b.geo_id AS blk_geo_id,
       '2020' AS hra_census_year, 'H' || CAST(s.s_nationkey AS STRING) AS hra_geo_id
FROM ({BLOCKS}) b JOIN {{supplier}} s ON b.l_suppkey = s.s_suppkey
"""

OLD_AREAS = f"""
SELECT CASE WHEN b.l_suppkey % 3 = 0 THEN '2010' ELSE '2020' END AS geo_year, b.geo_id AS blk_geo_id,
       'H' || CAST(s.s_nationkey AS STRING) AS hra_id
FROM ({BLOCKS}) b JOIN {{supplier}} s ON b.l_suppkey = s.s_suppkey
"""

REGIONS = """
SELECT '2020' AS census_year, 'H' || CAST(n.n_nationkey AS STRING) AS hra_geo_id, 'R-' || r.r_name AS reg_geo_id
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# Two targets of each type per block. Shares of the last type add up to less than 1.
_SHARES = [(kind, part, share)
           for i, kind in enumerate(TARGET_TYPES)
           for part, share in ((0, "0.60"), (1, "0.30" if i == len(TARGET_TYPES) - 1 else "0.40"))]
_SHARE_ROWS = ", ".join(f"('{kind}', {part}, CAST({share} AS DECIMAL(3,2)))" for kind, part, share in _SHARES)
_WEIGHT_COLUMNS = """'2020' AS geo_year, '2020' AS census_year, b.geo_id AS geo_id, t.target_type AS target_type,
       t.target_type || CAST((b.l_suppkey + t.part) % 10 AS STRING) AS target_id, t.share AS proportion"""
_WEIGHTS_SQL = f"""
SELECT {_WEIGHT_COLUMNS}
FROM ({BLOCKS}) b CROSS JOIN (VALUES {_SHARE_ROWS}) AS t(target_type, part, share)
"""
_STRUCTS = ", ".join(f"named_struct('target_type', '{kind}', 'part', {part}, 'share', CAST({share} AS DECIMAL(3,2)))"
                     for kind, part, share in _SHARES)
_WEIGHTS_SPARK = f"""
SELECT {_WEIGHT_COLUMNS}
FROM (SELECT l_suppkey, geo_id, explode(array({_STRUCTS})) AS t FROM ({BLOCKS})) b
""".replace("t.target_type", "b.t.target_type").replace("t.part", "b.t.part").replace("t.share", "b.t.share")

# --- file names -----------------------------------------------------------------------------------

# One file per order line, in folders by ship year; some names lack the ending or the scheme word.
FILES = """
SELECT l_orderkey, l_linenumber, l_partkey,
       '/data/extract/' || CAST(year(l_shipdate) AS STRING) || '0715final/csv_' || CAST(year(l_shipdate) AS STRING) || '/'
       || CASE WHEN l_partkey % 6 = 0 THEN CAST(year(l_shipdate) AS STRING) || '0715final/' ELSE '' END
       || CASE l_linenumber WHEN 1 THEN 'BlockCode' WHEN 2 THEN 'zip' WHEN 3 THEN 'SchoolDist' WHEN 4 THEN 'LegDistCode'
               WHEN 5 THEN 'County' WHEN 6 THEN 'TRACTCODE' ELSE 'Ward' END
       || CASE WHEN l_partkey % 2 = 0 THEN '2020' ELSE '2010' END
       || CASE WHEN l_partkey % 19 = 0 THEN 'Race' ELSE 'RaceMars' END
       || CASE WHEN l_linestatus = 'F' THEN '97' ELSE '77' END || CAST(year(l_shipdate) AS STRING)
       || CASE WHEN l_returnflag = 'R' THEN '.csv' ELSE '.CSV.gz' END AS file_path
FROM {lineitem}
"""

# --- rules ----------------------------------------------------------------------------------------


def rule_rows(*, overlap: bool) -> list[tuple]:
    """Code book rows. With ``overlap`` two rules share a value in three recodes, so joins fan out."""
    rows = []

    def add(old, new, num, *, txt=None, lo=None, hi=None, text=None, r_type=None):
        rows.append((old, txt, lo, hi, new, num, text, r_type))

    for i in range(18):
        add("age", "age_5", i + 1, lo=i * 5, hi=i * 5 + 4 if i < 17 else 120)
    for i, lo in enumerate([0, 1, 5, 15, 25, 35, 45, 55, 65, 75, 85]):
        add("age", "age_11", i + 1, lo=lo, hi=[0, 4, 14, 24, 34, 44, 54, 64, 74, 84, 120][i])
    # No rule for 41 and 42: such ages are dropped by the join and stay null in a cascade.
    for i, (lo, hi) in enumerate([(0, 17), (18, 40), (43, 64), (65, 120)]):
        add("age", "age_20", i + 1, lo=lo, hi=hi)
    if overlap:
        add("age", "age_20", 5, lo=60, hi=69)
    add("raw_gender", "gender", 1, txt="1")
    add("raw_gender", "gender", 2, txt="2")
    codes = ["10000", "01000", "00100", "00010", "00001", "11000", "10100"]
    for scheme in (77, 97):
        for i, code in enumerate(codes):
            add("raw_racemars", "rcode", i + 1 + (10 if scheme == 77 else 0), txt=code, r_type=scheme)
            for j, flag in enumerate(["race_wht", "race_blk", "race_aian", "race_as", "race_nhpi"]):
                if code[j] == "1":
                    add("raw_racemars", flag, 1, txt=code, r_type=scheme)
        base = 10 if scheme == 77 else 0
        add("rcode", "r1r3", 1, lo=base + 1, hi=base + 1, r_type=scheme)
        add("rcode", "r1r3", 2, lo=base + 2, hi=base + 5, r_type=scheme)
        add("rcode", "r1r3", 3, lo=base + 6, hi=base + 9, r_type=scheme)
        for i in range(5):
            add("rcode", "r2r4", i + 1, lo=base + i + 1, hi=base + i + 1, r_type=scheme)
        add("rcode", "r2r4", 7, lo=base + 6, hi=base + 9, r_type=scheme)
    add("raw_hispanic", "r2r4", 6, txt="1", r_type=97)
    add("raw_hispanic", "race_hisp", 1, txt="1")
    add("raw_hispanic", "race_hisp", 0, txt="0")
    if overlap:
        add("rcode", "r2r4", 8, lo=0, hi=2, r_type=97)
        add("raw_racemars", "race_wht", 0, txt="11000", lo=0, hi=0, r_type=97)
    return rows


@cache
def _rule_values(overlap: bool) -> str:
    def literal(value):
        return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)
    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rule_rows(overlap=overlap))


def rules_sql(overlap: bool = True) -> str:
    names = [f.name for f in RULE_SCHEMA.fields]
    kinds = {"r_type": "SMALLINT"} | {n: "INTEGER" for n in names if "_num" in n}
    columns = ", ".join(f"CAST({n} AS {kinds.get(n, 'STRING')}) AS {n}" for n in names)
    return f"SELECT {columns} FROM (VALUES {_rule_values(overlap)}) AS r({', '.join(names)})"


def rules(spark: SparkSession, overlap: bool = True) -> DataFrame:
    columns = list(zip(*rule_rows(overlap=overlap)))
    schema = to_arrow_schema(RULE_SCHEMA)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema), schema=RULE_SCHEMA)


# --- access ---------------------------------------------------------------------------------------

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
_SQL = {"log": LOG, "versions": VERSIONS, "facts": FACTS, "stamped": STAMPED, "areas": AREAS, "old_areas": OLD_AREAS,
        "regions": REGIONS, "files": FILES, "blocks": BLOCKS}


def shape_sql(name: str) -> str:
    """SQL text of a shape with plain table names, for the SQL check."""
    if name == "rules":
        return rules_sql()
    if name == "plain_rules":
        return rules_sql(overlap=False)
    text = _WEIGHTS_SQL if name == "weights" else INCOMING if name == "incoming" else _SQL[name]
    names = {t: t for t in TABLES}
    return text.format(**names, versions=VERSIONS.format(**names))


def weights_of(blocks: DataFrame) -> DataFrame:
    """The shape ``weights``, derived from rows of the shape ``blocks``."""
    return blocks.sparkSession.sql(_WEIGHTS_SPARK.replace(f"({BLOCKS})", "{blocks}"), blocks=blocks)


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shape as a DataFrame over the Parquet tables in ``sf_dir``."""
    if name in ("rules", "plain_rules"):
        return rules(spark, overlap=name == "rules")
    text = _WEIGHTS_SPARK if name == "weights" else INCOMING if name == "incoming" else _SQL[name]
    paths = {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in TABLES}
    rows = spark.sql(text.format(**paths, versions=VERSIONS.format(**paths)))
    return rows if name != "stamped" else rows.withColumn("etl_batch_id", F.col("etl_batch_id").cast("long"))
