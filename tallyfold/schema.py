"""Column lists, table schemas and code maps of the headcount data model."""

from pyspark.sql import types as T

# Names, order and codes that have to match existing data.

GEO_TYPE_CODES = {
    "block": "blk",
    "blockgroup": "blkg",
    "county": "cou",
    "legdist": "lgd",
    "schooldist": "scd",
    "state": "ste",
    "tract": "trc",
    "zip": "zip",
}
GEO_SCOPES = {
    "blk": "kps",
    "blkg": "kps",
    "cou": "wa",
    "lgd": "wa",
    "scd": "wa",
    "ste": "wa",
    "trc": "wa",
    "zip": "wa",
}
COUNTIES = ("33", "53", "61")
RACE_FLAGS = ["race_wht", "race_blk", "race_aian", "race_as", "race_nhpi", "race_hisp"]
RAW_CODES = ["raw_agestr", "raw_gender", "raw_racemars", "raw_hispanic"]
AGE_BANDS = ["age_5", "age_11", "age_20"]
TARGET_TYPES = ["CCL", "CSA", "Inc_Uninc", "kccd", "PUMA", "tribal"]
QA_COLUMNS = ["age", "age_5", "age_11", "age_20", "gender", *RACE_FLAGS, "fips_co"]
QA_KEYS = ["geo_type", "geo_scope", "geo_year", "r_type", "year"]
STAMPED = ["geo_type", "geo_scope", "geo_year", "census_year", "year", "r_type"]
RAW_CELLS = [f"col{i}" for i in range(1, 8)]

BATCH_FIELDS = ["etl_batch_id", "geo_type", "geo_scope", "geo_year", "census_year", "year", "r_type"]
RECODED = ["age", *AGE_BANDS, "age_100", "gender", *RACE_FLAGS, "rcode", "r1r3", "r2r4"]
DIMENSIONS = [*RECODED, "fips_co", *RAW_CODES]
GEO_COLUMNS = [
    *BATCH_FIELDS, "geo_id", "age", *AGE_BANDS, "age_100", "gender", "pop",
    *RACE_FLAGS, "rcode", "r1r3", "r2r4", "fips_co", *RAW_CODES,
]
# Every geography table and the columns it adds to or leaves out of GEO_COLUMNS.
GEO_TABLES = [
    "pop_geo_blk", "pop_geo_CCL", "pop_geo_cou", "pop_geo_CSA", "pop_geo_hra", "pop_geo_Inc_Uninc",
    "pop_geo_kccd", "pop_geo_lgd", "pop_geo_PUMA", "pop_geo_reg", "pop_geo_scd", "pop_geo_tribal",
    "pop_geo_zip",
]

LOG_STAMPS = [f"{act}_{hop}_datetime" for hop in ("raw", "stage", "ref", "archive") for act in ("load", "delete")]
LOG_ROW_COUNTS = ["qa_rows_file", "qa_rows_raw", "qa_rows_stage", "qa_rows_ref"]
LOG_TOTALS = ["qa_pop_file", "qa_pop_raw", "qa_pop_stage", "qa_pop_ref"]
LOG_KEY = ["batch_name", "file_name", "geo_type", "geo_scope", "geo_year", "year", "r_type", "census_year"]


def _struct(**kinds):
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_S, _H, _I, _L, _D = T.StringType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()

RAW_SCHEMA = _struct(**{name: _S for name in RAW_CELLS})

RULE_SCHEMA = _struct(
    old_column=_S, old_value_txt=_S, old_value_num_min=_I, old_value_num_max=_I,
    new_column=_S, new_value_num=_I, new_value_txt=_S, r_type=_H,
)

LOG_SCHEMA = _struct(
    id=_L, batch_name=_S, batch_date=T.DateType(), file_name=_S, file_loc=_S, geo_type=_S, geo_scope=_S,
    geo_year=_S, census_year=_S, year=_S, r_type=_H,
    **{name: _L for name in LOG_ROW_COUNTS},
    **{name: _D for name in LOG_TOTALS},
    **{name: T.TimestampType() for name in LOG_STAMPS},
    last_update_datetime=T.TimestampType(), etl_notes=_S,
)

STAGE_SCHEMA = _struct(
    etl_batch_id=_L, geo_type=_S, geo_scope=_S, geo_year=_S, census_year=_S, year=_S, r_type=_H, geo_id=_S,
    **{name: _H for name in ["age", *AGE_BANDS, "age_100", "gender"]},
    pop=_D,
    **{name: _H for name in [*RACE_FLAGS, "rcode", "r1r3", "r2r4", "fips_co"]},
    **{name: _S for name in RAW_CODES},
)

QA_SCHEMA = _struct(
    geo_type=_S, geo_scope=_S, geo_year=_S, r_type=_H, year=_S, col=_S, val=_H, pop=_D,
)
