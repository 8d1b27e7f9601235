"""SQL counterparts of the registered queries, run by another engine on the same tables."""

from __future__ import annotations

from catalog.shapes import shape_sql
from tallyfold.schema import AGE_BANDS, COUNTIES, GEO_COLUMNS, QA_COLUMNS, QA_KEYS, RACE_FLAGS, RAW_CODES

SQL: dict[str, str] = {}


def _with(query: str, /, *shapes: str, **ctes: str) -> str:
    parts = [f"{name} AS ({shape_sql(name)})" for name in shapes]
    parts += [f"{name} AS ({text})" for name, text in ctes.items()]
    return f"WITH {', '.join(parts)}\n{query}" if parts else query


def _small(column, value):
    return f"CAST({value} AS SMALLINT) AS {column}"


_AGE = "TRY_CAST(substring(raw_agestr, 1, 3) AS SMALLINT)"
_COUNTY_LIST = ", ".join(f"'{c}'" for c in COUNTIES)

# --- latest versions ------------------------------------------------------------------------------

_NEWEST = """SELECT geo_type, geo_year, census_year, year, MAX(batch_date) AS batch_date FROM log
WHERE load_ref_datetime IS NOT NULL AND delete_ref_datetime IS NULL GROUP BY ALL"""
_CHOSEN = """SELECT log.* FROM log JOIN newest USING (geo_type, geo_year, census_year, year, batch_date)
WHERE r_type = 97 AND census_year = '2020' AND (geo_year = '2020' OR geo_type = 'zip')"""
_LATEST_COLUMNS = "id, geo_type, geo_year, census_year, year, r_type, CAST(batch_date AS VARCHAR) AS batch_date"

SQL["latest"] = _with(f"SELECT {_LATEST_COLUMNS} FROM chosen", "log", newest=_NEWEST, chosen=_CHOSEN)
SQL["latest_loaded_any_scheme"] = _with(
    f"""SELECT {_LATEST_COLUMNS} FROM log JOIN newest USING (geo_type, geo_year, census_year, year, batch_date)
WHERE load_ref_datetime IS NOT NULL AND delete_ref_datetime IS NULL""", "log", newest=_NEWEST)

# --- recodes by join ------------------------------------------------------------------------------


def _rule(alias, old, new, on, *, how="JOIN", scheme=False, source="rules"):
    """One join with a slice of the rule table; ``on`` is the value looked up, ranges when it is not text."""
    text = on.startswith("'") is False and (old.startswith("raw_"))
    test = f"{alias}.old_value_txt = {on}" if text else f"{on} BETWEEN {alias}.old_value_num_min AND {alias}.old_value_num_max"
    only = f" AND {alias}.r_type = f.r_type" if scheme else ""
    return (f"{how} (SELECT * FROM {source} WHERE old_column = '{old}' AND new_column = '{new}') {alias} "
            f"ON {test}{only}")


def _recoded(source_rows: str, rules: str = "rules") -> str:
    """All recodes of rows ``f`` that have raw codes, age and r_type; plain values of flags and r2r4 parts kept."""
    joins = [_rule(b, "age", b, "f.age", source=rules) for b in AGE_BANDS]
    joins.append(_rule("gen", "raw_gender", "gender", "f.raw_gender", source=rules))
    joins.append(_rule("rc", "raw_racemars", "rcode", "f.raw_racemars", scheme=True, source=rules))
    joins.append(_rule("r13", "rcode", "r1r3", "rc.new_value_num", scheme=True, source=rules))
    joins.append(_rule("r24", "rcode", "r2r4", "rc.new_value_num", scheme=True, source=rules))
    joins.append(_rule("ov", "raw_hispanic", "r2r4", "f.raw_hispanic", how="LEFT JOIN", scheme=True, source=rules))
    for flag in RACE_FLAGS[:-1]:
        joins.append(_rule(flag, "raw_racemars", flag, "f.raw_racemars", how="LEFT JOIN", scheme=True, source=rules))
    joins.append(_rule("race_hisp", "raw_hispanic", "race_hisp", "f.raw_hispanic", how="LEFT JOIN", source=rules))
    values = [_small(b, f"{b}.new_value_num") for b in AGE_BANDS]
    values += [_small("age_100", "CASE WHEN f.age > 100 THEN 100 ELSE f.age END"), _small("gender", "gen.new_value_num")]
    values += [_small(f"{flag}_plain", f"{flag}.new_value_num") for flag in RACE_FLAGS]
    values += [_small("rcode", "rc.new_value_num"), _small("r1r3", "r13.new_value_num")]
    values += [_small("r24_base", "r24.new_value_num"), _small("r24_override", "ov.new_value_num")]
    return f"SELECT f.*, {', '.join(values)} FROM ({source_rows}) f " + "\n".join(joins)


_DEFAULTED = ", ".join([*[_small(flag, f"COALESCE({flag}_plain, 0)") for flag in RACE_FLAGS],
                        _small("r2r4", "COALESCE(r24_override, r24_base)")])
_FILE = "z.id AS etl_batch_id, z.geo_type, z.geo_scope, z.geo_year, z.census_year, z.year, z.r_type"


def _chosen_facts(geo_type, where="TRUE"):
    return (f"SELECT {_FILE}, x.geo_id, {_AGE} AS age, x.pop, {', '.join(RAW_CODES)} FROM facts x "
            f"JOIN chosen z ON z.id = x.etl_batch_id WHERE z.geo_type = '{geo_type}' AND {where}")


_GEO = {"newest": _NEWEST, "chosen": _CHOSEN}
_POP = "CAST(pop AS DOUBLE) AS pop"
_IN_COUNTIES = f"substring(x.geo_id, 4, 2) IN ({_COUNTY_LIST})"


def _columns(names, **changes):
    return ", ".join(changes.get(n, n) for n in names)


_FIPS = "CASE WHEN geo_scope = 'kps' THEN substring(geo_id, 4, 2) END AS fips_co"
_BLOCKS = f"SELECT *, {_DEFAULTED}, {_FIPS} FROM plain"

SQL["geo_block"] = _with(
    f"""SELECT {_columns(GEO_COLUMNS, pop=_POP)}, substring(geo_id, 1, 11) AS geo_id_tract,
substring(geo_id, 1, 12) AS geo_id_blkgrp FROM blocks""",
    "log", "facts", "rules", **_GEO, plain=_recoded(_chosen_facts("blk", _IN_COUNTIES)), blocks=_BLOCKS)

for _name, _code in (("geo_legislative", "lgd"), ("geo_school", "scd"), ("geo_zip", "zip")):
    SQL[_name] = _with(
        f"SELECT {_columns([c for c in GEO_COLUMNS if c != 'fips_co'], pop=_POP)} FROM (SELECT *, {_DEFAULTED} FROM plain)",
        "log", "facts", "rules", **_GEO, plain=_recoded(_chosen_facts(_code)))

_PLAIN_KEYS = ["etl_batch_id", "geo_year", "census_year", "year", "r_type", "age", *AGE_BANDS, "age_100", "gender",
               *[f"{flag}_plain" for flag in RACE_FLAGS], "rcode", "r1r3", "r24_base", "r24_override", *RAW_CODES]
SQL["geo_county"] = _with(
    f"""SELECT {_columns(GEO_COLUMNS, geo_type="'cou' AS geo_type", geo_scope="'wa' AS geo_scope", pop=_POP,
    fips_co="CAST(NULL AS VARCHAR) AS fips_co")} FROM (SELECT *, {_DEFAULTED} FROM
(SELECT {', '.join(_PLAIN_KEYS)}, substring(geo_id, 1, 5) AS geo_id, SUM(pop) AS pop FROM plain
GROUP BY {', '.join(_PLAIN_KEYS)}, substring(geo_id, 1, 5)))""",
    "log", "facts", "rules", **_GEO, plain=_recoded(_chosen_facts("blk")))

_BLOCK_CTES = {**_GEO, "plain": _recoded(_chosen_facts("blk", _IN_COUNTIES)), "blocks": _BLOCKS}
_PLAIN_BLOCK_CTES = {**_GEO, "plain": _recoded(_chosen_facts("blk", _IN_COUNTIES), "plain_rules"), "blocks": _BLOCKS}


def _summed(changes: dict, source: str, pop="b.pop") -> str:
    """Grouped sum in the common layout; ``changes`` gives columns that do not come from the rows."""
    picked = [f"{changes[c]} AS {c}" if c in changes else f"CAST(SUM({pop}) AS DOUBLE) AS pop" if c == "pop" else f"b.{c}"
              for c in GEO_COLUMNS]
    return f"SELECT {', '.join(picked)} FROM {source} GROUP BY ALL"


_HRA = _summed({"geo_type": "'hra'", "geo_scope": "'kc'", "geo_year": "a.hra_census_year", "geo_id": "a.hra_geo_id"},
               "blocks b JOIN areas a ON b.census_year = a.blk_census_year AND b.geo_id = a.blk_geo_id")
_HRA_EXACT = _HRA.replace("CAST(SUM(b.pop) AS DOUBLE)", "SUM(b.pop)")
SQL["geo_hra"] = _with(_HRA, "log", "facts", "rules", "areas", **_BLOCK_CTES)
SQL["geo_region"] = _with(
    _summed({"geo_type": "'reg'", "geo_id": "g.reg_geo_id"},
            "hra b JOIN regions g ON b.geo_year = g.census_year AND b.geo_id = g.hra_geo_id"),
    "log", "facts", "rules", "areas", "regions", **_BLOCK_CTES, hra=_HRA_EXACT)


def _allocated(where):
    return _summed({"geo_type": "w.target_type", "geo_scope": "'kc'", "geo_year": "w.geo_year",
                    "census_year": "w.census_year", "geo_id": "w.target_id"},
                   f"blocks b JOIN weights w ON (b.census_year, b.geo_year, b.geo_id) = (w.census_year, w.geo_year, w.geo_id) "
                   f"WHERE {where}", "b.pop * w.proportion")


SQL["geo_allocated"] = _with(_allocated("TRUE"), "log", "facts", "rules", "weights", **_BLOCK_CTES)
SQL["allocation_of_recoded_blocks"] = _with(_allocated("w.target_type IN ('kccd', 'tribal')"),
                                            "log", "facts", "plain_rules", "weights", **_PLAIN_BLOCK_CTES)
SQL["hierarchy_of_recoded_blocks"] = _with(_HRA, "log", "facts", "plain_rules", "areas", **_PLAIN_BLOCK_CTES)

_TARGETS = ["CCL", "CSA", "Inc_Uninc", "kccd", "PUMA", "tribal"]
_COUNT = "geo_id, geo_year, year, COUNT(*) AS n, CAST(SUM(pop) AS DOUBLE) AS pop"
_ALLOCATED_EXACT = _allocated("TRUE").replace("CAST(SUM(b.pop * w.proportion) AS DOUBLE)", "SUM(b.pop * w.proportion)")
_GEO_ROWS = {
    "pop_geo_blk": "blocks", "pop_geo_lgd": "lgd", "pop_geo_scd": "scd", "pop_geo_zip": "zip", "pop_geo_hra": "hra", "pop_geo_reg": "reg",
    "pop_geo_cou": f"""(SELECT substring(geo_id, 1, 5) AS geo_id, geo_year, year, SUM(pop) AS pop FROM wide
  GROUP BY {', '.join(c for c in _PLAIN_KEYS if c not in ("geo_year", "year"))}, substring(geo_id, 1, 5), geo_year, year)""",
    **{f"pop_geo_{t}": f"(SELECT * FROM allocated WHERE geo_type = '{t}')" for t in _TARGETS}}
_GEO_SHAPES = ("log", "facts", "rules", "areas", "regions", "weights")
_GEO_ALL = dict(
    **_BLOCK_CTES, wide=_recoded(_chosen_facts("blk")),
    lgd=_recoded(_chosen_facts("lgd")), scd=_recoded(_chosen_facts("scd")), zip=_recoded(_chosen_facts("zip")),
    hra=_HRA_EXACT, allocated=_ALLOCATED_EXACT,
    reg=_summed({"geo_type": "'reg'", "geo_id": "g.reg_geo_id"},
                "hra b JOIN regions g ON b.geo_year = g.census_year AND b.geo_id = g.hra_geo_id").replace(
                    "CAST(SUM(b.pop) AS DOUBLE)", "SUM(b.pop)"))
SQL["geographies"] = _with("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, {_COUNT} FROM {rows} GROUP BY geo_id, geo_year, year" for name, rows in _GEO_ROWS.items()),
    *_GEO_SHAPES, **_GEO_ALL)
SQL["copied_geographies"] = _with("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS rows_from, COUNT(*) AS rows_to, 'PASS' AS status FROM {rows}"
    for name, rows in _GEO_ROWS.items()), *_GEO_SHAPES, **_GEO_ALL)

_FACT_COLUMNS = "f.etl_batch_id, f.geo_id, f.raw_agestr, f.raw_gender, f.raw_racemars, f.raw_hispanic, CAST(f.pop AS DOUBLE) AS pop"
_SCHEME_FACTS = "SELECT x.*, log.r_type FROM facts x JOIN log ON log.id = x.etl_batch_id"

SQL["recode_exact"] = _with(
    f"SELECT {_FACT_COLUMNS}, {_small('gender', 'g.new_value_num')} FROM facts f "
    + _rule("g", "raw_gender", "gender", "f.raw_gender"), "facts", "rules")
SQL["recode_range"] = _with(
    f"SELECT {_FACT_COLUMNS}, f.age, {', '.join(_small(b, f'{b}.new_value_num') for b in AGE_BANDS)} "
    f"FROM (SELECT *, {_AGE} AS age FROM facts) f " + " ".join(_rule(b, "age", b, "f.age") for b in AGE_BANDS),
    "facts", "rules")
SQL["recode_optional"] = _with(
    f"SELECT {_FACT_COLUMNS}, {_small('race_hisp', 'COALESCE(h.new_value_num, 0)')} FROM facts f "
    + _rule("h", "raw_hispanic", "race_hisp", "f.raw_hispanic", how="LEFT JOIN"), "facts", "rules")
_RCODE = _rule("rc", "raw_racemars", "rcode", "f.raw_racemars", scheme=True)
SQL["recode_by_scheme"] = _with(
    f"SELECT {_FACT_COLUMNS}, f.r_type, {_small('rcode', 'rc.new_value_num')}, {_small('r1r3', 'r13.new_value_num')} "
    f"FROM ({_SCHEME_FACTS}) f {_RCODE} " + _rule("r13", "rcode", "r1r3", "rc.new_value_num", scheme=True),
    "log", "facts", "rules")
SQL["recode_with_override"] = _with(
    f"SELECT {_FACT_COLUMNS}, f.r_type, {_small('rcode', 'rc.new_value_num')}, "
    f"{_small('r2r4', 'COALESCE(ov.new_value_num, r24.new_value_num)')} FROM ({_SCHEME_FACTS}) f {_RCODE} "
    + _rule("r24", "rcode", "r2r4", "rc.new_value_num", scheme=True) + " "
    + _rule("ov", "raw_hispanic", "r2r4", "f.raw_hispanic", how="LEFT JOIN", scheme=True), "log", "facts", "rules")
SQL["recode_all"] = _with(
    f"""SELECT etl_batch_id, geo_id, {', '.join(RAW_CODES)}, {_POP}, r_type, age, {', '.join(AGE_BANDS)}, age_100, gender,
rcode, r1r3, {_DEFAULTED} FROM plain""",
    "log", "facts", "rules", plain=_recoded(f"SELECT *, {_AGE} AS age FROM ({_SCHEME_FACTS})"))

# --- cascades -------------------------------------------------------------------------------------

_PAD = """CASE WHEN r_type = 97 AND length(raw_racemars) < 5 THEN lpad(raw_racemars, 5, '0') ELSE raw_racemars END"""
_PADDED = f"SELECT * REPLACE ({_PAD} AS raw_racemars), {_AGE} AS age FROM stamped"
_TUPLE = ["age", "raw_gender", "raw_racemars", "raw_hispanic", "r_type"]
_ORDERS = {
    "first": "old_column DESC, new_value_num ASC NULLS LAST, new_value_txt ASC NULLS LAST",
    "last": "old_column DESC, old_value_txt ASC NULLS LAST, old_value_num_min ASC NULLS LAST",
}


def _cascaded(policy, source="padded", override="raw_hispanic"):
    """Every new column as the value of the rule that wins, found by rank over all rules that match a code tuple."""
    columns = sorted({"age_5", "age_11", "age_20", "gender", "rcode", "r1r3", "r2r4", *RACE_FLAGS}, reverse=True)
    frame = f"(SELECT DISTINCT {', '.join(_TUPLE)} FROM {source})"
    for i, name in enumerate(columns):
        old = "CASE r.old_column " + " ".join(
            f"WHEN '{c}' THEN CAST(t.{c} AS VARCHAR)" for c in ["age", "raw_gender", "raw_racemars", "raw_hispanic"]
            + (["rcode"] if i > columns.index("rcode") else [])) + " END"
        best = {"first": f"arg_max(r.new_value_num, CASE WHEN r.old_column = '{override}' THEN 100000 + r.pos ELSE -r.pos END)",
                "last": "arg_max(r.new_value_num, r.pos)"}[policy]
        hit = (f"(r.r_type IS NULL OR r.r_type = t.r_type) AND (r.old_value_txt = {old} OR (r.old_value_txt IS NULL "
               f"AND TRY_CAST({old} AS INTEGER) BETWEEN r.old_value_num_min AND r.old_value_num_max))")
        won = f"SELECT CAST({best} AS SMALLINT) FROM ranked r WHERE r.new_column = '{name}' AND {hit}"
        frame = f"(SELECT t.*, ({won}) AS {name} FROM {frame} t)"
    return f"SELECT * FROM {frame}"


def _ranked(policy):
    return f"SELECT *, row_number() OVER (PARTITION BY new_column ORDER BY {_ORDERS[policy]}) AS pos FROM rules"


_NEW_COLUMNS = [*AGE_BANDS, "gender", *RACE_FLAGS, "rcode", "r1r3", "r2r4"]
_STAMPED_COLUMNS = ["etl_batch_id", "geo_type", "geo_scope", "geo_year", "census_year", "year", "r_type", "geo_id",
                    *RAW_CODES, "pop"]

def _cascade_join(source, tuples):
    same = " AND ".join(f"{source}.{c} IS NOT DISTINCT FROM {tuples}.{c}" for c in _TUPLE)
    return f"{source} JOIN {tuples} ON {same}"


def _stamped_select(zero):
    picked = [f"CAST(padded.{c} AS BIGINT) AS {c}" if c == "etl_batch_id" else f"CAST(padded.{c} AS DOUBLE) AS {c}"
              if c == "pop" else f"padded.{c}" for c in _STAMPED_COLUMNS] + ["padded.age"]
    picked += [_small(c, f"COALESCE(coded.{c}, 0)") if zero and c in RACE_FLAGS else f"coded.{c}" for c in _NEW_COLUMNS]
    return f"SELECT {', '.join(picked)} FROM {_cascade_join('padded', 'coded')}"


for _policy in ("first", "last"):
    SQL[f"cascade_{_policy}"] = _with(_stamped_select(_policy == "first"), "stamped", "rules", padded=_PADDED,
                                      ranked=_ranked(_policy), coded=_cascaded(_policy))

SQL["cascade_many_rules"] = """WITH spans AS (
  SELECT k.l_orderkey, CAST(arg_max(o.o_custkey % 50, o.o_orderkey) AS SMALLINT) AS grade
  FROM (SELECT DISTINCT l_orderkey FROM lineitem) k JOIN orders o ON o.o_orderkey BETWEEN k.l_orderkey - 3 AND k.l_orderkey
  GROUP BY k.l_orderkey),
rows AS (SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 77 ELSE 97 END AS SMALLINT) AS r_type FROM lineitem)
SELECT r.l_orderkey, r.l_linenumber, r.r_type, CASE WHEN o.o_orderkey IS NULL THEN s.grade
  WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(o.o_custkey % 100 AS SMALLINT) END AS grade
FROM rows r LEFT JOIN spans s ON s.l_orderkey = r.l_orderkey
LEFT JOIN orders o ON o.o_orderkey = r.l_orderkey AND (o.o_orderkey % 2 = 0 OR r.r_type = 77)"""

SQL["area_of_block"] = _with(
    f"""SELECT {_FACT_COLUMNS}, a.hra_id FROM facts f
LEFT JOIN (SELECT * FROM old_areas WHERE geo_year = '2020') a ON a.blk_geo_id = f.geo_id""", "facts", "old_areas")

# --- scalar clean-up ------------------------------------------------------------------------------

SQL["block_id_parts"] = _with(
    """SELECT etl_batch_id, geo_id, CAST(pop AS DOUBLE) AS pop, left(geo_id, 5) AS geo_id_county,
left(geo_id, 11) AS geo_id_tract, left(geo_id, 12) AS geo_id_blkgrp, substring(geo_id, 4, 2) AS fips_co FROM facts""", "facts")
SQL["ages"] = _with(
    f"""SELECT etl_batch_id, geo_id, raw_agestr, CAST(pop AS DOUBLE) AS pop, {_AGE} AS age,
{_small("age_100", f"CASE WHEN {_AGE} > 100 THEN 100 ELSE {_AGE} END")} FROM facts""", "facts")
SQL["padded_codes"] = _with(f"SELECT geo_id, r_type, raw_agestr, {_PAD} AS raw_racemars FROM stamped", "stamped")
SQL["scope"] = _with(
    f"""SELECT geo_id, geo_scope, raw_agestr, raw_gender FROM stamped
WHERE geo_scope <> 'kps' OR substring(geo_id, 4, 2) IN ({_COUNTY_LIST})""", "stamped")
SQL["block_scope"] = _with(
    f"""SELECT etl_batch_id, geo_id, raw_agestr, CAST(pop AS DOUBLE) AS pop FROM facts
WHERE substring(geo_id, 4, 2) IN ({_COUNTY_LIST})""", "facts")
SQL["zero_filled"] = _with(
    """SELECT geo_id, raw_agestr, raw_gender, CASE WHEN geo_scope = 'kps' THEN substring(geo_id, 4, 2) ELSE '0' END AS fips_co,
CAST(COALESCE(pop, 0) AS DOUBLE) AS pop FROM stamped""", "stamped")
SQL["aligned"] = _with(
    """SELECT etl_batch_id, geo_id, CAST(pop AS DOUBLE) AS pop, CAST(NULL AS SMALLINT) AS fips_co, raw_agestr, raw_hispanic
FROM facts""", "facts")
SQL["batch_dates"] = _with(
    """SELECT id, batch_name, CAST(CASE WHEN regexp_full_match(substring(batch_name, 5, 2), '[0-9]+') THEN
substring(batch_name, 1, 4) || '-' || substring(batch_name, 5, 2) || '-' || substring(batch_name, 7, 2)
ELSE substring(batch_name, 1, 4) || '-01-01' END AS VARCHAR) AS named_date FROM log""", "log")
SQL["folder_matches"] = _with(
    """SELECT id, replace(replace(file_loc, 'https://store', ''), '/pop/', '') AS folder FROM log
WHERE position('csv_1997/' IN file_loc) > 0 OR position('/2000' IN file_loc) > 0""", "log")
SQL["valid"] = _with(
    """SELECT CAST(etl_batch_id AS BIGINT) AS etl_batch_id, geo_id, raw_agestr, raw_gender, CAST(pop AS DOUBLE) AS pop
FROM stamped WHERE pop IS NOT NULL AND geo_type = 'blk' AND etl_batch_id IN (19971, 19981, 19992, 20001)""", "stamped")
SQL["routed"] = _with(
    """SELECT geo_id, r_type, raw_agestr, raw_gender, t.table_name AS table_name, t.table_name AS routed_to
FROM (SELECT *, CASE WHEN r_type = 77 THEN 'pop_77' ELSE 'pop' END AS table_name FROM stamped) t""", "stamped")

# --- files ----------------------------------------------------------------------------------------

SQL["manifest"] = _with(
    r"""SELECT l_orderkey, l_linenumber, file_path,
CASE WHEN file_name LIKE '%.gz' THEN file_name ELSE file_name || '.gz' END AS file_name,
COALESCE(map_from_entries([('block','blk'),('blockgroup','blkg'),('county','cou'),('legdist','lgd'),('schooldist','scd'),
  ('state','ste'),('tract','trc'),('zip','zip')])[word], word) AS geo_type,
CASE WHEN word IN ('block','blockgroup') THEN 'kps' WHEN word IN ('county','legdist','schooldist','state','tract','zip')
  THEN 'wa' END AS geo_scope,
CASE WHEN racemars THEN regexp_extract(lower(file_name), '^[a-z]+([0-9]{4})racemars', 1) END AS geo_year,
regexp_extract(lower(file_name), '([0-9]{4})\.csv', 1) AS year,
CAST(regexp_extract(lower(file_name), '([0-9]{2})[0-9]{4}\.csv', 1) AS SMALLINT) AS r_type,
batch_name, substring(batch_name, 1, 4) || '-07-15' AS batch_date,
'https://store/pop/' || batch_name || '/csv_' || substring(batch_name, 1, 4) || '/'
  || CASE WHEN l_partkey % 6 = 0 THEN batch_name || '/' ELSE '' END AS file_loc
FROM (SELECT *, CASE WHEN racemars THEN regexp_replace(regexp_extract(lower(file_name), '^([a-z]+)[0-9]{4}racemars', 1), 'code', '') END
          AS word FROM
  (SELECT *, regexp_extract(file_path, '([^/]+)$', 1) AS file_name, split_part(file_path, '/', 4) AS batch_name,
          lower(file_path) LIKE '%racemars%' AS racemars FROM files))""", "files")
SQL["file_profiles"] = _with(
    """SELECT geo_type || '-' || year || '-' || CAST(r_type AS VARCHAR) AS file, COUNT(*) AS rows_file,
CAST(SUM(COALESCE(pop, 0)) AS DOUBLE) AS pop_file FROM stamped GROUP BY ALL""", "stamped")

_SOURCES = "SELECT DISTINCT 'BlockCode2020RaceMars' || CAST(r_type AS VARCHAR) || year AS file, r_type FROM stamped"
_LAYOUT = {
    97: ["year", "geo_id", "raw_agestr", "raw_gender", "raw_racemars", "raw_hispanic", "pop"],
    77: ["pop", "raw_gender", "raw_agestr", "geo_id", "raw_hispanic", "raw_racemars", "year"],
}
_PLACES = ", ".join(f"({s}, {i + 1}, '{role}')" for s, roles in _LAYOUT.items() for i, role in enumerate(roles))
SQL["header_roles"] = _with(
    f"""SELECT file, CAST(p.position AS INTEGER) AS position, p.role AS role
FROM sources JOIN (VALUES {_PLACES}) AS p(scheme, position, role) ON p.scheme = sources.r_type""",
    "stamped", sources=_SOURCES)
SQL["bad_records"] = _with(
    """SELECT file, CASE WHEN file = 'BlockCode2020RaceMars972000' THEN (SELECT COUNT(*) FROM region) ELSE 0 END AS bad_records
FROM sources""", "stamped", sources=_SOURCES)
# A first cell that is empty leaves its row out: the layout of scheme 77 begins with the headcount.
_BODY = """SELECT 'BlockCode2020RaceMars' || CAST(r_type AS VARCHAR) || year AS file, * FROM stamped
WHERE r_type = 97 OR pop IS NOT NULL"""
SQL["raw_rows"] = _with(
    f"""SELECT file, year, CAST(pop AS DOUBLE) AS pop, {', '.join(RAW_CODES)}, geo_id FROM body""", "stamped", body=_BODY)
SQL["stamped_rows"] = _with(
    """SELECT file, CAST(pop AS DOUBLE) AS pop, raw_gender, raw_agestr, raw_racemars, raw_hispanic, geo_id, 'blk' AS geo_type,
'kps' AS geo_scope, '2020' AS geo_year, '2020' AS census_year, year, r_type, substring(geo_id, 4, 2) AS fips_co FROM body""",
    "stamped", body=_BODY)
SQL["table_source"] = _with(
    """SELECT 7 AS etl_batch_id, geo_id, CAST(pop AS DOUBLE) AS pop, raw_agestr, raw_gender,
CASE WHEN length(raw_racemars) < 5 THEN lpad(raw_racemars, 5, '0') ELSE raw_racemars END AS raw_racemars, raw_hispanic,
'blk' AS geo_type, 'kps' AS geo_scope, '2020' AS geo_year, '2020' AS census_year, 97 AS r_type, year,
substring(geo_id, 4, 2) AS fips_co FROM stamped WHERE year = '1998'""", "stamped")

_CLEAN = f"""SELECT '2020' AS year, geo_id, substring(raw_agestr, 1, 3) AS raw_agestr, raw_gender, raw_racemars, raw_hispanic,
CAST(pop AS DOUBLE) AS pop, CAST(97 AS SMALLINT) AS r_type, {_AGE} AS age, substring(geo_id, 4, 2) AS fips_co FROM facts
WHERE substring(geo_id, 4, 2) IN ({_COUNTY_LIST})"""
SQL["cleaned_frame"] = _with(
    f"""SELECT padded.geo_id, padded.year, padded.raw_agestr, padded.raw_gender, padded.raw_racemars,
COALESCE(padded.raw_hispanic, '0') AS raw_hispanic, padded.pop, padded.fips_co, 'blk' AS geo_type, 'kps' AS geo_scope,
'2020' AS geo_year, '2020' AS census_year, padded.r_type, {_small('age', 'COALESCE(padded.age, 0)')},
{', '.join(_small(c, f'COALESCE(coded.{c}, 0)') for c in _NEW_COLUMNS)}, a.hra_id
FROM {_cascade_join('padded', 'coded')}
LEFT JOIN (SELECT * FROM old_areas WHERE geo_year = '2020') a ON a.blk_geo_id = padded.geo_id""",
    "facts", "rules", "old_areas", padded=_CLEAN, ranked=_ranked("last"), coded=_cascaded("last"))
SQL["replaced_batches"] = _with(
    """SELECT CAST(etl_batch_id AS BIGINT) AS etl_batch_id, geo_type, COUNT(*) AS n, CAST(SUM(pop) AS DOUBLE) AS pop FROM stamped
WHERE geo_type = 'blk' OR etl_batch_id % 10 <> 1 GROUP BY ALL""", "stamped")
SQL["written_formats"] = _with(
    """SELECT format, geo_id, raw_agestr, raw_gender, raw_racemars, raw_hispanic, CAST(pop AS DOUBLE) AS pop, year FROM stamped
JOIN (VALUES ('parquet'), ('orc')) AS v(format) ON TRUE""", "stamped")
SQL["copied_tables"] = _with(
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS rows_from, COUNT(*) AS rows_to, 'PASS' AS status FROM {t}"
                        for t in ("log", "facts", "areas", "regions", "rules")),
    "log", "facts", "areas", "regions", "rules")
_FILES = """SELECT year, r_type, COUNT(*) AS n, COUNT(pop) AS counted, CAST(round(COALESCE(SUM(pop), 0), 0) AS DOUBLE) AS total
FROM stamped GROUP BY year, r_type, CAST(right(geo_id, 1) AS INTEGER) % 4"""
_HOP_TOTALS = ", ".join(["CAST(SUM(n) AS BIGINT) AS qa_rows_file", *[f"CAST(SUM(counted) AS BIGINT) AS qa_rows_{hop}" for hop in (
    "raw", "stage", "ref")], *[f"SUM(total) AS qa_pop_{hop}" for hop in ("file", "raw", "stage", "ref")]])
SQL["loaded_files"] = _with(
    f"""SELECT 'blk' AS geo_type, 'kps' AS geo_scope, '2020' AS geo_year, '2020' AS census_year, year, r_type, {_HOP_TOTALS}
FROM files GROUP BY year, r_type""", "stamped", files=_FILES)
# The layout of scheme 77 begins with the headcount: without one its rows have no first cell.
SQL["load_reconciled"] = _with(
    """SELECT year, r_type, hop, fate, CAST(SUM(CASE
  WHEN hop = 'file' AND fate = 'kept' THEN CASE WHEN r_type = 77 THEN counted ELSE n END
  WHEN fate = 'no_first_cell' THEN CASE WHEN r_type = 77 THEN n - counted ELSE 0 END
  WHEN fate = 'no_headcount' THEN CASE WHEN r_type = 77 THEN 0 ELSE n - counted END
  WHEN fate = 'kept' THEN counted ELSE 0 END) AS BIGINT) AS n_rows,
CASE WHEN hop <> 'file' THEN bool_and(n = counted) END AS agrees
FROM files JOIN (VALUES ('file', 'kept'), ('file', 'bad_record'), ('file', 'no_first_cell'), ('raw', 'kept'),
  ('raw', 'unreadable_headcount'), ('raw', 'no_headcount'), ('stage', 'kept'), ('ref', 'kept')) AS h(hop, fate) ON TRUE
GROUP BY year, r_type, hop, fate""", "stamped", files=_FILES)

SQL["loaded_table_batches"] = _with(
    """SELECT CAST(year AS BIGINT) AS id, year, COUNT(pop) AS qa_rows_raw, COUNT(pop) AS qa_rows_stage,
COUNT(pop) AS qa_rows_ref, CAST(round(COALESCE(SUM(pop), 0), 0) AS DOUBLE) AS qa_pop_raw,
CAST(round(COALESCE(SUM(pop), 0), 0) AS DOUBLE) AS qa_pop_stage, CAST(round(COALESCE(SUM(pop), 0), 0) AS DOUBLE) AS qa_pop_ref,
TRUE AS loaded FROM stamped GROUP BY year""", "stamped")

# --- log ------------------------------------------------------------------------------------------

_LISTED = """id, batch_name, CAST(batch_date AS VARCHAR) AS batch_date, geo_type, geo_scope, geo_year, census_year, year, r_type"""
SQL["log_rows"] = _with(f"SELECT {_LISTED} FROM log", "log")
SQL["pending_batches"] = _with(
    """SELECT DISTINCT batch_name, CAST(batch_date AS VARCHAR) AS batch_date FROM log WHERE load_ref_datetime IS NULL
AND CAST(year AS INTEGER) >= 1997 AND census_year = '2020' AND file_loc <> 'ref' AND geo_type IN ('blk', 'scd')""", "log")
SQL["pending_table_batches"] = _with(
    """SELECT DISTINCT batch_name, CAST(batch_date AS VARCHAR) AS batch_date FROM log WHERE load_ref_datetime IS NULL
AND file_loc = 'ref'""", "log")
SQL["pending_folders"] = _with(
    """SELECT replace(replace(file_loc, 'https://store', ''), '/pop/', '') AS folder FROM
(SELECT DISTINCT file_loc FROM log WHERE load_ref_datetime IS NULL AND batch_name = '19980401census2020')""", "log")
SQL["pending_files"] = _with(
    f"""SELECT {_LISTED}, qa_rows_file, qa_pop_file, file_name, file_loc FROM log WHERE load_ref_datetime IS NULL
AND census_year = '2020' AND CAST(year AS INTEGER) >= 1996 AND r_type = 97
AND (file_loc LIKE '%csv_1996/%' OR file_loc LIKE '%csv_1998/%')""", "log")

_FILE_KEY = ["batch_name", "file_name", "geo_type", "geo_scope", "geo_year", "year", "r_type", "census_year"]
_SAME_FILE = " AND ".join(f"v.{c} IS NOT DISTINCT FROM i.{c}" for c in _FILE_KEY)
SQL["file_status"] = _with(
    f"""SELECT i.batch_name, i.file_loc, i.year, i.r_type, CAST(COALESCE(
  (SELECT MAX(v.id) FROM versions v WHERE {_SAME_FILE} AND v.file_loc = i.file_loc AND v.load_ref_datetime IS NULL),
  (SELECT -MAX(v.id) FROM versions v WHERE {_SAME_FILE} AND v.file_loc = i.file_loc AND v.load_ref_datetime IS NOT NULL),
  CASE WHEN k.n >= 2 AND k.oldest > i.batch_date THEN -9999 END, 0) AS BIGINT) AS status
FROM incoming i LEFT JOIN kept k ON (k.geo_type, k.geo_scope, k.geo_year, k.year, k.r_type, k.census_year)
  = (i.geo_type, i.geo_scope, i.geo_year, i.year, i.r_type, i.census_year)""",
    "versions", "incoming",
    kept="""SELECT geo_type, geo_scope, geo_year, year, r_type, census_year, COUNT(*) AS n, MIN(batch_date) AS oldest
FROM versions WHERE load_archive_datetime IS NOT NULL AND delete_archive_datetime IS NULL AND geo_scope IS NOT NULL GROUP BY ALL""")
_ENTRY = ["id", "batch_name", "CAST(batch_date AS VARCHAR) AS batch_date", "file_name", "file_loc", "geo_type", "geo_scope",
          "geo_year", "census_year", "year", "r_type", "qa_rows_file", "qa_pop_file", "touched AS last_update_datetime"]

def _upserted(files):
    return f"""SELECT v.id, v.batch_name, COALESCE(i.batch_date, v.batch_date) AS batch_date, v.file_name,
       COALESCE(i.file_loc, v.file_loc) AS file_loc, v.geo_type, v.geo_scope, v.geo_year, v.census_year, v.year, v.r_type,
       COALESCE(i.rows_file, v.qa_rows_file) AS qa_rows_file, COALESCE(i.pop_file, v.qa_pop_file) AS qa_pop_file,
       CASE WHEN i.batch_name IS NULL THEN CAST(v.last_update_datetime AS VARCHAR) ELSE '2024-01-02 00:00:00' END AS touched
FROM versions v LEFT JOIN {files} i ON {_SAME_FILE}
UNION ALL
SELECT (SELECT MAX(id) FROM versions) + row_number() OVER (ORDER BY {', '.join(f'i.{c} NULLS FIRST' for c in _FILE_KEY)}),
       i.batch_name, i.batch_date, i.file_name, i.file_loc, i.geo_type, i.geo_scope, i.geo_year, i.census_year, i.year,
       i.r_type, i.rows_file, round(i.pop_file, 0), '2024-01-02 00:00:00'
FROM {files} i WHERE NOT EXISTS (SELECT 1 FROM versions v WHERE {_SAME_FILE})"""


SQL["upserted_log"] = _with(f"SELECT {', '.join(_ENTRY)} FROM ({_upserted('incoming')})", "versions", "incoming")
SQL["upserted_log_blocks"] = _with(
    f"""SELECT {', '.join(_ENTRY)}, (id - 1) // 1000 IN (SELECT (id - 1) // 1000 FROM after WHERE touched = '2024-01-02 00:00:00')
  AS rewritten FROM after""", "versions", "incoming",
    delivery="SELECT * FROM incoming WHERE batch_date = (SELECT MAX(batch_date) FROM incoming)", after=_upserted("delivery"))

_LAST = """MAX(l_shipdate) FILTER (l_linenumber {test})"""
_DAY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS DOUBLE)"
SQL["log_events"] = _with(
    f"""SELECT id, CAST(COALESCE(e.loaded, load_ref_datetime) AS VARCHAR) AS load_ref_datetime,
CAST(COALESCE(e.deleted, delete_ref_datetime) AS VARCHAR) AS delete_ref_datetime,
CAST(COALESCE(e.archived, load_archive_datetime) AS VARCHAR) AS load_archive_datetime,
COALESCE(CAST({_DAY.format(d='e.counted')} AS BIGINT), qa_rows_file) AS qa_rows_file,
COALESCE({_DAY.format(d='e.totalled')}, qa_pop_file) AS qa_pop_file,
CAST(COALESCE(greatest(e.loaded, e.deleted, e.archived), last_update_datetime) AS VARCHAR) AS last_update_datetime
FROM log LEFT JOIN (SELECT l_orderkey, {_LAST.format(test='= 1')} AS loaded, {_LAST.format(test='= 2')} AS deleted,
  {_LAST.format(test='= 3')} AS counted, {_LAST.format(test='= 4')} AS totalled, {_LAST.format(test='> 4')} AS archived
  FROM lineitem GROUP BY l_orderkey) e ON e.l_orderkey = log.id""", "log")
SQL["log_notes"] = _with(
    """SELECT id, CASE WHEN n.added IS NULL THEN etl_notes ELSE COALESCE(etl_notes, '') || n.added END AS etl_notes,
CAST(COALESCE(n.touched, last_update_datetime) AS VARCHAR) AS last_update_datetime
FROM log LEFT JOIN (SELECT l_orderkey, string_agg(note, '' ORDER BY l_linenumber, note) AS added, MAX(l_shipdate) AS touched
  FROM (SELECT *, l_returnflag || ' ' || l_linestatus || ' (' || CAST(l_shipdate AS VARCHAR) || ');' AS note FROM lineitem)
  GROUP BY l_orderkey) n ON n.l_orderkey = log.id""", "log")

SQL["stamped_log_blocks"] = _with(
    """SELECT id, CAST(COALESCE(touched, load_archive_datetime) AS VARCHAR) AS load_archive_datetime,
CASE WHEN added IS NULL THEN etl_notes ELSE COALESCE(etl_notes, '') || added END AS etl_notes,
CAST(COALESCE(touched, last_update_datetime) AS VARCHAR) AS last_update_datetime,
(id - 1) // 1000 IN (SELECT (l_orderkey - 1) // 1000 FROM last) AS rewritten
FROM log LEFT JOIN (SELECT l_orderkey, string_agg(note, '' ORDER BY l_linenumber, note) AS added, MAX(l_shipdate) AS touched
  FROM last GROUP BY l_orderkey) n ON n.l_orderkey = log.id""", "log",
    last="""SELECT *, l_returnflag || ' ' || l_linestatus || ' (' || CAST(l_shipdate AS VARCHAR) || ');' AS note
  FROM lineitem WHERE l_shipdate = (SELECT MAX(l_shipdate) FROM lineitem)""")

# --- archive --------------------------------------------------------------------------------------

_IN_REF = "load_archive_datetime IS NULL AND load_ref_datetime IS NOT NULL"
_SERIES = ["geo_type", "geo_year", "census_year", "r_type", "year"]
_ON = "USING ({})".format(", ".join(_SERIES))
_SPANS = f"""SELECT {', '.join(_SERIES)}, MIN(batch_date) AS oldest, MAX(batch_date) AS newest, COUNT(*) AS n
FROM versions WHERE {_IN_REF} GROUP BY {', '.join(_SERIES)}, geo_scope"""
_ARCHIVE_LIST = f"""SELECT old.id AS archive_id, MAX(new.id) AS ref_id, r_type
FROM versions old JOIN spans {_ON} JOIN versions new {_ON}
WHERE spans.n > 1 AND old.batch_date = spans.oldest AND new.batch_date = spans.newest GROUP BY old.id, r_type"""
SQL["archive_list"] = _with(_ARCHIVE_LIST, "versions", spans=_SPANS)
SQL["direct_archive_list"] = _with(
    f"""SELECT old.id AS archive_id, arg_max(new.id, (new.batch_date, new.id)) AS ref_id, r_type
FROM versions old JOIN spans {_ON} JOIN versions new {_ON}
WHERE old.batch_date < spans.newest AND new.batch_date = spans.newest
AND old.load_ref_datetime IS NULL AND old.load_archive_datetime IS NULL GROUP BY old.id, r_type""", "versions", spans=_SPANS)
_KEPT = "load_archive_datetime IS NOT NULL AND delete_archive_datetime IS NULL"
_SCOPED = ", ".join([*_SERIES, "geo_scope"])
SQL["prune_list"] = _with(
    f"""SELECT id, r_type FROM versions JOIN (SELECT {_SCOPED}, MIN(batch_date) AS batch_date FROM versions WHERE {_KEPT}
GROUP BY {_SCOPED} HAVING COUNT(*) > 1) USING ({_SCOPED}, batch_date)""", "versions")
SQL["prune_list_exhausted"] = _with(
    f"""SELECT id, r_type FROM (SELECT *, rank() OVER (PARTITION BY {_SCOPED} ORDER BY batch_date DESC) AS place FROM versions
WHERE {_KEPT} AND geo_scope IS NOT NULL) WHERE place > 1""", "versions")
SQL["archive_split"] = _with(
    """SELECT etl_batch_id, CASE WHEN etl_batch_id IN (SELECT archive_id FROM old) THEN 'archive' ELSE 'ref' END AS place,
COUNT(*) AS n, CAST(SUM(pop) AS DOUBLE) AS pop FROM facts GROUP BY ALL""", "versions", "facts", spans=_SPANS, old=_ARCHIVE_LIST)
SQL["archive_moved"] = _with(
    """SELECT CAST(etl_batch_id AS BIGINT) AS etl_batch_id, CASE WHEN etl_batch_id % 10 = 1 THEN 'archive' ELSE 'ref' END AS place,
COUNT(*) AS n, CAST(SUM(pop) AS DOUBLE) AS pop FROM stamped GROUP BY ALL""", "stamped")

SQL["batches_moved_and_pruned"] = _with(
    """SELECT CASE WHEN etl_batch_id % 10 = 1 THEN 'archive_ref' ELSE 'ref' END AS dataset,
CAST(etl_batch_id AS BIGINT) AS etl_batch_id, geo_type, COUNT(*) AS n, COUNT(DISTINCT geo_id) AS n_geo, CAST(SUM(pop) AS DOUBLE) AS pop
FROM stamped WHERE etl_batch_id % 20 <> 1 AND (etl_batch_id % 100 <> 2 OR geo_type = 'blk') GROUP BY ALL""", "stamped")
SQL["replaced_batch_stamp"] = _with(
    """SELECT id, CASE WHEN id = (SELECT MIN(etl_batch_id) FROM facts) THEN '2024-11-05 12:00:00'
ELSE CAST(delete_ref_datetime AS VARCHAR) END AS delete_ref_datetime, CAST(load_ref_datetime AS VARCHAR) AS load_ref_datetime
FROM log""", "log", "facts")

# --- quality --------------------------------------------------------------------------------------

SQL["totals"] = _with(
    """SELECT CAST(etl_batch_id AS BIGINT) AS etl_batch_id, COUNT(pop) AS row_cnt, CAST(round(SUM(pop), 0) AS DOUBLE) AS pop_tot
FROM stamped WHERE pop IS NOT NULL GROUP BY etl_batch_id""", "stamped")
SQL["reconciled"] = _with(
    f"""SELECT *, rows_raw = rows_file AND pop_raw = round(pop_file, 0) AS raw_ok,
rows_stage = rows_file AND pop_stage = round(pop_file, 0) AS stage_ok, rows_ref = rows_file AND pop_ref = round(pop_file, 0) AS ref_ok
FROM (SELECT CAST(etl_batch_id AS BIGINT) AS etl_batch_id, COUNT(*) AS rows_file, CAST(SUM(pop) AS DOUBLE) AS pop_file,
  COUNT(pop) AS rows_raw, CAST(round(SUM(pop), 0) AS DOUBLE) AS pop_raw, COUNT(pop) AS rows_stage,
  CAST(round(SUM(pop), 0) AS DOUBLE) AS pop_stage, COUNT(pop) FILTER (inside) AS rows_ref,
  CAST(round(SUM(pop) FILTER (inside), 0) AS DOUBLE) AS pop_ref
  FROM (SELECT *, substring(geo_id, 4, 2) IN ({_COUNTY_LIST}) AS inside FROM stamped) GROUP BY etl_batch_id)""", "stamped")

_QA_ROWS = f"""SELECT padded.*, CASE WHEN geo_scope = 'kps' THEN substring(geo_id, 4, 2) END AS fips_co,
{', '.join(f"COALESCE(coded.{c}, 0) AS {c}" if c in RACE_FLAGS else f"coded.{c} AS {c}" for c in _NEW_COLUMNS)}
FROM {_cascade_join('padded', 'coded')} WHERE pop IS NOT NULL"""
_SHARED_POP = "CASE WHEN substring(geo_id, 4, 2) = '77' THEN pop ELSE pop * CAST(0.97 AS DECIMAL(3,2)) END"


def _long(pop):
    return "\nUNION ALL ".join(
        f"SELECT {', '.join(QA_KEYS)}, '{c}' AS col, CAST({c} AS SMALLINT) AS val, SUM({pop}) AS pop FROM qa "
        f"WHERE {c} IS NOT NULL GROUP BY ALL" for c in QA_COLUMNS)


_QA = {"padded": _PADDED, "ranked": _ranked("first"), "coded": _cascaded("first"), "qa": _QA_ROWS}
SQL["quality_long"] = _with(f"SELECT * REPLACE (CAST(pop AS DOUBLE) AS pop) FROM ({_long('pop')})", "stamped", "rules", **_QA)


def _compared(year, geo_year):
    keys = [*QA_KEYS, "col", "val"]
    return f"""SELECT *, round_even(diff / ref_pop, 4) AS perc FROM (
SELECT {', '.join(f'a.{k}' for k in keys)}, CAST(a.pop AS DOUBLE) AS raw_pop, CAST(b.pop AS DOUBLE) AS ref_pop,
  round_even(CAST(a.pop - b.pop AS DOUBLE), 6) AS diff
FROM a JOIN (SELECT * REPLACE ({year} AS year, {geo_year} AS geo_year) FROM b) b USING ({', '.join(keys)}))"""


SQL["quality_against_current"] = _with(_compared("year", "geo_year"), "stamped", "rules", **_QA, a=_long("pop"),
                                       b=_long(_SHARED_POP))
SQL["quality_against_previous"] = _with(
    _compared("CAST(CAST(year AS INTEGER) + 1 AS VARCHAR)",
              "CASE WHEN geo_type = 'zip' THEN CAST(CAST(geo_year AS INTEGER) + 1 AS VARCHAR) ELSE geo_year END"),
    "stamped", "rules", **_QA, a=_long("pop"), b=_long(_SHARED_POP))
SQL["quality_run"] = SQL["quality_long"]
SQL["quality_refreshed"] = _with(
    f"""SELECT * REPLACE (CAST(pop AS DOUBLE) AS pop) FROM ({_long(f"CASE WHEN etl_batch_id % 10 = 2 THEN {_SHARED_POP} ELSE pop END")})""",
    "stamped", "rules", **{**_QA, "qa": f"SELECT * FROM ({_QA_ROWS}) WHERE etl_batch_id % 20 <> 1"})
SQL["quality_report"] = _with(
    f"""SELECT 'raw_vs_current_year' AS comparison, * FROM ({_compared("year", "geo_year")})
UNION ALL SELECT 'raw_vs_previous_year', * FROM ({_compared("CAST(CAST(year AS INTEGER) + 1 AS VARCHAR)",
    "CASE WHEN geo_type = 'zip' THEN CAST(CAST(geo_year AS INTEGER) + 1 AS VARCHAR) ELSE geo_year END")})""",
    "stamped", "rules", **_QA, a=_long("pop"), b=_long(_SHARED_POP))
SQL["resume"] = _with(
    """SELECT v.id AS etl_batch_id, COALESCE(l.n, 0) AS rows_loaded FROM versions v
LEFT JOIN (SELECT etl_batch_id, COUNT(*) AS n FROM facts GROUP BY ALL) l ON l.etl_batch_id = v.id""", "versions", "facts")
