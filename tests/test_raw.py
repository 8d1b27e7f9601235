"""Raw files, header discovery, roles, cleaning and manifest on hand-made inputs."""

import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import rows_of
from tallyfold.functions import batch_date, contains_any, pad_code, parse_age, remove_first, scope_filter, top_code, zero_fill
from tallyfold.operators.clean import (
    align_columns, column_roles, drop_header_rows, roles_from_names, route_by_scheme, strip_cells, valid_facts,
)
from tallyfold.plans.intake import data_rows, typed_rows
from tallyfold.sources.manifest import file_manifest, list_files, locate_files, profile_files
from tallyfold.sources.raw import detect_header, read_raw, read_table_batches, read_table_source, survey_files

LINES_97 = [
    "2020,530330001001000,034,1,10000,0,1.5",
    "Year,BlockCode,AgeStr,Gender,RaceMars97,Hispanic,Pop",
    "2020,530330001001000,105,2,01000,1,0.25  ",
    "2020,530770001001000,85+,2,1000,1,",
    "Year,BlockCode,AgeStr,Gender,RaceMars97,Hispanic,Pop",
    "2020,530530001001000,001,1,10000,0,many",
    ",530530001001000,001,1,10000,0,4",
    "2020,bad",
]
LINES_77 = ["POP,HISPANIC,RACE,GENDER,AGE,ZIP,YEAR", "7,0,1,2,044,98101,2019"]


def write_gz(path, lines, end="\r\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", newline="") as out:
        out.write("".join(line + end for line in lines))
    return str(path)


@pytest.fixture
def files(tmp_path):
    return [write_gz(tmp_path / "BlockCode2020RaceMars972020.csv.gz", LINES_97),
            write_gz(tmp_path / "Zip2019RaceMars772019.csv.gz", LINES_77, "\n")]


def test_roles_follow_the_header_of_each_file(spark, files):
    roles = column_roles(detect_header(read_raw(spark, files)))
    names = roles.withColumn("file", F.element_at(F.split("file", "/"), -1))
    got = {}
    for file, position, role in rows_of(names, "file", "position", "role"):
        got.setdefault(file, []).append(role)
    assert got == {
        "BlockCode2020RaceMars972020.csv.gz": [
            "year", "geo_id", "raw_agestr", "raw_gender", "raw_racemars", "raw_hispanic", "pop"],
        "Zip2019RaceMars772019.csv.gz": [
            "pop", "raw_hispanic", "raw_racemars", "raw_gender", "raw_agestr", "geo_id", "year"]}


def test_typed_rows(spark, files):
    raw = read_raw(spark, files)
    rows = typed_rows(raw, survey_files(raw))
    assert rows_of(rows, "year", "geo_id", "raw_agestr", "raw_racemars", "pop") == [
        ("2019", "98101", "044", "1", 7.0),
        ("2020", "530330001001000", "034", "10000", 1.5),
        ("2020", "530330001001000", "105", "01000", 0.25),
        ("2020", "530530001001000", "001", "10000", None),
        ("2020", "530770001001000", "85+", "1000", None)]
    profile = profile_files(data_rows(raw, survey_files(raw))).withColumn("file", F.element_at(F.split("file", "/"), -1))
    assert rows_of(profile, "file", "rows_file", "pop_file") == [
        ("BlockCode2020RaceMars972020.csv.gz", 5, 5.75), ("Zip2019RaceMars772019.csv.gz", 1, 7.0)]


def test_error_limit(spark, files):
    assert read_raw(spark, files, max_errors=1).count() == 9
    with pytest.raises(ValueError, match="too many bad records"):
        read_raw(spark, files, max_errors=0)
    with pytest.raises(ValueError):
        read_raw(spark, files, first_row=3)


def test_first_row_two_skips_the_header(spark, files):
    assert rows_of(read_raw(spark, files[1], first_row=2), "col1", "col6") == [("7", "98101")]


def test_other_separators_and_formats(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('1;"x;y";3;4;5;6;7\n')
    assert rows_of(read_raw(spark, str(path), sep=";", quote='"'), "col2") == [("x;y",)]
    frame = spark.createDataFrame([(1, "b", 2.5, 4, 5, 6, 7)], "a int, b string, c double, d int, e int, f int, g int")
    for fmt in ("parquet", "orc"):
        frame.write.format(fmt).save(str(tmp_path / fmt))
        assert rows_of(read_raw(spark, str(tmp_path / fmt), fmt=fmt), "col1", "col2", "col3") == [("1", "b", "2.5")]


def test_strip_and_drop(spark):
    cells = [f"col{i}" for i in range(1, 8)]
    rows = spark.createDataFrame([("a\r ", " b", "c", "d", "e", "f", "g"), ("Year", *"bcdefg"), (None, *"bcdefg")],
                                 ", ".join(f"{c} string" for c in cells))
    assert rows_of(strip_cells(drop_header_rows(rows)), "col1", "col2") == [("a", " b")]


def test_roles_from_names():
    names = ["Year", "Pop", "RaceMars97", "AgeStr", "BlockCode2020", "Gender", "Hispanic", "Zip"]
    assert list(roles_from_names(names, "zip").values()) == [
        "year", "pop", "raw_racemars", "raw_agestr", "geo_id", "raw_gender", "raw_hispanic", "geo_id"]


def test_manifest(spark, tmp_path):
    for name in ("b1/x/BlockCode2020RaceMars972020.csv.gz", "b1/ZIP2010racemars771999.csv", "b1/Oddname2020.csv"):
        write_gz(tmp_path / name, ["x"])
    found = file_manifest(list_files(spark, str(tmp_path)).selectExpr("regexp_replace(file_path, '^file:/+', '/') AS file_path"))
    assert rows_of(found, "file_name", "geo_type", "geo_scope", "geo_year", "year", "r_type") == [
        ("BlockCode2020RaceMars972020.csv.gz", "blk", "kps", "2020", "2020", 97),
        ("Oddname2020.csv", None, None, None, "2020", None),
        ("ZIP2010racemars771999.csv", "zip", "wa", "2010", "1999", 77)]
    placed = locate_files(found, base_url="u:", base_path="/p", final_folder=str(tmp_path))
    assert rows_of(placed, "file_name", "batch_name", "file_loc") == [
        ("BlockCode2020RaceMars972020.csv.gz", "b1", "u:/p/b1/x/"), ("Oddname2020.csv.gz", "b1", "u:/p/b1/"),
        ("ZIP2010racemars771999.csv.gz", "b1", "u:/p/b1/")]
    named = locate_files(found, batch_name="20241018census2020", base_path="/p", extract_folder=str(tmp_path))
    assert rows_of(named, "file_loc", "batch_date")[0] == ("/p/20241018census2020/b1/", __import__("datetime").date(2024, 10, 18))


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


@pytest.mark.parametrize("name,expected", [
    ("20241018census2020", "2024-10-18"), ("2019final", "2019-01-01"), ("20191340x", None)])
def test_batch_date(spark, name, expected):
    assert str(one(spark, name).select(batch_date("x")).first()[0]) == str(expected)


def test_small_functions(spark):
    assert one(spark, "a.b.a.b").select(remove_first("x", "a.b")).first()[0] == ".a.b"
    assert one(spark, "axb").select(remove_first("x", "a.b")).first()[0] == "axb"
    assert one(spark, "ab").select(remove_first("x", "")).first()[0] == "ab"
    assert one(spark, None).select(contains_any("x", ["a"])).first()[0] is None
    assert one(spark, "q").select(contains_any("x", [])).first()[0] is True
    assert [one(spark, v).select(parse_age("x")).first()[0] for v in ("034 x", "85+", None)] == [34, None, None]
    assert [one(spark, v, "smallint").select(top_code("x")).first()[0] for v in (100, 101, None)] == [100, 100, None]
    pads = [("1000", 97), ("1234567", 97), ("1", 77), (None, 97)]
    assert [one(spark, c).select(pad_code("x", F.lit(r))).first()[0] for c, r in pads] == ["01000", "1234567", "1", None]


def test_filters_and_fills(spark):
    rows = spark.createDataFrame([("5303300", "kps"), ("533A300", "kps"), ("5307700", "kps"), ("98101", "wa"), ("98101", None)],
                                 "geo_id string, geo_scope string")
    assert scope_filter(rows).count() == 1
    assert scope_filter(rows, scope_column="geo_scope").count() == 3
    mixed = spark.createDataFrame([(None, None, 1.5)], "a int, b string, c double")
    assert rows_of(zero_fill(mixed, every=True)) == [(0, "0", 1.5)]
    assert rows_of(zero_fill(mixed, ["a"])) == [(0, None, 1.5)]
    facts = spark.createDataFrame([(1, 2.0, 77), (1, None, 97), (None, 1.0, 97), (2, 1.0, None)],
                                  "etl_batch_id int, pop double, r_type smallint")
    assert valid_facts(facts).count() == 2 and valid_facts(facts, [2], F.col("pop") > 5).count() == 0
    parts = route_by_scheme(facts, "pop")
    assert {k: v.count() for k, v in parts.items()} == {"pop": 3, "pop_77": 1}


def test_align_columns(spark):
    target = T.StructType([T.StructField("B", T.IntegerType()), T.StructField("c", T.StringType())])
    rows = spark.createDataFrame([("7", 1), (None, 2)], "b string, other int")
    assert align_columns(rows, target).columns == ["B"]
    assert rows_of(align_columns(rows, target, add_missing=True)) == [(None, None), (7, None)]


def test_table_source(spark):
    table = spark.createDataFrame([("530330", 1.0, "5", "1", 1000, "0", 2020), ("530330", 1.0, "5", "1", 123456, "0", 2019)],
                                  "Block2020 string, Pop double, AgeGroup string, Gender string, RaceMars97 int, Hispanic string, Year int")
    info = {"id": 3, "geo_type": "blk", "geo_scope": "kps", "geo_year": "2020", "census_year": "2020", "year": "2020", "r_type": 97}
    assert rows_of(read_table_source(table, info), "etl_batch_id", "geo_id", "raw_racemars", "fips_co") == [(3, "530330", "01000", "33")]
    other = read_table_source(table.withColumn("County", F.lit("033")), {**info, "geo_scope": "wa"})
    assert rows_of(other, "geo_id", "fips_co") == [("033", None)]
    with pytest.raises(ValueError):
        read_table_source(table.drop("Block2020"), info)


def test_table_batches_read_their_years_in_one_scan(spark, tmp_path):
    years = spark.createDataFrame(
        [("530330", 1.0, "5", "1", 1000, "0", year) for year in (2018, 2019, 2020, None)],
        "Block2020 string, Pop double, AgeGroup string, Gender string, RaceMars97 int, Hispanic string, Year int")
    years.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    batches = spark.createDataFrame(
        [(1, "blk", "kps", "2020", "2020", 97, "2020"), (2, "blk", None, "2020", "2020", 97, "2019"),
         (3, "blk", "kps", "2020", "2020", 97, "1999"), (4, "blk", "kps", "2020", "2020", 97, None)],
        "id long, geo_type string, geo_scope string, geo_year string, census_year string, r_type smallint, year string")
    found = read_table_batches(table, batches)
    assert rows_of(found, "etl_batch_id", "year", "raw_racemars", "fips_co") == [(1, "2020", "01000", "33"), (2, "2019", "01000", None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(Year" in plan and plan.count("FileScan") == 1


def test_other_formats_need_seven_columns(spark, tmp_path):
    spark.range(3).selectExpr(*[f"id AS c{k}" for k in range(9)]).write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="9 columns"):
        read_raw(spark, str(tmp_path / "p"), fmt="parquet")


def test_values_that_do_not_fit_raise(spark):
    target = T.StructType([T.StructField("r_type", T.ShortType())])
    with pytest.raises(Exception, match="CAST"):
        align_columns(spark.createDataFrame([(70000,)], "r_type int"), target).collect()
