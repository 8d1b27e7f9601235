"""Recodes against row-by-row application of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from catalog.shapes import rules
from frames import rows_of
from tallyfold.operators.recode import (
    attach_area, code_book, fill_defaults, overlapping, recode_cascade, recode_facts, recode_join, recode_override,
)
from tallyfold.schema import AGE_BANDS, RACE_FLAGS, RULE_SCHEMA

FACTS = "id int, raw_agestr string, raw_gender string, raw_racemars string, raw_hispanic string, r_type smallint, pop double"


def facts(spark, n=400, seed=7):
    rng = random.Random(seed)
    ages = ["000", "017", "041", "060", "064", "065", "099", "100", "105", "120", "121", "85+", "", None, "034 yrs"]
    races = ["10000", "01000", "00100", "11000", "10100", "99999", None]
    rows = [(i, rng.choice(ages), rng.choice(["1", "2", "3", None]), rng.choice(races),
             rng.choice(["0", "1", "9", None]), rng.choice([77, 97]), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, FACTS)


def parse(text):
    try:
        return int((text or "x")[:3])
    except ValueError:
        return None


def hits(rule_rows, old, new, code, scheme=None, is_range=False):
    """Values of all rules of one recode that match a code."""
    out = []
    for r in rule_rows:
        if (r.old_column, r.new_column) != (old, new) or (scheme is not None and r.r_type != scheme):
            continue
        if code is None:
            continue
        if is_range:
            if r.old_value_num_min <= code <= r.old_value_num_max:
                out.append(r.new_value_num)
        elif r.old_value_txt == code:
            out.append(r.new_value_num)
    return out


def brute_force(rule_rows, f):
    """All output rows of the join form for one fact."""
    out = [{}]

    def cross(name, values, optional=False):
        nonlocal out
        values = values or ([None] if optional else [])
        out = [{**row, name: v} for row in out for v in values]

    age = parse(f.raw_agestr)
    for band in AGE_BANDS:
        cross(band, hits(rule_rows, "age", band, age, is_range=True))
    cross("gender", hits(rule_rows, "raw_gender", "gender", f.raw_gender))
    cross("rcode", hits(rule_rows, "raw_racemars", "rcode", f.raw_racemars, f.r_type))
    out = [{**row, "r1r3": v} for row in out
           for v in hits(rule_rows, "rcode", "r1r3", row["rcode"], f.r_type, is_range=True)]
    out = [{**row, "base": v} for row in out
           for v in hits(rule_rows, "rcode", "r2r4", row["rcode"], f.r_type, is_range=True)]
    cross("over", hits(rule_rows, "raw_hispanic", "r2r4", f.raw_hispanic, f.r_type), optional=True)
    for flag in RACE_FLAGS[:-1]:
        cross(flag, hits(rule_rows, "raw_racemars", flag, f.raw_racemars, f.r_type), optional=True)
    cross("race_hisp", hits(rule_rows, "raw_hispanic", "race_hisp", f.raw_hispanic), optional=True)
    return [(f.id, age, *[row[b] for b in AGE_BANDS], min(age, 100), row["gender"],
             *[row[flag] or 0 for flag in RACE_FLAGS], row["rcode"], row["r1r3"],
             row["base"] if row["over"] is None else row["over"]) for row in out]


def all_by_brute_force(book, rows):
    rule_rows = book.collect()
    return sorted(x for f in rows.collect() for x in brute_force(rule_rows, f))


RECODED = ["age", *AGE_BANDS, "age_100", "gender", *RACE_FLAGS, "rcode", "r1r3", "r2r4"]


@pytest.mark.parametrize("overlap", [False, True])
def test_recode_facts_keeps_drops_and_fan_out(spark, overlap):
    book, rows = rules(spark, overlap), facts(spark)
    expected = all_by_brute_force(book, rows)
    assert expected
    assert rows_of(recode_facts(rows, book), "id", *RECODED) == expected
    assert code_book(book).fans_out is overlap


def test_large_rule_table_stays_distributed(spark, monkeypatch):
    from tallyfold.operators import sizing
    monkeypatch.setattr(sizing, "CONTROL_ROWS", 5)
    book, rows = rules(spark, False), facts(spark, 100)
    expected = all_by_brute_force(book, rows)
    assert not code_book(book).fans_out and code_book(rules(spark, True)).fans_out
    assert rows_of(recode_facts(rows, book), "id", *RECODED) == expected


def test_overlaps_are_found_by_a_sweep(spark):
    def n(*rows):
        return overlapping(spark.createDataFrame([(*r, 1, None, s) for *r, s in rows], "old_column string, old_value_txt string, "
                           "old_value_num_min int, old_value_num_max int, new_column string, new_value_num int, "
                           "new_value_txt string, r_type smallint")).count()
    assert n(("age", None, 0, 9, "age_5", None), ("age", None, 10, 12, "age_5", None), ("age", None, 5, 7, "age_11", None)) == 0
    # The second range ends before the third begins, the first does not.
    assert n(("age", None, 0, 90, "age_5", None), ("age", None, 91, 92, "age_5", 77), ("age", None, 3, 4, "age_5", 97)) == 1
    assert n(("raw_gender", "1", None, None, "gender", 77), ("raw_gender", "1", None, None, "gender", 97)) == 1
    assert n(("raw_racemars", "1", None, None, "rcode", 77), ("raw_racemars", "1", None, None, "rcode", 97)) == 0
    assert n(("other", "1", None, None, "x", 77), ("other", "1", None, None, "x", 77)) == 0
    assert overlapping(rules(spark, True)).count() == 5 and overlapping(rules(spark, False)).count() == 0


@pytest.mark.parametrize("policy", ["first", "last"])
def test_cascade_without_held_winners_gives_the_same(spark, policy, monkeypatch):
    from tallyfold.operators import recode
    rows = facts(spark).withColumn("age", F.substring("raw_agestr", 1, 3).try_cast("smallint"))
    held = rows_of(recode_cascade(rows, rules(spark, True), policy=policy), "id", *NEW)
    monkeypatch.setattr(recode, "_held_winners", lambda *_: {})
    assert rows_of(recode_cascade(rows, rules(spark, True), policy=policy), "id", *NEW) == held


def test_plain_values_are_kept_apart(spark):
    row = spark.createDataFrame([(1, "030", "1", "10000", "1", 97, 1.0)], FACTS)
    plain = recode_facts(row, rules(spark, False), defaults=False)
    assert rows_of(plain, "race_blk", "r2r4_base", "r2r4_override") == [(None, 1, 6)]
    assert rows_of(fill_defaults(plain), "race_blk", "r2r4") == [(0, 6)]


def rule(spark, *rows):
    return spark.createDataFrame([(*r, None)[:8] if len(r) == 7 else r for r in rows], RULE_SCHEMA)


def test_wide_ranges_and_fractions(spark):
    book = rule(spark, ("x", None, 0, 2_000_000_000, "y", 1, None, None), ("x", None, 5, 5, "y", 2, None, None),
                ("x", None, 9, 3, "y", 3, None, None))
    values = spark.createDataFrame([(4.5,), (5.0,), (-0.5,), (2e9,), (2.1e9,), (None,)], "x double")
    assert rows_of(recode_join(values, book, "x", "y", kind="range")) == [(4.5, 1), (5.0, 1), (5.0, 2), (2e9, 1)]
    text = spark.createDataFrame([("5",), ("five",), (None,)], "x string")
    left = recode_join(text, book, "x", "y", kind="range", how="left", default=0)
    assert rows_of(left) == [(None, 0), ("5", 1), ("5", 2), ("five", 0)]


def test_override_wins(spark):
    book = rule(spark, ("raw_hispanic", "1", None, None, "r2r4", 6, None, 97))
    rows = spark.createDataFrame([("1", 97, 3), ("1", 77, 3), (None, 97, 3)], "raw_hispanic string, r_type smallint, r2r4 smallint")
    assert rows_of(recode_override(rows, book, "raw_hispanic", "r2r4", "r2r4"), "raw_hispanic", "r_type", "r2r4") == [
        (None, 97, 3), ("1", 77, 3), ("1", 97, 6)]


def test_shuffle_join_gives_the_same(spark, shuffle_only):
    book, rows = rules(spark, True), facts(spark)
    expected = all_by_brute_force(book, rows)
    assert rows_of(recode_facts(rows, book), "id", *RECODED) == expected


def apply_in_order(rule_rows, row, policy, overrides=("raw_hispanic",)):
    """The cascades as statements run one after another."""
    row = dict(row)
    tail = (lambda r: [(r.new_value_num is None, r.new_value_num or 0), (r.new_value_txt is None, r.new_value_txt or "")]) \
        if policy == "first" else (lambda r: [(r.old_value_txt is None, r.old_value_txt or ""),
                                              (r.old_value_num_min is None, r.old_value_num_min or 0)])
    ordered = sorted(rule_rows, key=tail)
    ordered = sorted(ordered, key=lambda r: r.old_column, reverse=True)
    ordered = sorted(ordered, key=lambda r: r.new_column, reverse=True)
    for r in ordered:
        row.setdefault(r.new_column, None)
        old = row.get(r.old_column)
        if old is None or (r.r_type is not None and r.r_type != row["r_type"]):
            continue
        if r.old_value_txt is not None:
            match = str(old) == r.old_value_txt
        else:
            match = r.old_value_num_min <= old <= r.old_value_num_max
        if not match or (policy == "first" and r.old_column not in overrides and row[r.new_column] is not None):
            continue
        row[r.new_column] = r.new_value_num
    return row


NEW = [*AGE_BANDS, "gender", *RACE_FLAGS, "rcode", "r1r3", "r2r4"]


@pytest.mark.parametrize("policy", ["first", "last"])
def test_cascade_equals_statements_in_order(spark, policy):
    rows = facts(spark).withColumn("age", F.substring("raw_agestr", 1, 3).try_cast("smallint"))
    book = rules(spark, True)
    rule_rows = book.collect()
    expected = [apply_in_order(rule_rows, r.asDict(), policy) for r in rows.collect()]
    got = recode_cascade(rows, book, policy=policy)
    assert rows_of(got, "id", *NEW) == sorted(
        (tuple(r[c] for c in ["id", *NEW]) for r in expected), key=lambda t: t[0])


def test_cascade_on_random_rules(spark):
    rng = random.Random(3)
    olds = ["a", "b", "n", "m"]
    news = ["z", "y", "b"]
    rule_rows = []
    for i in range(60):
        old, new = rng.choice(olds), rng.choice(news)
        scheme = rng.choice([None, 77, 97])
        if old in ("a", "b") and not (old == "b" and rng.random() < 0.5):
            rule_rows.append((old, rng.choice("pqr"), None, None, new, rng.choice([i, i, None]), None, scheme))
        elif old == "b":
            continue
        else:
            lo = rng.randint(0, 8000 if old == "m" else 9)
            rule_rows.append((old, None, lo, lo + rng.randint(0, 5), new, rng.choice([i, i, None]), None, scheme))
    book = spark.createDataFrame(rule_rows, RULE_SCHEMA)
    rows = spark.createDataFrame(
        [(i, rng.choice(["p", "q", None]), rng.randint(0, 12), rng.choice([1.5, 3.0, 8000.0]), rng.choice([77, 97, 50]))
         for i in range(200)], "id int, a string, n smallint, m double, r_type smallint")
    rule_rows = book.collect()
    for policy in ("first", "last"):
        expected = [apply_in_order(rule_rows, r.asDict(), policy, ("a",)) for r in rows.collect()]
        got = recode_cascade(rows, book, policy=policy, override_columns=("a",))
        assert rows_of(got, "id", "z", "y") == sorted(tuple(r[c] for c in ("id", "z", "y")) for r in expected)


def test_text_values_and_existing_columns(spark):
    book = rule(spark, ("k", "a", None, None, "v", 1, "one", None), ("k", "b", None, None, "v", None, "two", None),
                ("k", "it's", None, None, "w", 5, None, None))
    rows = spark.createDataFrame([("a", None), ("b", 9), ("it's", None)], "k string, w smallint")
    assert rows_of(recode_cascade(rows, book), "k", "v", "w") == [("a", "1", None), ("b", "two", 9), ("it's", None, 5)]
    assert rows_of(recode_cascade(rows, book, policy="last"), "k", "v", "w") == [
        ("a", "one", None), ("b", "two", 9), ("it's", None, 5)]
    with pytest.raises(ValueError):
        recode_cascade(rows, book, policy="best")


def test_rules_without_a_new_value(spark):
    book = rule(spark, ("k", "a", None, None, "v", 1, None, None), ("j", "a", None, None, "v", None, None, None),
                ("i", "a", None, None, "v", 3, None, None))
    rows = spark.createDataFrame([("x", "a", "a"), ("a", "a", "a"), ("x", "a", "x")], "i string, j string, k string")
    assert rows_of(recode_cascade(rows, book, policy="last"), "i", "k", "v") == [("a", "a", 3), ("x", "a", None), ("x", "x", None)]
    # The override takes the value away, what runs after it fills again.
    first = recode_cascade(rows, book, override_columns=("j",))
    assert rows_of(first, "i", "k", "v") == [("a", "a", 3), ("x", "a", None), ("x", "x", None)]


@pytest.mark.parametrize("policy", ["first", "last"])
def test_cascade_with_many_rules(spark, policy):
    book = spark.range(12_000).selectExpr(
        "IF(id % 2 = 0, 'code', 'number') AS old_column", "IF(id % 2 = 0, CAST(id AS STRING), NULL) AS old_value_txt",
        "IF(id % 2 = 1, CAST(id AS INT), NULL) AS old_value_num_min", "IF(id % 2 = 1, CAST(id + 4 AS INT), NULL) AS old_value_num_max",
        "'v' AS new_column", "CAST(id % 1000 AS INT) AS new_value_num", "CAST(NULL AS STRING) AS new_value_txt",
        "CAST(IF(id % 3 = 0, 77, NULL) AS SMALLINT) AS r_type")
    rows = spark.createDataFrame([(str(n), n, s) for n in (-5, 0, 7, 8, 3000, 11998, 20000) for s in (77, 97)],
                                 "code string, number int, r_type smallint")
    rule_rows = book.collect()
    expected = [apply_in_order([r for r in rule_rows if r.old_value_txt == str(n) or r.old_value_txt is None
                                and r.old_value_num_min <= n <= r.old_value_num_max], row.asDict(), policy)
                for row in rows.collect() for n in (row.number,)]
    got = recode_cascade(rows, book, policy=policy)
    assert rows_of(got, "number", "r_type", "v") == sorted(
        ((r["number"], r["r_type"], r.get("v")) for r in expected), key=lambda t: t[:2])


def test_cascade_equals_join_without_overlaps(spark):
    book = rules(spark, False)
    rows = facts(spark).withColumn("age", F.substring("raw_agestr", 1, 3).try_cast("smallint"))
    joined = rows_of(recode_facts(facts(spark), book), "id", *NEW)
    cascaded = recode_cascade(rows, book).fillna(0, RACE_FLAGS)
    complete = cascaded.where(" AND ".join(f"{c} IS NOT NULL" for c in [*AGE_BANDS, "gender", "rcode", "r1r3"]))
    assert rows_of(complete, "id", *NEW) == joined


def test_attach_area(spark):
    rows = spark.createDataFrame([("b1", 1), ("b2", 2)], "geo_id string, n int")
    areas = spark.createDataFrame([("2020", "b1", "h1"), ("2010", "b2", "h2")], "geo_year string, blk_geo_id string, hra_id string")
    assert rows_of(attach_area(rows, areas, "2020"), "geo_id", "n", "hra_id") == [("b1", 1, "h1"), ("b2", 2, None)]
