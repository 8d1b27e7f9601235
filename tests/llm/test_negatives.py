import math

import numpy as np
import pytest

from tallyfold.llm import negatives

KIND = "vec_id long, embedding array<double>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50):
    fine = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            one = (label, v)
            fine[i] = min(fine.get(i, one), one)
    q = {i: (label, [math.floor(256 * x) if abs(x) < 2 ** 60 else int(x) * 256 for x in v]) for i, (label, v) in fine.items()}
    out = []
    for a in q:
        if a % every == 0:
            told = sorted((-min(max(sum(x * y for x, y in zip(q[a][1], v)), -2 ** 63), 2 ** 63 - 1), i) for i, (_, v) in q.items() if i != a)
            for p, i in [x for x in told if q[x[1]][0] == q[a][0]][:5]:
                fits = [(s, j) for s, j in told if q[j][0] != q[a][0] and -50 * p <= -100 * s <= -95 * p]
                out += [(a, i, r, j, -p, -s) for r, (s, j) in enumerate(fits[:3], 1)]
    return sorted(out)


def check(spark, rows, **more):
    found = negatives.mine(spark.createDataFrame(rows, KIND).repartition(3), **more)
    assert found.columns == NAMES
    got = sorted(map(tuple, found.collect()))
    assert got == brute(rows, more.get("every", 50))
    return got


def random_rows(n, dims, labels=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) + 0.3
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(k, [float(v) for v in row], int(rng.integers(labels))) for k, row in enumerate(x)]


@pytest.mark.parametrize("dims", [2, 8, 64])
def test_against_brute_force(spark, dims):
    assert check(spark, random_rows(400, dims, seed=dims), every=10)


def test_several_blocks_on_both_sides(spark, monkeypatch):
    for name, value in (("CANDIDATES", 64), ("ANCHORS", 8), ("LANES", 3)):
        monkeypatch.setattr(negatives, name, value)
    check(spark, random_rows(300, 10), every=7)


def test_nulls_ties_repeats_and_lengths(spark):
    rows = random_rows(120, 4) + [(k + 200, [0.5, 0.5, 0.5, 0.5], k % 3) for k in range(60)]
    rows += [(None, [1.0], 0), (250, None, 0), (300, [1.0, None], 0), (350, [math.nan], 0), (400, [math.inf], 0), (450, [1.0], None),
             (500, [], 0), (501, [], 1), (550, [1.0], 0), (551, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0], 1),
             (600, [0.0, 0.0], 1), (650, [-1.0, -1.0], 2), (7, [0.1], 1), (7, [0.1], 1), (7, [0.1], 0), (50, [0.9, 0.9], 2)]
    check(spark, rows)


def test_wide_components(spark):
    """Scores beyond 31 and 63 bits, and beyond what doubles scaled by 256 can hold."""
    rows = [(k, [2.0 ** (k % 11), -3.5 * k, 1e6 + k], k % 2) for k in range(60)]
    check(spark, rows, every=10)
    rows += [(60 + k, [1e9 * (k - 20), 1e8, 2.0 ** 33 + k, 0.5], k % 3) for k in range(40)]
    check(spark, rows, every=10)
    check(spark, [*rows, (200, [1e308, -1e308], 0), (201, [1e300, 1.0], 1), (202, [-1e200, 0.0], 0), (203, [1e19], 0)], every=10)


def test_empty_and_extra_columns(spark):
    frame = spark.createDataFrame(random_rows(100, 4), KIND)
    for odd in (frame.limit(0), frame.where("vec_id % 50 <> 0"), frame.withColumn("label", frame["label"] * 0)):
        assert negatives.mine(odd).count() == 0
    extra = frame.selectExpr("*", "1 AS block", "2 AS rank", "3 AS vec", "4 AS given", "5 AS positives", "6 AS row")
    assert sorted(map(tuple, negatives.mine(extra).collect())) == brute(random_rows(100, 4))


def test_planes_and_tables_give_inner_products():
    rng = np.random.default_rng(2)
    for scale in (1, 5, 1 << 12, 1 << 28):
        a, b = (rng.integers(-scale, scale + 1, size=(n, 21)) for n in (9, 30))
        assert (negatives.scores(a, negatives.bit_planes(b)) == b.astype(object) @ a.astype(object).T).all()
    tables = negatives.subset_sums(np.arange(8)[None], 1)
    assert [tables[0, m, 0] for m in range(256)] == [sum(d for d in range(8) if m >> d & 1) for m in range(256)]


def test_a_vector_is_read_without_the_driver(spark):
    """No row of the anchors is collected: blocks of both sides meet in a join."""
    blocks = spark.createDataFrame([(0, b"a"), (1, b"b")], "anchor_block long, x binary")
    index = spark.createDataFrame([(0, b"c"), (1, b"d"), (2, b"e")], "block long, y binary")
    pairs = negatives.met(blocks, index, 2, 3)
    assert sorted((r.x, r.y) for r in pairs.collect()) == [(x, y) for x in (b"a", b"b") for y in (b"c", b"d", b"e")]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
