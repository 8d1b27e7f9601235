import math

import numpy as np
import pytest

from tallyfold.llm import ann, topk

KIND = "vec_id long, embedding array<float>, label int"
ODD = [(None, [1.0, 2.0], 0), (900, None, 0), (901, [1.0, None], 0), (902, [math.nan, 1.0], 0), (903, [math.inf, 1.0], 0)]


def random_rows(n, dims, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(k, [float(np.float32(v)) for v in row], 0) for k, row in enumerate(x)]


def brute(rows, every, k, measure):
    fine = [(i, v) for i, v, _ in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = {}
    for i, v in fine:
        if i % every == 0:
            near = sorted(((-measure(v, w), j) for j, w in fine if j != i))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def told(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def whole(v, w):
    return sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w))


@pytest.mark.parametrize("dims", [3, 64])
def test_topk_is_exact(spark, dims):
    rows = random_rows(700, dims) + [(k + 700, [0.5] * dims, 0) for k in range(30)] + ODD
    assert told(topk.highest(spark.createDataFrame(rows, KIND))) == brute(rows, 50, 5, whole)


def test_topk_over_several_blocks_and_few_rows(spark, monkeypatch):
    rows = random_rows(300, 8) + [(k + 300, [2.5, -3.0, 0.0, 1.0, 0.0, 0.0, 0.0, -0.001], 0) for k in range(9)]
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    assert told(topk.highest(spark.createDataFrame(rows, KIND).repartition(3))) == brute(rows, 50, 5, whole)
    few = [(0, [0.0, 0.0], 0), (50, [1.0, 0.25], 0), (7, [], 0), (8, [1.0, 2.0, 3.0], 0)]
    found = told(topk.highest(spark.createDataFrame(few, KIND)))
    assert found == {0: [(7, 0), (8, 0), (50, 0)], 50: [(8, 256 * 256 + 64 * 512), (0, 0), (7, 0)]}


def test_topk_edges(spark):
    empty = spark.createDataFrame([], KIND)
    assert topk.highest(empty).count() == 0 and ann.nearest(empty).count() == 0
    assert topk.highest(spark.createDataFrame(ODD, KIND)).count() == 0
    twice = [(0, [1.0], 0), (0, [1.0], 0), (1, [1.0], 0)]
    assert told(topk.highest(spark.createDataFrame(twice, KIND))) == {0: [(1, 65536)]}
    large = [(0, [1e30], 0), (1, [1.0], 0), (2, [-1e30], 0), (50, [2.0 ** 25], 0)]
    assert told(topk.highest(spark.createDataFrame(large, KIND)))[0] == [(1, 2 ** 63 - 1), (50, 2 ** 63 - 1), (2, -2 ** 63)]


def test_topk_of_wide_components(spark):
    """Components beyond 2 ** 20 and products beyond 32 bits."""
    rng = np.random.default_rng(4)
    rows = [(k, [float(np.float32(v)) for v in row], 0) for k, row in enumerate(rng.normal(size=(200, 5)) * 2.0 ** 21)]
    rows += [(200 + k, [float(k), 1e6, -2.5e6, 0.5, 1.0], 0) for k in range(20)]
    assert told(topk.highest(spark.createDataFrame(rows, KIND))) == brute(rows, 50, 5, whole)
    many = [(k, [2.0 ** 19 + k] * 200, 0) for k in range(60)]
    assert told(topk.highest(spark.createDataFrame(many, KIND))) == brute(many, 50, 5, whole)


def test_a_repeated_query_id_is_one_query(spark):
    rows = [(0, [2.0, 1.0], 0), (0, [1.0, 5.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)]
    for frame in (spark.createDataFrame(rows, KIND), spark.createDataFrame(rows[::-1], KIND)):
        assert told(topk.highest(frame)) == {0: [(2, 5 * 65536), (1, 65536)]}
        assert told(ann.nearest(frame)) == {0: [(2, 5.0), (1, 1.0)]}


def test_signed_digits():
    for weight in range(-300, 300):
        assert sum(d << p for p, d in topk.signed_digits(weight)) == weight


def test_ann_recall_and_scores(spark):
    rows = random_rows(3000, 64, 3)
    found = told(ann.nearest(spark.createDataFrame(rows, KIND)))
    true = brute(rows, 20, 20, lambda v, w: float(np.dot(v, w)))
    assert set(found) == set(true) and all(len(v) == 20 for v in found.values())
    hits = sum(len({j for j, _ in found[q]} & {j for j, _ in true[q]}) for q in true)
    assert hits >= 0.9 * 20 * len(true)
    vec = {i: np.array(v, dtype=float) for i, v, _ in rows}
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - vec[q] @ vec[j]) < 1e-12 for j, s in near)


def test_ann_edges(spark):
    rows = [(0, [1.0, 0.0], 0), (20, [0.0, 1.0], 0), (3, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (5, [0.0, 0.0], 0),
            (6, [1.0, 2.0, 3.0], 0)] + ODD
    found = told(ann.nearest(spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS query_id", "2 AS score")))
    assert found == {0: [(2, 1.0), (3, 1.0), (20, 0.0)], 20: [(0, 0.0), (2, 0.0), (3, 0.0)]}


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    model = ann.Model(64, np.zeros(64), np.eye(64), 0)
    index = ann.Index(model, np.arange(500), rng.normal(size=(500, 64)))
    for radius in (0, 3, 8, 21, 26, 31, 64):
        for code in index.codes[:20]:
            want = np.flatnonzero(np.bitwise_count(index.codes ^ code) <= radius)
            assert index.within(code, radius).tolist() == want.tolist()
