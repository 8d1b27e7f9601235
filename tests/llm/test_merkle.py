import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import merkle

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(doc_id, text, lang, source, n_chars):
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def way(tree, at):
    """(sibling or None, whether the node is the right one) for each level."""
    out = []
    for nodes in tree[:-1]:
        other = at ^ 1
        out.append((nodes[other] if other < len(nodes) else None, at & 1))
        at >>= 1
    return out


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(*row), row))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: levels([x[2] for x in sorted(groups[lang], key=lambda x: x[:3])]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    root, out = top[-1][0], []
    for number, lang in enumerate(langs):
        for at, (_, _, digest, row) in enumerate(sorted(groups[lang], key=lambda x: x[:3])):
            steps = way(trees[lang], at) + way(top, number)
            seen = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                seen = leaf(*row[:4], row[4] + 1)
            for other, right in steps:
                seen = h(seen) if other is None else h(other, seen) if right else h(seen, other)
            out.append((row[0], digest, trees[lang][-1][0], root, h(*[o for o, _ in steps if o]), seen, seen == root))
    return sorted(out, key=str)


def check(spark, rows, **extra):
    frame = spark.createDataFrame(rows, KIND).repartition(3)
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    found = merkle.manifest(frame, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == brute(rows)
    return got


@pytest.mark.parametrize("step,fan", [(10, 12), (2, 1)])
def test_against_brute_force(spark, monkeypatch, step, fan):
    """Also with steps and copies of ancestors as in trees of thousands and of millions of leaves."""
    monkeypatch.setattr(merkle, "STEP", step)
    monkeypatch.setattr(merkle, "FAN", fan)
    rows = [(k * 3 % 1009, f"text {k}\né", ["en", "de", "fr"][(k > 150) + (k > 159)], f"s{k % 5}", k % 90 or None) for k in range(170)]
    got = check(spark, rows)
    assert {v for *_, v in got} == {True, False}


def test_nulls_repeats_and_small_groups(spark):
    rows = [(None, None, None, None, None), (None, "", None, None, 0), (1, "a", None, "x", 1), (7, "b", "", "", 3),
            (2, "c", "é", None, 2), (2, "c", "é", None, 2), (2, "other", "é", None, 2), (-5, "word " * 40000, "z", "s", 200000),
            (9, "d", "Z", "s", 1), (14, "d", "a", "s", 1)] + [(k, "", "one", None, None) for k in range(5)]
    check(spark, rows, idx=1, n=2, grp="g", part=3, hash="h", subroot="s", level=4)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9])
def test_small_trees(spark, n):
    check(spark, [(k, f"t{k}", "en", "s", k) for k in range(n)])


def test_every_row_its_own_group(spark):
    check(spark, [(k, f"t{k}", f"l{k}", "s", k) for k in range(13)])


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], KIND), F.lit(True)).count() == 0


def test_a_proof_is_bound_to_its_place(spark):
    """Siblings in another order, or another leaf, do not lead to the root."""
    rows = spark.createDataFrame([(k, h(str(k))) for k in range(11)], "doc_id long, leaf string")
    found = merkle.proofs(rows, F.lit("g"), ["doc_id"], "leaf")
    good = found.where(merkle.check_proof(F.col("leaf")) == F.col("root"))
    assert good.count() == 11
    moved = found.withColumn("idx", F.col("idx").bitwiseXOR(F.lit(1))).where("idx < 10")
    assert moved.where(merkle.check_proof(F.col("leaf")) == F.col("root")).count() == 0


def test_rounds_double(spark, monkeypatch):
    """A height of 9 takes four rounds of joins."""
    made = []
    keep = merkle.Scratch.keep
    monkeypatch.setattr(merkle.Scratch, "keep", lambda self, rows, name: made.append(name) or keep(self, rows, name))
    check(spark, [(k, "t", "en", "s", k) for k in range(300)])
    assert [x for x in made if x.startswith("jump-grp")] == [f"jump-grp-{d}" for d in (1, 2, 4, 8)]
