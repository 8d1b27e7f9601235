import hashlib
import random
from collections import defaultdict

import pytest

from tallyfold.llm import lines

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, chars, docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(AZ)

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if doc_id is None or len(holders[key(x)]) < docs or doc_id == max(holders[key(x)])]
        out.append((doc_id, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def check(frame, rows, chars=40, docs=5):
    found = lines.deduplicate(frame, least_chars=chars, least_docs=docs).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, chars, docs)


@pytest.mark.parametrize("docs", [1, 2, 5])
def test_against_brute_force(docs_of, docs):
    pick = random.Random(docs)
    shared = ["Alpha beta", "ALPHA BETA", " alpha beta\t", "\x0balpha beta\x0c", "É alpha", "é alpha", "é ALPHA", "", "x",
              "long " * 9, "LONG " * 9, "alpha beta", " alpha beta", "日本語 Alpha"]
    rows = [(pick.randrange(60), "\n".join(pick.choices(shared, k=pick.randrange(200)))) for _ in range(80)]
    check(docs_of(*rows), rows, 6, docs)


def test_nulls_repeats_and_odd_texts(docs_of):
    line = "a line of at least forty code points, yes"
    rows = [(None, line), (None, line), (1, None), (2, ""), (3, "\n"), (4, line), (4, line), (5, f"{line}\n{line}"), (6, line),
            (7, line + "\r"), (8, f"\n{line}\n\n{line}\nend"), (8, f"{line}\nother"), (8, f"{line}\nother")]
    check(docs_of(*rows), rows)
    check(docs_of(*rows[:-3]), rows[:-3])


def test_length_is_counted_in_code_points_after_stripping(docs_of):
    rows = [(k, "é" * 40 + " " * k) for k in range(5)] + [(10 + k, "é" * 39 + " " * 9) for k in range(5)]
    check(docs_of(*rows), rows)


def test_very_long_texts(docs_of):
    """Every second of 40,000 lines goes: bits of both kinds in every word, and the last word is not full."""
    common = [f"this line is in every one of the documents {k}" for k in range(20001)]
    rows = [(k, "\n".join(x for c in common for x in (c, f"own line {k}"))) for k in range(2)]
    check(docs_of(*rows), rows, 40, 2)


def test_bitmaps_leave_out_words_that_keep_all(docs_of):
    line = "a line of at least forty code points, yes"
    text = "\n".join(line if k in (3, 700) else f"{k}" for k in range(1000))
    found = lines.keep_bitmaps(docs_of((1, text), (2, text), (3, "other")), least_docs=2).collect()
    assert [(r.doc_id, r.n_dropped, [w.word for w in r["keep"]]) for r in found] == [(1, 2, [0, 700 >> 6])]
    assert found[0]["keep"][0].bits == ~(1 << 3) and found[0]["keep"][1].bits == ~(1 << (700 & 63))


def test_empty_table_and_clashing_columns(docs_of):
    assert lines.deduplicate(docs_of().limit(0)).count() == 0
    line = "a line of at least forty code points, yes"
    rows = [(k, f"{line}\n{k}") for k in range(6)]
    extra = docs_of(*rows).selectExpr("*", "1 AS body", "2 AS pos", "3 AS hash", "4 AS keep", "5 AS of", "6 AS own", "7 AS first")
    check(extra, rows)
    kept = lines.apply_bitmaps(extra, lines.keep_bitmaps(extra))
    assert kept.columns == [*extra.columns, "n_lines", "n_dropped", "kept"]
    assert {(r.body, r.pos, r.keep, r.own) for r in kept.collect()} == {(1, 2, 4, 6)}
    with pytest.raises(ValueError):
        lines.apply_bitmaps(extra.selectExpr("*", "8 AS Kept"), lines.keep_bitmaps(extra))


def test_one_shuffle_by_range_and_no_python(docs_of):
    plan = lines.occurrences(lines.line_hashes(docs_of((1, "a")), 1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("rangepartitioning(hash") == 1 and "Python" not in plan


def test_query(spark):
    from tallyfold.llm.queries import REGISTRY
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = REGISTRY["op11_line_dedup"](spark, sf).collect()
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute(rows, 40, 5)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str) and any(r.n_dropped for r in found)
