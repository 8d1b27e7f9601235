import random
import re

import pytest

from tallyfold.llm import spans
from tallyfold.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    owner = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        if doc_id is not None:
            for k in range(len(words) - width + 1):
                run = tuple(words[k:k + width])
                owner[run] = min(owner.get(run, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for k in range(len(words) - width + 1):
            if doc_id is not None and owner[tuple(words[k:k + width])] < doc_id:
                gone.update(range(k, k + width))
        out.append((doc_id, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def check(frame, rows, width=13):
    found = spans.deduplicate(frame, width=width).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, width)


@pytest.mark.parametrize("width", [2, 5, 13])
def test_against_brute_force(docs_of, width):
    pick = random.Random(width)
    words = [f"w{k}" for k in range(12)] + ["é", "I.", "x" * 40]
    passages = [" ".join(pick.choices(words, k=30)) for _ in range(4)]
    rows = []
    for k in range(60):
        parts = [pick.choice(passages)[pick.randrange(10):] if pick.random() < .5 else " ".join(pick.choices(words, k=9))
                 for _ in range(pick.randrange(6))]
        rows.append((pick.randrange(1000), pick.choice([" ", "\n", "  "]).join(parts)))
    check(docs_of(*rows), rows, width)


def test_nulls_repeats_and_odd_texts(docs_of):
    long = " ".join(f"w{k % 4001}" for k in range(12000))
    loop = "go " * 300
    rows = [(1, long), (2, long), (2, long), (2, loop), (3, loop), (None, long), (None, None), (4, None), (5, ""),
            (6, " \t "), (7, "a b c"), (8, "a\x0bb c d"), (9, long + " tail"), (-4, "tail " + loop)]
    check(docs_of(*rows), rows)


def test_texts_of_one_doc_id_that_line_up(spark, docs_of):
    """Windows 0-5 come from one text of document 1, windows 8-20 from the other, at consecutive places."""
    words = [f"a{k}" for k in range(40)]
    one, two = ([*words[:k], "changed", *words[k + 1:]] for k in (20, 5))
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join(words))]
    check(docs_of(*rows), rows)
    rows += [(3, " ".join(words + one))] + [(k, " ".join([*words[:k], "other", *words[k + 1:]])) for k in range(1, 38) for _ in range(2)]
    check(docs_of(*rows), rows, 5)


def test_a_span_is_compared_with_its_own_source_text(spark, docs_of):
    keyed = spans._keyed(docs_of((1, "a b c d"), (1, "a b x d"), (2, "a b c d")))
    body = {r.text: r.body for r in keyed.collect()}
    kind = "doc_id long, body long, at long, n long, source long, place long"
    right, wrong = (spark.createDataFrame([(2, body["a b c d"], 0, 1, 1, body[t] << 32)], kind) for t in ("a b c d", "a b x d"))
    assert spans.verified(keyed, right, 3, Scratch(spark, "test"))
    assert not spans.verified(keyed, wrong, 3, Scratch(spark, "test"))


def test_a_block_is_asked_for_few_pieces(spark, docs_of, monkeypatch):
    """However many documents quote a source from and to other places, a task hashes a bounded list per block."""
    pick, size, packed = random.Random(4), 4, 77 << 32
    rows = []
    for k in range(600):
        place, n = pick.randrange(100), pick.randrange(1, 100)
        rows.append((2 + k, 5, pick.randrange(9), n, 1, packed + place))
    asked = spark.createDataFrame(rows, "doc_id long, body long, at long, n long, source long, place long")
    cut = spans.pieces(asked, size)
    covered = {}
    for r in cut.collect():
        assert r.at // size == (r.at + r.n - 1) // size and r.place // size == (r.place + r.n - 1) // size
        covered.setdefault(r.doc_id, []).extend((r.at + k, r.place + k) for k in range(r.n))
    assert {k: sorted(v) for k, v in covered.items()} == {
        r[0]: [(r[2] + k, r[5] + k) for k in range(r[3])] for r in rows}
    lists = spans.asked_of(cut, size).where("doc_id = 1").collect()
    assert {r.body for r in lists} == {77} and max(len(r.runs) for r in lists) <= size * (size + 1) // 2
    monkeypatch.setattr(spans, "PIECE", size)
    words = [f"w{k % 97}" for k in range(300)]
    quotes = [(k, " ".join([f"x{k}"] * (k % 7) + words[(a := pick.randrange(250)):a + pick.randrange(60)])) for k in range(2, 80)]
    check(docs_of((1, " ".join(words)), *quotes), [(1, " ".join(words)), *quotes], 5)


def test_empty_table_and_other_columns(spark, docs_of):
    assert spans.deduplicate(docs_of().limit(0)).count() == 0
    rows = [(1, "a b c d"), (2, "a b c d")]
    frame = docs_of(*rows).selectExpr("*", "1 AS body", "2 AS runs", "3 AS at", "4 AS source_", "5 AS kept")
    check(frame, rows, 3)


def test_words_that_share_a_hash_are_told_apart_by_the_next_seed(docs_of, monkeypatch):
    whole = spans.Words.keys
    monkeypatch.setattr(spans.Words, "keys", lambda self, seed: whole(self, seed) if seed else whole(self, seed) * 0)
    rows = [(1, " ".join(f"a{k}" for k in range(30))), (2, " ".join(f"a{k if k != 9 else 'x'}" for k in range(30)))]
    check(docs_of(*rows), rows, 5)


@pytest.mark.parametrize("size", [500, 1024])
def test_long_words_that_differ_in_a_pattern(docs_of, size):
    """Words of two letters in the Thue-Morse order, and its complement: polynomials modulo a power of two confuse them."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(size))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(k, " ".join(f"w{j}" if j != 15 else middle for j in range(30))) for k, middle in enumerate((word, other))]
    check(docs_of(*rows), rows)


def test_keys_of_words():
    texts = [b"a ab abcdefgh abcdefghi  \xff" + b"z" * 600, b"", b"ab abcdefgh " + b"z" * 600 + b" h\x00 h"]
    words = spans.Words(texts)
    keys = words.keys(3).tolist()
    by_word = {}
    for key, start, end in zip(keys, words.starts, words.ends):
        assert by_word.setdefault(bytes(words.raw[start:end]), key) == key
    assert len(set(by_word.values())) == len(by_word) == 8 and not set(keys) & set(words.keys(4).tolist())


def graph_of(spark, frame, width):
    scratch, keyed = Scratch(spark, "test"), spans._keyed(frame)
    flags = spans.seeds(keyed, width, 0).groupBy("doc_id", "body").agg({"run": "collect_list"}).toDF("doc_id", "body", "runs")
    walked = scratch.keep(spans.walks(keyed.join(flags, ["doc_id", "body"]).select("doc_id", "body", "text", "runs"), width, 0), "w")
    compact = scratch.keep(spans.compacted(scratch.keep(spans.repeated_edges(walked), "e")), "c")
    return walked, compact, spans.path_table(compact)


def test_paths_are_compacted(spark, docs_of):
    """Documents that share one passage share one path; a branch inside it cuts the path."""
    passage = [f"p{k}" for k in range(40)]
    plain = docs_of((1, " ".join(passage)), (2, "x " + " ".join(passage)), (3, "y " + " ".join(passage)))
    branch = docs_of((1, " ".join(passage)), (2, " ".join(passage)), (3, " ".join(passage[:20]) + " q r s"),
                     (4, " ".join(passage[:20]) + " q r s"))
    for frame, lengths in ((plain, [37]), (branch, [3, 17, 20])):
        paths = graph_of(spark, frame, 4)[2]
        assert sorted(r.length for r in paths.collect()) == lengths


def test_spans_are_parts_of_paths(spark, docs_of):
    """A stretch that begins inside a path has its place by the path; without paths nothing is repeated."""
    passage = [f"p{k}" for k in range(40)]
    frame = docs_of((1, "a b " + " ".join(passage)), (2, " ".join(passage)), (3, "c " + " ".join(passage[10:30]) + " d"))
    walked, compact, paths = graph_of(spark, frame, 4)
    stretched = spans.stretches(spans.repeats(walked, compact))
    found = spans.spans_of(stretched, paths).collect()
    assert sorted((r.doc_id, r["at"], r.n, r.source, r.place & 0xffffffff) for r in found) == [(2, 0, 37, 1, 2), (3, 1, 17, 1, 12)]
    assert spans.spans_of(stretched, paths.limit(0)).count() == 0


def test_no_paths_no_removal(spark, docs_of, monkeypatch):
    """What goes is what paths cover: emptied, nothing goes but whole copies."""
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(1, passage), (2, "x " + passage), (3, passage)]
    whole = spans.path_table
    monkeypatch.setattr(spans, "path_table", lambda compact: whole(compact).limit(0))
    assert sorted((r.doc_id, r.n_removed) for r in spans.deduplicate(docs_of(*rows)).collect()) == [(1, 0), (2, 0), (3, 40)]
