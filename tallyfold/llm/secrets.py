"""Secret scans through a trigram index, all in DataFrame functions.

A Boolean query over trigrams follows from each rule's pattern: what any match must contain. The index lists, for the
trigrams that the rules ask for, the documents that hold them in any case. Intersecting the lists gives each rule's
candidates, which are then matched. A rule whose query is always true is matched against every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import free

_MOST = 32  # strings followed side by side before the query is closed
_GRAMS = 3  # trigrams asked for of one string


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and a least length of one of its groups (0: the whole match)."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The three base kinds. For runs of one class, a least count inside the pattern finds the same matches as
#: a later check of their length.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Further kinds that this method adds.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}"),
    Rule("login", r"://[A-Za-z0-9._-]+:[A-Za-z0-9._-]+@"),
)
RULES = BASE + MORE

#: A query: all of the clauses; a clause: one of its sets of trigrams; no clause: always true.
Query = tuple[frozenset[frozenset[str]], ...]


def _grams(text: str) -> frozenset[str]:
    every = [text[k:k + 3] for k in range(len(text) - 2)]
    step = max(1, (len(every) - 1) / max(1, _GRAMS - 1))
    return frozenset(every[min(len(every) - 1, round(k * step))] for k in range(min(_GRAMS, len(every))))


def _clause(strings: set[str]) -> Query:
    """What holds of a text that contains one of the strings."""
    if not strings or min(map(len, strings)) < 3:
        return ()
    sets = {_grams(s) for s in strings if not any(t != s and t in s for t in strings)}
    return (frozenset(sets),)


def _exact(item) -> set[str] | None:
    """All strings that a part of a pattern can match, in lower case; None if there are too many."""
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        out: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                out.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < 8:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op == "SUBPATTERN":
        return _exact_run(arg[3])
    if op == "BRANCH":
        parts = [_exact_run(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op == "MAX_REPEAT" and arg[1] == 1:
        one = _exact_run(arg[2])
        return None if one is None else one | ({""} if arg[0] == 0 else set())
    return {""} if op == "AT" else None


def _exact_run(items) -> set[str] | None:
    strings = {""}
    for item in items:
        one = _exact(item)
        if one is None or len(one) * len(strings) > _MOST:
            return None
        strings = {a + b for a, b in product(strings, one)}
    return strings


def _run(items) -> Query:
    query: Query = ()
    strings = {""}
    for item in items:
        one = _exact(item)
        if one is not None and len(one) * len(strings) <= _MOST:
            strings = {a + b for a, b in product(strings, one)}
            continue
        query, strings = query + _clause(strings), {""}
        op, arg = str(item[0]), item[1]
        if one is not None:
            strings = one
        elif op == "SUBPATTERN":
            query += _run(arg[3])
        elif op == "MAX_REPEAT" and arg[0] > 0:
            query += _run(arg[2])
    return query + _clause(strings)


def trigram_query(pattern: str) -> Query:
    """What any match of the pattern contains, in lower case. Parts that are not understood ask for nothing."""
    return _run(re._parser.parse(pattern))


def grams_of(rules) -> list[str]:
    return sorted({g for r in rules for clause in trigram_query(r.pattern) for one in clause for g in one})


def build_index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, doc_id) of the given trigrams, found in any case."""
    folded = docs.select("doc_id", F.lower("text").alias("folded"))
    found = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(g)), F.lit(g)) for g in grams]))
    return folded.select("doc_id", F.explode(found).alias("gram"))


def candidates(postings: DataFrame, rules) -> DataFrame:
    """doc_id and the kinds whose query its trigrams fulfil."""
    held = postings.groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))

    def holds(query: Query) -> Column:
        def one(grams):
            return reduce(Column.__and__, [F.array_contains("grams", g) for g in sorted(grams)])
        return reduce(Column.__and__, [reduce(Column.__or__, [one(s) for s in sorted(c, key=sorted)]) for c in query])

    kinds = F.array_compact(F.array(*[F.when(holds(trigram_query(r.pattern)), F.lit(r.kind)) for r in rules]))
    return held.select(F.col("doc_id").alias("of"), kinds.alias("kinds")).where(F.size("kinds") > 0)


_RUN = 256  # elements whose running totals are worked out together
_PIECE = 1024  # code points of a piece that a text is cut into


def _bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once and not again for each element that looks at it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op) -> Column:
    """What ``op`` makes of all elements before each element, and last of all of them; 0 before the first.

    Elements are taken in runs, so that the work grows with their number: an array that grows by one element at a time is
    copied each time.
    """
    zero = F.lit(0).cast("long")
    def grown(xs, start):
        return F.aggregate(xs, F.array(start), lambda done, x: F.concat(done, F.array(op(F.element_at(done, -1), x))))

    def whole(xs):
        starts = F.when(F.size(xs) > 0, F.sequence(F.lit(1), F.size(xs), F.lit(_RUN))).otherwise(F.array().cast("array<int>"))
        runs = F.transform(starts, lambda at: grown(F.slice(xs, at, F.lit(_RUN)), zero))

        def totalled(runs):
            before = grown(F.transform(runs, lambda r: F.element_at(r, -1)), zero)
            return _bound(F.struct(runs.alias("runs"), before.alias("before")), shifted)

        def shifted(s):
            def moved(r, before):
                # One struct for a run, so that the total before it is looked up once.
                return _bound(F.struct(r.alias("run"), before.alias("before")), lambda m: F.transform(
                    F.slice(m["run"], F.lit(1), F.size(m["run"]) - 1), lambda x: op(m["before"], x)))

            parts = F.transform(s["runs"], lambda r, i: moved(r, F.get(s["before"], i)))
            return F.concat(F.flatten(parts), F.array(F.element_at(s["before"], -1)))

        return _bound(runs, totalled)

    return _bound(values, whole)


def _spans(rule: Rule, number: int, text: Column) -> Column:
    """(start, number, end) of each match, from the lengths of the matches and of what lies between them."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    steps = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("hit"), checked.alias("part"))
    steps = F.transform(steps, lambda x: F.struct(
        F.length(x["gap"]).cast("long").alias("gap"), F.coalesce(F.length(x["hit"]), F.lit(0)).cast("long").alias("hit"),
        (F.coalesce(F.length(x["part"]), F.lit(-1)) >= rule.least).alias("fine")))

    def found(steps):
        def placed(both):
            at = F.transform(both["steps"], lambda x, i: F.struct(
                (F.get(both["before"], i) + x["gap"]).alias("start"), F.lit(number).alias("kind"),
                F.get(both["before"], i + 1).alias("end"), x["fine"].alias("fine")))
            return F.transform(F.filter(at, lambda x: x["fine"]), lambda x: F.struct(
                x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

        sums = running(F.transform(steps, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b)
        return _bound(F.struct(steps.alias("steps"), sums.alias("before")), placed)

    return _bound(steps, found)


_NONE = "cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)"


def with_spans(docs: DataFrame, rules=RULES, *, spans: str = "spans") -> DataFrame:
    """``docs`` with an array, named ``spans``, of (start, kind, end): code points, end exclusive, by start and then kind.

    Matches of one kind do not overlap; kind is the rule's number. Null and empty texts have none. Rows that repeat a
    doc_id or have none are matched against their own text. Other columns stay as they are; the new name must be free.
    """
    if spans in docs.columns:
        raise ValueError(f"column {spans} exists already")
    asked = [r for r in rules if trigram_query(r.pattern)]
    rows = docs
    if asked:
        # The kinds are hashed, so that texts are not sorted for the join.
        found = candidates(build_index(docs, grams_of(asked)), asked).hint("shuffle_hash")
        rows = docs.join(found, docs["doc_id"].eqNullSafe(found["of"]), "left")
    parts = []
    for number, rule in enumerate(rules):
        wanted = docs["text"].rlike(rule.pattern)
        if rule in asked:
            wanted = F.array_contains(found["kinds"], rule.kind) & wanted
        parts.append(F.when(wanted, _spans(rule, number, docs["text"])).otherwise(F.expr(_NONE)))
    return rows.select(*[docs[c] for c in docs.columns], F.sort_array(F.concat(*parts)).alias(spans))


def told(spans: Column, rules=RULES) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans.

    One row per row, also for repeated and missing ids. Null and empty texts have no spans. Columns beyond doc_id and text
    are not read.
    """
    rows = with_spans(docs.select("doc_id", "text"))

    def count(number):
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each run of overlapping spans replaced by ``mark``; spans are in the order of their starts.

    The text is cut into pieces first, so that a part of it is found without counting from its begin.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))

    def part(pieces, start, end):
        first, last = F.floor(start / _PIECE).cast("int"), F.floor((end - 1) / _PIECE).cast("int")
        at = (start % _PIECE).cast("int") + 1
        head = F.substring(F.get(pieces, first), at, F.lit(_PIECE))
        inner = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        tail = F.substring(F.get(pieces, last), F.lit(1), (end - last.cast("long") * _PIECE).cast("int"))
        return F.when(end <= start, F.lit("")).when(
            first == last, F.substring(F.get(pieces, first), at, (end - start).cast("int"))).otherwise(F.concat(head, inner, tail))

    def joined(s):
        heads = F.filter(F.transform(s["spans"], lambda x, i: F.struct(F.get(s["before"], i).alias("before"), x["start"].alias("start"))),
                         lambda x: x["start"] >= x["before"])
        parts = F.transform(heads, lambda x: F.concat(part(s["pieces"], x["before"], x["start"]), F.lit(mark)))
        rest = part(s["pieces"], F.element_at(s["before"], -1), s["size"])
        return F.array_join(F.concat(parts, F.array(rest)), "")

    before = running(F.transform(spans, lambda x: x["end"]), F.greatest)
    return _bound(F.struct(spans.alias("spans"), before.alias("before"), pieces.alias("pieces"),
                           F.length(text).cast("long").alias("size")), joined)


def redacted(docs: DataFrame, *, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by ``mark``, and n_chars of changed texts counted anew.

    One row per row, with the columns that it had, whatever their names. Null and empty texts, and texts without a span,
    stay as they are, and so does their n_chars.
    """
    spans, clean = free("spans", docs), free("clean", docs)
    rows = with_spans(docs, spans=spans)
    hit = F.size(spans) > 0
    out = rows.withColumn(clean, F.when(hit, masked(F.col("text"), F.col(spans), mark)).otherwise(F.col("text")))
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    cells = {"text": F.col(clean)}
    if kind is not None:
        cells["n_chars"] = F.when(hit, F.length(clean).cast(kind)).otherwise(F.col("n_chars"))
    return out.select(*[cells.get(c, F.col(c)).alias(c) for c in docs.columns])
