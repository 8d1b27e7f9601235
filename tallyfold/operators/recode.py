"""Rule-table recodes: join form (drop and fan out), first-match and last-match cascades.

The three meanings of one rule table are separate operators and are never mixed.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tallyfold.functions.codes import parse_age, top_code
from tallyfold.operators import sizing
from tallyfold.operators.sizing import local_frame, local_rows, small_side
from tallyfold.schema import AGE_BANDS, RACE_FLAGS, RECODED

_SPAN = 64  # bands that the widest rule may cover in a range join
_SCOPED = [("raw_racemars", name) for name in ["rcode", *RACE_FLAGS[:-1]]] + [
    ("rcode", "r1r3"), ("rcode", "r2r4"), ("raw_hispanic", "r2r4"),
]
_UNSCOPED = [("age", name) for name in AGE_BANDS] + [("raw_gender", "gender"), ("raw_hispanic", "race_hisp")]


# --- single recodes -------------------------------------------------------------------------------

def recode_join(rows: DataFrame, rules: DataFrame, old_column: str, new_column: str, *, kind: str = "exact",
                how: str = "inner", on_scheme: bool = False, default: int | None = None,
                alias: str | None = None) -> DataFrame:
    """Add ``alias`` (or ``new_column``) by joining one slice of the rule table.

    ``how="inner"`` drops rows without a rule, overlapping rules fan out. ``kind="range"`` matches
    min <= value <= max; it is planned as a hash join on value bands, with the bounds as residual filter.
    """
    out = alias or new_column
    slice_ = rules.where(f"old_column = {_literal(old_column)} AND new_column = {_literal(new_column)}")
    value = f"CAST(new_value_num AS SMALLINT) AS {_quoted(out)}"
    scheme = ["r_type AS _scheme"] if on_scheme else []
    rows = rows.drop(out)
    if kind == "exact":
        lookup = slice_.selectExpr("old_value_txt AS _old", value, *scheme)
        match = f"{_quoted(old_column)} = _old"
    else:
        rows, lookup, match = _band_match(rows, slice_, old_column, [value, *scheme])
    match = F.expr(f"{match} AND r_type = _scheme" if on_scheme else match)
    joined = rows.join(small_side(lookup), match, how).drop("_old", "_scheme", "_lo", "_hi", "_band", "_at")
    if default is not None:
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.lit(default).cast("smallint")))
    return joined


def _band_match(rows, slice_, column, values, width=None):
    """Equality on bands: each rule is listed under the bands it covers, each value falls into one band."""
    slice_ = slice_.where("old_value_num_min <= old_value_num_max")
    if width is None:
        width = _band_width(slice_.selectExpr("max(CAST(old_value_num_max AS BIGINT) - old_value_num_min)").first()[0] or 0)

    def band(value):
        return f"CAST(floor({value} / {width}) AS BIGINT)"

    bands = f"explode(sequence({band('old_value_num_min')}, {band('old_value_num_max')})) AS _band"
    lookup = slice_.selectExpr("old_value_num_min AS _lo", "old_value_num_max AS _hi", *values, bands)
    is_text = isinstance(rows.schema[column].dataType, T.StringType)
    rows = rows.withColumn("_at", F.expr(f"TRY_CAST({_quoted(column)} AS DOUBLE)" if is_text else _quoted(column)))
    return rows, lookup, f"{band('_at')} = _band AND _at BETWEEN _lo AND _hi"


def _band_width(widest: int) -> int:
    return max(1, -(-widest // _SPAN))


def recode_override(rows: DataFrame, rules: DataFrame, old_column: str, new_column: str, base: str, *,
                    on_scheme: bool = True) -> DataFrame:
    """A matching rule of ``old_column`` replaces ``base``; without one the base value stays."""
    joined = recode_join(rows, rules, old_column, new_column, how="left", on_scheme=on_scheme, alias="_override")
    return joined.withColumn(base, F.coalesce("_override", base)).drop("_override")


# --- whole recode of a fact set -------------------------------------------------------------------

@dataclass(frozen=True)
class CodeBook:
    """The fourteen rule joins folded into five lookups keyed by raw code.

    ``fans_out`` tells whether some code may match more than one rule, so that recoding may repeat rows.
    """

    age: DataFrame
    gender: DataFrame
    race: DataFrame
    override: DataFrame
    hispanic: DataFrame
    fans_out: bool


def code_book(rules: DataFrame) -> CodeBook:
    """Match the rules with the codes instead of with the facts.

    Every recode depends on one raw code (and the race scheme), so the rule joins are done once per code of
    the rule table. Multiplicity is kept: a code with two matching rules appears twice in its lookup.
    A rule table of the usual size is held as a local relation; a larger one stays distributed.
    """
    rows = rules.take(sizing.CONTROL_ROWS + 1)
    if len(rows) <= sizing.CONTROL_ROWS:
        spans = [r.old_value_num_max - r.old_value_num_min for r in rows
                 if r.old_value_num_min is not None and r.old_value_num_max is not None]
        book, side, width, fans_out = local_frame(rules, rows), F.broadcast, _band_width(max(spans, default=0)), _overlaps(rows)
    else:
        book, side, width, fans_out = rules, small_side, None, bool(overlapping(rules).take(1))
    book = book.withColumn("value", F.expr("CAST(new_value_num AS SMALLINT)"))

    def in_range(codes, column, scheme=(), extra=""):
        ranges = book.where(f"old_column = '{column}'")
        codes, lookup, match = _band_match(codes, ranges, column, ["new_column", "value", *scheme], width)
        return codes.join(side(lookup), F.expr(match + extra))

    # Three characters of text give ages from -99 to 999.
    ages = rules.sparkSession.range(-99, 1000).selectExpr("CAST(id AS SMALLINT) AS age")
    age = _spread(in_range(ages, "age"), ["age"], AGE_BANDS)

    race = book.where("old_column = 'raw_racemars' AND old_value_txt IS NOT NULL AND r_type IS NOT NULL")
    race = race.withColumnRenamed("old_value_txt", "raw_racemars")
    race = _spread(race, ["raw_racemars", "r_type"], ["rcode"], RACE_FLAGS[:-1])
    hits = in_range(race, "rcode", ["r_type AS _scheme"], " AND r_type = _scheme")
    race = _spread(hits, race.columns, ["r1r3", "r2r4"])

    def exact(old_column, new_column, *columns):
        picked = book.where(f"old_column = '{old_column}' AND new_column = '{new_column}' AND old_value_txt IS NOT NULL")
        return side(picked.selectExpr(f"old_value_txt AS {old_column}", *columns))

    return CodeBook(
        age=small_side(age),
        gender=exact("raw_gender", "gender", "value AS gender"),
        race=small_side(race.withColumnRenamed("r2r4", "r2r4_base")),
        override=exact("raw_hispanic", "r2r4", "r_type", "value AS r2r4_override"),
        hispanic=exact("raw_hispanic", "race_hisp", "value AS race_hisp"),
        fans_out=fans_out,
    )


def _spread(hits, keys, required, optional=()):
    """One column per recode from matched rules, with a row for every combination of their values.

    Codes without a value for a ``required`` recode vanish, an ``optional`` one is null then.
    """
    names = [*required, *optional]
    lists = hits.groupBy(*keys).agg(*[
        F.expr(f"collect_list(struct(value)) FILTER (WHERE new_column = '{name}') AS {name}") for name in names])
    for name in names:
        explode = "explode" if name in required else "explode_outer"
        others = [c for c in lists.columns if c != name]
        lists = lists.selectExpr(*others, f"{explode}({name}) AS {name}")
    return lists.selectExpr(*keys, *[f"{name}.value AS {name}" for name in names])


def _overlaps(rows) -> bool:
    """True when two rules of one recode can match the same code."""
    texts, ranges = defaultdict(int), defaultdict(list)
    for rule in rows:
        recode = (rule.old_column, rule.new_column)
        key = (*recode, rule.r_type) if recode in _SCOPED else recode
        if recode not in _SCOPED and recode not in _UNSCOPED:
            continue
        if rule.old_value_txt is not None:
            texts[(*key, rule.old_value_txt)] += 1
        elif rule.old_value_num_min is not None and rule.old_value_num_max is not None:
            ranges[key].append((rule.old_value_num_min, rule.old_value_num_max))
    if any(n > 1 for n in texts.values()):
        return True
    return any(later[0] <= earlier[1] for spans in ranges.values()
               for earlier, later in zip(sorted(spans), sorted(spans)[1:]))


def overlapping(rules: DataFrame) -> DataFrame:
    """Rules that match a code that an earlier rule of the same recode (and scheme, where it counts) matches too.

    One sweep over the rules: texts by their value, ranges by their lower bounds, each beside the furthest end before it.
    """
    def listed(recodes):
        return F.array(*[F.concat_ws("\x00", F.lit(old), F.lit(new)) for old, new in recodes])

    recode = F.concat_ws("\x00", "old_column", "new_column")
    scoped = F.array_contains(listed(_SCOPED), recode)
    known = rules.where(scoped | F.array_contains(listed(_UNSCOPED), recode))
    known = known.withColumn("_scheme", F.when(scoped, F.col("r_type")))
    group = ["old_column", "new_column", "_scheme"]
    again = Window.partitionBy(*group, "old_value_txt").orderBy(F.lit(0))
    texts = known.where("old_value_txt IS NOT NULL").withColumn("_n", F.row_number().over(again)).where("_n > 1")
    before = Window.partitionBy(*group).orderBy("old_value_num_min").rowsBetween(Window.unboundedPreceding, -1)
    spans = known.where("old_value_txt IS NULL AND old_value_num_min <= old_value_num_max")
    spans = spans.withColumn("_end", F.max("old_value_num_max").over(before)).where("old_value_num_min <= _end")
    return texts.select(*rules.columns).unionByName(spans.select(*rules.columns))


def recode_facts(rows: DataFrame, rules: DataFrame | CodeBook, *, defaults: bool = True) -> DataFrame:
    """Add all analysis columns to rows with raw codes and ``r_type``; unmatched required codes drop rows.

    Five hash joins against lookups bounded by the code book: no shuffle of the facts and no extra scan.
    With ``defaults=False`` race flags stay null without a rule and ``r2r4_base`` and ``r2r4_override`` are
    kept apart, for groupings by the plain rule values.
    """
    book = rules if isinstance(rules, CodeBook) else code_book(rules)
    rows = rows.drop(*RECODED)
    out = rows.withColumn("age", parse_age("raw_agestr")).join(book.age, "age")
    out = out.join(book.gender, "raw_gender").join(book.race, ["raw_racemars", "r_type"])
    out = out.join(book.override, ["raw_hispanic", "r_type"], "left").join(book.hispanic, "raw_hispanic", "left")
    out = out.withColumn("age_100", top_code("age"))
    recoded = [c for c in RECODED if c != "r2r4"] + ["r2r4_base", "r2r4_override"]
    out = out.select(*rows.columns, *recoded)
    return fill_defaults(out) if defaults else out


def fill_defaults(rows: DataFrame) -> DataFrame:
    """Race flags without a rule become 0 and the ethnicity override wins over the race-based r2r4."""
    zero = F.lit(0).cast("smallint")
    flags = {name: F.coalesce(F.col(name), zero) for name in RACE_FLAGS}
    rows = rows.withColumns({**flags, "r2r4": F.coalesce("r2r4_override", "r2r4_base")})
    return rows.drop("r2r4_base", "r2r4_override")


# --- cascades -------------------------------------------------------------------------------------

def recode_cascade(rows: DataFrame, rules: DataFrame, *, policy: str = "first",
                   override_columns=("raw_hispanic",)) -> DataFrame:
    """Apply the rules one after another, as lookups of the rule that decides.

    ``policy="first"``: a rule only fills a null, except that rules on ``override_columns`` overwrite.
    ``policy="last"``: every matching rule overwrites. A rule that overwrites does so with null too. A rule without a
    text value is an inclusive range rule, and a rule without ``r_type`` applies to both schemes. Rules run by new and
    old column descending, so that a column can depend on one built before it (rcode before r2r4).

    Which rule wins is found on the rule side, per old value, for all columns in one grouped pass. Rows meet one lookup per
    old column, by equality and with at most one match. While the winners are few they are held as local relations, read once
    when the plan is built; more of them, wide ranges and ranges on fractions are looked up in tables that stay distributed.
    """
    if policy not in ("first", "last"):
        raise ValueError("policy must be 'first' or 'last'")
    rules = rules.where("old_column IS NOT NULL AND new_column IS NOT NULL").withColumn(
        "_at", F.monotonically_increasing_id())
    groups = _rule_groups(rows, rules, policy, set(override_columns))
    order = sorted(groups, reverse=True)
    names, ready, held = rows.columns, {}, _held_winners(rows, rules, groups)
    for at, new_column in enumerate(order):
        present = [g for g in groups[new_column] if g.old_column in rows.columns]
        for old in dict.fromkeys(g.old_column for g in present):
            if old not in ready:
                until = order.index(old) + 1 if old in order[at:] else len(order)
                users = [g for later in order[at:until] for g in groups[later] if g.old_column == old]
                if old in held:
                    rows, ready[old] = _attach_held(rows, held[old], old, users, f"_{at}_{len(ready)}")
                else:
                    rows, ready[old] = _attach_winners(rows, rules, old, users, f"_{at}_{len(ready)}")
        won = [(g, ready[g.old_column][new_column]) for g in present]
        rows = rows.withColumn(new_column, _decided(rows, new_column, won, groups[new_column][0].kind))
        ready.pop(new_column, None)
        names = [*names, new_column] if new_column not in names else names
    return rows.select(*map(_quoted, names))


@dataclass(frozen=True)
class _Group:
    """The rules of one new column on one old column."""

    new_column: str
    old_column: str
    kind: str  # type of the new column
    value: str  # SQL text of the new value of a rule
    fills: bool  # the first value that is not null wins; otherwise the last rule
    order: tuple[str, ...]
    schemes: tuple[int, ...]
    exact: bool
    widest: int | None  # of its range rules

    def decisive(self, column: Column) -> Column:
        return F.min(column) if self.fills else F.max(column)

    def best(self, *columns: Column) -> Column:
        return F.least(*columns) if self.fills else F.greatest(*columns)

    def winner(self) -> Column:
        """Place and value of a rule of this group, null for other rules."""
        mine = f"new_column = {_literal(self.new_column)}" + (f" AND {self.value} IS NOT NULL" if self.fills else "")
        return F.expr(f"CASE WHEN {mine} THEN struct({', '.join(self.order)}, {self.value} AS value) END")


def _rule_groups(rows, rules, policy, override_columns) -> dict[str, list[_Group]]:
    """Groups by new column, in the order in which they run. As many as pairs of column names."""
    first, second = ("new_value_num", "new_value_txt") if policy == "first" else ("new_value_txt", "new_value_num")
    tail = ("new_value_num", "new_value_txt") if policy == "first" else ("old_value_txt", "old_value_num_min")
    order = tuple(f"{c} IS NULL AS no_{c}, {c}" for c in tail) + ("_at",)
    text = f"new_value_txt IS NOT NULL AND (new_value_num IS NULL OR {str(policy == 'last').upper()})"
    found = rules.groupBy("new_column", "old_column").agg(
        F.collect_set("r_type").alias("schemes"), F.bool_or(F.expr(text)).alias("textual"),
        F.bool_or(F.col("old_value_txt").isNotNull()).alias("exact"),
        F.expr("max(CAST(old_value_num_max AS BIGINT) - old_value_num_min) FILTER (WHERE old_value_txt IS NULL)").alias("widest"),
    ).collect()
    groups: dict[str, list[_Group]] = defaultdict(list)
    for new_column in {g.new_column for g in found}:
        own = sorted((g for g in found if g.new_column == new_column), key=lambda g: g.old_column, reverse=True)
        textual = any(g.textual for g in own)
        if new_column in rows.columns:
            kind = rows.schema[new_column].dataType.simpleString()
        else:
            kind = "string" if textual else "smallint"
        either = f"coalesce(CAST({first} AS STRING), CAST({second} AS STRING))" if textual else "new_value_num"
        for g in own:
            groups[new_column].append(_Group(
                new_column, g.old_column, kind, f"CAST({either} AS {kind})",
                policy == "first" and g.old_column not in override_columns, order, tuple(sorted(g.schemes)),
                g.exact, g.widest))
    return groups


def _held_winners(rows, rules, groups) -> dict[str, dict[str, dict[tuple, str | None]]]:
    """By old column and old value: the new value of the rule that wins, by new column and scheme (None: any other one).

    Only for old columns whose rules are all met by equality: rules on a text, and narrow ranges of a whole number. Nothing
    if there are too many winners to hold.
    """
    by_old: dict[str, list[_Group]] = defaultdict(list)
    for group in groups.values():
        for g in group:
            by_old[g.old_column].append(g)

    def whole(old):
        kind = rows.schema[old].dataType if old in rows.columns else None
        return isinstance(kind, T.IntegralType) if kind else old in groups and groups[old][0].kind == "smallint"

    fit = {old: own for old, own in by_old.items()
           if all(g.widest is None or (g.widest <= _SPAN and whole(old)) for g in own)}
    if not fit:
        return {}
    flat = [g for own in fit.values() for g in own]

    def by_group(what, otherwise="NULL"):
        cases = " ".join(f"WHEN old_column = {_literal(g.old_column)} AND new_column = {_literal(g.new_column)} THEN {what(k, g)}"
                         for k, g in enumerate(flat))
        return f"CASE {cases} ELSE {otherwise} END"

    def listed_schemes(_, g):
        return f"CAST(array({', '.join(map(str, g.schemes))}) AS ARRAY<SMALLINT>)"

    # A rule for any scheme also stands against the rules of each scheme.
    schemes = by_group(listed_schemes, "CAST(array() AS ARRAY<SMALLINT>)")
    listed = rules.selectExpr(
        f"{by_group(lambda k, _: k)} AS number", f"{by_group(lambda _, g: str(g.fills).upper(), 'FALSE')} AS fills",
        f"{by_group(lambda _, g: f'CAST({g.value} AS STRING)')} AS value", f"struct({', '.join(flat[0].order)}) AS place",
        f"CASE WHEN r_type IS NULL THEN concat(array(CAST(NULL AS SMALLINT)), {schemes}) ELSE array(r_type) END AS schemes",
        "CASE WHEN old_value_txt IS NOT NULL THEN array(old_value_txt) WHEN old_value_num_min <= old_value_num_max "
        "THEN CAST(sequence(old_value_num_min, old_value_num_max) AS ARRAY<STRING>) END AS keys")
    listed = listed.where("number IS NOT NULL AND (value IS NOT NULL OR NOT fills)")
    listed = listed.selectExpr("number", "fills", "struct(place, value) AS win", "keys", "explode(schemes) AS scheme")
    listed = listed.selectExpr("number", "fills", "win", "scheme", "explode(keys) AS key")
    won = listed.groupBy("number", "fills", "scheme", "key").agg(F.min("win").alias("first"), F.max("win").alias("last"))
    won = won.selectExpr("number", "scheme", "key", "IF(fills, first.value, last.value) AS value")
    found = won.take(sizing.PINNED_ROWS + 1)
    if len(found) > sizing.PINNED_ROWS:
        return {}
    out: dict[str, dict[str, dict[tuple, str | None]]] = {old: defaultdict(dict) for old in fit}
    for r in found:
        g = flat[r.number]
        out[g.old_column][r.key][g.new_column, r.scheme] = r.value
    return out


def _attach_held(rows, winners, old, users, tag) -> tuple[DataFrame, dict[str, Column]]:
    """Join the held winners of one old column; the winner of each user's rules by new column."""
    key = f"{tag}_key"
    fields, shown, picks, asked = [T.StructField(key, T.StringType())], [key], {}, []
    for n, g in enumerate(users):
        names = {s: f"{tag}_{n}_{'any' if s is None else s}".replace("-", "m") for s in (None, *g.schemes)}
        for scheme, name in names.items():
            fields += [T.StructField(f"{name}_v", T.StringType()), T.StructField(f"{name}_m", T.BooleanType())]
            shown.append(f"CASE WHEN {name}_m THEN named_struct('value', CAST({name}_v AS {g.kind})) END AS {name}")
            asked.append((g.new_column, scheme))
        cases = " ".join(f"WHEN r_type = {s} THEN {names[s]}" for s in g.schemes)
        picks[g.new_column] = F.expr(f"CASE {cases} ELSE {names[None]} END" if cases else names[None])
    # What no rule of a scheme names is decided by the rules for any scheme.
    filled = [(value, *[x for new, scheme in asked for cell in [(new, scheme) if (new, scheme) in won else (new, None)]
                        for x in (won.get(cell), cell in won)]) for value, won in winners.items()]
    lookup = F.broadcast(local_rows(rows.sparkSession, T.StructType(fields), filled).selectExpr(*shown))
    column = F.col(_quoted(old))
    is_text = isinstance(rows.schema[old].dataType, T.StringType)
    return rows.join(lookup, (column if is_text else column.cast("string")) == F.col(key), "left"), picks


def _attach_winners(rows, rules, old, users, tag) -> tuple[DataFrame, dict[str, Column]]:
    """Join the lookups of one old column; the winner of each user's rules by new column."""
    column, kind = F.col(_quoted(old)), rows.schema[old].dataType
    is_text = isinstance(kind, T.StringType)
    mine = rules.where(F.col("old_column") == old)
    found: dict[str, list[Column]] = {g.new_column: [] for g in users}
    widest = [g.widest for g in users if g.widest is not None]
    alone = not (widest and any(g.exact for g in users))

    if any(g.exact for g in users):
        key, texts = f"{tag}_key", mine.where("old_value_txt IS NOT NULL")
        exact, picks = _by_key(texts.withColumn(key, F.col("old_value_txt")), key, users, f"{tag}_e", alone)
        rows = rows.join(exact, (column if is_text else column.cast("string")) == F.col(key), "left")
        for name, pick in picks.items():
            found[name].append(pick)

    if widest:
        width, key = _band_width(max(widest)), f"{tag}_band"
        spans = mine.where("old_value_txt IS NULL AND old_value_num_min <= old_value_num_max")
        bands = f"explode(sequence(CAST(floor(old_value_num_min / {width}) AS BIGINT), CAST(floor(old_value_num_max / {width}) AS BIGINT))) AS {key}"
        value = F.expr(f"TRY_CAST({_quoted(old)} AS DOUBLE)") if is_text else column
        place = F.floor(value / F.lit(width)).cast("bigint")
        if width == 1 and isinstance(kind, T.IntegralType):
            # A band is one value, so its winner is known.
            lookup, picks = _by_key(spans.selectExpr("*", bands), key, users, f"{tag}_r", alone)
            rows = rows.join(lookup, column.cast("bigint") == F.col(key), "left")
            for name, pick in picks.items():
                found[name].append(pick)
        else:
            # Equal ranges meet first; a band then lists each of its ranges once.
            spans = spans.groupBy("old_value_num_min", "old_value_num_max", "r_type").agg(
                *[g.decisive(g.winner()).alias(f"w{number}") for number, g in enumerate(users)]).selectExpr("*", bands)
            listed = spans.groupBy(key).agg(*[
                F.collect_list(F.expr(f"CASE WHEN w{number} IS NOT NULL THEN struct(old_value_num_min AS lo, "
                                      f"old_value_num_max AS hi, r_type, w{number} AS win) END")).alias(f"{tag}_r{number}")
                for number in range(len(users))])
            rows = rows.join(listed, place == F.col(key), "left")
            for number, g in enumerate(users):
                hits = F.filter(f"{tag}_r{number}", lambda x: value.between(x["lo"], x["hi"]))
                if g.schemes:
                    hits = F.filter(hits, lambda x: x["r_type"].isNull() | (x["r_type"] == F.col("r_type")))
                hits = F.transform(hits, lambda x: x["win"])
                found[g.new_column].append(F.array_min(hits) if g.fills else F.array_max(hits))

    best = {g.new_column: g.best for g in users}
    return rows, {name: best[name](*w) if len(w) > 1 else w[0] for name, w in found.items()}


def _by_key(rules, key, users, tag, alone) -> tuple[DataFrame, dict[str, Column]]:
    """The winners per key, one column for each user and scheme, and which of them a row takes.

    ``alone`` leaves out the winners' places, which nothing is compared with then.
    """
    raw, shown, picks = [], [], {}
    for number, g in enumerate(users):
        names = {s: f"{tag}{number}_{'any' if s is None else s}".replace("-", "m") for s in (None, *g.schemes)}
        for scheme, name in names.items():
            same = F.col("r_type").isNull() if scheme is None else F.col("r_type") == scheme
            raw.append(g.decisive(F.when(same, g.winner())).alias(name))
            win = F.col(name) if scheme is None else g.best(F.col(name), F.col(names[None]))
            shown.append((F.when(win.isNotNull(), F.struct(win["value"].alias("value"))) if alone else win).alias(name))
        pick = F.col(names[None])
        for scheme in g.schemes:
            pick = F.when(F.col("r_type") == scheme, F.col(names[scheme])).otherwise(pick)
        picks[g.new_column] = pick
    return rules.groupBy(key).agg(*raw).select(key, *shown), picks


def _decided(rows, new_column, won, kind) -> Column:
    """The value of a new column from the winners of its groups, which run in the given order."""
    nothing = F.lit(None).cast(kind)
    start = F.col(_quoted(new_column)) if new_column in rows.columns else nothing
    def filled(groups):
        return F.coalesce(*[w["value"] for g, w in groups if g.fills], nothing)

    result = F.coalesce(start, filled(won))
    for place, (g, w) in enumerate(won):
        if not g.fills:
            # What overwrites with null can be filled by the groups that follow.
            result = F.when(w.isNotNull(), F.coalesce(w["value"], filled(won[place + 1:]))).otherwise(result)
    return result


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


# --- small areas ----------------------------------------------------------------------------------

def attach_area(rows: DataFrame, areas: DataFrame, geo_year: str, *, out: str = "hra_id") -> DataFrame:
    """Left-join the small-area id of a block for one geography year."""
    year = areas.where(F.col("geo_year") == geo_year)
    lookup = year.select(F.col("blk_geo_id").alias("geo_id"), F.col("hra_id").alias(out))
    return rows.join(small_side(lookup), "geo_id", "left")
