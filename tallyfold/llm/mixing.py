"""Mixing to target weights with soft domains, all in DataFrame functions.

A naive Bayes classifier over hashed words, learnt from a table of labelled texts, gives each document a posterior over
domains. Nonnegative rates r_i then minimise sum_d (sum_i r_i n_i p_id - T_d)^2 / N_d, where n_i are the words of a
document, N_d the expected words of a domain and T_d its target. With steps scaled by 1 / n_i the largest curvature is
1, so a step of one is safe. A step needs one sum per domain; the rates themselves never leave the executors.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import Scratch, free

BLANKS = r"[\x20\x09-\x0D]+"
BUCKETS = 4096
#: Bound of the labelled rows that the classifier is fitted on.
SAMPLE_ROWS = 4000
#: Words of a document that count as independent evidence; more only sharpen the average.
EVIDENCE = 40
STORED_EVERY = 8  # steps between stored rates
#: No progress: over so many steps the objective fell by less than this share of itself.
PATIENCE, PROGRESS = 64, 0.01
TOLERANCE = 1e-3  # of a target


def _words(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), BLANKS)


def _bucket(word: Column) -> Column:
    return F.when(word != "", F.pmod(F.xxhash64(F.lower(word)), F.lit(BUCKETS)))


def learn(texts: DataFrame, labelled: DataFrame, domains: list[str], scratch: Scratch, *,
          sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, list[float]]:
    """(bucket, one log likelihood per domain) with at most BUCKETS rows, and log priors.

    ``labelled`` has doc_id and domain, ``texts`` doc_id and text. At most ``sample_rows`` labelled rows, those of the
    smallest hash, are used; rows of other domains are not.
    """
    known = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    chosen = known.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = texts.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = scratch.keep(rows.select("domain", "text"), "sample")
    docs = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(docs.values())
    priors = [float((docs.get(d, 0) + 1) / (total + len(domains))) for d in domains]
    width = range(len(domains))
    words = rows.select("domain", F.explode(_words(F.col("text"))).alias("word")).where("word <> ''")
    tallies = words.groupBy(_bucket(F.col("word")).alias("bucket")).agg(
        *[F.sum(F.when(F.col("domain") == d, 1.0).otherwise(0.0)).alias(f"c{k}") for k, d in enumerate(domains)])
    buckets = texts.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    every = scratch.keep(buckets.join(tallies, "bucket", "left").na.fill(0.0), "tallies")
    sums = every.agg(*[F.sum(f"c{k}").alias(f"s{k}") for k in width]).first()
    weights = every.select("bucket", *[
        F.log((F.col(f"c{k}") + 0.5) / F.lit(float(sums[k]) + 0.5 * BUCKETS)).alias(f"w{k}") for k in width])
    return weights, [log(p) for p in priors]


def posteriors(docs: DataFrame, weights: DataFrame, log_priors: list[float]) -> DataFrame:
    """(doc_id, body, n, p0, p1, ...) per row: body is a hash of the text, n its words. Without words p is the prior."""
    width = range(len(log_priors))
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    words = rows.select("row", "doc_id", F.xxhash64("text").alias("body"),
                        F.explode(_words(F.col("text"))).alias("word"))
    cells = words.select("row", "doc_id", "body", _bucket(F.col("word")).alias("b"))
    met = cells.join(F.broadcast(weights), F.col("b") == F.col("bucket"), "left")
    sums = met.groupBy("row", "doc_id", "body").agg(F.count("b").alias("n"), *[F.sum(f"w{k}").alias(f"s{k}") for k in width])
    scale = F.least(F.col("n"), F.lit(EVIDENCE)) / F.greatest(F.col("n"), F.lit(1))
    scores = [F.lit(log_priors[k]) + F.coalesce(F.col(f"s{k}"), F.lit(0.0)) * scale for k in width]
    shown = sums.select("doc_id", "body", "n", *[s.alias(f"s{k}") for k, s in enumerate(scores)])
    top = F.greatest(*[F.col(f"s{k}") for k in width]) if len(log_priors) > 1 else F.col("s0")
    raised = shown.select("doc_id", "body", "n", *[F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in width])
    whole = sum((F.col(f"e{k}") for k in width), F.lit(0.0))
    return raised.select("doc_id", "body", "n", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in width])


@dataclass
class Fit:
    """Rates per document, and what they reach: expected words per domain and their targets."""
    rates: DataFrame
    reached: list[float]
    targets: list[float]
    steps: int


def fit_rates(table: DataFrame, shares: list[float], scratch: Scratch, *, least: float = 0.0,
              tolerance: float = TOLERANCE, max_steps: int | None = None) -> Fit:
    """Projected gradient on (n, p0, ...) of a stored table; rates start at 1 and stay at or above ``least``.

    The whole is as large as keeping every domain's words asks for: the largest of N_d / share_d. Domains without words
    or without share have no target. A table without words keeps rate 1.

    Steps go on until every domain is within ``tolerance`` of its target, or without progress: the objective fell by less
    than PROGRESS of itself over PATIENCE steps, or a step changed nothing. ``reached`` then tells what was missed.
    """
    width = range(len(shares))
    total = sum(shares)

    def masses(rows):
        found = rows.agg(*[F.sum(F.col("rate") * F.col("n") * F.col(f"p{k}")) for k in width]).first()
        return [float(v or 0.0) for v in found]

    rows = table.withColumn("rate", F.lit(1.0))
    start = masses(rows)
    live = [k for k in width if start[k] > 0 and shares[k] > 0]
    whole = max((start[k] * total / shares[k] for k in live), default=0.0)
    targets = [whole * shares[k] / total if k in live else 0.0 for k in width]
    reached, steps, gaps = start, 0, []
    while steps != max_steps and any(abs(reached[k] - targets[k]) > tolerance * targets[k] for k in live):
        push = sum((F.col(f"p{k}") * F.lit((targets[k] - reached[k]) / start[k]) for k in live), F.lit(0.0))
        rows = rows.withColumn("rate", F.greatest(F.lit(float(least)), F.col("rate") + push))
        steps += 1
        if steps % STORED_EVERY == 0:
            rows = scratch.keep(rows, f"rates-{steps}")
            scratch.drop(f"rates-{steps - STORED_EVERY}")
        before, reached = reached, masses(rows)
        if max(abs(a - b) for a, b in zip(before, reached)) <= 1e-9 * whole:
            break  # the bound on the rates keeps the targets out of reach
        gaps.append(sum((reached[k] - targets[k]) ** 2 / start[k] for k in live))
        if steps > PATIENCE and gaps[-1] > (1 - PROGRESS) * gaps[-1 - PATIENCE]:
            break
    return Fit(rows, reached, targets, steps)


def mix(docs: DataFrame, labelled: DataFrame, shares: dict[str, float], *, texts: DataFrame | None = None,
        least: float = 0.0, seed: int = 7) -> DataFrame:
    """doc_id, body, n_tokens, p_<domain> ..., rate, copies, reached_<domain> ..., target_<domain> ... for each row.

    reached and target are the expected words of a domain at these rates and those aimed at, the same in all rows; a
    domain without words or share has target 0. Targets that the bound on the rates or overlapping domains keep out of
    reach show there, and a warning names them.

    copies is the rate rounded down or up by a hash of doc_id and text, so its mean is the rate. Null and empty texts
    have no words, the prior and a rate like others. The classifier learns the domains that ``labelled`` (doc_id,
    domain) states from ``texts``, by default ``docs``. Rows without doc_id and repeated rows are treated like any other.
    Columns beyond doc_id and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    domains = sorted(shares)
    weights, priors = learn(docs if texts is None else texts, labelled, domains, scratch)
    table = scratch.keep(posteriors(docs, weights, priors), "posteriors")
    fit = fit_rates(table, [float(shares[d]) for d in domains], scratch, least=least)
    missed = [f"{d}: {r:.0f} of {t:.0f}" for d, r, t in zip(domains, fit.reached, fit.targets)
              if t and abs(r - t) > TOLERANCE * t]
    if missed:
        warnings.warn(f"target words missed after {fit.steps} steps: {', '.join(missed)}", stacklevel=2)
    chance = F.pmod(F.xxhash64("doc_id", "body", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return fit.rates.select(
        "doc_id", "body", F.col("n").alias("n_tokens"), *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)],
        "rate", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).alias("copies"),
        *[F.lit(r).alias(f"reached_{d}") for d, r in zip(domains, fit.reached)],
        *[F.lit(t).alias(f"target_{d}") for d, t in zip(domains, fit.targets)])


def mixed(docs: DataFrame, labelled: DataFrame, shares: dict[str, float], *, texts: DataFrame | None = None,
          least: float = 0.0, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` in as many copies as ``mix`` gives them, with the columns they had."""
    found = mix(docs, labelled, shares, texts=texts, least=least, seed=seed)
    copies = found.groupBy("doc_id", "body").agg(F.max("copies").alias("copies"))
    named = copies.select(F.col("doc_id").alias("of"), F.col("body").alias("held"), "copies")
    same = docs["doc_id"].eqNullSafe(named["of"]) & F.xxhash64(docs["text"]).eqNullSafe(named["held"])
    rows, time = docs.join(named, same).where(named["copies"] > 0), free("time", docs)
    return rows.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), named["copies"])).alias(time)).drop(time)
