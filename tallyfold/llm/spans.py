"""Substring dedup by compaction of the De Bruijn graph of word runs.

Nodes are runs of width - 1 words, edges runs of ``width`` words. An edge in several documents is repeated; its source
is a place in a text of the smallest of them. Repeated edges that follow each other without a branch, also at their source,
are compacted into a path: a row (source, start, length). An edge then is an offset on a path, and what a document repeats
is a list of stretches of paths. A stretch is compared word by word, through digests, with the source that its path names.

Most windows occur once. They are set aside first: each window has a least hash among its short word runs, two equal
windows have the same one, and only windows whose least hash occurs again are looked at as edges. Of documents with the same
text only the smallest is looked at; the others repeat it from the first word to the last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import Scratch, Words, in_chunks, rolled, text_bytes

WIDTH = 13
SHORT = 3  # words whose least hash stands for a window
TRIES = 4  # seeds that are tried when different words share a hash
PIECE = 256  # windows of a block of a text; spans are compared in pieces that lie in one block on both sides
_LOW = (1 << 31) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, body (31 bits of a hash of the text, to tell texts of one doc_id apart) and text."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "body", F.xxhash64("text").bitwiseAND(F.lit(_LOW)))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def seeds(keyed: DataFrame, width: int, seed: int) -> DataFrame:
    """(least, doc_id, body, run): consecutive windows with the same least hash; run packs the first and the count."""
    short = min(SHORT, width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, texts in in_chunks(map(text_bytes, batch["text"])):
                words = Words(texts)
                grams = rolled(words.keys(seed), short)
                if len(grams) < width - short + 1:
                    continue
                least = _sliding_min(grams, width - short + 1)
                of = words.text_of()
                at = np.flatnonzero(of[:len(least)] == of[width - 1:])  # windows inside one text
                if not len(at):
                    continue
                owner = of[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (least[at[1:]] != least[at[:-1]]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(at)))
                text = owner[first]
                place = at[first] - words.first[text]
                part = batch.iloc[lo:lo + len(texts)]
                yield pd.DataFrame({
                    "least": least[at[first]].view(np.int64), "doc_id": part["doc_id"].to_numpy()[text],
                    "body": part["body"].to_numpy()[text], "run": place << 31 | count})

    return keyed.mapInPandas(run, "least long, doc_id long, body long, run long")


def walks(flagged: DataFrame, width: int, seed: int) -> DataFrame:
    """(doc_id, body, at, nodes): the node hashes along each stretch of windows that are looked at."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, texts in in_chunks(map(text_bytes, batch["text"])):
                words = Words(texts)
                nodes = rolled(words.keys(seed), width - 1).view(np.int64)
                out = []
                for k in range(len(texts)):
                    row = batch.iloc[lo + k]
                    runs = np.unique(np.asarray(row["runs"]))
                    start, count = runs >> 31, runs & _LOW
                    head = np.ones(len(runs), dtype=bool)
                    head[1:] = start[1:] != start[:-1] + count[:-1]
                    first = np.flatnonzero(head)
                    ends = (start + count)[np.append(first[1:] - 1, len(runs) - 1)]
                    base = words.first[k]
                    out += [(row["doc_id"], row["body"], a, nodes[base + a:base + b + 1])
                            for a, b in zip(start[first].tolist(), ends.tolist())]
                yield pd.DataFrame(out, columns=["doc_id", "body", "at", "nodes"])

    return flagged.mapInPandas(run, "doc_id long, body long, at long, nodes array<long>")


def occurrences(walked: DataFrame) -> DataFrame:
    """(u, v, doc_id, spot): every edge of the walks; spot packs body and the place of the window."""
    n = F.size("nodes") - 1
    pairs = F.arrays_zip(F.slice("nodes", 1, n).alias("u"), F.slice("nodes", 2, n).alias("v"))
    base = F.shiftleft("body", 32) + F.col("at")
    return walked.select("doc_id", base.alias("base"), F.posexplode(pairs).alias("k", "e")).select(
        F.col("e.u").alias("u"), F.col("e.v").alias("v"), "doc_id", (F.col("base") + F.col("k")).alias("spot"))


def repeated_edges(walked: DataFrame) -> DataFrame:
    """(u, v, source, place) of edges in several documents: the smallest doc_id and a spot there.

    A spot names the text too, so neighbouring spots are places of one text where several texts share a doc_id.
    """
    found = occurrences(walked).groupBy("u", "v").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.min_by("spot", "doc_id").alias("place"))
    return found.where("source < last").drop("last")


def joined(edges: DataFrame) -> DataFrame:
    """Nodes that join their only edge in and their only edge out, if the sources of the two follow each other in one text."""
    out = edges.select(F.col("u").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), "source", "place")
    into = edges.select(F.col("v").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), "source", "place")

    def only(side, column):
        return F.max(F.when(F.col(side) == 1, F.col(column)))

    nodes = out.unionByName(into).groupBy("node").agg(
        F.sum("o").alias("outs"), F.sum("i").alias("ins"),
        only("o", "source").alias("to"), only("o", "place").alias("to_place"),
        only("i", "source").alias("origin"), only("i", "place").alias("from_place"))
    return nodes.where("outs = 1 AND ins = 1 AND to = origin AND from_place + 1 = to_place").select("node")


def compacted(edges: DataFrame) -> DataFrame:
    """``edges`` with ``start``, the spot at which the path of the edge begins.

    An edge whose first node joins it to another one belongs to the path of that one, so along a source text a path goes on
    up to the next edge that is not joined. A group holds the edges whose source is one text, at most as many as its words.
    """
    nodes = joined(edges).select(F.col("node").alias("joint"))
    rows = edges.join(nodes, edges["u"] == nodes["joint"], "left")
    along = Window.partitionBy("source", F.shiftright("place", 32)).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.when(F.col("joint").isNull(), F.col("place"))
    return rows.select("u", "v", "source", "place", F.last(begins, ignorenulls=True).over(along).alias("start"))


def path_table(compact: DataFrame) -> DataFrame:
    """(source, start, length): every path once; length counts its edges."""
    return compact.groupBy("source", "start").agg(F.count("*").alias("length"))


def repeats(walked: DataFrame, compact: DataFrame) -> DataFrame:
    """(doc_id, body, places, sources, starts, offsets): the edges that a document repeats from a smaller doc_id, each as a
    path and the offset on it."""
    met = occurrences(walked).join(compact, ["u", "v"]).where("doc_id > source")
    return met.groupBy("doc_id", F.shiftright("spot", 32).alias("body")).agg(
        F.collect_list(F.col("spot").bitwiseAND(F.lit((1 << 32) - 1))).alias("places"),
        F.collect_list("source").alias("sources"), F.collect_list("start").alias("starts"),
        F.collect_list((F.col("place") - F.col("start")).cast("int")).alias("offsets"))


def stretches(found: DataFrame) -> DataFrame:
    """(doc_id, body, at, n, source, start, offset): stretches of n windows that run along one path."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, body, places, *origin in batch.itertuples(index=False):
                at, order = np.unique(places, return_index=True)
                source, start, offset = (np.asarray(x)[order] for x in origin)
                new = np.ones(len(at), dtype=bool)
                new[1:] = ((at[1:] != at[:-1] + 1) | (source[1:] != source[:-1]) | (start[1:] != start[:-1])
                           | (offset[1:] != offset[:-1] + 1))
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                out.append(pd.DataFrame({"doc_id": doc_id, "body": body, "at": at[first], "n": n, "source": source[first],
                                         "start": start[first], "offset": offset[first]}))
            yield pd.concat(out) if out else pd.DataFrame(
                columns=["doc_id", "body", "at", "n", "source", "start", "offset"])

    return found.mapInPandas(run, "doc_id long, body long, at long, n long, source long, start long, offset long")


def spans_of(stretched: DataFrame, paths: DataFrame) -> DataFrame:
    """(doc_id, body, at, n, source, place): the part of each stretch that its path covers, place being its spot there."""
    n = F.least("n", F.col("length") - F.col("offset"))
    return stretched.join(paths, ["source", "start"]).select(
        "doc_id", "body", "at", n.alias("n"), "source", (F.col("start") + F.col("offset")).alias("place")).where("n > 0")


def pieces(spans: DataFrame, size: int) -> DataFrame:
    """``spans`` cut where ``at`` or the place at the source is a multiple of ``size``; together they cover the same."""
    def cuts(column):
        first = size - F.pmod(column, F.lit(size))
        return F.when(first < F.col("n"), F.sequence(first, F.col("n") - 1, F.lit(size).cast("long"))).otherwise(
            F.array().cast("array<bigint>"))

    zero = F.array(F.lit(0).cast("long"))
    starts = spans.withColumn("starts", F.array_sort(F.array_union(zero, F.array_union(cuts("at"), cuts("place")))))
    each = F.transform("starts", lambda k, i: F.struct(
        k.alias("from"), (F.coalesce(F.try_element_at("starts", (i + 2).cast("int")), F.col("n")) - k).alias("windows")))
    return starts.select("doc_id", "body", "at", "source", "place", F.inline(each)).select(
        "doc_id", "body", (F.col("at") + F.col("from")).alias("at"), F.col("windows").alias("n"), "source",
        (F.col("place") + F.col("from")).alias("place"))


def asked_of(cut: DataFrame, size: int) -> DataFrame:
    """(doc_id, body, block, runs): the pieces asked of each block of a text, by its own spans or as a source.

    A block has at most size * (size + 1) / 2 pieces, however many documents quote it.
    """
    text, place = F.shiftright("place", 32), F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
    asked = cut.select("doc_id", "body", "at", "n").unionByName(
        cut.select(F.col("source").alias("doc_id"), text.alias("body"), place.alias("at"), "n"))
    return asked.distinct().groupBy("doc_id", "body", F.floor(F.col("at") / size).alias("block")).agg(
        F.collect_list(F.shiftleft("at", 31) + F.col("n")).alias("runs"))


def text_blocks(keyed: DataFrame, width: int, size: int) -> DataFrame:
    """(doc_id, body, block, words): the words of each ``size`` windows of a text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, texts in in_chunks(map(text_bytes, batch["text"])):
                out = []
                for text, doc_id, body in zip(texts, batch["doc_id"][lo:], batch["body"][lo:]):
                    words = text.split()
                    out += [(doc_id, body, at // size, b" ".join(words[at:at + size + width - 1]))
                            for at in range(0, len(words) - width + 1, size)]
                yield pd.DataFrame(out, columns=["doc_id", "body", "block", "words"])

    return keyed.mapInPandas(run, "doc_id long, body long, block long, words binary")


def digests(keyed: DataFrame, asked: DataFrame, width: int, size: int) -> DataFrame:
    """(doc_id, body, at, n, digest): 128 bits of the words that the n windows of each asked piece cover."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, body, block, text, runs in batch.itertuples(index=False):
                words = text.split()
                for packed in np.asarray(runs).tolist():
                    at, n = packed >> 31, packed & _LOW
                    first = at - block * size
                    end = first + n + width - 1
                    if end <= len(words):
                        out.append((doc_id, body, at, n, xxhash.xxh3_128_digest(b" ".join(words[first:end]))))
            yield pd.DataFrame(out, columns=["doc_id", "body", "at", "n", "digest"])

    wanted = asked.select("doc_id", "body").distinct().hint("shuffle_hash")
    texts = keyed.join(wanted, ["doc_id", "body"], "left_semi")
    rows = text_blocks(texts, width, size).join(asked, ["doc_id", "body", "block"])
    return rows.select("doc_id", "body", "block", "words", "runs").mapInPandas(
        run, "doc_id long, body long, at long, n long, digest binary").distinct()


def verified(keyed: DataFrame, spans: DataFrame, width: int, scratch: Scratch) -> bool:
    """Whether the words of all spans are those at their source. If not, two edges share hashes.

    Spans are cut at the blocks of both texts, and pieces that say the same of one source are counted together before
    the two sides meet.
    """
    cut = pieces(spans, PIECE)
    told = scratch.keep(digests(keyed, asked_of(cut, PIECE), width, PIECE), "digests")
    own = cut.join(told, ["doc_id", "body", "at", "n"], "left").groupBy("source", "place", "n", "digest").count()
    spot = F.shiftleft("body", 32) + F.col("at")
    origin = told.select(F.col("doc_id").alias("source"), spot.alias("place"), "n", "digest").distinct()
    wrong = own.join(origin, ["source", "place", "n", "digest"], "left_anti").limit(1).count()
    scratch.drop("digests")
    return not wrong


def removed(keyed: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words of every row."""
    lists = spans.groupBy("doc_id", "body").agg(F.collect_list(F.shiftleft("at", 31) + F.col("n")).alias("runs"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, runs in zip(batch["text"], batch["runs"]):
                words = text_bytes(text).split()
                n = len(words)
                if runs is not None and n >= width:
                    keep = np.ones(n, dtype=bool)
                    for packed in np.asarray(runs).tolist():
                        keep[packed >> 31:(packed >> 31) + (packed & _LOW) + width - 1] = False
                    words = [w for w, k in zip(words, keep) if k]
                out.append((n, n - len(words), b" ".join(words).decode("utf-8", "replace")))
            told = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
            told.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield told

    rows = keyed.join(lists.hint("shuffle_hash"), ["doc_id", "body"], "left").select("doc_id", "text", "runs")
    return rows.mapInPandas(run, "doc_id long, n_words long, n_removed long, kept string")


def later_copies(known: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, body) of the documents whose text a smaller doc_id has too."""
    texts = scratch.keep(known.select("doc_id", "body", F.unhex(F.sha2("text", 256)).alias("same")), "texts")
    least = texts.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    least = scratch.keep(least.where("first < last").select("same", "first"), "least")
    return scratch.keep(texts.join(least, "same").where("doc_id > first").select("doc_id", "body").distinct(), "copies")


def repeated_spans(known: DataFrame, copies: DataFrame, width: int, seed: int, scratch: Scratch) -> DataFrame:
    """(doc_id, body, at, n, source, place): stretches of windows of a document that are also at a place of a smaller one."""
    every = scratch.keep(seeds(known, width, seed), "seeds")
    met = every.groupBy("least").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    again = scratch.keep(met.where("first < last").select("least"), "again")
    flags = every.join(again, "least").groupBy("doc_id", "body").agg(F.collect_list("run").alias("runs"))
    flags = scratch.keep(flags.join(copies, ["doc_id", "body"], "left_anti"), "flags")
    scratch.drop("seeds", "again")
    flagged = known.join(flags.hint("shuffle_hash"), ["doc_id", "body"]).select("doc_id", "body", "text", "runs")
    walked = scratch.keep(walks(flagged, width, seed), "walks")
    scratch.drop("flags")
    edges = scratch.keep(repeated_edges(walked), "edges")
    compact = scratch.keep(compacted(edges), "compact")
    scratch.drop("edges")
    paths = scratch.keep(path_table(compact), "paths")
    stretched = scratch.keep(stretches(repeats(walked, compact)), "stretches")
    scratch.drop("walks", "compact")
    spans = scratch.keep(spans_of(stretched, paths), "spans")
    scratch.drop("stretches", "paths")
    return spans


def deduplicate(docs: DataFrame, *, width: int = WIDTH, seed: int = 0) -> DataFrame:
    """doc_id, n_words, n_removed, kept: each text without the words of windows that a smaller doc_id also has.

    One row per input row. Words are what ASCII white space parts, unchanged; null and empty texts have none. Windows
    are judged on the input. Rows that share a doc_id never remove from each other. Rows without doc_id keep all words
    and remove none. Columns other than doc_id and text are not read. Where different words turn out to share a hash, the
    work is done again with the next seed.
    """
    if width < 2:
        raise ValueError("width must be at least 2")
    scratch = Scratch(docs.sparkSession, "spans")
    keyed = _keyed(docs)
    known = keyed.where("doc_id IS NOT NULL")
    copies = later_copies(known, scratch)
    for number in range(seed, seed + TRIES):
        spans = repeated_spans(known, copies, width, number, scratch)
        if verified(known, spans, width, scratch):
            break
    else:
        raise RuntimeError(f"different runs of words share a hash under each of {TRIES} seeds")
    whole = copies.select("doc_id", "body", F.lit(0).cast("long").alias("at"), F.lit(_LOW).cast("long").alias("n"))
    return removed(keyed, spans.select("doc_id", "body", "at", "n").unionByName(whole), width)
