"""Line dedup over range-partitioned line hashes, all in DataFrame functions.

Every long line becomes a hash with its document and position. The hashes are range-partitioned by (hash, document) and
sorted by position after that, so the first occurrence of a line in each document is found while rows stream by, and a
line that very many documents hold is spread over several partitions. Hashes in enough documents lose their lines
everywhere but in the last document. The result is a compressed bitmap per document that says which lines stay; texts are
only read again by whoever applies it.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.llm.common import Scratch, free

#: The white space that a key does without at both ends.
BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 40, 5
#: Bits of one word of a bitmap.
WORD = 64


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case and all other letters as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    # Only ASCII has as many bytes as characters, and there lower() touches nothing but A-Z.
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, ascii_uppercase, ascii_lowercase))


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def _body(docs: DataFrame) -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(_text(docs))


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """(hash, doc_id, body, pos) of every line whose key is long enough; hash is 128 bits of the key's SHA-256."""
    known = docs.where(docs["doc_id"].isNotNull())
    lines = known.select(known["doc_id"].alias("doc_id"), _body(known).alias("body"),
                         F.posexplode(F.split(_text(known), "\n", -1)).alias("pos", "line"))
    # A line is never shorter than its key, so short ones go before keys are made.
    keys = lines.where(F.char_length("line") >= least_chars).select("doc_id", "body", "pos", line_key(F.col("line")).alias("key"))
    long = keys.where(F.char_length("key") >= least_chars)
    return long.select(F.unhex(F.substring(F.sha2(F.col("key"), 256), 1, 32)).alias("hash"), "doc_id", "body", "pos")


def occurrences(hashes: DataFrame) -> DataFrame:
    """``hashes`` without repeats, with ``first``: whether it is the first occurrence of the line in its document.

    Rows are range-partitioned by (hash, doc_id) and sorted by position inside, in one shuffle. Repeats of whole rows are
    dropped map-side before it, so a group of one hash and document holds no more rows than the texts of the document have lines.
    """
    place = Window.partitionBy("hash", "doc_id").orderBy("pos", "body")
    spread = hashes.distinct().repartitionByRange("hash", "doc_id")
    return spread.withColumn("first", F.row_number().over(place) == 1)


def keep_bitmaps(docs: DataFrame, *, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, body, n_dropped, keep) of every document that loses lines; one that is not listed keeps all.

    ``keep`` holds the words of the document's bitmap in order, as (word, bits): line ``64 * word + b`` stays if bit b is
    set. Words in which every line stays are left out. ``body`` tells texts of one doc_id apart.

    Keys of at least ``least_chars`` code points that at least ``least_docs`` documents hold lose their lines in all but the
    largest doc_id. Rows that share a doc_id are one document: it counts once, and as the largest it keeps the line in
    each of its rows. Rows without doc_id count for nothing and lose nothing. Null and empty texts have one empty line.
    Columns beyond doc_id and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    found = scratch.keep(occurrences(line_hashes(docs, least_chars)), "lines")
    held = found.where("first").groupBy("hash").agg(F.count("*").alias("held"), F.max("doc_id").alias("last"))
    # Stored, so that a hash of very many lines can be split in the join.
    common = scratch.keep(held.where(F.col("held") >= least_docs).select("hash", "last"), "common")
    gone = found.join(common, "hash").where("doc_id < last")
    words = gone.groupBy("doc_id", "body", F.shiftright("pos", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, pos & 63))").alias("gone"))
    # As many words as the text has lines at most, so the list of a document is smaller than its text.
    lists = words.groupBy("doc_id", "body").agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"))
    return scratch.keep(lists, "bitmaps")


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps. The words are laid side by side first, so each line costs one look."""
    gaps = F.transform(keep, lambda w, i: F.concat(
        F.array_repeat(F.lit(-1).cast("long"), w["word"] - F.when(i > 0, F.get(keep, i - 1)["word"]).otherwise(-1) - 1),
        F.array(w["bits"])))
    # Bound once per row; a plain column could be worked out again for each line.
    both = F.array(F.struct(lines.alias("lines"), F.flatten(gaps).alias("words")))

    def stays(words, i):
        word = F.get(words, F.shiftright(i, 6))
        return F.coalesce(F.call_function("shiftrightunsigned", word, i.bitwiseAND(F.lit(WORD - 1))).bitwiseAND(F.lit(1).cast("long")) == 1,
                          F.lit(True))

    return F.get(F.transform(both, lambda b: F.filter(b["lines"], lambda _, i: stays(b["words"], i))), F.lit(0))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, kept: str = "kept") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and the text of the lines that stay, named ``kept``.

    One row per row of ``docs``; its other columns stay as they are. The new names must be free.
    """
    if taken := {c.lower() for c in docs.columns} & {"n_lines", "n_dropped", kept.lower()}:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    own, names = free("own", docs), docs.columns
    rows = docs.withColumn(own, _body(docs))
    side = bitmaps.select(F.col("doc_id").alias("of"), "body", F.col("n_dropped").alias("gone"), "keep").hint("shuffle_hash")
    joined = rows.join(side, (rows["doc_id"] == side["of"]) & (rows[own] == side["body"]), "left")
    lines = F.split(_text(rows), "\n", -1)
    out = F.when(side["keep"].isNull(), _text(rows)).otherwise(F.array_join(kept_lines(lines, side["keep"]), "\n"))
    return joined.select(*[rows[c] for c in names], F.size(lines).cast("long").alias("n_lines"),
                         F.coalesce(side["gone"], F.lit(0)).cast("long").alias("n_dropped"), out.alias(kept))


def deduplicate(docs: DataFrame, *, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept: each text without the lines that its bitmap drops. See ``keep_bitmaps``."""
    slim = docs.select("doc_id", "text")
    bitmaps = keep_bitmaps(slim, least_chars=least_chars, least_docs=least_docs)
    return apply_bitmaps(slim, bitmaps).select("doc_id", "n_lines", "n_dropped", "kept")
