"""Byte-level BPE: encoding by a queue of merge ranks over a linked list of symbols, decoding by concatenation.

Only vocabulary, merges and added tokens of a tokenizer file are used; nothing is trained. Spark deals the documents
out; each task encodes its own with the tables broadcast to it, whose size is that of the file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F, types as T

#: Fixed value: how byte-level files cut a text before merging.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Pieces whose ids a worker remembers, twice: a full memory becomes the older one. This changes nothing but time.
REMEMBERED = 300_000
_SHIFT = 20  # bits of an id
_GONE = 1 << 40  # no id


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it can be printed, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Bpe:
    """Tables of one tokenizer file."""

    def __init__(self, spec: str):
        said = json.loads(spec)
        model, cut = said["model"], said["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or said["normalizer"] or cut["add_prefix_space"]:
            raise ValueError("only byte-level BPE files without normalizer and prefix space are read")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in said["added_tokens"]):
            raise ValueError("added tokens that take white space or need word bounds are not read")
        vocab = model["vocab"]
        letters = byte_letters()
        values = {c: b for b, c in letters.items()}
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left] << _SHIFT | vocab[right]] = rank << _SHIFT | vocab[left + right]
        self.added = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.strings = {
            n: bytes(values[c] for c in s) if all(c in values for c in s) else s.encode()
            for s, n in (vocab | self.added).items()
        }
        ordered = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece. Equal ranks merge from the left."""
        get, byte_ids = self.merges.get, self.byte_ids
        symbols = [byte_ids[b] for b in piece]
        n = len(symbols)
        if n == 1:
            return tuple(symbols)
        # Place n is an end on both sides: its symbol, like that of a place merged away, is in no pair.
        queue = [got << 32 | k for k, pair in enumerate(zip(symbols, symbols[1:]))
                 if (got := get(pair[0] << _SHIFT | pair[1])) is not None]
        heapify(queue)
        symbols.append(_GONE)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        before[0] = n
        while queue:
            entry = heappop(queue)
            k, got = entry & 0xFFFFFFFF, entry >> 32
            right = after[k]
            if get(symbols[k] << _SHIFT | symbols[right]) != got:
                continue  # one of the two symbols has changed since
            symbols[k] = one = got & 0xFFFFF
            symbols[right] = _GONE
            after[k] = beyond = after[right]
            before[beyond] = k
            new = get(one << _SHIFT | symbols[beyond])
            if new is not None:
                heappush(queue, new << 32 | k)
            ahead = before[k]
            new = get(symbols[ahead] << _SHIFT | one)
            if new is not None:
                heappush(queue, new << 32 | ahead)
        return tuple([s for s in symbols if s != _GONE])

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        known = self.known
        for part in self.special.split(text or "") if self.special else [text or ""]:
            if part in self.added:
                ids.append(self.added[part])
                continue
            for piece in self.pieces.findall(part):
                got = known.get(piece)
                if got is None:
                    got = self.older.get(piece) or self.merged(piece.encode("utf-8", "surrogatepass"))
                    if len(piece) <= 40:
                        if len(known) >= REMEMBERED:
                            self.older, self.known = known, {}
                            known = self.known
                        known[piece] = got
                ids.extend(got)
        return ids

    def decode(self, ids) -> str:
        """Bytes that are no UTF-8 become replacement characters. Unknown ids give nothing."""
        return b"".join([self.strings.get(n, b"") for n in ids]).decode("utf-8", "replace")


_loaded: dict[int, Bpe] = {}


def _tables(shared) -> Bpe:
    """One set of tables for all tasks of a worker."""
    key = hash(shared.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(shared.value)
    return _loaded[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(rows: DataFrame, spec: str, *, text: str = "text", decoded: str | None = None) -> DataFrame:
    """Replace column ``text`` by the array ``ids``; with ``decoded`` also add what the ids decode to.

    Null and empty texts give an empty array. Every row stays, repeated ones too, and so do other columns.
    """
    clash = [c for c in ("ids", decoded) if c and c in rows.columns and c != text]
    if clash:
        raise ValueError(f"columns {clash} exist already")
    kept = [f for f in rows.schema.fields if f.name != text]
    out = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    if decoded:
        out = out.add(T.StructField(decoded, T.StringType(), False))
    shared = rows.sparkSession.sparkContext.broadcast(spec)
    names = [f.name for f in kept]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        bpe, schema = _tables(shared), to_arrow_schema(out)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [bpe.encode(t) for t in column.slice(lo, 256).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter((n for one in ids for n in one), dtype=np.int32, count=int(ends[-1]))
                arrays = [part.column(part.schema.get_field_index(n)) for n in names]
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                if decoded:
                    arrays.append(pa.array([bpe.decode(one) for one in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return rows.mapInArrow(run, out)


def decode(rows: DataFrame, spec: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """Replace the array column ``ids`` by the text it stands for; a null array gives an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(spec)

    @F.pandas_udf("string")
    def told(column: pd.Series) -> pd.Series:
        bpe = _tables(shared)
        return column.map(lambda one: "" if one is None else bpe.decode(n for n in one if n is not None))

    return rows.withColumn(text, told(F.col(ids))).drop(ids)


def digests(rows: DataFrame, spec: str) -> DataFrame:
    """Encode, decode, and give for each document the token count and SHA-256 of ids and of decoded text.

    One row per row, also for repeated and missing ids. A null text counts as empty, which has no tokens. Columns beyond
    doc_id and text are not read.
    """
    both = encode(rows.select("doc_id", "text"), spec, decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
