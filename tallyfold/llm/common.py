"""Scratch tables in the shared folder, and word arithmetic on whole batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tallyfold.sources.store import shared_folder

#: Spark frees the shuffle files of a query when it ends, so that a sequence of stored steps needs the disk of one step.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Stored intermediate tables of one operator call, below the folder that all executors share."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, rows: DataFrame, name: str, *, conf: dict[str, str] | None = None) -> DataFrame:
        """Write ``rows`` once and return the stored table. Lineage ends here. ``conf`` holds for the write only."""
        conf = {CLEANUP: "true", **(conf or {})}
        before = {key: self.spark.conf.get(key, None) for key in conf}
        for key, value in conf.items():
            self.spark.conf.set(key, value)
        try:
            rows.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Remove stored tables that no later step reads."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            target = path(f"{self.folder}/{name}")
            target.getFileSystem(conf).delete(target, True)


#: The white space that ends a word, as bytes.
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_LONG = 512  # bytes of a word beyond which it is hashed by itself
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def free(name: str, rows: DataFrame) -> str:
    """A column name that ``rows`` does not have."""
    while name.lower() in map(str.lower, rows.columns):
        name = f"_{name}"
    return name


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def in_chunks(texts: Iterable[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of together about ``limit`` bytes, with the number of the first; one long text stands alone."""
    first, held, size = 0, [], 0
    for number, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = number, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


class Words:
    """The words of several texts: places in one buffer, counts per text, 64-bit hashes."""

    def __init__(self, texts: Sequence[bytes]):
        self.raw = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        gap = np.ones(len(self.raw) + 2, dtype=np.int8)
        gap[1:-1] = BLANK[self.raw]
        edges = np.flatnonzero(np.diff(gap))
        self.starts, self.ends = edges[0::2], edges[1::2]
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate(([0], np.cumsum(lengths)))
        self.first = np.searchsorted(self.starts, self.text_starts)  # first word of each text, and the end
        self.counts = np.diff(self.first)

    def hashes(self, *, fold: bool = False) -> np.ndarray:
        """A hash of the bytes of each word, from prefix sums of a polynomial; ``fold`` takes A-Z as a-z."""
        raw = LOWER[self.raw] if fold else self.raw
        up, down = _power_tables(len(self.raw) + 1)
        sums = np.zeros(len(self.raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def keys(self, seed: int) -> np.ndarray:
        """A hash of the bytes of each word, eight bytes at a time; other seeds give other hashes of all words."""
        size = self.ends - self.starts
        held = np.concatenate([self.raw, np.zeros(8, dtype=np.uint8)])
        # Eight bytes from every place of the buffer, without a copy.
        lanes = np.ndarray(len(self.raw) + 1, dtype="<u8", buffer=held, strides=(1,))
        out = mixed(np.uint64(seed) + size.astype(np.uint64) * _BASE)
        many = size > _LONG
        at = np.flatnonzero(~many)
        done = 0
        while len(at):
            left = size[at] - done
            lane = lanes[self.starts[at] + done]
            short = left < 8
            lane[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
            out[at] = mixed((out[at] ^ lane) * _BASE + np.uint64(seed))
            at, done = at[left > 8], done + 8
        for word in np.flatnonzero(many).tolist():
            out[word] = xxhash.xxh3_64_intdigest(held[self.starts[word]:self.ends[word]].tobytes(), seed)
        return out

    def text_of(self) -> np.ndarray:
        """Number of the text that holds each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive hashes; empty if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = _power_tables(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * down[:n])
