"""A factorisation machine for text quality: hashed words, structure statistics and metadata, interacting in pairs.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pair sum is half of the squared sum of
v_i x_i less the sum of squares, so a document costs its number of features times the rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import Words, in_chunks, rolled, text_bytes

BITS = 15  # buckets of hashed words: 2 ** BITS
RANK = 8
BINS = 10
#: Bound of the labelled rows that a model is fitted on.
SAMPLE_ROWS = 6000
_SEEN = 34  # bins of the length that the table states

_CLASSES = np.zeros((6, 256), dtype=np.uint8)
_CLASSES[0, 65:91] = 1  # upper case
_CLASSES[1, 48:58] = 1  # digits
_CLASSES[2, [ord(c) for c in "#$%&*|<>{}[]\\^~=+_@/"]] = 1  # symbols
_CLASSES[3, [ord(c) for c in ".,;:!?"]] = 1  # stops
_CLASSES[4, 10] = 1  # line ends
_CLASSES[5, 128:] = 1  # beyond ASCII
STATS = 6 + 6
FEATURES = (1 << BITS) + STATS * BINS + _SEEN


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers and word buckets, each pair once and sorted, and the statistics of each text."""
    words, n = Words(texts), len(texts)
    hashes, of = words.hashes(fold=True), words.text_of()
    keys, times = np.unique(of << BITS | (hashes >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    rows, buckets = keys >> BITS, keys & ((1 << BITS) - 1)
    distinct, most = np.bincount(rows, minlength=n), np.zeros(n)
    np.maximum.at(most, rows, times)
    pairs = rolled(hashes, 2)
    inside = of[1:] == of[:-1]
    met = np.unique(of[1:][inside] << 40 | (pairs[inside] >> np.uint64(24)).astype(np.int64))
    pair_kinds = np.bincount(met >> 40, minlength=n)
    sizes = np.diff(words.text_starts)
    count = np.maximum(words.counts, 1)
    stats = [np.add.reduceat(c[words.raw], words.text_starts[:-1], dtype=np.int64) / sizes for c in _CLASSES]
    stats += [np.log1p(words.counts), sizes / count, distinct / count, most / count,
              pair_kinds / np.maximum(words.counts - 1, 1), np.log1p(sizes)]
    return rows, buckets, np.stack(stats, axis=1)


def length_bin(n_chars) -> np.ndarray:
    """Bin of the length that the table states; a missing or negative one has the last bin."""
    known = pd.to_numeric(pd.Series(n_chars), errors="coerce").to_numpy(dtype=np.float64, na_value=np.nan)
    usable = np.isfinite(known) & (known >= 0)
    return np.where(usable, np.minimum(np.log2(np.where(usable, known, 0) + 1), _SEEN - 2).astype(np.int64), _SEEN - 1)


@dataclass
class Machine:
    """A fitted model; its size is fixed by BITS and RANK."""
    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def features(self, rows, buckets, stats, seen) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row starts, feature numbers and values: unit length for the words, one half for each other feature."""
        n = len(stats)
        bins = np.stack([np.searchsorted(e, s, side="right") for e, s in zip(self.edges, stats.T)], axis=1)
        fixed = np.concatenate([(1 << BITS) + np.arange(STATS) * BINS + bins,
                                (1 << BITS) + STATS * BINS + seen[:, None]], axis=1)
        per = np.bincount(rows, minlength=n)
        size = per + STATS + 1
        starts = np.concatenate(([0], np.cumsum(size)))
        index = np.empty(starts[-1], dtype=np.int64)
        value = np.empty(starts[-1], dtype=np.float64)
        at = starts[:-1, None] + np.arange(STATS + 1)
        index[at], value[at] = fixed, 0.5
        place = starts[:-1][rows] + STATS + 1 + np.arange(len(rows)) - np.concatenate(([0], np.cumsum(per)))[rows]
        index[place], value[place] = buckets, per[rows] ** -0.5
        return starts[:-1], index, value

    def margins(self, starts, index, value) -> tuple[np.ndarray, np.ndarray]:
        """Margin of each row, and the sum of its scaled factors."""
        scaled = self.factors[index] * value[:, None]
        total = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(np.square(scaled).sum(axis=1), starts)
        linear = np.add.reduceat(self.weights[index] * value, starts)
        return self.bias + linear + 0.5 * (np.square(total).sum(axis=1) - squares), total

    def scores(self, texts: list[bytes], n_chars) -> np.ndarray:
        rows, buckets, stats = describe(texts)
        margin, _ = self.margins(*self.features(rows, buckets, stats, length_bin(n_chars)))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(texts: list[tuple], labels: np.ndarray, *, epochs: int = 8, steps: int = 400, batch: int = 64,
        rate: float = 0.1, seed: int = 1) -> Machine:
    """Fit by AdaGrad on (buckets, stats, n_chars) of labelled texts: ``epochs`` passes, more to come to ``steps`` steps.

    Without rows every score is one half.
    """
    rng = np.random.default_rng(seed)
    stats = np.array([t[1] for t in texts], dtype=np.float64).reshape(-1, STATS)
    edges = (np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T if len(texts)
             else np.zeros((STATS, BINS - 1)))
    model = Machine(edges, 0.0, np.zeros(FEATURES), rng.normal(0, 0.02, (FEATURES, RANK)))
    if not len(texts):
        model.factors[:] = 0
        return model
    seen = length_bin([t[2] for t in texts])
    labels = np.asarray(labels, dtype=np.float64)
    share = np.clip(labels.mean(), 0.01, 0.99)
    model.bias = float(np.log(share / (1 - share)))
    past_w, past_v, past_b = np.full(FEATURES, 1e-3), np.full((FEATURES, RANK), 1e-3), 1e-3
    for _ in range(max(epochs, -(-steps * batch // len(texts)))):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            part = order[lo:lo + batch]
            buckets = [np.asarray(texts[k][0], dtype=np.int64) for k in part]
            rows = np.repeat(np.arange(len(part)), [len(b) for b in buckets])
            starts, index, value = model.features(rows, np.concatenate(buckets), stats[part], seen[part])
            margin, total = model.margins(starts, index, value)
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]
            row = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(index))))
            used, back = np.unique(index, return_inverse=True)
            pull = error[row] * value
            grad_w = np.bincount(back, pull) / len(part) + 1e-6 * model.weights[used]
            each = pull[:, None] * (total[row] - model.factors[index] * value[:, None])
            grad_v = np.stack([np.bincount(back, c) for c in each.T], axis=1) / len(part) + 1e-6 * model.factors[used]
            past_w[used] += grad_w ** 2
            past_v[used] += grad_v ** 2
            past_b += error.mean() ** 2
            model.weights[used] -= rate * grad_w / np.sqrt(past_w[used])
            model.factors[used] -= rate * grad_v / np.sqrt(past_v[used])
            model.bias -= rate * error.mean() / np.sqrt(past_b)
    return model


def fold(doc_id="doc_id"):
    """crc32 of the decimal doc_id modulo 3; rows of remainder 1 are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``sample_rows`` labelled rows, those of the smallest hash of doc_id; fold 1 is left out.

    Null and empty texts are learnt from like any other; a label given twice counts as its largest. Rows that share a
    labelled doc_id all have its label and count one by one, also against the bound. Without rows every score is one half.
    """
    chosen = (labels.where(F.col(label).isNotNull() & (fold() != 1)).groupBy("doc_id")
              .agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    picked = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, texts in in_chunks(map(text_bytes, batch["text"])):
                rows, buckets, stats = describe(texts)
                cut = np.searchsorted(rows, np.arange(1, len(texts)))
                part = batch.iloc[lo:lo + len(texts)]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "label": part["label"].to_numpy(),
                    "seen": pd.to_numeric(part["n_chars"]).astype("float64").to_numpy(),
                    "buckets": np.split(buckets.astype(np.int32), cut) if len(texts) > 1 else [buckets.astype(np.int32)],
                    "stats": list(stats)})

    found = picked.mapInPandas(run, "doc_id long, label int, seen double, buckets array<int>, stats array<double>")
    # A doc_id that many rows share has as many texts, so the bound holds for what is learnt from, too.
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("buckets", "stats"), "seen").limit(sample_rows)
    told = sorted(found.collect(), key=lambda r: (r["doc_id"], r["buckets"]))
    return fit([(r["buckets"], r["stats"], r["seen"]) for r in told], np.array([r["label"] for r in told]))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id, score and predicted for each row. Null and empty texts, and a missing n_chars, are scored like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, texts in in_chunks(map(text_bytes, batch["text"])):
                part = batch.iloc[lo:lo + len(texts)]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"),
                                    "score": shared.value.scores(texts, part["n_chars"])})

    found = docs.select("doc_id", "text", "n_chars").mapInPandas(run, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``, learnt from ``labels`` outside fold 1.

    Rows without doc_id count as not held out. A label given twice counts as its largest. Columns beyond doc_id, text
    and n_chars are not read.
    """
    return score(docs, train(docs, labels)).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, *, learn_from: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that the model predicts as good, with the columns they had.

    The model learns from the labelled rows of ``learn_from``, by default of ``docs``. Rows without doc_id, null and empty
    texts and repeated rows are judged by their score like any other; rows with the same text and n_chars stay or go
    together. Columns of any name are kept.
    """
    model = train(docs if learn_from is None else learn_from, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def told(text: pd.Series, n_chars: pd.Series) -> pd.Series:
        parts = [shared.value.scores(texts, n_chars.iloc[lo:lo + len(texts)])
                 for lo, texts in in_chunks(map(text_bytes, text))]
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.where(told("text", "n_chars") >= 0.5)
