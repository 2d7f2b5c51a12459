"""Document quality by a factorisation machine.

A document is a sparse vector: hashed words (logarithms of their counts, of length one together),
structure statistics and metadata, both cut into bins.  The machine adds a weight per feature and,
for each pair of features, the product of their values times the inner product of their low-rank
factors.  Over all pairs that is half of (square of the sum - sum of the squares), factor by factor,
so a score takes time linear in the features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.bytewords import Hasher, Lot, byte_set, lots, words_of
from tidemart.llm.common import text_or_empty

# Hashed words, and the factors of a feature.
WORDS = 1 << 16
RANK = 8
# Labelled rows that the machine is fitted on, at most.
SAMPLE = 6000
EPOCHS, BATCH = 6, 64
RATE, DECAY, SPREAD = 0.1, 1e-4, 0.05
SEED = 11
BINS = 16
METADATA = ("n_chars",)

_BLANK = byte_set((9, 13), (32, 32))
_LETTER = byte_set((65, 90), (97, 122), (128, 255))
_DIGIT = byte_set((48, 57))
_STOP = byte_set((33, 33), (46, 46), (63, 63))
_COMMA = byte_set((44, 44), (58, 59))
_LINE = byte_set((10, 10))
STATISTICS = ("bytes", "words", "word length", "letters", "digits", "stops", "commas", "symbols", "lines",
              "words a line", "distinct words", "repeated at once", "most frequent word", "upper case")


def of_share(x: np.ndarray) -> np.ndarray:
    """The bin of a share from 0 to 1; small ones are told apart better."""
    return np.minimum(np.sqrt(np.clip(x, 0, 1)) * BINS, BINS - 1).astype(np.int64)


def of_size(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(x, 0) + 1.0), BINS - 1).astype(np.int64)


@dataclass
class Rows:
    """Sparse rows one after the other: where each begins, features and values."""

    begin: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def taken(self, rows: np.ndarray) -> Rows:
        size = np.diff(np.append(self.begin, len(self.feature)))[rows]
        begin = np.cumsum(size) - size
        at = np.repeat(self.begin[rows] - begin, size) + np.arange(size.sum())
        return Rows(begin, self.feature[at], self.value[at])


class Features:
    """Turns texts and bins of metadata into rows; every row has its structure's features at least."""

    def __init__(self, metadata: int):
        self.metadata, self.hasher = metadata, Hasher()
        self.blocks = len(STATISTICS) + metadata
        self.size = WORDS + self.blocks * (BINS + 1)

    def __call__(self, lot: Lot, raw: np.ndarray, meta: list[np.ndarray]) -> Rows:
        docs = len(lot.sizes)
        begin = lot.ends - lot.sizes - 1
        words = words_of(lot, _BLANK)
        h = self.hasher(lot.data, words.start, words.end)

        def per_text(hit: np.ndarray) -> np.ndarray:
            return np.add.reduceat(hit, begin, dtype=np.int64) if docs else np.zeros(0, np.int64)

        n = np.bincount(words.text, minlength=docs)
        some, byte = np.maximum(n, 1), np.maximum(lot.sizes, 1)
        letters, digits = per_text(_LETTER[lot.data]), per_text(_DIGIT[lot.data])
        stops, commas, blanks = per_text(_STOP[lot.data]), per_text(_COMMA[lot.data]), per_text(_BLANK[lot.data]) - 1
        lines = per_text(_LINE[lot.data])
        upper = per_text(raw != lot.data)
        length = np.bincount(words.text, words.end - words.start, minlength=docs)
        bucket = (h >> np.uint64(48)).astype(np.int64) % WORDS
        key, times = np.unique(words.text * WORDS + bucket, return_counts=True)
        owner = key // WORDS
        distinct = np.bincount(owner, minlength=docs)
        most = np.zeros(docs, np.int64)
        np.maximum.at(most, owner, times)
        again = np.zeros(docs, np.int64)
        same = (h[1:] == h[:-1]) & (words.text[1:] == words.text[:-1])
        again += np.bincount(words.text[1:][same], minlength=docs)
        bins = [of_size(lot.sizes), of_size(n), of_size(4 * length / some), of_share(letters / byte), of_share(digits / byte),
                of_share(stops / some), of_share(commas / some),
                of_share((lot.sizes - letters - digits - stops - commas - blanks) / byte), of_size(lines),
                of_size(n / lines), of_share(distinct / some), of_share(again / some), of_share(most / some),
                of_share(upper / byte), *meta]
        weight = np.log1p(times).astype(np.float32)
        norm = np.sqrt(np.bincount(owner, weight.astype(np.float64) ** 2, minlength=docs))
        weight = (weight / norm[owner]).astype(np.float32) if len(owner) else weight
        own = np.concatenate([np.arange(docs)] * self.blocks)
        feature = np.concatenate([b + WORDS + i * (BINS + 1) for i, b in enumerate(bins)])
        owners = np.concatenate([owner, own])
        order = np.argsort(owners, kind="stable")
        size = np.bincount(owners, minlength=docs)
        return Rows(np.cumsum(size) - size, np.concatenate([key % WORDS, feature])[order],
                    np.concatenate([weight, np.full(len(own), 1 / np.sqrt(self.blocks), np.float32)])[order])


@dataclass
class Machine:
    """bias; weight and factors of each feature."""

    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def margins(self, rows: Rows) -> np.ndarray:
        """The log odds of label 1; pairs by the sum-of-squares identity."""
        return self.parts(rows)[0]

    def parts(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        x = rows.value.astype(np.float64)
        v = self.factors[rows.feature] * x[:, None]
        sums = np.add.reduceat(v, rows.begin, axis=0)
        squares = np.add.reduceat((v * v).sum(axis=1), rows.begin)
        linear = np.add.reduceat(self.weight[rows.feature] * x, rows.begin)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fitted(rows: Rows, labels: np.ndarray, size: int, rank: int = RANK, epochs: int = EPOCHS) -> Machine:
    """By gradient descent on the logistic loss, steps scaled by each weight's own past gradients."""
    ones = int(labels.sum())
    draw = np.random.default_rng(SEED)
    machine = Machine(float(np.log((ones + 1) / (len(labels) - ones + 1))), np.zeros(size), draw.normal(0, SPREAD, (size, rank)))
    if not 0 < ones < len(labels):
        return Machine(machine.bias, machine.weight, np.zeros((size, rank)))
    past_w, past_v = np.full(size, 1e-2), np.full((size, rank), 1e-2)
    for _ in range(epochs):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            lot = order[at:at + BATCH]
            part = rows.taken(lot)
            margin, sums = machine.parts(part)
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[lot]
            owner = np.repeat(np.arange(len(lot)), np.diff(np.append(part.begin, len(part.feature))))
            x = part.value.astype(np.float64)
            known, back = np.unique(part.feature, return_inverse=True)
            slope = error[owner] * x
            w = np.bincount(back, slope) / len(lot) + DECAY * machine.weight[known]
            own = machine.factors[part.feature]
            each = slope[:, None] * (sums[owner] - own * x[:, None])
            v = np.stack([np.bincount(back, each[:, f]) for f in range(rank)], axis=1) / len(lot) + DECAY * machine.factors[known]
            past_w[known] += w * w
            past_v[known] += v * v
            machine.weight[known] -= RATE * w / np.sqrt(past_w[known])
            machine.factors[known] -= RATE * v / np.sqrt(past_v[known])
            machine.bias -= RATE * float(error.mean()) * 0.1
    return machine


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _source(docs: DataFrame, metadata: Sequence[str], *more: Column) -> DataFrame:
    return docs.select(text_or_empty().alias("text"),
                       F.array(*[F.col(f"`{c}`").try_cast("double") for c in metadata]).cast("array<double>").alias("meta"), *more)


def _lots(batch: pa.RecordBatch, features: Features) -> Iterator[tuple[Lot, Rows]]:
    flat = batch.column(1).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, features.metadata)
    for lot in lots(batch.column(0)):
        raw = np.frombuffer(b"\n".join([*[v.as_buffer() for v in batch.column(0)[lot.first:lot.last]], b""]), np.uint8)
        part = values[lot.first:lot.last]
        yield lot, features(lot, raw, [np.where(np.isfinite(x), of_size(np.nan_to_num(x, posinf=0, neginf=0)), BINS) for x in part.T])


def _rows(metadata: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(metadata)
        for batch in batches:
            for lot, found in _lots(batch, features):
                offsets = pa.array(np.append(found.begin, len(found.feature)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2)[lot.first:lot.last], batch.column(3)[lot.first:lot.last],
                     pa.ListArray.from_arrays(offsets, pa.array(found.feature.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(found.value, pa.float32()))],
                    ["place", "good", "feature", "value"])

    return rows


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, metadata: Sequence[str] = METADATA) -> Machine:
    """The machine for `docs`, from labels (doc_id, quality) of rows that are not held out.

    At most `sample` labels are used, those first by a seeded hash; a document labelled twice counts
    each label, null labels and labels without a document don't count, and 1 is the good one.
    Without both kinds of labels the score is the smoothed share of good ones for every text.
    """
    place = F.xxhash64(F.lit(SEED), "doc_id", "good")
    chosen = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).cast("int").alias("good"))
              .orderBy(place, "doc_id", "good").limit(sample))
    # At most `sample` rows, so the broadcast is bounded; so is what comes back, ids repeated or not.
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys(("text", *metadata))]).alias("_doc"))
    both = known.join(F.broadcast(chosen), "doc_id").select("_doc.*", F.xxhash64(F.lit(SEED), "doc_id", "good", "_doc.text").alias("place"), "good")
    rows = (_source(both, metadata, F.col("place"), F.col("good"))
            .mapInArrow(_rows(len(metadata)), "place long, good int, feature array<int>, value array<float>")
            .orderBy("place", "good").limit(sample).toArrow())
    size = Features(len(metadata)).size
    if not rows.num_rows:
        return fitted(Rows(*[np.zeros(0, np.int64)] * 2, np.zeros(0, np.float32)), np.zeros(0), size)
    feature, value = rows.column("feature").combine_chunks(), rows.column("value").combine_chunks()
    begin = np.cumsum(lengths := feature.value_lengths().to_numpy()) - lengths
    return fitted(Rows(begin, feature.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy()),
                  rows.column("good").to_numpy().astype(np.float64), size)


def _scores(machine: Machine, metadata: int):
    slim = Machine(machine.bias, machine.weight.astype(np.float32), machine.factors.astype(np.float32))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(metadata)
        for batch in batches:
            for lot, rows in _lots(batch, features):
                score = 1 / (1 + np.exp(-np.clip(slim.margins(rows), -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2)[lot.first:lot.last], batch.column(3)[lot.first:lot.last], pa.array(np.round(score, 6))],
                    ["doc_id", "held_out", "score"])

    return scores


def score(docs: DataFrame, machine: Machine, metadata: Sequence[str] = METADATA) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted: a row for every row of `docs`.

    Only the text and the columns of `metadata` (numbers; null is a value of its own) are inputs of
    the score.  Null text counts as empty; empty texts are scored by structure and metadata.  Rows
    without doc_id are not held out; repeated rows get equal scores.
    """
    source = _source(docs, metadata, F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"))
    return (source.mapInArrow(_scores(machine, len(metadata)), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
