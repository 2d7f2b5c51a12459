"""Language identification by nearest centroid.

A text is a TF-IDF vector of its hashed byte 3-grams, of length one.  Each language has several
centroids, found by clustering a bounded sample of its labelled texts by cosine.  A text takes the
language of the nearest one, and is rejected where even that is too far away.  Cosines grow with
length, so how far that is is measured in bands of length: on pieces of the language's own texts, on
pieces of other languages' texts as the classifier sees them without their language, and on noise.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 4096
CENTROIDS = 3
# Labelled texts that the classifier is fitted on, over all languages.
SAMPLE = 3000
# Lengths, as powers of 2 of the counted 3-grams, at which thresholds are measured; shorter texts tell too little.
BANDS = np.arange(4, 19)
# Own pieces below the first quantile may be rejected, foreign ones and noise above the second may be kept.
OWN, FOREIGN = 0.01, 0.98
# Pieces without which a language's band says nothing of its own.
ENOUGH = 30
# Languages up to which their shares are broadcast.
FEW = 10_000
# Texts that are turned into vectors at once.
LOT = 256
SEED = 9

_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(rb"[A-Za-z\x80-\xff]{2}")
_LEVEL = np.full(256, 32, np.uint8)
_LEVEL[128:] = np.arange(128, 256)
for _c in range(ord("a"), ord("z") + 1):
    _LEVEL[_c] = _LEVEL[_c - 32] = _c


def has_letter(text: str | None) -> bool:
    return bool(text and _LETTER.search(text))


def grams(text: str) -> np.ndarray:
    """How often each hashed 3-gram occurs: letters lower-cased, all else ASCII as blanks."""
    data = _LEVEL[np.frombuffer(f" {text} ".encode("utf-8", "replace"), np.uint8)].astype(np.uint32)
    code = data[:-2] | data[1:-1] << 8 | data[2:] << 16
    code = code[code != 0x202020]
    return np.bincount((code * np.uint32(2654435769)) >> np.uint32(20), minlength=DIMENSIONS)


def has_word(text: str) -> bool:
    """Two bytes of letters side by side; short texts without them are asked for as much as longer ones."""
    return bool(_WORD.search(text.encode("utf-8", "replace")))


@dataclass
class Model:
    """centroids: a row each, of length one; owner: whose they are; least: similarity each language asks for
    in each band of length."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    langs: list[str]
    least: np.ndarray

    def similarities(self, counts: np.ndarray) -> np.ndarray:
        """Of each row with each language."""
        near = weighted(counts, self.idf) @ self.centroids.T
        return np.maximum.reduceat(near, np.flatnonzero(np.diff(self.owner, prepend=-1)), axis=1).clip(0, 1)

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of each text's language, its similarity and whether that is too little."""
        counts = np.vstack([grams(t) for t in texts])
        near = self.similarities(counts)
        best = near.argmax(axis=1)
        near = near[np.arange(len(best)), best]
        length = np.log2(np.maximum(counts.sum(axis=1), 1))
        least = [np.interp(x, BANDS, self.least[k], left=0 if has_word(t) else None) for x, k, t in zip(length, best, texts, strict=True)]
        return best, near, near < least


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts).astype(np.float32) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def cluster(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means by cosine; each start is the vector farthest from those before it."""
    def unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-9)

    centroids = unit(vectors.mean(axis=0))[None]
    while len(centroids) < min(k, len(vectors)):
        centroids = np.vstack([centroids, vectors[(vectors @ centroids.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        mine = (vectors @ centroids.T).argmax(axis=1)
        centroids = np.vstack([unit(vectors[mine == i].mean(axis=0)) if (mine == i).any() else centroids[i]
                               for i in range(len(centroids))])
    return centroids


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def pieces(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """The number and the 3-grams of a piece of each band's length, as far as the text goes."""
    for i, band in enumerate(BANDS):
        size = 1 << int(band)
        if len(text) < size:
            return
        at = zlib.crc32(text.encode("utf-8", "replace")) % (len(text) - size + 1)
        piece = text[at:at + size]
        if has_letter(piece):
            yield i, grams(piece)


def noise() -> list[np.ndarray]:
    """For each band, 3-grams of random base64, letters, and words of random letters."""
    draw, found = np.random.default_rng(SEED), []
    base = string.ascii_letters + string.digits + "+/"
    for band in BANDS:
        kinds = [np.frombuffer(k.encode(), np.uint8) for k in (base, string.ascii_letters, string.ascii_lowercase + " " * 5)]
        found.append(np.vstack([grams(draw.choice(k, 1 << int(band)).tobytes().decode())
                                for k in kinds for _ in range(20 if band < 14 else 3)]))
    return found


def thresholds(model: Model, bands: np.ndarray, true: np.ndarray, own: np.ndarray, near: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Language by band.  A row for each piece: band, language, similarity to it, and which other language
    is nearest (-1: there is none) and how near.

    What foreign pieces and noise hardly reach is asked for, but no more than nearly all own pieces
    reach, and nothing where those are no nearer than ordinary noise.
    """
    least = np.zeros((len(model.langs), len(BANDS)))
    for i, counts in enumerate(noise()):
        middle, high = np.quantile(model.similarities(counts).max(axis=1), [0.5, FOREIGN])
        here = bands == i
        for k in range(len(model.langs)):
            mine, strange = own[here & (true == k)], other[here & (near == k)]
            if len(mine) < ENOUGH:
                mine = own[here]
            if len(strange) < ENOUGH:
                strange = other[here & (near >= 0)]
            if len(mine) < ENOUGH:
                # Longer than what was learned from: as the band before, and no noise.
                least[k, i] = max(least[k, i - 1], high) if i else 0
                continue
            low = np.quantile(mine, OWN)
            # One language alone has no foreign texts to go by: half way from noise to its own.
            top = max(high, np.quantile(strange, FOREIGN)) if len(strange) else (high + max(low, high)) / 2
            least[k, i] = min(low, top) if low > middle else 0
    return least


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learns from a hashed sample of the labelled rows that are not held out, the same share of
    the bound for each language; `sample` rows are expected at most.  They are read twice, for the
    centroids and for the thresholds."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    per = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    langs = per.count()
    share = per.select("lang", (F.lit(sample / max(langs, 1)) / F.col("rows")).alias("share"))
    if langs <= FEW:
        share = F.broadcast(share)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "text"), 11) / F.lit(float(1 << 53))
    chosen = labelled.select("lang", "text", draw.alias("draw")).join(share, "lang").filter("draw < share")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [(lang, grams(text)) for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    if has_letter(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in both], pa.string()),
                 pa.array([np.minimum(x[1], 65535).astype(np.uint16).tobytes() for x in both], pa.binary())],
                ["lang", "grams"])

    rows = sorted((r[0], bytes(r[1])) for r in chosen.select("lang", "text").mapInArrow(
        count, "lang string, grams binary").collect())
    if not rows:
        return Model(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), [],
                     np.zeros((0, len(BANDS))))
    counts = np.vstack([np.frombuffer(r[1], np.uint16) for r in rows])
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    vectors, names = weighted(counts, idf), np.array([r[0] for r in rows], object)
    found, owner, langs_ = [], [], sorted(set(names))
    for i, lang in enumerate(langs_):
        own = vectors[names == lang]
        found.append(cluster(own, centroids))
        owner += [i] * len(found[-1])
    model = Model(idf, np.vstack(found).astype(np.float32), np.array(owner), langs_, np.zeros((len(langs_), len(BANDS))))
    number = {lang: i for i, lang in enumerate(langs_)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k = number.get(lang)
                cut = list(pieces(text)) if k is not None else []
                if not cut:
                    continue
                near = model.similarities(np.vstack([c for _, c in cut]))
                own = near[:, k].copy()
                near[:, k] = -1
                best = near.argmax(axis=1) if len(langs_) > 1 else np.full(len(near), -1)
                out += zip([i for i, _ in cut], [k] * len(cut), own.tolist(), best.tolist(), near.max(axis=1).tolist(), strict=True)
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64()), strict=True)],
                ["band", "lang", "own", "near", "other"])

    measured = np.array([tuple(r) for r in chosen.select("lang", "text").mapInArrow(
        measure, "band int, lang int, own double, near int, other double").collect()]).reshape(-1, 5).T
    model.least = thresholds(model, measured[0].astype(int), measured[1].astype(int), measured[2], measured[3].astype(int), measured[4])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: a row for every row of `docs`.

    Reads text alone (doc_id only says what is held out).  Null texts and texts without a letter
    are `und`, score 0, rejected; so is everything when nothing was learned.  Else lang_pred is the
    nearest language and score its cosine, and `rejected` says that it is too far from it for a text of
    this length.  Ties go
    to the language first in order.  Whole texts are read; repeated rows repeat.
    """
    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, LOT):
                lot = batch.slice(at, LOT)
                texts = lot.column(2).to_pylist()
                lang, score, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
                some = [i for i, t in enumerate(texts) if model.langs and has_letter(t)]
                if some:
                    for i, k, near, far in zip(some, *model.predict([texts[i] for i in some]), strict=True):
                        lang[i], score[i], rejected[i] = model.langs[k], float(near), bool(far)
                yield pa.RecordBatch.from_arrays(
                    [lot.column(0), lot.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(
        judge, schema)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns, whose language is not rejected."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, LOT):
                lot = batch.slice(start, LOT)
                texts = lot.column(at).to_pylist()
                mask = [False] * len(texts)
                some = [i for i, t in enumerate(texts) if model.langs and has_letter(t)]
                if some:
                    for i, _, _, far in zip(some, *model.predict([texts[i] for i in some]), strict=True):
                        mask[i] = not far
                yield lot.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
