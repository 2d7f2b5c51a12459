"""Language-model scores by subword lattice likelihood.

The vocabulary of an existing tokenizer gives the pieces; the tokenizer's own segmentation of the
training words, counted over the whole corpus, gives each piece its weight.  The probability of a
word is the sum over all its segmentations, from a forward recursion in log space; a text's is the
product over its words and one end.  Beside it stands a plain word model with add-one counts.

Counts of words may not be broadcast: they grow with the corpus.  Documents are hashed into chunks
of bounded size, each chunk asks for its distinct words once, and the answers come back by chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.bytewords import byte_set, lots, ranges, words_of
from tidemart.llm.common import text_or_empty, written

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
# Text of a chunk, on average; a single longer document is a chunk's own.
CHUNK_BYTES = 12_000_000
# Words that a task looks at together.
_FLUSH = 1_000_000
_LOT = 50_000
_BLANK = byte_set((9, 13), (32, 32))

_BASE = np.uint64(0x9E3779B97F4A7C15)


def token_arrays(texts: Iterable[pa.Array], most: int = _FLUSH) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The tokens of the texts as one array, and how many each text has; some `most` tokens at a time.

    Tokens are runs of all but ASCII white space, ASCII letters lower-cased.  They stay ranges of bytes:
    as objects of Python they would take ten times the text.
    """
    parts, sizes, held = [], [], 0
    for column in texts:
        for lot in lots(column.cast(pa.binary())):
            words = words_of(lot, _BLANK)
            parts.append(ranges(lot.data, words.start, words.end))
            sizes.append(np.bincount(words.text, minlength=lot.last - lot.first))
            held += len(words.start)
            if held >= most:
                yield pa.concat_arrays(parts), np.concatenate(sizes)
                parts, sizes, held = [], [], 0
    if parts:
        yield pa.concat_arrays(parts), np.concatenate(sizes)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def vocabulary(path: str) -> list[bytes]:
    """The tokenizer's pieces as bytes, by id; a leading blank marks a word's start, b"" is no piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            found.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or "▁" in piece[1:]:
            found.append(b"")
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


@dataclass
class Lattice:
    """Weights of pieces: for each length, sorted hashes and the pieces' natural log probability."""

    by_length: dict[int, tuple[np.ndarray, np.ndarray]]
    powers: np.ndarray
    end: float

    @classmethod
    def build(cls, pieces: list[bytes], counts: dict[int, int], ends: int) -> Lattice:
        """Add-one weights; byte pieces and others of the same bytes add up.  Id -1 is the end."""
        known = [i for i, p in enumerate(pieces) if p]
        total = sum(counts.get(i, 0) + 1 for i in known) + ends + 1
        weight: dict[bytes, float] = {}
        for i in known:
            weight[pieces[i]] = weight.get(pieces[i], 0.0) + (counts.get(i, 0) + 1) / total
        by_length = {}
        for size in sorted({len(p) for p in weight}):
            own = [p for p in weight if len(p) == size]
            h = prefix_hashes(np.frombuffer(b"".join(own), np.uint8).reshape(-1, size))[:, -1]
            order = np.argsort(h)
            by_length[size] = h[order], np.log(np.array([weight[p] for p in own]))[order]
        powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(max(by_length) + 1)], np.uint64)
        return cls(by_length, powers, math.log((ends + 1) / total))

    def log10(self, words: list[bytes]) -> np.ndarray:
        """Marginal log10 probability of each word, a blank before it, over all segmentations."""
        result = np.zeros(len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(lengths):
            where = np.flatnonzero(lengths == size)
            step = max(1, 1_000_000 // int(size + 1))
            for at in range(0, len(where), step):
                part = where[at:at + step]
                result[part] = self._forward(b"".join(b" " + words[i] for i in part), len(part), int(size) + 1)
        return result / math.log(10)

    def _forward(self, data: bytes, n: int, size: int) -> np.ndarray:
        h = prefix_hashes(np.frombuffer(data, np.uint8).reshape(n, size))
        h = np.concatenate([np.zeros((n, 1), np.uint64), h], axis=1)
        reach = np.full((n, size + 1), -np.inf)
        reach[:, 0] = 0
        for end in range(1, size + 1):
            terms = []
            for length, (known, weight) in self.by_length.items():
                if length > end:
                    break
                x = h[:, end] - h[:, end - length] * self.powers[length]
                at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                terms.append(np.where(known[at] == x, weight[at] + reach[:, end - length], -np.inf))
            most = np.max(terms, axis=0)
            safe = np.where(np.isfinite(most), most, 0)
            with np.errstate(divide="ignore"):
                reach[:, end] = safe + np.log(np.sum(np.exp(np.array(terms) - safe), axis=0))
        return reach[:, size]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of every prefix of each row."""
    h = np.zeros(data.shape, np.uint64)
    last = np.zeros(len(data), np.uint64)
    for j in range(data.shape[1]):
        last = last * _BASE + data[:, j] + np.uint64(1)
        h[:, j] = last
    return h


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found, _ in token_arrays(batch.column(0) for batch in batches):
        seen = found.value_counts()
        yield pa.RecordBatch.from_arrays([seen.field("values"), seen.field("counts")], ["word", "c"])


def _count_pieces(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        total = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            ids = model.encode([w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()], num_threads=1)
            times = np.repeat(batch.column(1).to_numpy(), [len(x) for x in ids])
            np.add.at(total, np.fromiter((i for x in ids for i in x), np.int64, len(times)), times)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["piece", "c"])

    return count


def _weigh(lattice: Lattice):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _LOT):
                lot = batch.slice(at, _LOT)
                yield pa.RecordBatch.from_arrays(
                    [lot.column(0), lot.column(1), pa.array(lattice.log10(lot.column(0).to_pylist()))],
                    ["word", "c", "lp"])

    return weigh


def _asked(docs: pa.Table) -> pa.Table:
    """The distinct words of a chunk."""
    words = pa.chunked_array([found.unique() for found, _ in token_arrays(docs.column("text").chunks)], pa.binary()).unique()
    return pa.table({"chunk": pa.repeat(docs.column("chunk")[0], len(words)), "word": words})


def _score(lattice: Lattice, n: int, v: int, ends: int):
    below = math.log10(n + v + 1)

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        words = answers.column("word").combine_chunks()
        c = answers.column("c").fill_null(0).to_numpy()
        lp = answers.column("lp").to_numpy(zero_copy_only=False).copy()
        new = np.flatnonzero(np.isnan(lp))
        for at in range(0, len(new), _LOT):
            lot = new[at:at + _LOT]
            lp[lot] = lattice.log10(words.take(pa.array(lot)).to_pylist())
        base = np.log10(c + 1.0) - below
        found = []
        for own, sizes in token_arrays(docs.column("text").chunks):
            places = pc.index_in(own, value_set=words).to_numpy()
            for at in np.split(places, np.cumsum(sizes)[:-1]):
                found.append((len(at) + 1, int((c[at] > 0).sum()) + (ends > 0),
                              float(base[at].sum()) + math.log10(ends + 1) - below,
                              float(lp[at].sum()) + lattice.end / math.log(10)))
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
            "n_tokens": pa.array(columns[0], pa.int64()), "n_known": pa.array(columns[1], pa.int64()),
            "train_tokens": pa.repeat(pa.scalar(n, pa.int64()), len(found)),
            "base_score": pa.array(columns[2], pa.float64()), "score": pa.array(columns[3], pa.float64())})

    return score


def likelihoods(docs: DataFrame, tokenizer: str = TOKENIZER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for every row of `docs`.

    Scores are log10 probabilities of whole texts.  Null text counts as empty: it has one token, the
    end.  Rows without doc_id are training rows; repeated rows count as often as they stand there.
    Every byte is a piece, so every word has a score.  Only doc_id and text are read.  No training
    rows: all words are unknown and pieces weigh the same.
    """
    source = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text_or_empty().alias("text"))
    rows, size = source.agg(F.count_if(~F.col("held_out")), F.sum(F.octet_length("text").cast("long"))).first()
    words = written(
        source.filter(~F.col("held_out")).select("text").mapInArrow(_count_words, "word binary, c long")
        .groupBy("word").agg(F.sum("c").alias("c")), "words")
    n, v = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = (n or 0) + rows, v + (rows > 0)
    # At most one row per piece of the vocabulary.
    pieces = dict(words.mapInArrow(_count_pieces(tokenizer), "piece long, c long")
                  .groupBy("piece").agg(F.sum("c")).collect())
    lattice = Lattice.build(vocabulary(tokenizer), pieces, rows)
    weighed = words.mapInArrow(_weigh(lattice), "word binary, c long, lp double")

    chunks = max(1, math.ceil((size or 0) / chunk_bytes))
    by_chunk = source.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"), "doc_id", "held_out",
        F.col("text").cast("binary").alias("text"))
    asked = by_chunk.groupBy("chunk").applyInArrow(_asked, "chunk long, word binary")
    answers = asked.join(weighed, "word", "left").select("chunk", "word", "c", "lp")
    return by_chunk.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(lattice, n, v, rows),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
