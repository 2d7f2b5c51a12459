"""Phrase collocations, counted by dynamic itemset counting.

The documents are dealt out in shards, which are scanned one after the other in a cycle.  Words are
counted from the first scan on.  A longer phrase is counted as soon as the two phrases that it is
made of (all but its last word, all but its first) have been seen often enough, whatever their
lengths and wherever in the cycle the scan stands, and for one full cycle from there: then its count
is that of all documents.  So lengths are counted side by side, and the work is over when no phrase
is left within its cycle.

Scans know the phrases that were seen often enough by a table of a fixed number of slots, each with
the scan from which its phrases count.  Phrases that share a slot share that scan, so a phrase is
counted over exactly one cycle in any case; a slot shared with a frequent phrase only means that a
rare one is counted in vain.  Counts are by the phrases themselves, not by hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.bytewords import Hasher, byte_set, counted, lots, phrase_hash, words_of
from tidemart.llm.common import text_or_empty, written

LEAST = 100
LONGEST = 5
SHARDS = 4
TOP = 2000
ABSORB = 100
# Bytes of the table of frequent phrases: its size is fixed whatever the corpus holds.
SLOTS = 1 << 24

_PIECE = byte_set((10, 13), (33, 33), (44, 44), (46, 46), (58, 59), (63, 63))
_BREAK = _PIECE | byte_set((9, 9), (32, 32))
_COUNTS = "lang string, n int, phrase string, c long, start int"


def lang_hash(langs: pa.Array) -> np.ndarray:
    """A hash per row that tells languages apart."""
    named = langs.to_pylist()
    known = {x: int.from_bytes(blake2b(x.encode("utf-8", "replace"), digest_size=8).digest(), "little") for x in set(named)}
    return np.fromiter((known[x] for x in named), np.uint64, len(named))


class Phrases:
    """The words of a lot with a hash, and of each the piece it stands in."""

    def __init__(self, lot, langs: np.ndarray, hasher: Hasher):
        words = words_of(lot, _BREAK)
        self.data, self.start, self.end, self.text = lot.data, words.start, words.end, words.text
        self.piece = np.cumsum(_PIECE[lot.data])[words.start] if len(words.start) else words.start
        self.own = langs[words.text] if len(words.text) else np.zeros(0, np.uint64)
        self.hasher, self.hashes = hasher, hasher(lot.data, words.start, words.end) + self.own
        self.others: np.ndarray | None = None

    def second(self, at: np.ndarray, length: int) -> np.ndarray:
        """Other hashes of the phrases of `length` words that start at the words `at`: their words are hashed alone if few."""
        asked = np.zeros(len(self.start), bool)
        for i in range(length):
            asked[at + i] = True
        words = np.flatnonzero(asked)
        if self.others is None and 4 * len(words) > len(asked):
            self.others = self.hasher(self.data, self.start, self.end, 1) + self.own
        if self.others is not None:
            return phrase_hash(self.others, at, length, 1)
        end = np.cumsum(self.end[words] - self.start[words])
        start = np.concatenate([[0], end[:-1]])
        alone = self.data[np.repeat(self.start[words] - start, end - start) + np.arange(end[-1])]
        hashes = np.zeros(len(asked), np.uint64)
        hashes[words] = self.hasher(alone, start, end, 1) + self.own[words]
        return phrase_hash(hashes, at, length, 1)

    def strings(self, at: np.ndarray, length: int) -> pa.Array:
        """The phrases of `length` words that start at the words `at`, a blank between two words."""
        words = (at[:, None] + np.arange(length)).ravel()
        sizes = self.end[words] - self.start[words] + 1
        sizes[length - 1::length] -= 1
        upto = np.cumsum(sizes)
        # What stands behind a word of a phrase is a blank or a tab.
        taken = self.data[np.repeat(self.start[words] - upto + sizes, sizes) + np.arange(upto[-1])]
        taken[taken == 9] = 32
        offsets = np.concatenate([[0], upto[length - 1::length]]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(taken))


def summed(batches: Iterator[pa.RecordBatch], most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """The counts of one lot after the other, added up by phrase; some `most` rows are held.

    Where adding up leaves most rows, as of words that hardly repeat, it is left to the shuffle.
    """
    held, n, pays = [], 0, True
    for batch in batches:
        if not pays:
            yield batch
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            held, before = _added(held), n
            n = sum(x.num_rows for x in held)
            pays = 4 * n < 3 * before
            if 2 * n > most or not pays:
                yield from held
                held, n = [], 0
    yield from _added(held)


def _added(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    if not held:
        return held
    rows = pa.Table.from_batches(held).group_by(["lang", "n", "phrase", "start"], use_threads=False).aggregate([("c", "sum")])
    return rows.rename_columns({"c_sum": "c"}).select(["lang", "n", "phrase", "c", "start"]).combine_chunks().to_batches()


def slots_of(hashes: np.ndarray, at: np.ndarray, length: int, size: int) -> np.ndarray:
    return (phrase_hash(hashes, at, length) >> np.uint64(20)) % np.uint64(size)


def _scan(step: int, shards: int, longest: int, size: int, slots: np.ndarray, begins: np.ndarray):
    """Counts of a shard's words, in the first cycle, and of the phrases within their cycle at this step.

    The row with n = 0 has the number of all words.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.uint8)
        table[slots] = begins
        yield from summed(counts(batches, table))

    def counts(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            names = batch.column(1)
            for lot in lots(batch.column(0)):
                part = names[lot.first:lot.last]
                words = Phrases(lot, lang_hash(part), hasher)
                n = len(words.start)
                if not n:
                    continue
                lengths = [(1, np.arange(n), np.zeros(n, np.uint8))] if step < shards else []
                begin = table[slots_of(words.hashes, np.arange(n), 1, size)]
                for k in range(2, min(longest, n) + 1):
                    m = n - k + 1
                    both = (begin[:m] > 0) & (begin[1:m + 1] > 0) & (words.piece[:m] == words.piece[k - 1:])
                    at = np.flatnonzero(both)
                    if not len(at):
                        break
                    first = np.maximum(begin[at], begin[at + 1])
                    now = (first <= step) & (step < first.astype(np.int64) + shards)
                    lengths.append((k, at[now], first[now]))
                    own = table[slots_of(words.hashes, at, k, size)]
                    begin = np.zeros(m, np.uint8)
                    # A slot may be known before the phrase's own parts are: it begins with the last of them.
                    begin[at] = np.where(own > 0, np.maximum(own, first), 0)
                if step < shards:
                    total = np.bincount(words.text, minlength=len(part))
                    yield pa.RecordBatch.from_arrays(
                        [part, pa.array(np.zeros(len(part), np.int32)), pa.array([""] * len(part), pa.string()),
                         pa.array(total.astype(np.int64)), pa.array(np.zeros(len(part), np.int32))], ["lang", "n", "phrase", "c", "start"])
                for k, at, first in lengths:
                    if not len(at):
                        continue
                    head, times = counted(phrase_hash(words.hashes, at, k), words.second(at, k))
                    place = at[head]
                    yield pa.RecordBatch.from_arrays(
                        [part.take(pa.array(words.text[place])), pa.array(np.full(len(head), k, np.int32)),
                         words.strings(place, k),
                         pa.array(times.astype(np.int64)), pa.array(first[head].astype(np.int32))],
                        ["lang", "n", "phrase", "c", "start"])

    return scan


def _slots(size: int):
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for lot in lots(batch.column(0)):
                words = Phrases(lot, lang_hash(batch.column(1)[lot.first:lot.last]), hasher)
                n = batch.column(2).to_numpy()[lot.first:lot.last]
                head = np.searchsorted(words.text, np.arange(len(n)))
                found = np.zeros(len(n), np.int64)
                for k in np.unique(n):
                    found[n == k] = slots_of(words.hashes, head[n == k], int(k), size).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["slot"])

    return slots


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS,
                     size: int = SLOTS) -> DataFrame:
    """lang, n, phrase, c: every word and phrase of 2 to `longest` words that occurs `least` times.

    Case is folded for A-Z; phrases don't cross pieces; a null lang counts as `und`, null text as
    empty.  The row with n = 0 has the number of all words of the language.  Phrases are counted
    wherever they start, so they may overlap.  Repeated rows count each time.  No documents, no rows.
    """
    source = docs.select(text_or_empty().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    dealt = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    shard = _dealt(source.withColumn("shard", dealt), shards)
    open_, found, known = None, [], (np.zeros(0, np.int64), np.zeros(0, np.uint8))
    step, last = 0, -1
    while step < shards or step < last + shards:
        counts = (shard[step % shards].mapInArrow(_scan(step, shards, longest, size, *known), _COUNTS)
                  .withColumn("old", F.lit(0).cast("long")))
        if open_ is not None:
            counts = counts.unionByName(open_.withColumn("old", F.col("c")))
        state = written(
            counts.groupBy("lang", "n", "phrase").agg(F.sum("c").alias("c"), F.max("old").alias("old"), F.max("start").alias("start"))
            .withColumn("done", F.col("start") + shards - 1 == step)
            # A phrase that was counted in full and is rare is of no more use.
            .filter(~F.col("done") | (F.col("c") >= least) | (F.col("n") == 0)), f"phrases-{step}")
        found.append(state.filter("done").select("lang", "n", "phrase", "c"))
        open_ = state.filter("NOT done").select("lang", "n", "phrase", "c", "start")
        # At most as many as there are slots.
        new = (state.filter(F.col("n").between(1, longest - 1) & (F.col("c") >= least) & (F.col("old") < least))
               .select("phrase", "lang", "n").mapInArrow(_slots(size), "slot long").distinct().toArrow())
        fresh = np.setdiff1d(new.column("slot").to_numpy(), known[0])
        step += 1
        if len(fresh):
            last = step
            known = (np.concatenate([known[0], fresh]), np.concatenate([known[1], np.full(len(fresh), step, np.uint8)]))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _dealt(source: DataFrame, shards: int) -> list[DataFrame]:
    """The documents of each shard, read from one table."""
    folder_rows = written(source, "phrase-shards", "shard")
    return [folder_rows.filter(F.col("shard") == i).select("text", "lang") for i in range(shards)]


def _rest(words: str, k: str) -> str:
    return f"array_join(slice({words}, {k} + 1, size({words})), ' ')"


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, absorb: int = ABSORB,
                 shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases.

    A phrase that occurs a times scores floor(1000 * a * n / (l * r)) in the cut into two parts (which
    occur l and r times) where that is least, n being all words of the language; of cuts alike the
    first counts.  Phrases within a longer one that has `absorb` % of their occurrences are left out.
    Products are exact to 38 digits.  Ties rank by occurrences, then by the phrase's bytes.
    """
    every = written(frequent_phrases(docs, least, longest, shards), "frequent-phrases")
    phrases = every.filter("n >= 2").select("lang", "phrase", F.col("n").alias("length"), F.col("c").alias("a"),
                                            F.split("phrase", " ").alias("words"))
    parts = every.filter("n >= 1").select("lang", "phrase", "c")
    inside = (phrases.filter("length >= 3")
              .select("lang", "a", "words", "length", F.explode(F.expr("sequence(2, length - 1)")).alias("k"))
              .select("lang", "a", F.explode(F.expr(
                  "transform(sequence(1, length - k + 1), i -> array_join(slice(words, i, k), ' '))")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    own = (phrases.join(inside, ["lang", "phrase"], "left")
           .filter(F.coalesce(100 * F.col("longer") < absorb * F.col("a"), F.lit(True))))
    cuts = own.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, length - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("first"),
        F.expr(_rest("words", "k")).alias("rest"))
    totals = every.filter("n = 0").select("lang", F.col("c").alias("n"))
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l")), ["lang", "first"])
              .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r")), ["lang", "rest"])
              .join(totals, "lang")
              .withColumn("score", F.expr("(cast(1000 * a AS decimal(19, 0)) * cast(n AS decimal(19, 0))) div "
                                          "(cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0)))")))
    least_cut = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("x"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (least_cut.select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")
            .withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def oracle() -> str:
    """The same in DuckDB's SQL."""
    grams = "\n UNION ALL ".join(
        f"SELECT lang, {k} AS n, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM pieces WHERE len(w) >= {k})"
        for k in range(1, LONGEST + 1))
    return f"""
    WITH cut AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM cut),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
    grams AS ({grams}),
    often AS (SELECT lang, n, phrase, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
    cand AS (SELECT lang, n AS k, phrase, c AS a, string_split(phrase, ' ') AS w FROM often WHERE n >= 2),
    inside AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
               FROM (SELECT lang, a, w, size, unnest(range(1, k - size + 2)) AS i
                     FROM (SELECT lang, a, w, k, unnest(range(2, k)) AS size FROM cand WHERE k >= 3)) GROUP BY ALL),
    own AS (SELECT c.* FROM cand c LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {ABSORB} * a),
    cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS j FROM own),
    scored AS (SELECT u.lang, u.phrase, u.a, u.j, x.c AS l, y.c AS r, t.n,
                      ((1000::HUGEINT * u.a * t.n) // (x.c::HUGEINT * y.c))::BIGINT AS score
               FROM cuts u JOIN often x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:u.j], ' ')
               JOIN often y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.j + 1:], ' ')
               JOIN totals t ON t.lang = u.lang),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
                      phrase, a, l, r, n, score FROM least)
    SELECT * FROM ranked WHERE rank <= {TOP}"""
