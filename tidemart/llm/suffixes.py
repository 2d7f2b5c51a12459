"""Removal of repeated passages by a sparse suffix array.

A string of `length` bytes that occurs twice has the same lowest-hashed 32-byte gram in both places,
so only suffixes that start at such anchors need sorting.  Splitters sampled from the anchors'
bytes deal the suffixes out in ranges.  A first pass keeps anchors whose gram occurs again; its
splitters look at the gram's own bytes, so equal grams meet.  A second sorts what stands right and
left of those by multikey quicksort.  Classes of equal neighbours in both orders tell for every start
whether its string occurs elsewhere in the range, byte for byte.  Its splitters look at all that is
sorted, so a range may end inside one gram, and a gram that a third of the documents hold is many
ranges.  A match across a boundary shares its first bytes with the splitter there: starts that do are
compared across ranges by a 128-bit hash of their string, counted by Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import text_or_empty, written

LENGTH = 200
GRAM = 32
LEAD = 16
# Text per range of suffixes, and documents sampled for the splitters: at least so many, and so many a range.
RANGE_BYTES = 4_000_000
SAMPLE_DOCS, RANGE_DOCS = 1000, 4
# Rows of a range whose strings are hashed at once.
HASHED_ROWS = 4_000
SEED = 1
# Stands for a null doc_id.
NO_ID = -(1 << 62)
# Text that is hashed at once; one longer document is a lot of its own.
LOT_BYTES = 2_000_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes from each place on."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h = words[:n] * _ODD[0]
    for i in range(1, 4):
        h ^= words[8 * i:8 * i + n] * _ODD[i]
        h ^= h >> np.uint64(29)
        h *= _ODD[(i + 1) % 4]
    return h ^ (h >> np.uint64(32))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by doubling."""
    least, have = keys, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[:len(keys) - width + 1], least[width - have:]) if width > have else least


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of texts that stand one after the other in `data`: document, place, hash, and the least and most
    distance to the starts of the strings, for each anchor and run of starts it serves."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty.astype(np.uint64), empty, empty
    h = gram_hashes(data)
    keys = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    least = sliding_least(keys, length - GRAM + 1)
    begins = np.concatenate([[0], ends[:-1]])
    many = np.maximum(ends - begins - length + 1, 0)
    doc = np.repeat(np.arange(len(ends)), many)
    starts = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + begins[doc]
    at = (least[starts] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])) if len(at) else empty
    last = np.concatenate([new[1:] - 1, [len(at) - 1]]) if len(at) else empty
    place = at[new]
    return doc[new], place, h[place], place - starts[last], place - starts[new]


def lots(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """first row, row after the last, the bytes of their texts, where each text ends."""
    texts = batch.column(column)
    sizes = np.array([len(v.as_buffer()) for v in texts], np.int64)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), LOT_BYTES, "right")) + at)
        data = np.frombuffer(b"".join(v.as_buffer() for v in texts[at:to]), np.uint8)
        yield at, to, data, np.cumsum(sizes[at:to])
        at = to


def gathered(data: np.ndarray, place: np.ndarray, before: int, after: int) -> np.ndarray:
    """A row of bytes around each place; zeros beyond the ends."""
    padded = np.concatenate([np.zeros(before, np.uint8), data, np.zeros(after, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, before + after)
    return rows[place]


def ranges(keys: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The range of each row of bytes; splitters may be shorter than rows."""
    width = splitters.dtype.itemsize
    whole = np.ascontiguousarray(keys[:, :width]).view(f"S{width}").ravel()
    return np.searchsorted(splitters, whole, "right").astype(np.int32)


def sort_key(around: np.ndarray, left: int) -> np.ndarray:
    """What a range of contexts is sorted by: the bytes from the anchor on, then those before it backwards."""
    return np.concatenate([around[:, left:], around[:, :left][:, ::-1]], axis=1)


def shared_with_splitters(right: np.ndarray, bucket: int, splitters: np.ndarray) -> np.ndarray:
    """How many first bytes each row of a range has in common with a splitter at either end of it."""
    n, width = right.shape
    found = np.zeros(n, np.int64)
    for at in (bucket - 1, bucket):
        if 0 <= at < len(splitters):
            differ = right != np.frombuffer(splitters[at].ljust(splitters.dtype.itemsize, b"\0"), np.uint8)[:width]
            found = np.maximum(found, np.where(differ.any(axis=1), differ.argmax(axis=1), width))
    return found


def multikey_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of byte rows, and each one's common prefix with the one before it.

    Multikey quicksort with words of 8 bytes as characters: rows are parted by one word, and only
    parts with more than one row go on to the next.  All open parts are parted in one sort.
    """
    n, width = rows.shape
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -width % 8)))).view(">u8").astype(np.uint64)
    order, part = np.arange(n), np.zeros(n, np.int64)
    open_ = np.arange(n)
    for i in range(words.shape[1]):
        if not len(open_):
            break
        by = np.lexsort((words[order[open_], i], part[open_]))
        order[open_] = order[open_][by]
        key = words[order[open_], i]
        own = part[open_]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        first = np.flatnonzero(fresh)
        part[open_] = np.repeat(open_[first], np.diff(np.concatenate([first, [len(open_)]])))
        size = np.diff(np.concatenate([first, [len(open_)]]))
        open_ = open_[np.repeat(size > 1, size)]
    common = np.zeros(n, np.int64)
    for at in range(0, n - 1, 20_000):
        to = min(n - 1, at + 20_000)
        differ = rows[order[at:to]] != rows[order[at + 1:to + 1]]
        common[at + 1:to + 1] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def repeated_starts(context: np.ndarray, least: np.ndarray, most: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, distance) of the starts whose whole string occurs around another anchor too.

    context: `length` - GRAM bytes left of each anchor and `length` from it on.  The start at distance
    d repeats if another anchor that serves d has the same d bytes before and length - d after.
    """
    n, left = len(context), length - GRAM
    orders = [multikey_order(context[:, left:]), multikey_order(context[:, :left][:, ::-1])]

    def classes(side: int, size: int) -> np.ndarray:
        order, common = orders[side]
        found = np.empty(n, np.int64)
        found[order] = np.cumsum(common < size)
        return found

    def counts(keys: np.ndarray) -> np.ndarray:
        _, back, many = np.unique(keys, return_inverse=True, return_counts=True)
        return many[back]

    # Rows alike throughout repeat each other at every distance; one of them stands for all.
    alike = ((classes(0, length) * (n + 1) + classes(1, left)) * 256 + least) * 256 + most
    _, head, back, many = np.unique(alike, return_index=True, return_inverse=True, return_counts=True)
    whole = np.flatnonzero(many[back] > 1)
    size = most[whole] - least[whole] + 1
    rows = [np.repeat(whole, size)]
    distances = [np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(least[whole], size)]
    for d in range(left + 1):
        serving = head[(least[head] <= d) & (d <= most[head])]
        if len(serving) > 1:
            keys = classes(0, length - d)[serving] * (n + 1) + classes(1, d)[serving]
            twice = serving[counts(keys) > 1]
            twice = twice[many[back[twice]] == 1]
            rows.append(twice)
            distances.append(np.full(len(twice), d))
    return np.concatenate(rows), np.concatenate(distances)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if found and a <= found[-1][1]:
            found[-1] = found[-1][0], max(b, found[-1][1])
        else:
            found.append((a, b))
    return found


def _sampled(length: int):
    left = length - GRAM

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, ends in lots(batch, 0):
                doc, place, _, _, _ = anchors(data, ends, length)
                place = place[(np.arange(len(place)) + doc) % 8 == 0]
                keys = sort_key(gathered(data, place, left, length), left)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in keys], pa.binary())], ["key"])

    return sampled


def splitters(texts: DataFrame, length: int, wanted: int) -> np.ndarray:
    """Sort keys that cut the anchors into `wanted` ranges, from a sample of some documents a range.

    Every eighth anchor of a sampled document counts, whatever its gram: a gram that many documents
    hold is cut as often as its share of the anchors asks for.
    """
    width = 2 * length - GRAM
    if wanted < 2:
        return np.zeros(0, f"S{width}")
    share = max(SAMPLE_DOCS, RANGE_DOCS * wanted) / max(texts.count(), 1)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "text"), 11) / F.lit(float(1 << 53))
    keys = sorted(bytes(r[0]) for r in texts.filter(draw < share).select("text")
                  .mapInArrow(_sampled(length), "key binary").collect())
    cuts = [keys[len(keys) * i // wanted] for i in range(1, wanted)] if keys else []
    return np.unique(np.array(cuts, f"S{width}"))


def _asked(length: int, cut: np.ndarray):
    """A row per anchor.  A gram that a lot holds more than once needs no answer (sure): one row of
    it goes to its range on behalf of the lot, the others by row."""
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, _, data, ends in lots(batch, 2):
                doc, place, h, least, most = anchors(data, ends, length)
                if not len(doc):
                    continue
                _, head, back, many = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                sure = many[back] > 1
                spread = np.ones(len(h), bool)
                spread[head] = False
                bucket = ranges(gathered(data, place, 0, LEAD), cut)
                bucket[spread] = prints[at + doc[spread]] % (len(cut) + 1)
                begin = np.concatenate([[0], ends[:-1]])[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int32()), pa.array(h.view(np.int64)), pa.array(ids[at + doc]), pa.array(prints[at + doc]),
                     pa.array((place - begin).astype(np.int32)), pa.array((least << 8 | most).astype(np.int32)),
                     pa.array(sure.astype(np.int8) + spread)],
                    ["bucket", "h", "id", "print", "place", "reach", "sure"])

    return asked


def _answered(table: pa.Table) -> pa.Table:
    """The anchors whose gram occurs again.  sure: 0 open, 1 known to, 2 known to and not its lot's first."""
    h, sure = table.column("h").to_numpy(), table.column("sure").to_numpy()
    _, back, many = np.unique(h, return_inverse=True, return_counts=True)
    return table.filter(pa.array((sure > 0) | (many[back] > 1))).select(["id", "print", "place", "reach"])


def _contexts(length: int, cut: np.ndarray):
    """A row per anchor with what stands around it, or, where its lot already holds an equal one, a
    row without, which only says that its starts repeat.  Of rows alike in doc_id and text, which
    come one after the other, the first speaks for all."""
    left = length - GRAM

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            both = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            new = [x != y for x, y in zip(both, [before, *both[:-1]], strict=True)]
            before = both[-1] if both else before
            batch = batch.filter(pa.array(new, pa.bool_()))
            ids, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, to, data, ends in lots(batch, 2):
                asked = batch.column(3)[at:to]
                flat = asked.flatten()
                doc = np.repeat(np.arange(to - at), asked.value_lengths().to_numpy())
                begin = np.concatenate([[0], ends[:-1]])[doc]
                place = flat.field("place").to_numpy().astype(np.int64)
                reach = flat.field("reach").to_numpy()
                least, most = (reach >> 8).astype(np.int64), (reach & 255).astype(np.int64)
                for part in range(0, len(doc), 20_000):
                    s = slice(part, part + 20_000)
                    around = gathered(data, begin[s] + place[s], left, length).copy()
                    column = np.arange(left + length)
                    around[(column < left - most[s][:, None]) | (column >= left + length - least[s][:, None])] = 0
                    keys = np.concatenate([around, least[s, None].astype(np.uint8), most[s, None].astype(np.uint8)], axis=1)
                    rows = np.ascontiguousarray(keys).view(f"V{keys.shape[1]}").ravel()
                    first: dict[bytes, int] = {}
                    head = np.array([first.setdefault(r, i) for i, r in enumerate(rows.tolist())])
                    own = head == np.arange(len(head))
                    twice = np.bincount(head, minlength=len(head))[head] > 1
                    bucket = ranges(sort_key(around, left), cut)
                    bucket[~own] = (prints[at + doc[s][~own]] % (len(cut) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket, pa.int32()), pa.array(ids[at + doc[s]]), pa.array(prints[at + doc[s]]),
                         pa.array(place[s].astype(np.int32)), pa.array((least[s] << 8 | most[s]).astype(np.int32)),
                         pa.array(twice), pa.array([r.tobytes() if o else None for r, o in zip(around, own, strict=True)], pa.binary())],
                        ["bucket", "id", "print", "place", "reach", "twice", "around"])

    return contexts


def _judged(length: int, cut: np.ndarray):
    """The repeated starts of a range, as spans; and with a key, the starts that a row of another range may share.

    known: the start repeats here, and the row only says so to others; not every row of a string need.
    """
    left = length - GRAM

    def judged(table: pa.Table) -> pa.Table:
        reach = table.column("reach").to_numpy()
        least, most = (reach >> 8).astype(np.int64), (reach & 255).astype(np.int64)
        place = table.column("place").to_numpy().astype(np.int64)
        twice = table.column("twice").to_numpy()
        around = table.column("around").combine_chunks()
        with_text = np.flatnonzero(around.is_valid().to_numpy(zero_copy_only=False))
        rows, low, high = [np.flatnonzero(twice)], [place[twice] - most[twice]], [place[twice] - least[twice]]
        asked: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
        if len(with_text):
            data = np.frombuffer(b"".join(around.drop_null().to_pylist()), np.uint8).reshape(len(with_text), -1)
            row, d = repeated_starts(data, least[with_text], most[with_text], length)
            told = row * 256 + d
            row = with_text[row]
            order = np.lexsort((d, row))
            row, d = row[order], d[order]
            row, d = row[~twice[row]], d[~twice[row]]
            if len(row):
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (d[1:] != d[:-1] + 1)])
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:] - 1, [len(row) - 1]])
                rows.append(row[first])
                low.append(place[row[first]] - d[last])
                high.append(place[row[first]] - d[first])
            # A start at distance d shares its length - d bytes from the anchor on with a splitter, or no
            # row of another range has them.
            shared = shared_with_splitters(data[:, left:], table.column("bucket")[0].as_py(), cut)
            lowest = np.maximum(least[with_text], length - shared)
            flat, near = memoryview(data).cast("B"), np.flatnonzero(lowest <= most[with_text])
            for part in range(0, len(near), HASHED_ROWS):
                one = near[part:part + HASHED_ROWS]
                size = most[with_text[one]] - lowest[one] + 1
                at = np.repeat(one, size)
                distance = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lowest[one], size)
                known = twice[with_text[at]] | np.isin(at * 256 + distance, told)
                begin = at * data.shape[1] + left - distance
                keys = [xxhash.xxh3_128_digest(flat[b:b + length]) for b in begin.tolist()]
                said: dict[bytes, int] = {}
                keep = np.array([not k or said.setdefault(key, i) == i
                                 for i, (key, k) in enumerate(zip(keys, known.tolist(), strict=True))], bool)
                asked.append((with_text[at[keep]], distance[keep], known[keep],
                              pa.array(keys, pa.binary()).filter(pa.array(keep))))
        spans = sum(map(len, rows))
        for row, d, _, _ in asked:
            rows.append(row)
            low.append(place[row] - d)
            high.append(place[row] - d)
        own = np.concatenate(rows)
        known = np.concatenate([np.ones(spans, bool), *[k for _, _, k, _ in asked]])
        keys = pa.concat_arrays([pa.nulls(spans, pa.binary()), *[k for _, _, _, k in asked]])
        return pa.table({"id": table.column("id").take(pa.array(own)), "print": table.column("print").take(pa.array(own)),
                         "low": pa.array(np.concatenate(low).astype(np.int32)),
                         "high": pa.array((np.concatenate(high) + length).astype(np.int32)),
                         "key": keys, "known": pa.array(known)})

    return judged


def _settled(judged: DataFrame) -> DataFrame:
    """The spans, those found in one range and those that another range has too, in one pass.

    A string that is not known to repeat has one row a range; a known one may have some more.
    """
    spans = [F.when(F.col("key").isNull(), F.col(c)) for c in ("id", "print")]
    rows = F.count(F.lit(1)).over(Window.partitionBy("key", *spans))
    return (judged.withColumn("n", rows).filter("key IS NULL OR (NOT known AND n > 1)")
            .select("id", "print", "low", "high"))


_RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
           " spans array<struct<start: int, end: int>>, text binary")


def _cut_out(with_text: bool):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for i, value in enumerate(batch.column(1)):
                data = value.as_py()
                spans = merged([(x["low"], min(x["high"], len(data))) for x in batch.column(2)[i].as_py() or ()])
                parts, at = [], 0
                for a, b in spans:
                    parts.append(data[at:a])
                    at = b
                rest = b"".join([*parts, data[at:]])
                found.append((len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(),
                              [{"start": a, "end": b} for a, b in spans]))
                kept.append(rest if with_text else None)
            columns = list(zip(*found, strict=True)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), kind), strict=True)],
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text"])

    return cut_out


def without_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, text: a row for every row of `docs`.

    spans are the removed runs in bytes; text is what is left, or null unless asked for.  Null text
    counts as empty; texts shorter than `length` lose nothing but may not be told apart from others
    either.  Repeated rows repeat each other's text and lose it all.  Null and repeated doc_ids are
    allowed: a row is known by doc_id and the hash of its text.  Only doc_id and text are read.  `length` is 33 to 255.
    """
    if not GRAM < length < 256:
        raise ValueError("length must be 33 to 255")
    data = text_or_empty().cast("binary")
    # Both joins below deal out the same columns by id and print, so the texts are shuffled once.
    row = ["id", "print"]
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                         F.xxhash64("doc_id", "text").alias("print"), data.alias("text"))
    total = source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    cut = splitters(source, length, math.ceil(total / RANGE_BYTES))
    grams = np.unique(cut.astype(f"S{LEAD}"))
    long = F.octet_length("text") >= length
    found = (source.filter(long).mapInArrow(
        _asked(length, grams), "bucket int, h long, id long, print long, place int, reach int, sure byte")
        .groupBy("bucket").applyInArrow(_answered, "id long, print long, place int, reach int"))
    # A row's anchors differ; those of rows alike come once for each of them.
    asked = written(found.groupBy(*row).agg(F.collect_set(F.struct("place", "reach")).alias("asked"), F.count(F.lit(1)).alias("times"))
                    .withColumn("alike", F.col("times") > F.size("asked")).drop("times"), "anchors")
    judged = (source.join(asked.drop("alike").hint("merge"), row).select(*row, "text", "asked").mapInArrow(
        _contexts(length, cut), "bucket int, id long, print long, place int, reach int, twice boolean, around binary")
        .groupBy("bucket").applyInArrow(
            _judged(length, cut), "id long, print long, low int, high int, key binary, known boolean"))
    whole = asked.filter("alike").select(*row, F.lit(0).alias("low"), F.lit((1 << 31) - 1).alias("high"))
    spans = _settled(judged).unionByName(whole).groupBy(*row).agg(F.collect_list(F.struct("low", "high")).alias("found"))
    return source.join(spans.hint("merge"), row, "left").select("id", "text", "found").mapInArrow(
        _cut_out(with_text), _RESULT).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
