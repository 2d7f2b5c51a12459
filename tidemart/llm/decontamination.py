"""Benchmark decontamination by pigeonhole edit matching.

A text within k edits of a test item must hold one of any k + 1 pieces of the item unchanged.  So
each item is cut into pieces, one automaton finds all pieces in a document in one pass, and around
each hit Myers' bit-parallel distance says whether the item really ends there within k edits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import text_or_empty

# Edits allowed, as a share of an item's length.
ERROR_RATE = 0.08
# Shorter items prove nothing: any text may hold them.
LEAST_CHARS = 24
# Items of so many characters at most go to the executors at once; more take more passes.
ITEM_CHARS = 16_000_000

# Of UTF-8 bytes; it keeps every length, so that offsets stay those of the original.
_FOLD = bytes.maketrans(bytes(range(0x41, 0x5B)) + bytes(range(0x09, 0x0E)), bytes(range(0x61, 0x7B)) + b" " * 5)


def fold(text: bytes) -> str:
    """ASCII letters lower-cased, each white space character a blank."""
    return text.translate(_FOLD).decode("utf-8", "replace")


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of almost equal length, with their offsets."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_end(item: str, text: str, errors: int) -> tuple[int, int] | None:
    """(distance, end) of the item's best occurrence anywhere in `text`, if within `errors`.

    Myers' recurrence on whole-number bit vectors, first row 0: a match may start anywhere.
    """
    m = len(item)
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, distance, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        diagonal = (((eq & up) + up) ^ up | eq | down) & full
        h_up, h_down = down | ~(diagonal | up) & full, up & diagonal
        if h_up & last:
            distance += 1
        elif h_down & last:
            distance -= 1
        h_up, h_down = h_up << 1 & full, h_down << 1 & full
        up, down = h_down | ~(diagonal | h_up) & full, h_up & diagonal
        if distance <= errors and (best is None or distance < best[0]):
            best = distance, j + 1
    return best


def matches(text: str, items: Sequence[tuple[int, str, int]], automaton) -> list[tuple[int, int, int]]:
    """(item index, end, distance) of every item found in the folded text, at its best place."""
    hits: dict[int, list[int]] = {}
    for end, (size, owners) in automaton.iter(text):
        for item, offset in owners:
            hits.setdefault(item, []).append(end + 1 - size - offset)
    found = []
    for item, starts in hits.items():
        _, wanted, errors = items[item]
        best, at = None, 0
        starts.sort()
        while at < len(starts):
            low = high = starts[at]
            # Hits whose windows overlap share one.
            while at < len(starts) and starts[at] <= high + len(wanted):
                high = starts[at]
                at += 1
            begin = max(0, low - errors)
            seen = best_end(wanted, text[begin:high + len(wanted) + errors], errors)
            if seen and (best is None or seen[0] < best[0]):
                best = seen[0], begin + seen[1]
                if not best[0]:
                    break
        if best:
            found.append((item, best[1], best[0]))
    return sorted(found)


def build(items: Sequence[tuple[int, str, int]]):
    owners: dict[str, list[tuple[int, int]]] = {}
    for i, (_, text, errors) in enumerate(items):
        for offset, piece in pieces(text, errors):
            owners.setdefault(piece, []).append((i, offset))
    automaton = ahocorasick.Automaton()
    for piece, where in owners.items():
        automaton.add_word(piece, (len(piece), where))
    automaton.make_automaton()
    return automaton


def item_lots(benchmark: DataFrame, rate: float, least: int, lot_chars: int) -> Iterator[list[tuple[int, str, int]]]:
    """The items, folded, as (item_id, text, errors), in lots of bounded size."""
    lot, chars = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), text_or_empty()).toLocalIterator():
        text = fold(row[1].encode()).strip()
        if row[0] is None or len(text) < least:
            continue
        if lot and chars + len(text) > lot_chars:
            yield lot
            lot, chars = [], 0
        lot.append((row[0], text, int(len(text) * rate)))
        chars += len(text)
    if lot:
        yield lot


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE,
                      least_chars: int = LEAST_CHARS, lot_chars: int = ITEM_CHARS) -> DataFrame:
    """doc_id, item_id, end_char, distance: a row per document row and item it holds.

    An item of m characters is held where some passage of the document is within floor(rate * m)
    edits of it, after ASCII case and kinds of white space are levelled; end_char is where the best
    such passage ends (code points, the first of equals among those searched).  Null and empty
    texts hold nothing; items that are null, without id or shorter than `least_chars` are not
    searched; repeated rows give repeated matches, equal items one match each.  Whole texts are
    searched, whatever their length.
    """
    schema = "doc_id long, item_id long, end_char long, distance int"
    found = None
    for lot in item_lots(benchmark, rate, least_chars, lot_chars):
        def search(batches: Iterator[pa.RecordBatch], lot=lot) -> Iterator[pa.RecordBatch]:
            automaton = build(lot)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                    rows += [(doc_id, lot[i][0], end, d) for i, end, d in matches(fold(text.as_py()), lot, automaton)]
                columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)],
                    ["doc_id", "item_id", "end_char", "distance"])

        part = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE,
                   least_chars: int = LEAST_CHARS, lot_chars: int = ITEM_CHARS) -> DataFrame:
    """The rows of `docs`, all columns, that hold no benchmark item.  Judged row by row, in the same
    pass over the texts and without a join; null texts stay."""
    at = docs.columns.index("text")
    for lot in item_lots(benchmark, rate, least_chars, lot_chars):
        def clean(batches: Iterator[pa.RecordBatch], lot=lot) -> Iterator[pa.RecordBatch]:
            automaton = build(lot)
            for batch in batches:
                yield batch.filter(pa.array(
                    [not matches(fold(text.as_py() or b""), lot, automaton)
                     for text in batch.column(at).cast(pa.binary())],
                    pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
