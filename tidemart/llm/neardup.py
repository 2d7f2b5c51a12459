"""Near-duplicate groups by a MinHash LSH forest, confirmed on full shingle sets.

Documents of one shingle set are one class.  Each class's MinHash signature is read in several
orders; in the sorted order of each, neighbours with a long enough common prefix form a region, and
a region too large is cut by a longer prefix.  Regions that share a class are one cluster.  In a
cluster the full sets are compared outwards from one class at a time, each only with the classes
not reached yet: this finds the groups exactly, without listing their pairs.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import text_or_empty, written
from tidemart.llm.graph import components

WORDS = 5
SIMILARITY = 80
# Two sets of similarity 0.8 share a prefix of 5 in none of 24 orders with probability 0.00007.
TREES = 24
DEPTH, DEEPEST = 5, 8
# Classes in a region beyond which it is cut deeper.
REGION = 2000
# Words a task remembers the hash of, and shingles it compares at once.
_CACHE = 100_000
_AT_ONCE = 1 << 18

_MIX = np.random.default_rng(8).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SLOPE = np.random.default_rng(80).integers(1, 1 << 31, TREES * DEEPEST, np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = np.random.default_rng(81).integers(0, 1 << 32, TREES * DEEPEST, np.uint32)


def finished(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit sums."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Distinct shingles of a text as a sorted array of 64-bit hashes.

    Words are runs of all but ASCII white space, ASCII letters lower-cased; a text with fewer than
    `words` words is one shingle, one without any has none.
    """

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(words))
        sums = codes[:len(codes) - k + 1] * _MIX[0]
        for i in range(1, k):
            sums = sums + codes[i:len(codes) - k + 1 + i] * _MIX[i]
        if k < self.words:
            sums = sums + _MIX[63 - k]
        return np.unique(finished(sums))


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES * DEEPEST minima; order t is columns t * DEEPEST and on."""
    low = np.full(len(_SLOPE), 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        low = np.minimum(low, (x[None, at:at + 2048] * _SLOPE[:, None] + _SHIFT[:, None]).min(axis=1))
    return low


def _sketch(words: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                lot = batch.slice(at, 500)
                n, prints, signs = [], [], []
                for value in lot.column(2):
                    s = shingle(value.as_py())
                    n.append(len(s))
                    prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    signs.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [lot.column(0), lot.column(1), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())],
                    ["id", "row", "n_shingles", "print", "signature"])

    return sketch


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and order: a hash of the first DEPTH values, and the values that follow."""
    tree = finished(np.arange(1, TREES + 1, dtype=np.uint64) * _MIX[60])
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            lot = batch.slice(at, 2000)
            signs = np.frombuffer(b"".join(lot.column(1).to_pylist()), np.uint32).reshape(-1, TREES, DEEPEST)
            key = np.broadcast_to(tree, signs.shape[:2]).copy()
            for d in range(DEPTH):
                key = finished(key * _MIX[61] + signs[:, :, d])
            ids = np.repeat(lot.column(0).to_numpy(zero_copy_only=False), TREES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), pa.array(ids, pa.int64()),
                 *[pa.array(signs[:, :, d].ravel().view(np.int32)) for d in range(DEPTH, DEEPEST)]],
                ["region", "doc_id", *[f"v{d}" for d in range(DEPTH, DEEPEST)]])


def _regions(orders: DataFrame, region: int) -> DataFrame:
    """a, b: each class in a region with others and the region's first class."""
    found, depth = [], DEPTH
    while True:
        held = (orders.groupBy("region").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1"))
        held = written(orders.join(held, "region"), "regions")
        deeper = depth < DEEPEST and held.filter(F.col("n") > region).limit(1).count()
        found.append((held.filter(F.col("n") <= region) if deeper else held)
                     .select(F.col("doc_id").alias("a"), F.col("first").alias("b")))
        if not deeper:
            break
        orders = (held.filter(F.col("n") > region).drop("first", "n")
                  .withColumn("region", F.xxhash64("region", f"v{depth}")))
        depth += 1
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    # A class is in one region per order at most.  It and the first classes of its regions are
    # linked with the lowest of those: connected as before, by about one edge a class.
    stars = edges.groupBy("a").agg(F.min("b").alias("low"), F.collect_set("b").alias("firsts"))
    return (stars.select("a", F.col("low").alias("b"))
            .unionByName(stars.select(F.explode("firsts").alias("a"), F.col("low").alias("b")))
            .filter("a <> b").distinct())


def _shared(one: np.ndarray, owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many of each owner's values are in the sorted set `one`."""
    found = np.zeros(n, np.int64)
    for start in range(0, len(values), _AT_ONCE):
        part = values[start:start + _AT_ONCE]
        at = np.searchsorted(one, part)
        at[at == len(one)] = 0
        found += np.bincount(owner[start:start + _AT_ONCE][one[at] == part], minlength=n)
    return found


def linked_groups(sets: list[np.ndarray], similarity: int) -> list[int]:
    """For each set the index of the first member of its group.

    100 * intersection >= similarity * union links two sets; a group is what links reach.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    values = np.concatenate(sets)
    root = np.full(len(sets), -1, np.int32)
    for start in range(len(sets)):
        if root[start] >= 0:
            continue
        root[start], queue = start, deque([start])
        left = root[owner] < 0
        owner, values = owner[left], values[left]
        while queue and len(values):
            x = queue.popleft()
            shared = _shared(sets[x], owner, values, len(sets))
            near = np.flatnonzero((100 * shared >= similarity * (sizes[x] + sizes - shared)) & (root < 0))
            if len(near):
                root[near] = start
                queue.extend(near.tolist())
                left = root[owner] < 0
                owner, values = owner[left], values[left]
    return root.tolist()


def _confirmed(similarity: int):
    def confirmed(table: pa.Table) -> pa.Table:
        # Rows alike in doc_id and text come once for each of them.
        ids, order = np.unique(table.column("doc_id").to_numpy(), return_index=True)
        data = table.column("shingles").to_pylist()
        roots = linked_groups([np.frombuffer(data[i], np.uint64) for i in order], similarity)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "component": pa.array(ids[roots], pa.int64())})

    return confirmed


def _with_sets(words: int):
    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                lot = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [lot.column(0), lot.column(1),
                     pa.array([shingle(t.as_py()).tobytes() for t in lot.column(2)], pa.binary())],
                    ["cluster", "doc_id", "shingles"])

    return with_sets


# Stands for a null doc_id, after all others.
NO_ID = (1 << 63) - 1


def _identified(docs: DataFrame) -> list:
    """What a row is known by: its doc_id and a hash of its text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text_or_empty()).alias("row")]


def _grouped(docs: DataFrame, words: int, similarity: int, region: int) -> tuple[DataFrame, DataFrame]:
    """The sketches (id, row, n_shingles, print) of all rows, and of each class that has company, by
    its print, the first document (id, row) of its group."""
    known = ["id", "row"]
    texts = docs.select(*_identified(docs), text_or_empty().alias("text"))
    sketches = written(texts.mapInArrow(
        _sketch(words), "id long, row long, n_shingles long, print binary, signature binary"), "sketches")
    # A class is known by a number of its own; its head is its first row by doc_id.
    classes = written(
        sketches.filter("print IS NOT NULL").groupBy("print")
        .agg(F.min(F.struct("id", "row")).alias("head"), F.count(F.lit(1)).alias("members"))
        .select("print", "head.id", "head.row", "members", F.monotonically_increasing_id().alias("node")), "classes")
    heads = (sketches.filter("print IS NOT NULL").select("print", *known, "signature")
             .join(classes.select("print", *known, "node"), ["print", *known])
             .dropDuplicates(["node"]).select(F.col("node").alias("doc_id"), "signature"))
    orders = heads.mapInArrow(_orders, "region long, doc_id long, " + ", ".join(
        f"v{d} int" for d in range(DEPTH, DEEPEST)))
    clusters = components(_regions(orders, region))
    # The same join at every size: of what is a small side here today, much is left at scale.
    members = (clusters.select("node", F.col("root").alias("cluster"))
               .join(classes.select("node", *known).hint("merge"), "node").hint("merge"))
    sets = (texts.join(members, known)
            .select("cluster", F.col("node").alias("doc_id"), "text")
            .mapInArrow(_with_sets(words), "cluster long, doc_id long, shingles binary"))
    roots = (sets.groupBy("cluster").applyInArrow(_confirmed(similarity), "doc_id long, component long")
             .groupBy(F.col("doc_id").alias("node")).agg(F.min("component").alias("component")))
    held = written(classes.join(roots.hint("merge"), "node", "left")
                   .withColumn("component", F.coalesce("component", "node")), "class-groups")
    # Classes of one document without links need no row here.
    first = (held.groupBy("component").agg(F.min(F.struct("id", "row")).alias("first"), F.sum("members").alias("all"))
             .filter(F.col("all") > 1).drop("all"))
    return (sketches.select(*known, "n_shingles", "print"),
            held.select("print", "component").join(first.hint("merge"), "component").select("print", "first"))


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY,
                    region: int = REGION) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for every row of `docs`.

    Texts without words, empty and null ones have no shingles, are linked with nothing and kept.
    Rows are linked by their texts alone: rows that share a doc_id are told apart by text, and each
    has its own text's component.  Rows without doc_id join their text's component, which has none if
    all of its rows lack one.  Only doc_id and text are read.
    """
    sketches, grouped = _grouped(docs, words, similarity, region)
    own = F.nullif("id", F.lit(NO_ID))
    return (sketches.join(grouped, "print", "left")
            .select(own.alias("doc_id"), "n_shingles",
                    F.nullif(F.coalesce("first.id", "id"), F.lit(NO_ID)).alias("component_id"))
            .select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept")))


def first_of_groups(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns: of each group of near duplicates its first, by doc_id.

    A row is known by doc_id and text, so rows that share a doc_id but not the text are told apart,
    and rows without doc_id, which come after all others, are duplicates like any.  Of rows alike in
    both one stays.  Texts without words are linked with nothing: all their rows stay.
    """
    sketches, grouped = _grouped(docs, words, similarity, REGION)
    known = ["id", "row"]
    in_group = sketches.join(grouped, "print").select(
        *known, (F.struct("id", "row") == F.struct("first.id", "first.row")).alias("first"))
    # A row per document of a group: does it stay, and are there more rows like it?
    told = in_group.groupBy(*known).agg(F.first("first").alias("_stays"), (F.count(F.lit(1)) > 1).alias("_again"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *_identified(docs))
    kept = held.join(told.hint("merge"), known, "left").filter(F.coalesce("_stays", F.lit(True)))
    once = Window.partitionBy(*known).orderBy(F.to_json("_doc"))
    again = F.coalesce("_again", F.lit(False))
    # One a map task reaches the window, however many rows are alike.
    single = kept.filter(again).withColumn("_n", F.row_number().over(once)).filter(F.col("_n") == 1)
    return kept.filter(~again).select("_doc.*").unionByName(single.select("_doc.*"))
