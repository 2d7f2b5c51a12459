"""Ranked lexical search by exact sparse ball trees.

Every document is a sparse vector over the items' terms, whose entry is what the term adds to a
score; an item is the set of its terms, so a score is an inner product.  The documents of a task are
cut into blocks, and each block is a ball tree: a node knows the centroid of its documents, the
largest distance from it and which terms occur below it.  No document below a node scores more than
the centroid's product plus that distance times the length of the item's part that occurs there.
Both are worked out in doubles and rounded up by more than they can be wrong, so a node whose bound
is below the item's tenth score so far can go.  Nodes are opened best first; leaves are scored in
64-bit integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.bytewords import Hasher, byte_set, lots, words_of
from tidemart.llm.common import text_or_empty, written

TOP = 10
# Documents of a block and of a leaf.
BLOCK, LEAF = 1024, 32
# Bytes of items that are searched for together; more are searched for lot by lot.
ITEM_BYTES = 4_000_000

_NO_TERM = ~byte_set((48, 57), (65, 90), (97, 122), (128, 255))


def term_hashes(lot, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, and both hashes, of each term of a lot."""
    words = words_of(lot, _NO_TERM)
    return words.text, *[hasher(lot.data, words.start, words.end, lane) for lane in range(2)]


@dataclass
class Items:
    """ids; the terms' hashes in order; begin and term: which terms (by place) each item has."""

    ids: list
    one: np.ndarray
    two: np.ndarray
    begin: np.ndarray
    term: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str]) -> Items:
        parts = []
        for lot in lots(pa.array(texts, pa.string())):
            text, one, two = term_hashes(lot, Hasher())
            parts.append((text + lot.first, one, two))
        text, one, two = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 2)
        order = np.lexsort((two, one))
        new = np.concatenate([np.ones(min(len(order), 1), bool), (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        pairs = np.unique(np.stack([text, place], axis=1), axis=0)
        return cls(ids, one[order][new], two[order][new], np.searchsorted(pairs[:, 0], np.arange(len(ids) + 1)), pairs[:, 1])

    def places(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The place of each term among the items', or -1."""
        if not len(self.one):
            return np.full(len(one), -1)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        found = np.where((self.one[at] == one) & (self.two[at] == two), at, -1)
        for i in np.flatnonzero((self.one[at] == one) & (found < 0)):  # terms of one first hash
            while at[i] < len(self.one) and self.one[at[i]] == one[i]:
                if self.two[at[i]] == two[i]:
                    found[i] = at[i]
                at[i] += 1
        return found


def _indexed(items: Items):
    """Each document's length in terms, and those of its terms that items have, with their counts."""
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for lot in lots(batch.column(1)):
                docs = len(lot.sizes)
                text, one, two = term_hashes(lot, hasher)
                place = items.places(one, two)
                known = place >= 0
                key, times = np.unique(text[known] * (len(items.one) + 1) + place[known], return_counts=True)
                offsets = pa.array(np.searchsorted(key // (len(items.one) + 1), np.arange(docs + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lot.first:lot.last], pa.array(np.bincount(text, minlength=docs).astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array((key % (len(items.one) + 1)).astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
                    ["doc_id", "n", "term", "tf"])

    return indexed


def term_weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def entries(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What each term adds to a score; n: its document's terms."""
    m = 100 - 90 + (90 * n * documents) // max(terms, 1)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Node:
    """low to high: its documents in the block's order; children, or None for a leaf."""

    low: int
    high: int
    children: tuple[int, int] | None = None


class Block:
    """A ball tree over the sparse integer vectors of some documents."""

    def __init__(self, begin: np.ndarray, term: np.ndarray, value: np.ndarray, items: Items, leaf: int = LEAF):
        self.items, self.leaf = items, leaf
        self.size = len(begin) - 1
        self.begin, self.term, self.value = begin, term, value
        self.order = np.arange(self.size)
        self.nodes: list[Node] = []
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        centers, reach, seen = [], [], []
        # Breadth first; a node's documents stand side by side.
        todo = [(0, self.size)]
        while todo:
            grown = []
            for low, high in todo:
                self.nodes.append(Node(low, high))
                columns, center, radius, distance = self._ball(low, high)
                seen.append(columns)
                centers.append(center)
                reach.append(radius)
                # Documents that are all alike need no leaves of their own.
                if high - low > leaf and radius > 0:
                    middle = self._split(low, high, distance)
                    grown += [(low, middle), (middle, high)]
                    self.nodes[-1].children = (0, 0)
            todo = grown
        follow = 1
        for node in self.nodes:
            if node.children:
                node.children = follow, follow + 1
                follow += 2
        self.bounds = self._bounds(seen, centers, reach)

    def _rows(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """begin of each document from 0 on, terms, values."""
        s = slice(self.begin[low], self.begin[high])
        return self.begin[low:high + 1] - self.begin[low], self.term[s], self.value[s].astype(np.float64)

    def _ball(self, low: int, high: int):
        begin, term, value = self._rows(low, high)
        owner = np.repeat(np.arange(high - low), np.diff(begin))
        columns, back = np.unique(term, return_inverse=True)
        center = np.bincount(back, value, minlength=len(columns)) / (high - low)
        length, middle = np.bincount(owner, value * value, minlength=high - low), float(center @ center)
        square = length - 2 * np.bincount(owner, value * center[back], minlength=high - low) + middle
        first = value[begin[0]:begin[1]]
        if (np.diff(begin) == begin[1]).all() and len(columns) == begin[1] and (value.reshape(high - low, -1) == first).all():
            return columns, center, 0.0, square
        # The sums are wrong by less than 1e-9 of their parts.
        return columns, center, float(np.sqrt(np.max(np.maximum(square, 0) + 1e-9 * (length + middle)))), square

    def _split(self, low: int, high: int, distance: np.ndarray) -> int:
        """Orders the documents by which of two far ones they are nearer to; the place of the middle."""
        begin, term, value = self._rows(low, high)
        owner = np.repeat(np.arange(high - low), np.diff(begin))

        def products(row: int) -> np.ndarray:
            one = np.zeros(len(self.items.one))
            one[term[begin[row]:begin[row + 1]]] = value[begin[row]:begin[row + 1]]
            return np.bincount(owner, value * one[term], minlength=high - low)

        length = np.bincount(owner, value * value, minlength=high - low)
        a = int(distance.argmax())
        from_a = products(a)
        b = int((length - 2 * from_a).argmax())
        side = products(b) - from_a
        by = np.argsort(side, kind="stable")
        size = np.diff(begin)[by]
        at = np.repeat(begin[:-1][by] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        s = slice(self.begin[low], self.begin[high])
        self.term[s], self.value[s] = self.term[s][at], self.value[s][at]
        self.begin[low + 1:high + 1] = self.begin[low] + np.cumsum(size)
        self.order[low:high] = self.order[low:high][by]
        return (low + high) // 2

    def _bounds(self, seen: list, centers: list, reach: list) -> np.ndarray:
        """A row per node, a column per item: no document of the node scores more."""
        items, found = self.items, np.zeros((len(seen), len(self.items.ids)))
        owner = np.repeat(np.arange(len(items.ids)), np.diff(items.begin))
        for i, (columns, center, radius) in enumerate(zip(seen, centers, reach, strict=True)):
            dense, here = np.zeros(len(items.one)), np.zeros(len(items.one))
            dense[columns], here[columns] = center, 1
            near = np.bincount(owner, dense[items.term], minlength=len(items.ids))
            shared = np.bincount(owner, here[items.term], minlength=len(items.ids))
            found[i] = (near + np.sqrt(shared) * radius) * (1 + 1e-9) + 1
        return found

    def scores(self, node: int, item: int) -> np.ndarray:
        """The exact scores of a node's documents, in the block's order."""
        low, high = self.nodes[node].low, self.nodes[node].high
        if node not in self.known:
            begin = self.begin[low:high + 1] - self.begin[low]
            s = slice(self.begin[low], self.begin[high])
            columns, back = np.unique(self.term[s], return_inverse=True)
            table = np.zeros((len(columns), high - low), np.int64)
            table[back, np.repeat(np.arange(high - low), np.diff(begin))] = self.value[s]
            self.known[node] = columns, table
        columns, table = self.known[node]
        wanted = self.items.term[self.items.begin[item]:self.items.begin[item + 1]]
        if not len(columns):
            return np.zeros(high - low, np.int64)
        at = np.minimum(np.searchsorted(columns, wanted), len(columns) - 1)
        return table[at[columns[at] == wanted]].sum(axis=0)

    def search(self, item: int, best: list, top: int, ids: np.ndarray) -> int:
        """Adds to `best`, a heap of (score, -id or so) of at most `top`; how many documents were scored."""
        scored, heap = 0, [(-self.bounds[0, item], 0)]
        while heap:
            bound, at = heapq.heappop(heap)
            # Equal scores go by doc_id, so only what is surely lower can be left out.
            if len(best) == top and -bound < best[0][0]:
                break
            node = self.nodes[at]
            if node.children:
                for child in node.children:
                    heapq.heappush(heap, (-self.bounds[child, item], child))
                continue
            score = self.scores(at, item)
            scored += len(score)
            least = best[0][0] if len(best) == top else 1
            for i in np.flatnonzero(score >= max(least, 1)):
                entry = (int(score[i]), -int(ids[self.order[node.low + i]]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


# Stands for a null doc_id, which ranks after all others of its score.
_NO_ID = (1 << 63) - 1


def _searched(items: Items, weight: np.ndarray, documents: int, terms: int, top: int):
    """Each item's best documents of the task."""
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items.ids]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                lot = batch.slice(at, BLOCK)
                listed = lot.column(2)
                size = listed.value_lengths().to_numpy()
                term, tf = listed.flatten().to_numpy().astype(np.int64), lot.column(3).flatten().to_numpy().astype(np.int64)
                n = np.repeat(lot.column(1).to_numpy(), size)
                block = Block(np.concatenate([[0], np.cumsum(size)]), term, entries(weight[term], tf, n, documents, terms), items)
                ids = lot.column(0).fill_null(_NO_ID).to_numpy()
                for item in range(len(items.ids)):
                    block.search(item, best[item], top, ids)
        rows = [(i, -doc, score) for i, found in enumerate(best) for score, doc in found]
        item, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array([None if d == _NO_ID else d for d in doc], pa.int64()), pa.array(score, pa.int64())],
            ["item", "doc_id", "score"])

    return searched


def _numbered(items: DataFrame) -> DataFrame:
    """The items with the lot each is searched for in; a lot holds about ITEM_BYTES."""
    size = F.octet_length(text_or_empty()).cast("long")
    total = items.agg(F.sum(size)).first()[0] or 0
    return items.select("item_id", text_or_empty().alias("text")).withColumn(
        "lot", F.pmod(F.xxhash64("item_id", "text"), F.lit(1 + total // ITEM_BYTES)))


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` best documents that score above 0.

    Every row of `items` is asked for, rows that repeat repeat their answers; of a repeated item_id
    each text is ranked on its own.  Null texts have no terms, so such items have no rows and such
    documents are never found.  Rows of `docs` that repeat are documents of their own; equal scores
    rank by doc_id, null ones last.  Other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    numbered = _numbered(items)
    found = None
    for (lot,) in numbered.select("lot").distinct().orderBy("lot").collect():
        # One lot's items at a time: bounded, and sent along with the tasks.
        asked = numbered.filter(F.col("lot") == lot).select("item_id", "text").collect()
        part = _ranked(source, Items.of([r[0] for r in asked], [r[1] for r in asked]), items.schema["item_id"].dataType, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found


def _ranked(source: DataFrame, items: Items, kind, top: int) -> DataFrame:
    spark = source.sparkSession
    index = written(source.mapInArrow(_indexed(items), "doc_id long, n long, term array<int>, tf array<int>"), "search-index")
    documents, terms = index.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # A row per term of the lot's items at most.
    counts = index.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(len(items.one), np.int64)
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    near = index.filter(F.size("term") > 0).mapInArrow(
        _searched(items, term_weights(documents, df), documents, terms, top), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = spark.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {kind.simpleString()}")
    return best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def oracle() -> str:
    """The same in DuckDB's SQL."""
    terms = ("unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
             " '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))")
    return f"""
    WITH words AS (SELECT doc_id, {terms} AS term FROM documents),
    asked AS (SELECT DISTINCT item_id, {terms} AS term FROM benchmark),
    long AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
    sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM long),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
               FROM tf, sums GROUP BY term, docs),
    part AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS s
             FROM tf JOIN weight USING (term) JOIN long USING (doc_id), sums),
    score AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM asked JOIN part USING (term) GROUP BY ALL HAVING sum(s) > 0),
    ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                      doc_id, score FROM score)
    SELECT * FROM ranked WHERE rank <= {TOP}"""
