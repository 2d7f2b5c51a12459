"""Exact dedup by block naming, and removal of repeated passages."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.compare import connect, difference
from tests.llm.cases import FOLDER, awkward, clashing, docs, plain, words
from tidemart.llm import blocks, queries, suffixes


def groups(rows):
    by = {}
    for i, text in rows:
        by.setdefault(text or "", []).append(i)
    found = []
    for i, text in rows:
        ids = by[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        found.append((i, keep, len(ids), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("size", [16, 4096])
def test_block_naming_on_awkward_rows(spark, size):
    rows = [(r[0], r[1]) for r in awkward()]
    assert plain(blocks.exact_duplicates(clashing(docs(spark)), size)) == groups(rows)


def test_hot_blocks_are_salted_and_found_again(spark, monkeypatch):
    monkeypatch.setattr(blocks, "HOT_ROWS", 5)
    rows = [(i, words(1, 9) if i % 3 else words(i, 9)) for i in range(90)]
    assert plain(blocks.exact_duplicates(docs(spark, rows), 32)) == groups(rows)


def test_exact_query_agrees_with_sql(spark):
    assert difference(queries.op10_exact_dedup(spark, FOLDER), connect(FOLDER),
                      queries.statements()["op10_exact_dedup"]) is None


def test_no_documents(spark):
    none = docs(spark, [])
    assert blocks.exact_duplicates(none).count() == 0
    assert suffixes.without_repeats(none).count() == 0


def removed(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j:j + length] for _, b in data for j in range(len(b) - length + 1))
    found = []
    for i, b in data:
        gone = np.zeros(len(b) + 2, bool)
        for j in range(len(b) - length + 1):
            if seen[b[j:j + length]] > 1:
                gone[j + 1:j + 1 + length] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        found.append((i, len(b), len(b) - len(rest), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(rest).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("length", [40, 200])
def test_passages_against_brute_force(spark, length, monkeypatch):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 20_000)
    monkeypatch.setattr(suffixes, "LOT_BYTES", 30_000)
    passage = words(77, 40)
    rows = [(r[0], r[1]) for r in awkward()] + [
        (200, words(8, 30) + passage + words(9, 3)), (201, passage), (202, passage[3:] + words(10, 20) + passage[:-5]),
        (203, "ab" * 400), (204, "\x00" * 500), (205, "a" + "\x00" * 260), (206, words(11, 3) + "é" * 150)]
    result = suffixes.without_repeats(clashing(docs(spark, rows)), length).drop("spans", "text")
    assert plain(result) == removed(rows, length)


def test_rows_that_share_an_id_keep_their_own_passages(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 20_000)
    monkeypatch.setattr(suffixes, "LOT_BYTES", 3_000)
    passages = [words(60 + i, 60) for i in range(3)]
    rows = [(i % 2 and None or 7, p + words(300 + 10 * k + i, 60)) for k, p in enumerate(passages) for i in range(4)]
    rows += [(None, words(400 + i, 150)) for i in range(8)] + [(7, words(420 + i, 150)) for i in range(8)]
    rows += [(None, words(440, 90))] * 9 + [(7, words(441, 90))] * 2
    assert plain(suffixes.without_repeats(docs(spark, rows)).drop("spans", "text")) == removed(rows, 200)


@pytest.mark.parametrize("phrase", [100, 199, 320])
def test_a_phrase_of_every_document_lies_in_many_ranges(spark, monkeypatch, phrase):
    """Ranges end inside its grams, and strings around it are found again across their ends."""
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 4_000)
    monkeypatch.setattr(suffixes, "LOT_BYTES", 1_500)
    monkeypatch.setattr(suffixes, "HASHED_ROWS", 3)
    common = words(500, 60)[:phrase]
    # Pairs and triples share what stands on one side of the phrase, or some of it.
    rows = [(i, words(600 + i % 67, 12)[i % 3:] + common + words(700 + i % 71, 12)[:-1 - i % 2]) for i in range(200)]
    cut = suffixes.splitters(docs(spark, rows).select("text"), 200, 40)
    keys = np.array([list(c.ljust(cut.dtype.itemsize, b"\0")) for c in cut], np.uint8)
    shared = [suffixes.shared_with_splitters(keys[i:i + 1, :200], i, cut)[0] for i in range(1, len(cut))]
    assert len(cut) > 20 and sum(x >= suffixes.GRAM for x in shared) > 3
    assert plain(suffixes.without_repeats(docs(spark, rows)).drop("spans", "text")) == removed(rows, 200)


def test_passage_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert plain(queries.op1_suffix_dedup(spark, FOLDER)) == removed(rows, 200)


def test_what_is_left_is_returned(spark):
    rows = [(1, "start " + words(5, 60)), (2, words(5, 60) + " end")]
    left = {r.doc_id: bytes(r.text).decode() for r in suffixes.without_repeats(docs(spark, rows), with_text=True).collect()}
    assert left == {1: "start ", 2: " end"}


def test_multikey_order_is_the_sorted_order():
    rows = np.random.default_rng(1).integers(0, 2, (300, 21), np.uint8)
    order, common = suffixes.multikey_order(rows)
    texts = [bytes(rows[i]) for i in order]
    assert texts == sorted(texts)
    for i in range(1, 300):
        same = next((j for j in range(21) if texts[i][j] != texts[i - 1][j]), 21)
        assert common[i] == same
