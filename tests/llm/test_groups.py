"""Near duplicates, components, benchmark matches and URL filters."""

import random
from itertools import combinations

import numpy as np
import pytest

from tests.compare import connect, difference
from tests.llm.cases import FOLDER, awkward, clashing, docs, plain, words
from tidemart.llm import decontamination, graph, neardup, queries, urls


def near_groups(rows, k):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.setdefault(i, []).append(
            {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations([(i, s) for i, many in sets.items() for s in many if i is not None], 2):
        shared = len(a[1] & b[1])
        if shared and 100 * shared >= 80 * len(a[1] | b[1]):
            x, y = sorted((find(a[0]), find(b[0])))
            root[y] = x
    return sets, find


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_on_awkward_rows(spark, k):
    rows = [(r[0], r[1]) for r in awkward() if r[0] is not None]
    sets, find = near_groups(rows, k)
    found = neardup.near_duplicates(clashing(docs(spark)), words=k).filter("doc_id IS NOT NULL")
    assert plain(found) == sorted(
        ((i, len(s), find(i), find(i) == i) for i, t in rows for s in [sets[i][0]]), key=str)


def test_row_without_id_joins_its_class(spark):
    text = words(3, 80)
    found = neardup.near_duplicates(docs(spark, [(7, text), (None, text), (None, "alone here now"), (8, None)]), words=2)
    assert {(r.doc_id, r.component_id, r.kept) for r in found.collect()} == {
        (7, 7, True), (None, 7, False), (None, None, True), (8, 8, True)}


def test_near_duplicates_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    sets, find = near_groups(rows, 2)
    assert plain(queries.op8_near_dedup(spark, FOLDER)) == sorted(
        ((i, len(sets[i][0]), find(i), find(i) == i) for i, _ in rows), key=str)


def test_regions_too_large_are_cut_deeper(spark):
    draw = random.Random(5)
    base = words(6, 200).split()
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(3):
            own[draw.randrange(200)] = f"new{draw.random()}"
        rows.append((i, " ".join(own)))
    _, find = near_groups(rows, 2)
    found = neardup.near_duplicates(docs(spark, rows), words=2, region=10)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: find(i) for i, _ in rows}


def test_groups_are_exact_within_a_cluster():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.choice(40, 30)).astype(np.uint64) for _ in range(60)]
    near = neardup.linked_groups(sets, 80)
    root = list(range(60))
    for _ in range(60):
        for i, j in combinations(range(60), 2):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                root[i] = root[j] = min(root[i], root[j])
    assert near == root


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    edges = spark.createDataFrame([*path, *star, (200, 200), (300, 301), (301, 300)], "a long, b long")
    found = {r.node: r.root for r in graph.components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {300: 300, 301: 300}
    assert graph.components(edges.limit(0)).count() == 0


def distance(item, text):
    """Least edits between the item and any passage of the text, row by row."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


def test_edit_matches_against_brute_force(spark):
    draw = random.Random(3)
    items = [(i, words(i, 8).upper() if i % 2 else words(i, 8)) for i in range(6)]
    items += [(90, None), (91, ""), (92, "short"), (None, words(99, 8)), (93, items[0][1])]
    texts = []
    for i in range(40):
        passage = list(items[draw.randrange(6)][1])
        for _ in range(draw.randrange(8)):
            at = draw.randrange(len(passage))
            passage[at:at + draw.randrange(2)] = draw.choice(["", "q", "zz"])
        texts.append((i, words(1000 + i, 12) + "\n" + "".join(passage) + " " + words(2000 + i, draw.randrange(9))))
    texts += [(50, None), (51, ""), (None, items[1][1]), (52, items[2][1]), (52, items[2][1]), (53, items[3][1].replace(" ", "\n"))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.benchmark_matches(clashing(docs(spark, texts)), benchmark)
    fold = lambda t: decontamination.fold(t.encode())
    wanted = sorted(((i, k, d) for i, t in texts if t for k, item in items if k is not None and item and len(item) >= 24
                     for d in [distance(fold(item), fold(t))] if d <= len(item) * decontamination.ERROR_RATE), key=str)
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in found.collect()), key=str) == wanted
    # In lots of one item each, and as a filter that keeps clean rows with all columns.
    lots = decontamination.benchmark_matches(docs(spark, texts), benchmark, lot_chars=50)
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in lots.collect()), key=str) == wanted
    bad = {i for i, _, _ in wanted}
    kept = decontamination.decontaminated(clashing(docs(spark, texts)), benchmark)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in texts if i not in bad)
    assert kept.columns == clashing(docs(spark)).columns


def test_no_items_and_no_documents(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.benchmark_matches(docs(spark), items).count() == 0
    assert decontamination.decontaminated(docs(spark), items).count() == len(awkward())
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


def test_matches_end_where_the_passage_ends(spark):
    item = words(4, 10)
    text = "é" * 30 + item + " and on"
    found = decontamination.benchmark_matches(
        docs(spark, [(1, text)]), spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert [tuple(r) for r in found] == [(1, 5, 30 + len(item), 0)]


def test_url_query_agrees_with_sql(spark):
    assert difference(queries.op2_url_filters(spark, FOLDER), connect(FOLDER), urls.oracle()) is None


def test_rules_hosts_and_paths(spark):
    pages = spark.createDataFrame([
        (1, "http://A.Example.ORG/es/1?x#y"), (2, "https://example.org/en/12"), (3, "https://x.org/de/1"), (4, "x.org/de/1"),
        (5, None), (6, "http://b.com/fr/"), (7, "http://b.com/de/x"), (8, "http://notorg/es/"), (9, "http://x.org"),
        (10, "http://x.org?a=/de/"), (11, "ftp://b.COM:80/de/"), (12, ""), (None, "http://x.org/"), (1, "http://A.Example.ORG/es/1?x#y")],
        "page_id long, url string")
    found = urls.judged(clashing(pages), spark.createDataFrame([], "page_id long, good int"))
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=str)
    assert got == sorted([
        (1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "x.org", "/de/1", "org/", "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "b.com", "/fr/", "com/fr/", "allow"), (7, "b.com", "/de/x", "com/de/", "block"), (8, "notorg", "/es/", None, "allow"),
        (9, "x.org", "", None, "allow"), (10, "x.org", "", None, "allow"), (11, "b.com:80", "/de/", None, "allow"),
        (12, "", "", None, "allow"), (None, "x.org", "/", "org/", "allow"), (1, "a.example.org", "/es/1", "example.org/es/", "block")], key=str)
    assert urls.judged(pages.limit(0), spark.createDataFrame([], "page_id long, good int")).count() == 0


def test_a_bad_branch_keeps_its_name_and_is_rejected(spark):
    rows = [(i, f"http://shop.net/{'spam' if i % 4 == 0 else 'goods'}/{i}") for i in range(400)]
    rows += [(1000 + i, f"http://deep.net/a/b/c/d/e/{i}") for i in range(3)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 2)] + [(3, None)], "page_id long, good int")
    found = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    by = {(r.template, r.verdict) for r in found}
    assert ("/spam/*", "block") in by and ("/goods/*", "allow") in by
    assert {r.template for r in found if r.page_id >= 1000} == {"/*/*/*/*/*/*"}


def test_rows_that_share_an_id_or_have_none(spark):
    t, u, v = words(61, 40), words(62, 40), words(63, 40)
    def left(rows):
        return sorted(((r.doc_id, r.text) for r in neardup.first_of_groups(clashing(docs(spark, rows))).collect()), key=str)
    assert left([(3, t), (7, t), (7, u)]) == [(3, t), (7, u)]
    assert left([(7, t), (None, t), (None, t)]) == [(7, t)]
    assert left([(None, t), (None, t), (None, u), (None, ""), (None, None)]) == sorted(
        [(None, min(t, t)), (None, u), (None, ""), (None, None)], key=str)
    assert left([(5, v), (5, v), (5, v), (1, "")]) == [(1, ""), (5, v)]
    assert left([]) == []
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(spark, [(3, t), (7, t), (7, u + " more")])).collect()}
    assert found == {(3, 36, 3), (7, 36, 3), (7, 37, 7)}


def test_a_bad_branch_far_below(spark):
    """All levels are judged, down to the deepest path."""
    rows = [(i, f"http://h.net/a/b/c/d/e/{'spam' if i % 4 == 0 else 'news'}/page-{i}/{'x/' * (i % 3)}") for i in range(400)]
    rows += [(1000, "http://h.net/a/b/c/d/e/spam/" + "deep/" * 40), (1001, "http://h.net"), (1002, None)]
    marks = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "page_id long, good int")
    found = {r.page_id: (r.verdict, r.template) for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string"), marks).collect()}
    assert all(found[i][0] == ("allow" if i % 4 else "block") for i in range(400))
    assert found[4][1] == "/*/*/*/*/*/spam/*/*" and found[1001] == ("allow", "") and len(found) == 403
