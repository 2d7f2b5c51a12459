"""Quality by a factorisation machine, phrases by dynamic counting, ranked search by ball trees."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import FOLDER, awkward, clashing, docs, plain
from tidemart.llm import bytewords, phrases, quality, queries, search
from tidemart.llm.common import read


def test_words_and_hashes_against_plain_ones():
    texts = ["", "One two\tone", "é  É x", "\n\n", "a" * 3000, "one"]
    hasher = bytewords.Hasher()
    seen = {}
    for lot in bytewords.lots(pa.array(texts)):
        words = bytewords.words_of(lot, bytewords.byte_set((9, 13), (32, 32)))
        for lane in range(2):
            hashes = hasher(lot.data, words.start, words.end, lane)
            for text, a, b, h in zip(words.text, words.start, words.end, hashes, strict=True):
                seen.setdefault((lane, bytes(lot.data[a:b])), set()).add(int(h))
                assert bytes(lot.data[a:b]).decode() in re.sub("[A-Z]", lambda m: m[0].lower(), texts[lot.first + text])
    assert {w for _, w in seen} == {b"one", b"two", "é".encode(), "É".encode(), b"x", b"a" * 3000}
    for lane in range(2):
        own = [x for (k, _), x in seen.items() if k == lane]
        assert all(len(x) == 1 for x in own) and len(set().union(*own)) == len(own)


def test_pairs_of_equal_first_hashes_are_told_apart():
    one, two = np.array([5, 5, 7, 5, 5], np.uint64), np.array([1, 2, 1, 1, 2], np.uint64)
    place, times = bytewords.counted(one, two)
    assert sorted((int(one[p]), int(two[p]), int(t)) for p, t in zip(place, times, strict=True)) == [(5, 1, 2), (5, 2, 2), (7, 1, 1)]


# Quality ------------------------------------------------------------------------------------


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_sum_of_squares_is_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    machine = quality.Machine(0.3, draw.normal(size=20), draw.normal(size=(20, 4)))
    rows = quality.Rows(np.array([0, 3]), np.array([1, 5, 7, 2, 5, 9, 19]), draw.random(7).astype(np.float32))
    for at, (a, b) in enumerate([(0, 3), (3, 7)]):
        f, x = rows.feature[a:b], rows.value[a:b].astype(float)
        pairs = sum(x[i] * x[j] * machine.factors[f[i]] @ machine.factors[f[j]] for i, j in itertools.combinations(range(b - a), 2))
        assert math.isclose(machine.margins(rows)[at], 0.3 + machine.weight[f] @ x + pairs, rel_tol=1e-9)


def test_quality_learns_what_only_a_pair_tells():
    """Label 1 if exactly one of two words stands there: no sum of weights tells that."""
    begin, feature, label = np.arange(0, 1600, 2), [], []
    for i in range(800):
        a, b = i % 2, i // 2 % 2
        feature += [a, 2 + b]
        label.append(float(a != b))
    rows = quality.Rows(begin, np.array(feature), np.ones(1600, np.float32))
    margins = quality.fitted(rows, np.array(label), 4, epochs=20).margins(rows)
    assert ((margins > 0) == (np.array(label) > 0)).all()


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op11_quality(spark, folder).toPandas()
    known = read(spark, folder, "labels").toPandas()
    both = found.merge(known, on="doc_id")
    both = both[both.held_out]
    assert len(found) == 10_000 and (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    good, bad = both[both.quality == 1].score.to_numpy(), both[both.quality == 0].score.to_numpy()
    area = (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()
    assert area > 0.95 and (both.predicted == both.quality).mean() > 0.93
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()


def test_quality_query_against_plain_scores(spark):
    """The query's scores from its own machine, pair by pair, over features counted one by one."""
    source = read(spark, FOLDER, "documents")
    machine = quality.fit(source, read(spark, FOLDER, "labels"))
    features = quality.Features(1)
    found = {r.doc_id: r.score for r in queries.op11_quality(spark, FOLDER).collect()}
    hasher = bytewords.Hasher()
    for r in source.limit(12).collect():
        lot = next(bytewords.lots(pa.array([r.text or ""])))
        raw = np.frombuffer((r.text or "").encode() + b"\n", np.uint8)
        rows = features(lot, raw, [quality.of_size(np.array([r.n_chars]))])
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        counts = Counter()
        for w in words:
            data = np.frombuffer(w.encode(), np.uint8)
            counts[int(hasher(data, np.array([0]), np.array([len(data)]))[0]) >> 48] += 1
        hashed = {f: x for f, x in zip(rows.feature.tolist(), rows.value.tolist(), strict=True) if f < quality.WORDS}
        norm = math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values()))
        assert hashed.keys() == counts.keys()
        assert all(math.isclose(hashed[f], math.log1p(c) / norm, rel_tol=1e-5) for f, c in counts.items())
        v = machine.factors[rows.feature] * rows.value[:, None].astype(float)
        gram = v @ v.T
        margin = machine.bias + machine.weight[rows.feature] @ rows.value.astype(float) + (gram.sum() - np.trace(gram)) / 2
        assert abs(found[r.doc_id] - 1 / (1 + math.exp(-margin))) < 1e-4


def test_quality_of_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward()]
    marks = labels(spark, [(i, i % 2, 0) for i in range(1, 14)] + [(1, None, 0), (None, 1, 0), (999, 1, 1), (2, 1, 0), (2, 1, 0)])
    source = clashing(docs(spark, rows))
    found = quality.score(source, quality.fit(source, marks)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    assert len({r.score for r in found if r.doc_id == 7}) == 1
    assert not any(r.held_out for r in found if r.doc_id is None)
    again = quality.score(source.repartition(7), quality.fit(source.repartition(5), marks))
    assert plain(again) == sorted((tuple(r) for r in found), key=str)
    none = quality.fit(docs(spark, []), marks)
    assert quality.score(docs(spark, []), none).count() == 0
    assert {r.score for r in quality.score(source, quality.fit(source, labels(spark, []))).collect()} == {0.5}
    learned = [i for i in (1, 2, 3, 4, 5, 6, 8, 9) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    single = quality.fit(source, labels(spark, [(i, 1, 0) for i in learned]))
    assert {r.score for r in quality.score(source, single).collect()} == {0.75}


def test_quality_is_fitted_on_a_bounded_sample(spark):
    source = docs(spark, [(1, f"word{i}") for i in range(300)] + [(3, "other")])
    marks = labels(spark, [(1, 1, 0), (3, 0, 0), (1, 1, 0)])
    machine = quality.fit(source, marks, sample=50)
    # At most 50 rows of the 601: the bias starts from their share.
    assert abs(machine.bias) < math.log(51) + 1


# Phrases ------------------------------------------------------------------------------------


def plain_phrases(rows, least, longest, top, absorb=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if any(len(q) > len(p) and x == lang and 100 * b >= absorb * a and b >= least and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (x, q), b in f.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        found.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out, rank = [], Counter()
    for lang, score, a, p, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_phrases_against_brute_force(spark, seed):
    draw = random.Random(seed)
    vocabulary = ["Wind", "fall", "é", "of", "a", "a", "b\tc", "x."]
    rows = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(30))) + draw.choice(["", ", new york city hall\n", "! A a A a"]),
             draw.choice(["en", "fr", None]), "s", 0) for i in range(90)]
    rows += [rows[0]] * 3 + [(None, None, "en", "s", 0), (900, "", None, "s", 0), (901, "new york " * 500, "de", "s", 0)]
    for shards, least in ((1, 5), (3, 9)):
        found = phrases.collocations(clashing(docs(spark, rows)), least, 4, 25, shards=shards)
        assert plain(found) == sorted(plain_phrases([r[1:3] for r in rows], least, 4, 25), key=str)


def test_phrases_with_few_slots_are_the_same(spark):
    """Phrases that share slots are counted in vain, but counts stay those of one full cycle."""
    source = read(spark, FOLDER, "documents")
    wide, narrow = (phrases.frequent_phrases(source, 20, 4, 3, size) for size in (1 << 20, 64))
    assert plain(wide) == plain(narrow)


def test_a_task_hands_on_a_phrase_once():
    # Over four lots of text in three batches; words by several blanks and tabs.
    text = "one  two\tthree four. " * 60_000
    batches = [pa.RecordBatch.from_arrays([pa.array([text]), pa.array([lang])], ["text", "lang"]) for lang in ("a", "b", "a")]
    slots = np.concatenate([x.column(0).to_numpy() for x in phrases._slots(1 << 20)(iter([pa.RecordBatch.from_arrays(
        [pa.array(["one", "two", "three"]), pa.array(["a"] * 3), pa.array([1] * 3, pa.int32())], ["phrase", "lang", "n"])]))])
    rows = pa.Table.from_batches(phrases._scan(1, 4, 3, 1 << 20, slots, np.ones(3, np.uint8))(iter(batches))).to_pylist()
    found = {(r["lang"], r["phrase"]): r["c"] for r in rows}
    assert len(found) == len(rows)
    wanted = {(lang, word): n for lang, n in (("a", 120_000), ("b", 60_000)) for word in ("one", "two", "three", "four")}
    wanted |= {("a", ""): 480_000, ("b", ""): 240_000, ("a", "one two"): 120_000, ("a", "two three"): 120_000}
    assert found == wanted


def test_phrases_beyond_64_bits(spark):
    """Scores are exact where a * n and l * r pass 64 bits."""
    a, n, left, right = 4_000_000_007, 9_000_000_000_000_003, 5_000_000_011, 6_000_000_013
    row = spark.sql(f"SELECT (cast(1000 * {a}L AS decimal(19, 0)) * cast({n}L AS decimal(19, 0))) div "
                    f"(cast({left}L AS decimal(19, 0)) * cast({right}L AS decimal(19, 0))) AS s").first()
    assert row.s == 1000 * a * n // (left * right)


def test_no_phrases(spark):
    assert phrases.collocations(docs(spark, [])).count() == 0
    assert phrases.collocations(docs(spark, [(1, None), (2, ""), (3, "?!")])).count() == 0


# Ranked search ------------------------------------------------------------------------------


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranks(rows, items, top=10):
    counts = [(i, Counter(terms_of(t))) for i, t in rows]
    documents, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in counts:
            n = sum(c.values())
            score = 0
            for t in set(terms_of(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * documents // total)))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(found)[:top], 1)]
    return out


def test_search_against_brute_force(spark):
    draw = random.Random(13)
    words = ["River", "stone", "élan", "x1", "the", "of", "a-b", "cloud's", "ß"]
    rows = [(i % 150, " ".join(draw.choice(words) + (str(draw.randrange(30)) if draw.random() < 0.5 else "") for _ in range(draw.randrange(60))))
            for i in range(400)] + [(r[0], r[1]) for r in awkward()]
    items = [(1, "river stone7 the"), (2, None), (3, "ß élan x1 a b cloud s"), (4, "nowhere"), (1, "of"), (5, " ".join(words * 3)), (6, ""), (None, "stone"), (7, words[0])]
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = search.ranked_documents(clashing(docs(spark, rows)), clashing(asked))
    assert plain(found) == sorted(plain_ranks(rows, items), key=str)
    few = search.ranked_documents(docs(spark, rows).repartition(9), asked, top=3)
    assert plain(few) == sorted(plain_ranks(rows, items, 3), key=str)


def test_search_in_lots_of_items(spark, monkeypatch):
    rows = [(i, f"alpha beta{i % 7} gamma{i % 3} " * (i % 5)) for i in range(80)]
    items = [(i, f"beta{i} gamma{i % 4} alpha") for i in range(9)]
    monkeypatch.setattr(search, "ITEM_BYTES", 60)
    found = search.ranked_documents(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert plain(found) == sorted(plain_ranks(rows, items), key=str)


def test_search_without_documents_or_items(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.ranked_documents(docs(spark, []), items).count() == 0
    assert search.ranked_documents(docs(spark), items.limit(0)).count() == 0
    assert search.ranked_documents(docs(spark, [(1, None), (2, "?")]), items).count() == 0


def test_bounds_hold_and_prune():
    """No document passes its nodes' bounds, and a search among groups of likes opens a few of the leaves."""
    draw = np.random.default_rng(3)
    names = [[f"t{g}x{i}" for i in range(12)] for g in range(16)]
    items = search.Items.of(list(range(16)), [" ".join(n[:6]) for n in names])
    size = draw.integers(3, 7, 512)
    group = np.arange(512) % 16
    place = [sorted(draw.choice(items.term[items.begin[g]:items.begin[g + 1]], n - 1 if n > 6 else n, replace=False)) for g, n in zip(group, np.minimum(size, 6), strict=True)]
    begin = np.concatenate([[0], np.cumsum([len(p) for p in place])])
    term = np.concatenate(place)
    value = draw.integers(1, 50, len(term)) * 10**8 + draw.integers(0, 9, len(term))
    plain_rows = [dict(zip(p, value[a:b].tolist(), strict=True)) for p, a, b in zip(place, begin[:-1], begin[1:], strict=True)]
    block = search.Block(begin.copy(), term.copy(), value.copy(), items, leaf=8)
    scored = 0
    for item in range(16):
        wanted = items.term[items.begin[item]:items.begin[item + 1]].tolist()
        exact = np.array([sum(r.get(t, 0) for t in wanted) for r in plain_rows])
        for at, node in enumerate(block.nodes):
            own = exact[block.order[node.low:node.high]]
            assert (block.scores(at, item) == own).all() and own.max() <= block.bounds[at, item]
        best = []
        scored += block.search(item, best, 5, np.arange(512))
        assert sorted((-s, -i) for s, i in best) == sorted((-int(s), i) for i, s in enumerate(exact))[:5]
    assert scored < 16 * 512 / 3
