"""Documents with every awkward case, and the registered queries over the small tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

_WORDS = "alpha beta gamma delta omega sigma river stone cloud paper green seven".split()


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(_WORDS) + str(draw.randrange(400)) for _ in range(n))


LONG = words(1, 20_000)


def awkward() -> list[tuple]:
    """Nulls anywhere, empty and very long texts, ties, repeated rows, near and exact copies."""
    base, other = words(2, 120), words(3, 80)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", None), (3, " ".join(near), None, "a"),
        (4, None, "en", "a"), (5, "", "en", "b"), (6, "   \n\t ", None, None),
        (7, other, "fr", "b"), (7, other, "fr", "b"), (8, "single", "fr", "b"), (9, "single", None, "é"),
        (None, other, "fr", "b"), (None, words(4, 50), None, None), (10, LONG, "en", "a"),
        (11, "é" * 300, "fr", "b"), (12, "x" * 1000, "en", ""), (13, words(5, 30), "en", "a")]
    rows += [(100 + i, other + " tail" * i, "en", "hot") for i in range(12)]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def docs(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else [
        (*r, "en", "s", 0) if len(r) == 2 else r for r in rows], SCHEMA)


#: Names that operators use inside.
CLASHES = ("size", "rank", "print", "shard", "slot", "h", "key", "n", "name", "word", "c", "chunk", "bucket",
           "id", "found", "data", "block", "row", "_doc", "_id", "_print", "_key", "_times", "repeats", "target",
           "cluster", "component", "signature", "held_out", "spans", "base", "src", "linked", "all", "members")


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def plain(df, key=lambda r: str(r)):
    return sorted((tuple(r) for r in df.collect()), key=key)
