"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import ranked, seeded, text_or_empty, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
# The dynamic program works on budgets up to this; a larger rest is first brought below it.
FIT_WORDS = 1 << 16
SEED = 20


def fit_counts(sizes: Sequence[int], counts: Sequence[int], budget: int, fit_words: int = FIT_WORDS) -> list[int]:
    """How many documents of each size to take, so that their words come as near to `budget` as can be.

    Every size first gives its share of the budget, rounded down.  Documents of the largest fitting
    sizes bring the rest below `fit_words`; a bounded knapsack over the counts left fits it: bit b
    of a set of sums says that b words can be reached.  Of two sums as near the lower is taken.
    """
    total = sum(s * c for s, c in zip(sizes, counts, strict=True))
    if budget >= total:
        return list(counts)
    take = [c * budget // total for c in counts]
    rest = budget - sum(s * t for s, t in zip(sizes, take, strict=True))
    largest_first = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    for i in largest_first:
        if rest <= fit_words or not sizes[i]:
            break
        more = min(counts[i] - take[i], (rest - fit_words + sizes[i] - 1) // sizes[i], rest // sizes[i])
        take[i] += more
        rest -= more * sizes[i]
    mask, sums, steps = (1 << (2 * rest + 1)) - 1, 1, []
    for i in largest_first:
        left, lot = counts[i] - take[i], 1
        while left and sizes[i] and lot * sizes[i] <= 2 * rest and not sums >> rest & 1:
            lot = min(lot, left)
            steps.append((i, lot, sums))
            sums |= sums << (lot * sizes[i]) & mask
            left -= lot
            lot *= 2
    below = (sums & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = sums >> rest
    over = (above & -above).bit_length() - 1
    at = rest + over if above and over < rest - below else below
    for i, lot, earlier in reversed(steps):
        if not earlier >> at & 1:
            take[i] += lot
            at -= lot * sizes[i]
    return take


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """src, source_size, target: a row per source (`src` is null-safe text, null sources come last).

    Sources in code point order take the weights in turn.  A target over `most` times its source's
    size stops there, and what is over is shared anew by weight among the others.  One row per
    source is ranked in one task; documents never are.
    """
    per = sizes.groupBy("src").agg(F.sum("size").cast("long").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy("src")) - 1) % len(weights) + 1
    per = written(per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")))
                  .withColumn("top", F.col("source_size") * most), "sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = 0.0, -1
    while True:
        over = F.col("w") * share > F.col("top") if stopped >= 0 else F.lit(False)
        n, fixed, open_ = per.agg(
            F.sum(over.cast("int")), F.coalesce(F.sum(F.when(over, F.col("top"))), F.lit(0)),
            F.sum(F.when(~over, F.col("w")))).first()
        if not n and stopped >= 0 or n == stopped or not open_:
            break
        share, stopped = (total - fixed) / open_, n
    return per.select("src", "source_size",
                      F.least(F.col("w") * share, F.col("top").cast("double")).alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS,
             seed: int = SEED) -> DataFrame:
    """doc_id, print, size, source_size, target, repeats, taken: a row for every row of `docs`.

    A source is taken whole as often as its target holds it; the remaining budget is fitted over
    the histogram of exact document sizes, and of each size the documents first in a seeded order
    are taken once more.  Documents without words or text have size 0 and repeat as their source's
    whole passes say; a source without words has target 0.  Null sources are one source, the last.
    Rows alike in doc_id and text may swap places.  Only doc_id, text and source are read.
    """
    # Texts are read and counted once; all that follows looks at this narrow table.
    sized = written(docs.select(
        "doc_id", seeded(seed, "doc_id", "text").alias("print"),
        F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"),
                 F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("src"),
        word_count(text_or_empty()).alias("size")), "sizes")
    targets = source_targets(sized, weights, most)
    histogram = sized.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n"))

    def fit(source: pd.DataFrame) -> pd.DataFrame:
        source = source.sort_values("size")
        size, target = int(source.source_size.iloc[0]), float(source.target.iloc[0])
        whole = min(int(target // size), most) if size else 0
        budget = round(target) - whole * size if whole < most else 0
        chosen = fit_counts(source["size"].tolist(), source.n.tolist(), budget) if budget > 0 else 0
        return source.assign(whole=whole, chosen=chosen)[
            ["src", "size", "source_size", "target", "whole", "chosen"]]

    # One row per distinct document size of a source: d sizes need over d * d / 2 words.
    fitted = written(histogram.join(targets, "src").groupBy("src").applyInPandas(
        fit, "src string, size long, source_size long, target double, whole long, chosen long"), "fitted")
    return (ranked(sized, ["src", "size"], "print", ["doc_id"], "rank").join(fitted, ["src", "size"])
            .withColumn("repeats", F.col("whole") + (F.col("rank") < F.col("chosen")).cast("long"))
            .withColumn("taken", F.col("repeats") * F.col("size"))
            .select("doc_id", "print", "size", "source_size", "target", "repeats", "taken"))


def mixture(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS,
            seed: int = SEED) -> DataFrame:
    """The mixed corpus: each row of `docs`, all columns, as often as the plan takes it."""
    plan = (mix_plan(docs, weights, most, seed).groupBy("doc_id", "print")
            .agg(F.sum("repeats").alias("repeats"), F.count(F.lit(1)).alias("alike"))
            .filter("repeats > 0")
            .select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "repeats", "alike"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       seeded(seed, "doc_id", "text").alias("_key"))
    alike = Window.partitionBy("_id", "_print").orderBy("_print")
    return (rows.join(plan, F.col("_doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_print")))
            .withColumn("_times", F.expr("repeats div alike") +
                        (F.row_number().over(alike) <= F.col("repeats") % F.col("alike")).cast("long"))
            .filter("_times > 0").withColumn("_copy", F.explode(F.expr("sequence(1L, _times)")))
            .select("_doc.*"))
