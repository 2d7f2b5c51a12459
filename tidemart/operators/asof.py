"""As-of joins: each event with the version of its key that was in force at the event's place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.session import stored

# Rows of one key that are ordered in one task.
PART_ROWS = 100_000


def _pane(place: str, width: int) -> Column:
    return F.call_function("div", F.col(place) - F.pmod(F.col(place), F.lit(width)), F.lit(width))


def pane_width(rows: DataFrame, keys: Sequence[str], most: int = PART_ROWS) -> int | None:
    """A width of panes of ``_place`` in which no key has over ``most`` rows; None if no key has
    over ``most`` rows at all.  A single place is not cut."""
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), (F.max("_place") - F.min("_place")).alias("span"))
    largest = per_key.agg(F.max_by(F.struct("n", "span"), "n")).first()[0]
    if largest is None or largest.n <= most:
        return None
    width = max(1, largest.span)
    fullest = largest.n
    # Places of a feed are about even, so that one round is the rule; uneven ones take a few.
    while fullest > most and width > 1:
        width = max(1, min(width // 2, width * most // (2 * fullest)))
        fullest = rows.groupBy(*keys, _pane("_place", width)).count().agg(F.max("count")).first()[0]
    return width


def as_of_join(events: DataFrame, versions: DataFrame, keys: Sequence[str], place: str,
               seq: str = "seq", into: str = "version", width: int | None = None,
               most: int = PART_ROWS) -> DataFrame:
    """``events`` with a struct ``into``: of the versions of the event's key the last whose ``seq``
    is not after the event's ``place``, with all its columns but the keys.  Null where there is
    none, and for events without key or place.

    ``seq`` and ``place`` are long numbers on one scale; a key has one version per ``seq`` (of
    more, any).  Events and versions are ordered together and each event takes over the last version
    seen, so work grows with their number and not with that of pairs, however often a key changes.  The events'
    distinct places are what is ordered; the events themselves are joined by place afterwards and
    spread also where one key has most of them.  A key with over ``most`` places is cut into panes, and
    only the last version of each pane is carried on to the next ones.
    """
    keys = list(keys)
    rest = [name for name in versions.columns if name not in keys]
    told = versions.filter(F.col(seq).isNotNull()).select(
        *keys, F.col(seq).cast("bigint").alias("_place"), F.struct(*rest).alias("_version"))
    told = told.dropna(subset=keys)
    asked = events.select(*keys, F.col(place).cast("bigint").alias("_place")).dropna().distinct()
    both = told.unionByName(asked.withColumn("_version", F.lit(None).cast(told.schema["_version"].dataType)))
    if width is None:
        # Looked at for the width, once a round, and for the answers: distinct places are worked out once.
        both = stored(both, "as-of-places")
        width = pane_width(both.select(*keys, "_place"), keys, most)

    # At one place the version comes first.
    order = ["_place", F.col("_version").isNull()]
    if width is None:
        so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        ran = both.withColumn(into, F.last("_version", ignorenulls=True).over(so_far))
    else:
        paned = both.withColumn("_pane", _pane("_place", width))
        inside = Window.partitionBy(*keys, "_pane").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        before = Window.partitionBy(*keys).orderBy("_pane").rowsBetween(Window.unboundedPreceding, -1)
        ends = paned.groupBy(*keys, "_pane").agg(
            F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_place"))).alias("_end"))
        carried = ends.select(*keys, "_pane", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
        ran = (paned.withColumn("_own", F.last("_version", ignorenulls=True).over(inside))
               .join(carried, [*keys, "_pane"])
               .withColumn(into, F.coalesce("_own", "_carried")))
    answers = ran.filter(F.col("_version").isNull() & F.col(into).isNotNull()).select(
        *[F.col(name).alias("_key_" + name) for name in keys], "_place", into)
    same = F.col(place) == F.col("_place")
    for name in keys:
        same = same & (F.col(name) == F.col("_key_" + name))
    return events.join(answers, same, "left").select(*events.columns, into)
