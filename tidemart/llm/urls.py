"""URL filters: fixed rules first, then a tree of path templates per host.

Going down segment by segment, a branch becomes a wildcard where its segment is variable (it holds
a digit, or is rare among many siblings) or where its labelled purity does not differ from that of
its siblings by a two-proportion test.  A template is rejected when its share of good labels,
smoothed towards its host's and that towards the whole table's, is too low.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import written

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
WIDE = 16
RARE = 0.02
Z = 2.0
PRIOR = 10.0
LEAST_PURITY = 0.7

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    none = F.lit(None).cast("string")
    rule, verdict = none, none
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame) -> DataFrame:
    """host, path, template from host, path, n (pages), k (labelled), g (good): a row per distinct path.

    Goes down to the deepest path there is.  Empty segments don't count.  A level has the paths that
    reach it only, so the work is in proportion to all segments.
    """
    rows = paths.withColumns({"segments": F.filter(F.split("path", "/"), lambda s: s != ""), "template": F.lit("")})
    level, done = 0, []
    while True:
        # What ends here is named; the others go on.
        done.append(rows.filter(F.size("segments") <= level).drop("segments"))
        rows = rows.filter(F.size("segments") > level)
        if rows.isEmpty():
            break
        rows = rows.withColumn("segment", F.get("segments", F.lit(level)))
        children = rows.groupBy("host", "template", "segment").agg(
            *[F.sum(c).alias(c) for c in "nkg"])
        nodes = children.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("kinds"), *[F.sum(c).alias(f"{c}_all") for c in "nkg"])
        k, g = F.col("k").cast("double"), F.col("g").cast("double")
        k_rest, g_rest = F.col("k_all") - k, F.col("g_all") - g
        pooled = F.try_divide(F.col("g_all").cast("double"), F.col("k_all").cast("double"))
        # Too few labels on either side tell no difference.
        differs = F.coalesce((k > 0) & (k_rest > 0) & (
            F.pow(F.try_divide(g, k) - F.try_divide(g_rest, k_rest), F.lit(2)) >
            Z * Z * pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), k) + F.try_divide(F.lit(1.0), k_rest))), F.lit(False))
        rare = (F.col("kinds") > WIDE) & (F.col("n") < RARE * F.col("n_all"))
        named = (children.join(nodes, ["host", "template"])
                 .withColumn("step", F.when(F.col("segment").rlike("[0-9]") | rare | ~differs, "*")
                             .otherwise(F.col("segment")))
                 .select("host", "template", "segment", "step"))
        rows = written(rows.join(named, ["host", "template", "segment"])
                       .withColumn("template", F.concat("template", F.lit("/"), "step")).drop("segment", "step"), "templates")
        level += 1
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return named


def judged(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
           least: float = LEAST_PURITY) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: a row for every row of `pages`.

    labels: page_id, good (0 or 1); the share of good ones is a template's purity, and pages without
    a label, or with a null one, just count.  A page labelled twice counts each label.  A url that
    is null or has no `://` has an empty host and path; it and other pathless urls have the template
    "".  Verdicts are the longest fitting rule's, else `block` where purity is below `least`.
    Repeated rows repeat.  No labels at all: purity is 1, nothing is blocked but by rules.
    """
    pages = pages.select("page_id", host_of(F.col("url").cast("string")).alias("host"),
                         path_of(F.col("url").cast("string")).alias("path"))
    marks = (labels.filter(F.col("good").isNotNull()).groupBy("page_id")
             .agg(F.count(F.lit(1)).alias("k"), F.sum("good").alias("g")))
    paths = written(
        pages.join(marks, "page_id", "left").groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"),
             F.coalesce(F.sum("g"), F.lit(0)).alias("g")), "paths")
    named = written(templates(paths), "named-paths")
    k_all, g_all = paths.agg(F.sum("k"), F.sum("g")).first()
    base = g_all / k_all if k_all else 1.0
    sums = [F.sum(c).alias(c) for c in "kg"]
    smooth = lambda g, k, prior: (F.col(g) + PRIOR * prior) / (F.col(k) + PRIOR)
    leaves = named.groupBy("host", "template").agg(*sums)
    hosts = leaves.groupBy("host").agg(*sums).select("host", smooth("g", "k", F.lit(base)).alias("prior"))
    purity = leaves.join(hosts, "host").select(
        "host", "template", smooth("g", "k", F.col("prior")).alias("purity"))
    verdicts = named.select("host", "path", "template").join(purity, ["host", "template"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (pages.join(verdicts, ["host", "path"]).withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("purity") < least, "block").otherwise("allow")))
            .select("page_id", "host", "path", "rule", "verdict", "template", "purity"))


def oracle() -> str:
    """The same in DuckDB's SQL, over pages and labels, with this module's parameters."""
    fits = "\n".join(
        f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{start}') THEN '{{{i}}}'"
        for i, (name, start) in enumerate(
            (r[1].partition("/")[0], r[1].partition("/")[2]) for r in sorted(RULES, key=lambda r: -len(r[1]))))
    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    return f"""
    WITH RECURSIVE cut AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    marks AS (SELECT doc_id AS page_id, count(*) AS k, sum(quality) AS g FROM labels
              WHERE quality IS NOT NULL GROUP BY 1),
    parts AS (SELECT host, path, count(*) AS n, coalesce(sum(k), 0)::DOUBLE AS k, coalesce(sum(g), 0)::DOUBLE AS g,
                     list_filter(string_split(path, '/'), lambda s: s <> '') AS segments
              FROM cut LEFT JOIN marks USING (page_id) GROUP BY host, path),
    walked AS (
        SELECT host, path, n, k, g, segments, '' AS template, 0 AS level FROM parts
        UNION ALL
        SELECT host, path, n, k, g, segments, template || '/' || CASE
                   WHEN regexp_matches(segment, '[0-9]') OR kinds > {WIDE} AND n_one < {RARE} * n_all
                        OR NOT coalesce(k_one > 0 AND k_all - k_one > 0
                               AND pow(g_one / k_one - (g_all - g_one) / (k_all - k_one), 2) >
                                   {Z * Z} * (g_all / k_all) * (1 - g_all / k_all) * (1 / k_one + 1 / (k_all - k_one)), false)
                   THEN '*' ELSE segment END, level + 1
        FROM (SELECT *, sum(CASE WHEN lead THEN 1 ELSE 0 END) OVER node AS kinds
              FROM (SELECT *, row_number() OVER (PARTITION BY host, template, segment ORDER BY path) = 1 AS lead,
                           sum(n) OVER one AS n_one, sum(k) OVER one AS k_one, sum(g) OVER one AS g_one,
                           sum(n) OVER every AS n_all, sum(k) OVER every AS k_all, sum(g) OVER every AS g_all
                    FROM (SELECT *, segments[level + 1] AS segment FROM walked WHERE len(segments) > level)
                    WINDOW one AS (PARTITION BY host, template, segment), every AS (PARTITION BY host, template))
              WINDOW node AS (PARTITION BY host, template))),
    leaves AS (SELECT * FROM walked WHERE level = len(segments)),
    base AS (SELECT coalesce(sum(g) / sum(k), 1.0) AS rate FROM parts),
    leaf AS (SELECT host, template, sum(k) AS k, sum(g) AS g FROM leaves GROUP BY ALL),
    prior AS (SELECT host, (sum(g) + {PRIOR} * (SELECT rate FROM base)) / (sum(k) + {PRIOR}) AS prior
              FROM leaf GROUP BY host),
    pure AS (SELECT host, template, (g + {PRIOR} * prior) / (k + {PRIOR}) AS purity FROM leaf JOIN prior USING (host)),
    ruled AS (SELECT *, CASE {fits.format(*(r[1] for r in ordered))} END AS rule,
                     CASE {fits.format(*(r[0] for r in ordered))} END AS said FROM cut)
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN purity < {LEAST_PURITY} THEN 'block' ELSE 'allow' END)
           AS verdict, template, round(purity, 6) AS purity
    FROM ruled JOIN leaves USING (host, path) JOIN pure USING (host, template)"""
