"""Exact dedup by deterministic block naming.

Texts are cut into blocks of fixed size.  Sorting the blocks gives each distinct block an integer
name; then adjacent names are paired and the pairs named again, level by level, until one name is
left of each document.  Equal names at equal block counts mean equal bytes: no hash decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import text_or_empty, written

BLOCK_BYTES = 4096
# Blocks that are looked at as hot: a fixed number, so their list is safe to broadcast.
HOT_BLOCKS = 1000
HOT_ROWS = 2000
SALTS = 16


def _sorted_names(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """An integer per distinct key: where it stands among its partition's sorted rows.

    Hash partitioning and the sort are the same in every attempt, so is the name.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartition(parts, *keys).sortWithinPartitions(*keys)
            .withColumn("_at", F.monotonically_increasing_id())
            .withColumn(name, F.min("_at").over(Window.partitionBy(*keys))))


def _first_names(docs: DataFrame, block_bytes: int) -> DataFrame:
    """doc_id, sha, n, idx, name: a row per block.

    A block in very many documents is salted: its salts are named apart, and the few first rows
    of those are named once more and lead to one name.
    """
    data = F.encode(text_or_empty(), "UTF-8")
    blocks = (
        docs.select("doc_id", data.alias("data"), F.unhex(F.sha2(data, 256)).alias("sha"))
        .withColumn("n", F.greatest(F.ceil(F.octet_length("data") / block_bytes), F.lit(1)).cast("int"))
        .select("doc_id", "sha", "n", F.posexplode(F.expr(
            f"transform(sequence(0, n - 1), i -> substring(data, i * {block_bytes} + 1, {block_bytes}))"
        )).alias("idx", "block")))
    hot = F.broadcast(
        blocks.groupBy(F.xxhash64("block").alias("print")).agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "print").limit(HOT_BLOCKS)
        .filter(F.col("rows") > HOT_ROWS).select("print", F.lit(True).alias("hot")))
    salted = (
        blocks.withColumn("print", F.xxhash64("block")).join(hot, "print", "left")
        .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(-1))
        .drop("print"))
    named = written(
        _sorted_names(salted, ["block", "salt"], "name").select(
            "doc_id", "sha", "n", "idx", "name",
            F.when(F.col("hot") & (F.col("_at") == F.col("name")), F.col("block")).alias("hot_block")),
        "block-names")
    one = (named.filter(F.col("hot_block").isNotNull())
           .select("name", F.min("name").over(Window.partitionBy("hot_block")).alias("one")))
    # At most HOT_BLOCKS * SALTS rows.
    return (named.drop("hot_block").join(F.broadcast(one), "name", "left")
            .withColumn("name", F.coalesce("one", "name")).drop("one"))


def block_identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, sha (SHA-256 of the text), n (blocks), name, copies: one row per doc_id and text.

    (n, name) is the text's identity.  Null text counts as empty; a row repeated with the same
    doc_id (null too) and text is counted in `copies`; columns besides doc_id and text are not
    read.  No rows give no rows.
    """
    level = _first_names(docs, block_bytes)
    level = written(
        level.groupBy("doc_id", "sha", "n", "idx", "name").agg(F.count(F.lit(1)).alias("copies")),
        "blocks")
    done = [level.filter("n = 1")]
    open_ = level.filter("n > 1")
    width = open_.agg(F.max("n")).first()[0] or 1
    while width > 1:
        side = lambda odd: F.max(F.when(F.col("idx") % 2 == odd, F.col("name")))
        pairs = written(
            open_.groupBy("doc_id", "sha", "n", F.expr("idx div 2").cast("int").alias("idx")).agg(
                side(0).alias("left"), F.coalesce(side(1), F.lit(-1)).alias("right"),
                F.max(F.when(F.col("idx") == 0, F.col("copies"))).alias("copies")), "pairs")
        names = written(_sorted_names(pairs.select("left", "right").distinct(), ["left", "right"], "name")
                        .select("left", "right", "name"), "pair-names")
        open_ = pairs.join(names, ["left", "right"]).drop("left", "right")
        width = (width + 1) // 2
    done.append(open_)
    columns = ["doc_id", "sha", "n", "name", "copies"]
    return done[0].select(columns).unionByName(done[1].select(columns))


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for every row of `docs`.

    Of equal texts the largest doc_id stays; group_size counts rows.  Rows that repeat doc_id and
    text are all there, with the same values.  A null doc_id never is keep_id unless its group has
    no other; its `kept` is then true.
    """
    ids = block_identities(docs, block_bytes)
    groups = (ids.groupBy("n", "name").agg(F.max("doc_id").alias("keep_id"),
                                           F.sum("copies").alias("group_size"))
              .filter("group_size > 1"))
    return (ids.join(groups, ["n", "name"], "left")
            .withColumn("keep_id", F.coalesce("keep_id", "doc_id"))
            .withColumn("_row", F.explode(F.expr("sequence(1L, copies)")))
            .select("doc_id", "keep_id",
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.expr("doc_id <=> keep_id").alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))
