"""Connected components of a link table, by rounds of star contraction.

Every round hangs the neighbours of a node on the least of them, first the larger ones, then the
smaller ones, until each component is a star around its least node. Rounds grow with the
logarithm of the component size. A node's neighbours are reduced by aggregates and joins alone,
so a node with very many links is never one task's burden, and every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import staged

MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    least = least.withColumn("least", F.least("least", "node"))
    return (
        both.where("b > a")
        .join(least, F.col("a") == F.col("node"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    hung = down.join(least, F.col("a") == F.col("node")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    return hung.union(least.select("node", "least")).where("a <> b").distinct()


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node it is linked to) of every node with a link.

    ``links`` has columns a and b of one type; loops and repeats do no harm; nulls are dropped.
    """
    now = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    before = _summary(now)
    for _ in range(MOST_ROUNDS):
        now = staged(_small_star(_large_star(now)), "stars")
        after = _summary(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
