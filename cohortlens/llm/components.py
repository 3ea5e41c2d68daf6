"""Connected components of a links table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut


def _smaller_first(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return _smaller_first(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    low = cut(links.groupBy("u").agg(F.min("v").alias("m")))
    near = links.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _smaller_first(near.union(low.select("u", F.col("m").alias("v"))))


def components(links: DataFrame) -> DataFrame:
    """(u, v): each linked node and the smallest node of its component (that node itself is not a
    row). ``links`` has two comparable columns u and v; direction and repeats do not matter.

    Each round works on the links by joins and partial aggregates alone; a node that many links
    share is pre-aggregated, and the minima are a table of their own, so that Spark can split the
    inner joins back to them.
    """
    now, mark = cut(_smaller_first(links)), None
    while True:
        now = cut(_small_star(_large_star(now)))
        got = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(got) == mark:
            return now
        mark = tuple(got)
