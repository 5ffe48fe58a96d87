"""Connected components of a link table, by alternating large-star and
small-star rounds (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014) until every link points at a root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.llm.frames import cut_lineage


def _down(links: DataFrame) -> DataFrame:
    return (links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of longs -> (id, component), component being the smallest
    id reachable; ids without a link are not listed. Each round is one
    min-aggregate and one join per star, written to the checkpoint folder."""
    star = cut_lineage(_down(links))
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _down(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _down(large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(low2.select("a", F.col("m").alias("b"))))
        star = cut_lineage(small)
        parents = star.select(F.col("b").alias("a")).distinct()
        if star.join(parents, "a", "left_semi").isEmpty():
            break
    return (star.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(star.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct())
