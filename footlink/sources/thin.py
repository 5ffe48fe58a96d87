"""Fixture of shapes that are thinner than the 0.1 m grid in places, from
``part``: a box of ``w`` x ``h`` metres a lot, its corners off the grid by less
than half a step, changed by ``k % 8``:

0 nothing; 1 a spike of 2 m on the top side; 2 a slit of 2 m into it;
3 a second part 0.03 m wide; 4 two rooms joined by a neck 0.04 m high;
5 a hole 0.04 m wide and one of 2 m x 2 m; 6 a notch whose tip ends 0.03 m over the
bottom side; 7 two parts 0.03 m apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.sources.fixtures import table


def thin_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, geometrie)."""
    k = F.col("p_partkey")
    lots = table(spark, sf_dir, "part").select(
        k.alias("k"), (F.lit(64.0) * (k % 100)).alias("x0"), (F.lit(64.0) * F.floor(k / 100)).alias("y0"),
        (F.lit(8.0) + k % 7).alias("w"), (F.lit(6.0) + F.col("p_size") % 9).alias("h"))
    w, h = F.col("w"), F.col("h")

    def ring(*points):
        at = [F.concat_ws(" ", (F.col("x0") + x).cast("string"), (F.col("y0") + y).cast("string"))
              for x, y in [*points, points[0]]]
        return F.concat(F.lit("("), F.concat_ws(", ", *at), F.lit(")"))

    def multi(*polygons):
        return F.concat(F.lit("MULTIPOLYGON("), F.concat_ws(", ", *[
            F.concat(F.lit("("), F.concat_ws(", ", *p), F.lit(")")) for p in polygons]), F.lit(")"))

    low = [(0.03, -0.02), (w + 0.04, 0.01)]
    top = [(w - 0.02, h + 0.03), (-0.04, h - 0.01)]
    box = ring(*low, *top)
    notched = lambda tip, half: ring(*low, top[0], (half[0], h), tip, (half[1], h), top[1])
    c = F.col("k") % 8
    wkt = (F.when(c == 0, multi([box]))
           .when(c == 1, multi([notched((3.01, h + 2), (3.03, 2.98))]))
           .when(c == 2, multi([notched((3.01, h - 2), (3.03, 2.98))]))
           .when(c == 3, multi([box], [ring((20.01, 0), (20.04, 0), (20.04, 3), (20.01, 3))]))
           .when(c == 4, multi([ring((0, 0), (4, 0), (4, 1.98), (8, 1.98), (8, 0), (12, 0), (12, 4), (8, 4), (8, 2.02),
                                     (4, 2.02), (4, 4), (0, 4))]))
           .when(c == 5, multi([box, ring((2.98, 2), (2.98, 4), (3.02, 4), (3.02, 2)),
                                ring((5.02, 2.04), (5.01, 3.98), (6.97, 4.03), (7.04, 1.96))]))
           .when(c == 6, multi([notched((4, 0.03), (5, 3))]))
           .otherwise(multi([ring((0, 0), (4, 0), (4, 5), (0, 5))], [ring((4.03, 0), (9, 0), (9, 5), (4.03, 5))])))
    return lots.select("k", G.from_wkt(wkt).alias("geometrie"))
