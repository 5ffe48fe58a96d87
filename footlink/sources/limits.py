"""Lots of ``part`` 3 km apart, each with up to three registry points and one
building whose gap to the first point is just within or just beyond 100 m or
500 m, beside an edge or a corner (see FIXTURES.md, B1). Buildings of case 8
reach over two lots, 6 km long and exactly 100 m away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.sources.boxes import _num, _rect
from footlink.sources.fixtures import table

#: (right, up) of the building's lower left corner from the first point, by case.
GAPS = [(99.5, -2.0), (100.5, -2.0), (59.5, 80.0), (60.5, 80.0), (499.5, -2.0),
        (500.5, -2.0), (299.5, 400.0), (300.5, 400.0), (100.0, -3.0), (60.0, 80.0)]


def _lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("k"), (k % 10).cast("int").alias("c"), (F.lit(3000.0) * (k % 100)).alias("x"),
        (F.lit(3000.0) * F.floor(k / 100)).alias("y"), (F.lit(8.0) + k % 7).alias("w"))


def registry_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = _lots(spark, sf_dir).withColumn("j", F.explode(F.sequence(F.lit(0), (F.col("k") % 3).cast("int"))))
    at = F.concat(F.lit("POINT("), _num(F.col("x") - 40.0 * F.col("j")), F.lit(" "), _num(F.col("y") - 30.0 * F.col("j")), F.lit(")"))
    return lots.select(F.concat(F.lit("L"), F.col("k"), F.lit("_"), F.col("j")).alias("cleabs"),
                       G.read_point(at).alias("geometrie"), F.lit(False).alias("gcms_detruit"))


def topo_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in GAPS])[F.col("c")]
    x0, y0 = F.col("x") + gaps[0], F.col("y") + gaps[1]
    x1 = x0 + F.when(F.col("c") == 8, F.lit(6000.0)).otherwise(F.col("w"))
    text = F.concat(F.lit("POLYGON"), _rect(x0, y0, x1, y0 + 6.0))
    b = _lots(spark, sf_dir).select(F.concat(F.lit("B"), F.col("k")).alias("cleabs"), text.alias("t"))
    return G.with_measures(b.select("cleabs", G.from_wkt("t").alias("geometrie"), F.lit(False).alias("gcms_detruit")), "geometrie")
