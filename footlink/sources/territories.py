"""Territory table (S5) and the territory lookup join.

Each territory is a box in its own projected system; the lookup tests a
lon/lat point against the box's four corners transformed to lon/lat (the
edges stay straight between transformed corners, as the source's
``ST_Transform`` of a 5-vertex polygon does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.functions import crs
from footlink.functions.geometry import point_distance

# The territory seed rows (name, code, department, SRID and
# the projected box xmin, ymin, xmax, ymax).
TERRITORIES = [
    ("Guyane", "GUF", "973", 2972, -100000, 100000, 500000, 700000),
    ("la Réunion", "REU", "974", 2975, 300000, 7620000, 390000, 7710000),
    ("Saint-Pierre-et-Miquelon", "SPM", "975", 4467, 530000, 5160000, 580000, 5240000),
    ("Mayotte", "MYT", "976", 4471, 490000, 8550000, 540000, 8620000),
    ("Guadeloupe", "GLP", "971", 5490, 470000, 1730000, 730000, 2020000),
    ("Martinique", "MTQ", "972", 5490, 680000, 1580000, 750000, 1660000),
    ("Bassas da India", "BAS", "984", 7074, 550000, 7600000, 600000, 7650000),
    ("Île Europa", "EUR", "984", 7074, 620000, 7500000, 670000, 7550000),
    ("Îles Glorieuses", "GLO", "984", 32738, 730000, 8700000, 780000, 8750000),
    ("Île Juan de Nova", "JUA", "984", 32738, 230000, 8090000, 280000, 8140000),
    ("Île Tromelin", "TRO", "984", 32740, 210000, 8220000, 260000, 8270000),
    ("Archipel de Crozet", "CRO", "984", 7076, 400000, 4800000, 700000, 5000000),
    ("Îles Saint-Paul et Amsterdam", "SPA", "984", 7080, 600000, 5600000, 800000, 5900000),
    ("Métropole", "FXX", "FXX", 2154, 60000, 6010000, 1270000, 7180000),
]


_CACHE: dict[str, DataFrame] = {}


def territories(spark: SparkSession) -> DataFrame:
    """The 14 literal rows, with projection constants and the lon/lat
    quadrilateral (``quad``) and its bbox. Built once per application and
    cached (14 rows; rebuilt from the literals if a cached block is lost)."""
    app = spark.sparkContext.applicationId
    if app not in _CACHE:
        _CACHE[app] = _build(spark).cache()
    return _CACHE[app]


def _build(spark: SparkSession) -> DataFrame:
    t = spark.createDataFrame(TERRITORIES, ["nom", "code", "dep", "srid", "bx0", "by0", "bx1", "by1"])
    t = t.join(crs.projection_table(spark), "srid")
    corners = [("bx0", "by0"), ("bx1", "by0"), ("bx1", "by1"), ("bx0", "by1"), ("bx0", "by0")]
    pts = []
    for cx, cy in corners:
        lon, lat = crs.inverse(F.col(cx).cast("double"), F.col(cy).cast("double"))
        pts.append(F.struct(lon.alias("x"), lat.alias("y")))
    t = t.withColumn("quad", F.array(F.array(F.array(*pts))))
    xs = F.transform(F.col("quad")[0][0], lambda p: p["x"])
    ys = F.transform(F.col("quad")[0][0], lambda p: p["y"])
    return (t.withColumn("qx0", F.array_min(xs)).withColumn("qx1", F.array_max(xs))
             .withColumn("qy0", F.array_min(ys)).withColumn("qy1", F.array_max(ys)))


def locate(df: DataFrame, point: str, terr: DataFrame) -> DataFrame:
    """Inner join of lon/lat points with the territories that contain
    them (boundary included). A point in no territory vanishes; a point in
    two fans out. The territory side is 14 literal rows — a proven bound —
    so it is broadcast and the big side is streamed once."""
    px, py = F.col(point)["x"], F.col(point)["y"]
    cond = ((px >= F.col("qx0")) & (px <= F.col("qx1")) & (py >= F.col("qy0")) & (py <= F.col("qy1"))
            & (point_distance(px, py, F.col("quad")) == 0))
    return df.join(F.broadcast(terr), cond, "inner")
