"""Projections: origins map to the false origin; forward/inverse round
trip; territory lookup of known places; precision grid."""

import pytest
from pyspark.sql import functions as F

from footlink.functions import crs
from footlink.sources.territories import locate, territories


def test_origins_and_round_trip(spark):
    pts = spark.createDataFrame([(2154, 3.0, 46.5), (2975, 57.0, 0.0), (2972, -51.0, 0.0), (2154, 2.35, 48.85),
                                 (32740, 54.52, -15.89), (7080, 77.55, -37.83)], "srid int, lon double, lat double")
    df = pts.join(crs.projection_table(spark), "srid")
    x, y = crs.forward(F.col("lon"), F.col("lat"))
    df = df.withColumn("x", x).withColumn("y", y)
    lo, la = crs.inverse("x", "y")
    rows = df.withColumn("lon2", lo).withColumn("lat2", la).collect()
    by = {(r.srid, r.lon): r for r in rows}
    assert (by[(2154, 3.0)].x, by[(2154, 3.0)].y) == (pytest.approx(700000, abs=1e-6), pytest.approx(6600000, abs=1e-6))
    assert (by[(2975, 57.0)].x, by[(2975, 57.0)].y) == (pytest.approx(500000), pytest.approx(10000000))
    assert (by[(2972, -51.0)].x, by[(2972, -51.0)].y) == (pytest.approx(500000), pytest.approx(0, abs=1e-6))
    for r in rows:
        assert r.lon2 == pytest.approx(r.lon, abs=1e-8) and r.lat2 == pytest.approx(r.lat, abs=1e-8)


def test_territory_lookup(spark):
    pts = spark.createDataFrame([("paris", 2.35, 48.85), ("st-denis", 55.45, -20.88), ("cayenne", -52.33, 4.94),
                                 ("sea", -30.0, 40.0)], "name string, lon double, lat double")
    pts = pts.withColumn("p", F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")))
    got = {r.name: r.code for r in locate(pts, "p", territories(spark)).collect()}
    assert got == {"paris": "FXX", "st-denis": "REU", "cayenne": "GUF"}


def test_snap_half_up(spark):
    df = spark.createDataFrame([(1.25,), (1.24,), (-1.25,)], "v double")
    got = [round(r.s, 6) for r in df.select(crs.snap(F.col("v"), 0.1).alias("s")).collect()]
    assert got == [1.3, 1.2, -1.2]


def test_point_in_two_territories_fans_out(spark):
    terr = territories(spark)
    twin = terr.filter("code = 'FXX'").withColumn("code", F.lit("FXX2"))
    pts = spark.createDataFrame([("paris", 2.35, 48.85)], "name string, lon double, lat double")
    pts = pts.withColumn("p", F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")))
    got = sorted(r.code for r in locate(pts, "p", terr.unionByName(twin)).collect())
    assert got == ["FXX", "FXX2"]


def test_moved_flag_null_old_shape_is_blank(spark):
    from footlink.functions.geometry import box
    from footlink.operators.localise import moved_flag
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "cleabs string, k int")
    df = (df.withColumn("new", box(F.lit(0), F.lit(0), F.lit(10), F.lit(10)))
            .withColumn("old", F.when(F.col("k") == 1, box(F.lit(0.5), F.lit(0), F.lit(10.5), F.lit(10)))
                                .when(F.col("k") == 2, box(F.lit(30), F.lit(0), F.lit(40), F.lit(10)))))
    got = {r.cleabs: r.commentaire_centralise for r in moved_flag(df, ["cleabs"], "new", "old").collect()}
    assert got == {"a": "", "b": "to_link", "c": ""}
