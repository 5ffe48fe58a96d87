"""Steps that must not cost more than once a row, and generated code that the
JVM still compiles."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.functions.edges import edges
from footlink.operators import spatial


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _squares(spark, prefix, shift):
    rows = spark.createDataFrame([(1, f"POLYGON(({shift} 0, {shift + 4} 0, {shift + 4} 4, {shift} 4, {shift} 0))")], "k int, t string")
    return spatial.side(G.with_measures(rows.select("k", G.from_wkt("t").alias("g")), "g"), prefix, "k")


def test_text_is_made_once_and_rings_turned_once(spark):
    rows = spark.createDataFrame([("0 0",)], "c string")
    text = F.concat(F.lit("POLYGON((0 0, 1 0, 1 1, "), "c", F.lit("))MARK"))
    assert _plan(rows.select(G.from_wkt(text).alias("g"))).count("MARK") == 1
    g = spark.createDataFrame([(None,)], f"g {G.GEOM_T}")
    assert _plan(g.select(edges("g").alias("e"))).count("reverse(") == 1
    assert _plan(g.select(G.point_distance(F.lit(0.0), F.lit(0.0), F.col("g")).alias("d"))).count("SQRT") == 1


def test_edge_measures_stay_below_what_the_jvm_compiles(spark):
    left, right = _squares(spark, "l_", 0), _squares(spark, "r_", 3)
    m = spatial.pair_measures(spatial.candidate_pairs(left, right), left, right,
                              ["hits", "inter", "dist", "contact"], ["l_id", "r_id"])
    row = m.collect()[0]
    assert (row.hits, row.inter, row.dist, row.contact) == (True, 4.0, 0.0, True)
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            m.select("*").explain(mode="codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    sizes = [int(v) for v in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000, sizes


def test_upright_edges_far_from_each_other_share_no_area(spark):
    thin = "POLYGON((0 0, 1e-160 0, 1e-160 1e10, 0 1e10, 0 0))"
    rows = spark.createDataFrame([(1, thin, "POLYGON((5e9 0, 6e9 0, 6e9 4, 5e9 4, 5e9 0))")], "k int, a string, b string")
    got = G.with_measures(G.with_measures(rows.select("k", G.from_wkt("a").alias("a"), G.from_wkt("b").alias("b")), "a", "l_"), "b", "r_")
    assert spatial.edge_measures(got, ["inter", "hits"], ["k"]).collect()[0][1:] == (0.0, False)
