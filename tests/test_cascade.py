"""Invariants of the O1 cascade on the box fixture (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from footlink.functions.lists import to_array
from footlink.plans import catalog as C
from footlink.plans import jobs as JB
from footlink.sources import boxes as BX
from footlink.sources import fixtures as FX


@pytest.fixture(scope="module")
def run(spark):
    R, B = C._pools(spark, SF_SMALL)
    links = BX.registry_rows(spark, SF_SMALL).select("cleabs", "liens_vers_batiment")
    out, res = JB.job_registry_change(R, links, B, FX.AS_OF)
    return R, B, links, out, res


def test_claims_are_exclusive_across_stages(run):
    _, _, _, _, res = run
    x = res.claims
    r_first = (x.filter((F.col("identifiant_rnb") != "") & (F.col("stage") < 7))
               .groupBy("identifiant_rnb").agg(F.count("*").alias("n")))
    assert r_first.filter("n > 1").count() == 0            # an R id is claimed once before the balcony stage
    b = x.select("stage", F.explode(to_array("liens_vers_batiment")).alias("b")).filter("b != ''")
    # a B key may be claimed by several R rows in one stage, never in two stages
    assert b.groupBy("b").agg(F.countDistinct("stage").alias("k")).filter("k > 1").count() == 0


def test_pools_end_smaller_and_disjoint_from_claims(run):
    R, B, _, _, res = run
    assert res.pools.R.count() < R.count() and res.pools.B.count() < B.count()
    claimed_r = res.claims.filter((F.col("identifiant_rnb") != "") & (F.col("stage") < 7)).select("identifiant_rnb")
    assert res.pools.R.join(claimed_r, "identifiant_rnb", "left_semi").count() == 0


def test_merge_keeps_existing_links(run):
    _, _, links, out, res = run
    treated = (res.pools.RT.filter(F.col("traitement") != FX.LABELS["far_r"]).select("cleabs").distinct())
    old = (links.join(treated, "cleabs", "left_semi").filter(F.col("liens_vers_batiment").isNotNull())
           .select("cleabs", F.explode(F.split("liens_vers_batiment", "/")).alias("lien")))
    merged = out.select("cleabs", F.explode(F.split("liens_vers_batiment", "/")).alias("lien"))
    assert old.join(merged, ["cleabs", "lien"], "left_anti").count() == 0
    assert out.filter(F.col("traitement").contains(FX.LABELS["far_r"])).count() == 0


def test_compat_buffer_excludes_the_annulus(spark):
    import math
    from footlink.functions import geometry as G
    R = spark.createDataFrame([("L1", "R1", 0.0, 0.0)], "cleabs string, identifiant_rnb string, x double, y double")
    R = R.select("cleabs", "identifiant_rnb", G.point("x", "y").alias("geometrie"))

    def tiny(angle_deg, r0, r1):
        a = math.radians(angle_deg)
        ux, uy, vx, vy = math.cos(a), math.sin(a), -math.sin(a), math.cos(a)
        pts = [(r0, -0.05), (r1, -0.05), (r1, 0.05), (r0, 0.05)]
        xy = [(p * ux + q * vx, p * uy + q * vy) for p, q in pts]
        return "POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in xy + xy[:1]) + "))"

    rows = [("B_vertex", tiny(0.0, 99.8, 99.95)), ("B_edge", tiny(5.625, 99.8, 99.95)),
            ("B_far", tiny(5.625, 100.2, 100.4)), ("B_near", tiny(5.625, 90, 91))]
    B = spark.createDataFrame(rows, "cleabs string, w string").select(
        "cleabs", G.from_wkt("w").alias("geometrie"), F.lit(False).alias("gcms_detruit"))
    B = G.with_measures(B, "geometrie")
    plain = {r.cleabs for r in JB.near_registry_points(R, B, 100.0).collect()}
    compat = {r.cleabs for r in JB.near_registry_points(R, B, 100.0, compat_buffer=True).collect()}
    assert plain == {"B_vertex", "B_edge", "B_near"}
    assert compat == {"B_vertex", "B_near"}
