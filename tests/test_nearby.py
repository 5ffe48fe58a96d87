"""M13-M15 by cell summaries against plain geometry."""

import math
import random

import pytest
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.plans import jobs as JB


def _building(rng, big):
    x, y, r = rng.uniform(-2000, 2000), rng.uniform(-2000, 2000), rng.uniform(4, 30) * (60 if big else 1)
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 7)))
    pts = [(x + r * math.cos(a), y + r * math.sin(a)) for a in angles]
    return pts + pts[:1]


def _dist(p, ring):
    def seg(a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(a[0] + t * dx - p[0], a[1] + t * dy - p[1])
    pairs = list(zip(ring, ring[1:]))
    odd = sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in pairs) % 2
    return 0.0 if odd else min(seg(a, b) for a, b in pairs)


def _frames(spark, points, rings):
    R = (spark.createDataFrame(points, "cleabs string, x double, y double")
         .select("cleabs", F.when(F.col("x").isNotNull(), G.point("x", "y")).alias("geometrie"), F.lit(False).alias("gcms_detruit")))
    text = [(i, "POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))") for i, ring in rings]
    B = spark.createDataFrame(text, "cleabs string, t string").select(
        "cleabs", G.from_wkt("t").alias("geometrie"), F.lit(False).alias("gcms_detruit"))
    return R, G.with_measures(B, "geometrie")


def test_both_sides_against_all_pairs(spark):
    rng = random.Random(5)
    rings = [(f"B{i}", _building(rng, i % 20 == 0)) for i in range(60)]
    # lone points, a crowd on one spot, a crowd in one cell; a point without coordinates
    points = [(f"P{i}", rng.uniform(-2500, 2500), rng.uniform(-2500, 2500)) for i in range(60)]
    points += [(f"S{i}", 1500.0, -700.0) for i in range(50)]
    points += [(f"C{i}", -800 + rng.uniform(0, 40), 900 + rng.uniform(0, 40)) for i in range(80)]
    points += [("none", None, None)]
    near = {(p, b) for p, x, y in points if x is not None for b, ring in rings if _dist((x, y), ring) <= 100}
    assert 0 < len({b for _, b in near}) < 60 and 0 < len({p for p, _ in near}) < 190
    R, B = _frames(spark, points, rings)
    assert [r.cleabs for r in JB.near_registry_points(R, B, 100.0).orderBy("cleabs").collect()] == sorted({b for _, b in near})
    assert [r.cleabs for r in JB.registry_near_buildings(R, B, 100.0).orderBy("cleabs").collect()] == sorted({p for p, _ in near})


def test_a_crowd_is_settled_by_its_cell(spark):
    """A spot that any number of points share leaves nothing to compare point
    by point, even on the limit's own ring."""
    points = [(f"S{i}", 0.0, 0.0) for i in range(3000)]
    box = lambda x: [(x, -5.0), (x + 9, -5.0), (x + 9, 5.0), (x, 5.0), (x, -5.0)]
    R, B = _frames(spark, points, [("in", box(99.0)), ("out", box(101.0)), ("far", box(1e5))])
    near, exact = JB._near(R, B, 100.0, False)
    sure, left = near.descend(["b_id"])
    assert left.count() == 0
    assert [r.b_id for _, rows in sure for r in rows.collect()] == ["in"]
    assert {r.b_id for r in near.buildings(exact).collect()} == {"in"}
    assert near.near_points(exact).count() == 3000


def test_empty_sides(spark):
    R, B = _frames(spark, [("P", 0.0, 0.0)], [("B", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)])])
    for r, b in ((R.limit(0), B), (R, B.limit(0)), (R.limit(0), B.limit(0))):
        assert JB.near_registry_points(r, b, 100.0).count() == 0
        assert JB.registry_near_buildings(r, b, 100.0).count() == 0
    with pytest.raises(ValueError):
        JB.near_registry_points(R, B, 0.0)
