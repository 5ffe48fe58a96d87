"""Snap rounding gives simple rings on the grid that keep the shape."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.operators.precision import reduce_precision


def snapped(spark, shapes):
    df = spark.createDataFrame(list(enumerate(shapes)), "k long, w string").select("k", G.from_wkt("w").alias("g"))
    out = reduce_precision(df, "g").withColumn("a", G.area("g")).withColumn("w", G.to_wkt("g"))
    return {r.k: r for r in out.collect()}


def rings_of(g):
    return [[(round(p.x * 10), round(p.y * 10)) for p in ring] for poly in g for ring in poly]


def _cross(o, a, b):
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def _meet(p, q, r, s):
    """Do two grid segments share anything but equal end points?"""
    d = [_cross(p, q, r), _cross(p, q, s), _cross(r, s, p), _cross(r, s, q)]
    if d[0] * d[1] < 0 and d[2] * d[3] < 0:
        return True
    inside = lambda a, b, v: _cross(a, b, v) == 0 and v not in (a, b) and min(a, b) <= v <= max(a, b) and (
        min(a[1], b[1]) <= v[1] <= max(a[1], b[1]))
    return inside(p, q, r) or inside(p, q, s) or inside(r, s, p) or inside(r, s, q) or {p, q} == {r, s}


def assert_valid(g):
    edges = []
    for ring in rings_of(g):
        assert ring[0] == ring[-1] and len(set(ring)) == len(ring) - 1 >= 3      # simple
        edges += list(zip(ring[:-1], ring[1:], strict=True))
    for i, (p, q) in enumerate(edges):
        assert not any(_meet(p, q, r, s) for r, s in edges[:i])
    for poly in g:
        turn = [sum(a.x * b.y - b.x * a.y for a, b in zip(r[:-1], r[1:], strict=True)) > 0 for r in poly]
        assert turn == [True] + [False] * (len(poly) - 1)


def wkt(*polys):
    ring = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")"
    return "MULTIPOLYGON(" + ", ".join("(" + ", ".join(ring(r) for r in p) + ")" for p in polys) + ")"


def star(rng, n, radius, cx, cy):
    ang = (np.arange(n) + rng.uniform(0, 0.9, n)) * 2 * np.pi / n
    rad = radius * rng.uniform(0.15, 1, n)
    return [(float(cx + a), float(cy + b)) for a, b in zip(rad * np.cos(ang), rad * np.sin(ang), strict=True)]


def test_random_stars_stay_valid(spark):
    """From a few grid steps to many metres; each ring simple, no two edges
    crossing, area within the grid's reach of the outline."""
    rng = np.random.default_rng(4)
    shapes = [star(rng, int(rng.integers(3, 24)), r, 650000 + 7 * i, 6860000.0) for i, r in enumerate(
        np.repeat([0.1, 0.3, 0.6, 1.5, 8.0], 16))]
    got = snapped(spark, [wkt([s]) for s in shapes])
    for k, s in enumerate(shapes):
        assert_valid(got[k].g)
        p = np.array([*s, s[0]]) - s[0]
        area = abs(np.sum(p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1])) / 2
        around = np.hypot(*np.diff(p, axis=0).T).sum()
        assert abs((got[k].a or 0) - area) <= 0.0708 * around + 0.02
    assert sum(len(r.g) > 1 for r in got.values()) > 3 and any(len(r.g) == 0 for r in got.values())


def test_a_snapped_geometry_stays_as_it_is(spark):
    rng = np.random.default_rng(8)
    first = snapped(spark, [wkt([star(rng, 9, 3.0, 0, 0)]) for _ in range(20)])
    again = snapped(spark, [first[k].w for k in range(20)])
    assert [again[k].w for k in range(20)] == [first[k].w for k in range(20)]


@pytest.mark.parametrize("shape,want", [
    # a hole that touches the shell in a point stays a hole
    (wkt([[(0, 0), (6, 0), (6, 6), (0, 6)], [(3.0, 0.02), (2.0, 2.0), (4.0, 2.0)]]),
     "MULTIPOLYGON(((0 0, 3 0, 6 0, 6 6, 0 6, 0 0), (2 2, 4 2, 3 0, 2 2)))"),
    # a hole along the shell becomes a bay
    (wkt([[(0, 0), (6, 0), (6, 6), (0, 6)], [(2.0, 0.03), (2.0, 2.0), (4.0, 2.0), (4.0, 0.03)]]),
     "MULTIPOLYGON(((0 0, 2 0, 2 2, 4 2, 4 0, 6 0, 6 6, 0 6, 0 0)))"),
    # an island inside a hole is a part of its own
    (wkt([[(0, 0), (9, 0), (9, 9), (0, 9)], [(1, 1), (1, 8), (8, 8), (8, 1)]], [[(3, 3), (5, 3), (5, 5.04), (3, 5)]]),
     "MULTIPOLYGON(((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 1 8, 8 8, 8 1, 1 1)), ((3 3, 5 3, 5 5, 3 5, 3 3)))"),
    # orientation of the input does not matter
    (wkt([[(0, 6), (6, 6), (6, 0), (0, 0)], [(2, 2), (4, 2), (4, 4), (2, 4)]]),
     "MULTIPOLYGON(((0 0, 6 0, 6 6, 0 6, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2)))"),
    (wkt([[(0, 0), (0.04, 0), (0.04, 9), (0, 9)]]), "MULTIPOLYGON()"),
])
def test_known_results(spark, shape, want):
    assert snapped(spark, [shape])[0].w == want


def test_null_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, wkt([[(0, 0), (1, 0), (1, 1.03)]]))] * 2, "k long, w string")
    df = df.select("k", G.from_wkt("w").alias("g"), F.lit(1).alias("x1"))
    out = reduce_precision(df, "g")
    assert out.columns == df.columns
    assert sorted((r.k, r.g is None) for r in out.collect()) == [(1, True)] * 4 + [(2, False)] * 2
    assert reduce_precision(df.limit(0), "g").count() == 0
