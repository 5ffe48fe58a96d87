"""Geometry: parsing and measures (JVM side) and the pair kernels on
hand-computed shapes: concave, hole, multipart, point touch, edge touch,
nested, empty erosion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import planar as P
from footlink.functions import geometry as G


def poly(xs, ys, rs=None, rk=None):
    return P.Poly(xs, ys, rs or [len(xs)], rk or [1])


def box(x0, y0, x1, y1):
    return poly([x0, x1, x1, x0, x0], [y0, y0, y1, y1, y0])


L_SHAPE = poly([0, 4, 4, 2, 2, 0, 0], [0, 0, 2, 2, 4, 4, 0])
HOLED = P.Poly([0, 10, 10, 0, 0, 2, 2, 4, 4, 2], [0, 0, 10, 10, 0, 2, 4, 4, 2, 2], [5, 5], [1, 0])
TWO_PARTS = P.Poly([0, 1, 1, 0, 0, 5, 6, 6, 5, 5], [0, 0, 1, 1, 0, 0, 0, 1, 1, 0], [5, 5], [1, 1])


def test_areas():
    assert L_SHAPE.area() == pytest.approx(12)
    assert HOLED.area() == pytest.approx(96)
    assert TWO_PARTS.area() == pytest.approx(2)


def test_intersection_area():
    assert P.inter_area(L_SHAPE, box(1, 1, 3, 3)) == pytest.approx(3)
    assert P.inter_area(HOLED, box(0, 0, 5, 5)) == pytest.approx(21)
    assert P.inter_area(TWO_PARTS, box(0.5, 0, 5.5, 1)) == pytest.approx(1)
    assert P.inter_area(box(0, 0, 10, 10), box(2, 2, 3, 3)) == pytest.approx(1)


def test_touching():
    assert P.intersects(box(0, 0, 1, 1), box(1, 1, 2, 2))          # point touch
    assert P.intersects(box(0, 0, 1, 1), box(1, 0, 2, 1))          # edge touch
    assert not P.intersects(box(0, 0, 1, 1), box(3, 0, 4, 1))
    assert P.distance(box(0, 0, 1, 1), box(3, 0, 4, 1)) == pytest.approx(2)
    assert P.intersects(HOLED, box(2.5, 2.5, 3, 3)) is False         # inside the hole


def test_equals_ignores_collinear_vertex_and_start():
    a = box(0, 0, 10, 6)
    b = poly([10, 10, 0, 0, 5, 10], [0, 6, 6, 0, 0, 0])
    assert P.equals(a, b)
    assert not P.equals(a, box(0, 0, 10, 6.1))


def test_erosion():
    assert P.contains_eroded(box(-3, -3, 13, 9), box(0, 0, 10, 6))
    assert P.contains_eroded(box(0.5, 0.5, 9.5, 5.5), box(0, 0, 10, 6))      # touches
    assert not P.contains_eroded(box(-9, -9, 9, 9), box(0, 0, 10, 0.8))      # empty erosion
    assert P.contains_eroded(box(-9, -9, 99, 99), L_SHAPE)


def test_general_erosion_agrees_with_the_convex_one():
    rng = np.random.default_rng(7)
    seen = set()
    for _ in range(300):
        w, h = rng.uniform(0.6, 12, 2)
        x0, y0, x1, y1 = rng.uniform(-0.5, 1.2, 4)
        a, b = box(0, 0, w, h), box(x0, y0, max(w - x1, x0 + 0.1), max(h - y1, y0 + 0.1))
        got = P.contains_eroded_general(b, a)
        assert got == P.contains_eroded(b, a)
        seen.add(got)
    assert seen == {True, False}


def _distance_to_boundary(p, x, y):
    dx, dy = p.bx - p.ax, p.by - p.ay
    t = np.clip(((x - p.ax) * dx + (y - p.ay) * dy) / (dx * dx + dy * dy), 0, 1)
    return np.hypot(p.ax + t * dx - x, p.ay + t * dy - y).min()


def test_general_erosion_against_sampled_points():
    """Random star polygons; the erosion is sampled on a fine grid."""
    rng = np.random.default_rng(11)
    seen = {True: 0, False: 0}

    def star(n, r):
        ang = (np.arange(n) + rng.uniform(0, 0.9, n)) * 2 * np.pi / n
        rad = rng.uniform(0.4 * r, r, n)
        x, y = rad * np.cos(ang), rad * np.sin(ang)
        return poly([*x, x[0]], [*y, y[0]])

    def grow(p, f):
        return poly([*(p.ax * f), p.ax[0] * f], [*(p.ay * f), p.ay[0] * f])

    for n in range(60):
        a = star(9, 5.0)
        b = grow(a, rng.uniform(0.6, 1.05)) if n % 2 else star(9, 9.0)
        gx, gy = (g.ravel() for g in np.meshgrid(np.arange(-5, 5, 0.1), np.arange(-5, 5, 0.1)))
        inside, _ = P.contains_points(a, gx, gy)
        gx, gy = gx[inside], gy[inside]
        dist = np.array([_distance_to_boundary(a, x, y) for x, y in zip(gx, gy)])
        core = dist > 0.5
        if not core.any():
            continue
        held, on = P.contains_points(b, gx[core], gy[core])
        got = P.contains_eroded_general(b, a)
        if got:
            assert np.all(held | on)
        elif np.all(held | on):
            # what sticks out is thinner than the grid: b's boundary must come close
            edge = np.array([_distance_to_boundary(b, x, y) for x, y in zip(gx[core], gy[core])])
            assert edge.min() < 0.15
        seen[got] += 1
    assert min(seen.values()) > 5


def test_erosion_that_falls_apart():
    """A dumbbell: a neck 0.8 m wide erodes away, leaving two rooms."""
    xs = [0, 4, 4, 8, 8, 12, 12, 8, 8, 4, 4, 0, 0]
    ys = [0, 0, 1.6, 1.6, 0, 0, 4, 4, 2.4, 2.4, 4, 4, 0]
    a = poly(xs, ys)
    assert not P.contains_eroded(box(-1, -1, 5, 5), a)
    assert not P.contains_eroded(box(7, -1, 13, 5), a)
    assert P.contains_eroded(P.Poly([-1, 5, 5, -1, -1, 7, 13, 13, 7, 7], [-1, -1, 5, 5, -1, -1, -1, 5, 5, -1], [5, 5], [1, 1]), a)


def test_union_by_exposed_boundary():
    h1, h2 = box(0, 0, 5, 6), box(5, 0, 10, 6)
    e1, a0, a1 = P.cover_pieces(h1, h2, False)
    e2, b0, b1 = P.cover_pieces(h2, h1, True)
    c1, l1 = P.edge_terms(h1)
    c2, l2 = P.edge_terms(h2)
    cov1, cov2 = np.zeros(h1.n), np.zeros(h2.n)
    np.add.at(cov1, e1, a1 - a0)
    np.add.at(cov2, e2, b1 - b0)
    assert np.sum((1 - cov1) * c1) + np.sum((1 - cov2) * c2) == pytest.approx(60)
    assert np.sum((1 - cov1) * l1) + np.sum((1 - cov2) * l2) == pytest.approx(32)


def test_wkt_and_measures(spark):
    rows = [("SRID=2154;MULTIPOLYGON Z (((0 0 1, 4 0 1, 4 2 1, 2 2 1, 2 4 1, 0 4 1, 0 0 1)))",),
            ("POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2))",),
            ("POLYGON EMPTY",), ("POINT(1 2)",)]
    df = spark.createDataFrame(rows, "w string").select(G.from_wkt("w").alias("g"), G.srid_of("w").alias("srid"))
    out = df.select(G.area("g").alias("a"), G.perimeter("g").alias("p"), G.npoints("g").alias("n"), "srid").collect()
    assert (out[0].a, out[0].p, out[0].n, out[0].srid) == (12.0, 16.0, 7, 2154)
    assert (out[1].a, out[1].p, out[1].n) == (96.0, 48.0, 10)
    assert out[2].a is None and out[3].a is None


def test_point_distance_expression(spark):
    df = spark.createDataFrame([(3.0, 3.0), (1.0, 1.0), (13.0, 0.0), (-1.0, 5.0)], "x double, y double")
    g = F.lit(None).cast(G.GEOM_T)
    holed = G.from_wkt(F.lit("POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2))"))
    got = [r.d for r in df.select(G.point_distance("x", "y", holed).alias("d")).collect()]
    assert got == [pytest.approx(1.0), 0.0, pytest.approx(3.0), pytest.approx(1.0)]
    assert df.select(G.point_distance("x", "y", g).alias("d")).first().d is None


def test_convex_fast_path_matches_general():
    rng = np.random.default_rng(11)

    def angles(k):
        while True:
            ang = np.sort(rng.uniform(0, 2 * np.pi, k))
            if np.diff(np.concatenate([ang, [ang[0] + 2 * np.pi]])).max() < 0.95 * np.pi:
                return ang

    def mk(cx, cy, r, k, star):
        ang = angles(k)
        rad = rng.uniform(0.3 * r, r, k) if star else np.full(k, r)
        xs = list(cx + rad * np.cos(ang)) + [cx + rad[0] * np.cos(ang[0])]
        ys = list(cy + rad * np.sin(ang)) + [cy + rad[0] * np.sin(ang[0])]
        return P.Poly(xs, ys, [len(xs)], [1])

    for i in range(400):
        a = mk(0, 0, 10, int(rng.integers(3, 9)), False)
        b = mk(rng.uniform(-8, 8), rng.uniform(-8, 8), 8, int(rng.integers(3, 12)), i % 2 == 1)
        assert P.inter_area(a, b) == pytest.approx(P.inter_area_general(a, b), abs=1e-9)
        assert P.inter_area(b, a) == pytest.approx(P.inter_area_general(a, b), abs=1e-9)


@pytest.mark.parametrize("boxes,area,perim", [
    ([(0, 0, 4, 4), (2, 0, 6, 4)], 24, 20),                    # overlap
    ([(0, 0, 4, 4), (2, 0, 6, 4), (1, 1, 5, 3)], 24, 20),      # triple overlap
    ([(0, 0, 4, 4), (0, 0, 4, 4)], 16, 16),                    # duplicates
    ([(0, 0, 10, 10), (2, 2, 3, 3)], 100, 40),                 # nested
    ([(0, 0, 2, 2), (2, 0, 4, 2), (0, 2, 2, 4)], 12, 16),      # edge-sharing L
    ([(0, 0, 1, 1), (1, 1, 2, 2)], 2, 8),                      # corner touch
])
def test_union_measures_from_pair_covers(boxes, area, perim):
    polys = [box(*b) for b in boxes]
    a_tot = p_tot = 0.0
    for i, p in enumerate(polys):
        iv = []
        for j, q in enumerate(polys):
            if i != j:
                ei, t0, t1 = P.cover_pieces(p, q, q_first=j < i)
                iv += list(zip(ei.tolist(), t0.tolist(), t1.tolist()))
        cov = P.covered_fraction(p.n, None, iv)
        cr, ln = P.edge_terms(p)
        a_tot += float(np.sum((1 - cov) * cr))
        p_tot += float(np.sum((1 - cov) * ln))
    assert (a_tot, p_tot) == (pytest.approx(area), pytest.approx(perim))


def test_convex_intersects_and_distance_match_general():
    rng = np.random.default_rng(21)
    for _ in range(500):
        ks = rng.integers(3, 9, 2)
        polys = []
        for k, (cx, cy) in zip(ks, [(0, 0), rng.uniform(-14, 14, 2)]):
            while True:
                ang = np.sort(rng.uniform(0, 2 * np.pi, k))
                if np.diff(np.concatenate([ang, [ang[0] + 2 * np.pi]])).max() < 0.95 * np.pi:
                    break
            xs = list(cx + 5 * np.cos(ang)) + [cx + 5 * np.cos(ang[0])]
            ys = list(cy + 5 * np.sin(ang)) + [cy + 5 * np.sin(ang[0])]
            polys.append(P.Poly(xs, ys, [len(xs)], [1]))
        a, b = polys
        assert P.intersects(a, b) == P.intersects_general(a, b)


def test_wkt_round_trip(spark):
    w = "MULTIPOLYGON(((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2)), ((20.5 0, 21 0, 21 1, 20.5 0)))"
    df = spark.createDataFrame([(w,)], "w string").select(G.from_wkt("w").alias("g"))
    back = df.select(G.from_wkt(G.to_wkt("g")).alias("g2"), "g").first()
    assert back.g2 == back.g
    p = spark.createDataFrame([(1.5, -2.25)], "x double, y double").select(G.point_to_wkt(G.point("x", "y")).alias("w"))
    assert p.first().w == "POINT(1.5 -2.25)"


@pytest.mark.parametrize("text", ["POLYGON((0 0, 1 0, 1 1", "MULTIPOLYGON(((0 0, x 1)))", "0103000000010000000500000000"])
def test_unreadable_geometry_raises(spark, text):
    with pytest.raises(Exception, match="cannot read geometry"):
        spark.createDataFrame([(text,)], "w string").select(G.from_wkt("w").alias("g")).collect()
