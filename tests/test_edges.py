"""The edge relations against plain numpy geometry, pair by pair, and against
closed forms; the cell join against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import planar as P
from footlink.functions import geometry as G
from footlink.operators import components as C
from footlink.operators import matching as M
from footlink.operators import spatial as S
from footlink.operators.erosion import holds_eroded

OX, OY = 652000.0, 6862000.0            # projected coordinates are large


def wkt(*polys):
    ring = lambda r: "(" + ", ".join(f"{OX + x!r} {OY + y!r}" for x, y in [*r, r[0]]) + ")"
    return "MULTIPOLYGON(" + ", ".join("(" + ", ".join(ring(r) for r in p) + ")" for p in polys) + ")"


def plain(*polys):
    xs, ys, rs, rk = [], [], [], []
    for p in polys:
        for i, r in enumerate(p):
            r = [*r, r[0]]
            xs += [x for x, _ in r]
            ys += [y for _, y in r]
            rs.append(len(r))
            rk.append(1 if i == 0 else 0)
    return P.Poly(xs, ys, rs, rk)


def box(x0, y0, x1, y1):
    return [[(float(x0), float(y0)), (float(x1), float(y0)), (float(x1), float(y1)), (float(x0), float(y1))]]


def star(rng, n, r, cx, cy):
    ang = (np.arange(n) + rng.uniform(0, 0.9, n)) * 2 * np.pi / n
    rad = rng.uniform(0.4 * r, r, n)
    return [[(float(x), float(y)) for x, y in zip(cx + rad * np.cos(ang), cy + rad * np.sin(ang), strict=True)]]


def shapes():
    rng = np.random.default_rng(6)
    out = []
    for i in range(120):
        a, b = star(rng, int(rng.integers(3, 12)), 6, 0, 0), star(rng, int(rng.integers(3, 12)), 6, *rng.uniform(-9, 9, 2))
        out.append(([a], [b]))
    holed = [box(0, 0, 10, 10)[0], [(2.0, 2.0), (2.0, 8.0), (8.0, 8.0), (8.0, 2.0)]]
    ell = [[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]]
    for a, b in [([holed], [box(0, 0, 5, 5)]), ([holed], [box(3, 3, 7, 7)]), ([holed], [box(2, 2, 8, 8)]),
                 ([box(0, 0, 1, 1), box(5, 0, 6, 1)], [box(0.5, 0, 5.5, 1)]), ([box(0, 0, 1, 1)], [box(1, 1, 2, 2)]),
                 ([box(0, 0, 1, 1)], [box(1, 0, 2, 1)]), ([box(0, 0, 1, 1)], [box(3, 0, 4, 1)]), ([ell], [box(1, 1, 3, 3)]),
                 ([ell], [ell]), ([ell], [[ell[0][3:] + [(0.0, 2.0)] + ell[0][:3]]]), ([box(0, 0, 9, 9)], [box(2, 2, 3, 3)]),
                 ([box(0, 0, 1, 1)], [box(1, 0.25, 2, 0.5)]), ([box(0, 0, 10, 6)], [box(0, 0, 10, 6.1)])]:
        out.append((a, b))
    return out


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(str(i), wkt(*a), wkt(*b)) for i, (a, b) in enumerate(shapes())]
    df = spark.createDataFrame(rows, "id string, a string, b string")
    left = S.side(G.with_measures(df.select("id", G.from_wkt("a").alias("g")), "g"), "l_", "id")
    right = S.side(G.with_measures(df.select("id", G.from_wkt("b").alias("g")), "g"), "r_", "id")
    return df, left, right


def test_measures_equal_plain_geometry(pairs):
    df, left, right = pairs
    ids = df.select(F.col("id").alias("l_id"), F.col("id").alias("r_id"))
    got = {r.l_id: r for r in S.pair_measures(ids, left, right, ["inter", "hits", "dist", "equal", "contact"],
                                              ["l_id", "r_id"]).collect()}
    for i, (a, b) in enumerate(shapes()):
        r, p, q = got[str(i)], plain(*a), plain(*b)
        assert r.inter == pytest.approx(P.inter_area_general(p, q), abs=1e-6), i
        assert r.dist == pytest.approx(P.distance(p, q), abs=1e-6) and r.hits == P.intersects(p, q), i
        assert r.equal == P.equals(p, q) or i >= 120, i
    known = {120 + k: v for k, v in {1: (False, 1.0, False), 2: (True, 0.0, True), 4: (True, 0.0, False), 5: (True, 0.0, True),
                                     6: (False, 2.0, False), 11: (True, 0.0, True)}.items()}
    for i, (hits, dist, contact) in known.items():
        assert (got[str(i)].hits, got[str(i)].contact) == (hits, contact) and got[str(i)].dist == pytest.approx(dist, abs=1e-6)
    assert [got[str(i)].equal for i in (128, 129, 132)] == [True, True, False]


def test_eroded_containment_equals_plain_geometry(spark):
    rng = np.random.default_rng(12)
    cases = []
    for n in range(60):
        a = star(rng, 9, 5.0, 0, 0)
        f = rng.uniform(0.6, 1.05)
        cases.append(([a], [[[(x * f, y * f) for x, y in a[0]]]] if n % 2 else [star(rng, 9, 9.0, 0, 0)]))
    dumb = [[(0.0, 0.0), (4.0, 0.0), (4.0, 1.6), (8.0, 1.6), (8.0, 0.0), (12.0, 0.0), (12.0, 4.0), (8.0, 4.0), (8.0, 2.4),
             (4.0, 2.4), (4.0, 4.0), (0.0, 4.0)]]
    holed = [box(0, 0, 10, 10)[0], [(3.0, 3.0), (3.0, 7.0), (7.0, 7.0), (7.0, 3.0)]]
    cases += [([dumb], [box(-1, -1, 5, 5)]), ([dumb], [box(-1, -1, 5, 5), box(7, -1, 13, 5)]), ([dumb], [box(-1, -1, 13, 5)]),
              ([holed], [box(0, 0, 10, 10)]), ([holed], [box(0.5, 0.5, 9.5, 9.5)]), ([holed], [box(0.6, 0.5, 9.5, 9.5)]),
              ([box(0, 0, 10, 0.8)], [box(-9, -9, 19, 9)]), ([box(0, 0, 10, 6)], [box(0.5, 0.5, 9.5, 5.5)])]
    df = spark.createDataFrame([(str(i), wkt(*a), wkt(*b)) for i, (a, b) in enumerate(cases)], "id string, a string, b string")
    shp = G.with_measures(df.select("id", G.from_wkt("a").alias("g")), "g")
    right = S.side(G.with_measures(df.select("id", G.from_wkt("b").alias("g")), "g"), "r_", "id")
    ids = right.select(F.col("r_id").alias("l_id"), "r_id", *[f"r_{c}" for c in S.BOX])
    got = {r.l_id for r in holds_eroded(ids, shp.select(F.col("id").alias("l_id"), F.col("edges").alias("l_edges"), "g"),
                                        "g", right, 0.5).collect()}
    want = {str(i) for i, (a, b) in enumerate(cases) if P.contains_eroded_general(plain(*b), plain(*a))}
    assert got == want and 5 < len(want) < len(cases) - 5


def dissolved_measures(spark, polys):
    df = spark.createDataFrame([(f"p{i:03}", wkt(p)) for i, p in enumerate(polys)], "id string, w string")
    pool = G.with_measures(df.select("id", G.from_wkt("w").alias("g")), "g")
    d = M.dissolve(pool, "id", "g")
    b = C.union_boundary(d.parts, d.touching)
    return sorted((round(r.u_area, 6), round(r.u_perim, 6)) for r in C.boundary_measures(b).collect()), d, b


@pytest.mark.parametrize("polys,want", [
    ([box(0, 0, 4, 4), box(2, 0, 6, 4)], [(24, 20)]),
    ([box(0, 0, 4, 4), box(2, 0, 6, 4), box(1, 1, 5, 3)], [(24, 20)]),
    ([box(0, 0, 4, 4)] * 3, [(16, 16)]),
    ([box(0, 0, 10, 10), box(2, 2, 3, 3)], [(100, 40)]),
    ([box(0, 0, 2, 2), box(2, 0, 4, 2), box(0, 2, 2, 4)], [(12, 16)]),
    ([box(0, 0, 1, 1), box(1, 1, 2, 2)], [(1, 4), (1, 4)]),
    ([box(i, j, i + 1, j + 1) for i in range(4) for j in range(4)], [(16, 16)]),
    ([box(i, j, i + 1, j + 1) for i in range(3) for j in range(3) if (i, j) != (1, 1)], [(8, 16)]),
    # a chain of nine boxes of height 2 and 3 that overlap by a metre
    ([box(3 * i, 0, 3 * i + 4, 2 + i % 2) for i in range(9)], [(28 * 2 + 4 * 4, 2 * 28 + 2 * 2 + 4 * 2)]),
])
def test_dissolved_measures(spark, polys, want):
    assert dissolved_measures(spark, polys)[0] == want


def test_overlap_with_a_large_component(spark):
    """A component over many strips: what it shares with a shape equals the
    area of the columns, whatever the width of a strip."""
    polys = [box(10 * i, 0, 10 * i + 10, 5 + i % 3) for i in range(30)]
    _, d, b = dissolved_measures(spark, polys)
    comp = d.parts.first().comp
    shape = spark.createDataFrame([("s", wkt(box(33, -2, 251, 5.5)))], "id string, w string").select("id", G.from_wkt("w").alias("g"))
    pairs = spark.createDataFrame([(comp, "s")], "comp string, b string")
    want = sum((min(10 * i + 10, 251) - max(10 * i, 33)) * min(5 + i % 3, 5.5) for i in range(3, 26))
    for strip in (7.0, 128.0, 1e6):
        got = C.boundary_overlap(pairs, b, G.with_measures(shape, "g"), strip).first().inter
        assert got == pytest.approx(want, abs=1e-6)


def test_cells_of_mixed_sizes(spark):
    """Boxes from 1 m to 100 km: at most four cells a level in use, and the
    same pairs as all against all."""
    rng = np.random.default_rng(2)
    n = 300
    size = 10.0 ** rng.uniform(0, 5, n)
    x, y = rng.uniform(-2e4, 2e4, n), rng.uniform(-2e4, 2e4, n)
    rows = [(f"{i:03}", *map(float, (x[i], y[i], x[i] + size[i], y[i] + size[i] * 0.3))) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, xmin double, ymin double, xmax double, ymax double")
    left, right = S.side(df, "l_", "id"), S.side(df, "r_", "id")
    for d in (0.0, 500.0):
        levels = S.used_levels(left, right, d, 128.0, "l_", "r_")
        per_box = S.cells(left, "l_", d, 128.0, levels[1]).groupBy("l_id").count().agg(F.max("count")).first()[0]
        assert per_box <= 4 * (len(levels[1]) + 1)
        got = {(r.l_id, r.r_id) for r in S.candidate_pairs(left, right, d).collect()}
        want = {(a[0], b[0]) for a in rows for b in rows
                if a[1] - d <= b[3] and b[1] <= a[3] + d and a[2] - d <= b[4] and b[2] <= a[4] + d}
        assert got == want
    assert S.candidate_pairs(left, right, self_join=True).where("l_id >= r_id").count() == 0


def test_no_python_worker_in_the_plans(spark):
    from conftest import SF_SMALL
    from footlink.plans.catalog import QUERIES
    for name in ("pairs_intersect", "pairs_within_20", "pairs_shapes", "match_similar", "match_contained_shapes"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython")), name
