"""Coordinate transforms (G4) and precision grid (G5) as Spark expressions.

Projections are the public closed forms (EPSG Guidance Note 7-2):
Transverse Mercator by the Krüger series to third order in ``n`` (well
under a millimetre inside a UTM zone) and Lambert Conformal Conic with two
standard parallels. Parameters travel as columns (joined from the
territory table), so one expression serves every territory — no per-SRID
branches in the generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_AXIS = 6378137.0
# Inverse flattening of the two ellipsoids in use.
RF_GRS80 = 298.257222101
RF_WGS84 = 298.257223563

# Projection parameters of the territory SRIDs (public EPSG
# definitions). kind, central meridian, false easting, false northing,
# scale factor (TM) / latitude of origin and standard parallels (LCC),
# inverse flattening.
PROJECTIONS = [
    # srid,  kind,  lon0,  fe,       fn,         k0,     lat0, lat1, lat2, rf
    (2154,  "lcc",   3.0, 700000.0, 6600000.0,  None,   46.5, 49.0, 44.0, RF_GRS80),
    (2972,  "tm",  -51.0, 500000.0, 0.0,        0.9996, None, None, None, RF_GRS80),
    (2975,  "tm",   57.0, 500000.0, 10000000.0, 0.9996, None, None, None, RF_GRS80),
    (4467,  "tm",  -57.0, 500000.0, 0.0,        0.9996, None, None, None, RF_GRS80),
    (4471,  "tm",   45.0, 500000.0, 10000000.0, 0.9996, None, None, None, RF_GRS80),
    (5490,  "tm",  -63.0, 500000.0, 0.0,        0.9996, None, None, None, RF_GRS80),
    (7074,  "tm",   39.0, 500000.0, 10000000.0, 0.9996, None, None, None, RF_GRS80),
    (7076,  "tm",   51.0, 500000.0, 10000000.0, 0.9996, None, None, None, RF_GRS80),
    (7080,  "tm",   75.0, 500000.0, 10000000.0, 0.9996, None, None, None, RF_GRS80),
    (32738, "tm",   45.0, 500000.0, 10000000.0, 0.9996, None, None, None, RF_WGS84),
    (32740, "tm",   57.0, 500000.0, 10000000.0, 0.9996, None, None, None, RF_WGS84),
]


def _tm_consts(rf: float) -> dict:
    f = 1.0 / rf
    n = f / (2 - f)
    big_a = A_AXIS / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    return dict(
        n=n, A=big_a,
        a1=n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16, a2=13 * n ** 2 / 48 - 3 * n ** 3 / 5, a3=61 * n ** 3 / 240,
        b1=n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96, b2=n ** 2 / 48 + n ** 3 / 15, b3=17 * n ** 3 / 480,
        d1=2 * n - 2 * n ** 2 / 3 - 2 * n ** 3, d2=7 * n ** 2 / 3 - 8 * n ** 3 / 5, d3=56 * n ** 3 / 15,
        c=2 * math.sqrt(n) / (1 + n))


def _lcc_consts(lat0, lat1, lat2, rf) -> dict:
    f = 1.0 / rf
    e = math.sqrt(2 * f - f * f)
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p0, p1, p2 = (math.radians(v) for v in (lat0, lat1, lat2))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    return dict(e=e, n=n, F=big_f, rho0=A_AXIS * big_f * t(p0) ** n)


def projection_table(spark: SparkSession) -> DataFrame:
    """One row per SRID with every constant the expressions need."""
    rows = []
    for srid, kind, lon0, fe, fn, k0, lat0, lat1, lat2, rf in PROJECTIONS:
        tm = _tm_consts(rf)
        lcc = _lcc_consts(lat0, lat1, lat2, rf) if kind == "lcc" else dict(e=0.0, n=1.0, F=1.0, rho0=0.0)
        rows.append((srid, kind, math.radians(lon0), fe, fn, k0 or 1.0,
                     tm["A"], tm["a1"], tm["a2"], tm["a3"], tm["b1"], tm["b2"], tm["b3"],
                     tm["d1"], tm["d2"], tm["d3"], tm["c"],
                     lcc["e"], lcc["n"], lcc["F"], lcc["rho0"]))
    cols = ["srid", "kind", "lam0", "fe", "fn", "k0", "tA", "a1", "a2", "a3", "b1", "b2", "b3",
            "d1", "d2", "d3", "tc", "le", "ln", "lF", "rho0"]
    return spark.createDataFrame(rows, cols)


def _c(p: str, name: str) -> Column:
    return F.col(p + name)


def forward(lon, lat, p: str = "") -> tuple[Column, Column]:
    """Degrees (EPSG:4326, lon/lat order) → projected metres, using the
    parameter columns prefixed ``p`` (see :func:`projection_table`)."""
    lam = F.radians(lon) - _c(p, "lam0")
    phi = F.radians(lat)
    # Transverse Mercator (Krüger)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - _c(p, "tc") * F.atanh(_c(p, "tc") * s))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e_sum = eta + sum((_c(p, f"a{j}") * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j in (1, 2, 3)), F.lit(0.0))
    n_sum = xi + sum((_c(p, f"a{j}") * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j in (1, 2, 3)), F.lit(0.0))
    tm_x = _c(p, "fe") + _c(p, "k0") * _c(p, "tA") * e_sum
    tm_y = _c(p, "fn") + _c(p, "k0") * _c(p, "tA") * n_sum
    # Lambert Conformal Conic (2SP)
    e = _c(p, "le")
    es = e * F.sin(phi)
    tt = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), e / 2)
    rho = F.lit(A_AXIS) * _c(p, "lF") * F.pow(tt, _c(p, "ln"))
    th = _c(p, "ln") * lam
    l_x = _c(p, "fe") + rho * F.sin(th)
    l_y = _c(p, "fn") + _c(p, "rho0") - rho * F.cos(th)
    is_tm = _c(p, "kind") == "tm"
    return F.when(is_tm, tm_x).otherwise(l_x), F.when(is_tm, tm_y).otherwise(l_y)


def inverse(x, y, p: str = "") -> tuple[Column, Column]:
    """Projected metres → degrees (lon, lat), same parameter columns."""
    x, y = (F.col(x) if isinstance(x, str) else x), (F.col(y) if isinstance(y, str) else y)
    ka = _c(p, "k0") * _c(p, "tA")
    xi = (y - _c(p, "fn")) / ka
    eta = (x - _c(p, "fe")) / ka
    xi2 = xi - sum((_c(p, f"b{j}") * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j in (1, 2, 3)), F.lit(0.0))
    eta2 = eta - sum((_c(p, f"b{j}") * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j in (1, 2, 3)), F.lit(0.0))
    chi = F.asin(F.sin(xi2) / F.cosh(eta2))
    tm_lat = chi + sum((_c(p, f"d{j}") * F.sin(2 * j * chi) for j in (1, 2, 3)), F.lit(0.0))
    tm_lon = _c(p, "lam0") + F.atan2(F.sinh(eta2), F.cos(xi2))
    # LCC inverse with a fixed number of latitude iterations
    dx = x - _c(p, "fe")
    dy = _c(p, "rho0") - (y - _c(p, "fn"))
    rho = F.signum(_c(p, "ln")) * F.sqrt(dx * dx + dy * dy)
    tt = F.pow(rho / (F.lit(A_AXIS) * _c(p, "lF")), 1 / _c(p, "ln"))
    theta = F.atan2(dx, dy)
    e = _c(p, "le")
    # ((1 - e sinφ) / (1 + e sinφ))^(e/2) = exp(-e·atanh(e sinφ)): φ appears
    # once per iteration, so the expression grows linearly.
    phi = F.lit(math.pi / 2) - 2 * F.atan(tt)
    for _ in range(6):
        phi = F.lit(math.pi / 2) - 2 * F.atan(tt * F.exp(-e * F.atanh(e * F.sin(phi))))
    l_lon = theta / _c(p, "ln") + _c(p, "lam0")
    is_tm = _c(p, "kind") == "tm"
    return (F.degrees(F.when(is_tm, tm_lon).otherwise(l_lon)),
            F.degrees(F.when(is_tm, tm_lat).otherwise(phi)))


def snap(v: Column, grid: float = 0.1) -> Column:
    """G5 on one ordinate: round half up to the precision grid. Dividing by
    the number of cells per metre gives the double nearest to the decimal,
    so a value that is on the grid stays as it is."""
    cells = round(1 / grid)
    if abs(cells * grid - 1) < 1e-9:
        return F.floor(v * cells + 0.5) / cells
    return F.floor(v / grid + 0.5) * grid


def transform_geom(g, p: str = "", grid: float | None = None) -> Column:
    """G4 (+ G5) on a multipolygon column: every vertex projected, then
    (optionally) snapped to ``grid``; repeated consecutive vertices that
    snapping creates are dropped. Topology repair is not attempted."""
    g = F.col(g) if isinstance(g, str) else g

    def pt(q):
        x, y = forward(q.getField("x"), q.getField("y"), p)
        if grid:
            x, y = snap(x, grid), snap(y, grid)
        return F.struct(x.alias("x"), y.alias("y"))

    def ring(r):
        pr = F.transform(r, pt)
        if not grid:
            return pr
        return F.filter(pr, lambda q, i: (i == 0) | (q != F.element_at(pr, i)))

    return F.transform(g, lambda poly: F.transform(poly, ring))


def transform_point(pnt, p: str = "", grid: float | None = None) -> Column:
    pnt = F.col(pnt) if isinstance(pnt, str) else pnt
    x, y = forward(pnt.getField("x"), pnt.getField("y"), p)
    if grid:
        x, y = snap(x, grid), snap(y, grid)
    return F.when(pnt.isNotNull(), F.struct(x.alias("x"), y.alias("y")))
