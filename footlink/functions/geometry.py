"""Planar geometry as Spark columns (G1-G3, G6-G9 and bounding boxes).

A polygonal geometry is ``array<array<array<struct<x,y>>>>``: polygons →
rings (first = shell, others = holes) → closed vertex lists. A point is
``struct<x,y>``. Everything here is a Catalyst expression (regex,
``from_json``, higher-order functions): parsing and per-geometry measures
never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footlink.functions import wkb
from footlink.functions.wkb import GEOM_T, POINT_T

# Geometry types other than the ones read, which give NULL.
OTHER_TYPES = ["POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON",
               "GEOMETRYCOLLECTION", "CIRCULARSTRING", "COMPOUNDCURVE", "CURVEPOLYGON", "MULTICURVE",
               "MULTISURFACE", "POLYHEDRALSURFACE", "TIN", "TRIANGLE"]

_NUM = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def srid_of(wkt) -> Column:
    """``ST_SRID`` of EWKT text: the ``SRID=n;`` prefix, else 0."""
    s = F.regexp_extract(_col(wkt), r"^\s*SRID=(\d+);", 1)
    return F.when(s == "", F.lit(0)).otherwise(s.cast("int"))


def _strip(wkt) -> Column:
    return F.upper(F.trim(F.regexp_replace(_col(wkt), r"^\s*SRID=\d+;", "")))


def from_wkt(wkt) -> Column:
    """G1 + G2 + G6: (E)WKT ``POLYGON``/``MULTIPOLYGON`` (2-D or Z/M) →
    multipolygon column; the third/fourth ordinate is dropped (force 2-D)
    and a polygon becomes a one-part multipolygon. Blank, empty or other
    types → NULL; what does not parse, hex WKB included, raises."""
    def parsed(t):
        body = F.regexp_replace(t, r"^(MULTIPOLYGON|POLYGON)\s*(ZM|Z|M)?\s*", "")
        v = F.struct(F.regexp_extract(t, r"^(MULTIPOLYGON|POLYGON)", 1).alias("kind"), body.alias("body"))
        return let(v, lambda v: read(t, v.getField("kind"), v.getField("body")))

    def read(t, kind, body):
        pts = F.regexp_replace(body, rf"({_NUM})\s+({_NUM})(?:\s+{_NUM})*", '{"x":$1,"y":$2}')
        js = F.translate(pts, "()", "[]")
        js = F.when(kind == "POLYGON", F.concat(F.lit("["), js, F.lit("]"))).otherwise(js)
        ok = (kind != "") & ~body.startswith("EMPTY")
        return (F.when(ok, F.coalesce(F.from_json(js, GEOM_T), _broken(t, GEOM_T)))
                .when(_unknown(t), _broken(t, GEOM_T)))

    # the text may be any expression: it is made and stripped once
    return let(_strip(wkt), parsed)


def _broken(t: Column, to: str) -> Column:
    return F.raise_error(F.concat(F.lit("cannot read geometry: "), F.left(t, F.lit(80)))).cast(to)


def _unknown(t: Column) -> Column:
    return (t != "") & ~t.rlike(rf"^({'|'.join(OTHER_TYPES)})\s*(ZM|Z|M)?\s*(\(|EMPTY)")


def point_from_wkt(wkt) -> Column:
    """G1 for ``POINT``: (E)WKT → ``struct<x,y>`` (z dropped). Blank,
    empty or other types → NULL; what does not parse raises."""
    t = _strip(wkt)
    pat = rf"^POINT\s*(?:ZM|Z|M)?\s*\(\s*({_NUM})\s+({_NUM})(?:\s+{_NUM})*\s*\)\s*$"
    return (F.when(t.rlike(pat), F.struct(F.regexp_extract(t, pat, 1).cast("double").alias("x"),
                                          F.regexp_extract(t, pat, 2).cast("double").alias("y")))
            .when(_unknown(t) | t.rlike(r"^POINT\s*(ZM|Z|M)?\s*\("), _broken(t, POINT_T)))


# Columns of outside tables hold (E)WKT or the hex (E)WKB of a database dump.
# The binary reader is a large expression, so only the doors have it.

def read_geometry(text) -> Column:
    t = _col(text)
    return F.when(wkb.is_hex(t), wkb.geometry_from_hex(t)).otherwise(from_wkt(t))


def read_point(text) -> Column:
    t = _col(text)
    return F.when(wkb.is_hex(t), wkb.point_from_hex(t)).otherwise(point_from_wkt(t))


def read_srid(text) -> Column:
    t = _col(text)
    return F.when(wkb.is_hex(t), wkb.srid_from_hex(t)).otherwise(srid_of(t))


def box(x0, y0, x1, y1) -> Column:
    """Axis-aligned rectangle as a one-part multipolygon (CCW shell)."""
    p = lambda x, y: F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))
    return F.array(F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))))


def point(x, y) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


# -- measures (higher-order functions) -------------------------------------

def area(g) -> Column:
    """G7 ``ST_Area``: shells minus holes, each ring by the shoelace formula
    taken relative to its first vertex (keeps precision with projected
    coordinates in the millions)."""
    g = _col(g)
    return F.aggregate(g, F.lit(0.0), lambda acc, poly: acc + F.aggregate(
        F.transform(poly, lambda r, j: F.when(j == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
                    * F.abs(_ring_area2(r)) / 2.0),
        F.lit(0.0), lambda a, b: a + b))


def _ring_area2(r: Column) -> Column:
    n = F.size(r)
    x0, y0 = r[0].getField("x"), r[0].getField("y")
    return F.when(n < 4, F.lit(0.0)).otherwise(F.aggregate(
        F.sequence(F.lit(1), n - 2), F.lit(0.0),
        lambda acc, i: acc
        + (r[i].getField("x") - x0) * (r[i + 1].getField("y") - y0)
        - (r[i + 1].getField("x") - x0) * (r[i].getField("y") - y0)))


def _ring_len(r: Column) -> Column:
    n = F.size(r)
    return F.when(n < 2, F.lit(0.0)).otherwise(F.aggregate(
        F.sequence(F.lit(0), n - 2), F.lit(0.0),
        lambda acc, i: acc + F.hypot(r[i + 1].getField("x") - r[i].getField("x"),
                                     r[i + 1].getField("y") - r[i].getField("y"))))


def perimeter(g) -> Column:
    """G8 ``ST_Perimeter``: every ring's length, holes included."""
    return F.aggregate(F.flatten(_col(g)), F.lit(0.0), lambda acc, r: acc + _ring_len(r))


def npoints(g) -> Column:
    """G9 ``ST_NPoints``: vertex count, closing vertices included."""
    return F.aggregate(F.flatten(_col(g)), F.lit(0), lambda acc, r: acc + F.size(r))


def _all(g, field: str) -> Column:
    return F.flatten(F.transform(F.flatten(_col(g)), lambda r: F.transform(r, lambda p: p.getField(field))))


def with_measures(df, geom: str, prefix: str = ""):
    """Measure once: bbox, area, perimeter, vertex count and the directed
    edges that pair measures read, computed at pool build and carried."""
    from footlink.functions.edges import edges
    g = F.col(geom)
    # all ordinates are listed once for both their ends
    return (df.withColumns({prefix + "edges": edges(g), "_xs": _all(g, "x"), "_ys": _all(g, "y"), prefix + "area": area(g),
                            prefix + "perim": perimeter(g), prefix + "npts": npoints(g)})
            .select(*df.columns, prefix + "edges", *[f(f"_{c}s").alias(f"{prefix}{c}{n}") for c in "xy" for n, f in
                                                     (("min", F.array_min), ("max", F.array_max))],
                    prefix + "area", prefix + "perim", prefix + "npts"))


def _num(v: Column) -> Column:
    """A coordinate as WKT text: ten decimals, trailing zeros dropped."""
    return F.regexp_replace(F.format_string("%.10f", v), r"\.?0+$", "")


def to_wkt(g) -> Column:
    """Multipolygon column → ``MULTIPOLYGON(((x y, ...)))`` text."""
    fmt = lambda p: F.concat(_num(p.getField("x")), F.lit(" "), _num(p.getField("y")))
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, fmt), ", "), F.lit(")"))
    poly = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))
    return F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(_col(g), poly), ", "), F.lit(")"))


def point_to_wkt(p) -> Column:
    p = _col(p)
    return F.concat(F.lit("POINT("), _num(p.getField("x")), F.lit(" "), _num(p.getField("y")), F.lit(")"))


def point_distance(px, py, g) -> Column:
    """Distance from a point to a polygonal geometry, JVM-side: 0 when the
    point is inside (even-odd crossing count over every ring) or on the
    boundary, else the smallest point-to-segment distance."""
    px, py, g = _col(px), _col(py), _col(g)
    inf = F.lit(float("inf"))

    def seg_d2(r, i):
        ax, ay = r[i].getField("x"), r[i].getField("y")
        s = F.struct((r[i + 1].getField("x") - ax).alias("dx"), (r[i + 1].getField("y") - ay).alias("dy"),
                     (px - ax).alias("x"), (py - ay).alias("y"))
        return let(s, from_start)

    def from_start(s):
        dx, dy, x, y = (s.getField(c) for c in ("dx", "dy", "x", "y"))
        l2 = dx * dx + dy * dy
        t = F.when(l2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x * dx + y * dy) / l2))).otherwise(F.lit(0.0))
        return let(F.struct((t * dx - x).alias("x"), (t * dy - y).alias("y")),
                   lambda v: v.getField("x") * v.getField("x") + v.getField("y") * v.getField("y"))

    def crosses(r, i):
        ax, ay = r[i].getField("x"), r[i].getField("y")
        bx, by = r[i + 1].getField("x"), r[i + 1].getField("y")
        straddle = (ay > py) != (by > py)
        xint = ax + (py - ay) * (bx - ax) / (by - ay)
        return F.when(straddle & (px < xint), F.lit(1)).otherwise(F.lit(0))

    segs = lambda r: F.sequence(F.lit(0), F.greatest(F.size(r) - 2, F.lit(0)))
    ok = lambda r: F.size(r) >= 2
    rings = F.flatten(g)
    d2 = F.aggregate(rings, inf, lambda acc, r: F.when(ok(r), F.least(acc, F.aggregate(
        segs(r), inf, lambda a, i: F.least(a, seg_d2(r, i))))).otherwise(acc))
    n = F.aggregate(rings, F.lit(0), lambda acc, r: F.when(ok(r), acc + F.aggregate(
        segs(r), F.lit(0), lambda a, i: a + crosses(r, i))).otherwise(acc))
    return F.when(g.isNull(), F.lit(None).cast("double")) \
            .when(n % 2 == 1, F.lit(0.0)).otherwise(F.sqrt(d2))
