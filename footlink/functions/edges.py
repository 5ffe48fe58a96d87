"""Directed edges of polygons as Spark columns, and what two edges say about
their polygons.

The edges of a (multi)polygon are ``array<struct<ax,ay,bx,by>>``, shells
counter-clockwise and holes clockwise, so the interior is on the left of every
edge. Whatever a pair of polygons has in common is a sum or a minimum over its
edge pairs; no polygon is ever clipped:

* a polygon is the signed sum of the strips below its edges, so the area of an
  intersection is the signed sum, over edge pairs, of the area below both
  (:func:`below_both`); the unbounded parts cancel because rings are closed;
* the distance is the smallest edge distance, 0 if the intersection has an area;
* shared boundary is the sum of collinear overlaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footlink.functions.geometry import _ring_area2, let

EDGES_T = "array<struct<ax:double,ay:double,bx:double,by:double>>"
#: Metres: nearer than this is touching.
EPS = 1e-7


def ring_edges(g) -> Column:
    """Directed edges of a multipolygon column, ring by ring, without empty
    ones. A ring is turned once, not once a coordinate."""
    g = F.col(g) if isinstance(g, str) else g
    x, y = (lambda p: p.getField("x")), (lambda p: p.getField("y"))

    def of(ring, i):
        ccw = _ring_area2(ring) > 0
        turned = F.when(ccw == (i == 0), ring).otherwise(F.reverse(ring))
        es = let(turned, lambda r: F.transform(F.sequence(F.lit(0), F.size(r) - 2), lambda k: F.struct(
            x(r[k]).alias("ax"), y(r[k]).alias("ay"), x(r[k + 1]).alias("bx"), y(r[k + 1]).alias("by"))))
        es = F.filter(es, lambda e: (e.getField("ax") != e.getField("bx")) | (e.getField("ay") != e.getField("by")))
        return F.when(F.size(ring) >= 4, es).otherwise(F.array().cast(EDGES_T))

    return F.flatten(F.transform(g, lambda poly: F.transform(poly, of)))


def edges(g) -> Column:
    """All directed edges of a multipolygon column."""
    return F.flatten(ring_edges(g))


class Edge:
    """Four coordinate columns of one edge."""

    def __init__(self, ax, ay, bx, by):
        self.ax, self.ay, self.bx, self.by = ax, ay, bx, by

    @classmethod
    def of(cls, prefix: str) -> Edge:
        return cls(*[F.col(prefix + c) for c in ("ax", "ay", "bx", "by")])

    @property
    def dx(self) -> Column:
        return self.bx - self.ax

    @property
    def dy(self) -> Column:
        return self.by - self.ay

    @property
    def length(self) -> Column:
        return F.sqrt(self.dx * self.dx + self.dy * self.dy)

    def y_at(self, x) -> Column:
        return self.ay + (x - self.ax) * (self.dy / F.when(self.dx == 0, F.lit(1.0)).otherwise(self.dx))

    def side(self, px, py) -> Column:
        """> 0: the point is on the left."""
        return self.dx * (py - self.ay) - self.dy * (px - self.ax)

    def distance2(self, px, py) -> Column:
        t = ((px - self.ax) * self.dx + (py - self.ay) * self.dy) / (self.dx * self.dx + self.dy * self.dy)
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        ex, ey = self.ax + t * self.dx - px, self.ay + t * self.dy - py
        return ex * ex + ey * ey

    def crosses_ray(self, px, py) -> Column:
        """1 if the ray from the point to x = +inf crosses the edge."""
        hit = ((self.ay > py) != (self.by > py)) & ((self.side(px, py) > 0) == (self.by > self.ay))
        return F.when(hit, 1).otherwise(0)


# What follows is summed over rows of edge pairs. Steps are without branches, so
# that generated code holds each shared step once and in a method of its own:
# a method of more than 8000 bytes is never compiled by the JVM.

def below_both(a: Edge, b: Edge, lo=None, hi=None) -> Column:
    """Signed area below both edges where both have points (between the x of
    ``lo`` and ``hi``, if given). Its sum over all edge pairs is the area of the
    intersection of the two polygons."""
    bounds = lambda x: [] if x is None else [x]
    x1 = F.greatest(F.least(a.ax, a.bx), F.least(b.ax, b.bx), *bounds(lo))
    x2 = F.least(F.greatest(a.ax, a.bx), F.greatest(b.ax, b.bx), *bounds(hi))
    f1, f2 = a.y_at(x1), a.y_at(x2)
    d1, d2 = f1 - b.y_at(x1), f2 - b.y_at(x2)
    up = F.greatest(d1, F.lit(0.0)) + F.greatest(d2, F.lit(0.0))
    over = up * up / (2 * F.greatest(F.abs(d1) + F.abs(d2), F.lit(1e-300)))
    width = F.greatest(x2 - x1, F.lit(0.0)) * F.signum(a.dx) * F.signum(b.dx)
    # off both edges the heights may be infinite
    return F.nanvl(width * ((f1 + f2) / 2 - over), F.lit(0.0))


def apart2(a: Edge, b: Edge) -> Column:
    """Squared distance of two edges, 0 when they cross."""
    cross = (b.side(a.ax, a.ay) * b.side(a.bx, a.by) < 0) & (a.side(b.ax, b.ay) * a.side(b.bx, b.by) < 0)
    return F.least(F.when(cross, F.lit(0.0)), b.distance2(a.ax, a.ay), b.distance2(a.bx, a.by),
                   a.distance2(b.ax, b.ay), a.distance2(b.bx, b.by))


def shared(a: Edge, b: Edge, same_direction: bool = False) -> Column:
    """Length that two edges share."""
    la = a.length
    flat = (F.abs(a.side(b.ax, b.ay)) <= EPS * la) & (F.abs(a.side(b.bx, b.by)) <= EPS * la)
    along = a.dx * b.dx + a.dy * b.dy
    if same_direction:
        flat = flat & (along > 0)
    at = lambda px, py: ((px - a.ax) * a.dx + (py - a.ay) * a.dy) / la
    s, t = at(b.ax, b.ay), at(b.bx, b.by)
    return F.when(flat, F.greatest(F.lit(0.0), F.least(F.greatest(s, t), la) - F.greatest(F.least(s, t), F.lit(0.0)))
                  ).otherwise(F.lit(0.0))


def cuts(a: Edge, b: Edge) -> Column:
    """Where b's ends lie on a, or b crosses it, as parameters of a (NULL where
    not: a plain array is compiled, a filter of it would not be)."""
    l2 = a.dx * a.dx + a.dy * a.dy
    at = lambda px, py: ((px - a.ax) * a.dx + (py - a.ay) * a.dy) / l2
    on = lambda px, py: F.when(a.distance2(px, py) <= EPS * EPS, at(px, py))
    sa, sb = b.side(a.ax, a.ay), b.side(a.bx, a.by)
    cross = (sa * sb < 0) & (a.side(b.ax, b.ay) * a.side(b.bx, b.by) < 0)
    return F.array(on(b.ax, b.ay), on(b.bx, b.by), F.when(cross, sa / F.when(sa == sb, F.lit(1.0)).otherwise(sa - sb)))
