"""G5 ``ST_ReducePrecision`` with a valid result, by snap rounding.

A rounded polygon is not a polygon any more where it is thinner than the
grid: spikes and slivers fold onto themselves, necks close, rings touch
others. So edges are rounded, not vertices:

1. every vertex makes its grid pixel hot; an edge is re-routed through the
   centre of each hot pixel it passes (edges join pixels by coarse cells of the
   geometry, so a long outline costs its length, not its square);
2. pieces that collapse or that meet their own reverse (interior on both sides
   or on none) cancel;
3. each piece left is followed by the first one clockwise from where it came,
   so lobes that touch in a point come apart; rings are numbered by pointer
   doubling, rings that still pass a vertex twice are cut there;
4. counter-clockwise rings are shells, the others holes of the smallest shell
   round them.

The input must be valid (its edges meet at vertices only), as the source
demands. Output rings are simple, start at their smallest vertex, and lie
on the grid; what is thinner than the grid is gone, and a geometry of which
nothing is left is an empty array (NULL stays NULL). Nothing runs in Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footlink.functions.geometry import GEOM_T, _ring_area2
from footlink.session import cut_lineage

GRID = 0.1


def _pixel(v) -> Column:
    return F.floor(v + 0.5).cast("long")


def _edges(rows: DataFrame, geom: str, per_metre: float) -> DataFrame:
    """Oriented edges in grid units, interior on the left, with the corner
    and the width of the geometry's own coarse cells."""
    points = F.transform(F.flatten(F.flatten(geom)), lambda p: F.struct(
        (p.getField("x") * per_metre).alias("x"), (p.getField("y") * per_metre).alias("y")))
    xs, ys = F.col("p.x"), F.col("p.y")
    sized = (rows.select("_row", geom, points.alias("p"))
             .select("_row", geom, F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
                     (F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys), F.lit(8.0))
                      / F.ceil(F.sqrt(F.size("p")))).alias("cell")))
    rings = (sized.select("_row", "x0", "y0", "cell", F.posexplode(geom).alias("pi", "poly"))
             .select("_row", "x0", "y0", "cell", "pi", F.posexplode("poly").alias("ri", "ring"))
             .where(F.size("ring") >= 4))
    ccw = _ring_area2(F.col("ring")) > 0
    ring = F.when(ccw == (F.col("ri") == 0), F.col("ring")).otherwise(F.reverse("ring"))
    at = lambda i, n: F.col("ring")[i].getField(n) * per_metre
    edge = F.transform(F.sequence(F.lit(0), F.size("ring") - 2), lambda i: F.struct(
        at(i, "x").alias("ax"), at(i, "y").alias("ay"), at(i + 1, "x").alias("bx"), at(i + 1, "y").alias("by")))
    return (rings.withColumn("ring", ring).withColumn("edge", edge)
            .select("_row", "x0", "y0", "cell", "pi", "ri", F.posexplode("edge").alias("si", "e"))
            .select("_row", "x0", "y0", "cell", "pi", "ri", "si", "e.*"))


def _pieces(edges: DataFrame) -> DataFrame:
    """(row, x1, y1, x2, y2): the edges re-routed through hot pixels."""
    cell_of = lambda v, lo: F.floor((v - F.col(lo)) / F.col("cell"))
    hot = (edges.select("_row", "x0", "y0", "cell", _pixel(F.col("ax")).alias("X"), _pixel(F.col("ay")).alias("Y"))
           .distinct().withColumn("cx", cell_of(F.col("X"), "x0")).withColumn("cy", cell_of(F.col("Y"), "y0"))
           .drop("x0", "y0", "cell"))
    span = lambda a, b, lo: F.sequence(cell_of(F.least(a, b) - 0.5, lo), cell_of(F.greatest(a, b) + 0.5, lo))
    near = (edges.withColumn("cx", F.explode(span("ax", "bx", "x0")))
            .withColumn("cy", F.explode(span("ay", "by", "y0"))).join(hot, ["_row", "cx", "cy"]))
    X, Y = F.col("X"), F.col("Y")

    def run(a, d, centre):
        """Parameters at which the edge's line is within the pixel's slab."""
        lo, hi = centre - 0.5 - a, centre + 0.5 - a
        level = d == 0
        inside = (lo <= 0) & (hi > 0)
        first = F.when(level, F.when(inside, F.lit(0.0)).otherwise(F.lit(2.0))).otherwise(F.least(lo / d, hi / d))
        last = F.when(level, F.lit(1.0)).otherwise(F.greatest(lo / d, hi / d))
        return first, last

    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    fx, lx = run(F.col("ax"), dx, X)
    fy, ly = run(F.col("ay"), dy, Y)
    enter, leave = F.greatest(F.lit(0.0), fx, fy), F.least(F.lit(1.0), lx, ly)
    mid = (F.col("enter") + F.col("leave")) / 2
    mx, my = F.col("ax") + mid * dx, F.col("ay") + mid * dy
    start = (X == _pixel(F.col("ax"))) & (Y == _pixel(F.col("ay")))
    end = (X == _pixel(F.col("bx"))) & (Y == _pixel(F.col("by")))
    passed = ((F.col("enter") <= F.col("leave")) & (mx >= X - 0.5) & (mx < X + 0.5) & (my >= Y - 0.5) & (my < Y + 0.5))
    key = ["_row", "pi", "ri", "si"]
    paths = (near.withColumn("enter", enter).withColumn("leave", leave).where(start | end | passed)
             .withColumn("t", F.when(start, F.lit(-1.0)).when(end, F.lit(2.0)).otherwise(F.col("enter")))
             .groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("t", "X", "Y"))).alias("path"))
             .where(F.size("path") >= 2))
    step = F.transform(F.sequence(F.lit(0), F.size("path") - 2), lambda i: F.struct(
        F.col("path")[i]["X"].alias("x1"), F.col("path")[i]["Y"].alias("y1"),
        F.col("path")[i + 1]["X"].alias("x2"), F.col("path")[i + 1]["Y"].alias("y2")))
    return paths.select("_row", F.explode(step).alias("s")).select("_row", "s.*")


def _kept(pieces: DataFrame) -> DataFrame:
    """Pieces with the interior on one side only."""
    p, q = (F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2))
    net = (pieces.groupBy("_row", F.least(p, q).alias("lo"), F.greatest(p, q).alias("hi"))
           .agg(F.sum(F.when(p < q, 1).otherwise(-1)).alias("net")).where("net <> 0"))
    a, b = (F.when(F.col("net") > 0, F.col(x)).otherwise(F.col(y)) for x, y in (("lo", "hi"), ("hi", "lo")))
    return net.select("_row", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))


def _followed(kept: DataFrame) -> DataFrame:
    """Each piece with the end (nx, ny) of the piece that follows it."""
    out = kept.select("_row", F.col("x1").alias("x2"), F.col("y1").alias("y2"),
                      F.col("x2").alias("nx"), F.col("y2").alias("ny"))
    back = F.atan2((F.col("y1") - F.col("y2")).cast("double"), (F.col("x1") - F.col("x2")).cast("double"))
    on = F.atan2((F.col("ny") - F.col("y2")).cast("double"), (F.col("nx") - F.col("x2")).cast("double"))
    turn = F.pmod(back - on, F.lit(2 * math.pi))
    return (kept.join(out, ["_row", "x2", "y2"]).groupBy("_row", "x1", "y1", "x2", "y2")
            .agg(F.min_by(F.struct("nx", "ny"), turn).alias("n"))
            .select("_row", "x1", "y1", "x2", "y2", "n.nx", "n.ny"))


def _cut(ring: Column) -> Column:
    """A vertex list (not closed) as simple rings: when a vertex comes again,
    the loop since its last visit is a ring of its own."""
    kind = "struct<path:array<struct<x:bigint,y:bigint>>,rings:array<array<struct<x:bigint,y:bigint>>>>"
    empty = F.struct(F.array().cast("array<struct<x:bigint,y:bigint>>").alias("path"),
                     F.array().cast("array<array<struct<x:bigint,y:bigint>>>").alias("rings")).cast(kind)

    def add(s, p):
        path, rings = s.getField("path"), s.getField("rings")
        at = F.array_position(path, p).cast("int")
        loop = F.slice(path, at, F.size(path) - at + 1)
        return F.when(at > 0, F.struct(F.slice(path, F.lit(1), at).alias("path"),
                                       F.concat(rings, F.array(loop)).alias("rings"))).otherwise(
            F.struct(F.concat(path, F.array(p)).alias("path"), rings.alias("rings"))).cast(kind)

    whole = F.aggregate(ring, empty, add, lambda s: F.concat(s.getField("rings"), F.array(s.getField("path"))))
    return F.when(F.size(F.array_distinct(ring)) == F.size(ring), F.array(ring)).otherwise(whole)


def _area2(ring: Column) -> Column:
    n = F.size(ring)
    x0, y0 = ring[0].getField("x"), ring[0].getField("y")
    return F.aggregate(F.sequence(F.lit(1), n - 2), F.lit(0).cast("long"), lambda s, i: s
                       + (ring[i].getField("x") - x0) * (ring[i + 1].getField("y") - y0)
                       - (ring[i + 1].getField("x") - x0) * (ring[i].getField("y") - y0))


def _holds(shell: Column, hole: Column) -> Column:
    """Is the middle of the hole's first side inside the shell? (Sides never
    lie on each other here.) Doubled coordinates keep it in integers."""
    n = F.size(shell)
    px = hole[0].getField("x") + hole[1].getField("x")
    py = hole[0].getField("y") + hole[1].getField("y")

    def crossed(i):
        a, b = shell[i], shell[F.when(i == n - 1, 0).otherwise(i + 1)]
        ax, ay, bx, by = (2 * v for v in (a.getField("x"), a.getField("y"), b.getField("x"), b.getField("y")))
        side = (bx - ax) * (py - ay) - (px - ax) * (by - ay)
        return ((ay > py) != (by > py)) & ((side > 0) == (by > ay))

    return F.size(F.filter(F.sequence(F.lit(0), n - 1), crossed)) % 2 == 1


def _geometry(followed: DataFrame, per_metre: float) -> DataFrame:
    """(row, geometry): rings by pointer doubling, then shells with holes."""
    es = F.array_sort(F.collect_list(F.struct("x1", "y1", "x2", "y2", "nx", "ny")))
    g = followed.groupBy("_row").agg(es.alias("es"))
    keys = F.transform("es", lambda e: F.struct(*[e.getField(c).alias(c) for c in ("x1", "y1", "x2", "y2")]))
    g = g.withColumn("keys", keys).withColumn("i", F.sequence(F.lit(0), F.size("es") - 1))
    follow = F.transform("es", lambda e: F.array_position("keys", F.struct(
        e.getField("x2").alias("x1"), e.getField("y2").alias("y1"), e.getField("nx").alias("x2"),
        e.getField("ny").alias("y2"))).cast("int") - 1)
    g = g.withColumn("next", follow).withColumn("rounds", F.sequence(F.lit(0), F.ceil(F.log2(F.size("es"))).cast("int")))

    def double(first, combine):
        state = F.struct(F.col("next").alias("n"), first.alias("v"))
        return F.aggregate("rounds", state, lambda s, _: F.struct(
            F.transform("i", lambda i: s.getField("n")[s.getField("n")[i]]).alias("n"),
            F.transform("i", lambda i: combine(s.getField("v")[i], s.getField("v")[s.getField("n")[i]])).alias("v")),
            lambda s: s.getField("v"))

    g = g.withColumn("ring", double(F.col("i"), F.least))
    # steps from each piece on to the first of its ring, where they stop
    g = (g.withColumn("next", F.transform("next", lambda n, i: F.when(F.col("ring")[i] == i, i).otherwise(n)))
         .withColumn("left", double(F.transform("ring", lambda r, i: F.when(r == i, 0).otherwise(1)), lambda a, b: a + b)))
    order = F.array_sort(F.transform("i", lambda i: F.struct(
        F.col("ring")[i].alias("ring"), F.when(F.col("left")[i] == 0, F.lit(-(1 << 30))).otherwise(-F.col("left")[i]).alias("at"),
        F.struct(F.col("es")[i].getField("x1").alias("x"), F.col("es")[i].getField("y1").alias("y")).alias("p"))))
    rings = F.transform(F.array_distinct("ring"), lambda r: F.transform(
        F.filter("order", lambda o: o.getField("ring") == r), lambda o: o.getField("p")))
    g = g.withColumn("order", order).withColumn("rings", rings)
    g = g.withColumn("rings", F.flatten(F.transform("rings", _cut)))

    def turned(r):
        k = F.array_position(r, F.array_min(r)).cast("int")
        return F.concat(F.slice(r, k, F.size(r)), F.slice(r, F.lit(1), k - 1))

    g = g.withColumn("rings", F.array_sort(F.transform("rings", lambda r: F.struct(turned(r).alias("r"), _area2(r).alias("a")))))
    g = (g.withColumn("shells", F.filter("rings", lambda r: r.getField("a") > 0))
         .withColumn("holes", F.filter("rings", lambda r: r.getField("a") < 0)))
    one = F.size("shells") == 1
    owner = F.transform("holes", lambda h: F.when(one, F.lit(0)).otherwise(F.array_min(F.transform(
        F.filter(F.transform("shells", lambda s, j: F.struct(s.getField("a").alias("a"), j.alias("j"), s.getField("r").alias("r"))),
                 lambda s: _holds(s.getField("r"), h.getField("r"))),
        lambda s: F.struct(s.getField("a").alias("a"), s.getField("j").alias("j")))).getField("j")))
    g = g.withColumn("owner", owner)
    point = lambda p: F.struct((p.getField("x") / per_metre).alias("x"), (p.getField("y") / per_metre).alias("y"))
    closed = lambda r: F.transform(F.concat(r, F.array(r[0])), point)
    polys = F.transform("shells", lambda s, j: F.concat(
        F.array(closed(s.getField("r"))),
        F.transform(F.filter("holes", lambda h, k: F.col("owner")[k] == j), lambda h: closed(h.getField("r")))))
    return g.select("_row", polys.cast(GEOM_T).alias("_snapped"))


def reduce_precision(rows: DataFrame, geom: str, grid: float = GRID) -> DataFrame:
    """``rows`` with ``geom`` snapped to the grid and valid."""
    per_metre = float(round(1 / grid)) if abs(round(1 / grid) * grid - 1) < 1e-9 else 1 / grid
    numbered = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
    kept = _kept(_pieces(_edges(numbered.where(F.col(geom).isNotNull()), geom, per_metre)))
    snapped = _geometry(_followed(kept), per_metre)
    out = F.when(F.col(geom).isNotNull(), F.coalesce("_snapped", F.array().cast(GEOM_T)))
    return numbered.join(snapped, "_row", "left").withColumn(geom, out).select(*rows.columns)
