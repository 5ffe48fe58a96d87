"""Connected components and dissolve.

``ST_Dump(ST_Union(g))`` over a pool = the connected components of the
"shares a piece of boundary or of area" graph between polygon parts.
Components use the alternating large-star / small-star rounds of Kiveris
et al., "Connected Components in MapReduce and Beyond" (SoCC 2014):
O(log n) rounds, each a min-aggregate (map-side combined) and a join — no
component is ever gathered into one task. Each round is checkpointed to
the cluster's checkpoint folder so lineage stays short and a lost executor
recomputes one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions import edges as E
from footlink.session import cut_lineage


def _norm(edges: DataFrame) -> DataFrame:
    return (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter(F.col("a") != F.col("b")).distinct())


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes(id)``, ``edges(a, b)`` → ``(id, comp)`` with ``comp`` the
    smallest id of the node's component."""
    e = cut_lineage(_norm(edges))
    if e.limit(1).count() == 0:
        return nodes.select("id").distinct().withColumn("comp", F.col("id"))
    while True:
        # large star: link every larger neighbour to the smallest of N(u)+u
        sym = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        m = sym.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _norm(sym.join(m, "a").filter(F.col("b") > F.col("a"))
                      .select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: link u and its smaller neighbours to the smallest of them
        m2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _norm(large.join(m2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(m2.select("a", F.col("m").alias("b"))))
        small = cut_lineage(small)
        e = small
        # Finished when no parent is itself a child: every edge points at a root.
        if e.join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    star = e.groupBy("a").agg(F.min("b").alias("comp"))
    return (nodes.select("id").distinct().join(star.withColumnRenamed("a", "id"), "id", "left")
            .select("id", F.coalesce("comp", "id").alias("comp")))


def union_boundary(parts: DataFrame, touching: DataFrame) -> DataFrame:
    """Boundary of each dissolved component (G13, A6) as directed pieces
    ``(comp, ax, ay, bx, by)``, interior on the left.

    ``parts``: ``(id, comp, edges)``; ``touching``: pairs ``(a, b)`` of parts
    that share area or boundary. Edges are cut where an edge of a touching
    part meets them; a piece is hidden when its middle is inside another
    part, or on its boundary with that part on the other side, or on the same
    side of a part with a smaller id (so a shared piece stays once). Edge
    pairs are rows; nothing of a component is gathered. A part that touches no
    other keeps its edges as they are.
    """
    sym = touching.select("a", "b").unionByName(touching.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = sym.select(F.col("a").alias("id")).distinct()
    alone = (parts.join(met, "id", "left_anti").select("comp", F.explode(F.array_distinct("edges")).alias("p"))
             .where(F.hypot(F.col("p")["bx"] - F.col("p")["ax"], F.col("p")["by"] - F.col("p")["ay"]) > E.EPS))
    # everything below is grouped and joined by the part, so it moves once
    own = parts.join(met, "id", "left_semi").select("comp", F.col("id").alias("a"), "edges").repartition("a")
    other = sym.join(parts.select(F.col("id").alias("b"), F.col("edges").alias("r_edges")), "b").repartition("a")
    rows = (own.join(other, "a", "left")
            .withColumn("_ox", F.col("edges")[0]["ax"]).withColumn("_oy", F.col("edges")[0]["ay"])
            .select("comp", "a", "r_edges", "_ox", "_oy", F.posexplode("edges").alias("e", "_a"))
            .select("comp", "a", "e", "_ox", "_oy", "_a", F.explode_outer("r_edges").alias("_b")))
    edge = lambda n: E.Edge(*[F.col(n)[c] - F.col("_ox" if c[1] == "x" else "_oy") for c in ("ax", "ay", "bx", "by")])
    cuts = (rows.withColumn("t", E.cuts(edge("_a"), edge("_b"))).groupBy("comp", "a", "e", "_a")
            .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("t")))).alias("ts")))
    ends = F.concat(F.array(F.lit(0.0)), F.filter("ts", lambda t: (t > 0) & (t < 1)), F.array(F.lit(1.0)))
    at = lambda t, c: F.when(t == 1.0, F.col("_a")["b" + c]).otherwise(
        F.col("_a")["a" + c] + t * (F.col("_a")["b" + c] - F.col("_a")["a" + c]))
    pieces = F.transform(F.sequence(F.lit(0), F.size("_ts") - 2), lambda i: F.struct(*[
        at(F.col("_ts")[i + k], c).alias(n + c) for n, k in (("a", 0), ("b", 1)) for c in "xy"]))
    cut = (cuts.withColumn("_ts", ends).select("comp", "a", F.explode(pieces).alias("p"))
           .where(F.hypot(F.col("p")["bx"] - F.col("p")["ax"], F.col("p")["by"] - F.col("p")["ay"]) > E.EPS))
    p = lambda c: F.col("p")[c]
    tests = (cut.join(other, "a", "left")
             .select("comp", "a", "b", "p", F.explode_outer("r_edges").alias("_b")))
    q = E.Edge(*[F.col("_b")[c] - (p("a" + c[1]) + p("b" + c[1])) / 2 for c in ("ax", "ay", "bx", "by")])
    zero = F.lit(0.0)
    on = q.distance2(zero, zero) <= (10 * E.EPS) ** 2
    along = q.dx * (p("bx") - p("ax")) + q.dy * (p("by") - p("ay"))
    hidden = F.when(F.col("same") | F.col("against"), F.col("against") | (F.col("b") < F.col("a"))).otherwise(F.col("inside"))
    return (tests.groupBy("comp", "a", "p", "b")
            .agg((F.sum(q.crosses_ray(zero, zero)) % 2 == 1).alias("inside"),
                 F.max(on & (along > 0)).alias("same"), F.max(on & (along < 0)).alias("against"))
            .groupBy("comp", "a", "p").agg(F.max(F.coalesce(hidden, F.lit(False))).alias("hidden"))
            .where("NOT hidden").select("comp", "p.*").unionByName(alone.select("comp", "p.*")))


def boundary_measures(boundary: DataFrame) -> DataFrame:
    """``(comp, u_area, u_perim)`` of dissolved components."""
    origin = boundary.groupBy("comp").agg(F.min("ax").alias("_ox"), F.min("ay").alias("_oy"))
    ax, ay, bx, by = (F.col(c) - F.col("_ox" if c[1] == "x" else "_oy") for c in ("ax", "ay", "bx", "by"))
    return (boundary.join(origin, "comp").groupBy("comp")
            .agg(F.round(F.sum(ax * by - bx * ay) / 2, 9).alias("u_area"),
                 F.round(F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))), 9).alias("u_perim")))


def boundary_overlap(pairs: DataFrame, boundary: DataFrame, shapes: DataFrame, strip: float) -> DataFrame:
    """``(comp, b, inter)``: area that component and shape ``(id, edges)`` share,
    for ``pairs (comp, b)``. Both boundaries meet in vertical strips of the
    plane, clipped there, so a large component costs each shape a column of
    it and no key holds it whole."""
    span = lambda x0, x1: F.explode(F.sequence(F.floor(F.least(x0, x1) / strip), F.floor(F.greatest(x0, x1) / strip)))
    u = (boundary.join(pairs.select("comp").distinct(), "comp", "left_semi").where("ax <> bx")
         .withColumn("cx", span(F.col("ax"), F.col("bx"))))
    b = (pairs.join(shapes.select(F.col("id").alias("b"), "edges"), "b")
         .withColumn("_ox", F.col("edges")[0]["ax"]).withColumn("_oy", F.col("edges")[0]["ay"])
         .select("comp", "b", "_ox", "_oy", F.explode("edges").alias("_b")).where("_b.ax <> _b.bx")
         .withColumn("cx", span(F.col("_b.ax"), F.col("_b.bx"))))
    shift = lambda v, c: v - F.col("_ox" if c[1] == "x" else "_oy")
    p = E.Edge(*[shift(F.col(c), c) for c in ("ax", "ay", "bx", "by")])
    q = E.Edge(*[shift(F.col("_b")[c], c) for c in ("ax", "ay", "bx", "by")])
    lo, hi = F.col("cx") * strip - F.col("_ox"), (F.col("cx") + 1) * strip - F.col("_ox")
    return (u.join(b, ["comp", "cx"]).groupBy("comp", "b")
            .agg(F.round(F.sum(E.below_both(p, q, lo, hi)), 9).alias("inter")))
