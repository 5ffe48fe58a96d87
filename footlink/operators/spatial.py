"""Spatial join on a multi-level cell index (J5, J6) and the edge relation of
its pairs (G10-G12, G18).

Join: each bounding box (the left one grown by the search distance) lies in at
most four cells of the level whose cells are as wide as the box; levels
double. A pair meets at the level of the larger box, so each box also takes
the ancestors of its cells at the coarser levels that the other side uses. The
number of cell rows is bounded whatever the box: a box of 100 km beside boxes of
10 m costs as many rows as they do. Cells are an integer key for a plain
shuffle join that carries ids, boxes and a few measures, never coordinates. A
pair that meets in several cells is kept in the one with the lower left
corner of the overlap: every pair once, without ``distinct``.

Edges: the survivors fetch the edge arrays of both sides by id, explode to
edge pairs and are summed back (:mod:`footlink.functions.edges`). All edge pairs
of a pair are in one task, so the sum shuffles one row a pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions import edges as E

DEFAULT_CELL = 128.0
BOX = ["xmin", "ymin", "xmax", "ymax"]
GEO = ["edges", *BOX]


def side(df: DataFrame, prefix: str, key: str, extra: list[str] | None = None) -> DataFrame:
    """Rename a pool's key, edges, box and extra columns with a prefix."""
    cols = [F.col(key).alias(prefix + "id")] + [F.col(c).alias(prefix + c) for c in GEO if c in df.columns]
    cols += [F.col(c).alias(prefix + c) for c in (extra or [])]
    return df.select(*cols)


def narrow(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(prefix + "edges")


def _level(prefix: str, grow: float, cell: float):
    c = lambda n: F.col(prefix + n)
    size = F.greatest(c("xmax") - c("xmin"), c("ymax") - c("ymin")) + 2 * grow
    return F.greatest(F.ceil(F.log2(size / cell)), F.lit(0)).cast("int")


def cells(df: DataFrame, prefix: str, grow: float, cell: float, levels: list[int]) -> DataFrame:
    """One row per cell of the box at its own level, and at those of
    ``levels`` above it: at most four a level."""
    c = lambda n: F.col(prefix + n)
    width = lambda v: F.lit(cell) * F.pow(F.lit(2.0), v)
    own = F.col(prefix + "level")
    above = F.filter(F.array(*[F.lit(v) for v in levels]).cast("array<int>"), lambda v: v > own)
    return (df.withColumn(prefix + "level", F.coalesce(_level(prefix, grow, cell), F.lit(0)))
            .withColumn("level", F.explode(F.concat(F.array(own), above)))
            .withColumn("cx", F.explode(F.sequence(F.floor((c("xmin") - grow) / width(F.col("level"))),
                                                   F.floor((c("xmax") + grow) / width(F.col("level"))))))
            .withColumn("cy", F.explode(F.sequence(F.floor((c("ymin") - grow) / width(F.col("level"))),
                                                   F.floor((c("ymax") + grow) / width(F.col("level")))))))


def used_levels(left: DataFrame, right: DataFrame, distance: float, cell: float, lp: str, rp: str) -> tuple[list, list]:
    """Levels of either side: a few dozen integers at most."""
    of = lambda df, p, d, s: df.select(F.lit(s).alias("s"), _level(p, d, cell).alias("v"))
    rows = of(left, lp, distance, "l").unionByName(of(right, rp, 0.0, "r")).distinct().collect()
    return tuple(sorted(r.v for r in rows if r.s == s and r.v is not None) for s in ("l", "r"))


def candidate_pairs(left: DataFrame, right: DataFrame, distance: float = 0.0,
                    cell: float = DEFAULT_CELL, lp: str = "l_", rp: str = "r_",
                    self_join: bool = False) -> DataFrame:
    """Pairs whose boxes are within ``distance`` (touching counts), with all
    columns of both sides but the edges. With ``self_join`` only pairs with
    ``l_id < r_id``."""
    d, cell = float(distance), float(cell)
    left, right = narrow(left, lp), narrow(right, rp)
    of_left, of_right = used_levels(left, right, d, cell, lp, rp)
    lc, rc = cells(left, lp, d, cell, of_right), cells(right, rp, 0.0, cell, of_left)
    l = lambda n: F.col(lp + n)
    r = lambda n: F.col(rp + n)
    width = F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))
    ix = F.greatest(l("xmin") - d, r("xmin"))
    iy = F.greatest(l("ymin") - d, r("ymin"))
    cond = ((F.col("level") == F.greatest(l("level"), r("level")))
            & (F.col("cx") == F.floor(ix / width)) & (F.col("cy") == F.floor(iy / width))
            & (l("xmin") - d <= r("xmax")) & (r("xmin") <= l("xmax") + d)
            & (l("ymin") - d <= r("ymax")) & (r("ymin") <= l("ymax") + d))
    if self_join:
        cond = cond & (l("id") < r("id"))
    return lc.join(rc, ["level", "cx", "cy"]).filter(cond).drop("level", "cx", "cy", lp + "level", rp + "level")


# -- the edge relation of pairs --------------------------------------------------

def attach(pairs: DataFrame, left: DataFrame, right: DataFrame, lp: str = "l_", rp: str = "r_") -> DataFrame:
    """The pairs with the edge arrays of both sides, by id."""
    return (pairs.join(left.select(lp + "id", lp + "edges"), lp + "id")
            .join(right.select(rp + "id", rp + "edges"), rp + "id"))


def exploded(pairs: DataFrame, keep: list[str], lp: str = "l_", rp: str = "r_") -> DataFrame:
    """One row per edge pair: ``keep`` columns, edge a (``a_*``) of the left
    and b (``b_*``) of the right polygon, both from the left one's first vertex
    (coordinates stay small)."""
    rows = pairs.select(*keep, F.col(lp + "edges").alias("_l"), F.col(rp + "edges").alias("_r"),
                        F.col(lp + "edges")[0]["ax"].alias("_ox"), F.col(lp + "edges")[0]["ay"].alias("_oy"))
    rows = (rows.select(*keep, "_r", "_ox", "_oy", F.explode("_l").alias("_a"))
            .select(*keep, "_ox", "_oy", "_a", F.explode("_r").alias("_b")))
    return rows.select(*keep, *[(F.col(f"_{e}")[c] - F.col("_ox" if c[1] == "x" else "_oy")).alias(f"{e}_{c}")
                                for e in "ab" for c in ("ax", "ay", "bx", "by")])


def edge_measures(pairs: DataFrame, measures: list[str], keep: list[str], lp: str = "l_", rp: str = "r_") -> DataFrame:
    """``keep`` (which identifies a pair) and the measures of each pair of edge
    arrays: ``inter`` (area of the intersection), ``hits`` (touching counts),
    ``dist``, ``equal`` (same point set), ``contact`` (a stretch of boundary or an
    area in common). Pairs in which a side has no edge have no row."""
    a, b = E.Edge.of("a_"), E.Edge.of("b_")
    sums = {}
    if {"inter", "hits", "dist", "contact"} & set(measures):
        t = E.below_both(a, b)
        sums["_area"], sums["_noise"] = F.sum(t), F.sum(F.abs(t))
    if {"hits", "dist"} & set(measures):
        sums["_d2"] = F.min(E.apart2(a, b))
    if "contact" in measures:
        sums["_shared"] = F.sum(E.shared(a, b))
    rows = pairs
    if "equal" in measures:
        outline = lambda c: F.aggregate(c, F.lit(0.0), lambda s, e: s + F.hypot(
            e.getField("bx") - e.getField("ax"), e.getField("by") - e.getField("ay")))
        rows = rows.withColumn("_around", F.greatest(outline(lp + "edges"), outline(rp + "edges")))
        sums["_same"] = F.sum(E.shared(a, b, same_direction=True))
        keep = [*keep, "_around"]
    rows = exploded(rows, keep, lp, rp)
    got = rows.groupBy(*keep).agg(*[v.alias(k) for k, v in sums.items()])
    # sums of n terms are off by their rounding; areas are to the square millimetre at most
    area = F.when(F.col("_area") <= 1e-9 + 1e-14 * F.col("_noise"), F.lit(0.0)).otherwise(F.round("_area", 9))
    near = F.when(area > 0, F.lit(0.0)).otherwise(F.sqrt("_d2"))
    out = {"inter": area, "hits": near <= E.EPS, "dist": F.when(near <= E.EPS, F.lit(0.0)).otherwise(near),
           "contact": (area > 0) | (F.col("_shared") > E.EPS),
           "equal": F.col("_same") >= F.col("_around") - 10 * E.EPS}
    return got.select(*[k for k in keep if k != "_around"], *[out[m].alias(m) for m in measures])


def pair_measures(pairs: DataFrame, left: DataFrame, right: DataFrame, measures: list[str], keep: list[str],
                  lp: str = "l_", rp: str = "r_") -> DataFrame:
    """:func:`edge_measures` of candidate pairs of two sides, with ids."""
    ids = [c for c in (lp + "id", rp + "id") if c not in keep]
    cols = [*ids, *keep]
    got = edge_measures(attach(pairs.select(*cols), left, right, lp, rp), measures, cols, lp, rp)
    return got.drop(*ids)


def located(points: DataFrame, key: list[str], edges: str, keep: list[str]) -> DataFrame:
    """``points`` (unique ``key``; coordinates ``px``, ``py``) against the edge
    array beside them: ``inside`` and ``on`` (the boundary)."""
    x, y = F.col("_e")["ax"] * 0, F.col("_e")["ay"] * 0
    e = E.Edge(*[F.col("_e")[c] - F.col("px" if c[1] == "x" else "py") for c in ("ax", "ay", "bx", "by")])
    rows = points.select(*key, *keep, "px", "py", F.explode(edges).alias("_e"))
    return (rows.groupBy(*key, *keep)
            .agg((F.sum(e.crosses_ray(x, y)) % 2 == 1).alias("inside"), (F.min(e.distance2(x, y)) <= E.EPS ** 2).alias("on")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
