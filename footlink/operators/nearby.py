"""Which buildings have a registry point within a distance, and which points a
building (M13-M15): existence, without a list of pairs.

Points are summed up by square cells: the box of the points of a cell. The
distance of a building to the middle of that box, more or less half its
diagonal, tells for most cells that all of their points are in or all out;
cells that it does not decide go to the cells an eighth as wide, and only what
the smallest cells leave open is compared point by point. A building or
cell that is in is not looked at again, so a cell with any number of points
costs a building one row.

A building starts at the level at which it spans a few cells, so its size does
not matter; each level is one materialised table of (building, cell, verdict).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions.geometry import point_distance
from footlink.operators.spatial import union_all
from footlink.session import cut_lineage

#: Cells at level v are ``distance * 2**v`` wide; the last level, and the step down.
FINEST, STEP = -3, 3
CELL = ["cx", "cy"]
POINT_BOX = ["px0", "py0", "px1", "py1"]


class Near:
    """``points``: ``p_id, px, py``; ``shapes``: ``b_id``, ``geom`` and the box
    ``xmin`` ...; ``inner``: what is nearer than that is in, what is farther
    than ``distance`` is out (they differ if the buffer is a polygon in the
    circle). Rows without coordinates have no part in it."""

    def __init__(self, points: DataFrame, shapes: DataFrame, distance: float, inner: float | None = None):
        self.d, self.inner = float(distance), float(distance if inner is None else inner)
        if self.d <= 0:
            raise ValueError("the distance must be positive")
        width = self.d * 2.0 ** FINEST
        self.points = (points.where("px IS NOT NULL AND py IS NOT NULL")
                       .withColumns({"cx": F.floor(F.col("px") / width), "cy": F.floor(F.col("py") / width)}))
        self.shapes = shapes
        self.fine = cut_lineage(self.points.groupBy(*CELL).agg(
            F.min("px").alias("px0"), F.min("py").alias("py0"), F.max("px").alias("px1"), F.max("py").alias("py1")))
        size = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
        own = F.greatest(F.ceil(F.log2(size / self.d)), F.lit(0))
        self.boxes = (shapes.where("xmin IS NOT NULL").select("b_id", "xmin", "ymin", "xmax", "ymax", (
            F.ceil(F.coalesce(own, F.lit(0)) / STEP) * STEP).cast("int").alias("level")))
        starts = sorted(r.level for r in self.boxes.select("level").distinct().collect())    # a dozen integers at most
        self.levels = list(range(starts[-1] if starts else 0, FINEST - 1, -STEP))
        self.starts = set(starts)

    def _cells(self, level: int) -> DataFrame:
        """The boxes of the points, by cells of a level."""
        up = lambda c: F.floor(F.col(c) / 2 ** (level - FINEST))
        if level == FINEST:
            return self.fine
        return (self.fine.groupBy(up("cx").alias("cx"), up("cy").alias("cy"))
                .agg(F.min("px0").alias("px0"), F.min("py0").alias("py0"), F.max("px1").alias("px1"), F.max("py1").alias("py1")))

    def _begin(self, level: int) -> DataFrame:
        width = self.d * 2.0 ** level
        span = lambda lo, hi: F.explode(F.sequence(F.floor((F.col(lo) - self.d) / width), F.floor((F.col(hi) + self.d) / width)))
        return (self.boxes.where(F.col("level") == level).withColumn("cx", span("xmin", "xmax"))
                .withColumn("cy", span("ymin", "ymax")).drop("level"))

    def _by_boxes(self, rows: DataFrame) -> DataFrame:
        """``rows`` of a building's box and a cell's: those that the boxes do not
        rule out, with ``sure`` where they tell that every point of the cell is
        in. A building touches all sides of its box, so it is no farther from a
        point than the far end of the box's nearer side."""
        gap = [F.greatest(F.col(f"{c}min") - F.col(f"p{c}1"), F.col(f"p{c}0") - F.col(f"{c}max"), F.lit(0.0)) for c in "xy"]
        wide = [F.greatest(F.col(f"{c}max") - F.col(f"p{c}0"), F.col(f"p{c}1") - F.col(f"{c}min")) for c in "xy"]
        slack = 1e-9 * self.d    # of rounding: what is that near to a limit is left open
        away = {c: (F.abs(F.col(f"{c}min") - F.col(f"p{c}")), F.abs(F.col(f"{c}max") - F.col(f"p{c}"))) for c in "xy"}
        reach = F.least(F.hypot(F.least(*away["x"]), F.greatest(*away["y"])),
                        F.hypot(F.greatest(*away["x"]), F.least(*away["y"])))
        return (rows.where(F.hypot(*gap) <= self.d + slack)
                .withColumns({"px": (F.col("px0") + F.col("px1")) / 2, "py": (F.col("py0") + F.col("py1")) / 2})
                .withColumn("half", F.hypot(F.col("px1") - F.col("px0"), F.col("py1") - F.col("py0")) / 2)
                .select("b_id", *CELL, "xmin", "ymin", "xmax", "ymax", "px", "py", "half",
                        (F.least(F.hypot(*wide), reach + F.col("half")) <= self.inner - slack).alias("sure")))

    def _by_shape(self, rows: DataFrame) -> DataFrame:
        """Rows that the boxes leave open, judged by the distance of the building
        and the middle of the cell's box: those that are not out, with ``sure``."""
        slack = 1e-9 * self.d
        near = rows.drop("sure").join(self.shapes.select("b_id", "geom"), "b_id")
        return (near.withColumn("_mid", point_distance("px", "py", "geom"))
                .where(F.col("_mid") - F.col("half") <= self.d + slack)
                .select("b_id", *CELL, "xmin", "ymin", "xmax", "ymax",
                        (F.col("_mid") + F.col("half") <= self.inner - slack).alias("sure")))

    def descend(self, done: list[str]) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
        """The rows that are in, by level, and what the last level leaves open.
        ``done``: the columns that name what one row that is in settles. Only
        what no box settles is looked at by its shape."""
        sure, left = [], None
        for level in self.levels:
            rows = [self._begin(level).join(self._cells(level), CELL)] if level in self.starts or left is None else []
            if left is not None:
                up = [F.floor(F.col(c) / 2 ** STEP).alias("_" + c) for c in CELL]
                below = self._cells(level).select("*", *up)
                rows.append(left.withColumnsRenamed({c: "_" + c for c in CELL}).join(below, ["_cx", "_cy"]).drop("_cx", "_cy"))
            boxes = cut_lineage(self._by_boxes(union_all([r.select("b_id", *CELL, "xmin", "ymin", "xmax", "ymax", *POINT_BOX)
                                                          for r in rows])))
            settled = boxes.where("sure").select("b_id", *CELL)
            shapes = cut_lineage(self._by_shape(boxes.where("NOT sure").join(settled.select(*done).distinct(), done, "left_anti")))
            settled_too = shapes.where("sure").select("b_id", *CELL)
            sure += [(level, settled), (level, settled_too)]
            left = shapes.where("NOT sure").drop("sure").join(settled_too.select(*done).distinct(), done, "left_anti")
        return sure, left

    def buildings(self, exact) -> DataFrame:
        """``b_id`` of the buildings with a point within the distance;
        ``exact(rows)`` keeps those rows of point and ``geom`` that are. Ids may
        repeat."""
        sure, left = self.descend(["b_id"])
        spots = self.points.select(*CELL, "px", "py").distinct()
        hits = exact(left.select("b_id", *CELL).join(spots, CELL).join(self.shapes.select("b_id", "geom"), "b_id"))
        return union_all([rows.select("b_id") for _, rows in sure] + [hits.select("b_id")])

    def near_points(self, exact) -> DataFrame:
        """``p_id`` of the points within the distance of a building. Ids may repeat."""
        sure, left = self.descend(CELL)
        marks = union_all([rows.select(F.lit(level).alias("level"), *CELL) for level, rows in sure])
        up = lambda c, level: F.floor(F.col(c) / 2 ** (level - FINEST)).alias(c)
        held = self.fine.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.explode(F.array(*[
            F.struct(F.lit(v).alias("level"), up("cx", v), up("cy", v)) for v in self.levels])).alias("c"))
        cells = (held.select("_cx", "_cy", "c.*").join(marks, ["level", *CELL], "left_semi")
                 .select(F.col("_cx").alias("cx"), F.col("_cy").alias("cy")).distinct())
        whole = self.points.join(cells, CELL, "left_semi").select("p_id")
        open_ = left.select("b_id", *CELL).join(cells, CELL, "left_anti")
        hits = exact(open_.join(self.points, CELL).join(self.shapes.select("b_id", "geom"), "b_id"))
        return whole.unionByName(hits.select("p_id"))


def within(distance: float):
    """The plain exact test: distance of point and polygon."""
    def test(rows: DataFrame) -> DataFrame:
        return rows.where(point_distance("px", "py", "geom") <= distance)
    return test
