"""Orchestrated jobs: the matching cascade after a registry change (O1) and
after topographic creations (O2), plus the candidate restrictions
(M13-M15) that build their pools.

The cascade measures the pools once and then resolves stage precedence on
ids; each stage's claims are written to the cluster's checkpoint folder, so
plans stay short and a lost executor only replays one stage.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions.dates import days_before
from footlink.functions.edges import edges
from footlink.functions.geometry import point_distance
from footlink.functions.lists import to_array
from footlink.operators import matching as M
from footlink.operators.links import destroyed_since, drop_destroyed_links, merge_links, merge_links_with_labels
from footlink.operators.nearby import Near, within
from footlink.operators.spatial import edge_measures, union_all
from footlink.session import cut_lineage


def on_weekday(as_of: str, day: int) -> bool:
    """Does ``as_of`` fall on ``day`` (Sunday = 0 ... Saturday = 6)?"""
    return date.fromisoformat(as_of).isoweekday() % 7 == day


@dataclass
class CascadeResult:
    pools: M.Pools
    claims: DataFrame      # every stage's X with its stage number


class _Left:
    """What earlier stages have left of the pools, from their claims alone:
    claims are a few ids, the pools are never rewritten."""

    def __init__(self, R: DataFrame, B: DataFrame):
        self.R, self.B, self.claims = R, B, []

    def claim(self, stage: int, X: DataFrame) -> None:
        self.claims.append(cut_lineage(X.withColumn("stage", F.lit(stage))))

    def all(self) -> DataFrame:
        return union_all(self.claims)

    def r_ids(self) -> DataFrame:
        return self.all().select("identifiant_rnb").filter("identifiant_rnb <> ''").distinct()

    def b_keys(self) -> DataFrame:
        return (self.all().select(F.explode(to_array("liens_vers_batiment")).alias("cleabs"))
                .filter("cleabs <> ''").distinct())

    def rows_r(self) -> DataFrame:
        return self.R.join(self.r_ids(), "identifiant_rnb", "left_anti").select(*self.R.columns)

    def rows_b(self) -> DataFrame:
        """A claimed building without geometry stays (M11 moves none)."""
        gone = self.b_keys().withColumn("_gone", F.lit(True))
        return (self.B.join(gone, "cleabs", "left").filter(F.col("_gone").isNull() | F.col("geometrie").isNull())
                .select(*self.B.columns))

    def pairs(self, found: DataFrame, stage: int) -> DataFrame:
        """The qualifying pairs of a stage whose two sides are left. The balcony
        stage takes claimed registry rows too, but not those that M11 lost
        because they have no point."""
        of = found.filter(F.col("stage") == stage)
        of = of.join(self.b_keys().withColumnRenamed("cleabs", "r_id"), "r_id", "left_anti")
        gone = self.r_ids()
        if stage == 7:
            gone = (self.R.filter(F.col("geometrie").isNull()).select("identifiant_rnb")
                    .join(gone, "identifiant_rnb", "left_semi"))
        return of.join(gone.withColumnRenamed("identifiant_rnb", "l_identifiant_rnb"), "l_identifiant_rnb", "left_anti")


def run_cascade(R: DataFrame, B: DataFrame, p: M.Params = M.Params(),
                compat_delete: bool = False) -> CascadeResult:
    """Stages M10, M9, M3, M4, M5, M6 each followed by M11, then M7 with
    its own update (M12). Stage order is semantic.

    Geometry is looked at once: the parts of R that meet (M10, reused by M5)
    and the pairs that qualify for M3, M4, M6 and M7. After that a stage is a
    join of ids: its pairs, less what earlier stages claimed. The pools are read
    in every stage, so callers pass written ones."""
    left = _Left(R, B)
    of_r = M.dissolve(R, "cleabs", "geometrie_enveloppe", p)
    left.claim(1, M.unmatchable(R, B, p, of_r))
    near_r = left.rows_r()
    left.claim(2, M.semantic(near_r, left.rows_b(), p))
    found = M.qualifying_pairs(cut_lineage(near_r), cut_lineage(left.rows_b()), p)
    for stage in (3, 4, 5, 6):
        X = (M.dissolved(left.rows_r(), left.rows_b(), p, of_r) if stage == 5
             else M.claims_of(left.pairs(found, stage), M.LABELS[M.PAIR_STAGES[stage]]))
        left.claim(stage, X)
    after = M.Pools(left.rows_r(), left.rows_b(), *_treated(R, B, left.all()))
    X = cut_lineage(M.claims_of(left.pairs(found, 7), M.LABELS[M.PAIR_STAGES[7]]).withColumn("stage", F.lit(7)))
    pools = M.update_pools_balcony(after, X.drop("stage"), compat_delete)
    return CascadeResult(M.Pools(pools.R, pools.B, cut_lineage(pools.RT), pools.BT), left.all().unionByName(X))


def _treated(R: DataFrame, B: DataFrame, X: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K4: RT and BT after all updates of M11, from all claims at once (a row
    is claimed in one stage only)."""
    RT, BT = M.empty_treated(R, B)
    xb = X.select(F.explode(to_array("liens_vers_batiment")).alias("cleabs"), "traitement", "identifiant_rnb").distinct()
    bt = xb.join(B.select("cleabs", "geometrie").filter(F.col("geometrie").isNotNull()), "cleabs")
    rt = X.join(R.filter(F.col("geometrie").isNotNull()), "identifiant_rnb").select(*RT.columns).distinct()
    return rt, bt.select(*BT.columns)


def _distinct_on(df: DataFrame, key: str) -> DataFrame:
    """``DISTINCT ON (key)`` with a deterministic pick: the smallest
    ``identifiant_rnb``, a NULL one only if there is no other."""
    cols = [c for c in df.columns if c != key]
    rank = F.struct(F.col("identifiant_rnb").isNull(), F.coalesce("identifiant_rnb", F.lit("")))
    return (df.groupBy(key).agg(F.min_by(F.struct(*cols), rank).alias("_r"))
            .select(key, "_r.*"))


def changed_registry(link_rows: DataFrame, as_of: str, days: int = 2) -> DataFrame:
    """O1 R selection: live rows created or modified in the last ``days``."""
    since = days_before(as_of, days)
    return link_rows.filter(~F.col("gcms_detruit") & (
        (F.col("gcms_date_creation") >= since) | (F.col("gcms_date_modification") >= since)))


def _in_polygon_buffer(distance: float):
    """The exact test of ``compat_buffer``, where the buffer is the inscribed
    32-gon the source builds round the point: nearer than its inner radius is
    in, farther than ``distance`` out, and only the thin annulus between goes
    to a polygon test."""
    inner = distance * math.cos(math.pi / 32)

    def test(rows: DataFrame) -> DataFrame:
        keep = ["b_id", "p_id", "px", "py"] if "p_id" in rows.columns else ["b_id", "px", "py"]
        pairs = cut_lineage(rows.withColumn("pdist", point_distance("px", "py", "geom")).where(F.col("pdist") <= distance))
        at = lambda i: [F.col(c) + distance * f(F.lit(2 * math.pi) * (i % 32) / 32) for c, f in (("px", F.cos), ("py", F.sin))]
        sides = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(
            *[v.alias(n) for v, n in zip(at(i) + at(i + 1), ("ax", "ay", "bx", "by"), strict=True)]))
        ring = pairs.where(F.col("pdist") > inner).withColumn("l_edges", sides).withColumn("r_edges", edges("geom"))
        return (pairs.where(F.col("pdist") <= inner).select(*keep)
                .unionByName(edge_measures(ring, ["hits"], keep).where("hits").select(*keep)))
    return test


def _near(rows: DataFrame, buildings: DataFrame, distance: float, compat_buffer: bool):
    points = rows.select(F.col("cleabs").alias("p_id"), F.col("geometrie.x").alias("px"), F.col("geometrie.y").alias("py"))
    shapes = buildings.select(F.col("cleabs").alias("b_id"), F.col("geometrie").alias("geom"), "xmin", "ymin", "xmax", "ymax")
    if not compat_buffer:
        return Near(points, shapes, distance), within(distance)
    return Near(points, shapes, distance, distance * math.cos(math.pi / 32)), _in_polygon_buffer(distance)


def near_registry_points(R: DataFrame, buildings: DataFrame, distance: float,
                         p: M.Params = M.Params(), compat_buffer: bool = False) -> DataFrame:
    """Live buildings within ``distance`` of a registry point (the
    union of point buffers only removes duplicates)."""
    live = buildings.filter(~F.col("gcms_detruit"))
    near, exact = _near(R, live, distance, compat_buffer)
    return live.join(near.buildings(exact).withColumnRenamed("b_id", "cleabs"), "cleabs", "left_semi")


def registry_near_buildings(link_rows: DataFrame, B: DataFrame, distance: float,
                            p: M.Params = M.Params(), compat_buffer: bool = False) -> DataFrame:
    """Live link rows whose point is within ``distance`` of a building."""
    live = link_rows.filter(~F.col("gcms_detruit"))
    near, exact = _near(live, B, distance, compat_buffer)
    return live.join(near.near_points(exact).withColumnRenamed("p_id", "cleabs"), "cleabs", "left_semi")


def job_registry_change(link_rows: DataFrame, link_table: DataFrame, buildings: DataFrame,
                        as_of: str, p: M.Params = M.Params(), compat_delete: bool = False,
                        compat_buffer: bool = False):
    """O1: rows changed in the last 2 days → buildings within 100 m →
    cascade → F1 merge with the existing links. ``link_rows`` and
    ``buildings`` are pool-shaped (parsed + measured)."""
    R = cut_lineage(_distinct_on(changed_registry(link_rows, as_of), "cleabs").select(*M.R_COLS, *M.MEAS))
    B = cut_lineage(near_registry_points(R, buildings, 100.0, p, compat_buffer).select("cleabs", "geometrie", *M.MEAS))
    res = run_cascade(R, B, p, compat_delete)
    return merge_links_with_labels(res.pools.RT, link_table), res


def job_topo_created(link_rows: DataFrame, link_table: DataFrame, buildings: DataFrame,
                     as_of: str, p: M.Params = M.Params(), enforce_weekday: bool = False,
                     compat_delete: bool = False, compat_buffer: bool = False):
    """O2: buildings created in the last 8 days → registry rows whose point
    is within 100 m → cascade → F2. The source runs only on Fridays;
    ``enforce_weekday`` keeps that gate (returns ``None`` otherwise)."""
    if enforce_weekday and not on_weekday(as_of, 5):
        return None, None
    since = days_before(as_of, 8)
    B = cut_lineage(buildings.filter(~F.col("gcms_detruit") & (F.col("gcms_date_creation") >= since))
                    .select("cleabs", "geometrie", *M.MEAS).distinct())
    R = cut_lineage(_distinct_on(registry_near_buildings(link_rows, B, 100.0, p, compat_buffer), "cleabs")
                    .select(*M.R_COLS, *M.MEAS))
    res = run_cascade(R, B, p, compat_delete)
    return merge_links(res.pools.RT, link_table), res


def job_topo_destroyed(link_table: DataFrame, buildings: DataFrame, as_of: str,
                       enforce_weekday: bool = False) -> DataFrame | None:
    """O3: lists without the buildings destroyed in the last 8 days. The
    source runs only on Thursdays; ``enforce_weekday`` keeps that gate
    (returns ``None`` otherwise)."""
    if enforce_weekday and not on_weekday(as_of, 4):
        return None
    return drop_destroyed_links(link_table, destroyed_since(buildings, as_of, 8))
