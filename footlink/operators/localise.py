"""Localised work tables W2 and W4 with W5-W8: the latest registry
changes placed in their territory, projected to its system, snapped to the
0.1 m grid, with the informations text and the moved-building flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions import crs
from footlink.functions.geometry import from_wkt, point_from_wkt, with_measures
from footlink.operators import worktables as W
from footlink.operators.precision import GRID, reduce_precision
from footlink.operators.spatial import edge_measures
from footlink.session import cut_lineage
from footlink.sources.territories import locate

def localise(last_changes: DataFrame, terr: DataFrame, grid: float = GRID) -> DataFrame:
    """W8 + W5: territory lookup on the lon/lat point, then point and shape
    projected to the territory's system (SRID reset to 0) and put on the
    grid, the shape as a valid geometry (G5)."""
    rows = (last_changes.withColumn("_pt", point_from_wkt("point"))
            .withColumn("_shape", from_wkt("shape")))
    located = locate(rows, "_pt", terr)
    placed = (located.withColumn("geometrie", crs.transform_point("_pt", grid=grid))
              .withColumn("geometrie_enveloppe", crs.transform_geom("_shape"))
              .withColumn("informations_rnb", W.informations_json(located)).drop("_pt", "_shape"))
    return reduce_precision(placed, "geometrie_enveloppe", grid)


def moved_flag(rows: DataFrame, key: list[str], new: str, old: str, tolerance: float = 1.0) -> DataFrame:
    """``'to_link'`` when the new envelope is farther than ``tolerance``
    from the old one, else ``''`` (also when the old one is NULL, as the
    source's NULL test falls through to ``''``)."""
    have = rows.filter(F.col(new).isNotNull() & F.col(old).isNotNull())
    a = with_measures(have.select(*key, F.col(new).alias("_n"), F.col(old).alias("_o")), "_n", "l_")
    a = with_measures(a, "_o", "r_")
    near = edge_measures(a, ["dist"], key).filter(F.col("dist") <= tolerance).select(*key, F.lit(True).alias("_near"))
    far = F.col(new).isNotNull() & F.col(old).isNotNull() & F.col("_near").isNull()
    return (rows.join(near, key, "left")
            .withColumn("commentaire_centralise", F.when(far, F.lit("to_link")).otherwise(F.lit(""))).drop("_near"))


def changed_to_update(last_changes: DataFrame, link_table: DataFrame, terr: DataFrame) -> DataFrame:
    """Update list ``(cleabs, gcms_fingerprint, identifiant_rnb,
    geometrie, geometrie_enveloppe, informations_rnb, status, event_type,
    parent_buildings, commentaire_centralise)`` plus the territory ``srid``."""
    loc = localise(W.update_filter(last_changes), terr)
    lt = link_table.select("cleabs", "identifiant_rnb", F.col("geometrie_enveloppe").alias("_old"))
    j = loc.join(lt, loc["rnb_id"] == lt["identifiant_rnb"])
    j = j.select("cleabs", F.lit(None).cast("string").alias("gcms_fingerprint"),
                 F.col("rnb_id").alias("identifiant_rnb"), "geometrie", "geometrie_enveloppe",
                 "informations_rnb", "status", "event_type", "parent_buildings", "srid", "_old")
    # materialise once: the flag reads these rows twice (kernel input and
    # the join back), and a work table is written here in the source too
    # (cleabs, srid) need not be unique (W8 fans out), so rows are numbered
    # before they are written
    j = cut_lineage(j.withColumn("_row", F.monotonically_increasing_id()))
    return moved_flag(j, ["_row"], "geometrie_enveloppe", "_old").drop("_old", "_row")


def new_to_insert(last_changes: DataFrame, link_table: DataFrame, terr: DataFrame) -> DataFrame:
    """Insert list ``(identifiant_rnb, geometrie, geometrie_enveloppe,
    informations_rnb, status, event_type, parent_buildings)`` + ``srid``."""
    loc = localise(W.insert_filter(last_changes, link_table), terr)
    return loc.select(F.col("rnb_id").alias("identifiant_rnb"), "geometrie", "geometrie_enveloppe",
                      "informations_rnb", "status", "event_type", "parent_buildings", "srid")
