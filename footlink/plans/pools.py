"""Pool builders for real tables: parse and measure once, materialise.

``links``: the link table (typed columns, geometries as (E)WKT or hex (E)WKB text);
``buildings``: the typed building table (``geometrie`` parsed by
``typed_buildings`` or still text). Filters that do not need geometry
(destroyed flag) run before parsing, so they reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.session import cut_lineage


def _geom(df: DataFrame, col: str):
    t = dict(df.dtypes)[col]
    return G.read_geometry(col) if t == "string" else F.col(col)


def registry_pool(links: DataFrame) -> DataFrame:
    r = links.select("cleabs", "identifiant_rnb",
                     G.read_point("geometrie").alias("geometrie"),
                     _geom(links, "geometrie_enveloppe").alias("geometrie_enveloppe"),
                     F.col("informations_rnb").cast("string").alias("informations_rnb"),
                     "gcms_detruit", "gcms_date_creation", "gcms_date_modification")
    return cut_lineage(G.with_measures(r, "geometrie_enveloppe"))


def topo_pool(buildings: DataFrame, live_only: bool = True) -> DataFrame:
    b = buildings.filter(~F.col("gcms_detruit")) if live_only else buildings
    b = b.select("cleabs", _geom(b, "geometrie").alias("geometrie"), "gcms_detruit", "gcms_date_creation")
    return cut_lineage(G.with_measures(b, "geometrie"))


def link_envelopes(links: DataFrame) -> DataFrame:
    """The link table with its envelope parsed (for the moved flag, W7)."""
    return links.withColumn("geometrie_enveloppe", _geom(links, "geometrie_enveloppe"))
