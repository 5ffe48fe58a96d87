"""Box fixture from ``part``: one lot per part key, a registry footprint
and a topographic footprint per lot whose relation is set by the case
``c = k % 10`` (see FIXTURES.md, B1):

==  =======================================  =======================
c   registry (R)                             topographic (B)
==  =======================================  =======================
0   box                                      same box
1   box                                      shifted 0.4 m in x
2   box                                      same box, one extra collinear vertex
3   two halves (ids k and kb)                full box
4   box                                      grown 3 m on each side
5   box                                      4×4 at the right edge (2 m² overlap)
6   box                                      10 m to the right
7   box                                      none
8   none                                     box
9   box, ``ext_ids`` names B                 10 m to the right
==  =======================================  =======================

Lots sit on a 64 m grid, so no two lots are within 20 m. Geometry is
written as WKT text (B as ``MULTIPOLYGON Z``) and parsed by the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.sources.fixtures import AS_OF, table


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("k"), (k % 10).cast("int").alias("c"),
        (F.lit(64.0) * (k % 100)).alias("x0"), (F.lit(64.0) * F.floor(k / 100)).alias("y0"),
        (F.lit(8.0) + k % 7).alias("w"), (F.lit(6.0) + F.col("p_size") % 9).alias("h"))


def _num(c: Column) -> Column:
    return c.cast("string")


def _ring(pts: list[tuple[Column, Column]], z: bool = False) -> Column:
    parts = []
    for i, (x, y) in enumerate(pts + [pts[0]]):
        if i:
            parts.append(F.lit(", "))
        parts += [_num(x), F.lit(" "), _num(y)] + ([F.lit(" 0")] if z else [])
    return F.concat(F.lit("(("), *parts, F.lit("))"))


def _rect(x0, y0, x1, y1, z=False):
    return _ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)], z)


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link-table rows for the registry footprints (A3 columns used by the
    jobs): ``cleabs``, ``identifiant_rnb``, point (box centre), envelope,
    ``informations_rnb``, existing links, state and dates."""
    lt = lots(spark, sf_dir).filter(F.col("c") != 8)
    x0, y0, w, h, k, c = (F.col(n) for n in ("x0", "y0", "w", "h", "k", "c"))
    half = x0 + w / 2
    pieces = F.when(c == 3, F.array(
        F.struct(F.lit("").alias("sfx"), x0.alias("a"), half.alias("b")),
        F.struct(F.lit("b").alias("sfx"), half.alias("a"), (x0 + w).alias("b")),
    )).otherwise(F.array(F.struct(F.lit("").alias("sfx"), x0.alias("a"), (x0 + w).alias("b"))))
    ex = lt.withColumn("p", F.explode(pieces))
    a, b = F.col("p.a"), F.col("p.b")
    kid = F.concat(k.cast("string"), F.col("p.sfx"))
    ext = F.when(c == 9, F.concat(F.lit('[{"id": "B'), k.cast("string"), F.lit('", "source": "bdtopo"}]'))) \
           .when(c == 1, F.lit('[{"id": "NOPE", "source": "bdtopo"}]')).otherwise(F.lit("[]"))
    info = F.concat(F.lit('{"ext_ids": '), ext, F.lit(', "created_at": "", "updated_at": "", "identifiants_ban": []}'))
    return ex.select(
        F.concat(F.lit("L"), kid).alias("cleabs"),
        F.concat(F.lit("R"), kid).alias("identifiant_rnb"),
        F.concat(F.lit("POINT("), _num((a + b) / 2), F.lit(" "), _num(y0 + h / 2), F.lit(")")).alias("point_wkt"),
        F.concat(F.lit("MULTIPOLYGON("), _rect(a, y0, b, y0 + h), F.lit(")")).alias("shape_wkt"),
        info.alias("informations_rnb"),
        F.when(k % 3 == 0, F.concat(F.lit("OLD"), k.cast("string"))).alias("liens_vers_batiment"),
        F.lit(False).alias("gcms_detruit"),
        F.date_sub(F.lit(AS_OF).cast("date"), 1).cast("timestamp_ntz").alias("gcms_date_creation"),
        F.lit(None).cast("timestamp_ntz").alias("gcms_date_modification"),
    )


def topo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building-table rows for the topographic footprints: ``cleabs``,
    ``MULTIPOLYGON Z`` text, state and dates."""
    lt = lots(spark, sf_dir).filter(F.col("c") != 7)
    x0, y0, w, h, k, c = (F.col(n) for n in ("x0", "y0", "w", "h", "k", "c"))
    x1, y1 = x0 + w, y0 + h
    ring = (F.when(c == 1, _rect(x0 + 0.4, y0, x1 + 0.4, y1, True))
            .when(c == 2, _ring([(x0, y0), (x0 + w / 2, y0), (x1, y0), (x1, y1), (x0, y1)], True))
            .when(c == 4, _rect(x0 - 3, y0 - 3, x1 + 3, y1 + 3, True))
            .when(c == 5, _rect(x1 - 0.5, y0 + 1, x1 + 3.5, y0 + 5, True))
            .when((c == 6) | (c == 9), _rect(x1 + 10, y0, x1 + 10 + w, y1, True))
            .otherwise(_rect(x0, y0, x1, y1, True)))
    return lt.select(
        F.concat(F.lit("B"), k.cast("string")).alias("cleabs"),
        F.concat(F.lit("MULTIPOLYGON Z ("), ring, F.lit(")")).alias("geometrie_wkt"),
        F.lit(False).alias("gcms_detruit"),
        F.date_sub(F.lit(AS_OF).cast("date"), 1).cast("timestamp_ntz").alias("gcms_date_creation"),
    )


def registry_pool(rows: DataFrame) -> DataFrame:
    """Parse and measure registry rows into the R pool layout."""
    r = rows.select("cleabs", "identifiant_rnb",
                    G.point_from_wkt("point_wkt").alias("geometrie"),
                    G.from_wkt("shape_wkt").alias("geometrie_enveloppe"),
                    "informations_rnb", "gcms_detruit", "gcms_date_creation", "gcms_date_modification")
    return G.with_measures(r, "geometrie_enveloppe")


def topo_pool(rows: DataFrame) -> DataFrame:
    """Parse (forcing 2-D) and measure building rows into the B pool."""
    b = rows.select("cleabs", G.from_wkt("geometrie_wkt").alias("geometrie"),
                    "gcms_detruit", "gcms_date_creation")
    return G.with_measures(b, "geometrie")
