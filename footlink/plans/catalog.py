"""Registered queries: one per operator family of the inventory.

Each query takes ``(spark, sf_dir)``, reads the generated tables (through
the fixture views) and returns a DataFrame whose column names match the
DuckDB oracle in :mod:`footlink.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.functions import casts as T
from footlink.functions.dates import range_start
from footlink.operators import constraints as C
from footlink.operators import diff as D
from footlink.operators import links as LK
from footlink.operators import upsert as U
from footlink.operators import worktables as W
from footlink.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _latest(spark, sf_dir):
    return D.latest_per_key(FX.diff(spark, sf_dir))


# -- D: change feed -----------------------------------------------------------

@query
def diff_range_start(spark, sf_dir):
    """D1 over every feed row."""
    d = FX.diff(spark, sf_dir)
    return d.select("event_id", "rnb_id",
                    F.unix_micros(range_start("sys_period")).alias("range_start_us"))


@query
def diff_latest(spark, sf_dir):
    """Newest row per id (flagship)."""
    return _latest(spark, sf_dir).select(
        "rnb_id", "event_id", "action", "status", "is_active",
        F.unix_micros("updated_at").alias("updated_at_us"), "first_pos")


@query
def diff_latest_ties(spark, sf_dir):
    """D2 on a feed with equal dates: the first row seen wins."""
    return D.latest_per_key(FX.diff_ties(spark, sf_dir)).select(
        "rnb_id", "extra", F.unix_micros("updated_at").alias("updated_at_us"), "first_pos")


@query
def diff_removed(spark, sf_dir):
    """Removal set."""
    return D.removal_set(_latest(spark, sf_dir))


@query
def diff_recalc(spark, sf_dir):
    """Ids to (re)match."""
    latest = _latest(spark, sf_dir)
    return D.recalc_set(latest, D.removal_set(latest))


@query
def diff_dates(spark, sf_dir):
    """created/updated split on the latest rows."""
    return D.created_updated(_latest(spark, sf_dir)).select(
        "rnb_id", "action", "created_at", "updated_at")


@query
def dup_keys(spark, sf_dir):
    """Ids seen more than once in the raw feed."""
    return D.duplicate_keys(FX.diff(spark, sf_dir)).select("rnb_id", "n")


@query
def diff_upsert(spark, sf_dir):
    """K8: stock = latest of the first half of the month, changes = latest
    of the second half; changed rows replace stock rows."""
    feed = FX.diff(spark, sf_dir)
    cut = F.lit("2024-01-16")
    start = F.substring("sys_period", 3, 10)
    stock = D.latest_per_key(feed.filter(start < cut))
    changes = D.latest_per_key(feed.filter(start >= cut))
    return U.with_origin(stock, changes).select("rnb_id", "event_id", "origin")


# -- T / C: typing and constraints -------------------------------------------

@query
def typed_cast(spark, sf_dir):
    """T1-T6 over the all-text staging rows; timestamps, dates and
    decimals are rendered as text for a type-neutral comparison."""
    s = FX.diff_text(spark, sf_dir)
    return s.select(
        "cleabs",
        T.tri_bool("construction_legere").alias("construction_legere"),
        T.tri_bool("gcms_detruit").alias("gcms_detruit"),
        F.date_format(T.blank_to_null_cast("gcms_date_creation", "timestamp_ntz"),
                      "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("gcms_date_creation"),
        T.blank_to_null_cast("date_d_apparition", "date").cast("string").alias("date_d_apparition"),
        T.json_or_null("source_detaillee").alias("source_detaillee"),
        T.numeric("hauteur", 6, 2).cast("string").alias("hauteur"),
        T.blank_to_null_cast("nombre_de_logements", "int").alias("nombre_de_logements"),
        T.text_or_null("nom").alias("nom"),
        T.text_or_null_quoted("metadonnees_unification").alias("metadonnees_unification"),
    )


@query
def key_violations(spark, sf_dir):
    """C1-C3 over the link table."""
    lt = FX.link_table(spark, sf_dir)
    return (C.unique_violations(lt, ["identifiant_rnb"], "unique:identifiant_rnb")
            .unionByName(C.unique_violations(lt, ["gcms_numrec", "gcms_territoire"],
                                             "unique:gcms_numrec,gcms_territoire"))
            .unionByName(C.not_null_violations(lt, ["identifiant_rnb", "gcms_territoire", "gcms_numrec"])))


# -- W: work tables -----------------------------------------------------------

@query
def work_deactivated(spark, sf_dir):
    """Removal set ⋈ link table."""
    return W.deactivated_to_delete(D.removal_set(_latest(spark, sf_dir)), FX.link_table(spark, sf_dir))


@query
def work_demolished(spark, sf_dir):
    """Demolished updates ⋈ link table."""
    return W.demolished_to_delete(_latest(spark, sf_dir), FX.link_table(spark, sf_dir))


# -- E / F / O3: link lists ---------------------------------------------------

@query
def links_explode(spark, sf_dir):
    """E1 and E2 side by side over every link list."""
    lk = FX.links(spark, sf_dir)
    e1 = LK.explode_strict(lk, "liens_vers_batiment", "lien").select("cleabs", "lien", F.lit("E1").alias("kind"))
    e2 = LK.explode_regexp(lk, "liens_vers_batiment", "lien").select("cleabs", "lien", F.lit("E2").alias("kind"))
    return e1.unionByName(e2)


@query
def links_merge_labels(spark, sf_dir):
    """merge new links and labels into existing lists."""
    return LK.merge_links_with_labels(FX.treated(spark, sf_dir), FX.links(spark, sf_dir))


@query
def links_merge(spark, sf_dir):
    """merge new links into existing lists."""
    return LK.merge_links(FX.treated(spark, sf_dir), FX.links(spark, sf_dir))


@query
def links_drop_destroyed(spark, sf_dir):
    """O3: rebuild lists naming buildings destroyed in the last 8 days."""
    gone = LK.destroyed_since(FX.destroyed_buildings(spark, sf_dir), FX.AS_OF, 8)
    return LK.drop_destroyed_links(FX.links(spark, sf_dir), gone)


# -- G / J / M: geometry, spatial joins, matching stages ----------------------

from footlink.operators import matching as M  # noqa: E402
from footlink.operators import spatial as S  # noqa: E402
from footlink.plans import jobs as JB  # noqa: E402
from footlink.sources import boxes as BX  # noqa: E402
from footlink.sources import limits as LM  # noqa: E402
from footlink.sources import shapes as SH  # noqa: E402


def _pools(spark, sf_dir):
    """Parse and measure both footprint tables once and materialise them:
    every later join reads plain columns (bbox, flat coordinates, measures)
    instead of re-deriving them from text in pushed-down filters."""
    from footlink.session import cut_lineage
    R = cut_lineage(BX.registry_pool(BX.registry_rows(spark, sf_dir)))
    B = cut_lineage(BX.topo_pool(BX.topo_rows(spark, sf_dir)))
    return R, B


def _r4(c):
    return F.round(F.col(c), 4)


@query
def geom_measures(spark, sf_dir):
    """Parse (E)WKT and measure every footprint."""
    R, B = _pools(spark, sf_dir)
    cols = lambda df, key: df.select(F.col(key).alias("id"), _r4("area").alias("area"),
                                     _r4("perim").alias("perim"), F.col("npts").cast("long").alias("npts"),
                                     _r4("xmin").alias("xmin"), _r4("ymin").alias("ymin"),
                                     _r4("xmax").alias("xmax"), _r4("ymax").alias("ymax"))
    return cols(R, "cleabs").unionByName(cols(B, "cleabs"))


@query
def pairs_intersect(spark, sf_dir):
    """J5 + G10 + G11: every intersecting (registry, building) pair with the
    area of the intersection."""
    R, B = _pools(spark, sf_dir)
    left, right = S.side(R, "l_", "cleabs"), S.side(B, "r_", "cleabs")
    m = S.pair_measures(S.candidate_pairs(left, right), left, right, ["hits", "inter"], ["l_id", "r_id"]).filter("hits")
    return m.select(F.col("l_id").alias("r_key"), F.col("r_id").alias("b_key"), _r4("inter").alias("inter"))


@query
def pairs_within_20(spark, sf_dir):
    """J6 + G12: every (registry, building) pair within 20 m, with distance."""
    R, B = _pools(spark, sf_dir)
    left, right = S.side(R, "l_", "cleabs"), S.side(B, "r_", "cleabs")
    m = S.pair_measures(S.candidate_pairs(left, right, 20.0), left, right, ["dist"],
                        ["l_id", "r_id"]).filter(F.col("dist") <= 20.0)
    return m.select(F.col("l_id").alias("r_key"), F.col("r_id").alias("b_key"), _r4("dist").alias("dist"))


def _stage(fn):
    def run(spark, sf_dir):
        R, B = _pools(spark, sf_dir)
        return fn(R.select(*M.R_COLS, *M.MEAS), B.select("cleabs", "geometrie", *M.MEAS))
    return run


QUERIES["match_equal"] = _stage(M.equal)
QUERIES["match_identical"] = _stage(M.identical)
QUERIES["match_similar"] = _stage(lambda R, B: M.similar(R, B, same_npoints=True))
QUERIES["match_similar_nbp"] = _stage(lambda R, B: M.similar(R, B, same_npoints=False))
QUERIES["match_dissolved"] = _stage(M.dissolved)
QUERIES["match_contained"] = _stage(M.contained)


def _shape_pools(spark, sf_dir):
    from footlink.session import cut_lineage
    return cut_lineage(SH.registry_pool(spark, sf_dir)), cut_lineage(SH.topo_pool(spark, sf_dir))


@query
def match_contained_shapes(spark, sf_dir):
    """M6 on concave, holed, two-part and rotated envelopes."""
    return M.contained(*_shape_pools(spark, sf_dir))


@query
def pairs_shapes(spark, sf_dir):
    """G10, G11 on the same shapes."""
    R, B = _shape_pools(spark, sf_dir)
    left, right = S.side(R, "l_", "identifiant_rnb"), S.side(B, "r_", "cleabs")
    m = S.pair_measures(S.candidate_pairs(left, right), left, right, ["hits", "inter"], ["l_id", "r_id"]).filter("hits")
    return m.select(F.col("l_id").alias("r_key"), F.col("r_id").alias("b_key"), F.round("inter", 3).alias("inter"))


QUERIES["match_balcony"] = _stage(M.balcony)
QUERIES["match_point"] = _stage(M.point_in_building)
QUERIES["match_semantic"] = _stage(M.semantic)
QUERIES["unmatchable"] = _stage(M.unmatchable)


@query
def candidates_100m(spark, sf_dir):
    """Live buildings within 100 m of a registry point."""
    R, B = _pools(spark, sf_dir)
    return JB.near_registry_points(R, B, 100.0).select("cleabs")


@query
def candidates_registry_100m(spark, sf_dir):
    """Live registry rows whose point is within 100 m of a building."""
    R, B = _pools(spark, sf_dir)
    return JB.registry_near_buildings(R, B, 100.0).select("cleabs")


def _limit_pools(spark, sf_dir):
    from footlink.session import cut_lineage
    return cut_lineage(LM.registry_pool(spark, sf_dir)), cut_lineage(LM.topo_pool(spark, sf_dir))


@query
def near_limit_100m(spark, sf_dir):
    """M14 with buildings on both sides of 100 m, beside edges and corners."""
    return JB.near_registry_points(*_limit_pools(spark, sf_dir), 100.0).select("cleabs")


@query
def near_limit_500m(spark, sf_dir):
    """M13 on the same lots, with buildings on both sides of 500 m."""
    return JB.near_registry_points(*_limit_pools(spark, sf_dir), 500.0).select("cleabs")


@query
def near_limit_registry_100m(spark, sf_dir):
    """M15 on the same lots: rows whose point is on either side of 100 m."""
    return JB.registry_near_buildings(*_limit_pools(spark, sf_dir), 100.0).select("cleabs")


def _link_table(spark, sf_dir):
    return BX.registry_rows(spark, sf_dir).select("cleabs", "liens_vers_batiment")


@query
def job_registry_change(spark, sf_dir):
    """O1 end to end."""
    R, B = _pools(spark, sf_dir)
    out, _ = JB.job_registry_change(R, _link_table(spark, sf_dir), B, FX.AS_OF)
    return out


@query
def job_topo_created(spark, sf_dir):
    """O2 end to end (M15, cascade, F2)."""
    R, B = _pools(spark, sf_dir)
    out, _ = JB.job_topo_created(R, _link_table(spark, sf_dir), B, FX.AS_OF)
    return out


@query
def stage_counts(spark, sf_dir):
    """M17 re-aimed: claims per stage of the O1 cascade."""
    R, B = _pools(spark, sf_dir)
    _, res = JB.job_registry_change(R, _link_table(spark, sf_dir), B, FX.AS_OF)
    return res.claims.groupBy("stage", "traitement").agg(F.count(F.lit(1)).alias("n"))


@query
def reduce_precision(spark, sf_dir):
    """G5 on shapes thinner than the grid in places: parts, area and the
    vertices of every ring, in grid steps."""
    from footlink.functions import geometry as G
    from footlink.operators import precision
    from footlink.sources.thin import thin_shapes
    g = precision.reduce_precision(thin_shapes(spark, sf_dir), "geometrie")
    steps = lambda v: F.floor(v * 10 + 0.5).cast("string")
    point = lambda p: F.concat_ws(",", steps(p.getField("x")), steps(p.getField("y")))
    ring = lambda r: F.array_join(F.transform(F.slice(r, 1, F.size(r) - 1), point), " ")
    text = F.array_join(F.transform("geometrie", lambda p: F.array_join(F.transform(p, ring), "/")), "|")
    return g.select("k", F.size("geometrie").alias("parts"), F.round(G.area("geometrie"), 4).alias("area"), text.alias("rings"))


# -- W2/W4-W8: localised work tables ------------------------------------------

from footlink.operators import localise as LO  # noqa: E402
from footlink.sources.territories import territories as _territories  # noqa: E402


def _last_changes(spark, sf_dir):
    """The ``rnb_last_changes`` table: latest rows with D7 dates, blanks
    read back as NULL (K1 loads unquoted empty fields as NULL)."""
    lc = D.created_updated(_latest(spark, sf_dir))
    return lc.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c)
                       for c, t in lc.dtypes])


@query
def work_changed(spark, sf_dir):
    """W2 (+W5-W8): localised update list with the moved flag."""
    out = LO.changed_to_update(_last_changes(spark, sf_dir), FX.link_table_geo(spark, sf_dir),
                               _territories(spark))
    return out.drop("geometrie", "geometrie_enveloppe")


@query
def work_new(spark, sf_dir):
    """W4 (+W5, W6, W8): localised insert list."""
    out = LO.new_to_insert(_last_changes(spark, sf_dir), FX.link_table(spark, sf_dir), _territories(spark))
    return out.drop("geometrie", "geometrie_enveloppe")


# -- S / K / D8: CSV feed end to end, staging load ----------------------------

import uuid as _uuid  # noqa: E402

from footlink.functions.geometry import npoints as _npoints  # noqa: E402
from footlink.operators.constraints import srid_violations as _srid_violations  # noqa: E402
from footlink.plans import sync as SY  # noqa: E402
from footlink.session import ensure_checkpoint_dir as _ckpt  # noqa: E402
from footlink.sources import feed as FD  # noqa: E402
from footlink.sources import sinks as SK  # noqa: E402


def _scratch(spark, name):
    return f"{_ckpt(spark).rstrip('/')}/{name}-{_uuid.uuid4().hex}"


@query
def sync_csv(spark, sf_dir):
    """S1 + D8 + K1/K2/K7: the feed exported as CSV (quotes doubled), read
    back with the feed scan, synced, published and read from the pointer."""
    src = _scratch(spark, "feed")
    SK.export_csv(FX.diff(spark, sf_dir).drop("pos"), src)
    out = _scratch(spark, "sync")
    last, removed = SY.sync_from_file(spark, src, out, run_date="2024-02-01")
    flag = removed.select("rnb_id", F.lit(True).alias("removed"))
    return (last.join(flag, "rnb_id", "left")
            .select("rnb_id", "event_id", "action", "created_at", "updated_at",
                    F.coalesce("removed", F.lit(False)).alias("removed")))


@query
def links_load(spark, sf_dir):
    """S3: the link CSV with bad values at fixed places, good rows typed and
    refused ones with their first problem."""
    path = _scratch(spark, "links")
    SK.export_csv(FX.link_rows(spark, sf_dir), path)
    good, bad = FD.split_link_rows(spark, path)
    p = F.col("problems")[0]
    null = F.lit(None).cast("string")
    return (good.select("cleabs", "liens_vers_batiment", "gcms_detruit",
                        F.date_format("gcms_date_creation", "yyyy-MM-dd").alias("created"), "gcms_numrec",
                        "parent_buildings", null.alias("refused"), null.alias("reason"), F.lit(0).alias("problems"))
            .unionByName(bad.select(
                null.alias("cleabs"), null.alias("liens_vers_batiment"), F.lit(None).cast("boolean").alias("gcms_detruit"),
                null.alias("created"), F.lit(None).cast("int").alias("gcms_numrec"), null.alias("parent_buildings"),
                F.concat_ws("=", p.getField("column"), p.getField("value")).alias("refused"),
                p.getField("reason").alias("reason"), F.size("problems").alias("problems"))))


@query
def schema_violations(spark, sf_dir):
    """Every declared key, NOT NULL and SRID of the link table, one scan."""
    return C.schema_violations(FX.link_rows(spark, sf_dir), C.DECLARED["links"])


@query
def wkb_load(spark, sf_dir):
    """G1: all boxes written as hex EWKB (both byte orders, with and without
    SRID and Z) and read back."""
    from footlink.functions import geometry as G
    from footlink.functions import wkb
    r = BX.registry_rows(spark, sf_dir).select(F.col("cleabs").alias("id"), F.col("shape_wkt").alias("w"))
    b = BX.topo_rows(spark, sf_dir).select(F.col("cleabs").alias("id"), F.col("geometrie_wkt").alias("w"))
    k = F.regexp_extract("id", r"([0-9]+)", 1).cast("long")
    g = r.unionByName(b).select("id", G.from_wkt("w").alias("g"), k.alias("k"))
    text = wkb.to_hex("g", F.when(F.col("k") % 3 == 0, 2154).when(F.col("k") % 3 == 1, 4326), F.col("k") % 5 < 2,
                      F.col("k") % 2 == 0)
    # The exchange keeps writer and reader apart: neither is folded into the other.
    t = g.select("id", text.alias("hex")).repartition("id")
    back = t.select("id", "hex", G.read_geometry("hex").alias("g"), G.read_srid("hex").alias("srid"))
    back = back.select("id", F.length("hex").cast("long").alias("hex_chars"), "srid", "g")
    xy = lambda field: F.flatten(F.transform(F.flatten("g"), lambda ring: F.transform(ring, lambda p: p.getField(field))))
    return back.select("id", "hex_chars", "srid", F.size(xy("x")).cast("long").alias("npts"),
                       F.round(G.area("g"), 4).alias("area"),
                       F.array_min(xy("x")).alias("xmin"), F.array_max(xy("x")).alias("xmax"),
                       F.array_min(xy("y")).alias("ymin"), F.array_max(xy("y")).alias("ymax"))


def _staging(spark, sf_dir):
    """49 text columns derived from ``events`` (blanks and spellings as in
    ``diff_text``; geometry as lon/lat WKT, every 5th with an SRID prefix,
    every 11th blank)."""
    t = FX.diff_text(spark, sf_dir)
    ev = FX.feed_lonlat(FX.table(spark, sf_dir, "events")).select(
        F.concat(F.lit("BATIMENT"), F.lpad(F.col("event_id").cast("string"), 16, "0")).alias("cleabs"),
        (F.col("event_id") % 5).alias("m5"), (F.col("event_id") % 11).alias("m11"),
        FX.square_wkt(F.col("_lon"), F.col("_lat")).alias("wkt"))
    t = t.join(ev, "cleabs")
    geo = (F.when(F.col("m11") == 10, F.lit(""))
           .when(F.col("m5") == 0, F.concat(F.lit("SRID=4326;"), F.col("wkt"))).otherwise(F.col("wkt")))
    cols = []
    for name, _kind in FD.BUILDING_COLUMNS:
        if name == "geometrie":
            cols.append(geo.alias(name))
        elif name in t.columns:
            cols.append(F.col(name))
        else:
            cols.append(F.lit("").alias(name))
    return t.select(*cols)


@query
def staging_load(spark, sf_dir):
    """S4 + T1-T7: the staging CSV written, scanned as text and typed."""
    path = _scratch(spark, "staging")
    SK.export_csv(_staging(spark, sf_dir), path)
    b = FD.typed_buildings(FD.read_building_staging(spark, path))
    return b.select("cleabs", "construction_legere", "gcms_detruit",
                    F.col("hauteur").cast("string").alias("hauteur"), "nombre_de_logements",
                    "metadonnees_unification", "geometrie_srid",
                    _npoints("geometrie").cast("long").alias("npts"))


@query
def srid_violations(spark, sf_dir):
    """C4: typed buildings whose geometry SRID is not 0."""
    path = _scratch(spark, "staging")
    SK.export_csv(_staging(spark, sf_dir), path)
    b = FD.typed_buildings(FD.read_building_staging(spark, path))
    return _srid_violations(b, "cleabs", "geometrie_srid")


@query
def candidates_500m(spark, sf_dir):
    """M13 (dormant in the source): live buildings within 500 m of a
    registry point."""
    R, B = _pools(spark, sf_dir)
    return JB.near_registry_points(R, B, 500.0).select("cleabs")


@query
def initial_pool(spark, sf_dir):
    """M16 (dormant in the source): the registry pool as the set union of
    the insert and update lists (no ``cleabs`` column)."""
    from footlink.session import cut_lineage
    lc = cut_lineage(_last_changes(spark, sf_dir))
    terr = _territories(spark)
    cols = ["identifiant_rnb", "geometrie", "geometrie_enveloppe", "informations_rnb"]
    ins = LO.new_to_insert(lc, FX.link_table(spark, sf_dir), terr).select(*cols)
    upd = LO.changed_to_update(lc, FX.link_table_geo(spark, sf_dir), terr).select(*cols)
    return ins.unionByName(upd).distinct().select("identifiant_rnb", "informations_rnb")


# -- streaming: landing folder → stock ----------------------------------------

from footlink.streaming import landing as ST  # noqa: E402


@query
def stream_upsert(spark, sf_dir):
    """S2/D2/K8 as a stream: the feed's first half lands, a micro-batch
    runs; the second half lands, another runs; the stock is returned."""
    feed = FX.diff(spark, sf_dir).drop("pos")
    start = F.substring("sys_period", 3, 10)
    landing, stock, ckpt = _scratch(spark, "landing"), _scratch(spark, "stock"), _scratch(spark, "stream-ckpt")
    for i, part in enumerate([feed.filter(start < "2024-01-16"), feed.filter(start >= "2024-01-16")]):
        SK.export_csv(part, f"{landing}/d{i}")
        ST.start(spark, f"{landing}/*/", stock, ckpt).awaitTermination()
    return ST.current_stock(spark, stock).select("rnb_id", "event_id")
