"""Matching stages M1-M12: each takes the registry pool R and the
topographic pool B and returns the claims X
``(liens_vers_batiment, identifiant_rnb, traitement)``.

Pool layouts (built by ``footlink.sources.boxes`` or any caller):

* R: ``cleabs, identifiant_rnb, geometrie (point), geometrie_enveloppe,
  informations_rnb`` + measures of the envelope (``with_measures``);
* B: ``cleabs, geometrie`` + measures.

Plan shape of every geometric stage: cell join of ids and boxes → exact
bbox filter → cheap measure filters (no pair geometry needed) → edge pairs
of the survivors, summed back to one row a pair → group by registry id. All
of it is DataFrame expressions; no stage starts a Python worker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions.geometry import point_distance
from footlink.functions.lists import agg_distinct_sorted, to_array
from footlink.operators.components import boundary_measures, boundary_overlap, connected_components, union_boundary
from footlink.operators.erosion import holds_eroded
from footlink.operators.spatial import DEFAULT_CELL, GEO, candidate_pairs, pair_measures, side
from footlink.session import cut_lineage
from footlink.sources.fixtures import LABELS

X_COLS = ["liens_vers_batiment", "identifiant_rnb", "traitement"]
R_COLS = ["cleabs", "identifiant_rnb", "geometrie", "geometrie_enveloppe", "informations_rnb"]
MEAS = GEO + ["area", "perim", "npts"]


@dataclass(frozen=True)
class Params:
    cell: float = DEFAULT_CELL
    erosion: float = 0.5
    far: float = 20.0


def _fl(c):
    """``floor`` of a measure, which is exact to a billionth."""
    return F.floor(F.round(F.col(c), 9)).cast("long")


def claims_of(matched: DataFrame, label: str) -> DataFrame:
    """X of matched pairs ``(l_identifiant_rnb, r_id)``."""
    return (matched.groupBy(F.col("l_identifiant_rnb").alias("identifiant_rnb"))
            .agg(agg_distinct_sorted("r_id").alias("liens_vers_batiment"))
            .select("liens_vers_batiment", "identifiant_rnb", F.lit(label).alias("traitement")))


@dataclass(frozen=True)
class _Sides:
    """Both pools as the sides of a spatial join."""
    left: DataFrame
    right: DataFrame

    def pairs(self, p: Params, distance: float = 0.0) -> DataFrame:
        return candidate_pairs(self.left, self.right, distance, p.cell)

    def measured(self, pairs: DataFrame, measures: list[str], keep: list[str]) -> DataFrame:
        return pair_measures(pairs, self.left, self.right, measures, keep)


def _sides(R: DataFrame, B: DataFrame) -> _Sides:
    return _Sides(side(R, "l_", "cleabs", ["identifiant_rnb", "area", "perim", "npts"]),
                  side(B, "r_", "cleabs", ["area", "perim", "npts"]))


_KEEP = ["l_identifiant_rnb", "r_id"]


def equal(R, B, p: Params = Params()):
    """M1 ``ST_Equals(b, env)``: equal areas first, they need no geometry."""
    s = _sides(R, B)
    pairs = s.pairs(p).filter(F.abs(F.col("l_area") - F.col("r_area")) < 1e-3)
    return claims_of(s.measured(pairs, ["equal"], _KEEP).filter("equal"), LABELS["equal"])


def identical(R, B, p: Params = Params()):
    """M2: intersects and floor(area ∩) = floor(area b) = floor(area env)."""
    s = _sides(R, B)
    pairs = s.pairs(p).filter(_fl("l_area") == _fl("r_area"))
    m = s.measured(pairs, ["hits", "inter"], _KEEP + ["l_area", "r_area"])
    return claims_of(m.filter(F.col("hits") & (_fl("inter") == _fl("r_area"))), LABELS["identical"])


def _alike():
    """M3 and M4 without geometry: floor areas and perimeters within 3."""
    return (F.abs(_fl("r_area") - _fl("l_area")) < 3) & (F.abs(_fl("r_perim") - _fl("l_perim")) < 3)


def _same_npoints():
    return F.col("l_npts") == F.col("r_npts")


def _small():
    """M7 without geometry: b under 25 m² and smaller than the envelope."""
    return (F.abs(_fl("r_area")) < 25) & (_fl("r_area") < _fl("l_area"))


def similar(R, B, p: Params = Params(), same_npoints: bool = True):
    """M3 (``same_npoints``) / M4: |floor ∩| > 3, floor areas and floor
    perimeters within 3, vertex counts equal (M3) or different (M4).
    The three measure filters run before any pair geometry is touched."""
    s = _sides(R, B)
    npt = _same_npoints() if same_npoints else ~_same_npoints()
    ok = s.measured(s.pairs(p).filter(_alike() & npt), ["inter"], _KEEP).filter(F.abs(_fl("inter")) > 3)
    return claims_of(ok, LABELS["similar" if same_npoints else "similar_nbp"])


def _held(s: _Sides, R: DataFrame, pairs: DataFrame, p: Params) -> DataFrame:
    shapes = s.left.select("l_id", "l_edges").join(
        R.select(F.col("cleabs").alias("l_id"), "geometrie_enveloppe"), "l_id")
    pairs = pairs.select("l_id", "r_id", "r_xmin", "r_ymin", "r_xmax", "r_ymax")
    held = holds_eroded(pairs, shapes, "geometrie_enveloppe", s.right, p.erosion)
    return held.join(s.left.select("l_id", "l_identifiant_rnb"), "l_id")


def contained(R, B, p: Params = Params()):
    """M6 ``ST_Contains(b, ST_Buffer(env, -0.5))``, envelopes of any shape."""
    s = _sides(R, B)
    return claims_of(_held(s, R, s.pairs(p), p), LABELS["contained"])


#: Stages that only look at one pair, by their number in the cascade.
PAIR_STAGES = {3: "similar", 4: "similar_nbp", 6: "contained", 7: "balcony"}


def qualifying_pairs(R: DataFrame, B: DataFrame, p: Params = Params()) -> DataFrame:
    """``(stage, l_id, l_identifiant_rnb, r_id)``: the pairs that satisfy M3, M4,
    M6 or M7, whatever the pools hold when the stage runs. One cell join and
    one edge relation serve all four."""
    s = _sides(R, B)
    pairs = cut_lineage(s.pairs(p))
    keep = ["l_id", *_KEEP, "l_area", "r_area", "l_perim", "r_perim", "l_npts", "r_npts"]
    m = s.measured(pairs.filter(_alike() | _small()), ["hits", "inter"], keep)
    inter = F.abs(_fl("inter"))
    stages = F.array_compact(F.array(F.when(_alike() & _same_npoints() & (inter > 3), 3),
                                     F.when(_alike() & ~_same_npoints() & (inter > 3), 4),
                                     F.when(_small() & F.col("hits") & (inter < 3), 7)))
    cols = ["stage", "l_id", "l_identifiant_rnb", "r_id"]
    held = _held(s, R, pairs, p).withColumn("stage", F.lit(6))
    return cut_lineage(m.withColumn("stage", F.explode(stages)).select(*cols).unionByName(held.select(*cols)))


def balcony_pool(R: DataFrame, RT: DataFrame) -> DataFrame:
    """M7 pool: R ∪ RT (set union on the R columns)."""
    cols = R_COLS + MEAS
    return R.select(*cols).unionByName(RT.select(*cols)).distinct()


def balcony(R, B, p: Params = Params(), RT: DataFrame | None = None):
    """M7: small B (floor area < 25) smaller than env, touching it with
    less than 3 m² of overlap. Pool is R ∪ RT."""
    pool = R if RT is None else balcony_pool(R, RT)
    s = _sides(pool, B)
    m = s.measured(s.pairs(p).filter(_small()), ["hits", "inter"], _KEEP)
    return claims_of(m.filter(F.col("hits") & (F.abs(_fl("inter")) < 3)), LABELS["balcony"])


def point_in_building(R, B, p: Params = Params()):
    """M8 ``ST_Intersects(b, r.geometrie)`` (registry point in building)."""
    m = point_pairs(R, B, p)
    return claims_of(m.filter(F.col("pdist") <= 0.0), LABELS["point"])


def point_pairs(R, B, p: Params = Params()) -> DataFrame:
    """Registry points against the building polygons whose box holds them, with
    ``pdist``, the distance of point and polygon (a JVM expression)."""
    left = R.select(F.col("cleabs").alias("l_id"), F.col("identifiant_rnb").alias("l_identifiant_rnb"),
                    F.col("geometrie.x").alias("l_px"), F.col("geometrie.y").alias("l_py"),
                    F.col("geometrie.x").alias("l_xmin"), F.col("geometrie.x").alias("l_xmax"),
                    F.col("geometrie.y").alias("l_ymin"), F.col("geometrie.y").alias("l_ymax")) \
        .filter(F.col("l_px").isNotNull())
    shapes = B.select(F.col("cleabs").alias("r_id"), F.col("geometrie").alias("r_geometrie"))
    pairs = candidate_pairs(left, side(B, "r_", "cleabs", []), 0.0, p.cell).join(shapes, "r_id")
    return pairs.withColumn("pdist", point_distance("l_px", "l_py", "r_geometrie")).drop("r_geometrie")


EXT_IDS_T = "array<map<string,string>>"


def semantic(R, B, p: Params = Params()):
    """M9: ids named in ``informations_rnb.ext_ids[].id`` that are in the
    B pool. Broken JSON or a NULL list gives no claim. Grouped by the
    (normalised) list and the registry id, as the source does."""
    ext_txt = F.get_json_object("informations_rnb", "$.ext_ids")
    r = (R.select("identifiant_rnb", ext_txt.alias("ext"))
         .withColumn("key", F.to_json(F.try_parse_json("ext")))
         .withColumn("elem", F.explode(F.from_json("ext", EXT_IDS_T)))
         .select("identifiant_rnb", "key", F.col("elem")["id"].alias("id"))
         .filter(F.col("id").isNotNull()))
    hit = r.join(B.select(F.col("cleabs").alias("id")).distinct(), "id", "left_semi")
    return (hit.groupBy("key", "identifiant_rnb").agg(agg_distinct_sorted("id").alias("liens_vers_batiment"))
            .select("liens_vers_batiment", "identifiant_rnb", F.lit(LABELS["semantic"]).alias("traitement")))


# -- dissolve-based stages ----------------------------------------------------------

def explode_parts(pool: DataFrame, key: str, geom: str) -> DataFrame:
    """One row per polygon part (the nodes of ``ST_Dump(ST_Union(...))``):
    ``(id, row_key, geometry + measures)``; ``id`` = ``key#part``."""
    from footlink.functions.geometry import with_measures
    ex = pool.select(F.col(key).alias("row_key"), F.posexplode(geom).alias("pi", "poly"))
    ex = ex.select(F.concat(F.col("row_key"), F.lit("#"), F.col("pi").cast("string")).alias("id"),
                   "row_key", F.array("poly").alias("g"))
    return with_measures(ex, "g").drop("g")


@dataclass
class Dissolved:
    parts: DataFrame    # id, row_key, comp, measures
    attach: DataFrame   # row_key, comp  (rows intersecting the component)
    meeting: DataFrame  # l_id, r_id, l_row_key, r_row_key, contact: parts that intersect

    @property
    def touching(self) -> DataFrame:
        """Pairs (a, b) of parts that share area or boundary."""
        return self.meeting.filter("contact").select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))


def dissolve(pool: DataFrame, key: str, geom: str, p: Params = Params()) -> Dissolved:
    """Components of parts sharing a piece of area or boundary (a
    single touching point does not merge), and the attachment of every
    row to each component it intersects (point touch included)."""
    parts = cut_lineage(explode_parts(pool, key, geom))
    sp = side(parts, "l_", "id", ["row_key"])
    sq = side(parts, "r_", "id", ["row_key"])
    pairs = candidate_pairs(sp, sq, 0.0, p.cell, self_join=True)
    rel = pair_measures(pairs, sp, sq, ["hits", "contact"], ["l_id", "r_id", "l_row_key", "r_row_key"])
    return _grouped(parts, cut_lineage(rel.filter("hits")))


def _grouped(parts: DataFrame, meeting: DataFrame) -> Dissolved:
    out = Dissolved(parts, parts, meeting)
    comp = connected_components(parts.select("id"), out.touching)
    out.parts = cut_lineage(parts.join(comp, "id"))
    pc = out.parts.select("id", "comp")
    own = out.parts.select("row_key", "comp")
    lr = meeting.join(pc.withColumnRenamed("id", "r_id"), "r_id").select(F.col("l_row_key").alias("row_key"), "comp")
    rl = meeting.join(pc.withColumnRenamed("id", "l_id"), "l_id").select(F.col("r_row_key").alias("row_key"), "comp")
    out.attach = own.unionByName(lr).unionByName(rl).distinct()
    return out


def regrouped(d: Dissolved, pool: DataFrame, key: str) -> Dissolved:
    """The dissolve of what is left of a pool, from that of the whole: parts
    and the pairs that meet are known, only the components are new."""
    alive = pool.select(F.col(key).alias("row_key")).distinct()
    of = lambda p: alive.withColumnRenamed("row_key", f"{p}_row_key")
    meeting = d.meeting.join(of("l"), "l_row_key", "left_semi").join(of("r"), "r_row_key", "left_semi")
    return _grouped(d.parts.drop("comp").join(alive, "row_key", "left_semi"), cut_lineage(meeting))


def near_components(parts: DataFrame, other: DataFrame, other_key: str, p: Params) -> DataFrame:
    """Components with a part within ``far`` m of a footprint of the other
    pool. A footprint touches all sides of its box, so two are no farther apart
    than any two sides of their boxes can be; where that is within ``far`` no
    geometry is needed, and only components that no box decides are measured."""
    ps = side(parts, "l_", "id", ["comp"])
    os_ = side(other, "r_", other_key)
    pairs = cut_lineage(candidate_pairs(ps, os_, p.far, p.cell))
    wide = [F.greatest(F.col(f"r_{c}max") - F.col(f"l_{c}min"), F.col(f"l_{c}max") - F.col(f"r_{c}min")) for c in "xy"]
    gaps = [F.least(*[F.abs(F.col(f"l_{c}{a}") - F.col(f"r_{c}{b}")) for a in ("min", "max") for b in ("min", "max")]) for c in "xy"]
    reach = F.least(F.hypot(gaps[0], wide[1]), F.hypot(wide[0], gaps[1]))
    sure = pairs.filter(reach <= p.far).select(F.col("l_comp").alias("comp")).distinct()
    open_ = pairs.join(sure.withColumnRenamed("comp", "l_comp"), "l_comp", "left_anti")
    near = pair_measures(open_, ps, os_, ["dist"], ["l_comp"]).filter(F.col("dist") <= p.far)
    return sure.unionByName(near.select(F.col("l_comp").alias("comp"))).distinct()


def unmatchable(R, B, p: Params = Params(), of_r: Dissolved | None = None):
    """Dissolve each pool by contact; a component within ``far`` m of
    any footprint of the other pool marks every row attached to it as
    near. Rows not near are claimed alone, one label per side. ``of_r``:
    the dissolve of R, if it is known."""
    def near_rows(d, other, other_key):
        near = near_components(d.parts, other, other_key, p)
        return d.attach.join(near, "comp", "left_semi").select("row_key").distinct()

    near_r = near_rows(of_r or dissolve(R, "cleabs", "geometrie_enveloppe", p), B, "cleabs")
    near_b = near_rows(dissolve(B, "cleabs", "geometrie", p), R.withColumnRenamed("geometrie", "_pt"), "cleabs")
    r_ids = R.select(F.col("identifiant_rnb"))
    near_ids = R.join(near_r.withColumnRenamed("row_key", "cleabs"), "cleabs", "left_semi").select("identifiant_rnb")
    far_r = r_ids.subtract(near_ids)
    far_b = B.select("cleabs").subtract(near_b.withColumnRenamed("row_key", "cleabs"))
    xr = far_r.select(F.lit("").alias("liens_vers_batiment"), "identifiant_rnb",
                      F.lit(LABELS["far_r"]).alias("traitement"))
    xb = far_b.select(F.col("cleabs").alias("liens_vers_batiment"), F.lit("").alias("identifiant_rnb"),
                      F.lit(LABELS["far_b"]).alias("traitement"))
    return xb.unionByName(xr).distinct()


def dissolved(R, B, p: Params = Params(), of_r: Dissolved | None = None):
    """M5: dissolve R by contact, then compare each component U with every
    B it intersects: |floor area(U∩b)| > 3, floor areas and floor
    perimeters within 3; every row attached to U is claimed with b.

    Area and perimeter of U are sums over its boundary pieces; they rule out
    almost every (U, b) before the two boundaries meet. ``of_r``: the
    dissolve of a pool that holds R, if it is known.
    """
    d = regrouped(of_r, R, "cleabs") if of_r else dissolve(R, "cleabs", "geometrie_enveloppe", p)
    boundary = cut_lineage(union_boundary(d.parts, d.touching))
    um = boundary_measures(boundary)
    bs = side(B, "r_", "cleabs", ["area", "perim"])
    pairs = (candidate_pairs(side(d.parts, "l_", "id", ["comp"]), bs, 0.0, p.cell)
             .select(F.col("l_comp").alias("comp"), F.col("r_id").alias("b"), F.col("r_area").alias("b_area"),
                     F.col("r_perim").alias("b_perim"))
             .join(um, "comp")
             .filter((F.abs(_fl("b_area") - _fl("u_area")) < 3) & (F.abs(_fl("b_perim") - _fl("u_perim")) < 3))
             .select("comp", "b").distinct())
    shapes = B.select(F.col("cleabs").alias("id"), "edges")
    ok = boundary_overlap(cut_lineage(pairs), boundary, shapes, p.cell).filter(F.abs(_fl("inter")) > 3)
    members = d.attach.join(R.select(F.col("cleabs").alias("row_key"), "identifiant_rnb"), "row_key")
    claimed = ok.join(members, "comp").select(F.col("identifiant_rnb").alias("l_identifiant_rnb"),
                                              F.col("b").alias("r_id"))
    return claims_of(claimed, LABELS["dissolved"])


# -- pool updates ---------------------------------------------------------------

@dataclass
class Pools:
    R: DataFrame
    B: DataFrame
    RT: DataFrame
    BT: DataFrame


def empty_treated(R: DataFrame, B: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K6: empty RT (R columns + label + links) and BT."""
    rt = (R.withColumn("traitement", F.lit("")).withColumn("liens_vers_batiment", F.lit(""))).limit(0)
    bt = B.select("cleabs", F.lit("").alias("traitement"), F.lit("").alias("identifiant_rnb"),
                  "geometrie").limit(0)
    return rt, bt


def update_pools(pools: Pools, X: DataFrame) -> Pools:
    """Move claimed footprints from the pools to the treated sets.

    BT += claimed B keys present in B; B −= those keys (≠ ''); RT += claims
    joined to their R rows; R −= claimed ids (≠ ''). All anti/semi joins.
    Removing only this stage's keys from B equals the source's "keys in
    all of BT", since earlier keys already left B.
    """
    R, B, RT, BT = pools.R, pools.B, pools.RT, pools.BT
    xb = (X.select(F.explode(to_array("liens_vers_batiment")).alias("cleabs"), "traitement", "identifiant_rnb")
          .distinct())
    add_bt = xb.join(B.select("cleabs", "geometrie"), "cleabs").filter(F.col("geometrie").isNotNull())
    BT = BT.unionByName(add_bt.select(*BT.columns))
    B = B.join(add_bt.filter(F.col("cleabs") != "").select("cleabs").distinct(), "cleabs", "left_anti")
    add_rt = (X.join(R, "identifiant_rnb").filter(F.col("geometrie").isNotNull())
              .select(*RT.columns).distinct())
    RT = RT.unionByName(add_rt)
    R = R.join(X.filter(F.col("identifiant_rnb") != "").select("identifiant_rnb").distinct(),
               "identifiant_rnb", "left_anti")
    return Pools(R, B, RT, BT)


def update_pools_balcony(pools: Pools, X: DataFrame, compat_delete: bool = False) -> Pools:
    """The balcony stage's own update: inserts without the non-NULL
    filters, RT rows added beside earlier ones, R untouched. The source's
    delete binds to the wrong column and empties B whenever X has rows;
    ``compat_delete`` reproduces that, the default deletes claimed keys."""
    R, B, RT, BT = pools.R, pools.B, pools.RT, pools.BT
    xb = (X.select(F.explode(to_array("liens_vers_batiment")).alias("cleabs"), "traitement", "identifiant_rnb")
          .distinct())
    add_bt = xb.join(B.select("cleabs", "geometrie"), "cleabs", "left")
    BT = BT.unionByName(add_bt.select(*BT.columns))
    if compat_delete:
        B = B.join(X.select(F.lit(1).alias("_x")).limit(1), how="left_anti",
                   on=F.col("cleabs") != "")
    else:
        B = B.join(xb.filter(F.col("cleabs") != "").select("cleabs").distinct(), "cleabs", "left_anti")
    pool = balcony_pool(R, RT)
    add_rt = (X.join(pool, "identifiant_rnb", "left").select(*RT.columns).distinct())
    RT = RT.unionByName(add_rt)
    return Pools(R, B, RT, BT)
