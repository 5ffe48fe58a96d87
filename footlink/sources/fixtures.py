"""Fixture views over the driver's tables.

The reference ships no input data, so the engine's inputs (change feed,
link table, building table, pools) are bound to the generated tables by
deterministic projections. Every view here has a DuckDB twin in
``footlink.plans.oracles`` built from the same rule, so the SQL oracle
sees exactly the same rows. All views grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.functions.lists import agg_distinct_sorted

# Fixed values (fixture rule): status chosen by ``event_id % 5``.
STATUS_BY_MOD5 = ["constructed", "demolished", "constructionProject",
                  "canceledConstructionProject", "notUsable"]
# Fixed values (fixture rule): boolean spellings chosen by ``event_id % 8``.
BOOL_SPELLINGS = ["T", "true", "1", "f", "FALSE", "0", "x", ""]
# Day all fixture rows are stamped relative to (the jobs' ``as_of``).
AS_OF = "2024-02-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a driver table. A scan with fewer splits than the cluster has
    cores (one small file) is spread round-robin so the row-wise parsing
    above it uses every core; a wide scan is returned as is (no shuffle)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores)
    return df


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _deg(micro: Column) -> Column:
    """Decimal text of an integer count of micro-degrees (same text in
    DuckDB, which a float rendering would not guarantee)."""
    a = F.abs(micro)
    return F.concat(F.when(micro < 0, F.lit("-")).otherwise(F.lit("")),
                    (a / 1000000).cast("long").cast("string"), F.lit("."),
                    F.lpad((a % 1000000).cast("string"), 6, "0"))


def _cents_text(c: Column) -> Column:
    a = F.abs(c)
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), (a / 100).cast("long").cast("string"),
                    F.lit("."), F.lpad((a % 100).cast("string"), 2, "0"))


def feed_lonlat(events: DataFrame) -> DataFrame:
    """Integer micro-degree position of each change: users 0-7 (mod 10) in
    mainland France, 8 in Réunion, 9 in the open sea (no territory); the
    building creeps by 2 m steps between versions."""
    u, e = F.col("user_id"), F.col("event_id")
    b = u % 10
    lon = (F.when(b < 8, -1000000 + (u * 37 % 800) * 10000)
           .when(b == 8, 55300000 + (u % 40) * 10000)
           .otherwise(-30000000)) + (e % 3) * 120
    lat = (F.when(b < 8, 43500000 + (u * 53 % 500) * 10000)
           .when(b == 8, -21300000 + (u % 50) * 10000)
           .otherwise(40000000))
    return events.withColumn("_lon", lon).withColumn("_lat", lat)


def _pt_text(x: Column, y: Column) -> Column:
    return F.concat(_deg(x), F.lit(" "), _deg(y))


def square_wkt(lon: Column, lat: Column) -> Column:
    """A 100 × 100 micro-degree footprint with its south-west corner at
    (lon, lat), as lon/lat WKT."""
    lon2, lat2 = lon + 100, lat + 100
    pt = _pt_text
    return F.concat(F.lit("POLYGON(("), pt(lon, lat), F.lit(", "), pt(lon2, lat), F.lit(", "),
                    pt(lon2, lat2), F.lit(", "), pt(lon, lat2), F.lit(", "), pt(lon, lat), F.lit("))"))


def diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed (A2 columns, all strings) from ``events``; ``pos`` is the
    feed position (``event_id``), used only for ties."""
    ev = feed_lonlat(table(spark, sf_dir, "events"))
    e = F.col("event_id")
    lon, lat = F.col("_lon"), F.col("_lat")
    pt = _pt_text
    shape = square_wkt(lon, lat)
    return ev.select(
        F.when(F.col("event_type") == "signup", "create").otherwise("update").alias("action"),
        F.col("user_id").cast("string").alias("rnb_id"),
        _pick(STATUS_BY_MOD5, e % 5).alias("status"),
        F.when(F.col("event_type") == "error", "0").otherwise("1").alias("is_active"),
        F.concat(F.lit('["'), _ts_text(F.col("ts")), F.lit('+00",)')).alias("sys_period"),
        F.concat(F.lit("POINT("), pt(lon, lat), F.lit(")")).alias("point"),
        shape.alias("shape"),
        F.when(e % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit('["'), (e % 1000).cast("string"), F.lit('"]'))).alias("addresses_id"),
        F.when(e % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("props")).alias("ext_ids"),
        F.when(e % 4 == 0, F.lit("[]")).otherwise(F.lit(None).cast("string")).alias("parent_buildings"),
        e.cast("string").alias("event_id"),
        F.when(e % 7 == 0, "reactivation").otherwise(F.col("event_type")).alias("event_type"),
        e.alias("pos"),
    )


def diff_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed with genuine ties: one row per order, keyed by customer, dated by
    order date (whole days), positioned by order key."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("rnb_id"),
        F.concat(F.lit('["'), _ts_text(F.col("o_orderdate")), F.lit('+00",)')).alias("sys_period"),
        F.col("o_orderkey").cast("string").alias("extra"),
        F.col("o_orderkey").alias("pos"),
    )


def diff_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text staging rows (shape of the building staging table) from
    ``events``; blanks and odd spellings placed by ``event_id % 11``."""
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    m = e % 11
    blank = lambda k, v: F.when(m == k, F.lit("")).otherwise(v)
    return ev.select(
        F.concat(F.lit("BATIMENT"), F.lpad(e.cast("string"), 16, "0")).alias("cleabs"),
        F.col("event_type").alias("nature"),
        _pick(BOOL_SPELLINGS, e % 8).alias("construction_legere"),
        _pick(BOOL_SPELLINGS, (e + 3) % 8).alias("gcms_detruit"),
        blank(0, _ts_text(F.col("ts"))).alias("gcms_date_creation"),
        blank(1, F.date_format(F.col("ts"), "yyyy-MM-dd")).alias("date_d_apparition"),
        F.when(m == 2, F.lit("")).when(m == 3, F.lit('""')).when(m == 4, F.lit("n/a"))
         .otherwise(F.col("props")).alias("source_detaillee"),
        blank(5, _cents_text(F.floor(F.col("value") * 100).cast("long"))).alias("hauteur"),
        blank(6, F.col("user_id").cast("string")).alias("nombre_de_logements"),
        blank(7, F.col("event_type")).alias("nom"),
        F.when(m == 8, F.lit('""')).when(m == 9, F.lit("")).otherwise(F.col("event_type"))
         .alias("metadonnees_unification"),
    )


def link_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link table L (identity columns only) from ``customer``: one row per
    customer; ``identifiant_rnb`` is the customer key as text, NULL for
    every 13th customer (links that were never made)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("L"), F.lpad(k.cast("string"), 10, "0")).alias("cleabs"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(k.cast("string")).alias("identifiant_rnb"),
        F.col("c_nationkey").alias("gcms_numrec"),
        F.when(k % 29 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("gcms_territoire"),
        (k % 31 == 0).alias("gcms_detruit"),
    )


def link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole link rows as text from ``orders``, with values that a typed load
    refuses at fixed places, repeated keys, NULLs and SRIDs (B4)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    at = lambda n, m, v, other: F.when(k % m == n, F.lit(v)).otherwise(other)
    null = F.lit(None).cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00")
    own = {
        "cleabs": F.concat(F.lit("L"), at(3, 89, "ABCDEFGHIJKLMNOPQRSTUVWX", F.lit("")),
                           F.when(k % 97 == 0, k % 194).otherwise(k).cast("string")),
        "identifiant_rnb": at(0, 13, None, F.col("o_custkey").cast("string")),
        "liens_vers_batiment": at(0, 5, "", at(1, 5, None, F.concat(F.lit("B"), k.cast("string"), F.lit("/B1")))),
        "gcms_detruit": at(7, 53, "maybe", at(8, 107, None, F.lit("false"))),
        "gcms_date_creation": at(9, 59, "2024-13-01 00:00:00", day),
        "diffusion": F.lit("true"),
        "gcms_numrec": at(11, 61, "12x", at(12, 101, None, (k % 50).cast("string"))),
        "gcms_territoire": at(14, 103, None, F.lit("FXX")),
        "gcvs_empreinte": at(15, 223, "SRID=4326;LINESTRING(0 0, 1 1)", null),
        "geometrie": at(16, 199, None, at(17, 211, "SRID=2154;POINT(1 2)", F.lit("POINT(1 2)"))),
        "parent_buildings": at(18, 67, "{broken", at(3, 4, '["a"]', null)),
    }
    from footlink.sources.feed import LINK_SCHEMA
    return o.select(*[own.get(f.name, null).cast("string").alias(f.name) for f in LINK_SCHEMA])


def link_table_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link table with the old localised envelope of each registry id: the
    footprint at the user's base position (no creep), projected in its
    territory and snapped to 0.1 m. Ids outside every territory get NULL."""
    from footlink.functions import crs
    from footlink.functions.geometry import from_wkt, point_from_wkt
    from footlink.sources.territories import locate, territories

    base = feed_lonlat(table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit(0).cast("long").alias("event_id")))
    base = base.select(F.concat(F.lit("L"), F.lpad(F.col("user_id").cast("string"), 10, "0")).alias("cleabs"),
                       point_from_wkt(F.concat(F.lit("POINT("), _pt_text(F.col("_lon"), F.col("_lat")), F.lit(")")))
                       .alias("_pt"),
                       from_wkt(square_wkt(F.col("_lon"), F.col("_lat"))).alias("_shape"))
    env = locate(base, "_pt", territories(spark)).select(
        "cleabs", crs.transform_geom("_shape", grid=0.1).alias("geometrie_enveloppe"))
    return link_table(spark, sf_dir).join(env, "cleabs", "left")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link table with id lists, from ``lineitem``: ``cleabs`` = order key,
    ``liens_vers_batiment`` = sorted distinct part keys joined by ``/``;
    ``''`` for every 50th order, NULL for every 51st."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey").agg(agg_distinct_sorted(F.col("l_partkey").cast("string")).alias("lst"))
    k = F.col("l_orderkey")
    return g.select(
        k.cast("string").alias("cleabs"),
        F.when(k % 50 == 0, F.lit("")).when(k % 51 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("lst")).alias("liens_vers_batiment"),
        F.concat(F.lit("fp"), (k % 97).cast("string")).alias("gcms_fingerprint"),
        (k % 23 == 0).alias("gcms_detruit"),
    )


def destroyed_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building table rows (identity, state, destruction date) from ``part``:
    every 10th size is destroyed, half of them within the last 8 days."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    gone = F.col("p_size") % 10 == 0
    return p.select(
        k.cast("string").alias("cleabs"),
        gone.alias("gcms_detruit"),
        F.when(gone, F.date_sub(F.lit(AS_OF).cast("date"), (k % 16).cast("int")).cast("timestamp_ntz"))
         .alias("gcms_date_destruction"),
    )


# Matching-stage labels (``traitement``) written into the link
# table; they must equal the source labels for the merge filters to work.
LABELS = {
    "equal": "Bâtiments égaux",
    "identical": "Batiments identiques",
    "similar": "Batiments semblables",
    "similar_nbp": "Batiments semblables nbpt diff",
    "dissolved": "Batiments RNB dissous semblables",
    "contained": "Batiments inclus",
    "balcony": "Batiments BDTOPO balcon",
    "point": "Bâtiments ponctuels",
    "semantic": "Croisement sémantique",
    "far_b": "Bâtiment non apparié, à plus de 20m d'un bâtiment RNB",
    "far_r": "Bâtiment non apparié, à plus de 20m d'un autre bâtiment BDUni",
}
_TREATED_LABELS = [LABELS[k] for k in ("similar", "semantic", "contained", "balcony", "far_r")]


def treated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treated-registry accumulator RT from every ``lineitem`` row:
    ``cleabs`` = order key, a stage label by part key, new links."""
    li = table(spark, sf_dir, "lineitem")
    lab = _pick(_TREATED_LABELS, F.col("l_partkey") % 5)
    return li.select(
        F.col("l_orderkey").cast("string").alias("cleabs"),
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("identifiant_rnb"),
        lab.alias("traitement"),
        F.when(lab == LABELS["far_r"], F.lit(""))
         .otherwise(F.concat(F.lit("N"), F.col("l_suppkey").cast("string"),
                             F.when(F.col("l_linenumber") == 2,
                                    F.concat(F.lit("/"), F.col("l_partkey").cast("string")))
                              .otherwise(F.lit("")))).alias("liens_vers_batiment"),
    )


__all__ = ["AS_OF", "LABELS", "diff", "diff_ties", "diff_text", "link_table", "links",
           "destroyed_buildings", "treated", "table"]
