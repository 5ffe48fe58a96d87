"""Sources: the change-feed CSV (S1, S2) and the bulk CSV loads of the link
and building tables (S3, S4 + the typed insert T1-T7).

Every scan has an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footlink.functions import casts as C
from footlink.functions.dates import range_start
from footlink.functions.geometry import read_geometry, read_srid

# Change-feed header (the target table's columns without the
# two derived dates).
FEED_COLUMNS = ["action", "rnb_id", "status", "is_active", "sys_period", "point", "shape",
                "addresses_id", "ext_ids", "parent_buildings", "event_id", "event_type"]


def _strings(cols) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def feed_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the feed, from its header line (columns are known by
    name, whatever their order; unknown ones are kept). A landing folder
    without a file yet has the usual columns."""
    try:
        names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        names = []
    if names and not {"rnb_id", "sys_period"} <= set(names):
        raise ValueError(f"{path}: the feed's header lacks rnb_id or sys_period: {names}")
    return names or FEED_COLUMNS


def feed_options(reader, columns: list[str], multiline: bool = False):
    """Options shared by the batch and the streaming reader: all strings,
    every file's header checked against the names, malformed rows raise."""
    return (reader.schema(_strings(columns)).option("header", True).option("enforceSchema", False)
            .option("escape", '"').option("quote", '"').option("mode", "FAILFAST").option("multiLine", multiline))


def read_feed(spark: SparkSession, path: str, columns: list[str] | None = None, multiline: bool = False) -> DataFrame:
    """CSV with a header, every field a string, ``"`` doubled inside
    quoted fields (ranges hold quotes, so ``escape='"'`` is required). An
    empty field reads as ``''`` like the source's reader. A quoted line break
    needs ``multiline``, which reads each file in one task; without it such a
    row raises. ``pos`` = (file, split start, row) is taken at scan time,
    before any shuffle, so ties can be broken by input order."""
    df = feed_options(spark.read, columns or feed_header(spark, path), multiline).csv(path).na.fill("")
    return df.withColumn("pos", F.struct(F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("row")))


def read_feed_since(spark: SparkSession, landing: str, since: str,
                    columns: list[str] | None = None) -> DataFrame:
    """S2 re-aimed: the feed files landed in a folder, keeping changes whose
    range starts at or after ``since`` (the download itself is not built)."""
    df = read_feed(spark, landing, columns)
    return df.filter(range_start("sys_period") >= F.lit(since).cast("timestamp"))


# Link-table columns and types (S3).
LINK_SCHEMA = T.StructType([
    T.StructField("cleabs", T.StringType()), T.StructField("identifiant_rnb", T.StringType()),
    T.StructField("liens_vers_batiment", T.StringType()), T.StructField("informations_rnb", T.StringType()),
    T.StructField("geometrie_enveloppe", T.StringType()), T.StructField("nom", T.StringType()),
    T.StructField("commentaire_centralise", T.StringType()), T.StructField("commentaire_collecteur", T.StringType()),
    T.StructField("gcms_detruit", T.BooleanType()), T.StructField("gcms_date_creation", T.TimestampNTZType()),
    T.StructField("gcms_date_modification", T.TimestampNTZType()),
    T.StructField("gcms_date_destruction", T.TimestampNTZType()), T.StructField("diffusion", T.BooleanType()),
    T.StructField("gcms_numrec", T.IntegerType()), T.StructField("gcms_territoire", T.StringType()),
    T.StructField("gcms_fingerprint", T.StringType()), T.StructField("exception_legitime", T.StringType()),
    T.StructField("gcvs_empreinte", T.StringType()), T.StructField("traitement", T.StringType()),
    T.StructField("gcvs_nom_lot", T.StringType()), T.StructField("geometrie", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("parent_buildings", T.StringType()),
])


# Declared as NOT NULL; the longest key; columns that hold JSON.
LINK_NOT_NULL = ["cleabs", "gcms_detruit", "diffusion", "gcms_numrec", "gcms_territoire", "geometrie"]
LINK_KEY_LENGTH = 24
LINK_JSON = ["parent_buildings"]


def split_link_rows(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S3 with a reject channel: the typed rows of the link CSV, and the rows
    that a typed load refuses as ``(file, row, problems, line)`` where
    ``problems`` lists (column, value, reason). Columns go by position.

    One text scan: each value is cast on its own, and a row with a value that
    does not cast, a NULL in a NOT NULL column, a key that is too long, text
    that is not JSON, or too few or too many fields is set apart. An
    unquoted empty field is NULL, a quoted one the empty string."""
    fields = [f for f in LINK_SCHEMA if columns is None or f.name in columns]
    names = [f.name for f in fields]
    scan = (spark.read.schema(_strings([*names, "_line"])).option("header", True).option("escape", '"')
            .option("nullValue", "\u0001").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
            .csv(path))
    problem = lambda column, value, reason: F.struct(F.lit(column).alias("column"), value.cast("string").alias("value"),
                                                     F.lit(reason).alias("reason"))
    found = [F.when(F.col("_line").isNotNull(), problem(None, F.lit(None), "number of fields"))]
    for f in fields:
        c = F.col(f.name)
        if f.dataType != T.StringType():
            found.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), problem(f.name, c, f.dataType.simpleString())))
        if f.name in LINK_JSON:
            found.append(F.when(c.isNotNull() & F.try_parse_json(c).isNull(), problem(f.name, c, "json")))
        if f.name == "cleabs":
            found.append(F.when(F.length(c) > LINK_KEY_LENGTH, problem(f.name, c, f"longer than {LINK_KEY_LENGTH}")))
        if f.name in LINK_NOT_NULL:
            found.append(F.when(c.isNull() & F.col("_line").isNull(), problem(f.name, c, "null")))
    checked = scan.select("*", F.array_compact(F.array(*found)).alias("problems"),
                          F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    good = checked.where(F.size("problems") == 0).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
    line = F.coalesce("_line", F.to_csv(F.struct(*names)))
    return good, checked.where(F.size("problems") > 0).select("file", "row", "problems", line.alias("line"))


def read_link_table(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """S3: typed CSV of the link table (geometries stay text until parsed by
    the pool builders). A row that a typed load refuses raises; with
    ``rejects`` such rows are written to that folder (Parquet) instead."""
    good, bad = split_link_rows(spark, path)
    if rejects:
        bad.write.mode("overwrite").parquet(rejects)
        return good
    first = bad.select("line", F.col("problems")[0].alias("p")).limit(1).collect()
    if first:
        p = first[0].p
        raise ValueError(f"{path}: {p.column} = {p.value!r} ({p.reason}) in row {first[0].line}")
    return good


# Building staging columns in file order, each with the
# cast family that types it.
BUILDING_COLUMNS = [
    ("cleabs", "keep"), ("nature", "keep"), ("usage_1", "keep"), ("usage_2", "keep"),
    ("construction_legere", "bool"), ("etat_de_l_objet", "keep"), ("gcms_detruit", "bool"),
    ("gcms_date_creation", "timestamp"), ("gcms_date_modification", "timestamp"),
    ("gcms_date_destruction", "timestamp"), ("date_d_apparition", "date"), ("date_de_confirmation", "date"),
    ("diffusion", "bool"), ("source_detaillee", "json"), ("sources", "text"), ("identifiants_sources", "text"),
    ("methode_d_acquisition_planimetrique", "text"), ("precision_planimetrique", "numeric(5,1)"),
    ("methode_d_acquisition_altimetrique", "text"), ("precision_altimetrique", "numeric(5,1)"),
    ("complement", "json"), ("nombre_de_logements", "int"), ("nombre_d_etages", "int"),
    ("materiaux_des_murs", "text"), ("materiaux_de_la_toiture", "text"), ("hauteur", "numeric(6,2)"),
    ("altitude_minimale_sol", "numeric(7,2)"), ("altitude_minimale_toit", "numeric(7,2)"),
    ("altitude_maximale_toit", "numeric(7,2)"), ("altitude_maximale_construction", "numeric(7,2)"),
    ("altitude_maximale_sol", "numeric(7,2)"), ("nom", "text"), ("commentaire_centralise", "text"),
    ("commentaire_collecteur", "text"), ("origine_du_batiment", "text"), ("source_restitution", "text"),
    ("metadonnees_unification", "text2"), ("metadonnees_appariement_ff", "json"),
    ("appariement_fichiers_fonciers", "text"), ("identifiant_parcellaire", "text"),
    ("liens_vers_adresse", "text"), ("liens_vers_evolution", "text"), ("gcms_numrec", "int"),
    ("gcms_territoire", "text"), ("gcms_fingerprint", "text"), ("gcvs_nom_lot", "text"),
    ("exception_legitime", "text"), ("geometrie", "geom"), ("gcvs_empreinte", "wkt"),
]


def read_building_staging(spark: SparkSession, path: str) -> DataFrame:
    """The building CSV with every column as text."""
    return (spark.read.schema(_strings([c for c, _ in BUILDING_COLUMNS]))
            .option("header", True).option("escape", '"').csv(path))


def typed_buildings(staging: DataFrame) -> DataFrame:
    """The typed insert as one ``select`` (one codegen stage).
    ``geometrie`` ((E)WKT or hex (E)WKB) becomes a parsed multipolygon (Z dropped) plus its SRID;
    the outline ``gcvs_empreinte`` stays WKT text, NULL when blank."""
    out = []
    for name, kind in BUILDING_COLUMNS:
        c = F.col(name)
        if kind == "keep":
            e = c
        elif kind == "bool":
            e = C.tri_bool(c)
        elif kind == "timestamp":
            e = C.blank_to_null_cast(c, "timestamp_ntz")
        elif kind == "date":
            e = C.blank_to_null_cast(c, "date")
        elif kind == "json":
            e = C.json_or_null(c)
        elif kind == "text":
            e = C.text_or_null(c)
        elif kind == "text2":
            e = C.text_or_null_quoted(c)
        elif kind == "int":
            e = C.blank_to_null_cast(c, "int")
        elif kind.startswith("numeric"):
            p, s = kind[8:-1].split(",")
            e = C.numeric(c, int(p), int(s))
        elif kind == "geom":
            out.append(F.when(C.text_or_null(c).isNotNull(), read_srid(c)).alias("geometrie_srid"))
            e = F.when(C.text_or_null(c).isNotNull(), read_geometry(c))
        else:  # wkt kept as text
            e = C.text_or_null(c)
        out.append(e.alias(name))
    return staging.select(*out)
