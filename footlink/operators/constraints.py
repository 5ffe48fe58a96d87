"""Constraint checks C1-C4 as data-quality operators: each returns the
violations as rows (empty = constraint holds). All are grouped counts with
map-side partial aggregation, so a hot key is pre-aggregated per task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions.geometry import srid_of


def unique_violations(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Key values seen more than once (NULL keys are exempt, as in a
    unique index). Output ``(check, key, n)`` with the key as text."""
    key_txt = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    nonnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.filter(nonnull).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1)
            .select(F.lit(check).alias("check"), key_txt.alias("key"), F.col("n")))


def not_null_violations(df: DataFrame, cols: list[str], check_prefix: str = "not_null") -> DataFrame:
    """One row per column holding NULLs: ``(check, key=column, n)``.
    One pass over the data (all counts in one aggregate)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(f"{check_prefix}:{c}").alias("check"), F.lit(c).alias("key"),
                 F.col(c).alias("n")) for c in cols])).alias("s")).select("s.*")
    return stacked.filter(F.col("n") > 0)


def srid_violations(df: DataFrame, key: str, srid_col: str, expected: int = 0,
                    check: str = "srid") -> DataFrame:
    """C4: rows whose geometry SRID is set and differs from ``expected``."""
    return (df.filter(F.col(srid_col).isNotNull() & (F.col(srid_col) != expected))
            .select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key"),
                    F.lit(1).cast("long").alias("n")))


# What the schema declares of the two tables.
DECLARED = {
    "links": {
        "unique": [["cleabs"], ["identifiant_rnb", "gcms_numrec"], ["identifiant_rnb"]],
        "not_null": ["cleabs", "gcms_detruit", "diffusion", "gcms_numrec", "gcms_territoire", "geometrie"],
        "srid": ["gcvs_empreinte", "geometrie"],
    },
    "buildings": {
        "unique": [["cleabs"]],
        "not_null": ["cleabs", "gcms_detruit", "diffusion", "gcms_numrec", "gcms_territoire", "geometrie"],
        "srid": ["gcvs_empreinte", "geometrie"],
    },
}


def schema_violations(df: DataFrame, declared: dict, srid=srid_of) -> DataFrame:
    """C1-C4 in one pass: every declared constraint's violations as ``(check,
    key, n)``, where ``key`` is the key seen n times, the column holding n
    NULLs, or the ``cleabs`` of the row whose geometry text has an SRID other
    than 0.

    Each row is expanded to what it has to say (its keys; its NULLs and
    SRIDs only where they violate), and one aggregate counts all of it, with
    map-side partial sums, so the table is scanned and shuffled once."""
    says = lambda check, key, least: F.struct(F.lit(check).alias("check"), key.cast("string").alias("key"),
                                              F.lit(least).alias("least"))
    said = []
    for keys in declared["unique"]:
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        said.append(F.when(known, says("unique:" + ",".join(keys), key, 2)))
    said += [F.when(F.col(c).isNull(), says(f"not_null:{c}", F.lit(c), 1)) for c in declared["not_null"]]
    said += [F.when(srid(F.col(c)) != 0, says(f"srid:{c}", F.col("cleabs"), 1)) for c in declared["srid"]]
    return (df.select(F.explode(F.array_compact(F.array(*said))).alias("s")).select("s.*")
            .groupBy("check", "key", "least").agg(F.count(F.lit(1)).alias("n"))
            .where("n >= least").select("check", "key", "n"))
