"""Link-list operators: exploding ``a/b/c`` lists, merging new links into
existing ones (F1, F2) and rebuilding lists after topographic buildings are
destroyed (O3 = F3a + F3b).

All of it is relational: explode, distinct, semi/anti joins, grouped string
aggregates. Duplicates are removed *before* the per-key aggregate so the
shuffle into the final ``collect`` carries one row per (key, link).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlink.functions.lists import agg_all_sorted, agg_distinct_sorted, to_array, to_array_keep_empty
from footlink.sources.fixtures import LABELS


def explode_strict(df: DataFrame, col: str, out: str, sep: str = "/") -> DataFrame:
    """E1 ``unnest(string_to_array(col, sep))``: ``''`` → no row."""
    return df.withColumn(out, F.explode(to_array(col, sep)))


def explode_regexp(df: DataFrame, col: str, out: str, sep: str = "/") -> DataFrame:
    """E2 ``regexp_split_to_table(col, sep)``: ``''`` → one ``''`` row."""
    return df.withColumn(out, F.explode(to_array_keep_empty(col, sep)))


def merge_links_with_labels(treated: DataFrame, link_table: DataFrame,
                            exclude_label: str = LABELS["far_r"]) -> DataFrame:
    """per treated ``cleabs``, the distinct union of its new links and
    the links it already had, with the distinct stage labels.

    Output ``(cleabs, liens_vers_batiment, traitement, gcms_fingerprint)``;
    lists are ``/``-joined, sorted; fingerprint NULL.
    """
    rt = treated.filter(F.col("traitement") != exclude_label).select("cleabs", "traitement",
                                                                      "liens_vers_batiment")
    new = explode_regexp(rt, "liens_vers_batiment", "lien").select("cleabs", "lien", "traitement")
    old = (link_table.select("cleabs", F.col("liens_vers_batiment").alias("old"))
           .join(rt.select("cleabs", "traitement").distinct(), "cleabs"))
    old = explode_regexp(old, "old", "lien").select("cleabs", "lien", "traitement")
    u = new.unionByName(old).distinct()
    return (u.groupBy("cleabs")
            .agg(agg_distinct_sorted("lien").alias("liens_vers_batiment"),
                 agg_distinct_sorted("traitement").alias("traitement"))
            .withColumn("gcms_fingerprint", F.lit(None).cast("string")))


def merge_links(treated: DataFrame, link_table: DataFrame,
                exclude_label: str = LABELS["far_r"]) -> DataFrame:
    """as F1 without the label column. The source aggregates without
    DISTINCT over a distinct union, which gives the same list."""
    rt = treated.filter(F.col("traitement") != exclude_label)
    new = explode_regexp(rt.select("cleabs", "liens_vers_batiment"), "liens_vers_batiment", "lien")
    old = (link_table.select("cleabs", "liens_vers_batiment")
           .join(rt.select("cleabs").distinct(), "cleabs"))
    old = explode_regexp(old, "liens_vers_batiment", "lien")
    u = new.select("cleabs", "lien").unionByName(old.select("cleabs", "lien")).distinct()
    return (u.groupBy("cleabs").agg(agg_all_sorted("lien").alias("liens_vers_batiment"))
            .withColumn("gcms_fingerprint", F.lit(None).cast("string")))


def destroyed_since(buildings: DataFrame, as_of: str, days: int = 8) -> DataFrame:
    """O3 step 1: distinct keys of buildings destroyed in the last ``days``."""
    since = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    return (buildings.filter(F.col("gcms_detruit") & (F.col("gcms_date_destruction") >= since))
            .select("cleabs").distinct())


def drop_destroyed_links(link_table: DataFrame, destroyed: DataFrame) -> DataFrame:
    """O3 (F3a + F3b): rebuild the lists of live link rows that name a
    destroyed building.

    * exploded live links (NULL list read as ``''``);
    * affected = (cleabs, link) pairs whose link is destroyed;
    * F3a: for affected ``cleabs``, the links not destroyed anywhere,
      re-joined (duplicates kept, sorted);
    * F3b: affected ``cleabs`` with nothing left get a NULL list.

    Output ``(cleabs, gcms_fingerprint, liens_vers_batiment)``.
    """
    live = link_table.filter(~F.col("gcms_detruit")).select(
        "cleabs", "gcms_fingerprint", F.coalesce(F.col("liens_vers_batiment"), F.lit("")).alias("l"))
    exploded = explode_regexp(live, "l", "lien").select("cleabs", "gcms_fingerprint", "lien")
    affected = (exploded.select("cleabs", "lien")
                .join(destroyed.select(F.col("cleabs").alias("lien")), "lien", "left_semi")
                .distinct())
    hit_keys = affected.select("cleabs").distinct()
    hit_links = affected.select("lien").distinct()
    kept = (exploded.join(hit_links, "lien", "left_anti")
            .join(hit_keys, "cleabs", "left_semi"))
    f3a = (kept.groupBy("cleabs", "gcms_fingerprint")
           .agg(agg_all_sorted("lien").alias("liens_vers_batiment")))
    f3b = (exploded.select("cleabs", "gcms_fingerprint")
           .join(hit_keys, "cleabs", "left_semi")
           .join(f3a.select("cleabs"), "cleabs", "left_anti")
           .distinct()
           .withColumn("liens_vers_batiment", F.lit(None).cast("string")))
    return f3a.unionByName(f3b)
