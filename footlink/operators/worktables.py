"""Diff → work tables (W1-W4): delete, update and insert lists for the link
table, derived from the latest changes and the removal set.

W1/W3 are equi joins on the registry id. W2/W4 also localise the geometry
(territory lookup, projection, precision grid); that part lives in
``footlink.operators.localise`` and is applied by the callers there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deactivated_to_delete(to_remove: DataFrame, link_table: DataFrame) -> DataFrame:
    """Link rows of removed ids → ``(cleabs, gcms_fingerprint NULL)``.
    An inner join: a NULL ``identifiant_rnb`` never matches."""
    return (to_remove.join(link_table, link_table["identifiant_rnb"] == to_remove["rnb_id"])
            .select(link_table["cleabs"], F.lit(None).cast("string").alias("gcms_fingerprint")))


def demolished_to_delete(last_changes: DataFrame, link_table: DataFrame) -> DataFrame:
    """Link rows of ids updated to ``demolished``."""
    dem = last_changes.filter((F.col("action") == "update") & (F.col("status") == "demolished"))
    return (dem.join(link_table, link_table["identifiant_rnb"] == dem["rnb_id"])
            .select(link_table["cleabs"], F.lit(None).cast("string").alias("gcms_fingerprint")))


def update_filter(last_changes: DataFrame) -> DataFrame:
    """W2 row filter: updates, and creations that are reactivations."""
    return last_changes.filter(
        (F.col("action") == "update")
        | ((F.col("action") == "create") & (F.col("event_type") == "reactivation")))


def insert_filter(last_changes: DataFrame, link_table: DataFrame) -> DataFrame:
    """W4 row filter: creations, and updates to ``constructed``, whose id
    is not yet in the link table (anti join)."""
    cand = last_changes.filter(
        ((F.col("action") == "update") & (F.col("status") == "constructed"))
        | (F.col("action") == "create"))
    known = link_table.filter(F.col("identifiant_rnb").isNotNull()).select(
        F.col("identifiant_rnb").alias("rnb_id")).distinct()
    return cand.join(known, "rnb_id", "left_anti")


def informations_json(df: DataFrame) -> F.Column:
    """The ``informations_rnb`` text exactly as the source concatenates
    it (a NULL ``ext_ids`` leaves a hole: invalid JSON, kept bit for bit)."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    return F.concat(F.lit('{"ext_ids": '), c("ext_ids"), F.lit(", "),
                    F.lit('"created_at": "'), c("created_at"), F.lit('", '),
                    F.lit('"updated_at": "'), c("updated_at"), F.lit('", '),
                    F.lit('"identifiants_ban": '), c("addresses_id"), F.lit("}"))
