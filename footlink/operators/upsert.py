"""K8: upsert the latest changes into a maintained stock table.

Expressed as ``stock ▷ changes`` (anti join on the key) ``∪ changes``:
the stock side is only filtered, never re-aggregated. Nothing is hinted:
Catalyst broadcasts the change keys when their estimated size, or with AQE
their measured one, is under the session's threshold, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(stock: DataFrame, changes: DataFrame, key: str = "rnb_id") -> DataFrame:
    """Rows of ``changes`` replace rows of ``stock`` with the same key;
    other stock rows are kept; new keys are inserted. Columns missing on
    one side become NULL (the feed's header decides the column list)."""
    kept = stock.join(changes.select(key).distinct(), key, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def with_origin(stock: DataFrame, changes: DataFrame, key: str = "rnb_id") -> DataFrame:
    """Upsert that also tells where each row came from (``stock``/``change``)."""
    return upsert(stock.withColumn("origin", F.lit("stock")),
                  changes.withColumn("origin", F.lit("change")), key)
