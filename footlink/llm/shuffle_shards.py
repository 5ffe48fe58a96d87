"""Reproducible shuffle into shards.

Documents are numbered 0 .. n - 1 in order of (doc_id, text checksum, size).
A keyed Feistel permutation of range(n) with cycle walking moves each number
to its place in the shuffle; shard and slot are the remainder and quotient of
that place by the number of shards, so anyone who knows n and the seed can
compute either way. Law ``rows``: shard counts differ by one at most.

Only id, checksum and size are moved: the text is read once, in place.

Edge cases: a null text has size 8 and the checksum of no bytes (0); null
ids are numbered last; repeated rows get numbers next to each other; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footlink.llm.feistel import permute_array
from footlink.llm.frames import cut_lineage, table

SHARDS = 24
SEED = 20240


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``rows`` with a gapless global ``number`` by ``order`` (nulls last),
    and their count. Rows are range-partitioned; one count per partition goes
    through the driver."""
    by = [F.col(c).asc_nulls_last() for c in order]
    parts = cut_lineage(rows.repartitionByRange(*by).withColumn("part", F.spark_partition_id()))
    counts = dict(parts.groupBy("part").count().collect())
    ahead, total = {}, 0
    for part in sorted(counts):
        ahead[part], total = total, total + counts[part]
    if not counts:
        return parts.withColumn("number", F.lit(0).cast("long")).drop("part"), 0
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in ahead.items() for x in kv]), F.col("part"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*by))
    return parts.withColumn("number", (offset + within - 1).cast("long")).drop("part"), total


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, number, place, shard, slot) of every document."""
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
                       F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    rows, n = numbered(rows, "doc_id", "text_crc32", "size")

    @F.arrow_udf("long")
    def place(number: pa.Array) -> pa.Array:
        return pa.array(permute_array(number.to_numpy(zero_copy_only=False), max(n, 1), seed))

    return (rows.withColumn("place", place("number"))
            .withColumn("shard", (F.col("place") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("place") / shards).cast("long")))


def locate(numbers: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of global row numbers, without the data."""
    place = permute_array(numbers, n, seed)
    return place % shards, place // shards


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
