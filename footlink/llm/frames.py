"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.session import cut_lineage, ensure_checkpoint_dir, ship_package

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Stands for a null doc_id where ids are compared: after all others.
NULL_ID = (1 << 63) - 1
BLOOM_BITS = 1 << 25
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and worker imports, for callers outside the entry.
    Arrow batches are bounded to ``BATCH_BYTES`` (unless the session sets
    less), so long texts cannot swell a task's memory."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, "67108864b")
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Give freed memory back: workers are reused by later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply a batch function inside Spark's tasks."""
    def over(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
                release()
    return df.mapInArrow(over, schema)


def held_out(doc_id="doc_id"):
    """Fold 0 of five by crc32 of the id's decimal text; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def smallest_by_hash(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """At most ``n`` rows, chosen by a fixed hash of ``doc_id`` (a bounded
    top-n, not a sort of the table); the choice never depends on file order."""
    return df.orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), *[F.col(c) for c in cols]).limit(n)


def bloom(keys: DataFrame):
    """Broadcast bitmap of ``BLOOM_BITS`` bits (4 MB, whatever the number of
    rows) over the one long column of ``keys``, as a test for Arrow
    arrays. It never misses a key; with very many keys it lets more rows
    through, so an exact join must follow."""
    import numpy as np
    spark = keys.sparkSession
    name = keys.columns[0]

    def slot(values):
        from footlink.llm.text import mix
        return (mix(np.asarray(values).astype(np.int64).view(np.uint64)) >> np.uint64(39)).astype(np.int64)

    def bits(batches):
        seen = np.zeros(BLOOM_BITS, bool)
        for b in batches:
            seen[slot(b.column(0).drop_null().to_numpy(zero_copy_only=False))] = True
        words = np.packbits(seen, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "bits"])

    parts = (keys.select(F.col(name).cast("long")).mapInArrow(bits, "at long, bits long")
             .groupBy("at").agg(F.bit_or("bits").alias("bits")))
    words = np.zeros(BLOOM_BITS // 64, np.int64)
    got = parts.toArrow()
    words[got["at"].to_numpy()] = got["bits"].to_numpy()
    shared = spark.sparkContext.broadcast(words)

    def held(v: pa.Array) -> np.ndarray:
        at = slot(v.fill_null(0).to_numpy(zero_copy_only=False))
        hit = (shared.value[at >> 6] >> (at & 63)) & 1
        return (hit == 1) & v.is_valid().to_numpy(zero_copy_only=False)

    return held


def bloom_column(held: Callable) -> Callable:
    """``bloom`` as a column function."""
    @F.arrow_udf("boolean")
    def may_hold(v: pa.Array) -> pa.Array:
        return pa.array(held(v))

    return may_hold


#: A key held by more than one row in so many counts as hot (there are fewer such keys than this).
HOT = 256


def lookup(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``table``, which has one row for each value of
    ``key`` (null included) and in ``count`` the rows that hold it, of ``total``.
    The fewer than ``HOT`` hot keys are joined by broadcast; no key of the
    shuffle join has more than 1 / ``HOT`` of the rows."""
    hot = F.col(count) > total // HOT
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}"))
    out = [F.col(f"r.{c}").alias(c) for c in rows.columns]
    out += [F.col(f"s.{c}").alias(c) for c in table.columns if c not in (key, count)]
    few, rest = F.broadcast(table.where(hot)).alias("s"), table.where(~hot).alias("s")
    others = rows.alias("r").join(few, same, "left_anti").alias("r")
    return rows.alias("r").join(few, same).select(*out).unionByName(others.join(rest, same).select(*out))


def without_rows(docs: DataFrame, removed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` less the rows whose (doc_id, text hash) is in ``removed`` and
    with one row for each of ``repeated``; both are (doc_id, text_hash).
    Only rows that a bloom filter lets through are shuffled with their text."""
    key = [F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).alias("_id"), F.xxhash64("text").alias("_h")]
    touched = cut_lineage(removed.withColumn("_gone", F.lit(True))
                          .unionByName(repeated.withColumn("_gone", F.lit(False)))
                          .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"))
                          .agg(F.max("_gone").alias("_gone")))
    may = bloom_column(bloom(touched.select("_h")))
    # The document rides in one struct, so no column name of it can clash.
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    marked = docs.select(doc, *key).withColumn("_may", may("_h"))
    checked = marked.where("_may").join(touched, ["_id", "_h"], "left")
    rows = [marked.where("NOT _may"), checked.where("_gone IS NULL"), checked.where("NOT _gone").dropDuplicates(["_id", "_h"])]
    plain, once, single = (r.select("_doc.*") for r in rows)
    return plain.unionByName(once).unionByName(single)


__all__ = ["DOCUMENT_COLUMNS", "NULL_ID", "bloom", "bloom_column", "cut_lineage", "held_out", "lookup", "map_batches", "prepare", "release",
           "smallest_by_hash", "table", "without_rows"]
