"""The maintained stock as hash buckets of its key (K8).

A change list touches few buckets of a large stock, and only those are read
and rewritten. A version writes its buckets under a folder of its own and is
published by one row of the pointer table: for every bucket, the version that
holds it. Untouched buckets keep their files, a reader sees one version
whole, a crash before the pointer row leaves the stock as it was, and a replayed
change list gives the same stock again.

The pointer row is bounded by the number of buckets, which the first version
fixes. Files of replaced buckets stay for readers of older versions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footlink.operators.upsert import upsert
from footlink.session import cut_lineage
from footlink.sources.sinks import append_pointer, newest_pointer

#: Buckets of a new stock: a few hundred MB each at the size it may reach.
BUCKETS = 64
BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a key; rows without one share a bucket."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _pointer(spark: SparkSession, stock_dir: str):
    return newest_pointer(spark, f"{stock_dir.rstrip('/')}/current")


def _read(spark: SparkSession, ptr, only: list[int] | None = None) -> DataFrame:
    """The published stock, or the buckets ``only`` of it. The schema comes
    with the pointer: a bucket written before a column existed has NULL there."""
    schema = StructType.fromJson(json.loads(ptr["schema"]))
    held = json.loads(ptr["held"])
    paths = [f"{folder}/{BUCKET}={b}" for b, folder in held.items() if only is None or int(b) in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def current_stock(spark: SparkSession, stock_dir: str) -> DataFrame | None:
    """The stock as last published; None if nothing ever was."""
    ptr = _pointer(spark, stock_dir)
    return _read(spark, ptr) if ptr else None


def upsert_stock(spark: SparkSession, stock_dir: str, changes: DataFrame, key: str = "rnb_id",
                 epoch: str = "", buckets: int = BUCKETS) -> list[int]:
    """Upsert ``changes`` (unique ``key``) into the stock and publish it; the
    buckets that were rewritten. No change publishes nothing, but the first
    version of a stock may be empty. ``buckets`` counts for a new stock only."""
    ptr = _pointer(spark, stock_dir)
    n = int(ptr["buckets"]) if ptr else buckets
    if ptr and ptr["key"] != key:
        raise ValueError(f"the buckets of {stock_dir} are by {ptr['key']}")
    if BUCKET in changes.columns:
        raise ValueError(f"{BUCKET} is the name of the bucket column")
    ch = cut_lineage(changes.withColumn(BUCKET, bucket_of(key, n)))
    touched = sorted(r[0] for r in ch.select(BUCKET).distinct().collect())    # at most n integers
    if ptr and not touched:
        return []
    held = json.loads(ptr["held"]) if ptr else {}
    new = ch.drop(BUCKET)
    if ptr:
        new = upsert(_read(spark, ptr, [b for b in touched if str(b) in held]), new, key)
    folder = f"{stock_dir.rstrip('/')}/versions/{epoch or 'run'}-{uuid.uuid4().hex}"
    # files of even size: the hint lets a large bucket be more than one task
    (new.withColumn(BUCKET, bucket_of(key, n)).hint("rebalance", BUCKET)
     .write.partitionBy(BUCKET).parquet(folder))
    held.update({str(b): folder for b in touched})
    append_pointer(spark, f"{stock_dir.rstrip('/')}/current", epoch=epoch, buckets=str(n), key=key,
                   held=json.dumps(held), schema=new.schema.json())
    return touched
