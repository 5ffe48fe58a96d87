"""Importance resampling towards a target distribution.

Features are all runs of 1 to ``RUN`` consecutive words, hashed (crc32 of
the UTF-8 bytes) into ``BUCKETS`` buckets. Both sides are counted whole; the
log ratio of a bucket is its integer gain, a document's weight the sum of the
gains of its features, looked up in one array. Gumbel noise from the doc_id
turns the weights into scores whose highest ``percent`` % are a draw without
replacement.

The draw never sorts the table. Scores are written once; the cutoff is found
by bisection on the number line: each job counts exactly how many rows lie
under ``SECTIONS - 1`` thresholds (four halvings at once), first over scores,
then, for the rows tied at the cutoff, over doc_ids, then over row numbers.
Only the drawn rows are range-partitioned, for their ranks.

A crc32 is affine in its bytes: the crc of "a b" is the crc of "a " shifted by
the length of "b", xor the crc of "b". So words are hashed once, byte column
by byte column, and runs follow from four table lookups.

Edge cases: a null or wordless text has no features, weight 0 and is not
eligible; a null doc_id takes the noise of ``42:`` and comes after all ids;
rows tied in score and doc_id are drawn in the order of the written table
(they differ in nothing the draw looks at); repeated rows are rows of their
own; an empty target gives gains from an empty count, an empty table gives no
rows; texts of any length are read whole, long words byte run by byte run;
extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.frames import NULL_ID, cut_lineage, map_batches

BUCKETS = 10_000
RUN = 3
PERCENT = 5
MIN_WORDS = 20
SEED = 42
SECTIONS = 16
#: Words up to this many bytes are hashed column by column, longer ones by zlib.
LONG = 48

_IS_WORD = np.zeros(256, np.uint8)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_ONES = np.uint32(0xFFFFFFFF)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte table of crc32, and ``shift[n, k, v]``: a crc whose byte k is
    v (others 0), moved on by n zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    shift = np.empty((LONG + 1, 4, 256), np.uint32)
    shift[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONG):
        shift[n + 1] = step[shift[n] & 0xFF] ^ (shift[n] >> np.uint32(8))
    return step, shift


def word_crcs(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of each byte run."""
    step, _ = _tables()
    size = end - start
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    at, left = start[order], size[order]
    n_long = int(np.searchsorted(-left, -LONG, "left"))
    at, left = at[n_long:], left[n_long:]
    reg = np.full(len(at), _ONES)
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, "left"))             # words of more than k bytes
        reg[:n] = step[(reg[:n] ^ buf[at[:n] + k]) & 0xFF] ^ (reg[:n] >> np.uint32(8))
    out = np.empty(len(start), np.uint32)
    out[order[n_long:]] = reg ^ _ONES
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(buf[start[i]:end[i]])
    return out


def _extend(crc: np.ndarray, nxt: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc of (run + space + next word), given the crcs of both."""
    step, shift = _tables()
    reg = crc ^ _ONES
    crc = step[(reg ^ np.uint32(0x20)) & 0xFF] ^ (reg >> np.uint32(8)) ^ _ONES
    size = end - start
    n = np.minimum(size, LONG)
    out = nxt.copy()
    for k in range(4):
        out ^= shift[n, k, (crc >> np.uint32(8 * k)) & 0xFF]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(buf[start[i]:end[i]], int(crc[i]))
    return out


def feature_buckets(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document) of every feature of a chunk, and words a document."""
    buf = _LOWER[buf]
    start, end, first = T.runs(_IS_WORD[buf], bounds)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    crc = word_crcs(buf, start, end)
    buckets, docs, run = [crc % np.uint32(BUCKETS)], [doc], crc
    for k in range(1, RUN):
        run = _extend(run[:-1], crc[k:], buf, start[k:], end[k:])
        inside = doc[k:] == doc[:-k]
        buckets.append(run[inside] % np.uint32(BUCKETS))
        docs.append(doc[k:][inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(docs), n


def count_features(texts: DataFrame) -> np.ndarray:
    """Features per bucket over all rows of ``texts``: one row a bucket and
    task, summed in the cluster; ``BUCKETS`` numbers reach the driver."""
    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, buf, bounds in T.text_chunks(batch.column(0)):
                total += np.bincount(feature_buckets(buf, bounds)[0], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    parts = texts.select("text").mapInArrow(count, "bucket long, n long")
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Integer log ratio of each bucket, in thousandths."""
    s, t = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(b + 1) * s) / (float(a + 1) * t)))
                     for a, b in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None) -> int:
    """Gumbel noise of an id, in thousandths."""
    text = f"{SEED}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)          # BUCKETS longs

    def of(batch):
        for lo, hi, buf, bounds in T.text_chunks(batch.column(1)):
            bucket, doc, words = feature_buckets(buf, bounds)
            weight = np.bincount(doc, shared.value[bucket], minlength=hi - lo).astype(np.int64)
            ids = batch.column(0).slice(lo, hi - lo)
            drawn = np.array([noise(i) for i in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(words.astype(np.int64)), pa.array(np.bincount(doc, minlength=hi - lo)),
                 pa.array(weight), pa.array(weight + drawn)],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), of,
                       "doc_id long, n_words long, n_features long, weight long, score long")


def nth_smallest(rows: DataFrame, column: str, n: int) -> tuple[int, int, int]:
    """(v, under, upto): v is the n-th smallest value of a long column,
    ``under`` rows are below it and ``upto`` at most equal to it. Every step is
    one job of exact counts; no value leaves the cluster but the two ends."""
    lo, hi, upto = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    under = 0
    while lo < hi:
        cuts = sorted({lo + (hi - lo) * i // SECTIONS for i in range(SECTIONS)})      # all below hi
        held = rows.agg(*[F.count_if(F.col(column) <= c).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        i = next((i for i, c in enumerate(held) if c >= n), len(cuts))
        if i < len(cuts):
            hi, upto = cuts[i], held[i]
        if i:
            lo, under = cuts[i - 1] + 1, held[i - 1]
    return lo, under, upto


def cutoff(rows: DataFrame, keys: list[str], n: int) -> Column:
    """Condition that holds for exactly the first ``n`` rows in the order of
    ``keys`` (longs, ascending), ties going to the next key."""
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        v, under, upto = nth_smallest(rows.where(tied), key, n)
        chosen = chosen | (tied & (F.col(key) < v))
        tied = tied & (F.col(key) == v)
        if upto == n:
            return chosen | tied
        n -= under
    raise AssertionError("the last key is not unique")


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with their rank in the order of ``keys``: range partitions,
    each sorted, and one offset per partition."""
    placed = cut_lineage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    offsets, total = [], 0
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):        # one row a partition
        offsets.append((p, total))
        total += n
    ends = placed.sparkSession.createDataFrame(offsets, "_part long, _before long")
    return (placed.withColumn("_part", part).join(F.broadcast(ends), "_part")     # bound: shuffle partitions
            .withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Every document's (doc_id, n_features, weight, score, rank); ``rank`` is
    null for those not drawn."""
    gain = gains(count_features(docs), count_features(target))
    rows = cut_lineage(weigh(docs, gain)
                       .withColumn("_score", -F.col("score")).withColumn("_id", F.coalesce("doc_id", F.lit(NULL_ID)))
                       .withColumn("_row", F.monotonically_increasing_id()))
    out = ["doc_id", "n_features", "weight", "score"]
    eligible = F.col("n_words") >= min_words
    n = percent * rows.where(eligible).count() // 100
    if n == 0:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    keys = ["_score", "_id", "_row"]
    drawn = eligible & cutoff(rows.where(eligible), keys, n)
    return (rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
            .unionByName(_ranked(rows.where(drawn), keys).select(*out, "rank")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from footlink.llm.frames import table
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
