"""Exact removal of repeated passages, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash
of the ``SEED_WORDS``-word sequences inside it, so equal windows have equal
minimisers, and consecutive windows mostly share one: such a stretch, a
super-k-mer, travels as one packed string (its words, joined by a space) to
the bucket of its minimiser. There, all windows of the bucket's strings are
sorted, which gives every window's smallest doc_id exactly.

1. Every document's super-k-mers as (minimiser, first word, windows), without
   text. A minimiser seen in one document alone cannot hold a repeat: those
   end here, which is most of the text.
2. The others' packed strings are cut from the documents that have some.
   Equal strings are collapsed to one row with their smallest doc_id.
3. Sorting within buckets. A bucket with more than ``HOT`` different strings
   is split: its windows travel one by one, to buckets by their own digest,
   so no task grows with a common passage.
4. Windows whose smallest doc_id is below the document's own cover words; the
   covered words go.

Edge cases: null, empty and short texts have no windows, keep all words and
give the digest of what is kept; a null doc_id comes after all ids; rows of
equal doc_id do not remove from each other, and each is answered by its own
text; repeated rows all come out; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.frames import NULL_ID, bloom, bloom_column, cut_lineage, map_batches, table

WINDOW = 50
SEED_WORDS = 8
HOT = 2000
LONGEST = 1000


def rolling_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive entries."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[width - span:width - span + n])


def super_kmers(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first word, windows, minimiser) of each super-k-mer; first
    words count within the chunk. No super-k-mer has more than LONGEST windows."""
    low = rolling_min(T.window_hashes(h, SEED_WORDS), WINDOW - SEED_WORDS + 1)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), np.maximum(n - WINDOW + 1, 0))
    if not len(doc):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.int64)
    count = np.maximum(n - WINDOW + 1, 0)
    at = first[:-1][doc] + np.arange(len(doc)) - (np.cumsum(count) - count)[doc]
    key = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at)))
    pieces = -(-length // LONGEST)
    if (pieces > 1).any():
        step = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        rest = np.repeat(length, pieces) - step * LONGEST
        begin, length = np.repeat(begin, pieces) + step * LONGEST, np.minimum(rest, LONGEST)
    return doc[begin], at[begin], length, key[begin].view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64("text").alias("h"), "text")


def stretches(docs: DataFrame) -> DataFrame:
    """(id, h, start, windows, minimiser) of every super-k-mer."""
    def of(batch):
        for lo, hi, buf, bounds in T.text_chunks(batch.column(2)):
            _, _, h, first = T.words(buf, bounds)
            doc, at, n, key = super_kmers(h, first)
            own = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo).take(own), batch.column(1).slice(lo, hi - lo).take(own),
                 pa.array((at - first[doc]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(key)],
                names=["id", "h", "start", "windows", "minimiser"])

    return map_batches(_keyed(docs), of, "id long, h long, start int, windows int, minimiser long")


def packed_strings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, h, start, bucket, digest, packed) of the wanted super-k-mers."""
    def of(batch):
        ids, hs, lists = batch.column("id"), batch.column("h"), batch.column("parts")
        for lo, hi, buf, bounds in T.text_chunks(batch.column("text")):
            start, end, first = T.runs((~T.IS_SPACE[buf]).view(np.uint8), bounds)
            raw = buf.tobytes()
            rows: list[tuple] = []
            for i in range(lo, hi):
                a, b = int(first[i - lo]), int(first[i - lo + 1])
                ws = [raw[x:y] for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)]
                for p in lists[i].as_py():
                    at, n, key = p["start"], p["windows"], p["minimiser"]
                    text = b" ".join(ws[at:at + n + WINDOW - 1])
                    rows.append((i, at, key, hashlib.md5(text).digest(), text))
            if rows:
                at, s, k, d, text = zip(*rows, strict=True)
                own = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(own), hs.take(own), pa.array(s, pa.int32()), pa.array(k, pa.int64()),
                     pa.array(d, pa.binary()), pa.array(text, pa.binary())],
                    names=["id", "h", "start", "bucket", "digest", "packed"])

    parts = wanted.groupBy("id", "h").agg(F.collect_set(F.struct("start", "windows", "minimiser")).alias("parts"))
    may = bloom_column(bloom(wanted.select("h")))
    some = _keyed(docs).where(may("h")).join(parts, ["id", "h"]).select("id", "h", "text", "parts")
    return map_batches(some, of, "id long, h long, start int, bucket long, digest binary, packed binary")


def split_hot(once: DataFrame) -> DataFrame:
    """(digest, lows) for the strings of oversized buckets: window by window,
    the smallest id by a map-side combined aggregate over the window's digest."""
    def of(batch):
        for digest, packed, low, high in zip(*(batch.column(c).to_pylist() for c in ("digest", "packed", "low", "high")),
                                             strict=True):
            ws = packed.split(b" ")
            n = len(ws) - WINDOW + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest] * n, pa.binary()), pa.array(range(n), pa.int32()),
                 pa.array([hashlib.md5(b" ".join(ws[i:i + WINDOW])).digest() for i in range(n)], pa.binary()),
                 pa.array([low] * n, pa.int64()), pa.array([high] * n, pa.int64())],
                names=["digest", "at", "window", "low", "high"])

    windows = map_batches(once.select("digest", "packed", "low", "high"), of,
                          "digest binary, at int, window binary, low long, high long")
    windows = cut_lineage(windows)
    least = windows.groupBy("window").agg(F.min("low").alias("least"))
    got = (windows.join(least, "window").groupBy("digest")
           .agg(F.max("high").alias("high"), F.sort_array(F.collect_list(F.struct("at", "least"))).alias("w")))
    lows = F.transform("w", lambda x: x["least"])
    return (got.select("digest", lows.alias("lows"), "high")
            .where(F.exists("lows", lambda x: x < F.col("high"))).select("digest", "lows"))


def smallest_ids(strings: DataFrame) -> DataFrame:
    """(digest, lows): for each distinct packed string, the smallest doc_id of
    each of its windows; only for strings some document of which can lose words."""
    def close(key, held):
        """Sort all windows of one bucket."""
        texts, lows, highs, digests = zip(*held, strict=True)
        buf = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        _, _, h, first = T.words(buf, bounds)
        win = [T.window_hashes(h[a:b], WINDOW) for a, b in pairwise(first.tolist())]
        second = [T.window_hashes(T.mix(h[a:b] + T.U64(1)), WINDOW) for a, b in pairwise(first.tolist())]
        sizes = [len(w) for w in win]
        flat, check = np.concatenate(win), np.concatenate(second)       # 128 bits name a window
        low = np.repeat(np.array(lows, np.int64), sizes)
        order = np.lexsort((low, check, flat))
        new = np.ones(len(order), bool)
        new[1:] = (flat[order][1:] != flat[order][:-1]) | (check[order][1:] != check[order][:-1])
        least = np.empty(len(order), np.int64)
        least[order] = low[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        at = 0
        for n, digest, high in zip(sizes, digests, highs, strict=True):
            part = least[at:at + n]
            at += n
            if (part < high).any():
                yield digest, part

    def emit(found):
        digests, parts = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(parts, pa.list_(pa.int64()))],
                                          names=["digest", "lows"])

    def over(batches):
        key, held, found = None, [], []
        for batch in batches:
            for k, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "packed", "low", "high", "digest")), strict=True):
                if k != key and held:
                    found += close(key, held)
                    held = []
                    if len(found) >= 2000:
                        yield emit(found)
                        found = []
                key = k
                held.append(row)
        if held:
            found += close(key, held)
        if found:
            yield emit(found)

    once = cut_lineage(strings.groupBy("bucket", "digest", "packed")
                       .agg(F.min("id").alias("low"), F.max("id").alias("high")))
    hot = cut_lineage(once.groupBy("bucket").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select("bucket"))
    cold = once.join(hot, "bucket", "left_anti").repartition("bucket").sortWithinPartitions("bucket", "digest")
    sorted_out = cold.select("bucket", "packed", "low", "high", "digest").mapInArrow(over, "digest binary, lows array<bigint>")
    return sorted_out.unionByName(split_hot(once.join(hot, "bucket", "left_semi")))


def covered(docs: DataFrame) -> DataFrame:
    """(id, h, spans) of the documents that lose words; spans are (first
    word, end) of stretches of repeated windows."""
    all_parts = cut_lineage(stretches(docs))
    shared = (all_parts.groupBy("minimiser").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
              .where("lo < hi").select("minimiser"))
    wanted = cut_lineage(all_parts.join(shared, "minimiser").select("id", "h", "start", "windows", "minimiser"))
    strings = cut_lineage(packed_strings(docs, wanted))
    lows = cut_lineage(smallest_ids(strings))
    hit = strings.select("id", "h", "start", "digest").join(lows, "digest")
    dup = F.transform("lows", lambda x: x < F.col("id"))
    found = hit.where(F.exists("lows", lambda x: x < F.col("id"))).select("id", "h", "start", dup.alias("dup"))
    return cut_lineage(found.groupBy("id", "h").agg(F.collect_set(F.struct("start", "dup")).alias("found")))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(id, n_words, n_removed, kept) of every document: its words that no
    repeated window covers, joined by one space (UTF-8 bytes)."""
    def of(batch):
        lists = batch.column("found") if "found" in batch.schema.names else None
        for lo, hi, buf, bounds in T.text_chunks(batch.column("text")):
            start, end, first = T.runs((~T.IS_SPACE[buf]).view(np.uint8), bounds)
            raw = buf.tobytes()
            kept, removed = [], np.zeros(hi - lo, np.int64)
            for i in range(lo, hi):
                a, b = int(first[i - lo]), int(first[i - lo + 1])
                ws = [raw[x:y] for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)]
                found = lists[i].as_py() if lists is not None else None
                if found:
                    edge = np.zeros(len(ws) + 1, np.int64)
                    for f in found:
                        at = np.flatnonzero(f["dup"]) + f["start"]
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + WINDOW, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed[i - lo] = int(gone.sum())
                    ws = [ws[j] for j in np.flatnonzero(~gone).tolist()]
                kept.append(b" ".join(ws))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(removed),
                 pa.array(kept, pa.binary())], names=["id", "n_words", "n_removed", "kept"])

    schema = "id long, n_words long, n_removed long, kept binary"
    losing = covered(docs)
    may = bloom_column(bloom(losing.select("h")))
    marked = _keyed(docs).withColumn("may", may("h"))
    # Texts that the filter rules out lose nothing and are not shuffled.
    whole = map_batches(marked.where("NOT may").select("id", "text"), of, schema)
    cut = marked.where("may").join(losing, ["id", "h"], "left").select("id", "text", "found")
    return whole.unionByName(map_batches(cut, of, schema))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(F.when(F.col("id") < NULL_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed",
                       F.sha2("kept", 256).alias("kept_sha256"))
