"""Near-duplicate classes by circulant MinHash.

Each document's distinct word shingles are points of a ``2 ** SLOT_BITS``
circle. One permutation (sigma) scatters them, a second one (pi), shifted
circularly by 0, 1, ..., ``COORDINATES - 1``, gives all signature
coordinates: coordinate k is the minimum of pi at (sigma - k). ``ROWS``
coordinates make a band; a link of similarity 0.8 misses all 32 bands with
probability (1 - 0.8 ** 4) ** 32 < 5e-8.

Links are confirmed on the full shingle sets, in two steps that never list
all pairs of a bucket:

1. every member of a bucket against the bucket's smallest id; what that
   links is one component;
2. members of buckets that still hold several components: a prefix filter
   over all their shingles, rarest first. Two sets that reach the threshold
   must share a shingle within their prefixes, so pairs of different
   components that share a prefix shingle, and pass the length and position
   bounds, are all the links that can be missing.

Equal shingle sets are collapsed first, so copies cost one row each. Links
are between sets: a set's node is 64 bits of its digest, and doc_ids only
name the components.

Edge cases: null or wordless texts have an empty set, link with nothing and
are their own component; a null doc_id sorts after all ids (its component is
null unless it links to an id); repeated rows all come out, with equal
answers; rows that share a doc_id (or have none) but not a text are judged by
their text: unrelated ones are apart, though components of the same name, and
of near copies the smallest text hash is kept; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.components import components
from footlink.llm.frames import NULL_ID, bloom, cut_lineage, map_batches, release, without_rows

SLOT_BITS = 20
COORDINATES = 128
ROWS = 4
BANDS = COORDINATES // ROWS
BLOCK = 2048


@functools.cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """sigma, and pi laid out so that row s holds pi at s, s - 1, ... s - 127."""
    rng = np.random.default_rng(0xC1C)
    sigma = rng.permutation(1 << SLOT_BITS).astype(np.int32)
    pi = rng.permutation(1 << SLOT_BITS).astype(np.int32)
    around = np.concatenate([pi[-(COORDINATES - 1):], pi])
    return sigma, np.lib.stride_tricks.sliding_window_view(around, COORDINATES)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """``COORDINATES`` minima of a non-empty set (in order of falling shift)."""
    sigma, shifted = _permutations()
    at = sigma[(shingle_set >> T.U64(64 - SLOT_BITS)).astype(np.int64)]
    out = shifted[at[:BLOCK]].min(axis=0)
    for i in range(BLOCK, len(at), BLOCK):
        np.minimum(out, shifted[at[i:i + BLOCK]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature row."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(T.U64)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=T.U64), (len(sig), BANDS)).copy()
    for r in range(ROWS):
        acc = T.mix(acc * T.U64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return acc.view(np.int64)


def node(shingle_set: np.ndarray) -> int:
    """64 bits of the set's digest."""
    return int.from_bytes(hashlib.md5(shingle_set.tobytes()).digest()[:8], "little", signed=True)


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, bands); an empty set has null
    node and bands. A null id becomes ``NULL_ID``."""
    def of(batch):
        for lo, hi, buf, bounds in T.text_chunks(batch.column(2)):
            _, _, h, first = T.words(buf, bounds, lower=True)
            sizes, nodes, sigs, full = [], [], [], []
            for i, s in enumerate(T.shingles(h, first, k)):
                sizes.append(len(s))
                nodes.append(node(s) if len(s) else None)
                if len(s):
                    sigs.append(signature(s))
                    full.append(i)
            bands = [None] * (hi - lo)
            if sigs:
                for i, keys in zip(full, band_keys(np.array(sigs)), strict=True):
                    bands[i] = keys
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sizes, pa.int64()),
                 pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "node", "bands"])

    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                         F.xxhash64("text").alias("text_hash"), "text")
    return map_batches(source, of, "doc_id long, text_hash long, n_shingles long, node long, bands array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, items) of the nodes in ``ids`` (id, row), ``row`` being the hash of
    one document of the node. Sets are built where the text is read, for the
    rows that a bloom filter lets through; the exact join then moves sets of
    long, not text. A repeated row gives its set once."""
    held = bloom(ids.select("row"))

    def of(batches):
        seen = set()
        for batch in batches:
            some = batch.filter(pa.array(held(batch.column(0))))
            for _, _, buf, bounds in T.text_chunks(some.column(1)):
                _, _, h, first = T.words(buf, bounds, lower=True)
                found = {}
                for s in T.shingles(h, first, k):
                    if len(s) and (i := node(s)) not in seen:
                        seen.add(i)
                        found[i] = s.view(np.int64)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))],
                        names=["id", "items"])
            release()

    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    source = docs.select(F.xxhash64(id_, F.xxhash64("text")).alias("row"), "text")
    return (source.mapInArrow(of, "id long, items array<long>").join(ids.select("id"), "id", "left_semi")
            .groupBy("id").agg(F.first("items").alias("items")))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("b_items"))
    common = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - F.col("common")
    return (pairs.join(right, "b").join(left, "a").withColumn("common", common)
            .where(100 * F.col("common") >= percent * union).select("a", "b"))


def _labelled(ids: DataFrame, comps: DataFrame) -> DataFrame:
    return (ids.join(comps.withColumnRenamed("id", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep")))


def remaining_pairs(members: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that may still reach the similarity, among the
    members of buckets that hold several components (prefix filter)."""
    held = _labelled(members.select("key", "rep"), comps)
    mixed = (held.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("key"))
    open_ids = _labelled(held.join(mixed, "key", "left_semi").select("rep").distinct(), comps)
    tokens = cut_lineage(sets.join(open_ids, sets.id == open_ids.rep)
                         .select("id", "component", F.size("items").alias("n"), F.explode("items").alias("token")))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # Shingles of one document come first in the order and pair with nothing,
    # so only their number matters.
    ordered = (tokens.join(shared, "token").groupBy("id", "component", "n")
               .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t")))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1 - (F.col("n") - F.size("t"))
    prefix = cut_lineage(ordered.where(length > 0)
                         .select("id", "component", "n", F.posexplode(F.slice("t", 1, length)).alias("i", "x"),
                                 (F.col("n") - F.size("t")).alias("own"))
                         .select("id", "component", "n", F.col("x.token").alias("token"),
                                 (F.col("own") + F.col("i")).alias("at")))
    per = prefix.groupBy("token", "component").agg(F.count("*").alias("c"))
    main = (per.groupBy("token").agg(F.max_by("component", F.struct("c", "component")).alias("main"),
                                     F.count("*").alias("parts")).where("parts > 1").select("token", "main"))
    # Only documents outside a shingle's largest component look for partners.
    seekers = prefix.join(main, "token").where("component <> main").drop("main").alias("x")
    others = prefix.join(main.select("token"), "token", "left_semi").alias("y")
    short, long = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    need = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    reach = 1 + F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) - 1
    hit = ((F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component"))
           & (100 * short >= percent * long) & (reach >= need))
    return (seekers.join(others, hit)
            .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: (doc_id, text_hash, n_shingles, component_id,
    kept); ``kept`` marks the smallest (doc_id, text_hash) of each component."""
    rows = cut_lineage(sketch(docs, k))
    # A set's bands depend on the set alone, so any document of it will do.
    classes = cut_lineage(rows.where("node IS NOT NULL").groupBy(F.col("node").alias("rep"))
                          .agg(F.min(F.struct("doc_id", "text_hash")).alias("best"), F.first("bands").alias("bands")))
    bands = classes.select("rep", F.col("best.doc_id").alias("at"), F.explode("bands").alias("key"))
    # The smallest doc_id is often the text that the others were made from, so
    # a star round it leaves the fewest links open.
    buckets = (bands.groupBy("key").agg(F.min(F.struct("at", "rep")).alias("head"), F.count("*").alias("c"))
               .where("c > 1").select("key", F.col("head.rep").alias("lo")))
    members = cut_lineage(bands.drop("at").join(buckets, "key"))
    best = classes.select("rep", "best")
    ids = cut_lineage(best.join(members.select("rep"), "rep", "left_semi")
                      .select(F.col("rep").alias("id"), F.xxhash64("best.doc_id", "best.text_hash").alias("row")))
    sets = cut_lineage(shingle_sets(docs, ids, k))
    stars = members.where("rep <> lo").select(F.col("lo").alias("a"), F.col("rep").alias("b")).distinct()
    links = cut_lineage(confirm(stars, sets, percent))
    first = cut_lineage(components(links))
    more = cut_lineage(confirm(remaining_pairs(members, sets, first, percent), sets, percent))
    final = components(first.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    linked = cut_lineage(final.join(best.withColumnRenamed("rep", "id"), "id"))
    heads = linked.groupBy("component").agg(F.min("best").alias("head"))
    heads = linked.join(heads, "component").select(F.col("id").alias("rep"), "head")
    named = (best.join(heads, "rep", "left")
             .select(F.col("rep").alias("node"), F.coalesce("head", "best").alias("head")))
    out = (rows.select("doc_id", "text_hash", "n_shingles", "node").join(named, "node", "left")
           .withColumn("head", F.coalesce("head", F.struct("doc_id", "text_hash"))))
    shown = {c: F.when(F.col(c) < NULL_ID, F.col(c)) for c in ("doc_id", "head.doc_id")}
    return out.select(shown["doc_id"].alias("doc_id"), "text_hash", "n_shingles",
                      shown["head.doc_id"].alias("component_id"),
                      (F.struct("doc_id", "text_hash") == F.col("head")).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate class, the smallest
    doc_id (and text hash); a row repeated in full stays once."""
    found = cut_lineage(near_duplicates(docs, k, percent)
                        .withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID))))
    repeated = (found.where("kept").groupBy("doc_id", "text_hash").agg(F.count("*").alias("c"))
                .where("c > 1").select("doc_id", "text_hash"))
    return without_rows(docs, found.where("NOT kept").select("doc_id", "text_hash").distinct(), repeated)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from footlink.llm.frames import table
    return near_duplicates(table(spark, sf_dir, "documents"), k=4).select("doc_id", "n_shingles", "component_id", "kept")
