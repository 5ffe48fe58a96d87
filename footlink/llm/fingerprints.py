"""One-permutation MinHash fingerprints.

Each distinct shingle hash is used once: its top bits choose one of ``BINS``
bins, the rest competes for the bin's minimum. An empty bin takes the value
of a filled one, the first that a sequence of bins meets which depends on the
empty bin and the attempt alone (optimal densification, Shrivastava, ICML
2017), however long it takes.
``BITS`` low-order bits of each bin are packed; two fingerprints agree by
chance in 2 ** -BITS of their bins, and ``likeness`` corrects for it.

The next document, for the comparison of the query, is found without a
global window: documents go once, whole, to chunks of consecutive ids and
text hashes; the first document of each chunk also goes to the chunk before.
Only rows repeated in full (equal id and text) share a chunk whatever their number.

Edge cases: null text counts as empty; an empty text has the fingerprint of
all zeros behind the mark ``-`` and is like another empty one (1) and unlike
any other (0); with fewer words than a shingle, all of them are one; null
ids come last; documents of equal id follow each other by text hash; a
single document is its own next; repeated rows all come out.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.frames import NULL_ID, cut_lineage, table

BINS = 512
BITS = 4
SHINGLE = 5
ATTEMPTS = 64          # in one step; the steps go on until a filled bin is met
ROWS_PER_CHUNK = 2000
SAMPLE_PER_CHUNK = 20


def _probes(block: int, bins: np.ndarray) -> np.ndarray:
    """Bins tried in the ``ATTEMPTS`` attempts of a block, for each empty bin."""
    at = np.arange(block * ATTEMPTS, (block + 1) * ATTEMPTS, dtype=np.uint64)
    return (T.mix(at[:, None] * T.U64(BINS) + bins.astype(np.uint64) + T.U64(0xD0F)) % T.U64(BINS)).astype(np.int64)


@functools.cache
def _first_probes() -> np.ndarray:
    return _probes(0, np.arange(BINS))


def bins_of(shingle_set: np.ndarray) -> np.ndarray:
    """The densified minimum of each bin of a non-empty set."""
    width = T.U64(64 - BINS.bit_length() + 1)
    at = (shingle_set >> width).astype(np.int64)
    out = np.full(BINS, T.U64(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(out, at, T.mix(shingle_set))
    filled = np.zeros(BINS, bool)
    filled[at] = True
    empty, block = np.flatnonzero(~filled), 0
    if len(shingle_set) == 1:                  # whatever is tried, it is this bin
        out[:] = out[at[0]]
        return out
    while len(empty):
        tried = _first_probes()[:, empty] if block == 0 else _probes(block, empty)
        hit = filled[tried]
        found = hit.any(axis=0)
        from_bin = tried[hit.argmax(axis=0), np.arange(len(empty))]
        out[empty[found]] = out[from_bin[found]]
        empty, block = empty[~found], block + 1
    return out


def fingerprint(shingle_set: np.ndarray) -> bytes:
    """Packed low-order bits; empty for an empty set."""
    if not len(shingle_set):
        return b""
    low = (bins_of(shingle_set) & T.U64((1 << BITS) - 1)).astype(np.uint8)
    bits = (low[:, None] >> np.arange(BITS - 1, -1, -1, dtype=np.uint8)) & 1
    return np.packbits(bits.ravel()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated similarity of two fingerprints' sets, corrected for chance."""
    if not a or not b:
        return float(a == b)
    both = np.unpackbits(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).reshape(BINS, BITS)
    agree = float((~both.any(axis=1)).mean())
    chance = 2.0 ** -BITS
    return min(1.0, max(0.0, (agree - chance) / (1 - chance)))


def text_form(fp: bytes) -> str:
    return fp.hex() if fp else "-" + "0" * (BINS * BITS // 4)


def fingerprints(texts: list[str]) -> list[bytes]:
    raw = [t.encode("utf-8", "replace") for t in texts]
    out: list[bytes] = []
    for _, _, buf, bounds in T.text_chunks(pa.array(raw, pa.large_binary())):
        _, _, h, first = T.words(buf, bounds)
        out += [fingerprint(s) for s in T.shingles(h, first, SHINGLE)]
    return out


def edited(text: str, following: str) -> str:
    """The last quarter of the text, replaced by the start of another."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _at_or_before(cuts: tuple, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Number of cuts (sorted pairs of id and text hash) not after each row."""
    lo, hi = np.searchsorted(cuts[0], ids, "left"), np.searchsorted(cuts[0], ids, "right")
    for i in np.unique(ids[lo < hi]):
        same = np.flatnonzero(ids == i)
        first, end = lo[same[0]], hi[same[0]]
        lo[same] += np.searchsorted(cuts[1][first:end], hashes[same], "right")
    return lo


def with_next(docs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(chunk, id, text_hash, text, own): documents in chunks of consecutive
    (id, text hash), so that a frequent id is split; ``own`` is false for the
    one copy of the first document of the next chunk (for the last chunk, of
    the first document of all)."""
    def keyed(some: DataFrame) -> DataFrame:
        return (some.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                            F.coalesce("text", F.lit("")).alias("text"))
                .select("id", F.xxhash64("text").alias("text_hash"), "text"))

    spark = docs.sparkSession
    n = docs.count()
    chunks = max(1, -(-n // rows_per_chunk))
    # Bounds from a sample of the keys, as a range exchange takes them. Every
    # bound gives the same pairs; only the sizes of the chunks depend on it.
    cuts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if chunks > 1:
        share = min(1.0, SAMPLE_PER_CHUNK * chunks / n)
        got = keyed(docs.sample(share, seed=17) if share < 1 else docs).select("id", "text_hash").toArrow()
        ids, hashes = (got[c].to_numpy() for c in ("id", "text_hash"))
        order = np.lexsort((hashes, ids))
        taken = sorted({(int(ids[i]), int(hashes[i])) for i in order[[len(order) * c // chunks for c in range(1, chunks)]]}
                       if len(order) else ())
        cuts = np.array([i for i, _ in taken], np.int64), np.array([h for _, h in taken], np.int64)
    edges = spark.sparkContext.broadcast(cuts)                                      # one pair per chunk

    @F.arrow_udf("long")
    def chunk_of(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array(_at_or_before(edges.value, *(c.to_numpy(zero_copy_only=False) for c in (ids, hashes)))
                        .astype(np.int64))

    own = keyed(docs).withColumn("chunk", chunk_of("id", "text_hash"))
    firsts = sorted((r["c"], *r["first"]) for r in own.select("id", "text_hash", F.col("chunk").alias("c")).groupBy("c")
                    .agg(F.min(F.struct("id", "text_hash")).alias("first")).collect())
    places = [c for c, _, _ in firsts]
    starts = spark.createDataFrame([(i, h, before) for (_, i, h), before in
                                    zip(firsts, places[-1:] + places[:-1], strict=True)],
                                   "id long, text_hash long, chunk long")
    foreign = keyed(docs).join(F.broadcast(starts), ["id", "text_hash"]).dropDuplicates(["id", "text_hash"])
    names = ["chunk", "id", "text_hash", "text"]
    return (own.select(*names, F.lit(True).alias("own"))
            .unionByName(foreign.select(*names, F.lit(False).alias("own"))))


def compare_with_next(docs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """One row per document, see ``query``."""
    placed = with_next(docs, rows_per_chunk)
    spread = placed.repartition("chunk").sortWithinPartitions("chunk", F.desc("own"), "id", "text_hash")

    def of(batches):
        held = None                                    # the document still waiting for its next one
        done = False                                   # the chunk's first foreign document has been used
        for batch in batches:
            for lo, hi, buf, bounds in T.text_chunks(batch.column("text")):
                raw = buf.tobytes()
                part = batch.slice(lo, hi - lo)
                fields = zip(*(part.column(c).to_pylist() for c in ("chunk", "id", "own")), strict=True)
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                fps = fingerprints(texts)
                rows, held, done = _pair_up(fields, texts, fps, held, done)
                if rows:
                    yield _result(rows)

    def _result(rows):
        new = [edited(t, following) for _, t, _, following, _ in rows]
        fps = fingerprints(new)
        out = [(i, len(t), hashlib.sha256(e.encode("utf-8", "replace")).hexdigest(), text_form(f), text_form(g),
                likeness(f, g), likeness(f, h)) for (i, t, f, _, h), e, g in zip(rows, new, fps, strict=True)]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)

    got = spread.mapInArrow(of, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
    return got.withColumn("doc_id", F.when(F.col("doc_id") < NULL_ID, F.col("doc_id")))


def _pair_up(fields, texts, fps, held, done):
    """Pairs each waiting document with the one that follows in its chunk;
    of the foreign documents only a chunk's first is used."""
    rows = []
    for (chunk, i, own), text, fp in zip(fields, texts, fps, strict=True):
        if held is not None and held[0] == chunk and not done:
            rows.append((held[1], held[2], held[3], text, fp))
        if own:
            held, done = (chunk, i, text, fp), False
        else:
            done = True
    return rows, held, done


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every document."""
    return compare_with_next(table(spark, sf_dir, "documents"))


__all__ = ["bins_of", "compare_with_next", "cut_lineage", "edited", "fingerprint", "fingerprints", "likeness", "query"]
