"""Quality rules: base rules plus a hashed n-gram log-likelihood ratio.

Two multinomials over hashed unigrams and bigrams are counted: ``target``
over a bounded sample of trusted rows (label quality = 1, at most
``TRUSTED_ROWS`` of them) and ``raw`` over every document. A document's score
is the mean log ratio of its n-grams; it is kept when no base rule fails and
the score reaches ``THRESHOLD``. There is no random draw: every document is
judged by the same threshold.

The target is smoothed towards the raw distribution: ``PRIOR_SHARE`` pseudo
n-grams for each of its own, so an n-gram that the target lacks weighs the same
whatever the size of the tables. Without trusted text all scores are 0 and
the method rejects nothing.

Edge cases: a null text counts as empty (no words: ``base_failed``); a text
without n-grams scores 0; an empty labels table gives score 0 everywhere;
repeated rows are judged alike, each returned; extra columns are ignored by
``score`` and kept by ``accepted``; null doc_ids are scored as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.frames import cut_lineage, map_batches, smallest_by_hash

BUCKET_BITS = 14
TRUSTED_ROWS = 20_000
PRIOR_SHARE = 0.05
THRESHOLD = -0.4
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(b"#*$%&|<>")] = 1
# Token classes of the ratio: space 0, word byte 1 (letters, digits, _ and
# everything outside ASCII), other ASCII 2.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = 1
_CLASS[T.IS_SPACE] = 0


def ngram_buckets(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each unigram and bigram of a chunk, with its document."""
    start, end, first = T.runs(_CLASS[buf], bounds)
    h = T.run_hashes(buf, start, end, T.BYTE_CODE_LOWER)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    pair = T.window_hashes(h, 2)
    same = doc[1:] == doc[:-1] if len(doc) > 1 else np.zeros(0, bool)
    shift = T.U64(64 - BUCKET_BITS)
    return (np.concatenate([h >> shift, pair[same] >> shift]).astype(np.int64),
            np.concatenate([doc, doc[:-1][same] if len(doc) else doc]))


def count_ngrams(docs: DataFrame, flag: str) -> DataFrame:
    """(bucket, n_target, n_raw) over all documents; ``flag`` marks the
    trusted rows. Each task sends at most one row per bucket."""
    size = 1 << BUCKET_BITS

    def count(batches):
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            marked = np.asarray(batch.column(1).to_pylist(), bool)
            for lo, hi, buf, bounds in T.text_chunks(batch.column(0)):
                bucket, doc = ngram_buckets(buf, bounds)
                raw += np.bincount(bucket, minlength=size)
                target += np.bincount(bucket[marked[lo:hi][doc]], minlength=size)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(target[seen]), pa.array(raw[seen])],
                                         names=["bucket", "n_target", "n_raw"])

    parts = docs.select("text", flag).mapInArrow(count, "bucket long, n_target long, n_raw long")
    return parts.groupBy("bucket").agg(F.sum("n_target").alias("n_target"), F.sum("n_raw").alias("n_raw"))


def log_ratio(counts: list[tuple[int, int, int]]) -> np.ndarray:
    """log target/raw per bucket; 0 for buckets never seen."""
    out = np.zeros(1 << BUCKET_BITS)
    if not counts:
        return out
    b, t, r = (np.array(c) for c in zip(*counts, strict=True))
    if not t.sum():
        return out
    p_raw, prior = r / r.sum(), PRIOR_SHARE * t.sum()
    p_target = (t + prior * p_raw) / (t.sum() + prior)
    out[b] = np.log(p_target) - np.log(p_raw)
    return out


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Ratio table of ``2 ** BUCKET_BITS`` doubles: its size is fixed, so it
    may go through the driver; the counting runs in the cluster."""
    trusted = smallest_by_hash(labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct(),
                               TRUSTED_ROWS).withColumn("_trusted", F.lit(True))
    marked = (docs.select("doc_id", "text").join(F.broadcast(trusted), "doc_id", "left")  # bound: TRUSTED_ROWS ids
              .select("text", F.coalesce("_trusted", F.lit(False)).alias("_trusted")))
    return log_ratio([tuple(r) for r in count_ngrams(marked, "_trusted").collect()])


def measure(buf: np.ndarray, bounds: np.ndarray, ratio: np.ndarray) -> dict[str, np.ndarray]:
    """Base measures and score of each document of a chunk."""
    _, _, h, first = T.words(buf, bounds)
    n = np.diff(first)
    n_docs = len(n)
    doc = np.repeat(np.arange(n_docs), n)
    # 5-word windows occurring twice in one document: sort salted hashes once.
    win = T.window_hashes(h, 5)
    start = np.flatnonzero(doc[4:] == doc[:len(win)]) if len(win) else np.zeros(0, np.int64)
    salted = T.mix(win[start] + doc[start].astype(T.U64) * T.U64(0xA24BAED4963EE407))
    order = np.argsort(salted, kind="stable")
    same = salted[order[1:]] == salted[order[:-1]]
    twice = np.zeros(len(start), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int32)
    np.add.at(edge, start[twice], 1)
    np.add.at(edge, start[twice] + 5, -1)
    dup = np.zeros(n_docs, np.int64)
    raw = buf.tobytes()
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        lines = [x for x in raw[a:b].split(b"\n") if x.strip(b" \t\v\f\r")]
        dup[i] = len(lines) - len(set(lines))
    bucket, owner = ngram_buckets(buf, bounds)
    grams = np.bincount(owner, minlength=n_docs)
    total = np.bincount(owner, weights=ratio[bucket], minlength=n_docs)
    return {
        "n_words": n,
        "word_chars": T.per_document(~T.IS_SPACE[buf] & ((buf & 0xC0) != 0x80), bounds),
        "n_symbols": T.per_document(_SYMBOL[buf], bounds),
        "n_dup_lines": dup,
        "n_repeat_words": T.per_document(np.cumsum(edge[:-1]) > 0, first),
        "score": np.round(total / np.maximum(grams, 1), 9),
    }


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def score(docs: DataFrame, ratio: np.ndarray, key: list[str]) -> DataFrame:
    """``key`` columns plus measures, ``base_failed``, ``score`` and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)     # 2 ** BUCKET_BITS doubles

    def judge(batch):
        at = batch.schema.get_field_index("text")
        keys = [i for i in range(batch.num_columns) if i != at]
        for lo, hi, buf, bounds in T.text_chunks(batch.column(at)):
            m = measure(buf, bounds, shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(lo, hi - lo) for i in keys] + [pa.array(m[c]) for c in (*MEASURES, "score")],
                names=[batch.schema.names[i] for i in keys] + [*MEASURES, "score"])

    source = docs.select(*key, *([] if "text" in key else ["text"]))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "text")
    out = map_batches(source, judge, f"{types}, {', '.join(c + ' long' for c in MEASURES)}, score double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("score") >= THRESHOLD)))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: measures, verdict and score."""
    return score(docs, fit(docs, labels), ["doc_id"])


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. The text
    goes through the same task that judges it, so nothing is joined back."""
    ratio = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def keep(batch):
        at = batch.schema.get_field_index("text")
        for lo, hi, buf, bounds in T.text_chunks(batch.column(at)):
            m = measure(buf, bounds, ratio.value)
            bad = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
            yield batch.slice(lo, hi - lo).filter(pa.array(~bad & (m["score"] >= THRESHOLD)))

    return map_batches(docs, keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from footlink.llm.frames import table
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judge_documents(docs, labels).select("doc_id", *MEASURES, "base_failed", "kept", "score")


__all__ = ["accepted", "count_ngrams", "cut_lineage", "fit", "judge_documents", "log_ratio", "measure", "query", "score"]
