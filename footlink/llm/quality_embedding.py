"""Quality classifier with supervised subword embeddings.

Every word, every byte n-gram inside a word and every pair of neighbouring
words is hashed to one of ``2 ** BUCKET_BITS`` learned vectors; a document is
the mean of its vectors, and a softmax over it gives the class. Vectors and
output weights are trained together by numpy mini-batch gradient descent on
at most ``PER_CLASS`` labelled rows of each class, none of fold 0.

After training, a bucket's vector only matters through its product with the
difference of the output weights, so scoring reads one number per feature.

Edge cases: null, empty and wordless texts have the zero vector and get the
score of the bias; without labels of both classes the score is 0.5
everywhere; a null doc_id counts as held out; repeated rows score alike;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.frames import held_out, map_batches, smallest_by_hash, table
from footlink.llm.subwords import subword_hashes

BUCKET_BITS = 17
DIMENSIONS = 8
SIZES = (2, 3)
PER_CLASS = 2000
EPOCHS = 12
BATCH = 64
RATE = 0.3
KEEP_AT = 0.3


def buckets(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, doc = subword_hashes(buf, bounds, SIZES, T.BYTE_CODE, bigrams=True)
    return (h >> T.U64(64 - BUCKET_BITS)).astype(np.int32), doc


def train(docs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> tuple[np.ndarray, float]:
    """``docs``: (buckets, share of the document's features) of each training
    row. Returns one weight per bucket and the bias, of class 1 against 0."""
    size = 1 << BUCKET_BITS
    if len(set(label.tolist())) < 2:
        return np.zeros(size, np.float32), 0.0
    rng = np.random.default_rng(0)
    vectors = rng.uniform(-1, 1, (size, DIMENSIONS)) / DIMENSIONS
    out, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    seen_v, seen_o = np.full(size, 1e-8), 1e-8
    truth = np.eye(2)[label]
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            at = np.concatenate([docs[i][0] for i in rows])
            value = np.concatenate([docs[i][1] for i in rows])
            doc = np.repeat(np.arange(len(rows)), [len(docs[i][0]) for i in rows])
            mean = np.stack([np.bincount(doc, weights=value * vectors[at, d], minlength=len(rows))
                             for d in range(DIMENSIONS)], axis=1)
            logit = mean @ out.T + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - truth[rows]) / len(rows)
            back = error @ out
            grad = np.stack([np.bincount(at, weights=value * back[doc, d], minlength=size)
                             for d in range(DIMENSIONS)], axis=1)
            seen_v += (grad * grad).mean(axis=1)
            vectors -= RATE * grad / np.sqrt(seen_v)[:, None]
            grad_out = error.T @ mean
            seen_o += (grad_out * grad_out).mean()
            out -= RATE * grad_out / np.sqrt(seen_o)
            bias -= RATE * error.sum(axis=0)
    step = out[1] - out[0]
    return (vectors @ step).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on the bounded sample; a doc_id with several labels takes the least."""
    known = (labels.where("quality IS NOT NULL").where(~held_out()).groupBy("doc_id")
             .agg(F.min("quality").alias("quality")))
    chosen = (smallest_by_hash(known.where("quality = 1"), PER_CLASS)
              .unionByName(smallest_by_hash(known.where("quality = 0"), PER_CLASS)))

    def of(batch):
        for lo, hi, buf, bounds in T.text_chunks(batch.column(1), 1 << 20):
            b, doc = buckets(buf, bounds)
            key, count = np.unique(doc.astype(np.int64) << BUCKET_BITS | b, return_counts=True)
            cut = np.searchsorted(key >> BUCKET_BITS, np.arange(hi - lo + 1))
            low = (key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo),
                 pa.array([low[a:c].tobytes() for a, c in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                 pa.array([(count[a:c] / max(count[a:c].sum(), 1)).astype(np.float32).tobytes()
                           for a, c in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                names=["quality", "bucket", "share"])

    # Bound: 2 * PER_CLASS ids, then the buckets of as many texts (the least
    # text of an id that repeats, combined before the shuffle).
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id", F.col("quality").cast("int").alias("quality")).agg(F.min("text").alias("text"))
              .select("quality", "text"))
    got = map_batches(sample, of, "quality int, bucket binary, share binary").toArrow()
    rows = sorted(zip(got["quality"].to_pylist(), got["bucket"].to_pylist(), got["share"].to_pylist(), strict=True))
    return train([(np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)) for _, b, s in rows],
                 np.array([q for q, _, _ in rows], np.int64))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # 2 ** BUCKET_BITS floats

    def of(batch):
        weight, bias = shared.value
        for lo, hi, buf, bounds in T.text_chunks(batch.column(1), 1 << 20):
            b, doc = buckets(buf, bounds)
            n = np.bincount(doc, minlength=hi - lo)
            logit = bias + np.bincount(doc, weights=weight[b], minlength=hi - lo) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40))))],
                names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (map_batches(docs.select("doc_id", "text"), of, f"doc_id {kind}, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= KEEP_AT).cast("int").alias("predicted")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, fit(docs, labels))
