"""Toxicity by non-negative positive-unlabelled learning.

Positives are confirmed toxic rows (label toxic = 1); the unlabelled rows are
drawn from all text. Features are the distinct hashed words and byte n-grams of a
document (ASCII letters in lower case). Those clearly commoner among the
positives are kept, and a numpy logistic model over their presence minimises
the risk of Kiryo et al. (NeurIPS 2017)

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

by gradient descent over the whole sample (in small batches the share of
hidden positives varies too much); while the corrected negative part is below
zero, steps go back along that part. The prior is the share of toxic rows
among all labelled rows outside fold 0.

Training reads a bounded sample: at most ``POSITIVES`` positive and
``UNLABELLED`` other rows, none of fold 0. Scoring reads every whole text.

Edge cases: null, empty and wordless texts have no features and get the
score of the bias alone; without positives every score is below 0.5; a null
doc_id counts as held out; repeated rows score alike; of rows that share a
sampled doc_id the least text is learnt from; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.frames import held_out, map_batches, smallest_by_hash, table
from footlink.llm.subwords import subword_hashes

POSITIVES = 1500
UNLABELLED = 4500
SIZES = (4, 5)
MIN_SUPPORT = 3
LIFT_SHARE = 0.3
EPOCHS = 200
RATE = 0.05
DECAY = 1e-2
BATCHES = 1
FILTER_BITS = 22


@dataclass
class Model:
    """Kept features (sorted 32-bit hashes), their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def maybe(self) -> np.ndarray:
        """Table over the top bits of a hash: may it be a kept feature?"""
        out = np.zeros(1 << FILTER_BITS, bool)
        out[self.features >> np.uint32(32 - FILTER_BITS)] = True
        return out

    def score(self, buf: np.ndarray, bounds: np.ndarray, maybe: np.ndarray) -> np.ndarray:
        h, doc = _features(buf, bounds)
        some = np.flatnonzero(maybe[h >> np.uint32(32 - FILTER_BITS)])
        h, doc = h[some], doc[some]
        at = np.minimum(np.searchsorted(self.features, h), max(len(self.features) - 1, 0))
        hit = self.features[at] == h if len(self.features) else np.zeros(len(h), bool)
        pair = np.unique(doc[hit].astype(np.int64) * len(self.features) + at[hit])
        n = max(len(self.features), 1)
        logit = self.bias + np.bincount(pair // n, weights=self.weights[pair % n], minlength=len(bounds) - 1)
        return _sigmoid(logit)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _features(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, doc = subword_hashes(buf, bounds, SIZES, T.BYTE_CODE_LOWER)
    return (h >> T.U64(32)).astype(np.uint32), doc


def train(docs: list[np.ndarray], positive: np.ndarray, prior: float) -> Model:
    """``docs``: distinct features of each training document."""
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    if not n_p or not n_u:
        return Model(np.zeros(0, np.uint32), np.zeros(0), float(np.log(max(prior, 1e-3) / (2 - max(prior, 1e-3)))))
    every = np.concatenate(docs)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    names, column = np.unique(every, return_inverse=True)
    in_p = np.bincount(column, weights=positive[owner], minlength=len(names))
    in_u = np.bincount(column, minlength=len(names)) - in_p
    # A feature of toxic text alone is 1 / prior times commoner among the
    # positives; counts are moved by their standard error against the feature.
    lift = ((in_p - np.sqrt(in_p)) / n_p) / ((in_u + np.sqrt(in_u) + 1) / n_u)
    keep = (in_p >= MIN_SUPPORT) & (lift >= LIFT_SHARE / prior)
    place = np.cumsum(keep) - 1
    used = keep[column]
    owner, column = owner[used], place[column[used]]
    first = np.searchsorted(owner, np.arange(len(docs) + 1))
    weights, bias = np.zeros(int(keep.sum())), float(np.log(prior / (1 - prior)))
    mean_g, mean_sq, step = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1), 0
    rng = np.random.default_rng(0)
    p_rows, u_rows = np.flatnonzero(positive), np.flatnonzero(~positive)
    batches = min(BATCHES, n_p, n_u)
    for _ in range(EPOCHS):
        for p, u in zip(np.array_split(rng.permutation(p_rows), batches), np.array_split(rng.permutation(u_rows), batches),
                        strict=True):
            if not len(p) or not len(u):
                continue
            rows = np.concatenate([p, u])
            size = first[rows + 1] - first[rows]
            doc = np.repeat(np.arange(len(rows)), size)
            col = column[np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
            f = bias + np.bincount(doc, weights=weights[col], minlength=len(rows))
            s = _sigmoid(f)
            is_p = np.arange(len(rows)) < len(p)
            soft = np.logaddexp(0, f)
            negative = soft[~is_p].mean() - prior * soft[is_p].mean()
            # d/df of the corrected negative part, then of the positive part
            g_neg = np.where(is_p, -prior * s / len(p), s / len(u))
            g_pos = np.where(is_p, prior * (s - 1) / len(p), 0.0)
            g = g_pos + g_neg if negative >= 0 else -g_neg
            grad = np.append(np.bincount(col, weights=g[doc], minlength=len(weights)) + DECAY * prior * weights, g.sum())
            step += 1
            mean_g = 0.9 * mean_g + 0.1 * grad
            mean_sq = 0.99 * mean_sq + 0.01 * grad * grad
            move = RATE * (mean_g / (1 - 0.9 ** step)) / (np.sqrt(mean_sq / (1 - 0.99 ** step)) + 1e-8)
            weights -= move[:-1]
            bias -= move[-1]
    return Model(names[keep], weights, bias)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample; the prior is counted over all labels."""
    known = (labels.where("toxic IS NOT NULL").where(~held_out()).groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")))
    share = known.agg(F.avg("toxic")).first()[0]
    toxic = known.where("toxic = 1")
    positives = smallest_by_hash(toxic.select("doc_id"), POSITIVES).withColumn("positive", F.lit(True))
    # The unlabelled rows stand for all text, so they are drawn from every
    # row of the training folds: one that is also a positive counts in both.
    others = (smallest_by_hash(docs.where(~held_out()).select("doc_id").distinct(), UNLABELLED)
              .withColumn("positive", F.lit(False)))
    chosen = positives.unionByName(others)

    def of(batch):
        for lo, hi, buf, bounds in T.text_chunks(batch.column(1)):
            h, doc = _features(buf, bounds)
            order = np.unique(doc.astype(np.uint64) << np.uint64(32) | h)
            cut = np.searchsorted(order >> np.uint64(32), np.arange(hi - lo + 1))
            low = (order & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo),
                 pa.array([low[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                names=["positive", "features"])

    # Bound: POSITIVES + UNLABELLED ids, then the features of as many texts
    # (the least text of an id that repeats, combined before the shuffle).
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id", "positive").agg(F.min("text").alias("text")).select("positive", "text"))
    got = map_batches(sample, of, "positive boolean, features binary").toArrow()
    rows = sorted(zip(got["positive"].to_pylist(), got["features"].to_pylist(), strict=True), key=lambda r: r[1])
    return train([np.frombuffer(f, np.uint32) for _, f in rows], np.array([p for p, _ in rows], bool),
                 min(max(float(share or 0), 1e-3), 0.9))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model, model.maybe()))

    def of(batch):
        own, maybe = shared.value
        for lo, hi, buf, bounds in T.text_chunks(batch.column(1), 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(own.score(buf, bounds, maybe))],
                                             names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (map_batches(docs.select("doc_id", "text"), of, f"doc_id {kind}, score double")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, fit(docs, labels))
