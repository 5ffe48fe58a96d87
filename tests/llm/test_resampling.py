"""Target resampling against a plain version."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as E
from footlink.llm import target_resampling as R

from .conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOW))
    return w, [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10_000


def plain(docs, target, percent=5, min_words=20):
    """Rows (doc_id, n_features, weight, score, rank) for (doc_id, text) rows."""
    raw, want = np.zeros(10_000, int), np.zeros(10_000, int)
    for _, t in docs:
        np.add.at(raw, [bucket(f) for f in features(t)[1]], 1)
    for t in target:
        np.add.at(want, [bucket(f) for f in features(t)[1]], 1)
    s, t = float(raw.sum() + 10_000), float(want.sum() + 10_000)
    gain = [math.floor(1000 * math.log((float(b + 1) * s) / (float(a + 1) * t))) for a, b in zip(raw, want, strict=True)]
    rows = []
    for i, text in docs:
        w, f = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(f), weight, score, len(w) >= min_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    n = percent * len(order) // 100
    out = [(*r[:4], k + 1) for k, r in enumerate(order[:n])] + [(*r[:4], None) for r in order[n:]]
    return out + [(*r[:4], None) for r in rows if not r[4]]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_resampling_equals_plain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = [tuple(r) for r in E.queries()["op13_target_resampling"](spark, SF).collect()]
    want = plain(docs, target)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[4] is not None for r in want) > 5


def test_crcs_of_any_words():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, n).tolist()).decode() for n in (1, 2, 47, 48, 49, 300, 5, 100_000, 1, 48)]
    text = " ".join(["Ab", *words, "é漢字", "Z9"]) + "\nnext-doc x"
    raw = np.frombuffer((text + "one two").encode(), np.uint8)
    cut = len(text.encode())
    got, doc, n = R.feature_buckets(raw, np.array([0, cut, cut, len(raw)]))
    for i, t in enumerate((text, "", "one two")):
        w, f = features(t)
        assert n[i] == len(w) and sorted(got[doc == i].tolist()) == sorted(map(bucket, f))


@pytest.mark.parametrize("percent", [0, 1, 30, 55, 100])
def test_odd_rows_and_ties(spark, odd, percent):
    """Many rows tied in score and id (repeated rows), null ids and texts."""
    many = odd.unionByName(odd.where("doc_id = 5")).unionByName(odd.where("doc_id IS NULL").withColumn("text", odd.text))
    docs = [(r.doc_id, r.text) for r in many.collect()]
    target = odd.where("doc_id = 4")
    got = [tuple(r) for r in R.resample(many, target, percent, 3).collect()]
    want = plain(docs, [r.text for r in target.collect()], percent, 3)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_cutoff_bisects_every_key(spark):
    """A third of the rows tied at the cutoff, in score and in id."""
    rng = np.random.default_rng(2)
    rows = [(int(s), int(i), r) for r, (s, i) in enumerate(zip(rng.integers(-3, 3, 900), rng.integers(0, 4, 900), strict=True))]
    rows += [(0, 1 << 40, 900 + r) for r in range(500)]
    df = spark.createDataFrame(rows, "_score long, _id long, _row long").cache()
    ordered = sorted(rows)
    for n in (1, 449, 450, 700, 1000, 1399, 1400):
        cond = R.cutoff(df, ["_score", "_id", "_row"], n)
        assert sorted(map(tuple, df.where(cond).collect())) == ordered[:n]


def test_empty_tables(spark, odd):
    assert R.resample(odd.limit(0), odd).count() == 0
    got = R.resample(odd, odd.limit(0))
    assert got.count() == odd.count() and got.where("rank IS NOT NULL").count() == 0
