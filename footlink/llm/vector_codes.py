"""Product-quantised vector codes, clustered with Drake-Hamerly bounds.

Components become integers; a vector is cut into ``PARTS`` equal parts and
each part position has a codebook of ``ENTRIES`` entries. ``ROUNDS`` rounds of
assignment and integer means follow, then a last assignment.

Every part keeps, in a table written once a round: its entry, an upper bound
of the distance to it, its ``b`` closest other entries with ordered lower
bounds, and one outer bound for all entries beyond those (Drake and Hamerly,
"Accelerated k-means with adaptive distance bounds", 2012). When the entries
have moved, bounds move with them. A part whose upper bound is below its first
lower bound keeps its entry without a distance. All others are uncertain and
are decided by exact integer distances, ties to the lower index: first to the
own entry alone, then to the close entries whose bounds it reaches, and to all
entries only if it reaches the outer bound. Bounds are floats rounded away
from each other, so they only ever choose what is computed, never a result.
``b`` starts at a quarter of the entries and falls, by part position, to
what all but one in ``SPARE`` parts needed in the last round.

A round is one pass: the tasks that assign also add up their parts, one row an
entry and task, beside the rows of the table. Codebooks (a fixed number of
integers) go through the driver; the table before is deleted as soon as the
next is complete.

Edge cases: vectors that are null, empty, or hold null or non-finite
components are dropped, and so are those whose length is not that of the
kept vector with the smallest vec_id, or that cannot be cut into equal parts;
integers beyond ``LIMIT`` (components of 32768 and more) saturate there, so
distances fit in 64 bits; a null vec_id comes after all ids; among equal
vec_ids the smaller vector comes first; with fewer vectors than entries
there are as many entries as vectors; repeated rows are coded one by one; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm.frames import cut_lineage, ensure_checkpoint_dir, lookup, release

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LIMIT = 1 << 27
SPARE = 100

STATE = ("vec_id long, label {label}, ints binary, code binary, upper binary, near binary, lower binary, "
         "outer binary, slot int, total array<long>")


def _down(x: np.ndarray) -> np.ndarray:
    x = x * (1 - 1e-12)
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


def _up(x: np.ndarray) -> np.ndarray:
    x = x * (1 + 1e-12)
    y = x.astype(np.float32)
    return np.where(y < x, np.nextafter(y, np.float32(np.inf)), y)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared integer distances of parts (n, w) to entries (k, w)."""
    out = np.empty((len(x), len(entries)), np.int64)
    for j, c in enumerate(entries):
        diff = x - c
        out[:, j] = (diff * diff).sum(1)
    return out


@dataclass
class Bounds:
    """The state of one part position: entry, upper bound, close entries with
    ordered lower bounds, outer bound."""
    code: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    def put(self, rows: np.ndarray, other: Bounds) -> None:
        for name in ("code", "upper", "near", "lower", "outer"):
            getattr(self, name)[rows] = getattr(other, name)


def scan(x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
    """State from the distances to all entries."""
    d = distances(x, entries)
    order = np.argsort(d, axis=1, kind="stable")
    far = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
    outer = far[:, b + 1] if b + 1 < len(entries) else np.full(len(x), np.inf)
    return Bounds(order[:, 0].astype(np.uint8), _up(far[:, 0]), order[:, 1:b + 1].astype(np.uint8),
                  _down(far[:, 1:b + 1]), _down(outer))


def moved(s: Bounds, drift: np.ndarray, b: int) -> Bounds:
    """The bounds after the entries moved by ``drift``, cut to ``b`` entries."""
    upper = _up(s.upper.astype(np.float64) + drift[s.code])
    bounds = np.concatenate([s.lower - drift[s.near], (s.outer - drift.max())[:, None]], 1)
    bounds = _down(np.minimum.accumulate(bounds[:, ::-1], 1)[:, ::-1])
    return Bounds(s.code, upper, s.near[:, :b], bounds[:, :b], bounds[:, b])


def settle(x: np.ndarray, entries: np.ndarray, s: Bounds) -> np.ndarray:
    """Decide all uncertain parts of ``s`` in place by integer distances;
    returns how many close entries each part needed (b + 1: all entries)."""
    b = s.near.shape[1]
    need = np.zeros(len(x), np.int64)
    first = s.lower[:, 0] if b else s.outer
    doubt = np.flatnonzero(s.upper >= first)
    diff = x[doubt] - entries[s.code[doubt]]
    own = (diff * diff).sum(1)
    s.upper[doubt] = _up(np.sqrt(own.astype(np.float64)))
    still = s.upper[doubt] >= first[doubt]
    doubt, own = doubt[still], own[still]
    reach = (s.lower[doubt] <= s.upper[doubt, None]).sum(1)
    every = s.outer[doubt] <= s.upper[doubt]
    need[doubt] = np.where(every, b + 1, reach)
    rows = doubt[every]
    if len(rows):
        s.put(rows, scan(x[rows], entries, b))
    rows, own, reach = doubt[~every], own[~every], reach[~every]
    if len(rows):
        near = s.near[rows]
        diff = x[rows][:, None, :] - entries[near]
        d = np.concatenate([own[:, None], (diff * diff).sum(2)], 1)
        names = np.concatenate([s.code[rows][:, None], near], 1)
        seen = np.arange(b + 1) <= reach[:, None]
        least = np.where(seen, d, np.iinfo(np.int64).max).min(1)
        best = np.where(seen & (d == least[:, None]), names, 255).min(1)
        exact = np.sqrt(d.astype(np.float64))
        bound = np.concatenate([np.zeros((len(rows), 1)), s.lower[rows].astype(np.float64)], 1)
        value = np.where(seen, exact, bound)
        value[names == best[:, None]] = -1                       # the new entry leaves the list
        order = np.argsort(value, axis=1, kind="stable")[:, 1:]
        s.code[rows] = best
        s.upper[rows] = _up(np.sqrt(least.astype(np.float64)))
        s.near[rows] = np.take_along_axis(names, order, 1)
        s.lower[rows] = _down(np.take_along_axis(value, order, 1))
    return need


# -- rows of the table ------------------------------------------------------------

def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    n = len(rows)
    width = rows[0].nbytes if n else 0
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * width),
                                                  pa.py_buffer(rows.tobytes())])


def _array(column: pa.Array, dtype, width: int) -> np.ndarray:
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    count = len(column) * width
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype, count, int(at)) if count else np.zeros(0, dtype)
    return flat.reshape(len(column), width)


def _pack(ids, labels, ints: np.ndarray, states: list[Bounds]) -> pa.RecordBatch:
    n = len(ints)
    cols = [ids, labels, _binary(ints), _binary(np.stack([s.code for s in states], 1)),
            _binary(np.stack([s.upper for s in states], 1)), _binary(np.concatenate([s.near for s in states], 1)),
            _binary(np.concatenate([s.lower for s in states], 1)), _binary(np.stack([s.outer for s in states], 1)),
            pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(cols, names=NAMES)


NAMES = ["vec_id", "label", "ints", "code", "upper", "near", "lower", "outer", "slot", "total"]


def _unpack(batch: pa.RecordBatch, dim: int, widths: list[int]) -> tuple[np.ndarray, list[Bounds]]:
    get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    ints = _array(get["ints"], np.int32, dim)
    code, upper = _array(get["code"], np.uint8, PARTS), _array(get["upper"], np.float32, PARTS)
    near, lower = _array(get["near"], np.uint8, sum(widths)), _array(get["lower"], np.float32, sum(widths))
    outer = _array(get["outer"], np.float32, PARTS)
    out, at = [], 0
    for p, w in enumerate(widths):
        out.append(Bounds(code[:, p].copy(), upper[:, p], near[:, at:at + w].copy(), lower[:, at:at + w], outer[:, p]))
        at += w
    return ints, out


def _floors(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int32)


class Pass:
    """One assignment of all parts: ``books`` (PARTS, k, w) integers;
    ``drift``: how far each entry moved since the last pass (None: there was
    none); ``widths`` and ``keep``: close entries kept before and from now on."""

    def __init__(self, books: np.ndarray, drift: np.ndarray | None, widths: list[int], keep: list[int]):
        self.books, self.drift, self.widths, self.keep = books, drift, widths, keep
        self.dim = books.shape[0] * books.shape[2]

    def assign(self, batch: pa.RecordBatch):
        """(integers, part integers, states, entries needed)."""
        if self.drift is None:
            ints = _floors(batch.column(2), self.dim)
        else:
            ints, states = _unpack(batch, self.dim, self.widths)
        parts = ints.astype(np.int64).reshape(len(ints), PARTS, -1)
        new, need = [], []
        for p in range(PARTS):
            x = np.ascontiguousarray(parts[:, p])
            if self.drift is None:
                new.append(scan(x, self.books[p], self.keep[p]))
                need.append(np.full(len(x), self.keep[p]))
            else:
                new.append(moved(states[p], self.drift[p], self.keep[p]))
                need.append(settle(x, self.books[p], new[p]))
        return ints, parts, new, need

    def table(self, batches):
        """The next table: its rows, then the sums of this task."""
        k, w = self.books.shape[1:]
        sums = np.zeros((PARTS, k, w + 1), np.int64)
        needed = np.zeros((PARTS, ENTRIES + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ints, parts, states, need = self.assign(batch)
            for p, s in enumerate(states):
                needed[p] += np.bincount(need[p], minlength=ENTRIES + 1)
                order = np.argsort(s.code, kind="stable")
                found, at, n = np.unique(s.code[order], return_index=True, return_counts=True)
                sums[p, found, :w] += np.add.reduceat(parts[order, p], at, axis=0)
                sums[p, found, w] += n
            yield _pack(batch.column(0), batch.column(1), ints, states)
            label = batch.column(1).type
            release()
        if not needed.any():
            return
        rows = [*sums.reshape(PARTS * k, w + 1), *needed]
        n = len(rows)
        none = pa.nulls(n, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, label), none, none, none, none, none, none,
             pa.array(np.arange(n, dtype=np.int32)), pa.array(rows, pa.list_(pa.int64()))], names=NAMES)

    def codes(self, batches):
        """(vec_id, label, code text, error) after the last assignment."""
        for batch in batches:
            if not batch.num_rows:
                continue
            _, parts, states, _ = self.assign(batch)
            code = np.stack([s.code for s in states], 1)
            diff = parts - self.books[np.arange(PARTS), code]
            text = np.ascontiguousarray(code).tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([text[i:i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]),
                 pa.array((diff * diff).sum((1, 2)))], names=["vec_id", "label", "code", "error"])
            release()


def totals(table: DataFrame, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the parts of each entry, and how many parts needed
    how many close entries: a fixed number of integers."""
    out = np.zeros((PARTS * k + PARTS, max(w, ENTRIES) + 1), np.int64)
    rows = (table.where("slot IS NOT NULL").select("slot", F.posexplode("total").alias("i", "v"))
            .groupBy("slot", "i").agg(F.sum("v").alias("v")))
    for slot, i, v in rows.collect():
        out[slot, i] = v
    return out[:PARTS * k, :w + 1].reshape(PARTS, k, w + 1), out[PARTS * k:, :ENTRIES + 1]


def next_width(needed: np.ndarray, b: int, k: int) -> int:
    """The fewest close entries that were enough for all but one in ``SPARE``
    parts, not under an eighth of the entries and not above ``b``."""
    enough = np.cumsum(needed[:b + 1]) >= needed.sum() * (1 - 1 / SPARE)
    return min(b, max(int(np.argmax(enough)) if enough.any() else b, k // 8))


class Model:
    """Final codebooks (PARTS, k, w) and their digest."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.sha256 = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()

    def decode(self, code: str) -> np.ndarray:
        """The components that a code stands for."""
        at = np.frombuffer(bytes.fromhex(code), np.uint8)
        return self.books[np.arange(PARTS), at].reshape(-1) / SCALE


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/footlink-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def encode(vectors: DataFrame) -> tuple[DataFrame, Model | None]:
    """(vec_id, label, code, error) of every kept vector, and the codebooks."""
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
            .where((F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0) & finite))
    label = vectors.schema["label"].dataType.simpleString()
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    first = kept.orderBy(*order).limit(1).select(F.size("embedding")).first()
    if first is None:
        return spark.createDataFrame([], f"vec_id long, label {label}, code string, error long"), None
    dim = first[0]
    kept = kept.where(F.size("embedding") == dim)
    seeds = [r[0] for r in kept.orderBy(*order).limit(ENTRIES).select("embedding").collect()]
    start = _floors(pa.array(seeds, pa.list_(pa.float64())), dim).astype(np.int64)
    books = start.reshape(len(seeds), PARTS, dim // PARTS).transpose(1, 0, 2).copy()
    k, w = books.shape[1:]
    keep = [min(max(k // 4, 1), k - 1)] * PARTS
    source, path, drift, widths = kept.select("vec_id", "label", "embedding"), None, None, keep
    schema = STATE.format(label=label)
    for _ in range(ROUNDS):
        table, written = _write(source.mapInArrow(Pass(books, drift, widths, keep).table, schema))
        sums, needed = totals(table, k, w)
        if path:
            _delete(spark, path)
        new = books.copy()
        used = sums[:, :, w] > 0
        new[used] = sums[used][:, :w] // sums[used][:, w:]
        step = (new - books).astype(np.float64)
        drift = np.sqrt((step * step).sum(2)) * (1 + 1e-12)
        books, path, widths = new, written, keep
        keep = [next_width(needed[p], b, k) for p, b in enumerate(widths)]
        source = table.where("slot IS NULL").drop("slot", "total")
    out, _ = _write(source.mapInArrow(Pass(books, drift, widths, keep).codes,
                                      f"vec_id long, label {label}, code string, error long"))
    _delete(spark, path)
    return out, Model(books)


def with_label_error(codes: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels, nulls together."""
    sums = cut_lineage(codes.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    return lookup(codes, sums, "label", "n", sums.agg(F.sum("n")).first()[0] or 0)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from footlink.llm.frames import table
    codes, model = encode(table(spark, sf_dir, "embeddings"))
    return with_label_error(codes).select("vec_id", "code", "error", "label_error",
                                          F.lit(model.sha256 if model else None).cast("string").alias("codebooks_sha256"))
