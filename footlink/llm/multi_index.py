"""Near-duplicate vectors by an inverted multi-index.

The two halves of a unit vector are quantised by codebooks of their own; the
pairs of entries form a product grid, and every vector lies in one cell of it.
A vector whose partner lies elsewhere visits other cells by multi-sequence
traversal: entries of each half are ordered by how far the half would have
to move to cross into them (its distance to the bisector with its own entry),
and cells are taken in order of the sum of both squares until the bound that
gives the target recall. The bound is measured on the fitted rows: each is
turned by the angle of the threshold in a random direction, and ``RECALL`` of
the turned vectors must lie in a visited cell. (Partners at the threshold are
the worst case, nearer ones are found more surely.) Of two vectors, the one in
the lower cell visits; what meets in a cell is verified by cosine in
double precision, so no link is wrong and a pair is verified once.

Codebooks are fitted on at most ``SAMPLE`` vectors (smallest hash); all
vectors are indexed and all query. The grid grows with the table, so a cell
keeps about ``PER_CELL`` vectors.

Cells are joined in blocks of about ``BLOCK`` members and ``BLOCK`` visitors: a
crowded cell becomes as many units as it has pairs of blocks, each a task's
small matrix product. A unit returns, for each vector, its number of links
and one vector of its local component: never pairs. Equal vectors of a
label are one class with a weight. In a dense group of different vectors the
work is quadratic (they all have to be counted), the rows that are moved
are so only by group size over ``BLOCK``.

Edge cases: rows whose label is null or whose vector is null, empty, zero or
holds null or non-finite components link with nothing; vectors of different
length do not link; a null vec_id comes after all ids, and a component with no
id has a null component_id (its rows are kept); rows that share a vec_id but
not a vector are judged by their vectors; repeated rows link with each
other and are all returned; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm.components import components
from footlink.llm.frames import NULL_ID, cut_lineage, lookup, release

COSINE = 0.98
RECALL = 0.999
SAMPLE = 16_384
PER_CELL = 256
MOST_ENTRIES = 512
BLOCK = 1024
ITERATIONS = 8


def units_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of a list column as one flat array, with offsets and
    lengths; each is scaled by its largest component first."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    if len(size):
        flat = flat / np.repeat(np.maximum.reduceat(np.abs(flat), at[:-1]), size)
        flat = flat / np.repeat(np.sqrt(np.add.reduceat(flat * flat, at[:-1])), size)
    return flat, at, size


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors cut or zero-padded to ``dim`` (which never lengthens the
    way between two of them)."""
    flat, at, size = units_of(column)
    out = np.zeros((len(size), dim))
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        m = min(n, dim)
        out[rows, :m] = flat[at[rows][:, None] + np.arange(m)]
    return out


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)


def fit_half(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means over a sample; entries without vectors stay where they were."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ITERATIONS):
        near = _squared(x, c).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


class Grid:
    """Two codebooks, the product grid of their entries, and the bound at
    which the traversal stops."""

    def __init__(self, sample: np.ndarray, k: int, cosine: float, recall: float):
        self.dim = sample.shape[1]
        self.cut = (self.dim + 1) // 2
        self.k = min(k, len(sample))
        self.books = [fit_half(h, self.k, s) for s, h in enumerate(self.halves(sample))]
        self.apart = [np.sqrt(np.maximum(_squared(b, b), 0)) for b in self.books]
        self.bound = self._bound(sample, cosine, recall)

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, :self.cut], x[:, self.cut:]]

    def margins(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: the own entry, and the squared distance to the bisector
        with each entry (0 for the own)."""
        out = []
        for h, book, apart in zip(self.halves(x), self.books, self.apart, strict=True):
            d = _squared(h, book)
            own = d.argmin(1)
            way = np.maximum(apart[own], 1e-300)
            move = np.maximum(d - d[np.arange(len(d)), own][:, None], 0) / (2 * way)
            move[apart[own] == 0] = 0
            out.append((own, move * move))
        return out

    def _bound(self, x: np.ndarray, cosine: float, recall: float) -> float:
        rng = np.random.default_rng(11)
        side = rng.standard_normal(x.shape)
        side -= (side * x).sum(1)[:, None] * x
        long = np.sqrt((side * side).sum(1))[:, None]
        turned = cosine * x + math.sqrt(1 - cosine * cosine) * side / np.maximum(long, 1e-300)
        rows = np.arange(len(x))
        cost = sum(m[rows, own] for (_, m), (own, _) in zip(self.margins(x), self.margins(turned), strict=True))
        return float(np.quantile(cost, recall)) if len(x) else 0.0

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home cell of each vector; vector, cell of each visit), visits going
        to cells above home only. Sequence one is walked entry by entry; sequence
        two as far as the bound leaves room, so cells beyond it are never seen."""
        (own1, m1), (own2, m2) = self.margins(x)
        home = own1.astype(np.int64) * self.k + own2
        o1, o2 = np.argsort(m1, axis=1), np.argsort(m2, axis=1)
        m1, m2 = np.take_along_axis(m1, o1, 1), np.take_along_axis(m2, o2, 1)
        rows, cells = [], []
        for i in range(self.k):
            live = np.flatnonzero(m1[:, i] <= self.bound)
            if not len(live):
                break
            for j in range(self.k):
                live = live[m1[live, i] + m2[live, j] <= self.bound]
                if not len(live):
                    break
                cell = o1[live, i].astype(np.int64) * self.k + o2[live, j]
                up = cell > home[live]
                rows.append(live[up])
                cells.append(cell[up])
        none = np.zeros(0, np.int64)
        return home, np.concatenate([none, *rows]), np.concatenate([none, *cells])


def fit(classes: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> Grid | None:
    """Grid over at most ``SAMPLE`` classes; its size follows their number."""
    n = classes.count()
    if not n:
        return None
    k = min(MOST_ENTRIES, 1 << max(1, math.ceil(math.log2(max(n / PER_CELL, 1)) / 2)))
    got = (classes.select("node", "embedding").orderBy(F.xxhash64("node", F.lit(17)), "node").limit(SAMPLE)
           .select("embedding").toArrow()["embedding"].combine_chunks())
    sizes = got.value_lengths().to_numpy(zero_copy_only=False)
    return Grid(matrix(got, int(np.bincount(sizes).argmax())), k, cosine, recall)


def crowded(classes: DataFrame, grid: Grid) -> DataFrame:
    """(label, dim, cell, blocks, guest_blocks) of the cells with more than one
    block of members or visitors. Tasks count before anything is shuffled."""
    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            home, row, cell = grid.visits(matrix(batch.column(2), grid.dim))
            at = np.concatenate([np.arange(len(home)), row])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                 pa.array(np.concatenate([home, cell])), pa.array(np.arange(len(at)) < len(home))],
                names=["label", "dim", "cell", "member"])
            release()

    source = classes.select("label", "dim", "embedding")
    label = source.schema["label"].dataType.simpleString()
    n = source.mapInArrow(count, f"label {label}, dim int, cell long, member boolean")
    blocks = lambda cond: F.ceil(F.count_if(cond) / BLOCK).cast("int")
    return (n.groupBy("label", "dim", "cell")
            .agg(blocks(F.col("member")).alias("blocks"), blocks(~F.col("member")).alias("guest_blocks"))
            .where("blocks > 1 OR guest_blocks > 1"))


def placed(classes: DataFrame, grid: Grid) -> DataFrame:
    """Every vector in its home cell (member) and in the cells it visits."""
    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            home, row, cell = grid.visits(matrix(batch.column(2), grid.dim))
            at = pa.array(np.concatenate([np.arange(len(home)), row]))
            yield pa.RecordBatch.from_arrays(
                [c.take(at) for c in batch.columns]
                + [pa.array(np.concatenate([home, cell])), pa.array(np.arange(len(at)) < len(home))],
                names=[*batch.schema.names, "cell", "member"])
            release()

    source = classes.select("label", "dim", "embedding", "node", "weight")
    types = {f.name: f.dataType.simpleString() for f in source.schema}
    return source.mapInArrow(place, ", ".join(f"{c} {t}" for c, t in types.items()) + ", cell long, member boolean")


def in_units(rows: DataFrame, big: DataFrame) -> DataFrame:
    """A row for each unit that a placed vector takes part in. Unit (p, q):
    member block p as the first side, with member block q (p < q), or itself
    and guest block 0 (p = q), or guest block -q (q < 0) as the other."""
    rows = rows.join(big, ["label", "dim", "cell"], "left").na.fill(1, ["blocks", "guest_blocks"])
    block = F.pmod(F.xxhash64("node", F.lit(3)), F.greatest(F.when(F.col("member"), F.col("blocks"))
                                                             .otherwise(F.col("guest_blocks")), F.lit(1))).cast("int")
    unit = lambda p, q, first: F.struct(p.cast("int").alias("p"), q.cast("int").alias("q"), first.alias("first"))
    b = F.col("b")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    guests = F.filter(F.sequence(F.lit(0), F.greatest(F.col("guest_blocks") - 1, F.lit(0))), lambda g: g > 0)
    member = F.concat(F.transform(others, lambda o: F.when(o >= b, unit(b, o, F.lit(True))).otherwise(
        unit(o, b, F.lit(False)))), F.transform(guests, lambda g: unit(b, -g, F.lit(True))))
    guest = F.transform(others, lambda o: F.when(b == 0, unit(o, o, F.lit(False))).otherwise(
        unit(o, -b, F.lit(False))))
    return (rows.where("blocks > 0").withColumn("b", block)
            .withColumn("u", F.explode(F.when(F.col("member"), member).otherwise(guest)))
            .select("label", "dim", "cell", "u.p", "u.q", "u.first", "node", "weight", "embedding"))


def stars(linked: np.ndarray) -> np.ndarray:
    """A vertex of each vertex's component, the same for all of it."""
    root = np.arange(len(linked))
    left = linked.any(1)
    while left.any():
        i = int(left.argmax())
        seen = np.zeros(len(linked), bool)
        seen[i] = True
        front = linked[i]
        while (new := front & ~seen).any():
            seen |= new
            front = linked[new].any(0)
        root[seen] = i
        left &= ~seen
    return root


def verify(rows: DataFrame, cosine: float) -> DataFrame:
    """(node, links, other): the links that each vector has in a unit, and a
    vector of its component there."""
    def unit(table: pa.Table):
        first = table["first"].combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(~first, kind="stable")
        n = int(first.sum())
        own = table["p"][0].as_py() == table["q"][0].as_py()
        if n == 0 or len(first) == (1 if own else n):
            return None
        x = matrix(table["embedding"].combine_chunks(), table["dim"][0].as_py())[order]
        hit = x[:n] @ x.T >= cosine
        np.fill_diagonal(hit, False)
        if not own:
            hit[:, :n] = False
        if not hit.any():
            return None
        linked = np.zeros((len(x), len(x)), bool)
        linked[:n] = hit
        linked[n:, :n] = hit[:, n:].T
        node = table["node"].combine_chunks().to_numpy()[order]
        weight = table["weight"].combine_chunks().to_numpy()[order]
        some = np.flatnonzero(linked.any(1))
        return pa.RecordBatch.from_arrays(
            [pa.array(node[some]), pa.array(linked[some] @ weight), pa.array(node[stars(linked)[some]])],
            names=["node", "links", "other"])

    def borders(table: pa.Table) -> np.ndarray:
        change = np.zeros(len(table) - 1, bool)
        for c in ("label", "dim", "cell", "p", "q"):
            v = table[c].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        return np.flatnonzero(change) + 1

    def run(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            ends = borders(table).tolist()
            for a, b in zip([0, *ends[:-1]], ends, strict=False):
                if (out := unit(table.slice(a, b - a))) is not None:
                    yield out
            rest = table.slice(ends[-1]) if ends else table
            release()
        if rest is not None and (out := unit(rest)) is not None:
            yield out

    key = ["label", "dim", "cell", "p", "q"]
    return (rows.repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(run, "node long, links long, other long"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("label").isNotNull() & (F.size("embedding") > 0) & finite
              & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("vec_id"), "label", "embedding",
                          F.when(usable, F.xxhash64("label", F.size("embedding"), "embedding")).alias("node"))
    classes = cut_lineage(rows.where("node IS NOT NULL").groupBy("node")
                          .agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"),
                               F.count("*").alias("weight"), F.min("vec_id").alias("least"))
                          .withColumn("dim", F.size("embedding")))
    rows = rows.select("vec_id", "node")
    grid = fit(classes, cosine, recall)
    if grid is None:
        named = None
    else:
        big = cut_lineage(crowded(classes, grid))
        found = cut_lineage(verify(in_units(placed(classes, grid), big), cosine))
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        comps = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
        linked = cut_lineage(classes.select("node", "weight", "least").join(links, "node")
                             .join(comps.withColumnRenamed("id", "node"), "node"))
        heads = linked.groupBy("component").agg(F.min("least").alias("head"))
        linked = linked.join(heads, "component").select("node", "links", "head")
        named = cut_lineage(classes.select("node", "weight", "least").join(linked, "node", "left").select(
            "node", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("head", "least").alias("component_id")))
    alone = rows.where("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                              F.col("vec_id").alias("component_id"))
    out = alone
    if named is not None:
        total = named.agg(F.sum("weight")).first()[0] or 0
        out = alone.unionByName(lookup(rows.where("node IS NOT NULL"), named, "node", "weight", total).drop("node"))
    shown = lambda c: F.when(F.col(c) < NULL_ID, F.col(c)).alias(c)
    return out.select(shown("vec_id"), "n_links", shown("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from footlink.llm.frames import table
    return near_duplicates(table(spark, sf_dir, "embeddings"))
