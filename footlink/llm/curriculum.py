"""Mixing sources to target weights along a time-varying curriculum.

Source number i (names by code point, null last) has weight ``weights[i]``
and slope ``slopes[i]`` (both repeat): at training time t in [0, 1] its share
of the stream is in proportion to ``weight * (1 + slope * (2 t - 1))``. Its
integral over [0, 1] is the weight, so the shares of the whole run follow
the weights. A source's target is its share of all words; no target exceeds
``max_repeats`` times the source's size, and the excess goes to the others
by weight until none is above (water filling, solved in closed form over the
one-row-per-source table).

Within a source, documents follow a fixed hash order, repeated up to
``max_repeats`` times, until the words taken reach the target; the last
document is taken in part. A copy's training position solves
``target * G(t) = words before its middle``, with G the integrated schedule;
the mix is range-sorted by position.

Everything is DataFrame functions. Running sums are taken per (source, hash
prefix), so a source holding any share of the rows is spread over
``16 ** PREFIX`` groups.

Edge cases: null text has size 0; a null source is a source, sorted last;
documents of size 0 take 0 words; a corpus without words has all targets 0;
repeated rows are ordered next to each other and taken like any others;
extra columns are ignored by ``plan`` and carried by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footlink.llm.frames import cut_lineage, table

WEIGHTS = (1, 2, 3)
SLOPES = (-0.5, 0.0, 0.5)
MAX_REPEATS = 3
PREFIX = 3
WORD = r"[^\x20\x09-\x0D]+"


def order_key() -> Column:
    """Fixed pseudo-random order of documents, by id and text."""
    return F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text")))


def row_key() -> Column:
    """Names a row by its order key and source."""
    return F.md5(F.concat(F.col("key"), F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key), written once: the text is read here only."""
    return cut_lineage(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        order_key().alias("key")))


def _cycle(values: tuple, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def targets(per_source: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> plus weight, slope and target. One row per
    source, so the windows over the whole table are small."""
    every = Window.partitionBy(F.lit(0))
    named = per_source.withColumn("i", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
    named = (named.withColumn("weight", _cycle(weights, F.col("i")).cast("double"))
             .withColumn("slope", _cycle(slopes, F.col("i")).cast("double"))
             .withColumn("cap", max_repeats * F.col("source_size"))
             .withColumn("full_at", F.col("cap") / F.col("weight")))
    # Sources fill up in the order of cap / weight; the level is the first
    # one that does not exceed the next source's.
    up = every.orderBy("full_at", "i")
    spent = F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) - F.coalesce(spent, F.lit(0))) / left
    filled = named.withColumn("level", level)
    reached = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "i", "level"))).over(every)
    return (filled.withColumn("at", reached)
            .withColumn("target", F.when(F.col("full_at") < F.col("at.full_at"), F.col("cap").cast("double"))
                        .otherwise(F.least(F.col("weight") * F.col("at.level"), F.col("cap").cast("double"))))
            .select("source", "source_size", "weight", "slope", "target"))


def position(share: Column, slope: Column) -> Column:
    """t with t + slope * (t * t - t) = share, written so that slope 0 is t = share."""
    b = 1 - slope
    return 2 * share / (b + F.sqrt(b * b + 4 * slope * share))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
         max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: (doc_id, key, row, size, source_size, target,
    taken, copies); ``copies`` lists (words, position) of each copy taken."""
    rows = sizes(docs).withColumn("prefix", F.substring("key", 1, PREFIX))
    parts = rows.groupBy("source", "prefix").agg(F.sum("size").alias("part"))
    parts = cut_lineage(parts)
    goal = targets(parts.groupBy("source").agg(F.sum("part").alias("source_size")), weights, slopes, max_repeats)
    before = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (parts.withColumn("ahead", F.coalesce(F.sum("part").over(before), F.lit(0)))
             .join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "part"))
    ahead = ahead.select(F.col("source").alias("s"), F.col("prefix").alias("p"), "ahead", "source_size", "slope", "target")
    within = (Window.partitionBy("source", "prefix").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    run = rows.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
    run = run.join(ahead, F.col("source").eqNullSafe(F.col("s")) & (F.col("prefix") == F.col("p")))
    start = F.col("start") + F.col("ahead")
    goal_words = F.round("target").cast("long")
    epochs = F.array(*[F.lit(e) for e in range(max_repeats)])

    def copy(e: Column) -> Column:
        at = start + e * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), goal_words - at))
        share = F.least(F.lit(1.0), (at + words / 2) / F.greatest(F.col("target"), F.lit(1.0)))
        return F.struct(words.alias("words"), position(share, F.col("slope")).alias("position"))

    run = run.withColumn("copies", F.filter(F.transform(epochs, copy), lambda c: c["words"] > 0))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda acc, c: acc + c["words"])
    return (run.withColumn("taken", taken).withColumn("row", row_key())
            .select("doc_id", "key", "row", "size", "source_size", "target", "taken", "copies"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The training stream: ``docs`` rows, repeated as the mix takes them, in
    order of position. Documents stay whole: of a source's last copy, which the
    plan takes in part, the stream has all or nothing, whichever is nearer."""
    columns = docs.columns
    todo = cut_lineage(plan(docs, weights, slopes, max_repeats)
                       .withColumn("twin", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("taken"))))
                       .select("row", "twin", "size", "copies", "taken"))
    # Rows of one key are equal in id, text and source. Repeated ones carry
    # their own row of the plan, told apart by a number; only they need one.
    repeated = cut_lineage(todo.where("twin = 2").select("row", F.lit(True).alias("again")))
    # The document rides in one struct, so no column name of it can clash.
    keyed = (docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), order_key().alias("key"), "source")
             .select("doc", row_key().alias("row")).join(repeated, "row", "left"))
    twin = F.row_number().over(Window.partitionBy("row").orderBy(F.lit(0)))
    keyed = (keyed.where("again IS NULL").withColumn("twin", F.lit(1))
             .unionByName(keyed.where("again").withColumn("twin", twin)))
    whole = F.filter("copies", lambda c: 2 * c["words"] >= F.col("size"))
    todo = todo.where("taken > 0").drop("taken").withColumn("copies", whole)
    rows = keyed.join(todo, ["row", "twin"]).select("doc", F.explode("copies").alias("copy"))
    return rows.orderBy("copy.position", "doc.doc_id").select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.size("copies") > 0, F.col("copies")[0]["position"])
    return (plan(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", first.alias("position"))
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', doc_id::VARCHAR, text)) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1 AS i
  FROM d GROUP BY source
), w AS (
  SELECT *, (i % 3 + 1)::DOUBLE AS weight, 3 * source_size AS cap FROM s
), lv AS (
  SELECT a.i, a.cap / a.weight AS full_at,
         ((SELECT sum(source_size) FROM w)
          - coalesce((SELECT sum(b.cap) FROM w b WHERE (b.cap / b.weight, b.i) < (a.cap / a.weight, a.i)), 0))::DOUBLE
         / (SELECT sum(b.weight) FROM w b WHERE (b.cap / b.weight, b.i) >= (a.cap / a.weight, a.i)) AS level
  FROM w a
), lam AS (
  SELECT level FROM lv WHERE level <= full_at ORDER BY full_at, i LIMIT 1
), t AS (
  SELECT source, source_size, least(weight * (SELECT level FROM lam), cap::DOUBLE) AS target,
         [-0.5, 0.0, 0.5][i % 3 + 1]::DOUBLE AS slope FROM w
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.slope, round(t.target)::BIGINT AS goal,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS LAST, d.size
                           ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, greatest(0, least(size, goal - start)) AS w0,
         greatest(0, least(size, goal - start - source_size)) AS w1,
         greatest(0, least(size, goal - start - 2 * source_size)) AS w2,
         least(1.0, (start + greatest(0, least(size, goal - start)) / 2) / greatest(target, 1.0))::DOUBLE AS share
  FROM r
)
SELECT doc_id, size, source_size, target, (w0 + w1 + w2)::BIGINT AS taken,
       CASE WHEN w0 > 0 THEN 2 * share / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * share)) END AS position
FROM e
"""
