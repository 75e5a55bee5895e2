"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every source gets a share of all words in proportion to its weight, at most
``max_epochs`` times its own size. What the cap cuts off goes to the sources
below theirs, again by weight, until none is above. With the sources ordered by
cap / weight this fixed point has a closed form: the clamped sources are a
prefix of that order, and the rest share what is left at one level a unit of
weight.

A source whose target is ``e`` times its size takes every document floor(e)
times and, for the remaining fraction, documents in the order of a seeded hash
until their words make up that fraction. The order is cut into ``BUCKETS`` hash
ranges, whose sums give every range its start, so that the running sum of a hot
source is taken in thousands of groups, not in one.

Defined results: a null or empty text has size 0 and takes 0; null sources form
one source, ordered last; rows that repeat a doc_id count as documents of their
own; a null doc_id is hashed as the empty text; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
BUCKETS = 4096  # three hexadecimal digits


def with_sizes(docs: DataFrame, others: list[str] | None = None) -> DataFrame:
    """doc_id, source and size: the number of words of the whole text."""
    return docs.select("doc_id", "source", *(others or []), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target: one row per source (this table has as many rows as there are sources)."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = by_source.select("source", "source_size",
                                F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).alias("weight"),
                                (F.col("source_size") * max_epochs).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    levels = weighted.withColumn("level", level)
    # The first source whose cap is above its level ends the clamped prefix; from there on one level holds.
    open_level = F.min(F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return levels.select("source", "source_size",
                         F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * open_level["level"], F.col("cap").cast("double"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, repetitions, taken: one row per document."""
    return _mix(docs, weights, max_epochs, seed, [])


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Documents without words have no weight; they stay once."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("__row"))
    times = F.when(F.col("size") == 0, F.lit(1).cast("long")).otherwise(F.col("repetitions"))
    taken = _mix(rows, weights, max_epochs, seed, ["__row"])
    return taken.select("__row", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("__row.*")


def _mix(docs: DataFrame, weights: tuple[float, ...], max_epochs: int, seed: str, others: list[str]) -> DataFrame:
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = written(with_sizes(docs, others).withColumn("key", key).withColumn("bucket", F.substring("key", 1, 3)), "mix-sizes")
    goal = targets(sizes, weights, max_epochs).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
              .withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words"))
    starts = starts.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = sizes.withColumn("upto", F.sum("size").over(within))
    joined = ordered.alias("d").join(starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.bucket") == F.col("s.bucket")))
    # A document is in the fraction if more than half of its words lie within it.
    extra = F.when(F.col("start") + F.col("upto") - F.col("size") / 2 <= F.col("part"), 1).otherwise(0)
    repetitions = (F.col("whole") + extra).cast("long")
    return joined.select("doc_id", F.col("d.source").alias("source"), "size", "source_size", "target", *others,
                         repetitions.alias("repetitions"), (repetitions * F.col("size")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, CAST([{', '.join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS DOUBLE) AS weight,
         {MAX_EPOCHS} * source_size AS cap
  FROM by_source),
levels AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), coalesce(weight * (SELECT arg_min(level, ratio) FROM levels WHERE ratio > level), CAST(cap AS DOUBLE))) AS target
  FROM levels),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goal),
ordered AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM sizes)
SELECT o.doc_id, o.size, p.source_size, p.target,
       CAST(o.size * (p.whole + CASE WHEN o.upto - o.size / 2 <= p.target - p.whole * p.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered o JOIN parts p ON o.source IS NOT DISTINCT FROM p.source
"""
