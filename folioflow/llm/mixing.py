"""Mixing sources to target weights by capped water-filling.

Sources share the corpus's size by weight; no source may give more than
max_epochs times its own size; what a clamped source leaves over goes to the
others by weight until none is above its cap. A target of k + f epochs takes
every document k times, and once more those that fill f epochs along the
source's documents in a seeded order (the last of them in part, so that a
source's taken words are its rounded target).

The place where a source's last repetition stops is found through levels of 256
hash buckets, each level inside the bucket that the one before found; every row
is then compared with its source's stop. So one task orders at most 256 buckets
of a source, however many rows it has.

Bound: targets() ranks all sources in one task, one narrow row each.

Edge cases: a null text has size 0; null is a source of its own, last; empty
documents and sources take nothing; repeated rows count each time, and those
equal in key and size share a last part evenly, rounded; rows with a null key are
mixed as rows of one key; an empty table gives an empty mix; other columns
pass through repeated(), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, cut

MAX_EPOCHS = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
SEED = 20240607
#: Hexadecimal digits of a level of buckets, and levels.
DIGITS, LEVELS = 2, 4


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(source_sizes: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) with its target: min(cap, level * weight), where level spends the whole size.

    Sorted by cap over weight, clamped sources come first; level is the first
    quotient (size left) / (weight left) that the next source's cap can hold.
    One row a source, so one task holds them."""
    everything = W.partitionBy()
    order = W.orderBy(F.col("source").asc_nulls_last())
    filling = W.orderBy("ratio", "at")
    sources = (
        source_sizes.withColumn("at", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("at") % len(weights) + 1).cast("long"))
        .withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    )
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    levels = sources.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing)))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "at", "level"))).over(everything)["level"]
    return levels.withColumn("found", level).select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("found") * F.col("weight")).alias("target"))


def _sized(docs: DataFrame, source: str, key: str, text: str, seed: int) -> DataFrame:
    """docs with __source, __size and __turn, its place in the source's order."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))).cast("binary"))
    return docs.withColumns({"__source": F.col(source).cast("string"), "__size": size_of(F.col(text)), "__turn": digest})


def _stops(sized: DataFrame, max_epochs: int, weights: tuple[int, ...]) -> DataFrame:
    """One row a source: its target, whole repetitions, and where along its order the last repetition stops.

    Level by level: of the 256 parts of the bucket found so far, the one in which
    the target is reached. So no window orders more than 256 rows of a source,
    the last apart, which orders the rows that agree in LEVELS * DIGITS digits."""
    sized = sized.select("__source", "__size", "__turn")
    prefix = lambda level: F.substring("__turn", 1, DIGITS * level)
    carried = ["source_size", "target", "whole", "rest"]
    goals = targets(sized.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size")), max_epochs, weights).withColumn("goal", F.round("target").cast("long"))
    whole = F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0)).cast("long")
    found = goals.withColumn("whole", whole).select(F.col("source").alias("of"), "source_size", "target", "whole", (F.col("goal") - F.col("whole") * F.col("source_size")).alias("rest"), F.lit("").alias("stop"), F.lit(0).cast("long").alias("before"))
    for level in range(1, LEVELS + 2):
        last = level > LEVELS
        parts = ["turn", "size"] if last else ["part"]
        place = [F.col("__turn").alias("turn"), F.col("__size").alias("size")] if last else [prefix(level).alias("part")]
        inside = sized.join(found, F.col("__source").eqNullSafe(F.col("of")) & (prefix(level - 1) == F.col("stop")))
        sums = inside.groupBy("of", *carried, "before", *place).agg(F.sum("__size").alias("words"), F.count("*").alias("equal"))
        by = W.partitionBy("of").orderBy(*parts)
        reached = sums.withColumn("upto", F.col("before") + F.sum("words").over(by.rowsBetween(W.unboundedPreceding, W.currentRow))).where("upto >= rest")
        first = reached.withColumn("n", F.row_number().over(by)).where("n = 1").withColumn("before", F.col("upto") - F.col("words"))
        found = first.select("of", *carried, "before", *([F.col("turn").alias("stop_turn"), F.col("size").alias("stop_size"), "equal"] if last else [F.col("part").alias("stop")]))
    return found.withColumn("left", F.col("rest") - F.col("before"))


def _taken(sized: DataFrame, stops: DataFrame) -> DataFrame:
    """sized with its source's row of stops and __taken: each row against its source's stop, so without any order of rows."""
    joined = sized.join(stops, F.col("__source").eqNullSafe(F.col("of")))
    here = F.struct("__turn", "__size")
    stop = F.struct(F.col("stop_turn").alias("__turn"), F.col("stop_size").alias("__size"))
    share = F.least(F.col("__size"), F.round(F.col("left") / F.col("equal")).cast("long"))
    more = F.when(here < stop, F.col("__size")).when(here == stop, share).otherwise(F.lit(0))
    return joined.withColumn("__taken", F.col("whole") * F.col("__size") + more)


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", *, seed: int = SEED, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(key, size, source_size, target, taken) of every row of docs."""
    sized = cut(_sized(docs.select(source, key, text), source, key, text, seed).select(F.col(key).alias("__key"), "__source", "__size", "__turn"), "mix-sizes")
    return _taken(sized, _stops(sized, max_epochs, weights)).select(F.col("__key").alias(key), F.col("__size").alias("size"), "source_size", "target", F.col("__taken").alias("taken"))


def repeated(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", *, seed: int = SEED, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """docs with each row as often as the mix takes it; a part of at least half a document counts as one.

    Only sizes and turns are aggregated; texts are read where they lie and never shuffled."""
    stops = cut(_stops(cut(_sized(docs.select(source, key, text), source, key, text, seed).select("__source", "__size", "__turn"), "mix-sizes"), max_epochs, weights), "mix-stops")
    copies = F.expr("CASE WHEN __size = 0 THEN 0 ELSE (2 * __taken + __size) div (2 * __size) END").cast("int")
    own = [F.col(f"`{c}`") for c in docs.columns]
    every = docs.select(F.struct(*own).alias("__row"), F.col(f"`{source}`").alias("__of"), F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    taken = _taken(_sized(every, "__of", "__key", "__text", seed).drop("__text"), stops)
    return taken.select("__row", F.explode(F.array_repeat(F.lit(1), copies)).alias("__turn")).select("__row.*")


def sql(max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')) AS turn
  FROM documents),
sources AS (
  SELECT source, source_size, pos, weight, {max_epochs} * source_size AS cap, ({max_epochs} * source_size)::DOUBLE / weight AS ratio FROM (
    SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source))),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY ratio, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM sources),
goals AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT arg_min(level, (ratio, pos)) FROM levels WHERE level <= ratio)) AS target FROM levels),
parts AS (
  SELECT *, round(target)::BIGINT - CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END * source_size AS rest,
         CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS whole
  FROM goals)
SELECT s.doc_id, s.size, p.source_size, p.target,
       (p.whole * s.size + greatest(0, least(s.size, p.rest - (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size))))::BIGINT AS taken
FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source"""
