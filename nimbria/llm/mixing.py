"""Mixing sources to target weights, in DataFrame operations alone.

Sizes are aggregated per source (combined map-side, so a hot source is one row a task), targets are found in closed
form on the table of sources, and each document is then decided on its own: floor(rate) copies and one more if its
seeded hash falls below the fraction. Decisions depend on nothing but the seed and the id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbria.llm.common import cut, word_count

WEIGHTS, MOST, SEED = (5, 2, 1), 3, "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size) -> the same with ``target``.

    Sources in code point order, null last, take the weights in turn and share the total; a target stops at ``most``
    times its source's size and the excess is reshared by weight until none is above. The fixed point is
    min(most * size, level * weight): going through sources by most * size / weight, the first whose ratio reaches the
    level of those not yet capped ends the capped prefix. One row a source, so one window over them is small. A source
    without size has target 0; without any size all targets are 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    turn = F.array(*[F.lit(w) for w in weights])
    w = sizes.withColumn("weight", F.get(turn, (F.row_number().over(order) - 1) % len(weights)).cast("long"))
    w = w.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    w = w.withColumn("rest", rest).withColumn("left", weight)
    w = w.withColumn("open", F.col("ratio") * F.col("left") >= F.col("rest"))
    first = F.min(F.when(F.col("open"), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "rest", "left"))).over(every)
    w = w.withColumn("first", first)
    shared = F.col("weight") * F.col("first.rest") / F.col("first.left")
    return w.select("source", "source_size", F.coalesce(F.when(F.col("open"), shared), F.col("cap").cast("double")).alias("target"))


def chance(id_col: str, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a document's seeded MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies (int).

    Null texts have size 0; null sources are a source of their own; rows that repeat an id share its decision; null ids
    share one. Sources of size 0 have rate 0. No document gets more than ``most`` copies. Empty tables give no rows.
    """
    sized = cut(docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")))
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    renamed = sources.withColumnRenamed("source", "__source")
    rated = sized.join(renamed, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    copies = whole + F.when(chance("__id", seed) < F.col("rate") - whole, 1).otherwise(0)
    return rated.withColumn("rate", rate).withColumn("copies", F.least(copies, F.lit(most)).cast("int")).withColumnRenamed("__id", id_col)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``plan`` says, columns unchanged; texts are not shuffled.

    The table of sources is read back into the plan as one row a source: by a join that adaptive execution turns into a
    broadcast when its measured size allows.
    """
    sized = docs.select(F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    few = sources.limit(10_001).count() <= 10_000
    sources = sources.select(F.col("source").alias("__source"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("__rate"))
    rated = docs.join(F.broadcast(sources) if few else sources, F.col(source_col).eqNullSafe(F.col("__source")))
    whole = F.floor("__rate")
    copies = F.least(whole + F.when(chance(id_col, seed) < F.col("__rate") - whole, 1).otherwise(0), F.lit(most)).cast("int")
    return rated.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*[docs[c] for c in docs.columns])


PLAN_SQL = """
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size
  FROM {docs}),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sizes),
rested AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio,
    (SELECT sum(source_size) FROM weighed) - coalesce(sum(cap) OVER b, 0) AS rest,
    (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER b, 0) AS left_
  FROM weighed WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest, left_ FROM rested WHERE ratio * left_ >= rest ORDER BY ratio, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN ratio * left_ >= rest
    THEN CAST(weight * (SELECT rest FROM level) AS DOUBLE) / CAST((SELECT left_ FROM level) AS DOUBLE) ELSE CAST(cap AS DOUBLE) END AS target
  FROM rested),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS chance
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * least(3, floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
