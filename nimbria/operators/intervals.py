"""Joins in time without theta joins: as-of, overlapping intervals, and windows gathered from steps of several parameters.

Time is cut into buckets of a given width, so both joins are equi-joins on the keys and a bucket: rows of a key that holds
much of a table are dealt over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbria.sources.shared import shared_dir

MOST_ROLES = 100_000


def asof(left: DataFrame, right: DataFrame, keys: list[str], time: str, columns: list[str], width: float, tolerance: float | None = None) -> DataFrame:
    """``left`` with ``columns`` and ``as_of`` of the latest row of ``right`` at or before its ``time`` (a number in both) with
    the same ``keys``; null where there is none, or none within ``tolerance``.

    Within a bucket both sides are ordered together; what a bucket begins with comes from a window over one row for each key
    and bucket, the bucket's last. Of right rows at one time the one with the greatest columns counts. Rows of ``left`` with
    a null key or time match nothing and stay. ``columns`` that ``left`` has are replaced.
    """
    bucket = F.floor(F.col(time) / width).cast("long")
    value = F.struct(F.col(time).alias("as_of"), *columns)
    plain = left.drop("as_of", *columns)
    fixed = [F.col(k).isNotNull() for k in [*keys, time]]
    known = fixed[0]
    for c in fixed[1:]:
        known = known & c
    ours = plain.where(known).withColumn("__b", bucket)
    theirs = right.where(known).select(*keys, F.col(time), bucket.alias("__b"), value.alias("__v"))
    ends = theirs.groupBy(*keys, "__b").agg(F.max("__v").alias("__v"))
    places = ours.select(*keys, "__b").distinct().withColumn("__v", F.lit(None).cast(theirs.schema["__v"].dataType)).unionByName(ends)
    places = places.groupBy(*keys, "__b").agg(F.max("__v").alias("__v"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.select(*keys, "__b", F.last("__v", ignorenulls=True).over(before).alias("__carried"))
    both = ours.withColumn("__v", F.lit(None).cast(theirs.schema["__v"].dataType)).withColumn("__left", F.lit(True)).unionByName(theirs.withColumn("__left", F.lit(False)), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "__b").orderBy(time, "__left", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("__in", F.last("__v", ignorenulls=True).over(inside)).where("__left").join(carried, [*keys, "__b"], "left")
    found = F.coalesce("__in", "__carried")
    if tolerance is not None:
        found = F.when(F.col(time) - found["as_of"] <= tolerance, found)
    made = met.withColumn("__f", found).select(*plain.columns, F.col("__f.as_of").alias("as_of"), *[F.col(f"__f.{c}").alias(c) for c in columns])
    rest = plain.where(~F.coalesce(known, F.lit(False)))
    return made.unionByName(rest, allowMissingColumns=True)


def _buckets(start: Column, end: Column, width: float) -> Column:
    first = F.floor(start / width).cast("long")
    return F.sequence(first, F.greatest(first, F.ceil(end / width).cast("long") - 1))


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], width: float, ours: tuple[str, str] = ("start", "end"), theirs: tuple[str, str] = ("begin", "finish")) -> DataFrame:
    """Pairs with the same ``keys`` whose half-open intervals [start, end) and [begin, finish) share time, with ``overlap``.

    An interval is in each bucket that it touches, so ``width`` should be near the usual length; a pair is kept in the bucket
    in which its common part begins, so it comes once. An instant (start = end) is in what holds it, with overlap 0; an
    interval that ends before it starts, or has a null end, meets nothing.
    """
    right = right.drop(*[c for c in left.columns if c in right.columns and c not in keys])
    sides = [df.where(F.col(a) <= F.col(b)).withColumn("__b", F.explode(_buckets(F.col(a), F.col(b), width))) for df, (a, b) in ((left, ours), (right, theirs))]
    first, last = F.greatest(ours[0], theirs[0]), F.least(ours[1], theirs[1])
    instant = (F.col(ours[0]) == F.col(ours[1])) & (F.col(theirs[1]) > first) | (F.col(theirs[0]) == F.col(theirs[1])) & (F.col(ours[1]) > first) | (F.col(ours[0]) == F.col(ours[1])) & (F.col(theirs[0]) == F.col(theirs[1]))
    meets = (first < last) | (first == last) & instant
    pairs = sides[0].join(sides[1], [*keys, "__b"]).where(meets & (F.floor(first / width).cast("long") == F.col("__b")))
    return pairs.withColumn("overlap", last - first).drop("__b")


def spans(steps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, step, begin, finish): each distinct step stands for the time since the step before it, the first for itself."""
    distinct = steps.select(*keys, "step").distinct()
    before = F.lag("step").over(Window.partitionBy(*keys).orderBy("step"))
    return distinct.select(*keys, "step", F.coalesce(before, F.col("step")).alias("begin"), F.col("step").alias("finish"))


def roles(steps: DataFrame, windows: DataFrame, changes: dict[str, tuple[str, str]], means: dict[str, str], latest: dict[str, str] | None = None, greatest: dict[str, str] | None = None) -> DataFrame:
    """(param, step, window_id, role, w): which step of which parameter a window needs and what for.

    ``steps`` has the (param, step) there are, ``windows`` (window_id, start, end) and maybe other columns of interval ends.
    ``changes``: role -> (param, prefix): the change of an accumulated parameter between the ends named ``<prefix>start`` and
    ``<prefix>end`` (weights -1 and 1; accumulations begin with 0 at step 0, so no field is needed there). ``means``: role ->
    param: its mean over the window, weighted by how much of the window each step stands for (``spans``). ``latest``: role ->
    param: its value at the window's end. ``greatest``: role -> param: its values of all steps that reach into the window, for
    a maximum. A window for which a step of any role is missing is left out.
    """
    shared_dir(steps.sparkSession)
    have = steps.select("param", "step").distinct().checkpoint()  # as many rows as there are steps of parameters
    asked = [(r, p, "change", prefix) for r, (p, prefix) in changes.items()] + [(r, p, kind, "") for kind, some in (("mean", means), ("latest", latest or {}), ("greatest", greatest or {})) for r, p in some.items()]
    ends = lambda kind, prefix: [(f"{prefix}start", -1.0), (f"{prefix}end", 1.0)] if kind == "change" else [("end", 1.0)] if kind == "latest" else [(None, 1.0)]
    wants = [F.struct(F.lit(r).alias("role"), F.lit(p).alias("param"), F.lit(kind).alias("kind"), (F.col(c) if c else F.lit(None)).cast("int").alias("step"), F.lit(w).alias("w")) for r, p, kind, prefix in asked for c, w in ends(kind, prefix)]
    required = windows.select("window_id", "start", "end", F.explode(F.array(*wants)).alias("x")).select("window_id", "start", "end", "x.*")
    table = required.where(F.col("kind").isin("change", "latest")).select("window_id", "role", "param", "step", "w", ((F.col("kind") == "latest") | (F.col("step") != 0)).alias("needed"))
    if means or greatest:
        reach = windows.agg(F.avg(F.col("end") - F.col("start"))).first()[0] or 1.0
        stand = spans(have.where(F.col("param").isin(sorted({*means.values(), *(greatest or {}).values()}))), ["param"])
        share = overlaps(windows.select("window_id", "start", "end"), stand, [], max(float(reach), 1.0)).where("overlap > 0")
        share = share.withColumn("all", F.sum("overlap").over(Window.partitionBy("window_id", "param"))).where(F.col("all") == F.col("end") - F.col("start"))
        over = required.where(F.col("kind").isin("mean", "greatest")).drop("step", "w").join(share.select("window_id", "param", "step", "overlap", "all"), ["window_id", "param"], "left")
        w = F.when(F.col("kind") == "mean", F.col("overlap") / F.col("all")).otherwise(1.0)
        table = table.unionByName(over.select("window_id", "role", "param", "step", w.alias("w"), F.lit(True).alias("needed")))  # a window that is not covered has no step
    marked = table.join(have.withColumn("there", F.lit(True)), ["param", "step"], "left").where("there or needed")
    lacks = F.max(F.col("there").isNull()).over(Window.partitionBy("window_id"))
    return marked.withColumn("lacks", lacks).where("not lacks").select("param", "step", "window_id", "role", "w").checkpoint()


def gather(fields: DataFrame, table: DataFrame, keys: list[str], sums: list[str], greatest: list[str] = ()) -> DataFrame:
    """(keys, window_id, a column for each role) from fields (keys, param, step, value): the roles in ``sums`` are weighted sums
    of their steps' values, those in ``greatest`` maxima.

    ``table`` comes from ``roles`` and is broadcast after a count of its rows. One grouped aggregate makes all columns; a group
    that lacks a field of any role is left out. NaN goes through sums and counts as the greatest.
    """
    few = table.limit(MOST_ROLES + 1).count() <= MOST_ROLES
    need = table.groupBy("window_id").agg(F.count("*").alias("__need"))
    table = table.join(need, "window_id").withColumnRenamed("step", "__step").withColumnRenamed("param", "__param")
    met = fields.join(F.broadcast(table) if few else table, (F.col("param") == F.col("__param")) & (F.col("step") == F.col("__step")))
    one = lambda role, fold, x: fold(F.when(F.col("role") == role, x)).alias(role)
    made = met.groupBy(*keys, "window_id").agg(F.count("value").alias("__n"), F.first("__need").alias("__need"), *[one(r, F.sum, F.col("w") * F.col("value")) for r in sums], *[one(r, F.max, F.col("value")) for r in greatest])
    return made.where("__n = __need").drop("__n", "__need")
