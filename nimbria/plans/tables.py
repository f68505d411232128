"""Request algebra, windows and product rules over tables: a request is a row, a hypercube of requests a row whose keys are
arrays. Nothing is collected; rules, windows and calendars are configuration and become Column expressions or small tables.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbria.plans.requests import deep_update
from nimbria.plans.schema import MARK

BISECTIONS = 60


def expand(cubes: DataFrame, dims: list[str]) -> DataFrame:
    """One row per combination of the values of the array columns ``dims``; an empty or null array gives no row."""
    for d in dims:
        cubes = cubes.withColumn(d, F.explode(d))
    return cubes


def squeeze(requests: DataFrame, dims: list[str]) -> DataFrame:
    """Requests that differ only in ``dims`` as one hypercube: each dim becomes the sorted array of its distinct values, nulls
    left out. A cube stands for the cross product of its arrays, as in the request that is sent."""
    rest = [c for c in requests.columns if c not in dims]
    return requests.groupBy(*rest).agg(*[F.sort_array(F.collect_set(d)).alias(d) for d in dims])


def cube_of(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One hypercube of the distinct values of a column each: key -> (table, column). The columns are codes of few values."""
    rows = [df.agg(F.sort_array(F.collect_set(column)).alias(key)).withColumn("__one", F.lit(1)) for key, (df, column) in tables.items()]
    return reduce(lambda a, b: a.join(b, "__one"), rows).select(*tables)


def volume(cubes: DataFrame, dims: list[str]) -> Column:
    """The number of requests that a cube stands for: the product of its arrays' sizes (a null array counts as one value)."""
    return reduce(lambda a, b: a * b, [F.coalesce(F.nullif(F.size(d), F.lit(-1)), F.lit(1)) for d in dims], F.lit(1).cast("long"))


def contained(cubes: DataFrame, held: DataFrame, dims: list[str], others: list[str]) -> DataFrame:
    """The cubes all of whose requests are in one of the cubes ``held``: equal ``others``, every array within the held one's."""
    theirs = held.select(*others, *[F.col(d).alias(f"__{d}") for d in dims])
    inside = reduce(lambda a, b: a & b, [F.size(F.array_except(d, f"__{d}")) == 0 for d in dims])
    met = cubes.withColumn("__id", F.monotonically_increasing_id()).join(theirs, others).where(inside)
    return met.drop(*[f"__{d}" for d in dims]).dropDuplicates(["__id"]).drop("__id")


def missing(required: DataFrame, available: DataFrame, dims: list[str]) -> DataFrame:
    """The difference of two tables of hypercubes as a small cover: the requests of ``required`` that are in none of
    ``available``, squeezed again along one dim after the other, so that equal neighbours become one cube."""
    left = expand(required, dims).distinct().join(expand(available, dims).distinct(), required.columns, "left_anti")
    return cover(left, dims)


def cover(requests: DataFrame, dims: list[str]) -> DataFrame:
    """Disjoint hypercubes that hold exactly the given requests: along each dim in turn, cubes that are equal in all others
    are merged. Unlike ``squeeze`` no request is added that was not there."""
    cubes = requests.select(*[F.array(c).alias(c) if c in dims else F.col(c) for c in requests.columns])
    for d in dims:
        rest = [c for c in cubes.columns if c != d]
        cubes = cubes.groupBy(*rest).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list(d)))).alias(d)).where(F.size(d) > 0)
    return cubes.select(*requests.columns)


# ---- text


def text_of(value: Column, kind: str) -> Column:
    """A value in request text: arrays as a/b/c, dates as YYYYMMDD; ``kind`` is the column's type."""
    if kind.startswith("array"):
        return F.array_join(F.transform(value, lambda x: text_of(x, kind[6:-1])), "/")
    return F.date_format(value, "yyyyMMdd") if kind in ("date", "timestamp", "timestamp_ntz") else value.cast("string")


def range_text(first: Column, last: Column, by: Column) -> Column:
    """``a/to/b/by/c``, without the step if that is 1."""
    plain = F.concat(first.cast("string"), F.lit("/to/"), last.cast("string"))
    return F.when(by == 1, plain).otherwise(F.concat(plain, F.lit("/by/"), by.cast("string")))


def request_text(requests: DataFrame, verb: str, keys: list[str]) -> Column:
    """``verb, key=value, ...`` of each row; a key that is null is left out."""
    lines = [F.concat(F.lit(f"  {k}="), text_of(F.col(k), dict(requests.dtypes)[k])) for k in keys]
    return F.array_join(F.array(F.lit(verb), *lines), ",\n")


def numbers_of(text: Column) -> Column:
    """The integers of ``a/b``, ``a/to/b/by/c``, ``a-b`` and ``a,b``, as an array."""
    parts = F.transform(F.split(F.regexp_replace(text, ",", "/"), "/"), lambda x: F.trim(x))
    at = F.array_position(parts, F.lit("to")).cast("int")
    number = lambda i: F.get(parts, i).cast("int")
    by = F.when(F.array_contains(parts, "by"), number(F.array_position(parts, F.lit("by")).cast("int"))).otherwise(F.lit(1))
    span = F.when(at > 1, F.concat(F.transform(F.slice(parts, F.lit(1), F.greatest(at - 2, F.lit(0))), lambda x: x.cast("int")), F.sequence(number(at - 2), number(at), by)))
    one = lambda x: F.when(x.rlike(r"^\d+-\d+$"), F.sequence(F.split(x, "-")[0].cast("int"), F.split(x, "-")[1].cast("int"))).otherwise(F.array(x.cast("int")))
    plain = F.flatten(F.transform(F.filter(parts, lambda x: ~x.isin("to", "by")), lambda x: F.when(at > 0, F.array().cast("array<int>")).otherwise(one(x))))
    return F.coalesce(span, plain)


# ---- windows and steps


def month_ranges(origins: DataFrame, date: str, start: int, end: int) -> DataFrame:
    """``origins`` with (first, last int, month int): the full calendar months between two steps in hours after the ``date``, and
    the number (from 1) of each as a forecast month."""
    zero = F.col(date).cast("date")
    hours = lambda day: F.date_diff(day, zero) * 24
    begin = F.trunc(F.date_add(zero, start // 24), "month")
    months = F.explode(F.sequence(begin, F.date_add(zero, math.ceil(end / 24)), F.expr("interval 1 month")))
    rows = origins.withColumn("__m", months)
    rows = rows.withColumn("first", hours(F.col("__m"))).withColumn("last", hours(F.add_months("__m", 1))).where((F.col("first") >= start) & (F.col("last") <= end))
    number = F.months_between(F.col("__m"), F.trunc(zero, "month")).cast("int") + F.when(F.dayofmonth(zero) == 1, 1).otherwise(0)
    return rows.withColumn("month", number).drop("__m")


def output_ranges(steps: DataFrame, width: int, interval: int) -> DataFrame:
    """(first, last, inputs, base): the ranges of ``width`` at an ``interval`` whose ends are both in ``steps`` (step), how many
    steps each holds after its first, and its first step as the base."""
    have = steps.select("step").distinct()
    least = have.agg(F.min("step").alias("__least")).withColumn("__one", F.lit(1))
    starts = have.withColumn("__one", F.lit(1)).join(least, "__one").where((F.col("step") - F.col("__least")) % interval == 0)
    ends = have.select((F.col("step") - width).alias("step"))
    ranges = starts.join(ends, "step").select(F.col("step").alias("first"), (F.col("step") + width).alias("last"))
    inside = ranges.withColumn("step", F.explode(F.sequence(F.col("first") + 1, F.col("last")))).join(have, "step")
    return inside.groupBy("first", "last").agg(F.count("*").cast("int").alias("inputs")).withColumn("base", F.col("first"))


def nearest_window(hour: Column, starts: list[int], base_time: int = 0) -> Column:
    """The start of the climatology window nearest by time of day to an hour; ties go to the earlier."""
    at = (hour + base_time) % 24
    away = [F.struct(F.least(F.pmod(F.lit(s) - at, F.lit(24)), F.pmod(at - F.lit(s), F.lit(24))).alias("away"), F.lit(s).alias("start")) for s in starts]
    return F.array_min(F.array(*away))["start"]


def cluster_steps(jobs: DataFrame, first: str = "first", last: str = "last", every: str = "every") -> DataFrame:
    """``jobs`` with ``monthly`` and a row for each ``step`` from ``first`` to ``last``: every ``every`` hours, or seven times that for
    monthly jobs, which are those of one step and those longer than 120 hours."""
    monthly = (F.col(last) - F.col(first) > 120) | (F.col(last) == F.col(first))
    rows = jobs.withColumn("monthly", monthly).where((F.col(first) <= F.col(last)) & (F.col(every) > 0))
    return rows.withColumn("step", F.explode(F.sequence(F.col(first).cast("int"), F.col(last).cast("int"), (F.col(every) * F.when(F.col("monthly"), 7).otherwise(1)).cast("int"))))


def as_of_calendar(dates: DataFrame, calendar: DataFrame, date: str, day: str) -> DataFrame:
    """``dates`` with ``calendar_day``: the last day of a calendar not after each date; an error is left to the caller (null)."""
    from nimbria.operators.intervals import asof

    number = lambda c: F.date_diff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date"))
    days = calendar.select(number(day).alias("__t"), F.col(day).cast("date").alias("calendar_day")).withColumn("__k", F.lit(0))
    return asof(dates.withColumn("__t", number(date)).withColumn("__k", F.lit(0)), days, ["__k"], "__t", ["calendar_day"], 64.0).drop("__t", "__k", "as_of")


def radiation_window(end: Column) -> tuple[Column, Column]:
    """First and last step of the 24 hours that go with a window: the first day if it ends before it."""
    last = F.greatest(end, F.lit(24))
    return F.greatest(last - 24, F.lit(0)), last


# ---- numbers


def truncation_to_gaussian(truncation: Column, order: Column) -> Column:
    return F.floor((truncation + 1) * (order + 1) / 4)


def gaussian_to_truncation(n: Column, order: Column) -> Column:
    return F.ceil(4.0 * n / (order + 1)) - 1


def overlap_of(spacing: Column, radius: float) -> Column:
    """The share of a circle that another of the same radius covers, its centre ``spacing`` away."""
    half = spacing / (2 * radius)
    return (2 * F.acos(half) - 2 * half * F.sqrt(F.greatest(1 - half * half, F.lit(0.0)))) / math.pi


def overlap_spacing(share: Column, radius: float) -> Column:
    """The spacing at which two equal circles overlap by ``share``, by bisection within the expression."""

    def halve(ends: Column, _: Column) -> Column:
        middle = (ends["low"] + ends["high"]) / 2
        more = overlap_of(middle, radius) > share
        return F.struct(F.when(more, middle).otherwise(ends["low"]).alias("low"), F.when(more, ends["high"]).otherwise(middle).alias("high"))

    start = F.struct(F.lit(0.0).alias("low"), F.lit(2.0 * radius).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(BISECTIONS)), start, halve, lambda ends: (ends["low"] + ends["high"]) / 2)


def level_of(label: Column) -> Column:
    """The level of a quantile label such as ``3:100``."""
    return F.split(label, ":")[0].cast("double") / F.split(label, ":")[1].cast("double")


# ---- rules


def settings(tree: dict, keys: dict[str, str], name: str, kind: str) -> Column:
    """The setting ``name`` (of SQL type ``kind``) that a tree of rules gives each row; ``keys`` maps its filters to columns.

    Branches are followed in order and deeper settings win, as in ``schema.traverse``. Null where no rule sets it.
    """
    own = F.lit(tree[name]).cast(kind) if name in tree else F.lit(None).cast(kind)
    for key, branches in tree.items():
        if not key.startswith(MARK):
            continue
        column, found, rest = F.col(keys[key[len(MARK) :]]).cast("string"), None, None
        for branch, child in branches.items():
            inner = settings(child, keys, name, kind)
            if branch == "*":
                rest = inner
            else:
                found = F.when(column.isin(*branch.split("/")), inner) if found is None else found.when(column.isin(*branch.split("/")), inner)
        if found is not None and rest is not None:
            found = found.otherwise(rest)
        below = rest if found is None else found
        own = F.coalesce(below, own) if below is not None else own
    return own


def rule_leaves(spark, tree: dict, keys: list[str], names: dict[str, str]) -> DataFrame:
    """The leaves of a tree of rules as a table: a column for each key (null: any value) and each setting (name -> SQL type).
    As long as the configuration, it can be joined with settings to find the requests that lead to them."""
    rows: list[tuple] = []

    def walk(node: dict, at: dict, held: dict) -> None:
        held = deep_update(held, {k: v for k, v in node.items() if not k.startswith(MARK)})
        filters = [(k[len(MARK) :], b) for k, b in node.items() if k.startswith(MARK)]
        if not filters:
            rows.append((*(at.get(k) for k in keys), *(held.get(n) for n in names)))
            return
        (name, branches), others = filters[0], {f"{MARK}{k}": b for k, b in filters[1:]}
        for branch, child in branches.items():
            for value in [None] if branch == "*" else branch.split("/"):
                if name not in at or value is None or at[name] == value:
                    walk({**child, **others}, at if value is None else {**at, name: value}, held)

    walk(tree, {}, {})
    return spark.createDataFrame(rows, ", ".join([*(f"{k} string" for k in keys), *(f"{n} {t}" for n, t in names.items())]))
