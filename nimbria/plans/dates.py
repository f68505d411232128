"""Windows over calendars: the days around a date and the days of a span, as rows.

A calendar is a table of days, at most ``MOST_DAYS`` (checked: some 350 years of days), made by a rule or given. Dates find
their place in it by an as-of join; what lies before, after or between follows from the days' numbers, by an equi-join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbria.operators.intervals import asof

MOST_DAYS, BUCKET_DAYS = 1 << 17, 64.0


def calendar(spark: SparkSession, first: dt.date, last: dt.date, rule: str = "daily", days: list | None = None, without: list[tuple[int, int]] = ()) -> DataFrame:
    """(day): the days from ``first`` to ``last`` of a rule: ``daily``; ``weekly`` on ``days`` (0 is Monday); ``monthly`` on
    days of the month; ``yearly`` on (month, day) pairs. Those of (month, day) pairs ``without`` are left out."""
    day, of_year = F.col("day"), F.month("day") * 100 + F.dayofmonth("day")
    rules = {"daily": lambda: F.lit(True), "weekly": lambda: F.weekday(day).isin(days), "monthly": lambda: F.dayofmonth(day).isin(days), "yearly": lambda: of_year.isin([m * 100 + d for m, d in days])}
    if rule not in rules:
        raise ValueError(f"{rule!r} is no rule of calendars: {', '.join(rules)}")
    if last < first:
        return spark.createDataFrame([], "day date")
    every = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")).where(rules[rule]())
    return every.where(~of_year.isin([m * 100 + d for m, d in without])) if without else every


def numbered(days: DataFrame) -> DataFrame:
    """(day, at): the distinct days of a calendar, numbered from 1."""
    days = days.select(F.col("day").cast("date").alias("day")).where("day is not null").distinct()
    if days.limit(MOST_DAYS + 1).count() > MOST_DAYS:
        raise ValueError(f"a calendar has at most {MOST_DAYS} days")
    return days.withColumn("at", F.row_number().over(Window.orderBy("day")))


def _place(rows: DataFrame, days: DataFrame, date: Column, name: str) -> DataFrame:
    """``rows`` with the number of the last of the numbered ``days`` not after ``date``; 0 before the first."""
    since = lambda c: F.date_diff(c, F.lit(dt.date(1970, 1, 1)))
    known = days.select(F.lit(0).alias("__k"), since(F.col("day")).alias("__t"), F.col("at").alias("__at"))
    found = asof(rows.withColumn("__k", F.lit(0)).withColumn("__t", since(date)), known, ["__k"], "__t", ["__at"], BUCKET_DAYS)
    return found.withColumn(name, F.coalesce("__at", F.lit(0))).drop("__k", "__t", "as_of", "__at")


def _days(rows: DataFrame, days: DataFrame, at: Column, keys: list[str]) -> DataFrame:
    """(keys, day, ord from 0) for the array ``at`` of the days' numbers; numbers that no day has are left out."""
    places = rows.select(*keys, F.posexplode(at).alias("ord", "at"))
    return places.join(F.broadcast(days), "at").select(*keys, "day", "ord")


def brackets(dates: DataFrame, days: DataFrame, date: str = "date", before: int = 1, after: int = 1, strict: bool = True) -> DataFrame:
    """(date, day, ord): for each distinct date the last ``before`` days of the calendar before it and the first ``after`` days
    behind it; unless ``strict``, a date that is itself a day of the calendar is among them. Beyond a calendar's ends there are
    fewer; a null date has none."""
    days = numbered(days)
    rows = dates.select(F.col(date).cast("date").alias(date)).where(F.col(date).isNotNull()).distinct()
    rows = _place(_place(rows, days, F.date_sub(date, 1), "__under"), days, F.col(date), "__upto")
    run = lambda first, n: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: first + i) if n else F.array().cast("array<int>")
    own = F.when(F.col("__upto") > F.col("__under"), F.array("__upto")).otherwise(F.array().cast("array<int>"))
    parts = [run(F.col("__under") - before, before), *([] if strict else [own]), run(F.col("__upto"), after)]
    found = _days(rows, days, F.filter(F.concat(*parts), lambda i: i > 0), [date])
    return found.select(date, "day", "ord")


def spans(ranges: DataFrame, days: DataFrame, keys: list[str], first: str = "first", last: str = "last", with_first: bool = True, with_last: bool = True) -> DataFrame:
    """(keys, day, ord): the calendar's days from ``first`` to ``last`` of each row, with or without the ends themselves. A row
    without days, or with a null end, gives none; ``keys`` tell the rows apart."""
    days = numbered(days)
    rows = ranges.select(*keys, F.col(first).cast("date").alias("__first"), F.col(last).cast("date").alias("__last")).where("__first is not null and __last is not null")
    rows = _place(rows, days, F.date_sub("__first", 1) if with_first else F.col("__first"), "__from")
    rows = _place(rows, days, F.col("__last") if with_last else F.date_sub("__last", 1), "__to")
    return _days(rows.where("__to > __from"), days, F.sequence(F.col("__from") + 1, F.col("__to")), keys)


def labelled(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, dates, n): each window's first and last day as ``YYYYMMDD-YYYYMMDD``, as in a product's header, and its length."""
    text = lambda c: F.date_format(c, "yyyyMMdd")
    return found.groupBy(*keys).agg(F.concat_ws("-", text(F.min("day")), text(F.max("day"))).alias("dates"), F.count("*").alias("n"))
