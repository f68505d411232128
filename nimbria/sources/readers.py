"""Readers: a registry of named sources, key filters that reach the scan, and the text formats of tracks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbria.functions.geo import displacement_km

READERS: dict[str, Callable[..., DataFrame]] = {}


def reader(name: str):
    def register(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        READERS[name] = function
        return function

    return register


def split_location(location: str, default: str = "table") -> tuple[str, str]:
    """``kind:path`` of a location; a path of its own is of the default kind."""
    kind, colon, path = location.partition(":")
    return (kind, path) if colon and kind in READERS else (default, location)


def key_filter(request: dict) -> Column:
    """Equality or membership for each key, all together. A null key is equal to nothing."""
    out = F.lit(True)
    for key, value in request.items():
        out = out & (F.col(key).isin(list(value)) if isinstance(value, list | tuple | set | range) else F.col(key) == value)
    return out


def matching(df: DataFrame, request: dict) -> DataFrame:
    """The rows that match a request. No row has a key that the table lacks, so such a request matches nothing."""
    return df.where(key_filter(request)) if set(request) <= set(df.columns) else df.where(F.lit(False))


@reader("table")
def read_table(spark: SparkSession, path: str, request: dict | None = None) -> DataFrame:
    """A field table (Parquet, partitioned by its keys); the request becomes partition and pushed filters."""
    df = spark.read.parquet(path)
    return matching(df, request or {})


@reader("fileset")
def read_fileset(spark: SparkSession, template: str, request: dict | None = None) -> DataFrame:
    """Files whose path is a template of request keys; list values read several files."""
    from nimbria.plans.requests import expand

    request = request or {}
    used = [k for k in request if f"{{{k}" in template]
    paths = sorted({template.format(**r) for r in expand({k: request[k] for k in used}, used)})
    df = spark.read.parquet(*paths)
    return matching(df, {k: v for k, v in request.items() if k not in used})


@reader("json")
def read_json(spark: SparkSession, path: str, request: dict | None = None, schema: str | None = None) -> DataFrame:
    """JSON predictions; ``step`` comes from the file's name (the last number in it)."""
    df = (spark.read.schema(schema) if schema else spark.read).option("multiLine", True).json(path)
    return df.withColumn("step", F.regexp_extract(F.input_file_name(), r"(\d+)\D*$", 1).cast("int"))


def open_source(spark: SparkSession, location: str, request: dict | None = None) -> DataFrame:
    kind, path = split_location(location)
    return READERS[kind](spark, path, request)


def open_parts(spark: SparkSession, location: str, requests: list[dict]) -> list[DataFrame]:
    return [open_source(spark, location, r) for r in requests]


def open_union(spark: SparkSession, location: str, requests: list[dict]) -> DataFrame:
    """Several requests of one source as one table (control and perturbed members, say)."""
    return reduce(DataFrame.unionByName, open_parts(spark, location, requests))


def open_single(spark: SparkSession, location: str, requests: list[dict]) -> DataFrame:
    if len(requests) != 1:
        raise ValueError(f"one part expected, {len(requests)} given")
    return open_parts(spark, location, requests)[0]


def not_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the request matches no field")
    return df


def unpack(packed: DataFrame, values: str = "values") -> DataFrame:
    """One row a grid point from fields packed as arrays."""
    rest = [c for c in packed.columns if c != values]
    return packed.select(*rest, F.posexplode(values).alias("point_id", "value"))


def pack(fields: DataFrame, keys: list[str]) -> DataFrame:
    """Fields as arrays in point order; a field is one row."""
    return fields.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("point_id", "value"))), lambda x: x["value"]).alias("values"))


def climatology_pair(df: DataFrame, keys: list[str], step_map: dict[int, int] | None = None) -> DataFrame:
    """(keys, step, mean, std) from fields of types em and es; forecast steps map to climatology steps by a small table."""
    wide = df.groupBy(*keys, "step").agg(F.max(F.when(F.col("type") == "em", F.col("value"))).alias("mean"), F.max(F.when(F.col("type") == "es", F.col("value"))).alias("std"))
    if not step_map:
        return wide
    table = df.sparkSession.createDataFrame([(int(a), int(b)) for a, b in step_map.items()], "step int, __clim int")
    return wide.withColumnRenamed("step", "__clim").join(F.broadcast(table), "__clim").drop("__clim")


def single_window(df: DataFrame) -> DataFrame:
    """``df`` itself; an error unless exactly one window is in it."""
    n = df.select("window_id").distinct().limit(2).count()
    if n != 1:
        raise ValueError(f"one climatology window expected, found {'none' if n == 0 else 'several'}")
    return df


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, n, v): trimmed lines of text files. Spark reads a large file in blocks of bytes, each by a task; lines are
    in order of (block, n), n counting only within a block."""
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), F.rtrim("value").alias("v"))


def running_count(lines: DataFrame, flag: Column, name: str) -> DataFrame:
    """``lines`` with how many lines of their file up to theirs have ``flag``: counts of whole blocks are added up first (a row
    a block), then each block counts its own lines, so that no file is one task's."""
    one = F.when(flag, 1).otherwise(0)
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum(one).alias("__k"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("__k").over(ahead), F.lit(0)).alias("__before"))
    within = F.sum(one).over(Window.partitionBy("file", "block").orderBy("n"))
    return lines.withColumn(name, within).join(blocks, ["file", "block"]).withColumn(name, F.col(name) + F.col("__before")).drop("__before")


@reader("tracks-text")
def read_tracks_text(spark: SparkSession, path: str, request: dict | None = None) -> DataFrame:
    """Fixed-form track text: category lines (starting with a letter) begin a new track; rows are
    ``number lat[N|S] lon[E|W] date step wind msl``. A track's id is the running count of category lines of its file."""
    lines = numbered_lines(spark, path).withColumn("v", F.ltrim("v")).where("v <> ''")
    header = F.col("v").rlike("^[A-Za-z]")
    lines = running_count(lines, header, "id").where(~header)
    part = F.split("v", r"\s+")
    signed = lambda i, minus: F.regexp_extract(F.get(part, F.lit(i)), r"^([\d.\-]+)", 1).cast("double") * F.when(F.get(part, F.lit(i)).rlike(f"(?i){minus}$"), -1).otherwise(1)
    return lines.select(F.get(part, F.lit(0)).cast("int").alias("number"), F.col("id").cast("int"), F.get(part, F.lit(4)).cast("int").alias("step"), signed(1, "S").alias("lat"), signed(2, "W").alias("lon"), F.get(part, F.lit(3)).alias("date"), F.get(part, F.lit(5)).cast("double").alias("wind"), F.get(part, F.lit(6)).cast("double").alias("msl"))


@reader("tracks-csv")
def read_tracks_csv(spark: SparkSession, path: str, request: dict | None = None, base: str | None = None) -> DataFrame:
    """CSV with datetime, name, lat_p, lon_p, wind; the step is in hours after ``base`` (default each track's first)."""
    df = spark.read.option("header", True).schema("datetime string, name string, lat_p double, lon_p double, wind double").csv(path)
    t = F.to_timestamp("datetime")
    zero = F.lit(base).cast("timestamp") if base else F.min(t).over(Window.partitionBy("name"))
    number = F.regexp_extract("name", r"(\d+)\s*$", 1)
    return df.select(F.when(number == "", 0).otherwise(F.expr("try_cast(regexp_extract(name, '(\\\\d+)\\\\s*$', 1) as int)")).alias("number"), F.lit(1).alias("id"), F.timestamp_diff("HOUR", zero, t).cast("int").alias("step"), F.col("lat_p").alias("lat"), F.col("lon_p").alias("lon"), "wind")


@reader("tracks-points")
def read_tracks_points(spark: SparkSession, path: str, request: dict | None = None) -> DataFrame:
    """White-space separated ``number step lat lon wind``; ``#`` begins a comment; the id is the number."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("v")).where("v <> ''")
    part = F.split("v", r"\s+")
    at = lambda i, kind: F.get(part, F.lit(i)).cast(kind)
    return lines.select(at(0, "int").alias("number"), at(0, "int").alias("id"), at(1, "int").alias("step"), at(2, "double").alias("lat"), at(3, "double").alias("lon"), at(4, "double").alias("wind"))


KNOT = 0.514444


#: Where the columns of a tracker line begin and how long they are (counted from 0).
TRACKER = {"year": (6, 4), "month": (11, 2), "day": (14, 2), "hour": (17, 2), "lat_p": (20, 3), "lon_p": (23, 4), "wind": (28, 3), "pres": (32, 4), "lat_w": (37, 3), "lon_w": (40, 4)}
SOUTHERN = ("aus", "spc", "sin")


@reader("tracker")
def read_tracker(spark: SparkSession, path: str, request: dict | None = None, base: str = "1970-01-01", basin: str = "nat") -> DataFrame:
    """Tracker text in fixed columns: (file, name, datetime, step, lat_p, lon_p, wind, pres, lat_w, lon_w, windrad, speed,
    accdist, dpdt).

    A line whose second word begins with the year of ``base`` is a point; one whose first word has no 0 at its fifth place
    ends a cyclone. Cyclones are numbered in a file's order; one that no line ends is left out. Positions are tenths of
    a degree, taken at the cell's centre, south in southern basins; winds are knots, made m/s; steps are hours after ``base``.
    ``windrad`` is the distance of the strongest wind in km; ``speed`` (m/s), ``accdist`` (km from the first point) and ``dpdt``
    (an hour) are those since the cyclone's line before, null on its first; a speed or change over no time is null.
    """
    words = F.split("v", " ")
    point = F.coalesce(F.startswith(F.get(words, F.lit(1)), F.lit(base[:4])), F.lit(False))
    ends = ~point & (F.length(F.get(words, F.lit(0))) >= 5) & (F.substring(F.get(words, F.lit(0)), 5, 1) != "0")
    marked = running_count(numbered_lines(spark, path), ends, "part").where(point)
    ended = numbered_lines(spark, path).where(ends).groupBy("file").agg(F.count("*").alias("parts"))
    held = marked.join(ended, "file").where("part < parts").drop("parts")
    numbers = held.select("file", "part").distinct().withColumn("tc", F.row_number().over(Window.partitionBy("file").orderBy("part")))  # a row a cyclone
    at = lambda name, kind="double": F.trim(F.substring("v", TRACKER[name][0] + 1, TRACKER[name][1])).cast(kind)
    when = F.make_timestamp(at("year", "int"), at("month", "int"), at("day", "int"), at("hour", "int"), F.lit(0), F.lit(0))
    south = -1.0 if basin in SOUTHERN else 1.0
    where = [c for side in ("p", "w") for c in ((south * at(f"lat_{side}") / 10 + 0.05).alias(f"lat_{side}"), (at(f"lon_{side}") / 10 + 0.05).alias(f"lon_{side}"))]
    step = F.timestamp_diff("HOUR", F.lit(base).cast("timestamp"), when).cast("int")
    rows = held.join(numbers, ["file", "part"]).select("file", "part", "block", "n", F.concat(F.lit(f"unnamed_{basin}"), F.col("tc")).alias("name"), when.alias("datetime"), step.alias("step"), *where[:2], (at("wind") * KNOT).alias("wind"), at("pres").alias("pres"), *where[2:])
    order = Window.partitionBy("file", "part").orderBy("block", "n")
    since = lambda c: F.col(c) - F.lag(c).over(order)
    rows = rows.withColumn("windrad", displacement_km(F.col("lat_p") - F.col("lat_w"), F.col("lon_p") - F.col("lon_w"), F.col("lat_p")))
    rows = rows.withColumn("__d", displacement_km(since("lat_p"), since("lon_p"), F.col("lat_p"))).withColumn("__h", since("step"))
    rows = rows.withColumn("speed", F.try_divide(F.col("__d") * 1000, F.col("__h") * 3600.0)).withColumn("dpdt", F.try_divide(since("pres"), F.col("__h").cast("double")))
    rows = rows.withColumn("accdist", F.when(F.col("__d").isNotNull(), F.sum("__d").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    return rows.select("file", "name", "datetime", "step", "lat_p", "lon_p", "wind", "pres", "lat_w", "lon_w", "windrad", "speed", "accdist", "dpdt")


@reader("best-track")
def read_best_track(spark: SparkSession, path: str, request: dict | None = None) -> DataFrame:
    """Best-track CSV with a header and a row of units, which is skipped; positions are numbers."""
    df = spark.read.option("header", True).csv(path)
    return df.where(F.expr("try_cast(LAT as double)").isNotNull())


@reader("records")
def read_records(spark: SparkSession, path: str, request: dict | None = None, dtype: str = ">f4") -> DataFrame:
    """Sequential records (length, payload, length; big-endian): (file, record, values array<double>)."""

    def run(batches):
        for batch in batches:
            files, index, values = [], [], []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = 0, 0
                while at < len(raw):
                    size = int.from_bytes(raw[at : at + 4], "big")
                    files.append(name)
                    index.append(n)
                    values.append(np.frombuffer(raw[at + 4 : at + 4 + size], dtype).astype(float).tolist())
                    at, n = at + 8 + size, n + 1
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(index, pa.int32()), pa.array(values, pa.list_(pa.float64()))], names=["file", "record", "values"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, record int, values array<double>")
