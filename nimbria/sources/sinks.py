"""Sinks and recovery: writers by location, overwriting by key, and a checkpoint table for restarts."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbria.functions.columns import to_missing
from nimbria.model import CHECKPOINTS

Writer = Callable[[DataFrame], None]


def null_sink() -> Writer:
    return lambda df: df.write.format("noop").mode("overwrite").save()


def file_sink(path: str, kind: str = "parquet", append: bool = False) -> Writer:
    """A run overwrites its output; with ``append`` (recovery) it adds to it."""
    return lambda df: df.write.mode("append" if append else "overwrite").format(kind).save(path)


def fileset_sink(path: str, keys: list[str]) -> Writer:
    """A folder for each combination of keys. A rerun replaces the folders that it writes, so that rows never double."""
    return table_sink(path, keys)


def table_sink(path: str, keys: list[str]) -> Writer:
    """A field table: writing the same keys again replaces their partitions, others stay."""
    return lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def with_keys(sink: Writer, **values) -> Writer:
    """A sink that sets columns before it writes."""
    return lambda df: sink(df.withColumns({k: F.lit(v) for k, v in values.items()}))


SINKS = {"null": lambda path, **o: null_sink(), "file": file_sink, "fileset": fileset_sink, "table": table_sink}


def sink_for(location: str, **options) -> Writer:
    kind, colon, path = location.partition(":")
    if not colon and kind != "null":
        kind, path = "file", location
    if kind not in SINKS:
        raise ValueError(f"unknown sink {kind!r}")
    return SINKS[kind](path, **options)


def read_back(spark: SparkSession, location: str, like: DataFrame) -> DataFrame | None:
    """What a sink wrote at a location, with the columns and types of ``like``; None for a sink that keeps nothing."""
    kind, colon, path = location.partition(":")
    if kind == "null":
        return None
    path = path if colon and kind in SINKS else location
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def keep_latest(df: DataFrame, keys: list[str], run: str = "run") -> DataFrame:
    """One row per key: the one of the latest run."""
    order = Window.partitionBy(*keys).orderBy(F.desc(run))
    return df.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def set_keys(meta: str, updates: dict[str, str]) -> F.Column:
    """A metadata map with keys set, and those set to ``MISSING`` removed."""
    gone = [k for k, v in updates.items() if v == "MISSING"]
    put = {k: v for k, v in updates.items() if v != "MISSING"}
    base = F.map_filter(F.coalesce(F.col(meta), F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin([*gone, *put]) if updates else F.lit(True))
    return F.map_concat(base, F.create_map(*[F.lit(str(x)) for kv in put.items() for x in kv])) if put else base


def encode_missing(fields: DataFrame, sentinel: float = -9999.0) -> DataFrame:
    """Fields with NaN as the sentinel, and the number of missing values a row group carries as a flag."""
    return fields.withColumn("missing", F.isnan("value")).withColumn("value", to_missing(F.col("value"), sentinel))


class Recovery:
    """Checkpoints of finished windows of one configuration, in a shared table; restarts skip what is done.

    The table is only ever appended to, so that jobs may share it: a row without a window forgets what its configuration
    wrote before it. Notes are numbered: each follows the greatest number of its configuration, so that machines whose clocks
    differ keep the order in which they saw each other's notes.
    """

    def __init__(self, spark: SparkSession, path: str, config: dict, enabled: bool = True):
        self.spark, self.path, self.enabled = spark, path, enabled
        self.key = hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()

    def _own(self) -> DataFrame:
        try:
            return self.spark.read.schema(CHECKPOINTS).parquet(self.path).where(F.col("config") == self.key)
        except Exception as e:  # no checkpoint was written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], CHECKPOINTS)

    def done(self) -> DataFrame:
        """(window_id) of the windows finished since the configuration was last cleaned."""
        last = F.max(F.when(F.col("window_id").isNull(), F.col("at"))).alias("cleaned")
        own = self._own().groupBy("window_id").agg(F.max("at").alias("at"))
        cleaned = self._own().agg(last).first().cleaned or 0
        return own.where(F.col("window_id").isNotNull() & (F.col("at") > cleaned)).select("window_id")

    def remaining(self, windows: DataFrame) -> DataFrame:
        return windows.join(self.done(), "window_id", "left_anti") if self.enabled else windows

    def _write(self, window_ids: list[str | None]) -> None:
        if self.enabled and window_ids:
            now = (self._own().agg(F.max("at")).first()[0] or 0) + 1  # later than all that this job can know of, whatever the machines' clocks say
            self.spark.createDataFrame([(self.key, w, now) for w in window_ids], CHECKPOINTS).coalesce(1).write.mode("append").parquet(self.path)

    def add(self, window_ids: list[str]) -> None:
        self._write(list(window_ids))

    def clean(self) -> None:
        """Forget this configuration."""
        self._write([None])
