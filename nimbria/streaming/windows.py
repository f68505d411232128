"""The same windows on Structured Streaming.

``stream_accumulate`` keeps state variables per key and window (``transformWithState``) and emits a window once it is complete, like the batch
operator; a coordinate that arrives again, or after its window was emitted, is dropped. State goes when the watermark
passes the window's last field by ``late``, complete or not, so it is bounded by the stream's recent past. ``stream_windows``
is the event-time form (tumbling or sliding), whose watermark bounds state alike. ``run_once`` writes what a stream
emits as Parquet, with its checkpoint beside it, so that a stopped query goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from nimbria.plans import windows as W

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
FOLDS = ("sum", "minimum", "maximum", "mean")


def stream_windows(events: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None, late: str = "1 day") -> DataFrame:
    """(window start and end, keys, n, total, mean, low, high) over event time; times without zone are taken as UTC."""
    timed = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    window = F.window("__t", width, slide) if slide else F.window("__t", width)
    out = timed.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total", "mean", "low", "high")


class WindowFold(StatefulProcessor):
    """The state of one key's window: the map ``coords`` of coordinates to values that arrived, the running ``fold``, and a
    timer for when the watermark has passed the last of them by ``grace`` milliseconds; then all of it goes.

    A finished window keeps its fold without coordinates until then, so that what comes late or again is known.
    """

    FOLD = "n int, total double, low double, high double, last int, done boolean, timer bigint"

    def __init__(self, keys: list[str], grace: int):
        self.keys, self.grace = keys, grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.coords = handle.getMapState("coords", "coord int", "value double")
        self.fold = handle.getValueState("fold", self.FOLD)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, total, low, high, last, done, timer = self.fold.get() if self.fold.exists() else (0, 0.0, float("inf"), float("-inf"), -(2**31), False, 0)
        until, emitted = timer, []
        for batch in rows:
            until = max(until, int(batch["at"].max().timestamp() * 1000) + self.grace)
            if done:
                continue
            way, new = batch.iloc[0], batch.drop_duplicates("coord")
            if way.sequential:
                new = new[(new.coord > last) & (new.coord == new.coord.cummax())]
            else:
                new = new[[not self.coords.containsKey((int(c),)) for c in new.coord]]
            if new.empty:
                continue
            values = new.value.to_numpy(float)
            for coord, value in zip(new.coord, values, strict=True):
                self.coords.updateValue((int(coord),), (float(value),))
            n, last, total = n + len(new), int(new.coord.max()), total + values.sum()
            low, high = np.minimum(low, values.min()), np.maximum(high, values.max())  # a missing value stays
            done = bool(last == way.last_coord if way.sequential else n == way.n_coords)
            if done:
                emitted.append((*key, float({"sum": total, "mean": total / n, "minimum": low, "maximum": high}[way.op])))
                self.coords.clear()
        until = max(until, timerValues.getCurrentWatermarkInMs() + 1)
        if until != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(until)
        self.fold.update((n, float(total), float(low), float(high), last, done, until))
        if emitted:
            yield pd.DataFrame(emitted, columns=["window_id", *self.keys, "value"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.coords.clear()
        self.fold.clear()
        yield from ()


def held_state(spark: SparkSession, checkpoint: str, variable: str = "fold") -> DataFrame:
    """What a stopped query's state holds: ``fold`` has a row for each key and window, ``coords`` one for each coordinate."""
    return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)


def stream_accumulate(fields: DataFrame, windows: list[W.Window], keys: list[str], time: str, dim: str = "step", late: str = "1 day") -> DataFrame:
    """(keys, window_id, value) of completed windows; operations sum, minimum, maximum and mean. ``time`` is the fields'
    event time. Of fields that repeat a coordinate the first to arrive counts; sequential windows drop coordinates that
    come after a later one and end with their last."""
    if any(w.op not in FOLDS or w.deaccumulate for w in windows):
        raise ValueError(f"streams fold {FOLDS} only")
    small = sum(len(w.coords) for w in windows) <= 100_000
    table = W.frame(fields.sparkSession, windows).join(fields.sparkSession.createDataFrame([(w.window_id, w.op) for w in windows], "window_id string, op string"), "window_id")
    table = table.withColumnRenamed("coord", "__coord")
    timed = fields.withColumn("at", F.col(time).cast("timestamp")).withWatermark("at", late)
    joined = timed.join(F.broadcast(table) if small else table, F.col(dim) == F.col("__coord")).select("window_id", *keys, F.col(dim).alias("coord"), "value", "op", "sequential", "n_coords", "last_coord", "at")
    spark = fields.sparkSession
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # state variables need it
    kinds = ", ".join(f"`{k}` {fields.schema[k].dataType.simpleString()}" for k in keys)
    fold = WindowFold(keys, int(pd.Timedelta(late).total_seconds() * 1000))
    return joined.groupBy("window_id", *keys).transformWithStateInPandas(fold, f"window_id string, {kinds}, value double", "append", "eventTime")


def run_once(out: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there, in append mode, into Parquet files at ``path``; what those hold in all."""
    query = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return out.sparkSession.read.schema(out.schema).parquet(path)
