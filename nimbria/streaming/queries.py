"""Registered streaming queries: a finite stream is run to its end and its result returned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbria.plans import windows as W
from nimbria.sources.shared import shared_path
from nimbria.streaming.windows import run_once, stream_accumulate, stream_windows


def _finished(out: DataFrame) -> DataFrame:
    """The whole output of a finite stream, from files in the shared folder."""
    base = shared_path(out.sparkSession, "stream")
    return run_once(out, f"{base}/out", f"{base}/checkpoint")


def stream_daily(spark, sf):
    """Tumbling days by event type, of days that the watermark (a day behind the latest event) has passed."""
    out = _finished(stream_windows(_stream(spark, sf), "ts", ["event_type"], "1 day"))
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_sliding(spark, sf):
    """Two-day windows every day, passed by the watermark."""
    out = _finished(stream_windows(_stream(spark, sf), "ts", ["event_type"], "2 days", "1 day"))
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("high", 6).alias("high"))


def _stream(spark, sf) -> DataFrame:
    """The events table as a stream: its folder filtered to its own files, since a stream reads folders."""
    folder, _, name = f"{sf}/events.parquet".rpartition("/")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def stream_complete_windows(spark, sf):
    """Completion-driven windows of hours: the batch fold as state."""
    first = _stream(spark, sf).select(F.hour("ts").alias("step"), (F.col("user_id") % 60).cast("int").alias("number"), F.lit(1.0).alias("value"), "ts")
    windows = W.default([{"from": q, "to": q + 3} for q in range(0, 21)], "sum")
    return _finished(stream_accumulate(first, windows, ["number"], "ts")).select("window_id", "number", "value")


#: When a window's end is passed by the watermark.
PASSED = "(SELECT max(ts) FROM events) - INTERVAL 1 DAY"

QUERIES = {
    "stream_daily": (
        stream_daily,
        f"SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= {PASSED} GROUP BY ALL",
    ),
    "stream_sliding": (
        stream_sliding,
        f"SELECT strftime(CAST(ts AS DATE) - INTERVAL (k) DAY, '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS n, round(max(value), 6) AS high FROM events, range(0, 2) t(k) WHERE CAST(ts AS DATE) - INTERVAL (k) DAY + INTERVAL 2 DAY <= {PASSED} GROUP BY ALL",
    ),
    "stream_complete_windows": (
        stream_complete_windows,
        """WITH f AS (SELECT DISTINCT hour(ts) AS step, CAST(user_id % 60 AS INTEGER) AS number FROM events)
SELECT CAST(q AS VARCHAR) || '-' || CAST(q + 3 AS VARCHAR) AS window_id, number, CAST(count(*) AS DOUBLE) AS value FROM f, range(0, 21) t(q) WHERE step BETWEEN q AND q + 3 GROUP BY q, number HAVING count(*) = 4""",
    ),
}
