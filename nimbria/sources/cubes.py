"""Dense field cubes over the warehouse tables: the long form that all operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quarter(col: str):
    return ((F.year(col) - 1995) * 4 + F.quarter(col) - 1).cast("int")


def fields(spark: SparkSession, sf_dir: str, points: int = 20) -> DataFrame:
    """step = quarter of shipping, number = line number, point = supplier mod ``points``, value = shipped quantity."""
    items = table(spark, sf_dir, "lineitem").select(
        quarter("l_shipdate").alias("step"), F.col("l_linenumber").cast("int").alias("number"), (F.col("l_suppkey") % points).cast("int").alias("point_id"), "l_quantity"
    )
    return items.groupBy("step", "number", "point_id").agg(F.sum("l_quantity").alias("value"))


FIELDS_SQL = """fields AS (
  SELECT CAST((year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS step, CAST(l_linenumber AS INTEGER) AS number,
    CAST(l_suppkey % 20 AS INTEGER) AS point_id, sum(l_quantity) AS value
  FROM lineitem GROUP BY ALL)"""


def wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parameters a cell: u = quantity - 25 and v = size of the discount's effect, signed by the line's status."""
    items = table(spark, sf_dir, "lineitem").select(
        quarter("l_shipdate").alias("step"), F.col("l_linenumber").cast("int").alias("number"), (F.col("l_suppkey") % 20).cast("int").alias("point_id"), "l_quantity", "l_linestatus"
    )
    cells = items.groupBy("step", "number", "point_id").agg(
        (F.sum("l_quantity") - 25.0 * F.count("*")).alias("u"), F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(-F.col("l_quantity"))).alias("v")
    )
    return cells.select("step", "number", "point_id", F.expr("stack(2, 'u', u, 'v', v) as (param, value)"))


WIND_SQL = """cells AS (
  SELECT CAST((year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS step, CAST(l_linenumber AS INTEGER) AS number,
    CAST(l_suppkey % 20 AS INTEGER) AS point_id, sum(l_quantity) - 25.0::DOUBLE * count(*) AS u,
    sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity END) AS v
  FROM lineitem GROUP BY ALL)"""


def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """step = day, number = user mod 5, point = event type, value = events times day: with gaps at small scale."""
    e = table(spark, sf_dir, "events").select(F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("step"), (F.col("user_id") % 5).cast("int").alias("number"), F.col("event_type").alias("point"))
    return e.groupBy("step", "number", "point").agg(F.count("*").cast("double").alias("value"))


EVENTS_SQL = """fields AS (
  SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS step, CAST(user_id % 5 AS INTEGER) AS number, event_type AS point,
    CAST(count(*) AS DOUBLE) AS value
  FROM events GROUP BY ALL)"""


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders since 2000 as forecast members: point = customer mod 12, value = total price in whole units."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= "2000-01-01")
    return o.select((F.col("o_custkey") % 12).cast("int").alias("point_id"), F.round("o_totalprice").alias("value"))


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before 2000 as the climatological sample."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < "2000-01-01")
    return o.select((F.col("o_custkey") % 12).cast("int").alias("point_id"), F.round("o_totalprice").alias("value"))


ORDERS_SQL = """fc AS (SELECT CAST(o_custkey % 12 AS INTEGER) AS point_id, round(o_totalprice) AS value FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'),
cl AS (SELECT CAST(o_custkey % 12 AS INTEGER) AS point_id, round(o_totalprice) AS value FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"""


def climate_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(point_id, quantile 0..100, value) of the climatological sample."""
    q = climate(spark, sf_dir).groupBy("point_id").agg(F.percentile("value", F.array(*[F.lit(i / 100) for i in range(101)])).alias("q"))
    return q.select("point_id", F.posexplode("q").alias("quantile", "value"))
