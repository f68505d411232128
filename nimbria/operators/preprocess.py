"""Preprocessing: each action maps a long table of parameters to another one, and actions compose in order.

``by`` are the columns that identify a cell (member, step, point); ``param`` tells the inputs apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbria.functions.columns import clip, compare, direction, zeroed

Action = Callable[[DataFrame, list[str]], DataFrame]


def scale(factor: float) -> Action:
    return lambda df, by: df.withColumn("value", F.col("value") * F.lit(float(factor)))


def norm(output: str = "norm") -> Action:
    """Euclidean norm over the inputs of a cell (u and v give speed)."""
    return lambda df, by: df.groupBy(*by).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("value")).withColumn("param", F.lit(output))


def total(output: str = "sum") -> Action:
    return lambda df, by: df.groupBy(*by).agg(F.sum("value").alias("value")).withColumn("param", F.lit(output))


def wind_direction(u: str, v: str, output: str = "direction") -> Action:
    """Where the wind comes from; cells without both inputs are left out."""

    def run(df: DataFrame, by: list[str]) -> DataFrame:
        both = df.where(F.col("param").isin(u, v)).groupBy(*by).agg(F.max(F.when(F.col("param") == u, F.col("value"))).alias("u"), F.max(F.when(F.col("param") == v, F.col("value"))).alias("v"))
        return both.where("u is not null and v is not null").select(*by, direction(F.col("u"), F.col("v")).alias("value"), F.lit(output).alias("param"))

    return run


def mask(select: str, left: str | float, sign: str, right: str | float, replacement: float, output: str | None = None) -> Action:
    """The selected parameter, replaced where ``left sign right`` holds; sides are numbers or parameters of the cell."""

    def run(df: DataFrame, by: list[str]) -> DataFrame:
        names = {x for x in (select, left, right) if isinstance(x, str)}
        wide = df.where(F.col("param").isin(*names)).groupBy(*by).agg(*[F.max(F.when(F.col("param") == p, F.col("value"))).alias(f"__{p}") for p in names])
        side = lambda x: F.col(f"__{x}") if isinstance(x, str) else F.lit(float(x))
        kept = F.col(f"__{select}")
        value = F.when(compare(side(left), sign, side(right)), F.lit(float(replacement))).otherwise(kept)
        return wide.where(kept.isNotNull()).select(*by, value.alias("value"), F.lit(output or select).alias("param"))

    return run


def reshape(inputs: list[str], order: str = "number") -> Action:
    """A stacked read split back to parameters: row r is input r mod n, member r div n (column-major)."""

    def run(df: DataFrame, by: list[str]) -> DataFrame:
        rest = [c for c in by if c != order]
        row = F.row_number().over(Window.partitionBy(*rest).orderBy(order)) - 1
        names = F.array(*[F.lit(i) for i in inputs])
        return df.withColumn("__row", row).withColumn("param", F.get(names, F.col("__row") % len(inputs))).withColumn(order, F.floor(F.col("__row") / len(inputs)).cast("int")).drop("__row")

    return run


def bounded(low: float | None = None, high: float | None = None) -> Action:
    return lambda df, by: df.withColumn("value", clip(F.col("value"), low, high))


def rounded_to_zero(epsilon: float, signed: bool = False) -> Action:
    return lambda df, by: df.withColumn("value", zeroed(F.col("value"), epsilon, signed))


def pipeline(*actions: Action) -> Action:
    def run(df: DataFrame, by: list[str]) -> DataFrame:
        for action in actions:
            df = action(df, by)
        return df

    return run


ACTIONS = {"scale": scale, "norm": norm, "sum": total, "direction": wind_direction, "mask": mask, "reshape": reshape, "clip": bounded, "zero": rounded_to_zero}


def from_config(specs: list[dict]) -> Action:
    """A pipeline from dictionaries with ``operation`` and its arguments."""
    made = []
    for spec in specs:
        options = dict(spec)
        operation = options.pop("operation")
        if operation not in ACTIONS:
            raise ValueError(f"unknown preprocessing {operation!r}")
        made.append(ACTIONS[operation](**options))
    return pipeline(*made)
