"""Spherical-harmonic transforms and wind from vorticity and divergence.

Coefficients are rows (keys, n, m, re, im) with 0 <= m <= n of a real field: the sum of c(n, m) P(n, m; mu) e^(i m lon),
terms with m > 0 counted with their conjugates. The associated Legendre functions are normalised so that half the integral
of their square is 1. A synthesis has two shuffles: by (block of fields, wavenumber m), one matrix product each, then by
(block of fields, row of latitude), one Fourier sum each; an analysis is the way back. A group holds at most about
``FIELDS`` fields at one wavenumber or one row, however many there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbria.functions.geo import EARTH_M
from nimbria.operators import grids

FIELDS = 64


def legendre(mu: np.ndarray, m: int, truncation: int) -> np.ndarray:
    """P(n, m; mu) for n = m .. truncation, a row for each n."""
    out = np.zeros((truncation - m + 1, len(mu)))
    k = np.arange(1, m + 1)
    with np.errstate(divide="ignore"):
        out[0] = np.exp(0.5 * np.log((2 * k + 1) / (2 * k)).sum() + m * np.log(np.sqrt(1 - mu * mu))) if m else 1.0
    epsilon = lambda n: np.sqrt((n * n - m * m) / (4.0 * n * n - 1))
    for i in range(1, len(out)):
        n = m + i
        out[i] = (mu * out[i - 1] - (epsilon(n - 1) * out[i - 2] if i > 1 else 0.0)) / epsilon(n)
    return out


def _rows(spark: SparkSession, grid: str) -> pd.DataFrame:
    """The 2 N rows of a grid, N checked by ``grids``."""
    return grids.rows(spark, grid).toPandas().sort_values("row")


def _blocked(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``block``: fields are dealt by hash to blocks of about ``FIELDS``."""
    fields = df.select(*keys).distinct().count() if keys else 1
    return df.withColumn("block", F.pmod(F.xxhash64(*keys) if keys else F.lit(0), F.lit(-(-fields // FIELDS) or 1)).cast("int"))


def _fields(df: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, pd.DataFrame]:
    """The number of each row's field in its group, and the fields' keys."""
    if not keys:
        return np.zeros(len(df), int), pd.DataFrame(index=[0])
    return df.groupby(keys, dropna=False, sort=False).ngroup().to_numpy(), df[keys].drop_duplicates()


def _spread(names: pd.DataFrame, width: int, **columns: np.ndarray) -> pd.DataFrame:
    """A row for each field and place, from arrays (field, place)."""
    made = pd.DataFrame({k: np.repeat(names[k].to_numpy(), width) for k in names.columns})
    for name, values in columns.items():
        made[name] = np.broadcast_to(values, (len(names), width)).reshape(-1)
    return made


def _schema(df: DataFrame, keys: list[str], rest: str) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in keys), *T._parse_datatype_string(rest).fields])


def synthesis(coefficients: DataFrame, keys: list[str], grid: str, truncation: int) -> DataFrame:
    """(keys, point_id int, value double): fields on a Gaussian grid from coefficients up to ``truncation``.

    Coefficients that are missing, or beyond the truncation, count as zero, repeated ones add up. Null or NaN parts make a
    field NaN. A row with fewer points than twice a wavenumber is summed at its points all the same.
    """
    rows = _rows(coefficients.sparkSession, grid)
    mu, row = rows.mu.to_numpy(), rows.row.to_numpy()
    n_lon, first = rows.n_lon.to_numpy(), rows["first"].to_numpy()

    def by_wavenumber(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        block, m = int(key[0]), int(key[1])
        field, names = _fields(group, keys)
        table = np.zeros((len(names), truncation - m + 1), complex)
        np.add.at(table, (field, group.n.to_numpy() - m), group.re.to_numpy(float) + 1j * group.im.to_numpy(float))
        made = table @ legendre(mu, m, truncation)
        return _spread(names, len(mu), block=np.int32(block), row=row, m=np.int32(m), re=made.real, im=made.imag)

    def by_row(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        at = int(np.flatnonzero(row == key[1])[0])
        field, names = _fields(group, keys)
        waves = np.zeros((len(names), n_lon[at]), complex)
        m = group.m.to_numpy()
        np.add.at(waves, (field, m % n_lon[at]), (group.re.to_numpy() + 1j * group.im.to_numpy()) * np.where(m > 0, 2.0, 1.0))
        values = np.fft.ifft(waves, axis=1).real * n_lon[at]
        return _spread(names, n_lon[at], point_id=(first[at] + np.arange(n_lon[at])).astype(np.int32), value=values)

    kept = coefficients.where(F.col("m").between(0, F.col("n")) & (F.col("n") <= truncation))
    blocked = _blocked(kept, keys).select(*keys, "block", F.col("n").cast("int").alias("n"), F.col("m").cast("int").alias("m"), "re", "im")
    waves = blocked.groupBy("block", "m").applyInPandas(by_wavenumber, _schema(coefficients, keys, "block int, row int, m int, re double, im double"))
    return waves.groupBy("block", "row").applyInPandas(by_row, _schema(coefficients, keys, "point_id int, value double"))


def analysis(fields: DataFrame, keys: list[str], grid: str, truncation: int) -> DataFrame:
    """(keys, n int, m int, re, im double): coefficients up to ``truncation`` of fields (keys, point_id, value).

    Exact for fields of that truncation if N > truncation / 2 and rows have more than twice as many points. A point without
    a row in ``fields`` counts as zero, a NaN makes its row's waves NaN.
    """
    rows = _rows(fields.sparkSession, grid)
    mu, weight = rows.mu.to_numpy(), rows.weight.to_numpy()
    n_lon, first = rows.n_lon.to_numpy(), rows["first"].to_numpy()

    def by_row(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        at = int(key[1])
        field, names = _fields(group, keys)
        values = np.zeros((len(names), n_lon[at]))
        values[field, group.point_id.to_numpy() - first[at]] = group.value.to_numpy(float)
        waves = np.fft.rfft(values, axis=1)[:, : truncation + 1] / n_lon[at]
        width = waves.shape[1]
        return _spread(names, width, block=np.int32(key[0]), row=np.int32(at), m=np.arange(width, dtype=np.int32), re=waves.real, im=waves.imag)

    def by_wavenumber(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        m = int(key[1])
        field, names = _fields(group, keys)
        waves = np.zeros((len(names), len(mu)), complex)
        waves[field, group.row.to_numpy()] = group.re.to_numpy() + 1j * group.im.to_numpy()
        made = (waves * weight / 2) @ legendre(mu, m, truncation).T
        return _spread(names, made.shape[1], n=np.arange(m, truncation + 1, dtype=np.int32), m=np.int32(m), re=made.real, im=made.imag)

    edges = F.array(*[F.lit(int(x)) for x in first])
    placed = _blocked(fields, keys).withColumn("row", F.lit(0))
    # the row of a point: how many rows begin at or before it, by a binary search in steps of powers of two
    step = 1 << max(0, (len(first) - 1).bit_length() - 1)
    at = F.lit(0)
    while step:
        placed = placed.withColumn("row", at)
        ahead = F.col("row") + step
        at = F.when((ahead < len(first)) & (F.get(edges, ahead) <= F.col("point_id")), ahead).otherwise(F.col("row"))
        step //= 2
    placed = placed.withColumn("row", at).select(*keys, "block", "row", "point_id", "value")
    waves = placed.groupBy("block", "row").applyInPandas(by_row, _schema(fields, keys, "block int, row int, m int, re double, im double"))
    return waves.groupBy("block", "m").applyInPandas(by_wavenumber, _schema(fields, keys, "n int, m int, re double, im double"))


def wind_coefficients(coefficients: DataFrame, keys: list[str], radius: float = EARTH_M) -> DataFrame:
    """(keys, param, n, m, re, im): coefficients of u cos(lat) (param ``U``) and v cos(lat) (``V``), to one degree more than
    those of vorticity (param ``vo``) and divergence (``d``).

    Stream function and velocity potential are -radius^2 / (n (n + 1)) times them (the mean, n = 0, has none). Each
    coefficient contributes to its neighbours in n, summed by one grouped aggregate that combines map-side.
    """
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    epsilon = lambda k: F.sqrt((k * k - m * m) / (4 * k * k - 1))
    scale = -radius / (n * (n + 1))
    re, im = F.col("re") * scale, F.col("im") * scale
    turned, straight = F.when(F.col("param") == "vo", "V").otherwise("U"), F.when(F.col("param") == "vo", "U").otherwise("V")
    sign = F.when(F.col("param") == "vo", 1.0).otherwise(-1.0)
    part = lambda to, at, a, b: F.struct(to.alias("param"), at.cast("int").alias("n"), a.alias("re"), b.alias("im"))
    up, down = sign * n * epsilon(n + 1), -sign * (n + 1) * epsilon(n)
    parts = F.array(part(turned, n, -m * im, m * re), part(straight, n + 1, up * re, up * im), part(straight, n - 1, down * re, down * im))
    rows = coefficients.where(F.col("param").isin("vo", "d") & (F.col("n") > 0) & F.col("m").between(0, F.col("n")))
    rows = rows.select(*keys, F.col("m").cast("int").alias("m"), F.explode(parts).alias("x")).where("x.n >= m")
    return rows.groupBy(*keys, F.col("x.param").alias("param"), F.col("x.n").alias("n"), "m").agg(F.sum("x.re").alias("re"), F.sum("x.im").alias("im"))


def wind_on_grid(coefficients: DataFrame, keys: list[str], grid: str, truncation: int, radius: float = EARTH_M) -> DataFrame:
    """(keys, param ``u`` or ``v``, point_id, value): wind in m/s on a Gaussian grid from coefficients (keys, param ``vo`` or
    ``d``, n, m, re, im) up to ``truncation``; a missing one of the two counts as zero."""
    kept = coefficients.where(F.col("n") <= truncation)
    made = synthesis(wind_coefficients(kept, keys, radius), [*keys, "param"], grid, truncation + 1)
    points = grids.points(coefficients.sparkSession, grid).select("point_id", F.cos(F.radians("lat")).alias("c"))
    on = made.join(points, "point_id")
    return on.select(*keys, F.lower("param").alias("param"), "point_id", (F.col("value") / F.col("c")).alias("value"))
