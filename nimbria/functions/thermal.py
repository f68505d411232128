"""Thermal-comfort indices as Column functions, from the published formulas. Temperatures in kelvin, wind in m/s,
humidity in percent, fluxes in W/m2; results in kelvin unless said otherwise. Null or NaN inputs give null or NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbria.operators import intervals

ZERO_C = 273.15
STEFAN = 5.67e-8


def _c(k: Column) -> Column:
    return k - ZERO_C


def _tetens(c: Column) -> Column:
    """Saturation vapour pressure over water in hPa at a temperature in degrees Celsius."""
    return 6.11 * F.pow(F.lit(10.0), 7.5 * c / (237.3 + c))


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def relative_humidity(t: Column, td: Column) -> Column:
    """Percent."""
    return 100 * _tetens(_c(td)) / _tetens(_c(t))


def vapour_pressure(t: Column, rh: Column) -> Column:
    """hPa, from humidity in percent."""
    return rh / 100 * 6.105 * F.exp(17.27 * _c(t) / (237.7 + _c(t)))


def humidex(t: Column, td: Column) -> Column:
    """Masterton and Richardson 1979."""
    e = 6.11 * F.exp(5417.7530 * (1 / 273.16 - 1 / td))
    return t + 0.5555 * (e - 10)


def heat_index(t: Column, td: Column) -> Column:
    """Rothfusz regression with the weather service's adjustments; the simple form below 80 F."""
    rh = relative_humidity(t, td)
    f = _c(t) * 1.8 + 32
    simple = 0.5 * (f + 61 + (f - 68) * 1.2 + rh * 0.094)
    full = -42.379 + 2.04901523 * f + 10.14333127 * rh - 0.22475541 * f * rh - 6.83783e-3 * f * f - 5.481717e-2 * rh * rh + 1.22874e-3 * f * f * rh + 8.5282e-4 * f * rh * rh - 1.99e-6 * f * f * rh * rh
    dry = (13 - rh) / 4 * F.sqrt(F.greatest((17 - F.abs(f - 95)) / 17, F.lit(0.0)))
    wet = (rh - 85) / 10 * ((87 - f) / 5)
    full = F.when((rh < 13) & f.between(80, 112), full - dry).when((rh > 85) & f.between(80, 87), full + wet).otherwise(full)
    return (F.when((simple + f) / 2 < 80, simple).otherwise(full) - 32) / 1.8 + ZERO_C


def wind_chill(t: Column, ws: Column) -> Column:
    """Environment Canada 2001."""
    p = F.pow(ws * 3.6, F.lit(0.16))
    return 13.12 + 0.6215 * _c(t) - 11.37 * p + 0.3965 * _c(t) * p + ZERO_C


def apparent_temperature(t: Column, ws: Column, rh: Column) -> Column:
    """Steadman 1984."""
    return t + 0.33 * vapour_pressure(t, rh) - 0.7 * ws - 4.0


def normal_effective_temperature(t: Column, ws: Column, rh: Column) -> Column:
    """Li and Chan 2000."""
    c = _c(t)
    return 37 - (37 - c) / (0.68 - 0.0014 * rh + 1 / (1.76 + 1.4 * F.pow(ws, F.lit(0.75)))) - 0.29 * c * (1 - 0.01 * rh) + ZERO_C


def wet_bulb(t: Column, rh: Column) -> Column:
    """Stull 2011."""
    c = _c(t)
    return c * F.atan(0.151977 * F.sqrt(rh + 8.313659)) + F.atan(c + rh) - F.atan(rh - 1.676331) + 0.00391838 * F.pow(rh, F.lit(1.5)) * F.atan(0.023101 * rh) - 4.686035 + ZERO_C


def globe_temperature(t: Column, mrt: Column, ws: Column) -> Column:
    """Root of Tg^4 + f Tg = f t + mrt^4 (standard black globe, emissivity 0.98 - 0.15 m), by Newton steps from t."""
    f = 1.1e8 * F.pow(ws, F.lit(0.6)) / (0.95 * 0.15**0.4)
    goal = f * t + F.pow(mrt, F.lit(4.0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.greatest(t, mrt), lambda g, _: g - (g * g * g * g + f * g - goal) / (4 * g * g * g + f))


def wet_bulb_globe(t: Column, mrt: Column, ws: Column, td: Column) -> Column:
    return 0.7 * wet_bulb(t, relative_humidity(t, td)) + 0.2 * globe_temperature(t, mrt, ws) + 0.1 * t


def per_second(accumulated: Column, hours: float) -> Column:
    return accumulated / F.lit(3600.0 * hours)


def direct_radiation(fdir: Column, cossza: Column, low: float = 0.01) -> Column:
    """Direct radiation on a plane facing the sun."""
    return F.when(cossza > low, fdir / F.when(cossza > low, cossza).otherwise(1.0)).otherwise(F.lit(0.0))


def mean_radiant_temperature(ssrd: Column, ssr: Column, dsrp: Column, strd: Column, fdir: Column, strr: Column, cossza: Column) -> Column:
    """Di Napoli et al. 2020; ``strr`` is the net thermal flux. Negative solar and downward fluxes count as 0, the net
    thermal flux does not; ``dsrp`` comes from fdir before that."""
    up = lambda x: F.greatest(x, F.lit(0.0))
    ssrd, fdir, strd, ssr = up(ssrd), up(fdir), up(strd), up(ssr)
    diffuse, reflected, upward = ssrd - fdir, ssrd - ssr, strd - strr
    gamma = F.degrees(F.asin(F.greatest(F.least(cossza, F.lit(1.0)), F.lit(-1.0))))
    projected = 0.308 * F.cos(F.radians(gamma * (0.998 - gamma * gamma / 50000)))
    sun = F.when(cossza > 0.01, projected * dsrp).otherwise(0.0)
    return F.pow((0.5 * strd + 0.5 * upward + 0.7 / 0.97 * (0.5 * diffuse + 0.5 * reflected + sun)) / STEFAN, F.lit(0.25))


def utci_valid(t: Column, ws: Column, mrt: Column, e: Column) -> Column:
    """Where the polynomial of Broede et al. 2012 may be used; ``e`` in hPa."""
    nan = F.isnan(t) | F.isnan(ws) | F.isnan(mrt) | F.isnan(e)
    return ~nan & (_c(t) < 70) & (_c(t) > -70) & (ws < 25) & (e <= 50) & (mrt - t < 150) & (mrt - t > -30)


def utci(t: Column, ws: Column, mrt: Column, e: Column, coefficients: dict[tuple[int, int, int, int], float]) -> Column:
    """Universal thermal climate index by its published polynomial: ``coefficients`` of t^i ws^j d^k p^l (t in Celsius,
    d = mrt - t, p = vapour pressure in kPa). The table of 210 coefficients is a parameter; outside validity NaN."""
    c, d, p = _c(t), mrt - t, e / 10
    powers = lambda x, n: F.lit(1.0) if n == 0 else F.pow(x, F.lit(float(n)))
    offset = F.lit(0.0)
    for (i, j, k, n), a in sorted(coefficients.items()):
        offset = offset + a * powers(c, i) * powers(ws, j) * powers(d, k) * powers(p, n)
    return F.when(utci_valid(t, ws, mrt, e), t + offset).otherwise(F.lit(float("nan")))


def declination(day: Column) -> Column:
    """Solar declination in radians by day of the year (Spencer 1971)."""
    g = 2 * 3.141592653589793 * (day - 1) / 365
    return 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)


def cos_zenith(lat: Column, lon: Column, day: Column, hour: Column) -> Column:
    """Cosine of the solar zenith angle at an hour (UTC), 0 below the horizon."""
    d, h = declination(day), F.radians((hour - 12) * 15 + lon)
    return F.greatest(F.sin(d) * F.sin(F.radians(lat)) + F.cos(d) * F.cos(F.radians(lat)) * F.cos(h), F.lit(0.0))


def cos_zenith_integrated(lat: Column, lon: Column, day: Column, first: Column, last: Column) -> Column:
    """Mean over an interval of hours by two-point Gauss quadrature in each hour."""
    mean = F.lit(0.0)
    width = last - first
    for node in (-0.5773502691896257, 0.5773502691896257):
        mean = mean + 0.5 * cos_zenith(lat, lon, day, (first + last) / 2 + node * width / 2)
    return mean


INDICES = {
    "relative_humidity": (relative_humidity, ("t", "td")),
    "humidex": (humidex, ("t", "td")),
    "heat_index": (heat_index, ("t", "td")),
    "wind_chill": (wind_chill, ("t", "ws")),
    "apparent_temperature": (apparent_temperature, ("t", "ws", "rh")),
    "normal_effective_temperature": (normal_effective_temperature, ("t", "ws", "rh")),
    "wet_bulb": (wet_bulb, ("t", "rh")),
    "globe_temperature": (globe_temperature, ("t", "mrt", "ws")),
    "wet_bulb_globe": (wet_bulb_globe, ("t", "mrt", "ws", "td")),
    "mean_radiant_temperature": (mean_radiant_temperature, ("ssrd", "ssr", "dsrp", "strd", "fdir", "strr", "cossza")),
}


def indices(df, names: list[str]):
    """``df`` with the requested indices only; rh, ws and dsrp are derived where absent."""
    have = set(df.columns)
    if "ws" not in have and {"u10", "v10"} <= have:
        df = df.withColumn("ws", wind_speed(F.col("u10"), F.col("v10")))
    if "rh" not in have and {"t", "td"} <= have:
        df = df.withColumn("rh", relative_humidity(F.col("t"), F.col("td")))
    if "dsrp" not in have and {"fdir", "cossza"} <= have:
        df = df.withColumn("dsrp", direct_radiation(F.col("fdir"), F.col("cossza")))
    for name in names:
        function, inputs = INDICES[name]
        missing = [i for i in inputs if i not in df.columns]
        if missing:
            raise KeyError(f"{name} needs {missing}")
        df = df.withColumn(name, function(*[F.col(i) for i in inputs]))
    return df


#: Instantaneous inputs at the end of an hour range and accumulated ones whose change over it makes a mean flux.
INSTANT, ACCUMULATED = ("t", "td", "u10", "v10"), ("ssrd", "ssr", "strd", "strr", "fdir")


def inputs(fields, windows: list[tuple[int, int]], keys: list[str], grid=None, day: int | None = None, hour: int = 0):
    """(keys, window_id, t, td, u10, v10, mean fluxes in W/m2, cossza) from fields (keys, param, step, value).

    ``windows`` are (first, last) steps in hours. Instantaneous parameters are those of the last step, accumulated ones the
    change from the first to the last by second. With ``grid`` (point_id, lat, lon) and the ``day`` of the year of step 0,
    which begins at ``hour`` UTC, ``cossza`` is the mean cosine of the zenith angle in between. Cells that lack a field are
    left out.
    """
    rows = [(f"{a}-{b}", a, b, float(b - a)) for a, b in windows]
    table = fields.sparkSession.createDataFrame(rows, "window_id string, start int, end int, hours double")
    kept = fields.where(F.col("param").isin(*INSTANT, *ACCUMULATED))
    roles = intervals.roles(kept, table, {p: (p, "") for p in ACCUMULATED}, {}, latest={p: p for p in INSTANT})
    made = intervals.gather(kept, roles, keys, [*INSTANT, *ACCUMULATED])
    made = made.join(F.broadcast(table), "window_id")
    out = made.select(*keys, "window_id", "start", "end", *INSTANT, *[(F.col(p) / (F.col("hours") * 3600)).alias(p) for p in ACCUMULATED])
    if grid is None:
        return out.drop("start", "end")
    sun = cos_zenith_integrated(F.col("lat"), F.col("lon"), F.lit(day) + F.floor((F.col("start") + hour) / 24), F.pmod(F.col("start") + hour, F.lit(24)), F.pmod(F.col("start") + hour, F.lit(24)) + F.col("end") - F.col("start"))
    return out.join(grid.select("point_id", "lat", "lon"), "point_id").withColumn("cossza", sun).drop("lat", "lon", "start", "end")
