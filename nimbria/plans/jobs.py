"""Product jobs from a configuration (JSON or, where the library is installed, YAML).

    {"product": "ensms", "source": {"location": "table:/data/fields", "requests": [{"param": "t"}]},
     "preprocessing": [{"operation": "scale", "factor": 0.1}],
     "windows": [{"coords": {"from": 0, "to": 24, "by": 6}, "operation": "mean"}],
     "target": "table:/data/out", "keys": ["param"], "recover": "/data/checkpoints"}

Source fields have number, step, point_id, value and the columns named in ``keys``. The result has the window, ``keys``,
point_id and the product's values. With ``recover`` finished windows are skipped on a restart.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbria.functions import thermal
from nimbria.functions.columns import clip
from nimbria.operators import accumulate as A
from nimbria.operators import cluster as K
from nimbria.operators import cyclones as Y
from nimbria.operators import ensemble as E
from nimbria.operators import extremes as X
from nimbria.operators import grids, spectral
from nimbria.operators import pointrain as R
from nimbria.operators import preprocess as P
from nimbria.operators import spatial as S
from nimbria.plans import metadata as M
from nimbria.plans import windows as W
from nimbria.plans.requests import deep_update, unique_requests
from nimbria.sources import readers, sinks

PRODUCTS: dict[str, Callable[[SparkSession, dict, DataFrame, list[str]], DataFrame]] = {}


def product(name: str):
    def register(function):
        PRODUCTS[name] = function
        return function

    return register


def load(path: str, changes: dict | None = None) -> dict:
    """A configuration file with changes merged into it."""
    with open(path) as f:
        text = f.read()
    try:
        config = json.loads(text)
    except ValueError:
        import yaml

        config = yaml.safe_load(text)
    return deep_update(config, changes or {})


def windows_of(config: dict) -> list[W.Window]:
    """Windows of a configuration: ``type`` default, named, ranges, monthly or legacy."""
    out: list[W.Window] = []
    for spec in config.get("windows", []):
        s = dict(spec)
        kind, op = s.pop("type", "default"), s.pop("operation", "aggregation")
        if "bins" in s:
            s["bins"] = tuple(s["bins"])
        if "weights" in s:
            s["weights"] = tuple(s["weights"])
        if kind == "default":
            out += W.default([s.pop("coords")], op, **s)
        elif kind == "named":
            out.append(W.Window(s.pop("name"), tuple(s.pop("coords")), op, **s))
        elif kind == "ranges":
            out += W.step_ranges(op=op, **s)
        elif kind == "legacy":
            out += W.legacy({"windows": [s | ({"operation": op} if "operation" in spec else {})]})[0]
        elif kind == "monthly":
            import datetime as dt

            out += W.monthly(dt.date.fromisoformat(s.pop("date")), op=op, **s)
        else:
            raise ValueError(f"unknown window type {kind!r}")
    return W.unique(out)


def source(spark: SparkSession, spec: dict) -> DataFrame:
    return readers.not_empty(readers.open_union(spark, spec["location"], spec.get("requests", [{}])))


def prepared(config: dict, fields: DataFrame, keys: list[str]) -> DataFrame:
    specs = config.get("preprocessing", [])
    if not specs:
        return fields
    by = [*[k for k in keys if k != "param"], "number", "step", "point_id"]
    return P.from_config(specs)(fields, by)


def members(config: dict, fields: DataFrame, keys: list[str], todo: list[W.Window]) -> DataFrame:
    if "total_fields" in config:
        A.check_members(fields, [*keys, "step"], config["total_fields"])
    out = A.accumulate(fields, todo, [*keys, "number", "point_id"])
    limits = config.get("clip", {})
    return out.withColumn("value", clip(F.col("value"), limits.get("low"), limits.get("high"))) if limits else out


@product("accumulate")
@product("monthly-stats")
@product("histogram-windows")
def _accumulate(spark, config, found, by):
    """The windows' values; ``relabel`` ({key, values?, order?}) labels outputs anew where they are not the input's fields."""
    label = config.get("relabel")
    return M.relabelled(found, label["key"], label.get("values"), label.get("order", "number")) if label else found


@product("ensms")
def _ensms(spark, config, found, by):
    return E.mean_std(found, by, config.get("sample", False))


@product("quantiles")
def _quantiles(spark, config, found, by):
    return E.quantiles(found, by, config.get("quantiles", 100))


@product("histogram")
def _histogram(spark, config, found, by):
    return E.histogram(found, by, config["bins"], config.get("mod"), config.get("normalise", True), config.get("scale_out", 1.0))


@product("probabilities")
def _probabilities(spark, config, found, by):
    rows = [(w, t["comparison"], float(t["value"])) for w in {x.window_id for x in windows_of(config)} for t in config["thresholds"]]
    return E.probability(found, spark.createDataFrame(rows, "window_id string, comparison string, threshold double"), by)


def _climate(spark, config) -> DataFrame:
    return source(spark, config["climatology"])


@product("anomaly")
def _anomaly(spark, config, found, by):
    clim = _climate(spark, config)
    on = [c for c in clim.columns if c not in ("mean", "std")]
    return E.anomaly(found, clim, on, config.get("standardised", False))


@product("extreme")
def _extreme(spark, config, found, by):
    q = _climate(spark, config)
    if "window_id" not in q.columns:  # one climatology for all windows
        q = found.select(*by).distinct().join(q, [c for c in by if c in q.columns])
    return X.indices(found, q, by, config.get("quantiles", 101), config.get("eps", -1.0), config.get("control"), tuple(config.get("sot", [])), config.get("cpf", False))


@product("significance")
def _significance(spark, config, found, by):
    clim = A.accumulate(prepared(config, _climate(spark, config), config.get("keys", [])), windows_of(config), [*config.get("keys", []), "number", "point_id"])
    return X.significance(found, clim, by)


@product("regrid")
def _regrid(spark, config, found, by):
    """To a table of ``weights``, or from a Gaussian ``grid`` to the ``points`` of a table (point_id, lat, lon) by ``method``
    ``linear`` or ``nearest``."""
    if "grid" in config:
        way = {"linear": grids.bilinear_weights, "nearest": grids.nearest_weights}[config.get("method", "linear")]
        weights = way(config["grid"], source(spark, config["points"]), config.get("lengths"))
    else:
        weights = source(spark, config["weights"])
    return S.regrid(found, weights, [c for c in by if c != "point_id"] + ["number"], config.get("statistic"))


@product("wind")
def _wind(spark, config, found, by):
    """Mean and deviation over members of the speed of two components (``params``: u and v)."""
    u, v = config.get("params", ["u", "v"])
    by = [b for b in by if b != "param"]
    speed = P.norm("ws")(found.where(F.col("param").isin(u, v)), [*by, "number"])
    return E.mean_std(speed, by, config.get("sample", False))


@product("anomaly-probabilities")
def _anomaly_probabilities(spark, config, found, by):
    clim = _climate(spark, config)
    away = E.anomaly(found, clim, [c for c in clim.columns if c not in ("mean", "std")], config.get("standardised", False))
    return _probabilities(spark, config, away, by)


#: Products that read a whole table rather than windows of fields: name -> (session, configuration, table).
TABLES: dict[str, Callable[[SparkSession, dict, DataFrame], DataFrame]] = {}


def table_product(name: str):
    def register(function):
        TABLES[name] = function
        return function

    return register


@table_product("thermal-indices")
def _thermal(spark, config, df):
    """``indices`` of cells whose columns are their inputs, beside ``keys``."""
    return thermal.indices(df, config["indices"]).select(*config.get("keys", []), *config["indices"])


@table_product("point-rainfall")
def _point_rainfall(spark, config, df):
    """Quantiles (``levels``) and mean of point rainfall by ``keys``: cells meet weather types (``types``) by their
    ``predictors`` and spread by the types' error ratios (``ratios``)."""
    typed = R.weather_types(df, source(spark, config["types"]), config["predictors"], min_rain=config.get("min_rain", 0.04))
    spread = R.calibrate(typed, source(spark, config["ratios"]))
    keys = config["keys"]
    mean = spread.groupBy(*keys).agg(F.avg("grid_scale").alias("grid_scale"))
    return R.point_quantiles(spread, keys, config["levels"]).join(mean, keys)


@table_product("strike-probability")
def _strikes(spark, config, df):
    grid = source(spark, config["grid"])
    chosen = df.where(F.col("number").isin(config["numbers"])) if "numbers" in config else df
    members = config.get("members") or chosen.select("number").distinct().count()
    return S.strike_probability(chosen, grid, config["radius_km"], members, config.get("sub_steps", 4), config.get("min_wind"), config.get("step_range"))


@table_product("spectrum")
def _spectrum(spark, config, df):
    return S.spectrum(df, config.get("keys", []), config.get("kinetic", False), config.get("log", True))


@table_product("spectral-to-grid")
def _to_grid(spark, config, df):
    """Fields on a Gaussian ``grid`` from coefficients (``keys``, n, m, re, im) up to ``truncation``; with ``wind``, u and v from
    vorticity and divergence (param vo and d)."""
    make = spectral.wind_on_grid if config.get("wind") else spectral.synthesis
    return make(df, config.get("keys", []), config["grid"], config["truncation"])


@table_product("grid-to-spectral")
def _to_spectral(spark, config, df):
    return spectral.analysis(df, config.get("keys", []), config["grid"], config["truncation"])


def _hours(config: dict) -> list[tuple[int, int]]:
    """The first and last coordinates of a configuration's windows."""
    return [(min(w.coords), max(w.coords)) for w in windows_of(config)]


@table_product("point-rainfall-fields")
def _point_rainfall_fields(spark, config, df):
    """Point rainfall from fields (``keys``, param, number, step, point_id, value): for each window the quantiles (``levels``)
    over members and error ratios. ``params`` renames the parameters, ``output`` is quantiles, ``cells`` (weather type and
    mean of each member) or ``predictors``."""
    keys = [*config.get("keys", []), "number", "point_id"]
    if config.get("output") == "predictors":
        return R.predictors(df, _hours(config), keys, config.get("params"))
    spread = R.from_fields(df, _hours(config), keys, source(spark, config["types"]), source(spark, config["ratios"]), config.get("params"), config.get("min_rain", 0.04))
    if config.get("output") == "cells":
        return spread.drop("points")
    return R.point_quantiles(spread, [*config.get("keys", []), "window_id", "point_id"], config["levels"])


@table_product("thermal-fields")
def _thermal_fields(spark, config, df):
    """``indices`` for each window: instants of its last step, mean fluxes of its hours, and the sun above ``grid`` if that and
    the ``day`` of the year are given."""
    keys = [*config.get("keys", []), "number", "point_id"]
    grid = source(spark, config["grid"]) if "grid" in config else None
    made = thermal.inputs(df, _hours(config), keys, grid, config.get("day"), config.get("hour", 0))
    return thermal.indices(made, config["indices"]).select(*keys, "window_id", *config["indices"])


@table_product("track-motion")
def _motion(spark, config, df):
    return Y.track_motion(df, config.get("keys", ["number", "id"]))


@table_product("storm-matching")
def _matching(spark, config, df):
    """Observed storms (the source) against ``predicted`` ones, or with ``confusion`` the counts of each step."""
    found = Y.match(df, source(spark, config["predicted"]), config["threshold_km"])
    return Y.confusion(found) if config.get("confusion") else found


@table_product("storm-annotation")
def _annotation(spark, config, df):
    return Y.annotate(df, source(spark, config["cells"]), config["radius"])


@table_product("storm-clusters")
def _storm_clusters(spark, config, df):
    return Y.density_clusters(df, config.get("keys", ["step"]), config["eps"], config["min_weight"])


@table_product("best-track")
def _best_track(spark, config, df):
    return Y.best_track(df, config["agencies"], config.get("missing", -999.0))


@table_product("clusters")
def _clusters(spark, config, df):
    """(number, cluster): the partition of members in the space of the components that explain ``variance`` percent, into the
    number of ``clusters`` (a list to choose from by significance against ``samples`` surrogates) that reaches ``significance``
    percent. If none does, all members are cluster 0. ``seeds`` are random or sectors; ``scaled`` weighs components by their
    deviations. With ``constraints`` (``spread`` as a share of the ensemble's, and what ``choose_constrained`` takes) the
    number is chosen under them, against the variance ratios that so many clusters of one normal cloud would have."""
    made = K.components(K.anomalies(df, config.get("clip")), source(spark, config["weights"]), config.get("components", 10))
    n = K.choose_components(made.var_cum, config.get("variance", 80.0))
    x = made.scaled(n) if config.get("scaled") else made.pc[:, :n]
    sizes, seed, passes = config.get("clusters", [2, 3, 4, 5, 6]), config.get("seed", 1), config.get("passes", 20)
    found = {r.k: r for r in K.partitions(spark, x, sizes, passes, seed, config.get("seeds", "random")).collect()}  # a row a number
    k = sizes[0]
    if len(sizes) > 1:
        sure = K.significance(spark, x, sizes, config.get("samples", 20), seed)
        if "constraints" in config:
            c = dict(config["constraints"])
            least = c.pop("spread", 0.0) * float((x * x).sum(1).mean())
            limits = {s: K.variance_threshold(s, c.get("cumulative", 0.0)) for s in sizes}
            c.pop("cumulative", None)
            k = K.choose_constrained([(s, found[s].within, found[s].ratio, sure[s]) for s in sizes], least, limits, **c)
        else:
            k = K.choose_partition(sure, config.get("significance", 0.0))
    label = found[k].label if k > 1 else [0] * len(made.members)
    return spark.createDataFrame([(int(m), int(c)) for m, c in zip(made.members, label, strict=True)], "number int, cluster int")


@table_product("cluster-centroids")
def _centroids(spark, config, df):
    return K.centroids(df, source(spark, config["labels"]))


@table_product("regime-attribution")
def _attribution(spark, config, df):
    return K.attribute(df, source(spark, config["regimes"]), config["keys"])


def run(spark: SparkSession, config: dict) -> DataFrame:
    """Compute a job, write it if it has a target, and return the result.

    With ``recover`` (a table) and a keyed target, each ``checkpoint_every`` windows are written and noted together; a job
    that was stopped goes on with the rest, and what it writes again replaces what it wrote. Success clears the notes.
    """
    name = config.get("product")
    if name in TABLES:
        out = TABLES[name](spark, config, source(spark, config["source"]))
        if config.get("target"):
            sinks.sink_for(config["target"])(out)
            kept = sinks.read_back(spark, config["target"], out)
            return out if kept is None else kept
        return out
    if name not in PRODUCTS:
        raise ValueError(f"unknown product {name!r}; known: {sorted([*PRODUCTS, *TABLES])}")
    keys = config.get("keys", [])
    todo = windows_of(config)
    recovery = sinks.Recovery(spark, config["recover"], {k: v for k, v in config.items() if k != "recover"}) if config.get("recover") else None
    if recovery:
        todo = A.remaining(todo, {r.window_id for r in recovery.done().collect()})
    if not todo:
        raise ValueError("no window is left to do")
    fields = prepared(config, source(spark, config["source"]), keys)
    by = ["window_id", *keys, "point_id"]
    made = lambda windows: PRODUCTS[name](spark, config, members(config, fields, keys, windows), by)
    if config.get("target"):
        keyed = config["target"].startswith(("table:", "fileset:"))
        write = sinks.sink_for(config["target"], **({"keys": ["window_id"]} if keyed else {}))
        size = config.get("checkpoint_every", len(todo)) if recovery and keyed else len(todo)
        for first in range(0, len(todo), size):
            write(made(todo[first : first + size]))
            if recovery:
                recovery.add([w.window_id for w in todo[first : first + size]])
        if recovery:
            recovery.clean()  # all is done: the next run starts anew
        kept = sinks.read_back(spark, config["target"], made(todo))
        if kept is not None:  # all windows of the job, those of an earlier run that was stopped too
            return kept.where(F.col("window_id").isin([w.window_id for w in windows_of(config)])) if "window_id" in kept.columns else kept
    return made(todo)


def listing(config: dict) -> dict:
    """The requests that a job reads, the windows it makes and its outputs, without running it."""
    requests = config["source"].get("requests", [{}])
    if config.get("product") in TABLES:
        return {"inputs": requests, "windows": [], "outputs": [{"product": config["product"]}]}
    windows = windows_of(config)
    keyed = [{k: r[k] for k in config.get("keys", []) if k in r} for r in requests]
    outputs = [{"product": config.get("product"), "window_id": w.window_id, **k} for k in unique_requests(keyed) for w in windows]
    return {"inputs": [{**r, "step": W.needed_coords(windows)} for r in requests], "windows": [w.window_id for w in windows], "outputs": outputs}
