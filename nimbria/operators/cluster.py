"""Ensemble clustering: weighted principal components, K-means partitions, their significance and regime attribution.

Only what is small leaves the executors: the member-by-member Gram matrix (members squared) and the leading components
(members times components). Anything over grid points stays a DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MOST_MEMBERS = 2000
MOST_CODES, CODES = 1 << 24, 1 << 14


def anomalies(members: DataFrame, clip: float | None = None) -> DataFrame:
    """(number, cell..., value) minus the ensemble mean of each cell, clipped to +-clip. Cells are (step, point_id)."""
    mean = F.avg("value").over(Window.partitionBy("step", "point_id"))
    a = F.col("value") - mean
    if clip is not None:
        a = F.greatest(F.least(a, F.lit(float(clip))), F.lit(-float(clip)))
    return members.withColumn("value", a)


def mean_spread(std: DataFrame, weights: DataFrame) -> float:
    """Weighted sum of squared deviations over points."""
    return float(std.join(weights, "point_id").agg(F.sum(F.col("value") * F.col("value") * F.col("weight"))).first()[0] or 0.0)


def gram(anomaly: DataFrame, weights: DataFrame) -> DataFrame:
    """(a, b, value): weighted inner products of members, a <= b, over the cells that both have. Each cell becomes one array of
    its members' values; a batch of cells is one matrix product, and the batches' triangles are summed."""
    cells = anomaly.join(weights, "point_id").groupBy("step", "point_id").agg(F.collect_list(F.struct("number", F.col("value").cast("double").alias("value"))).alias("m"), F.first("weight").cast("double").alias("w"))

    def run(batches):
        for batch in batches:
            held = batch.column(1)
            values = held.flatten()
            cell = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
            members, at = np.unique(values.field("number").to_numpy(), return_inverse=True)
            x, there = np.zeros((len(held), len(members))), np.zeros((len(held), len(members)))
            x[cell, at], there[cell, at] = values.field("value").to_numpy(zero_copy_only=False), 1
            product = (x * batch.column(0).to_numpy(zero_copy_only=False)[:, None]).T @ x
            a, b = np.nonzero(np.triu(there.T @ there))
            yield pa.RecordBatch.from_arrays([pa.array(members[a], pa.int64()), pa.array(members[b], pa.int64()), pa.array(product[a, b])], names=["a", "b", "value"])

    kind = anomaly.schema["number"].dataType.simpleString()
    triangles = cells.select("w", "m").mapInArrow(run, "a bigint, b bigint, value double")
    return triangles.groupBy(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b")).agg(F.sum("value").alias("value"))


@dataclass
class Components:
    """Eigenvalues, principal components (member, component) scaled by sqrt(n), and derived variances."""

    members: list[int]
    values: np.ndarray
    pc: np.ndarray

    @property
    def sd(self) -> np.ndarray:
        """Standard deviation of each component's pattern."""
        return np.sqrt(self.values / len(self.members))

    def scaled(self, n: int) -> np.ndarray:
        """The first ``n`` components of the members by their deviations, shifted to zero mean: distances are those of fields."""
        x = self.pc[:, :n] * self.sd[:n]
        return x - x.mean(0)

    @property
    def var_pct(self) -> np.ndarray:
        return 100 * self.values / max(self.total, 1e-300)

    total: float = 0.0

    @property
    def var_cum(self) -> np.ndarray:
        return np.cumsum(self.var_pct)


def components(anomaly: DataFrame, weights: DataFrame, n_components: int) -> Components:
    """Leading components of the member covariance (divided by the number of steps); members are at most MOST_MEMBERS."""
    if anomaly.select("number").distinct().limit(MOST_MEMBERS + 1).count() > MOST_MEMBERS:
        raise ValueError(f"more than {MOST_MEMBERS} members")
    steps = anomaly.select("step").distinct().count()
    rows = gram(anomaly, weights).collect()  # members squared / 2
    members = sorted({r.a for r in rows})
    at = {m: i for i, m in enumerate(members)}
    c = np.zeros((len(members), len(members)))
    for r in rows:
        c[at[r.a], at[r.b]] = c[at[r.b], at[r.a]] = r.value / steps
    values, vectors = np.linalg.eigh(c)
    order = np.argsort(values)[::-1][:n_components]
    return Components(members, np.clip(values[order], 0, None), vectors[:, order] * np.sqrt(len(members)), float(np.trace(c)))


def eofs(anomaly: DataFrame, made: Components) -> DataFrame:
    """(component, step, point_id, value): projection of anomalies on the components, divided by the members."""
    spark = anomaly.sparkSession
    rows = [(int(m), c, float(made.pc[i, c])) for i, m in enumerate(made.members) for c in range(made.pc.shape[1])]
    pc = spark.createDataFrame(rows, "number int, component int, pc double")
    joined = anomaly.join(F.broadcast(pc), "number")  # members x components rows
    return joined.groupBy("component", "step", "point_id").agg((F.sum(F.col("value") * F.col("pc")) / len(made.members)).alias("value"))


def choose_components(var_cum: np.ndarray, threshold: float) -> int:
    """Number of components whose cumulative variance first reaches the threshold (percent)."""
    enough = np.flatnonzero(np.asarray(var_cum) >= threshold)
    if not len(enough):
        raise ValueError(f"no number of components explains {threshold} %")
    return int(enough[0]) + 1


def settle(x: np.ndarray, centres: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float, float]:
    """The K-means partition that given centres lead to: labels, centroids, variance within and between clusters."""
    centres, label = centres.astype(float), None
    for _ in range(rounds):
        new = ((x[:, None, :] - centres[None]) ** 2).sum(-1).argmin(1)
        if label is not None and (new == label).all():
            break
        label = new
        for c in range(len(centres)):
            if (label == c).any():
                centres[c] = x[label == c].mean(0)
    return label, centres, *_variances(x, centres[label])


def _variances(x: np.ndarray, centre: np.ndarray) -> tuple[float, float]:
    """Variance within and between clusters, given each member's centroid."""
    return float(((x - centre) ** 2).sum() / len(x)), float(((centre - x.mean(0)) ** 2).sum() / len(x))


def random_seeds(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    return x[rng.choice(len(x), k, replace=False)]


def sector_seeds(x: np.ndarray, k: int, rng: np.random.Generator, reach: float = 1.5, apart: float = 0.5, tries: int = 10) -> np.ndarray:
    """Seeds near the middle, apart from each other and in different sectors of the first two components.

    Distances are in units of the root of the total variance. The first seed is a member within ``reach`` (the innermost if
    there is none); each further one is the best of ``tries`` members, scored by one point for being within ``reach`` and up
    to one each for the shares of earlier seeds that are more than ``apart`` away and more than pi / k to the side.
    """
    square = (x * x).sum(1)
    unit = square.mean()
    near = np.flatnonzero(square <= reach**2 * unit)
    chosen = [int(rng.choice(near)) if len(near) else int(square.argmin())]
    flat = x[:, :2] if x.shape[1] > 1 else np.c_[x, np.zeros(len(x))]
    length = np.sqrt((flat * flat).sum(1))
    while len(chosen) < k:
        free = np.setdiff1d(np.arange(len(x)), chosen)
        drawn = free[rng.integers(len(free), size=tries)]
        far = ((x[drawn][:, None] - x[chosen][None]) ** 2).sum(-1) > apart**2 * unit
        aside = flat[drawn] @ flat[chosen].T < np.cos(np.pi / k) * length[drawn][:, None] * length[chosen][None]
        chosen.append(int(drawn[((square[drawn] <= reach**2 * unit) + far.mean(1) + aside.mean(1)).argmax()]))
    return x[chosen]


SEEDS = {"random": random_seeds, "sectors": sector_seeds}


def lloyd(x: np.ndarray, k: int, seed: int, passes: int = 20, rounds: int = 100, seeds: str = "random") -> tuple[np.ndarray, np.ndarray, float]:
    """Best of ``passes`` K-means partitions: labels, centroids, and the ratio of variance between to within clusters."""
    rng = np.random.default_rng(seed)
    best = None
    for _ in range(passes):
        label, centres, within, between = settle(x, SEEDS[seeds](x, k, rng), rounds)
        ratio = between / within if within else float("inf")
        if best is None or ratio > best[2]:
            best = label, centres, ratio
    return best


def best_coded(x: np.ndarray, k: int, codes: np.ndarray) -> np.ndarray | None:
    """The labels of the partition of least variance within clusters among ``codes``. A code's digits to the base k are the
    labels of the members but the first; it stands for a partition if each of k labels occurs and they first occur in order."""
    label = np.zeros((len(codes), len(x)), np.int64)
    label[:, 1:] = codes[:, None] // k ** np.arange(len(x) - 1) % k
    highest = np.maximum.accumulate(label, 1)
    label = label[(highest[:, -1] == k - 1) & (label[:, 1:] <= highest[:, :-1] + 1).all(1)]
    if not len(label):
        return None
    within = np.full(len(label), (x * x).sum())
    for c in range(k):
        mine = (label == c).astype(float)
        within -= ((mine @ x) ** 2).sum(1) / mine.sum(1)
    return label[within.argmin()]


def partitions(spark: SparkSession, x: np.ndarray, ks: list[int], passes: int = 100, seed: int = 1, seeds: str = "sectors", every: bool = True) -> DataFrame:
    """(k, within, between, ratio, label array<int> numbered by size): the best partition for each number of clusters.

    With ``every``, all partitions are tried if at most MOST_CODES labellings make them up, a block of codes a row, as no
    number of passes is sure to meet the best. Else it is the best of ``passes`` K-means partitions, a pass a row. Spark deals
    the rows to tasks; what travels is the small matrix of members and components. Passes are seeded by their number, so the
    result doesn't depend on where they ran."""
    few = [k for k in ks if every and k <= len(x) and k ** (len(x) - 1) <= MOST_CODES]

    def run(batches):
        for batch in batches:
            rows = []
            for k, p in zip(batch["k"].astype(int), batch["pass"].astype(int), strict=True):
                if k in few:
                    label = best_coded(x, k, np.arange(p * CODES, min((p + 1) * CODES, k ** (len(x) - 1))))
                    if label is None:
                        continue
                    within, between = _variances(x, np.array([x[label == c].mean(0) for c in range(k)])[label])
                else:
                    label, _, within, between = settle(x, SEEDS[seeds](x, k, np.random.default_rng([seed, k, p])))
                rows.append((k, p, within, between, between / within if within else float("inf"), by_size(label, k).tolist()))
            yield pd.DataFrame(rows, columns=["k", "pass", "within", "between", "ratio", "label"])

    turns = {k: -(-(k ** (len(x) - 1)) // CODES) if k in few else passes for k in ks}
    asked = spark.range(max(turns.values())).withColumnRenamed("id", "pass").withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
    asked = asked.where(reduce(or_, [(F.col("k") == k) & (F.col("pass") < n) for k, n in turns.items()]))
    tried = asked.repartition(max(1, min(sum(turns.values()) // 8, 200))).mapInPandas(run, "k int, pass long, within double, between double, ratio double, label array<int>")
    best = F.max(F.struct("ratio", (-F.col("pass")).alias("pass"), "within", "between", "label")).alias("b")
    return tried.groupBy("k").agg(best).select("k", "b.within", "b.between", "b.ratio", "b.label")


def by_size(label: np.ndarray, k: int) -> np.ndarray:
    """Labels renumbered by descending size; of equals the later cluster comes first."""
    sizes = np.bincount(label, minlength=k)
    order = np.argsort(sizes, kind="stable")[::-1]
    rank = np.empty(k, int)
    rank[order] = np.arange(k)
    return rank[label]


def autocorrelation(x: np.ndarray) -> np.ndarray:
    """Lag-one autocorrelation of each column."""
    d = x - x.mean(0)
    scale = (d * d).sum(0)
    return np.where(scale > 0, (d[1:] * d[:-1]).sum(0) / np.where(scale > 0, scale, 1), 0)


def surrogate_ratios(spark: SparkSession, x: np.ndarray, ks: list[int], samples: int, seed: int = 1, passes: int = 20) -> DataFrame:
    """(sample, k, ratio): the best partition of red-noise surrogates with the columns' deviations and autocorrelations.
    One task a sample; what travels is the small matrix of components."""
    r, sd, shape = autocorrelation(x), x.std(0), x.shape

    def run(batches):
        for batch in batches:
            rows = []
            for s in batch["id"]:
                rng = np.random.default_rng(seed + int(s))
                noise = np.empty(shape)
                noise[0] = rng.standard_normal(shape[1])
                for i in range(1, shape[0]):
                    noise[i] = r * noise[i - 1] + np.sqrt(np.clip(1 - r * r, 0, None)) * rng.standard_normal(shape[1])
                noise = noise * sd
                rows += [(int(s), k, lloyd(noise, k, seed + int(s), passes)[2]) for k in ks]
            yield pd.DataFrame(rows, columns=["sample", "k", "ratio"])

    return spark.range(samples).repartition(max(1, min(samples, 200))).mapInPandas(run, "sample long, k int, ratio double")


def significance(spark: SparkSession, x: np.ndarray, ks: list[int], samples: int, seed: int = 1, passes: int = 20) -> dict[int, float]:
    """For each number of clusters the percentage of surrogates whose ratio is below that of the data, both by passes."""
    table = partitions(spark, x, ks, passes, seed, "random", every=False).select("k", F.col("ratio").alias("own"))
    below = surrogate_ratios(spark, x, ks, samples, seed, passes).join(F.broadcast(table), "k").groupBy("k").agg(F.avg(F.when(F.col("ratio") < F.col("own"), 100.0).otherwise(0.0)).alias("p"))
    return {r.k: r.p for r in below.collect()}


def variance_threshold(k: int, cumulative: float) -> float:
    return 4 * (k - 1) / k**2 * cumulative


def choose_partition(significances: dict[int, float], least: float) -> int:
    """The partition of greatest significance, smaller ones first among equals; 1 if none reaches ``least``."""
    if not significances:
        return 1
    k = min(significances, key=lambda k: (-significances[k], k))
    return k if significances[k] >= least else 1


def choose_constrained(found: list[tuple[int, float, float, float]], spread: float, thresholds: dict[int, float], max_sig: float = 100.0, med_sig: float = 100.0, min_sig: float = 100.0, tolerance: float = 0.0) -> int:
    """The number of clusters from (k, variance within, variance ratio, significance in percent), 1 if none will do.

    Those count whose clusters are at least as wide as ``spread`` and whose ratio reaches their threshold. Of them the first
    that reaches ``max_sig`` is taken, else the most significant. If that is the largest number asked for, the smallest that
    reaches ``med_sig`` is preferred; if it stays the largest and clears ``min_sig`` by the tolerance, the smallest that is
    less significant by no more than the tolerance.
    """
    largest = max((k for k, *_ in found), default=1)
    good = {k: sig for k, within, ratio, sig in sorted(found) if within >= spread and ratio >= thresholds.get(k, 0.0) and sig > 0}
    if not good:
        return 1
    best = next((k for k, sig in good.items() if sig >= max_sig), max(good, key=lambda k: (good[k], -k)))
    smaller = {k: sig for k, sig in good.items() if k < largest}
    if best == largest:
        best = next((k for k, sig in smaller.items() if sig >= med_sig), best)
    if best == largest and good[best] >= min_sig + tolerance:
        best = next((k for k, sig in smaller.items() if sig >= good[largest] - tolerance), best)
    return best


def centroids(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(cluster, step, point_id, value): mean field of each cluster; ``labels`` (number, cluster) has a row a member."""
    return members.join(labels, "number").groupBy("cluster", "step", "point_id").agg(F.avg("value").alias("value"))


def representatives(pcs: DataFrame, labels: DataFrame) -> DataFrame:
    """(cluster, number, rms): the member closest to its cluster's mean in component space; ``pcs`` (number, component, pc)."""
    joined = pcs.join(labels, "number")
    mean = F.avg("pc").over(Window.partitionBy("cluster", "component"))
    away = joined.withColumn("d", (F.col("pc") - mean) ** 2).groupBy("cluster", "number").agg(F.sqrt(F.avg("d")).alias("rms"))
    return away.groupBy("cluster").agg(F.min(F.struct("rms", "number")).alias("b")).select("cluster", "b.number", "b.rms")


def undivided(pcs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Where no partition will do: labels (keys, number, cluster) of one cluster with all members, and its representative
    (keys, cluster, number), the member of the smallest norm in component space; ties go to the smaller number."""
    square = pcs.groupBy(*keys, "number").agg(F.sum(F.col("pc") * F.col("pc")).alias("square"), F.lit(0).alias("cluster"))
    chosen = square.groupBy(*keys, "cluster").agg(F.min(F.struct("square", "number")).alias("b")).select(*keys, "cluster", "b.number")
    return square.select(*keys, "number", "cluster"), chosen


def records(labels: DataFrame, chosen: DataFrame, steps: list[tuple[int, int | None]], keys: list[str], control: int = 0, deterministic: DataFrame | None = None, regime_of: DataFrame | None = None, at_least: int = 0) -> DataFrame:
    """The headers of a clustering's output, a row for each cluster and step: keys, ``n_clusters``, ``control_cluster``,
    ``cluster`` (from 1), ``n_members``, ``members`` (sorted array), ``deterministic_cluster``, ``representative``, ``first_step``,
    ``last_step`` (null: an instant) and ``regime``.

    ``labels`` (keys, number, cluster from 0) has a row a member, ``chosen`` (keys, cluster, number) one a cluster, ``steps``
    are pairs of first and last step or None, ``deterministic`` (keys, cluster) where the deterministic forecast
    falls, ``regime_of`` (keys, cluster, first_step, regime) the regimes; what is not known is 0. Where there are fewer than
    ``at_least`` clusters, the numbers up to it get placeholders without members and with zeros. A clustering is told apart
    by ``keys``; its members are an ensemble's, so that one row holds them. Fields are in ``centroids`` and meet by cluster.
    """
    one = labels.groupBy(*keys).agg((F.max("cluster") + 1).cast("int").alias("n_clusters"), (F.max(F.when(F.col("number") == control, F.col("cluster"))) + 1).alias("control_cluster"))
    groups = labels.groupBy(*keys, "cluster").agg(F.count("*").cast("int").alias("n_members"), F.sort_array(F.collect_list("number")).alias("members"))
    chosen = chosen.select(*keys, "cluster", F.col("number").alias("representative"))
    places = one.withColumn("cluster", F.explode(F.sequence(F.lit(0), F.greatest("n_clusters", F.lit(at_least)) - 1)))
    rows = places.join(groups, [*keys, "cluster"], "left").join(chosen, [*keys, "cluster"], "left")
    zero, found = F.lit(0).cast("int"), F.col("n_members").isNotNull()
    own = rows.select(*keys).distinct().withColumn("own", zero) if deterministic is None else deterministic.select(*keys, (F.col("cluster") + 1).alias("own"))
    rows = rows.join(own, keys, "left").withColumnRenamed("own", "deterministic_cluster")
    spans = F.array(*[F.struct(F.lit(a).cast("int").alias("first_step"), F.lit(b).cast("int").alias("last_step")) for a, b in steps])
    rows = rows.withColumn("__step", F.explode(spans)).select("*", "__step.*").drop("__step")
    rows = rows.withColumn("regime", zero) if regime_of is None else rows.join(regime_of.select(*keys, "cluster", "first_step", "regime"), [*keys, "cluster", "first_step"], "left")
    known = lambda c: F.when(found, F.coalesce(F.col(c), zero)).otherwise(zero).cast("int").alias(c)
    members = F.coalesce("members", F.array().cast(groups.schema["members"].dataType))
    return rows.select(*keys, "n_clusters", known("control_cluster"), (F.col("cluster") + 1).cast("int").alias("cluster"), known("n_members"), members.alias("members"), known("deterministic_cluster"), known("representative"), "first_step", "last_step", known("regime"))


def project(fields: DataFrame, eof: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, component, pc): weighted projection of fields on EOFs, divided by the EOF's weighted norm."""
    e = eof.join(weights, "point_id")
    norm = e.groupBy("component").agg(F.sum(F.col("value") * F.col("value") * F.col("weight")).alias("norm"))
    dots = fields.join(e.select("component", "point_id", F.col("value").alias("e"), "weight"), "point_id").groupBy(*keys, "component").agg(F.sum(F.col("value") * F.col("e") * F.col("weight")).alias("dot"))
    return dots.join(norm, "component").select(*keys, "component", F.when(F.col("norm") > 0, F.col("dot") / F.col("norm")).otherwise(0.0).alias("pc"))


def regimes(pcs: DataFrame, regime_of: DataFrame, months: list[int]) -> DataFrame:
    """(regime, component, pc): mean components of climatological dates (date, component, pc) of the given months."""
    joined = pcs.join(regime_of, "date").where(F.month("date").isin(months))
    return joined.groupBy("regime", "component").agg(F.avg("pc").alias("pc"))


def attribute(pcs: DataFrame, regime_pcs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, regime, rms): the nearest regime by root mean square distance over components. Regimes are few: the join is
    on the component, and each row meets every regime once."""
    d = pcs.join(regime_pcs.withColumnRenamed("pc", "rpc"), "component").groupBy(*keys, "regime").agg(F.sqrt(F.avg((F.col("pc") - F.col("rpc")) ** 2)).alias("rms"))
    return d.groupBy(*keys).agg(F.min(F.struct("rms", "regime")).alias("b")).select(*keys, "b.regime", "b.rms")


def season(month_range: str) -> list[int]:
    """Months of a season such as ``10-4`` or ``5-9``."""
    first, last = (int(m) for m in month_range.split("-"))
    return list(range(first, last + 1)) if first <= last else [*range(first, 13), *range(1, last + 1)]


def season_name(months: list[int]) -> str:
    return "".join("JFMAMJJASOND"[m - 1] for m in months)


def day_of_season(day, months: list[int]):
    """Day number from 1 within the season as a Column; 29 February counts as the 28th."""
    leap = (F.month(day) == 2) & (F.dayofmonth(day) == 29)
    shown = F.when(leap, F.date_sub(day, 1)).otherwise(day)
    lengths = {m: d for m, d in zip(range(1, 13), (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31), strict=True)}
    before, out = 0, F.lit(None).cast("int")
    for m in months:
        out = F.when(F.month(shown) == m, F.dayofmonth(shown) + before).otherwise(out)
        before += lengths[m]
    return out


def climatology_on(fields, climatology, months: list[int], day: str = "date"):
    """``fields`` with ``clim``: the climatological value of their day of season (``climatology``: dos, point_id, value)."""
    clim = climatology.select("dos", "point_id", F.col("value").alias("clim"))
    return fields.withColumn("dos", day_of_season(F.col(day), months)).join(clim, ["dos", "point_id"])
