"""Quality rules: base statistics and robust multivariate outliers per language and source.

Each text becomes a vector of transformed statistics; per (language, source) group a minimum covariance determinant
estimate is found by concentration steps from two deterministic starts (medians and scaled quartile ranges; mean and
covariance), of which the one with the smaller determinant stays, and
reweighted: it is made consistent for normal data by the share it keeps, then centre and covariance are taken anew from
all documents within its 0.975 point of chi-square. Documents far from that centre are rejected.

Scale: texts are read once; after that only short vectors move. A concentration step is two grouped aggregates (an
approximate percentile sketch of distances, then moments), both combined map-side, so a source with a third of all
rows costs no more than its share; all documents count. Groups travel as one row each and are joined by key.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbria.llm.common import code_points, cut, small_batches, texts

SYMBOLS = b"#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
VECTOR = ["x_words", "x_length", "x_symbols", "x_lines", "x_repeats"]
#: Share of a group that a concentration step keeps, steps, least group.
SUPPORT, STEPS, LEAST_GROUP = 0.75, 4, 50
#: Added to the variances of VECTOR, so that a statistic that hardly varies in a group does not reject by itself: a line or two
#: that a sound text repeats stay within the cut-off, repeats of over a fifth of the words do not.
FLOORS = (0.05, 0.05, 0.05, 0.15, 0.15)


def _beyond(x: float, df: int) -> float:
    """The share of chi-square with an odd ``df`` beyond ``x``."""
    term = total = 1.0
    for j in range(3, df, 2):
        term *= x / j
        total += term
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * total


def _point(beyond: float, df: int) -> float:
    """Where chi-square with an odd ``df`` has the share ``beyond`` above it."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _beyond(middle, df) > beyond else (low, middle)
    return high


def _consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal data is multiplied by to be that of all of it."""
    n = len(VECTOR)
    return share / (1 - _beyond(_point(1 - share, n), n + 2)) if share < 1 else 1.0


#: The reweighting step takes documents within this share of chi-square; the square of the rejecting distance is the 1 - 1e-12
#: point of chi-square, about 65 for five statistics.
INNER, CUTOFF = 0.975, _point(1e-12, len(VECTOR))


def text_stats(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one UTF-8 text (null: none)."""
    text = text or b""
    words = text.split()
    chars = code_points(b"".join(words))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, dup = set(), 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                dup += 1
            elif line.strip():
                seen.add(line)
    repeated, covered = 0, 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return len(words), chars, symbols, dup, repeated


def stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """id (a column of any type), keys and the five statistics (long) of every row; one pass over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_stats(t) for t in texts(batch.column(batch.num_columns - 1))]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *STATS])

    picked = docs.select(id_col, *keys, F.col(text_col).alias("__text"))
    return small_batches(picked).mapInArrow(run, T.StructType([*picked.schema.fields[:-1], *[T.StructField(s, T.LongType()) for s in STATS]]))


def vector() -> dict[str, Column]:
    """The transformed statistics: logarithms of counts and of shares."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c: F.log1p(F.lit(100.0) * F.col(c) / words)
    return {
        "x_words": F.log1p(F.col("n_words").cast("double")),
        "x_length": F.log1p(F.col("word_chars") / words),
        "x_symbols": share("n_symbols"),
        "x_lines": F.log1p(F.col("n_dup_lines").cast("double")),
        "x_repeats": share("n_repeat_words"),
    }


def _distance(inverse: str = "inverse", centre: str = "centre") -> Column:
    """Squared Mahalanobis distance from array columns (inverse flattened by rows)."""
    n, away = len(VECTOR), [F.col(v) - F.get(centre, F.lit(i)) for i, v in enumerate(VECTOR)]
    return sum((away[i] * away[j] * F.get(inverse, F.lit(n * i + j)) for i in range(n) for j in range(n)), F.lit(0.0))


def _moments() -> list[Column]:
    n = len(VECTOR)
    pairs = [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"p{i}{j}") for i in range(n) for j in range(i, n)]
    return [F.count("*").alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(VECTOR)], *pairs]


def _shape(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, inverse covariance and its log determinant of each group from its moments and the share of it they cover."""
    n = len(VECTOR)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            centre = rows[[f"s{i}" for i in range(n)]].to_numpy(float) / rows[["n"]].to_numpy(float)
            out = rows[keys].copy()
            inverse = []
            for at, mean in zip(rows.itertuples(index=False), centre, strict=True):
                cov = np.array([[getattr(at, f"p{min(i, j)}{max(i, j)}") for j in range(n)] for i in range(n)]) / at.n - np.outer(mean, mean)
                inverse.append(np.linalg.inv(cov * _consistency(at.share) + np.diag(FLOORS)).ravel().tolist())
            out["centre"], out["inverse"] = [c.tolist() for c in centre], inverse
            out["precision"] = [np.linalg.slogdet(np.reshape(x, (n, n)))[1] for x in inverse]
            yield out

    fields = ", ".join(f"`{k}` {moments.schema[k].dataType.simpleString()}" for k in keys)
    return moments.mapInPandas(run, f"{fields}, centre array<double>, inverse array<double>, precision double")


def estimate(vectors: DataFrame, keys: tuple[str, ...] = ("lang", "source"), support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """(keys, centre, inverse): the reweighted minimum covariance determinant estimate of each group of ``vectors``.

    Both starts are groups of the same aggregates, so a step is one pass over the vectors for each of its two sums."""
    keys, n = list(keys), len(VECTOR)
    both = [*keys, "__start"]
    few = [F.percentile_approx(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias(f"q{i}") for i, v in enumerate(VECTOR)]
    start = cut(vectors.groupBy(*keys).agg(*few, *_moments(), F.lit(1.0).alias("share")))
    diagonal = [F.lit(0.0) if i != j else 1 / (F.pow((F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349, 2) + FLOORS[i]) for i in range(n) for j in range(n)]
    robust = start.select(*keys, F.lit(0).alias("__start"), F.array(*[F.get(f"q{i}", F.lit(1)) for i in range(n)]).alias("centre"), F.array(*diagonal).alias("inverse"), F.lit(0.0).alias("precision"))
    shape = robust.union(_shape(start.withColumn("__start", F.lit(1)), both))
    for _ in range(steps):
        far = _with(vectors, cut(shape), keys).withColumn("d", _distance())
        bound = far.groupBy(*both).agg(F.percentile_approx("d", F.lit(support), F.lit(1000)).alias("bound"), F.count("*").alias("all"))
        kept = _with(far.drop("centre", "inverse"), cut(bound), both).where(F.col("d") <= F.col("bound"))
        shape = _shape(kept.groupBy(*both).agg(*_moments(), (F.count("*") / F.max("all")).alias("share")), both)
    best = cut(shape).groupBy(*keys).agg(F.max_by(F.struct("centre", "inverse"), F.struct("precision", -F.col("__start"))).alias("b")).select(*keys, "b.*")
    near = _with(vectors, cut(best), keys).where(_distance() <= _point(1 - INNER, n))
    return cut(_shape(near.groupBy(*keys).agg(*_moments(), F.lit(INNER).alias("share")), keys).drop("precision"))


def _with(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group's columns; null keys match. Groups are broadcast only after counting them."""
    renamed = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    few = groups.limit(10_001).count() <= 10_000
    return rows.join(F.broadcast(renamed) if few else renamed, on).drop(*[f"__{k}" for k in keys])


def _shapes(sound: DataFrame, keys: tuple[str, ...], least_group: int) -> DataFrame:
    """(keys, centre, inverse) of every group of ``sound``; small groups have the estimate of their first large enough pool.

    Pools share the first keys, from all of them down to none; only pools that some group needs are estimated. In a pool's
    key the rest is null, and ``__level``, the number of its keys, tells it from groups with null keys.
    """
    groups = cut(sound.groupBy(*keys).agg(F.count("*").alias("__n")).withColumn("__level", F.lit(0)))
    for level in range(1, len(keys) + 1):
        pools = groups.groupBy(*keys[:level]).agg(F.sum("__n").alias("__pool"))
        groups = cut(_with(groups, cut(pools), list(keys[:level])).withColumn("__level", F.when(F.col("__pool") >= least_group, level).otherwise(F.col("__level"))).drop("__pool"))

    def pool(rows: DataFrame, level: int) -> DataFrame:
        return rows.withColumns({"__level": F.lit(level)} | {k: F.lit(None).cast(rows.schema[k].dataType) for k in keys[level:]})

    needed, rows = [r[0] for r in groups.select("__level").distinct().collect()], sound.select(*keys, *VECTOR)
    if not needed:
        return groups.select(*keys, F.array(F.lit(0.0)).alias("centre"), F.array(F.lit(0.0)).alias("inverse"))
    learn = []
    for level in needed:
        used = groups.where(F.col("__level") == level).select(*keys[:level]).distinct()
        learn.append(pool(_with(rows, cut(used), list(keys[:level])) if level else rows, level))
    shape = estimate(cut(reduce(DataFrame.unionByName, learn)), ("__level", *keys))
    made = []
    for level in needed:
        own = shape.where(F.col("__level") == level).select(*keys[:level], "centre", "inverse")
        mine = groups.where(F.col("__level") == level).select(*keys)
        if level:
            made.append(_with(mine, own, list(keys[:level])).select(*keys, "centre", "inverse"))
        else:  # the whole table's estimate: one row of 30 numbers
            whole = own.first()
            made.append(mine.select(*keys, *[F.array(*[F.lit(float(x)) for x in whole[c]]).alias(c) for c in ("centre", "inverse")]))
    return cut(reduce(DataFrame.unionByName, made))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, ...] = ("lang", "source"), cutoff: float = CUTOFF, least_group: int = LEAST_GROUP) -> DataFrame:
    """One row per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    base_failed: under 50 words, or more than half of them in repeated 3-word windows. The outlier rule learns from
    documents that pass the base rules and rejects on the far side only of what marks bad text: a document beyond
    ``cutoff`` (squared distance) whose symbols, repeats, repeated lines or word length lie outside its group's centre; a
    text that is merely long or short stays. Null keys are groups of their own. A group of fewer than ``least_group`` such
    documents is judged by the estimate of all documents with its leading keys (by default its language), and where those
    are fewer too by that of the whole table, whatever its size. Null and empty texts have no words and fail. Rows that
    repeat an id each return a row. An empty table gives an empty result.
    """
    return _judged(docs, id_col, text_col, keys, cutoff, least_group).select(id_col, *STATS, "base_failed", "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str, keys: tuple[str, ...], cutoff: float = CUTOFF, least_group: int = LEAST_GROUP) -> DataFrame:
    """``judge`` with the keys."""
    base = stats(docs, id_col, text_col, keys)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    base = cut(base.withColumn("base_failed", failed).withColumns(vector()))
    sound = base.where(~F.col("base_failed"))
    shape = _shapes(sound, keys, least_group)
    renamed = shape.select(*[F.col(k).alias(f"__{k}") for k in keys], "centre", "inverse")
    few = shape.limit(10_001).count() <= 10_000
    joined = base.join(F.broadcast(renamed) if few else renamed, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left")
    worse = sum((F.when(F.col(v) > F.get("centre", F.lit(i)), 1).otherwise(0) for i, v in enumerate(VECTOR) if v in ("x_symbols", "x_lines", "x_repeats")), F.lit(0))
    strange = (_distance() > cutoff) & ((worse > 0) | (F.abs(F.col("x_length") - F.get("centre", F.lit(1))) > 0.5))
    kept = ~F.col("base_failed") & ~F.coalesce(strange, F.lit(False))
    return joined.select(id_col, *keys, *STATS, "base_failed", kept.alias("kept"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, ...] = ("lang", "source"), **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged. Rows that repeat an id stay only if all of them pass;
    rows with a null id stay if their own statistics pass."""
    verdict = cut(_judged(docs, id_col, text_col, keys, **options))
    gone = verdict.where(~F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__gone")).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    nameless = docs.where(F.col(id_col).isNull()).withColumn("__row", F.struct(*[docs[c] for c in docs.columns]))
    own, same = stats(nameless, "__row", text_col, keys), [*keys, *STATS]
    fine = verdict.where(F.col("kept") & F.col(id_col).isNull()).select(*[F.col(c).alias(f"__{c}") for c in same]).distinct()
    passed = own.join(fine, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in same], "left_semi")
    return named.unionByName(passed.select("__row.*"))
