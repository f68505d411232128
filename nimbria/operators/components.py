"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima and two joins on node ids; edges stay distributed, hubs only ever reduce to a
minimum (combined map-side) and adaptive execution splits their join partitions. A round's edges are written to
the shared folder, so a lost executor costs no more than the current round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbria.sources.shared import shared_dir


def _cut(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.expr("sum(cast(xxhash64(b, a) % 1000003 as long))").alias("s")).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b: long, any order, repeats and loops allowed) -> (node, root): root is the component's smallest node.

    Only nodes with an edge to another node other than their root appear; every other node is its own root. Null ends
    are ignored; no edges give an empty result.
    """
    e = _cut(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        near = e.union(e.select("b", "a")).toDF("u", "v")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = _cut(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
        last, mark = mark, _mark(e)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
