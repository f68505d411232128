"""A write-through cache of requests: what one request read from a slow source is kept, and later ones that it holds are
answered from there.

The cache is a folder of two tables in a store that all executors share. ``data`` has the rows, in partitions by the request
keys; ``manifest`` has a hypercube (an array of values for each key) for all that was written. A request is compared with
the manifest cube by cube; only what no cube holds is read from the source, as few cubes as cover it. Rows are committed
before their cube, and writing a cube again replaces its partitions, so a run that stops in between costs a read, never rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbria.plans import tables as B


class RequestCache:
    """``source`` takes a request (key -> list of values) and returns its rows; ``keys`` (name -> SQL type) partition them."""

    def __init__(self, spark: SparkSession, path: str, source: Callable[[dict], DataFrame], keys: dict[str, str]):
        self.spark, self.path, self.source, self.keys = spark, path.rstrip("/"), source, keys

    def _manifest(self) -> DataFrame:
        kinds = ", ".join([*(f"{k} array<{t}>" for k, t in self.keys.items()), "schema string"])
        try:
            return self.spark.read.schema(kinds).parquet(f"{self.path}/manifest")
        except Exception as e:  # nothing was written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], kinds)

    def _cubes(self, request: dict) -> DataFrame:
        return self.spark.createDataFrame([tuple(list(request[k]) for k in self.keys)], ", ".join(f"{k} array<{t}>" for k, t in self.keys.items()))

    def lacking(self, request: dict) -> list[dict]:
        """The cubes of a request that the cache does not hold; a request is a few lists of values."""
        found = B.missing(self._cubes(request), self._manifest().select(*self.keys), list(self.keys))
        return [{k: list(r[k]) for k in self.keys} for r in found.collect()]

    def read(self, request: dict) -> DataFrame:
        """The rows of a request, from the cache alone once what it lacks is written. An empty answer of the source is kept as
        well; a key without values gives no rows."""
        for cube in self.lacking(request):
            rows = self.source(cube)
            rows.repartition(*self.keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.keys).parquet(f"{self.path}/data")
            kinds = json.dumps(rows.schema.jsonValue())
            self._cubes(cube).withColumn("schema", F.lit(kinds)).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        kinds = self._manifest().agg(F.max("schema")).first()[0]
        if kinds is None:
            raise ValueError("the request has no values and nothing was read before")
        wanted = reduce(lambda a, b: a & b, [F.col(k).isin(list(request[k])) for k in self.keys])
        return self.spark.read.schema(T.StructType.fromJson(json.loads(kinds))).parquet(f"{self.path}/data").where(wanted)
