"""Helpers that the training-data operators share.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``: exactly what ``bytes.split()`` returns for UTF-8, as
``bytes.lower()`` changes A-Z alone. Python code therefore works on the UTF-8 bytes that Arrow hands over.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbria.sources.shared import shared_dir, shared_path

#: The white space that separates words, as a regular expression class.
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage, survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again; smaller on disk than a checkpoint."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, most: int = 8 << 20) -> DataFrame:
    """``df`` itself; its session's Arrow batches are held to ``most`` bytes (a lower setting stays), so that a Python
    worker never has more than a few megabytes of texts at once. The setting is read when the result is planned, so it stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(df.sparkSession.conf.get(name).rstrip("b")) > most:
        df.sparkSession.conf.set(name, str(most))
    return df


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def strings(column: pa.Array) -> list[str | None]:
    """The texts of a string column; bytes that are no UTF-8 become U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if t is None else t.decode(errors="replace") for t in texts(column)]


CONTINUING = bytes(range(0x80, 0xC0))


def code_points(text: bytes) -> int:
    """The number of code points of UTF-8 bytes: of those that do not continue one."""
    return len(text.translate(None, CONTINUING))


def word_count(text: str = "text"):
    """Number of words as a native column; null counts 0."""
    flat = F.trim(F.translate(F.col(text), "\t\n\x0b\x0c\r", "     "))
    return F.when(F.col(text).isNull() | (flat == ""), F.lit(0)).otherwise(F.size(F.split(flat, " +"))).cast("long")
