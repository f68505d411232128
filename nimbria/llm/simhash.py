"""SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits form a ring of ``segments`` equal segments. If two fingerprints differ in at most ``t`` bits,
then by the pigeonring principle some start ``i`` exists such that, for every length ``l``, the segments i..i+l-1
differ in at most ``floor(l * t / segments)`` bits together. All lengths with a budget of zero are equal; of the segments
up to the last length with a budget of one, all but one are. Both together are the equi-join key (48 of 64 bits for t = 2
and 8 segments, 32 keys a fingerprint); the longer chains prune a bucket's candidates before the full Hamming check.

Scale: texts are read once and never shuffled; exact copies collapse to one fingerprint before any pairing, so a bucket
holds at most as many fingerprints as the bits outside its key can tell apart (65,536 for t = 2), whatever the corpus; it
emits the edges of a spanning forest (at most its size), never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbria.llm.common import cut, small_batches, texts
from nimbria.llm.components import components

SEED = 42
SHINGLE = 3


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one UTF-8 text as a signed 64-bit integer; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_digest
    return simhash_of(np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), ">u8"))


def simhash_of(hashes: np.ndarray) -> int:
    """The fingerprint of 64-bit hashes: the bits set in over half of them, as a signed integer; 0 without any."""
    raw, ones = hashes.astype(">u8").view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for first in range(0, len(raw), 1 << 15):  # bounded memory for very long texts
        ones += np.unpackbits(raw[first : first + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(raw)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp long) for every row; one pass, no shuffle. Null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def chain_budgets(segments: int, distance: int) -> list[int]:
    """Bits that the first 1, 2, ... segments of a chain may differ in."""
    return [length * distance // segments for length in range(1, segments + 1)]


def _passes(x: np.ndarray, start: int, segments: int, distance: int) -> np.ndarray:
    """Which differences ``x`` keep within every budget of the chain that begins at segment ``start``."""
    width, budgets = 64 // segments, chain_budgets(segments, distance)
    turn = np.uint64(start * width)
    ring = (x << turn) | (x >> (np.uint64(64) - turn)) if start else x
    ok = np.ones(len(x), bool)
    for length, budget in enumerate(budgets, 1):
        if length == segments or budget != budgets[length]:  # within equal budgets the longest chain implies the rest
            ok &= np.bitwise_count(ring >> np.uint64(64 - length * width)) <= budget
    return ok & (np.bitwise_count(x) <= distance)


def _forest(start: int, fps: np.ndarray, segments: int, distance: int, out: tuple[list, list]) -> None:
    """Append the edges of a spanning forest of one bucket's links: breadth first, each fingerprint leaves ``left`` once."""
    left = fps
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            hit = _passes(left ^ at, start, segments, distance)
            if hit.any():
                new = left[hit]
                out[0].extend([at] * len(new))
                out[1].extend(new)
                frontier.extend(new)
                left = left[~hit]


def links(distinct: DataFrame, distance: int = 2, segments: int = 8) -> DataFrame:
    """``distinct`` (fp long, no repeats) -> edges (a, b) whose components are those of all links at ``distance``.

    Meant for small distances: the fewer bits a key has, the more fingerprints share it by chance.
    """
    if 64 % segments or not 0 < distance < segments:
        raise ValueError("segments must divide 64 and exceed distance")
    width, budgets = 64 // segments, chain_budgets(segments, distance)
    free, run = sum(b == 0 for b in budgets), max(1, sum(b == 1 for b in budgets))
    long = free + run if run > 1 else free  # segments of the key; with run > 1 one of the last ``run`` is left out
    if 2 ** (long * width) * segments * run > 2**62:
        raise ValueError("a chain's key leaves no room for its number")
    keys = []
    for start in range(segments):
        ring = F.expr(f"(shiftleft(fp, {start * width}) | shiftrightunsigned(fp, {64 - start * width}))" if start else "fp")
        for out in range(run):
            kept = F.shiftrightunsigned(ring, 64 - long * width)
            if run > 1:
                kept = kept.bitwiseAND(F.lit((2 ** (long * width) - 1) & ~((2**width - 1) << (out * width))))
            keys.append(kept * (segments * run) + (start * run + out))
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for k, fps in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _forest(k % (segments * run) // run, np.sort(fps.values.to_numpy().view(np.uint64)), segments, distance, out)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in out], names=["a", "b"])

    return keyed.groupBy("key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).mapInArrow(forests, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, segments: int = 8) -> DataFrame:
    """One row per document: id, fp, root (the class's least fingerprint), component_id (its smallest id).

    Documents are linked if their fingerprints differ in at most ``distance`` bits; components are the transitive
    closure. Null or empty texts have fingerprint 0 and link like any other. Rows that repeat an id each return a row;
    null ids never become a component_id unless the whole component has none (then it is null). Bytes that are no UTF-8
    are words like others. Other columns of ``docs`` are not read. Empty tables give an empty result.
    """
    fps = cut(fingerprints(docs, id_col, text_col))
    groups = cut(fps.groupBy("fp").agg(F.min(id_col).alias("least_id")))
    roots = components(links(groups.select("fp"), distance, segments)).withColumnRenamed("node", "fp")
    groups = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = groups.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return fps.join(groups.join(classes, "root").select("fp", "root", "component_id"), "fp").select(id_col, "fp", "root", "component_id")
