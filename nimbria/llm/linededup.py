"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

A line's key is its 128-bit hash after stripping and lower-casing. The exact state is a table of references (one row
per key and document); a key's reference count and largest holder are aggregates of it. Keys whose count reaches the
threshold also sit in a cuckoo filter, one per shard of the key space, so that a pass over texts can tell most lines
apart from repeated ones without a join; only the hits are settled against the exact table. Cuckoo filters support
deletion, so ``insert`` and ``delete`` touch just the keys that cross the threshold, and deleting a batch of documents
restores the decisions that held before it.

Scale: references are 16-byte hashes, so the shuffle is a small part of the text; hot lines are combined before they
are shuffled (count and maximum). The filters stay distributed at every size: a pass over texts packs each batch's
keys by shard, and a shard's filter meets the packs of its shard. A shard with many references (a line that a third of
all documents hold) has its packs dealt to several tasks, each with a copy of that shard's filter, so a task probes about
``TASK_REFS`` references. Texts are joined once, by document id, with the keys that each document loses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from nimbria.llm.common import code_points, cut, small_batches, texts

MIN_CHARS, MIN_DOCS, SHARD_KEYS, LEAST_SHARDS, TASK_REFS = 20, 3, 1 << 16, 64, 1 << 20


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """16-byte key of a line, or None if the stripped line is shorter than ``min_chars`` code points."""
    key = line.strip()
    if len(key) < min_chars or (len(key) < 4 * min_chars and code_points(key) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


class CuckooFilter:
    """Partial-key cuckoo filter: 16-bit fingerprints, four slots a bucket, with deletion.

    ``insert`` answers False when no slot can be freed; the caller then builds a filter twice as large. There are no
    false negatives for inserted keys, and a deletion must name a key that was inserted.
    """

    SLOTS = 4

    def __init__(self, buckets: int, table: bytes | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, self.SLOTS), np.uint16) if table is None else np.frombuffer(table, np.uint16).reshape(buckets, self.SLOTS).copy()

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray) -> CuckooFilter:
        buckets = 4
        while buckets * cls.SLOTS * 0.9 < len(low):
            buckets *= 2
        while True:
            made = cls(buckets)
            if all(made.insert(int(a), int(b)) for a, b in zip(low, high, strict=True)):
                return made
            buckets *= 2

    @staticmethod
    def _mix(print_: int) -> int:
        return (print_ * 0x5BD1E995) & 0xFFFFFFFF

    def _places(self, low: int, high: int) -> tuple[int, int, int]:
        print_ = (high & 0xFFFF) or 1
        first = low % self.buckets
        return print_, first, first ^ (self._mix(print_) % self.buckets)

    def insert(self, low: int, high: int) -> bool:
        print_, first, second = self._places(low & (2**64 - 1), high)
        for at in (first, second):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = print_
                return True
        at = second
        for kick in range(500):
            slot = (print_ + kick) % self.SLOTS
            print_, self.table[at, slot] = int(self.table[at, slot]), print_
            at ^= self._mix(print_) % self.buckets
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = print_
                return True
        return False

    def delete(self, low: int, high: int) -> bool:
        print_, first, second = self._places(low & (2**64 - 1), high)
        for at in (first, second):
            held = np.flatnonzero(self.table[at] == print_)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False

    def contains(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        print_ = (high & np.uint64(0xFFFF)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = (low % np.uint64(self.buckets)).astype(np.int64)
        other = ((print_.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(0xFFFFFFFF)) % np.uint64(self.buckets)
        second = first ^ other.astype(np.int64)
        return (self.table[first] == print_[:, None]).any(axis=1) | (self.table[second] == print_[:, None]).any(axis=1)


def _keys(text: bytes | None, min_chars: int) -> list[bytes]:
    return list({k for line in (text or b"").split(b"\n") if (k := line_key(line, min_chars))})


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id_col, k1, k2): a row for each distinct eligible key of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owner = _batch_keys(batch.column(1), min_chars)
            columns = [batch.column(0).take(pa.array(owner)), *[pa.array(hashes[:, i].view(np.int64)) for i in (0, 1)]]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "k1", "k2"])

    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, k1 bigint, k2 bigint")


def _batch_keys(column: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys (two halves) of a batch's texts and the place of the text that each belongs to."""
    found = [_keys(t, min_chars) for t in texts(column)]
    hashes = np.ascontiguousarray(np.frombuffer(b"".join(k for keys in found for k in keys), np.uint64).reshape(-1, 2))
    return hashes, np.repeat(np.arange(len(found)), [len(keys) for keys in found])


def _packs(docs: DataFrame, id_col: str, text_col: str, min_chars: int, shards: int) -> DataFrame:
    """(shard, turn, ids, keys): a row for each batch of texts and shard of its keys (16 bytes each)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() * 7919
        for batch in batches:
            hashes, owner = _batch_keys(batch.column(1), min_chars)
            shard = ((hashes[:, 1] >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            full, begins = np.unique(shard[order], return_index=True)
            edges = np.append(begins, len(order))
            ids = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), batch.column(0).take(pa.array(owner[order])))
            keys = [hashes[order[a:b]].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            turn += 1
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(np.full(len(full), turn)), ids, pa.array(keys, pa.binary())], names=["shard", "turn", "ids", "keys"])

    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"shard int, turn bigint, ids array<{kind}>, keys binary")


def counts(refs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The exact reference-count table: (k1, k2, n documents, largest holder)."""
    return refs.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max(id_col).alias("largest"))


def _shard(shards: int) -> F.Column:
    """The shard of a key, as ``_packs`` computes it from the unsigned second half."""
    return F.pmod(F.shiftrightunsigned("k2", 16), F.lit(shards)).cast("int")


def build_filters(repeated: DataFrame, shards: int) -> DataFrame:
    """(shard, buckets, table binary) over the keys of ``repeated``; a shard holds about SHARD_KEYS keys."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.build(rows.k1.to_numpy().view(np.uint64), rows.k2.to_numpy().view(np.uint64))
        return pd.DataFrame({"shard": [key[0]], "buckets": [made.buckets], "table": [made.table.tobytes()]})

    keyed = repeated.select(_shard(shards).alias("shard"), "k1", "k2")
    return keyed.groupBy("shard").applyInPandas(build, "shard int, buckets int, table binary")


def _shards(repeated: DataFrame) -> int:
    return max(LEAST_SHARDS, -(-repeated.count() // SHARD_KEYS))


@dataclass
class LineIndex:
    """The incremental state: exact references, repeated keys (n >= min_docs) and their cuckoo filters."""

    refs: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int
    id_col: str = "doc_id"
    text_col: str = "text"
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS

    @classmethod
    def of(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keep_references: bool = True) -> LineIndex:
        """Index a batch. ``keep_references=False`` is for one-off runs, which need no later insert or delete."""
        refs = references(docs, id_col, text_col, min_chars)
        refs = cut(refs) if keep_references else refs
        repeated = cut(counts(refs, id_col).where(F.col("n") >= min_docs))
        shards = _shards(repeated)
        return cls(refs, repeated, cut(build_filters(repeated, shards)), shards, id_col, text_col, min_chars, min_docs)

    def _changed(self, refs: DataFrame, touched: DataFrame) -> LineIndex:
        """The state over ``refs`` given the keys that a batch touched: counts and filters change for those alone."""
        keys = touched.select("k1", "k2").distinct()
        now = counts(refs.join(keys, ["k1", "k2"], "left_semi"), self.id_col).where(F.col("n") >= self.min_docs)
        repeated = cut(self.repeated.join(keys, ["k1", "k2"], "left_anti").unionByName(now))
        old, new = self.repeated.select("k1", "k2"), repeated.select("k1", "k2")
        moves = old.exceptAll(new).withColumn("up", F.lit(False)).unionByName(new.exceptAll(old).withColumn("up", F.lit(True)))
        moves = moves.withColumn("shard", _shard(self.shards))

        def update(key: tuple, held: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
            own = CuckooFilter(int(held.buckets.iloc[0]), held.table.iloc[0]) if len(held) else CuckooFilter(4)
            for k1, k2 in change.loc[~change.up, ["k1", "k2"]].itertuples(index=False):
                own.delete(k1, k2)
            added = list(change.loc[change.up, ["k1", "k2"]].itertuples(index=False))
            if not all(own.insert(k1, k2) for k1, k2 in added):
                return pd.DataFrame({"shard": [key[0]], "buckets": [-1], "table": [b""]})
            return pd.DataFrame({"shard": [key[0]], "buckets": [own.buckets], "table": [own.table.tobytes()]})

        filters, shards = self.filters, _shards(repeated)
        if shards > 2 * self.shards:  # the index has outgrown its shards: deal the exact keys anew
            filters = cut(build_filters(repeated, shards))
            return replace(self, refs=refs, repeated=repeated, filters=filters, shards=shards)
        filters = cut(filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(update, self.filters.schema))
        full = filters.where("buckets < 0").select("shard")
        if not full.isEmpty():  # a filter outgrew its table: rebuild that shard from the exact keys
            again = build_filters(repeated.withColumn("shard", _shard(self.shards)).join(full, "shard", "left_semi"), self.shards)
            filters = cut(filters.where("buckets >= 0").unionByName(again))
        return replace(self, refs=refs, repeated=repeated, filters=filters)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The state with ``docs`` added; their references are written beside those held. An id that the index already has
        references of is an error, as its document would count twice."""
        new = cut(references(docs, self.id_col, self.text_col, self.min_chars))
        if not new.select(self.id_col).distinct().join(self.refs.select(self.id_col), self.id_col, "left_semi").isEmpty():
            raise ValueError("some of the documents to insert are in the index already")
        return self._changed(self.refs.unionByName(new), new)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The state without the documents whose ids are in ``ids``; unknown ids change nothing."""
        gone = cut(self.refs.join(ids.select(self.id_col).distinct(), self.id_col, "left_semi"))
        return self._changed(cut(self.refs.join(ids.select(self.id_col).distinct(), self.id_col, "left_anti")), gone)

    def hits(self, docs: DataFrame) -> DataFrame:
        """(id_col, k1, k2): the references of ``docs`` whose key a cuckoo filter holds: all repeated ones and a few others."""
        kind = docs.schema[self.id_col].dataType.simpleString()
        loads = self.repeated.groupBy(_shard(self.shards).alias("shard")).agg(F.sum("n").alias("load"))
        loads = cut(loads.select("shard", F.ceil(F.col("load") / TASK_REFS).cast("int").alias("tasks")))
        held = self.filters.join(loads, "shard").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).select("shard", "task", "buckets", "table")
        packs = _packs(docs, self.id_col, self.text_col, self.min_chars, self.shards).join(loads, "shard")  # shards without a repeated key go
        packs = packs.select("shard", F.pmod("turn", F.col("tasks")).cast("int").alias("task"), "ids", "keys")
        schema = f"`{self.id_col}` {kind}, k1 bigint, k2 bigint"
        names = [self.id_col, "k1", "k2"]

        def probe(own: pa.Table, rows: pa.Table) -> pa.Table:
            if not rows.num_rows:
                return pa.table({n: pa.array([], t) for n, t in zip(names, (rows["ids"].type.value_type, pa.int64(), pa.int64()), strict=True)})
            made = CuckooFilter(own["buckets"][0].as_py(), own["table"][0].as_py())
            keys = np.frombuffer(b"".join(rows["keys"].to_pylist()), np.uint64).reshape(-1, 2)
            hit = made.contains(keys[:, 0], keys[:, 1])
            ids = rows["ids"].combine_chunks().flatten().filter(pa.array(hit))
            return pa.table(dict(zip(names, [ids, *[pa.array(keys[hit, i].view(np.int64)) for i in (0, 1)]], strict=True)))

        return held.groupBy("shard", "task").cogroup(packs.groupBy("shard", "task")).applyInArrow(probe, schema)

    def dropped(self, docs: DataFrame) -> DataFrame:
        """(id_col, lost array of keys): the keys that each document loses; the filters' hits are settled by the exact table."""
        lost = self.hits(docs).join(self.repeated.select("k1", "k2", "largest"), ["k1", "k2"]).where(~F.col(self.id_col).eqNullSafe(F.col("largest")) & F.col("largest").isNotNull())
        return lost.groupBy(self.id_col).agg(F.collect_set(F.struct("k1", "k2")).alias("__lost"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the lines that they lose removed from the text, and n_lines, n_dropped."""
        docs = docs.drop("n_lines", "n_dropped", "__lost", "__id")
        lost = self.dropped(docs).withColumnRenamed(self.id_col, "__id")
        joined = docs.join(lost, F.col(self.id_col).eqNullSafe(F.col("__id")), "left").drop("__id")
        at, width, min_chars = docs.columns.index(self.text_col), len(docs.columns), self.min_chars
        names = [*docs.columns, "n_lines", "n_dropped"]
        fields = [*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept, n_lines, n_dropped = [], [], []
                for text, keys in zip(texts(batch.column(at)), batch.column(width).to_pylist(), strict=True):
                    lines = (text or b"").split(b"\n")
                    stay = lines
                    if keys:
                        lost = {np.array([k["k1"], k["k2"]], np.int64).tobytes() for k in keys}
                        stay = [x for x in lines if line_key(x, min_chars) not in lost]
                    kept.append(text if len(stay) == len(lines) else b"\n".join(stay))
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(stay))
                columns = batch.columns[:width]
                columns[at] = pa.array(kept, pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=names)

        return small_batches(joined).mapInArrow(run, T.StructType(fields))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without repeated lines, plus n_lines and n_dropped (long).

    A key (the line stripped of ``[\\x20\\x09-\\x0D]``, A-Z lower-cased) of at least ``min_chars`` code points that is in
    at least ``min_docs`` documents loses all its lines except in the largest id that holds it. A null or empty text is
    one empty line; a text that loses no line is returned as it is (null stays null), one that loses all is empty.
    Rows count as documents: rows that repeat an id each count and share their decisions. A null id is below any other;
    a key held by null ids alone keeps its lines. Bytes that are no UTF-8 stay as they are; what counts as a code point is
    any byte that does not continue one. An empty table gives an empty result. Columns of ``docs`` named like
    the results are replaced.
    """
    return LineIndex.of(docs, id_col, text_col, min_chars, min_docs, keep_references=False).apply(docs)
