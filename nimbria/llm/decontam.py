"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A benchmark item's windows of ``SIZE`` consecutive words (an item of fewer words is one window) are the patterns. Patterns
of one length share a shift table: the block of the ``BLOCK`` words that end at a position says how far the search may
jump, as far as a whole window for a block that no pattern holds. Where the jump is zero, the block's bucket of patterns,
cut down by their first block, is compared word by word with the text. Patterns of another length have tables of their own,
so that a short item doesn't shorten the jumps of the others.

Scale: documents are searched where they are read; what is shuffled is a row of a few numbers a document. The patterns are
dealt by hash to parts of about ``PART_BYTES``, and each part is collected and broadcast in its turn, so the memory of a
worker doesn't grow with the benchmark; the parts' finds are merged per document. (A window that very many items share
carries their ids and can make its part larger.)
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbria.llm.common import cut, small_batches, texts

SIZE, BLOCK, PART_BYTES = 10, 2, 16 << 20

#: Word bytes: digits, a-z and all that is not ASCII; A-Z become a-z, all others a space.
PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def split_words(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose A-Z are lower-cased; none of a null text."""
    return (text or b"").translate(PLAIN).split()


class Tables:
    """The shift table and the buckets of patterns of one length."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]]):
        patterns = list(patterns)
        self.size = len(patterns[0])
        self.block = min(BLOCK, self.size)
        self.far = self.size - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple]]] = defaultdict(lambda: defaultdict(list))
        for p in patterns:
            for end in range(self.block, self.size + 1):
                key = p[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), self.size - end)
            self.buckets[p[-self.block :]][p[: self.block]].append(p)

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, pattern) of each occurrence."""
        at, last, shift, far, block, size = self.size, len(words), self.shift, self.far, self.block, self.size
        while at <= last:
            key = tuple(words[at - block : at])
            step = shift.get(key, far)
            if step:
                at += step
                continue
            start = at - size
            for p in self.buckets[key].get(tuple(words[start : start + block]), ()):
                if all(a == b for a, b in zip(p, words[start:at], strict=True)):
                    yield start, p
            at += 1


class Search:
    """The tables of one part of the patterns, by length, and the items of each pattern."""

    def __init__(self, rows: Iterable[tuple[bytes, list[str]]]):
        self.items = {tuple(window.split(b" ")): items for window, items in rows}
        by_size = defaultdict(list)
        for p in self.items:
            by_size[len(p)].append(p)
        self.tables = [Tables(ps) for _, ps in sorted(by_size.items())]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """The spans of words (first, end) inside occurrences, merged, and the items found."""
        found, items = [], set()
        for t in self.tables:
            for start, p in t.occurrences(words):
                found.append((start, start + t.size))
                items.update(self.items[p])
        spans: list[tuple[int, int]] = []
        for first, end in sorted(found):
            if spans and first <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((first, end))
        return spans, sorted(items)


def windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(win binary, items array<string>): each distinct window, its words joined by a space, with the items that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wins, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                words = split_words(text)
                own = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else ()
                wins.extend(own)
                ids.extend([item] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(wins, pa.binary()), pa.array(ids, pa.string())], names=["win", "item"])

    named = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return small_batches(named).mapInArrow(run, "win binary, item string").groupBy("win").agg(F.collect_set("item").alias("items"))


def _search(docs: DataFrame, id_col: str, text_col: str, rows: list[tuple[bytes, list[str]]]) -> DataFrame:
    """(id_col, key, n_words, spans, items) of each row of ``docs`` against one part of the patterns."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value)
        span = pa.struct([("first", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            keys, counts, spans, items = [], [], [], []
            for text in texts(batch.column(1)):
                words = split_words(text)
                own, ids = search.find(words)
                keys.append(xxhash.xxh3_128_digest(text) if text is not None else None)
                counts.append(len(words))
                spans.append([{"first": a, "end": b} for a, b in own])
                items.append(ids)
            columns = [batch.column(0), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "key", "n_words", "spans", "items"])

    found = small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, key binary, n_words bigint, spans array<struct<first:int,end:int>>, items array<string>")
    found = cut(found)
    shared.unpersist()
    return found


def _repeat(df: DataFrame, times: str, at_once: int = 4096) -> DataFrame:
    """Each row as often as its column ``times`` says; no array is longer than a small multiple of ``at_once``."""
    blocks = df.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / at_once))))
    rest = F.least(F.lit(at_once).cast("long"), F.col(times) - F.col("__block") * at_once)
    return blocks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), rest))).drop("__block", "__copy", times)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = SIZE, part_bytes: int = PART_BYTES) -> DataFrame:
    """(id_col, n_words long, n_hit long, spans array<struct<first, end>>, items array<string>) for each row of ``docs``.

    A word is hit if an occurrence of a window covers it; ``spans`` are the runs of hit words (``end`` is exclusive) and
    ``items`` the ids of the items with an occurring window, as strings in code-point order. A null or empty text, or one of
    symbols alone, has no words and no hits; such an item has no window. Whole texts are searched, however long. Each row of
    ``docs`` returns one, repeated rows and null ids too; a null item id reads as an empty string, and items that repeat an
    id count once. An empty table on either side gives no hits. Other columns of both tables are left out, whatever their
    names. Bytes that are no UTF-8 count as letters.
    """
    wins = cut(windows(benchmark, item_col, item_text, size))
    total = wins.agg(F.sum(F.length("win") + 64 + 16 * F.size("items"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    turns = None
    for part in range(parts):
        rows = [(bytes(r.win), list(r.items)) for r in wins.where(F.pmod(F.xxhash64("win"), F.lit(parts)) == part).select("win", F.col("items")).toLocalIterator()]
        found = _search(docs, id_col, text_col, rows)
        turns = found if turns is None else turns.unionByName(found)
    merged = turns.groupBy(id_col, "key").agg(
        F.max("n_words").alias("n_words"),
        (F.count("*") / parts).cast("long").alias("__times"),
        F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    join = lambda done, s: (
        F.when((F.size(done) > 0) & (s["first"] <= F.element_at(done, -1)["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))).otherwise(F.concat(done, F.array(s)))
    )
    if parts > 1:  # spans of other parts' patterns may touch or overlap
        merged = merged.withColumn("spans", F.aggregate(F.array_sort("spans"), F.expr("cast(array() as array<struct<first:int,end:int>>)"), join))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return _repeat(merged, "__times").select(id_col, "n_words", n_hit.alias("n_hit"), "spans", "items")


DIGEST_SQL = r"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (
  SELECT r, i, s.size, array_to_string(list_slice(w, i, i + s.size - 1), ' ') AS win
  FROM docs, (SELECT DISTINCT size FROM windows) AS s, unnest(range(1, len(w) - s.size + 2)) AS t(i)),
spots AS (SELECT p.r, p.i, p.size, v.item FROM places p JOIN windows v ON p.size = v.size AND p.win = v.win),
hits AS (SELECT r, count(DISTINCT j) AS n_hit FROM spots, unnest(range(i, i + size)) AS t(j) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS digest FROM spots GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items,
  coalesce(f.digest, sha256('')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON d.r = h.r LEFT JOIN found f ON d.r = f.r
"""
