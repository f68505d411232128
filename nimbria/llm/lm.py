"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

A count is stored as its level on a logarithmic scale: the n-gram is entered once for each level up to its own, and a
lookup probes level after level until one is missing. Uni- and bigrams share the filter; smoothed probabilities come
from those probes: P(w | h) = (c(hw) + mu P(w)) / (c(h) + mu), P(w) = (c(w) + 1) / (N + V + 1).

``fit`` counts the n-grams of the training documents and writes the model, a table: for each segment of the n-grams' hash
space, of about ``segment_tokens`` tokens, the bits of its filter, and its words with their exact counts (for the base
score). ``score`` reads nothing but that table and works on any documents.

Scale: every training n-gram is kept, so the model grows with the corpus. Texts are read once and become blocks of token
numbers in the shared folder. For the counts a block sends its distinct training n-grams to their segments, packed, each
once; a task sums one segment. For the scores the segments are broadcast in groups of at most ``group_bytes``, one group after
the other: in its turn each block probes the n-grams that lie in the group and notes a byte each. A worker's memory is a
group and a block whatever the corpus; the turns grow with it, each a pass over the packed blocks alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from nimbria.llm.common import small_batches, texts, written

FOLDS, HELD_OUT = 7, 2
BLOCK_TOKENS, SEGMENT_TOKENS, BITS_PER_EVENT, PROBES, MU, GROUP_BYTES = 1_000_000, 1_000_000, 12, 5, 200.0, 64 << 20
#: The counts at which levels begin: powers of 5/4, rounded down.
LEVELS = np.unique(np.floor(1.25 ** np.arange(180)).astype(np.int64))
#: What a level stands for: the middle of its counts.
MIDDLES = np.concatenate([[0.0], (LEVELS + np.append(LEVELS[1:] - 1, LEVELS[-1])) / 2])
BEGIN, END = np.uint64(xxhash.xxh64_intdigest(b"\x01 begin")), xxhash.xxh64_intdigest(b"\x02 end")


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def single(word: np.ndarray) -> np.ndarray:
    """The key of a unigram: 48 bits, far finer than the filter itself errs."""
    return mixed(word) >> np.uint64(16)


def pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a bigram, 48 bits."""
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + word) >> np.uint64(16)


def held_out(doc_id) -> bool:
    """Whether a document is kept from training; a null id counts as the empty text."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _pack_planes(a: np.ndarray) -> bytes:
    """Compressed byte by byte place: high bytes of small numbers vanish."""
    return _pack(a.view(np.uint8).reshape(len(a), a.itemsize).T)


def _open_planes(raw: bytes, kind) -> np.ndarray:
    flat = _open(raw, np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _open(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def blocks(docs: DataFrame, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Documents as token numbers: a row a block of about ``block_tokens`` (a document is never split)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        numbers: dict[bytes, int] = {}
        ids, tokens, lengths, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            hashes = np.array([END, *map(xxhash.xxh64_intdigest, numbers)], np.uint64)
            at, sizes = np.concatenate(tokens), np.array(lengths)
            out = np.array([held_out(d) for d in ids])
            train = at[~np.repeat(out, sizes)]
            counts = np.bincount(train, minlength=len(hashes)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + seq], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([_pack(sizes)]), pa.array([_pack(out)]), pa.array([_pack_planes(at)]),
                    pa.array([_pack(hashes)]), pa.array([_pack(counts)]), pa.array([len(at)], pa.int64()), pa.array([len(train)], pa.int64()),
                ],
                names=["block", "ids", "sizes", "out", "tokens", "hashes", "counts", "n_tokens", "n_train"],
            )

        for batch in batches:
            id_type = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                words = (text or b"").lower().split()
                for w in set(words).difference(numbers):
                    numbers[w] = len(numbers) + 1
                tokens.append(np.fromiter(chain(map(numbers.__getitem__, words), (0,)), np.uint32, len(words) + 1))
                ids.append(doc)
                lengths.append(len(words) + 1)
                size += len(words) + 1
                if size >= block_tokens:
                    yield block()
                    seq, size, numbers = seq + 1, 0, {}
                    ids, tokens, lengths = [], [], []
        if ids:
            yield block()

    schema = f"block bigint, ids array<{kind}>, sizes binary, out binary, tokens binary, hashes binary, counts binary, n_tokens bigint, n_train bigint"
    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, schema)


@dataclass
class Filter:
    """A segment's log-frequency Bloom filter: packed bits, their number and the highest level entered."""

    bits: np.ndarray
    size: int
    top: int

    @staticmethod
    def _first(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The first probe of a level and the step to the next."""
        first = mixed(keys + np.uint64(level * 0xD1342543DE82EF95 % 2**64))
        return first, mixed(first) | np.uint64(1)

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Filter:
        """The filter of distinct ``keys`` with their ``counts``; a key without a count is not entered."""
        levels = np.searchsorted(LEVELS, counts, side="right")
        size, top = max(64, -(-int(levels.sum()) * BITS_PER_EVENT // 64) * 64), int(levels.max(initial=0))
        flags = np.zeros(size, np.uint8)
        for level in range(1, top + 1):
            spot, step = cls._first(keys[levels >= level], level)
            for _ in range(PROBES):
                flags[spot % np.uint64(size)] = 1
                spot = spot + step
        return cls(np.packbits(flags, bitorder="little"), size, top)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: probes go on while a level is found; 0 for a key that was not entered."""
        return levels(self.bits, keys, np.full(len(keys), self.size, np.uint64), np.zeros(len(keys), np.uint64), self.top)


def levels(bits: np.ndarray, keys: np.ndarray, sizes: np.ndarray, bases: np.ndarray, top: int) -> np.ndarray:
    """The levels of keys, each in a filter of its own that begins at bit ``bases`` and has ``sizes`` bits."""
    out, live = np.zeros(len(keys), np.uint8), np.arange(len(keys))
    for level in range(1, top + 1):
        spot, step = Filter._first(keys[live], level)
        for _ in range(PROBES):
            at = bases[live] + spot % sizes[live]
            hit = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            live, spot, step = live[hit], spot[hit] + step[hit], step[hit]
        if not len(live):
            break
        out[live] = level
    return out


@dataclass
class Block:
    """A block opened again: its documents, token numbers, word hashes (the begin of a document last) and each token's bigram."""

    sizes: np.ndarray
    out: np.ndarray
    at: np.ndarray
    words: np.ndarray
    pairs: np.ndarray

    @classmethod
    def of(cls, sizes: bytes, out: bytes, tokens: bytes, hashes: bytes) -> Block:
        sizes, out, at, words = _open(sizes, np.int64), _open(out, bool), _open_planes(tokens, np.uint32), np.append(_open(hashes, np.uint64), BEGIN)
        before = np.roll(at, 1)
        before[np.cumsum(sizes) - sizes] = len(words) - 1
        return cls(sizes, out, at, words, pair(words[before], words[at]))


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    return (keys % np.uint64(segments)).astype(np.int64)


def counted(made: DataFrame, segments: int) -> DataFrame:
    """(segment, words, word_counts, pairs, pair_counts): each block's distinct training n-grams by segment, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *packed, counts in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                own = Block.of(*packed)
                counts = np.append(_open(counts, np.int64), (~own.out).sum())
                trained = np.flatnonzero(counts)
                pairs, pair_counts = np.unique(own.pairs[np.repeat(~own.out, own.sizes)], return_counts=True)
                sides = []
                for keys, n, place in ((own.words[trained], counts[trained], single(own.words[trained])), (pairs, pair_counts, pairs)):
                    place = _segment(place, segments)
                    order = np.lexsort((keys, place))
                    sides.append((keys[order], n[order], np.searchsorted(place[order], np.arange(segments + 1))))
                full = np.flatnonzero(sum(np.diff(edges) for *_, edges in sides))
                for first in range(0, len(full), 64):
                    some, columns = full[first : first + 64], []
                    for keys, n, edges in sides:
                        spans = [slice(edges[s], edges[s + 1]) for s in some]
                        columns += [[_pack_planes(np.diff(keys[s], prepend=np.uint64(0))) for s in spans], [_pack_planes(n[s]) for s in spans]]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], names=["segment", "words", "word_counts", "pairs", "pair_counts"])

    return made.select("sizes", "out", "tokens", "hashes", "counts").mapInArrow(run, "segment int, words binary, word_counts binary, pairs binary, pair_counts binary")


def _sum(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of packed runs, sorted, and their summed counts."""
    found, back = np.unique(np.concatenate([np.cumsum(_open_planes(k, np.uint64), dtype=np.uint64) for k in keys]), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, back, np.concatenate([_open_planes(c, np.int64) for c in counts]))
    return found, total


MODEL = "segment int, size bigint, top int, bits binary, words binary, counts binary, n_words bigint, n_tokens bigint, segments int"


def _fit(made: DataFrame, total: int, segment_tokens: int) -> DataFrame:
    segments = max(1, -(-total // segment_tokens))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        words, counts = _sum(rows["words"].to_pylist(), rows["word_counts"].to_pylist())
        pairs, pair_counts = _sum(rows["pairs"].to_pylist(), rows["pair_counts"].to_pylist())
        held, real = Filter.of(np.concatenate([single(words), pairs]), np.concatenate([counts, pair_counts])), words != BEGIN
        made = [key[0].as_py(), held.size, held.top, held.bits.tobytes(), words.tobytes(), _pack_planes(counts), int(real.sum()), int(counts[real].sum()), segments]
        return pa.table([pa.array([v], t) for v, t in zip(made, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=[f.split()[0] for f in MODEL.split(", ")])

    return written(counted(made, segments).groupBy("segment").applyInArrow(build, MODEL), "lm-model")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """The model of the documents of ``docs`` that are not held out (see ``score``), as a table in the shared folder: a row a
    segment that has n-grams, with its filter, its words (64-bit hashes) and their counts. It can be written elsewhere and
    read again as it is; N and V are sums of its columns ``n_tokens`` and ``n_words``."""
    made = written(blocks(docs, id_col, text_col, block_tokens), "lm-blocks")
    return _fit(made, made.agg(F.sum("n_tokens")).first()[0] or 0, segment_tokens)


@dataclass
class Group:
    """Neighbouring segments of a model, as they are broadcast: their filters' bits in a row, where each begins and how many it
    has, and their words, sorted, with counts."""

    first: int
    sizes: np.ndarray
    bases: np.ndarray
    bits: np.ndarray
    top: int
    words: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, rows: list, first: int, last: int) -> Group:
        sizes, parts = np.full(last - first, 64, np.uint64), {r.segment: np.frombuffer(r.bits, np.uint8) for r in rows}
        for r in rows:
            sizes[r.segment - first] = r.size
        bits = [parts.get(s, np.zeros(8, np.uint8)) for s in range(first, last)]  # a segment without n-grams has an empty filter
        words = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r.words, np.uint64) for r in rows]])
        counts = np.concatenate([np.zeros(0, np.int64), *[_open_planes(r.counts, np.int64) for r in rows]])
        order = np.argsort(words)
        return cls(first, sizes, np.cumsum(sizes) - sizes, np.concatenate(bits), max((r.top for r in rows), default=0), words[order], counts[order])

    def level(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        return levels(self.bits, keys, self.sizes[segment - self.first], self.bases[segment - self.first], self.top)

    def count(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at], 0)


def _turns(model: DataFrame, segments: int, group_bytes: int) -> list[tuple[int, int]]:
    """Ranges of segments that together take at most ``group_bytes``, by the largest segment's bytes (one segment at least)."""
    largest = model.agg(F.max(F.length("bits") + F.length("words") + F.length("counts"))).first()[0] or 1
    step = max(1, group_bytes // largest)
    return [(first, min(first + step, segments)) for first in range(0, segments, step)]


def probed(made: DataFrame, model: DataFrame, segments: int, turn: tuple[int, int]) -> DataFrame:
    """(block, turn, counts, word_levels, pair_levels): what the turn's segments say of each block's words and tokens that lie
    in them, in their order, packed."""
    first, last = turn
    rows = model.where(F.col("segment").between(first, last - 1)).select("segment", "size", "top", "bits", "words", "counts")
    shared = made.sparkSession.sparkContext.broadcast(Group.of(list(rows.toLocalIterator()), first, last))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        for batch in batches:
            for block, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = Block.of(*packed)
                keys = single(own.words)
                place, pair_place = _segment(keys, segments), _segment(own.pairs, segments)
                here, pairs_here = (place >= first) & (place < last), (pair_place >= first) & (pair_place < last)
                found = [_pack_planes(group.count(own.words[here])), _pack(group.level(keys[here], place[here])), _pack(group.level(own.pairs[pairs_here], pair_place[pairs_here]))]
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([first], pa.int32()), *[pa.array([f], pa.binary()) for f in found]], names=["block", "turn", "counts", "word_levels", "pair_levels"])

    found = made.select("block", "sizes", "out", "tokens", "hashes").mapInArrow(run, "block bigint, turn int, counts binary, word_levels binary, pair_levels binary")
    found = written(found, "lm-answers")
    shared.unpersist()
    return found


def score(docs: DataFrame, model: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", mu: float = MU, block_tokens: int = BLOCK_TOKENS, segment_tokens: int = SEGMENT_TOKENS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``model`` is a table made by ``fit``, of these documents or others; without one it is fitted to ``docs`` on the way. Tokens
    are the words (A-Z lower-cased) and one end a document. Documents whose crc32(id as text) mod 7 is 2 are held out; the
    rest train. base_score adds log10((c + 1) / (N + V + 1)) over tokens with exact counts (words are told apart by 64-bit
    hashes, n-grams in the filter by 48 bits); score is the model's log10 probability: its counts are the middles of the
    filter's levels, a bigram's no more than its words'. A null or empty text is its end alone; bytes that are no UTF-8 are
    words like others; a null id trains; rows that repeat an id each count and each return a row. Without training documents
    N and V are 0. Other columns, whatever their names, are not read. An empty table gives an empty result. Memory a task: a
    group and a block, and a document is never split.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    made = written(blocks(docs, id_col, text_col, block_tokens), "lm-blocks")
    if model is None:
        model = _fit(made, made.agg(F.sum("n_tokens")).first()[0] or 0, segment_tokens)
    segments, train, known = (x or 0 for x in model.agg(F.max("segments"), F.sum("n_tokens"), F.sum("n_words")).first())
    segments, whole = max(segments, 1), float(train + known + 1)
    turns, answers = _turns(model, segments, group_bytes), None
    for turn in turns:
        found = probed(made, model, segments, turn)
        answers = found if answers is None else answers.unionByName(found)

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        block = Block.of(*(own[c][0].as_py() for c in ("sizes", "out", "tokens", "hashes")))
        place, pair_place = _segment(single(block.words), segments), _segment(block.pairs, segments)
        c, near, together = np.empty(len(block.words), np.int64), np.empty(len(block.words)), np.empty(len(block.pairs))
        for row in found.to_pylist():
            first, last = next(t for t in turns if t[0] == row["turn"])
            here, pairs_here = (place >= first) & (place < last), (pair_place >= first) & (pair_place < last)
            c[here] = _open_planes(row["counts"], np.int64)
            near[here] = MIDDLES[_open(row["word_levels"], np.uint8)]
            together[pairs_here] = MIDDLES[_open(row["pair_levels"], np.uint8)]
        sizes, at = block.sizes, block.at
        starts = np.cumsum(sizes) - sizes
        base = np.add.reduceat(np.log10((c + 1) / whole)[at], starts)
        n_known = np.add.reduceat((c > 0)[at].astype(np.int64), starts)
        alone = np.minimum(near + 1, whole) / whole  # a level may stand for more than was counted
        history = np.roll(near[at], 1)
        history[starts] = near[-1]
        both = np.minimum(together, np.minimum(history, near[at]))  # a bigram is no more frequent than its words
        logs = np.log10((both + mu * alone[at]) / (history + mu))
        n = len(sizes)
        return pa.table({id_col: own["ids"].combine_chunks().values, "held_out": pa.array(block.out), "n_tokens": pa.array(sizes), "n_known": pa.array(n_known), "train_tokens": pa.array(np.full(n, train, np.int64)), "base_score": pa.array(base), "score": pa.array(np.add.reduceat(logs, starts))})

    result = f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return made.drop("counts", "n_tokens", "n_train").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, result)
