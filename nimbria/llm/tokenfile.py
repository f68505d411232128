"""Token-id output as wavelet matrices, one per shard.

A shard holds the ids of consecutive documents as bit planes: plane 0 has each id's highest bit in text order, each
further plane the next bit after a stable partition by the bits before. Planes are compressed in blocks of 65,536 bits,
and the file holds a directory of where each block lies and how many ones precede it. Access, counting and occurrence
lookup open the few blocks that they touch, so one compressed file answers them without being expanded.

Scale: documents are range-partitioned by id once (the only shuffle of texts), then encoded and packed in a streaming
pass that holds one shard of about ``shard_tokens`` ids; files are written by Spark to any file system it knows (a row
a shard in a Parquet container), so no worker touches a local path. Global positions come from a running sum over one
number a shard.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from nimbria.llm.common import shared_path, small_batches, strings

MAGIC, BLOCK = b"NWM2", 1 << 16
MARKS, PIECE = ".,;:!?", 1 << 20
SPACE = np.array([i < 128 and chr(i).isspace() for i in range(256)])
OTHER_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])  # first bytes of the white space beyond ASCII


class Plane:
    """One bit plane in blocks: ``blocks`` are packed bits, compressed or not; ``ones`` has the ones before each and in all."""

    def __init__(self, blocks: list[bytes], ones: np.ndarray, compressed: bool = True):
        self.blocks, self.ones, self.compressed, self.opened = blocks, ones, compressed, 0
        self._held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, raw: bytes) -> Plane:
        blocks = [raw[i : i + BLOCK // 8] for i in range(0, len(raw), BLOCK // 8)]
        return cls(blocks, np.cumsum([0, *(int(np.bitwise_count(np.frombuffer(b, np.uint8)).sum()) for b in blocks)]), False)

    def raw(self, block: int) -> bytes:
        self.opened += len(self.blocks[block])
        return zstandard.ZstdDecompressor().decompress(self.blocks[block]) if self.compressed else self.blocks[block]

    def _open(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """A block's 64-bit words and the ones of the plane before each."""
        if block not in self._held:
            raw = self.raw(block)
            words = np.frombuffer(raw + b"\0" * (-len(raw) % 8 + 8), np.uint64)
            self._held[block] = words, self.ones[block] + np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return self._held[block]

    def look(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits at positions ``at`` (one past the end is 0) and the number of ones before each."""
        bits, ranks = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        if self.blocks:
            block = np.minimum(at // BLOCK, len(self.blocks) - 1)
            for b in np.unique(block).tolist():
                mine = np.flatnonzero(block == b)
                words, before = self._open(b)
                off = at[mine] - b * BLOCK
                word, bit = words[off >> 6], (off & 63).astype(np.uint64)
                bits[mine] = (word >> bit & np.uint64(1)).astype(np.int64)
                ranks[mine] = before[off >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        return bits, ranks

    def select(self, bit: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the nth (from 0) bits of that value; the directory tells in which block each lies."""
        before = self.ones if bit else np.arange(len(self.ones)) * BLOCK - self.ones
        block, out = np.searchsorted(before, nth, side="right") - 1, np.zeros(len(nth), np.int64)
        block = np.minimum(block, len(self.blocks) - 1)
        for b in np.unique(block).tolist():
            mine = np.flatnonzero(block == b)
            words, _ = self._open(b)
            bits = np.unpackbits(words[: BLOCK // 64].view(np.uint8), bitorder="little")
            out[mine] = b * BLOCK + np.flatnonzero(bits == bit)[nth[mine] - before[b]]
        return out


class WaveletMatrix:
    """Succinct sequence of non-negative integers: ``planes`` (most significant first) and the number of zero bits in each."""

    def __init__(self, length: int, planes: list[Plane], zeros: list[int]):
        self.length, self.planes, self.zeros = length, planes, zeros

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.asarray(ids)
        ids = ids.astype(np.uint16 if len(ids) and ids.max() < 1 << 16 else np.uint32)
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes, zeros = [], []
        for level in reversed(range(levels)):
            bits = (ids >> ids.dtype.type(level)).astype(np.uint8) & np.uint8(1)
            planes.append(Plane.of(np.packbits(bits, bitorder="little").tobytes()))
            ones = bits.view(bool)
            low = np.compress(~ones, ids)
            zeros.append(len(low))
            ids = np.concatenate([low, np.compress(ones, ids)])
        return cls(len(ids), planes, zeros)

    @property
    def opened(self) -> int:
        """Bytes of the planes that were read so far."""
        return sum(p.opened for p in self.planes)

    def access(self, at) -> np.ndarray:
        """The values at positions ``at``."""
        at = np.asarray(at, np.int64)
        out = np.zeros(at.shape, np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.look(at)
            at = np.where(bit == 1, zeros + ones, at - ones)
            out = out << 1 | bit
        return out

    def _range(self, symbol: int, first: int, last: int) -> tuple[int, int]:
        if not 0 <= symbol < 1 << len(self.planes):
            return 0, 0
        edge = np.array([first, last], np.int64)
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            _, ones = plane.look(edge)
            edge = zeros + ones if symbol >> (len(self.planes) - 1 - level) & 1 else edge - ones
        return int(edge[0]), int(edge[1])

    def count(self, symbol: int, first: int = 0, last: int | None = None) -> int:
        """How often ``symbol`` is in positions first..last-1."""
        low, high = self._range(symbol, first, self.length if last is None else last)
        return high - low

    def rank(self, symbol: int, at: int) -> int:
        return self.count(symbol, 0, at)

    def locate(self, symbol: int) -> np.ndarray:
        """All positions of ``symbol``, ascending."""
        low, high = self._range(symbol, 0, self.length)
        at = np.arange(low, high, dtype=np.int64)
        for level in reversed(range(len(self.planes))):
            if symbol >> (len(self.planes) - 1 - level) & 1:
                at = self.planes[level].select(1, at - self.zeros[level])
            else:
                at = self.planes[level].select(0, at)
        return np.sort(at)

    def values(self) -> np.ndarray:
        """The whole sequence: the stable partitions are undone from the last plane up."""
        levels = len(self.planes)
        whole = [b"".join([p.raw(b) for b in range(len(p.blocks))]) for p in self.planes]
        bits = [np.unpackbits(np.frombuffer(raw, np.uint8), count=self.length, bitorder="little").view(bool) for raw in whole]
        out = np.zeros(self.length, np.uint16 if levels <= 16 else np.uint32)
        for level in reversed(range(levels)):
            up = np.empty_like(out)
            up[~bits[level]] = out[: self.zeros[level]]
            up[bits[level]] = out[self.zeros[level] :] | out.dtype.type(1 << (levels - 1 - level))
            out = up
        return out


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """One shard file: magic, header, compressed document table, each plane's directory, compressed blocks."""
    matrix, press = WaveletMatrix.of(ids), zstandard.ZstdCompressor(level=1)
    table = press.compress(np.array([d or 0 for d in doc_ids], np.int64).tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes() + np.array(lengths, np.int64).tobytes())
    blocks = [[press.compress(b) for b in p.blocks] for p in matrix.planes]
    head = struct.pack("<4sQQIII", MAGIC, matrix.length, len(doc_ids), len(blocks), len(blocks[0]), len(table))
    directory = b"".join(struct.pack("<Q", z) + p.ones.astype("<u4").tobytes() + np.array([len(b) for b in own], "<u4").tobytes() for z, p, own in zip(matrix.zeros, matrix.planes, blocks, strict=True))
    return head + table + directory + b"".join(b for own in blocks for b in own)


def unpack(blob: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """The matrix, the document ids and the number of ids of each document of a shard file. Planes stay compressed."""
    magic, length, n, levels, count, size = struct.unpack_from("<4sQQIII", blob)
    if magic != MAGIC:
        raise ValueError("not a shard file")
    at = struct.calcsize("<4sQQIII")
    table = zstandard.ZstdDecompressor().decompress(blob[at : at + size])
    ids, none = np.frombuffer(table, np.int64, n).tolist(), np.frombuffer(table, np.uint8, n, 8 * n)
    docs = [None if x else d for d, x in zip(ids, none, strict=True)]
    at += size
    heads = []
    for _ in range(levels):
        zeros = struct.unpack_from("<Q", blob, at)[0]
        heads.append((zeros, np.frombuffer(blob, "<u4", count + 1, at + 8).astype(np.int64), np.frombuffer(blob, "<u4", count, at + 12 + 4 * count).tolist()))
        at += 12 + 8 * count
    planes = []
    for _, ones, sizes in heads:
        blocks = []
        for size in sizes:
            blocks.append(blob[at : at + size])
            at += size
        planes.append(Plane(blocks, ones))
    return WaveletMatrix(length, planes, [z for z, _, _ in heads]), docs, np.frombuffer(table, np.int64, n, 9 * n)


def _gathered(ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The spans of ``ids`` that begin at ``start``, one after the other."""
    at = np.repeat(start - (np.cumsum(length) - length), length)
    at += np.arange(len(at))
    return ids[at]


class Encoder:
    """Whole texts to ids with a file of the tokenizers library, by way of the words that it splits texts into anyway.

    A byte-level pre-tokenizer never joins a non-space character to a space before another non-space one, so a text
    may be cut before each such space and the parts encoded by the library apart. Arrow cuts and numbers the parts; those
    met before are looked up in a store of parts and their ids, which spares encoding the same word over and over. A store
    of more than ``most`` parts is cut to those of the last few megabytes of text.
    """

    def __init__(self, path: str, most: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.words, self.ids = pa.array([], pa.large_string()), np.zeros(0, np.uint32)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.line_bytes = self._whole("\n")
        self.line = int.from_bytes(self.line_bytes, "little")
        self.opens = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)  # ids that begin with the space before a part
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")
        self.mark = np.zeros(256, np.uint32)  # the id of each mark that may end a word
        for mark in MARKS:
            (self.mark[ord(mark)],) = self._ids(mark)

    def _ids(self, text: str) -> np.ndarray:
        """The library's ids of a text; its batch call for one text spares the offsets, which nobody reads."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _learn(self, words: list[str], gap: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words without white space, and how many each has: the library encodes them in one text with ``gap``
        between, and the ids tell where each begins: a space opens a word's first id, a line's end is an id of its own."""
        made, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first in range(0, len(words), 5000):
            some = words[first : first + 5000]
            ids = self._ids(gap + gap.join(some))
            begins = self.opens[ids] if gap == " " else ids == self.line
            cuts = np.flatnonzero(begins)
            if len(cuts) != len(some):
                raise ValueError("this tokenizer does not keep words apart")
            lengths.append(np.diff(cuts, append=len(ids)) - (gap != " "))
            made.append(ids if gap == " " else ids[~begins])
        return np.concatenate(made), np.concatenate(lengths)

    def _hold(self, words: set[str], gap: str, held: dict[str, bytes]) -> None:
        """Remember words that ``held`` lacks, which is emptied first if it has grown large."""
        if len(held) > self.most // 4:
            held.clear()
        some = list(words.difference(held))
        ids, length = self._learn(some, gap)
        raw, ends = ids.tobytes(), (4 * np.cumsum(length)).tolist()
        held.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def _others(self, parts: list[str]) -> list[bytes]:
        """The ids of parts (each after a space) that are not letters and at most one mark; a single line's end inside is
        taken apart."""
        plain, bare, ways = set(), set(), []
        for part in parts:
            line, end, rest = part.partition("\n")
            if "<|" in part or part.split() != ([line, rest] if end else [part]) or end and not part.isascii():
                ways.append(None)
                continue
            plain.add(line)
            if end:
                bare.add(rest)
            ways.append((line, end, rest))
        self._hold(plain, " ", self.spaced)
        self._hold(bare, "\n", self.bare)
        return [self._whole(" " + p) if w is None else self.spaced[w[0]] + self.line_bytes + self.bare[w[2]] if w[1] else self.spaced[p] for p, w in zip(parts, ways, strict=True)]

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where among them those of each of the distinct ``parts`` (each after a space) begin and how many they are.
        Most parts are letters and a mark or none: the letters are encoded once, whatever ends them."""
        stem = pc.utf8_rtrim(parts, MARKS)
        coded = stem.dictionary_encode()
        stems, code, n, size = coded.dictionary, coded.indices.to_numpy(), len(parts), len(self.words)
        found = pc.fill_null(pc.index_in(pa.concat_arrays([parts, stems]), value_set=self.words), -1).to_numpy().astype(np.int64)
        entry, stem_entry = found[:n].copy(), found[n:].copy()
        new = entry < 0
        met = np.zeros(len(stems), bool)
        met[code[new]] = True
        met = np.flatnonzero(met)
        texts = stems.take(pa.array(met)).to_pylist()
        alpha = np.zeros(len(stems), bool)
        alpha[met] = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        fresh = alpha[met] & (stem_entry[met] < 0)
        ids, length = self._learn(list(compress(texts, fresh.tolist())), " ")
        fresh = met[fresh]
        stem_entry[fresh] = size + np.arange(len(fresh))
        ids, length = np.concatenate([self.ids, ids]), np.concatenate([self.length, length])
        start = np.concatenate([self.start, len(self.ids) + np.cumsum(length[size:]) - length[size:]])

        tail = pc.subtract(pc.binary_length(parts), pc.binary_length(stem)).to_numpy()
        by_stem = new & alpha[code]
        same, marked, other = by_stem & (tail == 0), np.flatnonzero(by_stem & (tail == 1)), np.flatnonzero(new & ~(by_stem & (tail < 2)))
        entry[same] = stem_entry[code[same]]
        last = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset + marked + 1] - 1
        whole = stem_entry[code[marked]]
        letters = np.ones(int(length[whole].sum()) + len(marked), bool)
        letters[np.cumsum(length[whole] + 1) - 1] = False
        with_mark = np.empty(len(letters), np.uint32)
        with_mark[letters] = _gathered(ids, start[whole], length[whole])
        with_mark[~letters] = self.mark[np.frombuffer(parts.buffers()[2] or b"", np.uint8)[last]]
        rest = self._others(parts.take(pa.array(other)).to_pylist())
        more = np.concatenate([length[whole] + 1, np.fromiter(map(len, rest), np.int64, len(rest)) // 4])
        entry[np.concatenate([marked, other])] = len(length) + np.arange(len(more))
        start = np.concatenate([start, len(ids) + np.cumsum(more) - more])
        ids, length = np.concatenate([ids, with_mark, np.frombuffer(b"".join(rest), np.uint32)]), np.concatenate([length, more])

        self.words = pa.concat_arrays([self.words, stems.take(pa.array(fresh)), parts.take(pa.array(marked)), parts.take(pa.array(other))])
        self.ids, self.start, self.length = ids, start, length
        if len(self.words) > self.most:
            used = np.unique(entry)
            self.words, self.ids, self.length = self.words.take(pa.array(used)), _gathered(ids, start[used], length[used]), length[used]
            self.start = np.cumsum(self.length) - self.length
        return ids, start[entry], length[entry]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        out, some, size = [], [], 0
        for text in texts:
            some.append(text or "")
            size += len(text or "")
            if size > 1 << 23:  # so much text is cut into parts at a time
                out += self._encode(some)
                some, size = [], 0
        return out + (self._encode(some) if some else [])

    @staticmethod
    def _glued(parts: list[str]) -> list[str]:
        """Parts that are empty or begin with white space, joined to the part before them."""
        out = parts[:1]
        for part in parts[1:]:
            if part and not part[0].isspace():
                out.append(part)
            else:
                out[-1] += " " + part
        return out

    @staticmethod
    def _loose(parts: pa.Array, inner: np.ndarray) -> bool:
        """Whether one of the ``inner`` parts, which follow a space, is empty or begins with white space."""
        at = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
        first = np.append(np.frombuffer(parts.buffers()[2] or b"", np.uint8), np.uint8(32))[at[:-1]]
        if (inner & (SPACE[first] | (at[1:] == at[:-1]))).any():
            return True
        return any(p[0].isspace() for p in parts.filter(pa.array(inner & OTHER_SPACE[first])).to_pylist())

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        parts, ends = split.flatten(), split.offsets.to_numpy()
        inner = np.ones(len(parts), bool)
        inner[ends[:-1]] = False
        if self._loose(parts, inner):
            glued = [self._glued(text.split(" ")) for text in texts]
            parts, ends = pa.array(chain.from_iterable(glued), pa.large_string()), np.cumsum([0, *map(len, glued)])
            inner = np.ones(len(parts), bool)
            inner[ends[:-1]] = False
        coded = parts.dictionary_encode()
        codes, after = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), bool)
        after[codes[inner]] = True
        start, length = np.zeros(len(after), np.int64), np.zeros(len(after), np.int64)
        ids, start[after], length[after] = self._parts(coded.dictionary.filter(pa.array(after)))
        lengths = np.where(inner, length[codes], 0)  # a text's first part follows no space and is encoded apart
        before = np.concatenate([[0], np.cumsum(lengths)])
        raw = b"".join(_gathered(ids, start[codes[a : a + PIECE]], lengths[a : a + PIECE]).tobytes() for a in range(0, len(codes), PIECE))
        firsts = coded.dictionary.take(pa.array(codes[ends[:-1]])).to_pylist()
        self._hold({p for p in firsts if p and p.isascii() and "<|" not in p and p.split() == [p]}, "\n", self.bare)
        cuts, bare = (4 * before[ends]).tolist(), self.bare
        return [(bare[p] if p in bare else self._whole(p) if p else b"") + raw[a:b] for p, a, b in zip(firsts, cuts, cuts[1:], strict=False)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's encoder of a tokenizer file; kept while the worker lives."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 2, shard_tokens: int = 1 << 20) -> None:
    """Encode every whole text and write shard files under ``path``, documents in ascending id order.

    ``id_col`` must be integral. Null ids come first; rows that repeat an id are ordered by a hash of
    their text, so that many of them need not share a partition. Null and empty texts
    are the end id alone. An empty table writes no shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode_batch, b"" if end_id is None else struct.pack("<I", end_id)
        part, seq, held, docs_, lengths = TaskContext.get().partitionId(), 0, [], [], []

        def shard() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), np.uint32)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([pack(ids, docs_, lengths)], pa.binary())], names=["part", "seq", "n_tokens", "shard"])

        size = 0
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode(strings(batch.column(1))), strict=True):
                ids += end
                held.append(ids)
                docs_.append(doc)
                lengths.append(len(ids) // 4)
                size += len(ids) // 4
                if size >= shard_tokens:
                    yield shard()
                    seq, size = seq + 1, 0
                    held, docs_, lengths = [], [], []
        if docs_:
            yield shard()

    ordered = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).withColumn("__hash", F.xxhash64("__text"))
    ordered = ordered.repartitionByRange("__id", "__hash").sortWithinPartitions("__id", "__hash", "__text").select("__id", "__text")
    small_batches(ordered).mapInArrow(run, "part int, seq int, n_tokens bigint, shard binary").write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files under ``path``: id, start, n_tokens, ids_crc32, and with ``ids`` the ids."""
    schema = T.StructType.fromDDL("part int, seq int, n_tokens bigint, shard binary")
    files = spark.read.schema(schema).parquet(path)
    names = ["doc_id", "part", "seq", "before", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                matrix, docs, lengths = unpack(blob)
                values = matrix.values().astype(np.uint32)
                ends = np.cumsum(lengths)
                spans = list(zip((ends - lengths).tolist(), ends.tolist(), strict=True))
                columns = [
                    pa.array(docs, pa.int64()), pa.array([part] * len(docs), pa.int32()), pa.array([seq] * len(docs), pa.int32()),
                    pa.array([a for a, _ in spans], pa.int64()), pa.array(lengths, pa.int64()), pa.array([zlib.crc32(values[a:b].data) for a, b in spans], pa.int64()),
                ]
                if ids:
                    columns.append(pa.array([values[a:b].tolist() for a, b in spans], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = files.select("part", "seq", "shard").mapInArrow(run, "doc_id bigint, part int, seq int, before bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * ids)
    sums = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select("part", sums(Window.orderBy("part")).alias("first"))  # one row a writing task
    bases = files.select("part", "seq", sums(Window.partitionBy("part").orderBy("seq")).alias("base")).join(parts, "part")
    rows = rows.join(bases.select("part", "seq", (F.col("first") + F.col("base")).alias("base")), ["part", "seq"])
    return rows.select(F.col("doc_id").alias(id_col), (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the files (in the shared folder unless ``path`` is given) and return what they say about each document."""
    path = path or shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, id_col, text_col, end_id)
    return read_tokens(docs.sparkSession, path, id_col=id_col)
