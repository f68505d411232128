"""SentencePiece encoding and decoding over a trie of distinct marked words.

Distinct marked words are sorted, which walks their trie depth-first; the forward state of every prefix is kept while
the walk is below it, so a word reuses the states of the prefix that it shares with the one before. A unigram model's state
is the score of the best path to the prefix and its last piece (Viterbi). A BPE model's result is not the best-scoring path,
so that score would give other ids than the library; there the state is the last piece alone, found by the relation that is
exact for BPE: it is the one piece t ending at the prefix whose neighbour, the last piece of the prefix before t, would not
have merged differently with it (encoding both together gives just these two).

Scale: one pass over texts without a shuffle; a worker holds one batch's distinct words and a bounded cache.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from nimbria.llm.common import small_batches, strings

MARK = "▁"


#: What an unknown character costs beyond the least score of a unigram model's pieces: fixed by the format.
UNKNOWN = 10.0


def walk(words: list[str], scores: dict[str, float], unknown: float) -> Iterator[tuple[str, list[str]]]:
    """Each of ``words`` (sorted, distinct) with the pieces of its best-scoring path; forward scores are shared by prefix.

    ``unknown`` is the score of a character that is no piece; of equal paths the one with the shorter last piece wins.
    """
    longest = max(map(len, scores), default=1)
    best, size, before = [0.0], [0], ""
    for word in words:
        shared, limit = 0, min(len(before), len(word))
        while shared < limit and before[shared] == word[shared]:
            shared += 1
        del best[shared + 1 :], size[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            top, last = best[end - 1] + scores.get(word[end - 1], unknown), 1
            for length in range(2, min(longest, end) + 1):
                score = scores.get(word[end - length : end])
                if score is not None and best[end - length] + score > top:
                    top, last = best[end - length] + score, length
            best.append(top)
            size.append(last)
        pieces, end = [], len(word)
        while end:
            pieces.append(word[end - size[end] : end])
            end -= size[end]
        yield word, pieces[::-1]
        before = word


class Pieces:
    """A SentencePiece model with byte fallback; a BPE model's ids equal the library's."""

    def __init__(self, path: str, most_words: int = 200_000):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        special = [m.is_control(i) or m.is_unknown(i) or m.is_byte(i) for i in range(n)]
        self.names = [m.id_to_piece(i) for i in range(n)]
        self.ids = {self.names[i]: i for i in range(n) if not special[i]}
        self.rank = {i: -m.get_score(i) for i in self.ids.values()}
        self.unigram = any(score != round(score) for score in self.rank.values())  # merges are ranked by whole numbers
        self.scores = {name: m.get_score(i) for name, i in self.ids.items()} if self.unigram else {}
        self.bytes = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw = [b"" if m.is_control(i) else self.names[i].replace(MARK, " ").encode() for i in range(n)]
        self.raw[m.unk_id()] = " ⁇ ".encode()
        for b, i in enumerate(self.bytes):
            self.raw[i] = bytes([b])
        self.starts = {name[:k] for name in self.ids for k in range(1, len(name) + 1)}
        self.steps: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
        self.joint: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.most = most_words

    def _merge(self, text: str) -> list[int]:
        """Plain BPE of a short string of known characters."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                made = self.ids.get(parts[i] + parts[i + 1])
                if made is not None and (best is None or self.rank[made] < best):
                    best, at = self.rank[made], i
            if best is None:
                return [self.ids[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, right: int) -> bool:
        key = (left, right)
        held = self.joint.get(key)
        if held is None:
            text = self.names[right] if left < 0 else self.names[left] + self.names[right]
            held = self._merge(text) == ([right] if left < 0 else [left, right])
            if len(self.joint) > 150_000:
                self.joint.clear()
            self.joint[key] = held
        return held

    def _step(self, text: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """From the longest piece beginning that ended a prefix, plus the next character: the longest one that ends the
        longer prefix, and the pieces that end there as (piece, length), longest first. Remembered, so that the trie
        walk pays one lookup a character."""
        node = text
        while node and node not in self.starts:
            node = node[1:]
        found = tuple((self.ids[node[k:]], len(node) - k) for k in range(len(node)) if node[k:] in self.ids)
        if len(self.steps) > 150_000:
            self.steps.clear()
        self.steps[text] = node, found
        return node, found

    def encode_sorted(self, words: list[str]) -> None:
        """Add the ids of ``words`` (sorted, distinct, one leading mark each) to the cache.

        ``nodes``, ``last`` and ``size`` hold the forward state of every prefix: where the piece automaton stands, the
        last piece and its length. An unknown character is a piece of its own, -1.
        """
        if self.unigram:
            for word, pieces in walk(words, self.scores, min(self.scores.values()) - UNKNOWN):
                ids = [[self.ids[p]] if p in self.ids else [self.bytes[b] for b in p.encode()] for p in pieces]
                self.words[word] = array("I", [i for own in ids for i in own]).tobytes()
            return
        nodes, last, size = [""], [-1], [0]
        steps, joint, held, byte = self.steps, self.joint, self.words, self.bytes
        before = ""
        for word in words:
            shared, limit = 0, min(len(before), len(word))
            while shared < limit and before[shared] == word[shared]:
                shared += 1
            del nodes[shared + 1 :], last[shared + 1 :], size[shared + 1 :]
            node = nodes[shared]
            for i in range(shared, len(word)):
                text = node + word[i]
                node, found = steps.get(text) or self._step(text)
                nodes.append(node)
                for piece, length in found:
                    key = last[i + 1 - length], piece
                    fits = joint.get(key)
                    if fits is None:
                        fits = self._fits(*key)
                    if fits:
                        last.append(piece)
                        size.append(length)
                        break
                else:
                    last.append(-1)
                    size.append(1)
            out, i = [], len(word)
            while i:
                piece = last[i]
                if piece >= 0:
                    out.append(piece)
                else:
                    out.extend([byte[b] for b in reversed(word[i - 1].encode())])
                i -= size[i]
            out.reverse()
            held[word] = array("I", out).tobytes()
            before = word

    @staticmethod
    def marked(text: str) -> list[str]:
        """The marked words of a text: each begins with its marks; only the whole text's end may be marks alone."""
        if not text:
            return []
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return [MARK + part for part in parts]
        out, marks = [], ""
        for part in parts:
            marks += MARK
            if part:
                out.append(marks + part)
                marks = ""
        return [*out, marks] if marks else out

    def _several(self, word: str) -> bytes:
        """Words with several marks are left to the library (its mark-only pieces tie in score)."""
        marks = len(word) - len(word.lstrip(MARK))
        if word == MARK:
            return np.array([self.ids[MARK]], np.uint32).tobytes()
        return np.array(self.model.encode(" " * (marks - 1) + word[marks:]), np.uint32).tobytes()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        out, split, size = [], [], 0
        for text in texts:
            split.append(self.marked(text or ""))
            size += len(text or "")
            if size > 1 << 20:  # so much text is cut into words at a time
                out += self._encode(split)
                split, size = [], 0
        return out + self._encode(split)

    def _encode(self, split: list[list[str]]) -> list[bytes]:
        seen = set().union(*split)
        if len(self.words) > self.most:
            self.words = {}
        new = seen.difference(self.words)
        for word in [w for w in new if w[1:2] == MARK or w == MARK]:
            self.words[word] = self._several(word)
            new.discard(word)
        self.encode_sorted(sorted(new))
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def forget(self) -> None:
        """Drop what was remembered: a worker that waits for other tasks holds the model alone."""
        self.words, self.steps, self.joint = {}, {}, {}

    def decode(self, ids: bytes) -> str:
        """The text of ids; invalid UTF-8 becomes U+FFFD. The first mark is the one that encoding added."""
        raw = self.raw
        text = b"".join([raw[i] for i in np.frombuffer(ids, np.uint32).tolist()]).decode(errors="replace")
        return text[1:] if text[:1] == " " else text


_MODELS: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    """A worker's model of a file; kept while the worker lives."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with piece_ids array<int>, n_pieces and ids_crc32 (of little-endian 32-bit ids), and with ``decode``
    the text that the ids give back as decoded.

    Null and empty texts have no pieces and decode to an empty text. Decoding gives the text itself, but for U+2581,
    which the model reads as a space. Texts are encoded whole. Columns of ``docs`` named like the results are replaced;
    an empty table gives an empty result.
    """
    docs = docs.drop("piece_ids", "n_pieces", "ids_crc32", "decoded")
    at, names = docs.columns.index(text_col), [*docs.columns, "piece_ids", "n_pieces", "ids_crc32", *(["decoded"] if decode else [])]
    fields = [*docs.schema.fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    fields += [T.StructField("decoded", T.StringType())] * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            found = pieces.encode_batch(strings(batch.column(at)))
            sizes = [len(x) // 4 for x in found]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), np.int32)))
            columns = [*batch.columns, ids, pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x) for x in found], pa.int64())]
            if decode:
                columns.append(pa.array([pieces.decode(x) for x in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)
        pieces.forget()

    return small_batches(docs).mapInArrow(run, T.StructType(fields))


def decode(docs: DataFrame, path: str, ids_col: str = "piece_ids") -> DataFrame:
    """``docs`` with decoded: the text of an array of ids (null: empty)."""
    docs = docs.drop("decoded")
    at, names = docs.columns.index(ids_col), [*docs.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            out = [pieces.decode(np.array(x or [], np.uint32).tobytes()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("decoded", T.StringType())]))
