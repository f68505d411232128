"""Spelling variants: words one edit apart, found by merging subtries, and the common form that each rare word follows.

Two words are near if one inserted, deleted or replaced code point makes one from the other. In a trie the place of the edit
is the node where the two words part: below it one has a character that the other replaces or lacks, and then both go on
alike. So at each node the subtrees of its children are merged with that character replaced or skipped, and terminals that
coincide are near. By heavy-path decomposition only the light subtrees (all but the largest child's) are walked, small into
large, which is at most log n times per word (``near_words``).

Spark deals the work. A pair of lengths L and L or L + 1 with its edit in the zone [a, b) of places shares all before and
after that zone; words meet in groups by length, zone and the two shared ends. A word is in two zones, the halves, as either
partner: four small rows. A group of more than ``GROUP`` words is split by halving its zone, as often as it takes, so no
group is ever cut or left out; a zone of one place holds at most a square of the alphabet. A pair has one parting place, so
it is found once, and a group returns for each word a count and the best candidate, never pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbria.llm.common import cut, small_batches, texts

LEAST_CHARS, LEAST_COUNT, FACTOR, EVERY, GROUP, HELD = 7, 2, 10, 31, 4096, 1 << 18
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def damaged(doc_id: str, run: str, every: int = EVERY) -> str:
    """The run, without one code point where the checksum of document and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(word, n long): how often each word of at least ``least_chars`` code points occurs in all texts."""

    def flush(held: Counter) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                for word, n in Counter(RUN.findall((text or b"").lower().decode(errors="replace"))).items():
                    made = damaged(doc_id, word)
                    if len(made) >= least_chars:
                        held[made] += n
                if len(held) >= HELD:
                    yield flush(held)
        yield flush(held)

    named = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return small_batches(named).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Near:
    """Counts and best candidates of a group's words; the best has the largest n, then the smallest word."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = words, n
        self.count, self.best = [0] * len(words), [-1] * len(words)

    def pair(self, i: int, j: int) -> None:
        for a, b in ((i, j), (j, i)):
            self.count[a] += 1
            held = self.best[a]
            if held < 0 or (-self.n[b], self.words[b]) < (-self.n[held], self.words[held]):
                self.best[a] = b


class Node:
    """A trie node: children by character, the words that end here (several only after a merge), the words at or below it."""

    __slots__ = ("ends", "next", "size")

    def __init__(self) -> None:
        self.next: dict[str, Node] = {}
        self.ends: list[int] = []
        self.size = 0


def _trie(strings: list[str]) -> Node:
    root = Node()
    for i, s in enumerate(strings):
        node = root
        node.size += 1
        for c in s:
            child = node.next.get(c)
            if child is None:
                child = node.next[c] = Node()
            child.size += 1
            node = child
        node.ends.append(i)
    return root


def _meet(a: Node, b: Node, found: list[tuple[list[int], list[int]]], but: str | None = None) -> None:
    """The terminals of two subtrees that coincide; at the top the child ``but`` is left out."""
    stack = [(a, b, but)]
    while stack:
        a, b, but = stack.pop()
        if a.ends and b.ends:
            found.append((a.ends, b.ends))
        small, large = (a, b) if len(a.next) <= len(b.next) else (b, a)
        stack += [(child, large.next[c], None) for c, child in small.next.items() if c != but and c in large.next]


def _merge(into: Node, tree: Node, found: list[tuple[list[int], list[int]]]) -> None:
    """Add a subtree to the errata trie; terminals that it already has coincide."""
    stack = [(into, tree)]
    while stack:
        into, tree = stack.pop()
        if tree.ends:
            if into.ends:
                found.append((tree.ends, list(into.ends)))
            into.ends += tree.ends
        for c, child in tree.next.items():
            held = into.next.get(c)
            if held is None:
                held = into.next[c] = Node()
            stack.append((held, child))


def near_words(near: Near, members: list[int], strings: list[str], short: int, last: bool) -> None:
    """Note in ``near`` all pairs of one edit within ``strings`` (the zones of the words ``members``) whose shorter word has
    a zone of ``short`` characters. An edit after the zone's last place counts only in the ``last`` zone of a word."""
    root = _trie(strings)
    stack = [(root, 0)]
    while stack:
        node, depth = stack.pop()
        if node.size < 2 or depth > short or (depth == short and not last):
            continue
        children = sorted(node.next.items(), key=lambda x: -x[1].size)
        if depth < short:
            stack += [(child, depth + 1) for _, child in children]
        if not children:
            continue
        replaced: list[tuple[list[int], list[int]]] = []
        skipped: list[tuple[list[int], list[int]]] = []
        heavy, lights = children[0][1], children[1:]
        errata = Node()
        for c, light in lights:  # the largest first: each later one is walked into what is larger
            if depth < short:
                _meet(light, heavy, replaced)
                _merge(errata, light, replaced)
            _meet(light, node, skipped, but=c)  # c skipped in the light subtree
            if c in heavy.next:  # the heavy child's character skipped: what follows it is met by the light subtree
                _meet(light, heavy.next[c], skipped)
        if node.ends and heavy.ends:
            skipped.append((node.ends, heavy.ends))
        for pairs, gap in ((replaced, 0), (skipped, 1)):
            for left, right in pairs:
                for i in left:
                    for j in right:
                        lengths = sorted((len(strings[i]), len(strings[j])))
                        if lengths == [short, short + gap]:
                            near.pair(members[i], members[j])


def _zoned(words: DataFrame) -> DataFrame:
    """Add the group's key: length class, zone and what all its words share before and after the zone."""
    ends = (F.substring("word", F.lit(1), F.col("a")), F.substring("word", F.col("chars") - F.col("length") + F.col("b") + 1, F.col("length") - F.col("b")))
    return words.withColumn("key", F.xxhash64("length", "a", "b", *ends))


def _split(words: DataFrame) -> DataFrame:
    """Each word in both halves of its zone."""
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    zones = F.array(F.struct(F.col("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b")))
    return words.withColumn("z", F.explode(zones)).select("word", "n", "chars", "length", F.col("z.a").alias("a"), F.col("z.b").alias("b"))


def near_counts(vocabulary: DataFrame, group: int = GROUP, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(word, n_near long, best_n long, best string) of the words of ``vocabulary`` (word, n) that have near words."""
    partners = F.when(F.col("chars") > least_chars, F.array(F.col("chars"), F.col("chars") - 1)).otherwise(F.array(F.col("chars")))
    words = vocabulary.select("word", "n", F.length("word").alias("chars")).withColumn("length", F.explode(partners))
    words = _zoned(_split(words.withColumn("a", F.lit(0)).withColumn("b", F.col("length"))))
    ready = None
    while True:
        sizes = words.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        met = cut(words.join(sizes, "key"))
        small = met.where((F.col("members") <= group) | (F.col("b") - F.col("a") <= 1)).drop("members")
        ready = small if ready is None else ready.unionByName(small)
        large = met.where((F.col("members") > group) & (F.col("b") - F.col("a") > 1)).drop("members", "key")
        if large.isEmpty():
            break
        words = _zoned(_split(large))

    def flush(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, own in groupby(rows, key=lambda r: r[0]):
            exact = defaultdict(list)  # a key is a hash: the ends that it stands for are compared as well
            for _, word, n, length, a, b in own:
                exact[length, a, b, word[:a], word[len(word) - length + b :]].append((word, n))
            for (length, a, b, _, _), held in exact.items():
                if len(held) < 2:
                    continue
                near = Near([w for w, _ in held], [n for _, n in held])
                zones = [w[a : b + len(w) - length] for w in near.words]
                near_words(near, list(range(len(held))), zones, b - a, b == length)
                for i, k in enumerate(near.count):
                    if k:
                        out.append((near.words[i], k, near.n[near.best[i]], near.words[near.best[i]]))
            if len(out) >= HELD // 8:
                yield flush(out)
        yield flush(out)

    grouped = ready.repartition("key").sortWithinPartitions("key").select("key", "word", "n", "length", "a", "b")
    found = small_batches(grouped).mapInArrow(run, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of ``forms`` (word, form) along the forms to the last, by doubling the step.

    A form is ``FACTOR`` times as frequent as its word, so a chain is short and has no circle.
    """
    held = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = held.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut(held.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        held = moved.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, factor: int = FACTOR, group: int = GROUP) -> DataFrame:
    """(word, n long, n_near long, form string, form_n long, root string) of the words of all texts.

    Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z lower-cased and damaged as ``damaged`` tells,
    of at least ``least_chars`` code points (two at least) and ``least_count`` occurrences. ``form`` is the near word with the
    largest n (ties: the smallest in code-point order) if that is at least ``factor`` times the word's own n; ``root`` is the
    last word along the forms, the word itself if it has no form. Null and empty texts have no words; a run or text may be of
    any length. Rows that repeat an id or are equal each count; a null id reads as an empty string. Bytes that are no UTF-8
    separate words. An empty table, or one without words, gives an empty result. Other columns are left out.
    """
    vocabulary = cut(word_counts(docs, id_col, text_col, least_chars).where(F.col("n") >= least_count))
    near = near_counts(vocabulary, group, least_chars)
    known = cut(vocabulary.join(near, "word", "left"))
    follows = F.col("best_n") >= factor * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(follows, F.col("best")).alias("form"), F.when(follows, F.col("best_n")).alias("form_n"))
    last = roots(known.where("form is not null"))
    return known.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


VARIANTS_SQL = r"""
WITH RECURSIVE bits(c, step, v) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) AS t(i)
  UNION ALL
  SELECT c, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY c) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS k, hex(encode(id || ':' || run)) AS x FROM runs GROUP BY id, run),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(x), 2), lambda i: CAST('0x' || x[i : i + 1] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, k FROM hashed),
vocabulary AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
shorter AS MATERIALIZED (SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM vocabulary, unnest(range(1, length(word) + 1)) AS t(i)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, v.word, v.n FROM shorter a JOIN vocabulary v ON a.rest = v.word
  UNION SELECT v.word, a.word, a.n FROM shorter a JOIN vocabulary v ON a.rest = v.word),
near AS (SELECT word, count(*) AS n_near, min({'less': -other_n, 'word': other}) AS top FROM pairs GROUP BY word),
known AS MATERIALIZED (
  SELECT v.word, v.n, CAST(coalesce(m.n_near, 0) AS BIGINT) AS n_near, CASE WHEN -m.top.less >= 10 * v.n THEN m.top.word END AS form, CASE WHEN -m.top.less >= 10 * v.n THEN -m.top.less END AS form_n
  FROM vocabulary v LEFT JOIN near m ON v.word = m.word),
walk(word, place) AS (
  SELECT word, word FROM known
  UNION ALL
  SELECT w.word, k.form FROM walk w JOIN known k ON w.place = k.word WHERE k.form IS NOT NULL)
SELECT k.word, k.n, k.n_near, k.form, CAST(k.form_n AS BIGINT) AS form_n, w.place AS root
FROM known k JOIN walk w ON k.word = w.word JOIN known e ON w.place = e.word WHERE e.form IS NULL
"""
