"""Near-duplicate classes by shingle similarity, with SimHash fingerprints and pigeonring chains as the filter.

Two texts are linked if the sets of their word shingles have a Jaccard similarity of at least ``similarity`` (0.8 of five
words by default); classes are the transitive closure. At 0.8 two 64-bit fingerprints differ in 10 bits on average and in
over ``DISTANCE`` = 24 with a chance of about one in a million, too many for segments of the fingerprint to serve as join keys: at
any such distance the keys would be a few bits long and put a fixed share of the corpus in each bucket. So texts meet by
min-hash bands (36 bands of five: a pair at 0.8 misses all with a chance of 6e-7, one at 0.3 meets in some with 8 %, at 0.1
with 4e-4), candidates are pruned by the chains of the fingerprints' ring, then by the full Hamming check, and what remains
is settled by the exact sets.

Scale: texts are read once; copies of a shingle set are one node. A bucket of a band only links its nodes to its least one,
so nothing collects a bucket. A candidate group that this makes and that fits in a block is settled in one task. A larger one
is first compared with four of its own members, by an equi-join that adaptive execution may split. What that does not connect
to the first of them is compared with the group's blocks if they are fewer than the bands, else with the buckets it is in alone:
each in one task if it fits in a block, else with four of the bucket's members and then block against block. So work follows
the buckets, not the closure over unverified hits. Buckets of the same nodes count once. A row is a block, never a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from nimbria.llm.common import cut, small_batches, texts, written
from nimbria.llm.components import components
from nimbria.llm.simhash import SEED, chain_budgets, simhash_of

SHINGLE, SIMILARITY, DISTANCE, SEGMENTS = 5, 0.8, 24, 8
BANDS, ROWS, LEADERS = 36, 5, 4
BLOCK_DOCS, BLOCK_SHINGLES, MOST_NUMBERS = 1024, 1 << 18, 1 << 20
_ODD = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.random.default_rng(SEED + 1).integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted set of a text's shingle hashes (A-Z lower-cased); the whole sequence if it has fewer words, none without."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    runs = [b" ".join(words)] if len(words) < size else map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(s, SEED) for s in runs]), ">u8")).astype(np.uint64)


def bands(held: np.ndarray) -> np.ndarray:
    """A key for each band of min-hashes of a set; an empty set has keys of its own."""
    least = np.full(len(_ODD), np.uint64(2**64 - 1))
    for first in range(0, len(held), 1 << 12):  # bounded memory for very long texts
        least = np.minimum(least, (held[first : first + (1 << 12), None] * _ODD).min(axis=0))
    folded = (least.reshape(BANDS, ROWS) ^ (least.reshape(BANDS, ROWS) >> np.uint64(29))) * _FOLD
    return np.bitwise_xor.reduce(folded, axis=1) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, at, node, fp, n, bands, held) of every row: a number of its own, its set's hash, fingerprint, size, band keys and
    the set."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            sets = [shingles(t, shingle) for t in texts(batch.column(1))]
            columns = [
                pa.array(np.arange(at, at + len(sets))), pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], pa.uint64()).view(pa.int64()),
                pa.array([simhash_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([bands(s).view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([s.tobytes() for s in sets], pa.binary()),
            ]
            at += len(sets)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "at", "node", "fp", "n", "bands", "held"])

    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"id {kind}, at bigint, node bigint, fp bigint, n bigint, bands array<bigint>, held binary")


class Side:
    """The members of a block: node numbers, fingerprints, shingle sets and their sizes."""

    def __init__(self, members: pa.StructArray):
        self.nodes = members.field("node").to_numpy()
        self.fps = members.field("fp").to_numpy().view(np.uint64)
        self.sets = [np.frombuffer(x, np.uint64) for x in members.field("held").to_pylist()]
        self.sizes = np.array([len(s) for s in self.sets])

    def like(self, fp: np.uint64, held: np.ndarray, among: np.ndarray, similarity: float, distance: int) -> np.ndarray:
        """Those of ``among`` (places) that are linked to a text: sizes, chains, Hamming distance, then the exact sets."""
        sizes = self.sizes[among]
        among = among[np.minimum(sizes, len(held)) >= similarity * np.maximum(sizes, len(held))]
        x = self.fps[among] ^ fp
        among = among[_chained(x, distance)]
        among = among[np.bitwise_count(self.fps[among] ^ fp) <= distance]
        hits = []
        for i in among.tolist():
            own = self.sets[i]
            both = len(np.intersect1d(own, held, assume_unique=True))
            every = len(own) + len(held) - both
            if not every or both / every >= similarity:
                hits.append(i)
        return np.array(hits, np.int64)


def _chained(x: np.ndarray, distance: int) -> np.ndarray:
    """Which differences have a start on the ring whose every chain keeps within its budget."""
    width, budgets = 64 // SEGMENTS, chain_budgets(SEGMENTS, distance)
    bits = np.stack([np.bitwise_count((x >> np.uint64(64 - width * (i + 1))) & np.uint64(2**width - 1)) for i in range(SEGMENTS)])
    found = np.zeros(len(x), bool)
    for start in range(SEGMENTS):
        total, ok = np.zeros(len(x), np.int64), np.ones(len(x), bool)
        for length, budget in enumerate(budgets):
            total += bits[(start + length) % SEGMENTS]
            ok &= total <= budget
        found |= ok
    return found


def _edges(pairs: tuple[list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(p, np.int64)) for p in pairs], names=["a", "b"])


def _within(similarity: float, distance: int):
    """Edges of a spanning forest of each block's links: breadth first, a member leaves the rest once linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for members in batch.column(0):
                side = Side(members.values)
                left = np.argsort(side.nodes)
                while len(left) > 1:
                    frontier, left = [left[0]], left[1:]
                    while frontier and len(left):
                        at = frontier.pop()
                        new = side.like(side.fps[at], side.sets[at], left, similarity, distance)
                        out[0].extend([side.nodes[at]] * len(new))
                        out[1].extend(side.nodes[new])
                        frontier.extend(new)
                        left = np.setdiff1d(left, new, assume_unique=True)
            yield _edges(out)

    return run


def _between(similarity: float, distance: int):
    """Edges from each member of the first block to the second, one for each label of the second's members it is linked to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for asked, members in zip(batch.column(0), batch.column(1), strict=True):
                one, other, labels = Side(asked.values), Side(members.values), members.values.field("label").to_numpy()
                every = np.arange(len(other.nodes))
                for i, node in enumerate(one.nodes):
                    hit = other.like(one.fps[i], one.sets[i], every[other.nodes != node], similarity, distance)
                    hit = hit[np.unique(labels[hit], return_index=True)[1]]
                    out[0].extend([node] * len(hit))
                    out[1].extend(other.nodes[hit])
            yield _edges(out)

    return run


def candidate_groups(sketched: DataFrame) -> DataFrame:
    """(node, root) of the nodes that share a band's key with another node, directly or by way of others."""
    keyed = sketched.groupBy("node").agg(F.min(F.struct("at", "bands")).alias("s")).select("node", F.explode("s.bands").alias("band"))
    least = keyed.groupBy("band").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b <> most").select("band", "b")
    return components(keyed.join(least, "band").where("node <> b").select(F.col("node").alias("a"), "b"))


def _blocks(block_docs: int, block_shingles: int):
    return F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("blocks")


MEMBER = ("node", "fp", "held", "label")


def _stars(rows: DataFrame, key: str, run) -> tuple[DataFrame, DataFrame]:
    """Edges of the ``rows`` of each group to ``LEADERS`` of its members, chosen by hash, and the rows with ``in_first``: true if
    these edges connect them to the first leader, null if not."""
    leaders = cut(rows.groupBy(key).agg(*[F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("h"), "node", "fp", "held")).alias(f"l{i}") for i in range(LEADERS)]))
    many = F.array(*[F.struct(f"l{i}.node", f"l{i}.fp", f"l{i}.held", F.lit(i).cast("long").alias("label")) for i in range(LEADERS)])
    tested = rows.join(leaders.select(key, many.alias("many")), key).select(F.array(F.struct(*MEMBER)).alias("one"), "many")
    star = written(tested.mapInArrow(run, "a bigint, b bigint"), "near-stars")
    own = leaders.select(key, F.explode(F.array(*[F.struct(F.col(f"l{i}.node").alias("b"), F.lit(1 << i).alias("bit")) for i in range(LEADERS)])).alias("x")).select(key, "x.*")
    linked = star.join(own, "b").select(key, F.col("a").alias("node"), "bit").union(own.select(key, "b", "bit"))
    linked = cut(linked.groupBy(key, "node").agg(F.bit_or("bit").alias("mask")))  # which leaders a node is linked to
    meets = lambda x, y: x.bitwiseAND(y) != 0
    grown = lambda r: F.aggregate("masks", r, lambda q, m: F.when(meets(q, m), q.bitwiseOR(m)).otherwise(q))
    masks = linked.groupBy(key).agg(F.collect_set("mask").alias("masks"))  # at most 2 ** LEADERS of them
    reach = masks.select(key, F.aggregate(F.sequence(F.lit(1), F.lit(LEADERS)), F.lit(1), lambda r, _: grown(r)).alias("reach"))
    reached = linked.join(reach, key).where(meets(F.col("mask"), F.col("reach"))).select(key, "node", F.lit(True).alias("in_first"))
    return star, rows.join(reached, [key, "node"], "left")


def _across(tested: DataFrame, key: str, run) -> DataFrame:
    """Edges of the rows that are not ``in_first`` to all rows of their group, block against block."""
    labelled = tested.withColumn("label", F.when(F.col("in_first"), F.lit(-1).cast("long")).otherwise(F.col("node")))
    block = lambda salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col("blocks"))
    packed = lambda rows, salt: rows.groupBy(key, block(salt).alias("block")).agg(F.collect_list(F.struct(*MEMBER)).alias("members"))
    rest = packed(labelled.where("in_first is null"), 2).select(key, F.col("members").alias("asked"))
    return rest.join(packed(labelled, 3), key).select("asked", "members").mapInArrow(run, "a bigint, b bigint")


def links(sketched: DataFrame, similarity: float = SIMILARITY, distance: int = DISTANCE, block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES, most_blocks: int = BANDS) -> DataFrame:
    """Edges (a, b) between nodes of ``sketched`` whose components are those of all links between their sets.

    The rest of a group of at most ``most_blocks`` blocks meets each of them, that of a larger group its buckets: a set travels as
    often as there are blocks, and at most as often as there are bands."""
    groups = candidate_groups(sketched)
    groups = cut(groups.unionByName(groups.select(F.col("root").alias("node"), "root")).distinct())
    one = sketched.groupBy("node").agg(F.min("at").alias("at"), F.max("n").alias("n"))
    chosen = cut(one.join(groups, "node").select("at", "root", "n"))
    weights = cut(chosen.groupBy("root").agg(_blocks(block_docs, block_shingles)))
    within = lambda rows, key: rows.groupBy(key).agg(F.collect_list(F.struct(*MEMBER)).alias("members")).select("members").mapInArrow(_within(similarity, distance), "a bigint, b bigint")
    between = _between(similarity, distance)

    def members(groups: DataFrame) -> DataFrame:
        """The rows of ``sketched`` of the nodes of ``groups``, with their root. Their numbers are broadcast after counting them."""
        asked = chosen.join(groups, "root").select("at", "root", "blocks")
        few = asked.limit(MOST_NUMBERS + 1).count() <= MOST_NUMBERS
        rows = sketched.select("at", "node", "fp", "n", "bands", "held", F.lit(0).cast("long").alias("label"))
        return rows.join(F.broadcast(asked) if few else asked, "at").drop("at")

    found = within(members(weights.where("blocks = 1")), "root")
    if weights.where("blocks > 1").isEmpty():
        return found
    large = written(members(weights.where("blocks > 1")), "near-members")
    star, tested = _stars(large, "root", between)
    found = found.union(star).union(_across(tested.where(F.col("blocks") <= most_blocks), "root", between))
    if weights.where(F.col("blocks") > max(1, most_blocks)).isEmpty():
        return found
    large = large.where(F.col("blocks") > most_blocks).drop("blocks")
    place = cut(tested.where(F.col("blocks") > most_blocks).select("node", "n", F.explode("bands").alias("band"), F.col("in_first").isNull().alias("rest")))
    held = place.groupBy("band").agg(_blocks(block_docs, block_shingles), F.count("*").alias("nodes"), F.max("rest").alias("rest"), F.expr("bit_xor(xxhash64(node))").alias("same")).where("rest and nodes > 1")
    buckets = cut(held.groupBy("same", "nodes", "blocks").agg(F.min("band").alias("band")).select("band", "blocks"))
    inside = lambda some: large.join(place.join(buckets.where(some), "band").select("node", "band", "blocks"), "node").select("band", "blocks", *MEMBER)
    found = found.union(within(inside("blocks = 1"), "band"))
    if buckets.where("blocks > 1").isEmpty():
        return found
    star, tested = _stars(written(inside("blocks > 1"), "near-buckets"), "band", between)
    return found.union(star).union(_across(tested, "band", between))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, distance: int = DISTANCE, **blocks) -> DataFrame:
    """One row per row of ``docs``: id, node (its shingle set's 64-bit hash), root (the class's least node), component_id (its
    smallest id; null if none of its documents has an id).

    Texts without words have the empty set and are one class; a text with fewer words than a shingle is one shingle. Rows
    that repeat an id each return a row. Bytes that are no UTF-8 are words like others. Other columns are not read. An
    empty table gives an empty result.
    """
    sketched = written(sketches(docs, id_col, text_col, shingle), "near-sketches")
    roots = components(links(sketched, similarity, distance, **blocks))
    rows = sketched.select("id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = cut(rows)
    least = cut(rows.groupBy("root").agg(F.min("id").alias("component_id")))  # so that the join may split a large class
    return rows.join(least, "root").select(F.col("id").alias(id_col), "node", "root", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, **options) -> DataFrame:
    """Keep one document of each class, the one with the smallest id, with all columns of ``docs``, whatever their names.

    Rows with a null id stay only where their whole class has none, one a class. Of rows that repeat a kept id, one stays.
    Texts are shuffled only where a join with the ids that go is too large to be broadcast.
    """
    found = cut(classes(docs, id_col, text_col, shingle, **options).withColumnRenamed(id_col, "id"))
    ids = found.where("id is not null").groupBy("id").agg(F.count("*").alias("n"), F.max(F.col("id") == F.col("component_id")).alias("kept"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    named = rows.where("id is not null")
    stay = named.join(ids.where("not kept or n > 1").select("id"), "id", "left_anti").select("row")
    again = named.join(ids.where("kept and n > 1").select("id"), "id", "left_semi").dropDuplicates(["id"]).select("row")

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([xxhash.xxh3_64_intdigest(shingles(t, shingle).tobytes()) for t in texts(batch.column(1))], pa.uint64()).view(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), own], names=["row", "node"])

    shape = rows.select("row", F.lit(0).cast("long").alias("node")).schema
    nameless = found.where("component_id is null").select("node", "root").distinct()
    lost = rows.where("id is null").select("row", "text").mapInArrow(nodes, shape).join(nameless, "node").dropDuplicates(["root"]).select("row")
    return stay.union(again).union(lost).select("row.*")
