"""Maximum inner product search by score-aware (anisotropic) quantisation, four-bit table scans and exact reranking.

A vector is cut into subspaces of a few dimensions with 16 centroids each; further layers of the same form code what the
layers before them leave. The quantisation loss weighs the residual parallel to the vector by ``eta`` = (d - 1) t^2 /
(1 - t^2) times the orthogonal one, since only the parallel part moves large inner products. Codebooks and codes both
minimise that loss by coordinate descent. A query scans the packed four-bit codes of the first layer with its table of 16
partial products a subspace. The exact double products of a block's best rows so far bound what is in reach: a row stays
while its rough score and the bound of its error (the residual's length and the rounding of the sum, times the query's
length) reach them. Rows that stay go on to the next layer, those that stay after the last are reranked exactly. No row
that belongs to the result is cut off, however many have nearly equal codes.

Scale: codebooks (fixed size) are fitted on a bounded sample and broadcast; every row is coded. Rows form blocks of
about ``block_rows``; packed queries travel to every block by an equi-join on the block's number, so no pair of rows
is a row of a table; a block returns its 20 best a query, cut to the best 20 before the final shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbria.llm.common import cut

TOP, RERANK, SAMPLE_ROWS, BLOCK_ROWS, QUERY_ROWS, SUBSPACE, LAYERS, THRESHOLD = 20, 32, 8192, 4096, 512, 2, 3, 0.2


@dataclass
class Quantiser:
    """Codebooks (layers, subspaces, 16, width), each layer for what the ones before it leave, and the parallel residual's weight."""

    books: np.ndarray
    eta: float

    def split(self, x: np.ndarray) -> np.ndarray:
        spaces, _, width = self.books.shape[1:]
        return np.pad(x, ((0, 0), (0, spaces * width - x.shape[1]))).reshape(len(x), spaces, width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (layers, rows, subspaces) of rows ``x`` and, for each layer, a bound (layers, rows) of how far the inner product
        of the layers so far may lie from the true one, as a share of the query's length: what is left of the row, and
        the rounding of sums of table entries in single precision, whose number is that of the subspaces."""
        left, codes, errors = self.split(x), [], []
        unit, taken = left / np.linalg.norm(x, axis=1)[:, None, None], np.zeros(len(x))
        for depth, book in enumerate(self.books):
            codes.append(_codes(left, unit, book, self.eta))
            part = book[np.arange(len(book)), codes[-1]]
            left, taken = left - part, taken + np.sqrt((part**2).sum((1, 2)))
            errors.append(np.sqrt((left**2).sum((1, 2))) + taken * ((depth + 1) * (len(book) + 4) * 2.0**-23))
        return np.stack(codes), np.stack(errors)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Partial products (layers, queries, subspaces, 16)."""
        return np.einsum("nmw,lmcw->lnmc", self.split(queries), self.books).astype(np.float32)


def _codes(parts: np.ndarray, unit: np.ndarray, book: np.ndarray, eta: float, rounds: int = 2) -> np.ndarray:
    """Nearest centroids, then coordinate descent on the anisotropic loss; in pieces of some 16 MB."""
    out, step = [], max(1, (1 << 20) // book[..., 0].size)
    for first in range(0, len(parts), step):
        p, u = parts[first : first + step], unit[first : first + step]
        square = ((p**2).sum(-1)[:, :, None] - 2 * np.einsum("nmw,mcw->nmc", p, book)) + (book**2).sum(-1)
        along = (p * u).sum(-1)[:, :, None] - np.einsum("nmw,mcw->nmc", u, book)
        codes, rows = square.argmin(-1), np.arange(len(p))
        total = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0].sum(1)
        for m in list(range(len(book))) * rounds:
            rest = total - along[rows, m, codes[:, m]]
            codes[:, m] = (square[:, m] + (eta - 1) * (rest[:, None] + along[:, m]) ** 2).argmin(1)
            total = rest + along[rows, m, codes[:, m]]
        out.append(codes.astype(np.uint8))
    return np.concatenate(out)


def _book(parts: np.ndarray, unit: np.ndarray, eta: float, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """One layer's codebooks: alternate codes and the closed-form centroid of each code."""
    spaces, width = parts.shape[1:]
    book = parts[rng.choice(len(parts), 16, replace=len(parts) < 16)].transpose(1, 0, 2).copy()
    for _ in range(rounds):
        codes = _codes(parts, unit, book, eta, 1)
        total = ((parts - book[np.arange(spaces), codes]) * unit).sum((1, 2))
        for m in range(spaces):
            own, u, code = parts[:, m], unit[:, m], codes[:, m]
            along = ((own - book[m][code]) * u).sum(1)
            aim = own + (eta - 1) * u * ((total - along) + (own * u).sum(1))[:, None]
            for c in range(16):
                held = code == c
                if held.sum() > width:
                    a = np.eye(width) * held.sum() + (eta - 1) * u[held].T @ u[held]
                    book[m, c] = np.linalg.solve(a, aim[held].sum(0))
            total += ((own - book[m][code]) * u).sum(1) - along
    return book


def fit(x: np.ndarray, width: int = SUBSPACE, layers: int = LAYERS, threshold: float = THRESHOLD, rounds: int = 4, seed: int = 7) -> Quantiser:
    """Codebooks from sample rows ``x`` (no zero rows)."""
    d = x.shape[1]
    spaces, rng = -(-d // width), np.random.default_rng(seed)
    made = Quantiser(np.zeros((layers, spaces, 16, width)), max(1.0, (d - 1) * threshold**2 / (1 - threshold**2)))
    left = made.split(x)
    unit = left / np.linalg.norm(x, axis=1)[:, None, None]
    for depth in range(layers):
        made.books[depth] = _book(left, unit, made.eta, rounds, rng)
        left = left - made.books[depth][np.arange(spaces), _codes(left, unit, made.books[depth], made.eta)]
    return made


def nearest(q: Quantiser, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, errors: np.ndarray, asked_ids: np.ndarray, asked: np.ndarray, top: int = TOP, rerank: int = RERANK):
    """For each query (its id, positions of its best rows in order, their exact scores, how many exact products that took).

    The first layer's codes are scanned for all rows, each further layer's for the rows that are still in reach; the exact
    scores of the best by rough score say what is in reach. Nothing that belongs to the result is cut off."""
    for first in range(0, len(asked_ids), 64):
        own, qx = asked_ids[first : first + 64], asked[first : first + 64]
        tables, lengths = q.tables(qx), np.linalg.norm(qx, axis=1)
        scanned = np.zeros((len(own), len(ids)), np.float32)
        for m in range(tables.shape[2]):
            scanned += tables[0, :, m].take(codes[0, :, m], axis=1)
        for i, me in enumerate(own):
            close = np.flatnonzero(ids != me)
            rough, known, least = scanned[i, close], np.full(len(ids), np.nan), -np.inf
            for depth in range(len(codes)):
                if depth:
                    rough = rough + tables[depth, i][np.arange(tables.shape[2]), codes[depth][close]].sum(axis=1)
                most = min(rerank, len(close))
                best = close[np.argpartition(-rough, most - 1)[:most]] if most else close
                new = best[np.isnan(known[best])]
                known[new] = (x[new] * qx[i]).sum(axis=1)
                if most >= top:
                    least = max(least, np.sort(known[best])[-top])
                near = rough + errors[depth, close] * lengths[i] >= least
                close, rough = close[near], rough[near]
            new = close[np.isnan(known[close])]
            known[new] = (x[new] * qx[i]).sum(axis=1)
            best = close[np.lexsort((ids[close], -known[close]))[:top]]
            yield me, best, known[best], int((~np.isnan(known)).sum())


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part: no null, zero or non-finite components, of one length."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, top: int = TOP, rerank: int = RERANK, block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the ``top`` rows, itself apart, of
    largest inner product found, nearest first, ties to the smaller id; score is exact in double precision.

    Rows with null ids or with vectors that are null, empty, zero, or hold null or non-finite components take no part;
    neither do rows whose length is not the table's commonest (of equally common ones the shortest). Rows that repeat an id
    are candidates each once and queries once; a query is never its own candidate, by id. Other columns are not read. An
    empty table gives no rows. A block is about ``block_rows`` rows, so its size grows with the vectors' length alone.
    """
    spark = vectors.sparkSession
    rows = cut(usable(vectors, id_col, vector_col))
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], empty)
    rows = rows.where(F.size("v") == common.n)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toPandas()["v"]  # bounded by sample_rows
    books = spark.sparkContext.broadcast(fit(np.stack(list(sample))))  # spaces * 16 * width doubles
    blocks = max(1, -(-common["count"] // block_rows))
    queries = rows.where(F.col("id") % every == 0).dropDuplicates(["id"])
    groups = max(1, -(-queries.count() // QUERY_ROWS))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = books.value.encode(_matrix(batch.column(2)))
            packed = np.pad(codes, ((0, 0), (0, 0), (0, codes.shape[2] % 2)))
            packed = (packed[..., ::2] | packed[..., 1::2] << 4).transpose(1, 0, 2)  # a row's layers one after the other
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(list(errors.T))], names=["block", "id", "v", "code", "error"])

    dealt = rows.select(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"), "id", "v")
    index = dealt.mapInArrow(coded, "block int, id bigint, v array<double>, code binary, error array<double>")
    index = index.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("id", "code", "v", "error"))).alias("rows"))  # about block_rows each
    asked = queries.groupBy(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).alias("g")).agg(F.collect_list(F.struct("id", "v")).alias("queries"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = books.value
        for batch in batches:
            for r in range(batch.num_rows):
                held, queries = batch.column(0)[r].values, batch.column(1)[r].values
                ids, x, errors = held.field("id").to_numpy(), _matrix(held.field("v")), _matrix(held.field("error")).T
                raw = np.frombuffer(b"".join(held.field("code").to_pylist()), np.uint8).reshape(len(ids), len(q.books), -1).transpose(1, 0, 2)
                codes = np.stack([raw & 15, raw >> 4], axis=3).reshape(*raw.shape[:2], -1)[..., : q.books.shape[1]]
                asked_ids, asked_x = queries.field("id").to_numpy(), _matrix(queries.field("v"))
                out = [(np.full(len(best), me), ids[best], score) for me, best, score, _ in nearest(q, ids, x, codes, errors, asked_ids, asked_x, top, rerank)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    found = index.join(asked, "block").select("rows", "queries").mapInArrow(scan, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
