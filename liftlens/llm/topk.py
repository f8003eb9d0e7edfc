"""Exact top-k search by inner product on a bit-sliced index.

Vectors are quantised to integers. A block of rows keeps, for every component,
one bitmap for each binary digit but the lowest (``DROPPED_BITS``). A query's
approximate scores of a whole block are sums of these bitmaps, added by
carry-save adders on bitmaps: digit ``b`` of component ``d`` is added at
position ``b + j`` for each set digit ``j`` of the query's component, and a
negative component adds the complements. The sums are bit slices again; the
k-th largest is found from the most significant slice downward. The dropped
digits bound the error of every score, so the rows that can be among the k
largest (the boundary rows) are those within that bound of the k-th; only they
are scored exactly.

Queries and rows meet in blocks: every block of queries with every block of
rows, spread over the cluster; each pair returns at most k rows a query.

Vectors with a component beyond ``_LARGEST`` have no bitmaps. They form blocks
of their own, whose scores (and those of other vectors with them) are taken in
extended precision with an error bound; the rows that can be among the k
largest are scored exactly in Python's integers. A score beyond a long has its
exact rank and is reported as NULL.

Defined results: vectors that are NULL or empty, or that hold NULL or non-finite
components, and rows without an id take no part; vectors are compared with vectors of the same length; rows that carry
the query's own id are its own; ties go to the smaller id, and repeated rows
each count. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftlens.llm.common import blocks_of, table

K = 20
SCALE = 64
QUERY_EVERY = 20
ROWS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 1_024
#: Lowest binary digits left out of the bitmaps.
DROPPED_BITS = 1
_LARGEST = 1 << 26
_LONG = 1 << 63

_BLOCK = "block int, dim int, wide boolean, ids binary, vectors binary"
_FOUND = ("query_id bigint, query_no bigint, vec_id bigint, score bigint, beyond int, "
          "magnitude binary")


def _quantised(batches: Iterator[pa.RecordBatch], scale: int
               ) -> dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]:
    """By vector length and width: ids and vectors of the rows that take part.

    Integer vectors, or where a component is too large for them (wide) the given ones.
    """
    found: dict[tuple[int, bool], list] = {}
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        keep = np.asarray(ids.is_valid()) & np.asarray(vectors.is_valid())
        batch = batch.filter(pa.array(keep))
        ids, vectors = np.asarray(batch.column(0), np.int64), batch.column(1)
        values = np.asarray(vectors.values.cast(pa.float64()).fill_null(np.nan))
        offsets = np.asarray(vectors.offsets, np.int64)
        length = np.diff(offsets)
        for dim in np.unique(length[length > 0]):
            rows = np.flatnonzero(length == dim)
            x = values[offsets[rows][:, None] + np.arange(dim)]
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(x * scale)
                fits = (np.abs(whole) <= _LARGEST).all(axis=1)  # False for NaN
            wide = ~fits & np.isfinite(x).all(axis=1)
            for mine, values_of in ((fits, whole), (wide, x)):
                if mine.any():
                    kind = np.int32 if mine is fits else np.float64
                    found.setdefault((int(dim), mine is wide), []).append(
                        (ids[rows][mine], values_of[mine].astype(kind)))
    return {kind: (np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]))
            for kind, parts in found.items()}


def _as_blocks(scale: int, per_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for (dim, wide), (ids, vectors) in _quantised(batches, scale).items():
            for at in range(0, len(ids), per_block):
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([dim], pa.int32()),
                    pa.array([wide], pa.bool_()),
                    pa.array([ids[at:at + per_block].tobytes()], pa.binary()),
                    pa.array([vectors[at:at + per_block].tobytes()], pa.binary()),
                ], names=["block", "dim", "wide", "ids", "vectors"])
    return run


class BitSlicedBlock:
    """Bitmaps of the binary digits of the components of a block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors.astype(np.int64)
        self.low = vectors.min(axis=0).astype(np.int64)
        raised = (self.vectors - self.low) >> DROPPED_BITS
        self.bits = max(1, int(raised.max()).bit_length())
        rows, dim = raised.shape
        words = -(-rows // 64)
        self.slices = np.zeros((2, dim, self.bits, words), np.uint64)
        packed = np.zeros((dim, words * 8), np.uint8)
        for b in range(self.bits):
            bit = ((raised >> b) & 1).astype(np.uint8).T
            packed[:, :-(-rows // 8)] = np.packbits(bit, axis=1, bitorder="little")
            self.slices[0, :, b] = packed.view(np.uint64)
        self.slices[1] = ~self.slices[0]
        valid = np.zeros(words * 8, np.uint8)
        valid[:-(-rows // 8)] = np.packbits(np.ones(rows, np.uint8), bitorder="little")
        self.valid = valid.view(np.uint64)

    def approximate(self, query: np.ndarray) -> list[np.ndarray]:
        """Bit slices of sum |q_d| * digits_d, complemented where q_d is negative."""
        size, sign = np.abs(query), (query < 0).astype(np.int64)
        top = int(size.max()).bit_length()
        columns: list[list[np.ndarray]] = [[] for _ in range(self.bits + top)]
        for j in range(top):
            d = np.flatnonzero((size >> j) & 1)
            if len(d):
                chosen = self.slices[sign[d], d]
                for b in range(self.bits):
                    columns[b + j].append(chosen[:, b])
        out, c = [], 0
        while c < len(columns):
            parts = columns[c]
            column = (np.concatenate(parts) if parts
                      else np.zeros((1, self.slices.shape[-1]), np.uint64))
            while len(column) > 1:
                third = len(column) // 3
                if third:
                    x, y, z = (column[:third], column[third:2 * third],
                               column[2 * third:3 * third])
                    either = x ^ y
                    carry = (x & y) | (either & z)
                    column = np.concatenate([either ^ z, column[3 * third:]])
                else:
                    carry = column[:1] & column[1:]
                    column = column[:1] ^ column[1:]
                if c + 1 == len(columns):
                    columns.append([])
                columns[c + 1].append(carry)
            out.append(column[0])
            c += 1
        return out

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows, best first, ties to the smaller id."""
        query = query.astype(np.int64)
        open_rows = self.valid.copy()
        for row in np.flatnonzero(self.ids == own):
            open_rows[row >> 6] &= ~np.uint64(1 << (int(row) & 63))
        if query.any():
            slices = self.approximate(query)
            spread = ((1 << DROPPED_BITS) - 1) * int(np.abs(query).sum())
            bound = _kth(slices, open_rows, k) - (spread >> DROPPED_BITS)
            rows = _bits(_at_least(slices, open_rows, bound))
        else:
            rows = _bits(open_rows)
        scores = self.vectors[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[best], scores[best]


class WideBlock:
    """A block of rows searched without bitmaps, for components of any size.

    Integer values of doubles are exact in extended precision; so are products
    of two up to its rounding, and nothing overflows.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.sizes = ids, vectors, np.abs(vectors)
        self.slack = np.longdouble(len(vectors[0]) + 2) * np.finfo(np.longdouble).eps

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list[int]]:
        """Row numbers and scores of the k best rows, best first, ties to the smaller id."""
        rows = np.flatnonzero(self.ids != own)
        score = self.vectors[rows] @ query
        error = (self.sizes[rows] @ np.abs(query)) * self.slack
        if len(rows) > k:
            least = np.partition(score - error, len(rows) - k)[len(rows) - k]
            keep = score + error >= least
            rows = rows[keep]
        exact = [int(x) for x in query.tolist()]
        scored = sorted(
            (-sum(a * int(b) for a, b in zip(exact, self.vectors[r].tolist())), int(self.ids[r]), r)
            for r in rows.tolist())[:k]
        return np.array([r for _, _, r in scored], np.int64), [-s for s, _, _ in scored]


def _extended(vectors: bytes, dim: int, wide: bool, scale: int) -> np.ndarray:
    """Integer values in extended precision."""
    values = np.frombuffer(vectors, np.float64 if wide else np.int32).reshape(-1, dim)
    values = values.astype(np.longdouble)
    return np.floor(values * scale) if wide else values


def _beyond(score: int) -> tuple[int, bytes | None]:
    """(sign, sortable bytes) of a score that is no long; (0, None) of one that is."""
    if -_LONG <= score < _LONG:
        return 0, None
    size = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    size = len(size).to_bytes(4, "big") + size
    return (1, size) if score > 0 else (-1, bytes(255 - b for b in size))


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _bits(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _kth(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest value among the rows (0 if there are no more than k rows)."""
    if _count(rows) <= k:
        return 0
    value, equal = 0, rows
    for c in range(len(slices) - 1, -1, -1):
        ones = equal & slices[c]
        n = _count(ones)
        if n >= k:
            value, equal = value | (1 << c), ones
        else:
            k -= n
            equal = equal & ~slices[c]
    return value


def _at_least(slices: list[np.ndarray], rows: np.ndarray, bound: int) -> np.ndarray:
    """Bitmap of the rows whose value is at least the bound."""
    if bound <= 0:
        return rows
    above, equal = np.zeros_like(rows), rows
    for c in range(len(slices) - 1, -1, -1):
        if (bound >> c) & 1:
            equal = equal & slices[c]
        else:
            above |= equal & slices[c]
            equal = equal & ~slices[c]
    return above | equal


def _search(k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qblock, dim, qwide, qids, queries, wide, ids, vectors = (
                    c[i].as_py() for c in batch.columns)
                ids = np.frombuffer(ids, np.int64)
                if wide or qwide:
                    index = WideBlock(ids, _extended(vectors, dim, wide, scale))
                    queries = _extended(queries, dim, qwide, scale)
                else:
                    index = BitSlicedBlock(ids, np.frombuffer(vectors, np.int32).reshape(-1, dim))
                    queries = np.frombuffer(queries, np.int32).reshape(-1, dim)
                out: list[list[np.ndarray]] = [[], [], []]
                scored: list[int] = []
                for number, (own, query) in enumerate(
                        zip(np.frombuffer(qids, np.int64), queries, strict=True)):
                    rows, scores = index.top(query, int(own), k)
                    out[0].append(np.full(len(rows), own, np.int64))
                    out[1].append(np.full(len(rows), (qblock << 40) + (dim << 20) + 2 * number
                                          + qwide, np.int64))
                    out[2].append(ids[rows])
                    scored += [int(s) for s in scores]
                beyond = [_beyond(s) for s in scored]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.concatenate(x), pa.int64()) for x in out],
                     pa.array([None if b else s for s, (b, _) in zip(scored, beyond)], pa.int64()),
                     pa.array([b for b, _ in beyond], pa.int32()),
                     pa.array([m for _, m in beyond], pa.binary())],
                    names=["query_id", "query_no", "vec_id", "score", "beyond", "magnitude"])
    return run


def top_k(queries: DataFrame, rows: DataFrame, k: int = K, id_col: str = "vec_id",
          vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows by integer inner product."""
    n_rows = blocks_of(rows.count(), ROWS_PER_BLOCK)
    n_queries = blocks_of(queries.count(), QUERIES_PER_BLOCK)

    def blocks(frame: DataFrame, n: int, per_block: int) -> DataFrame:
        frame = frame.select(F.col(id_col).cast("long"), F.col(vector)).repartition(n)
        return frame.mapInArrow(_as_blocks(scale, 2 * per_block), _BLOCK)

    # a number for every block of rows; blocks of one length of vectors meet
    spread = min(4 * n_rows * n_queries, 20_000)
    left = (blocks(queries, n_queries, QUERIES_PER_BLOCK)
            .select(F.col("block").alias("query_block"), "dim", F.col("wide").alias("query_wide"),
                    F.col("ids").alias("query_ids"),
                    F.col("vectors").alias("query_vectors"),
                    F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("block"))
            .repartition(spread, "query_block", "block", "dim"))
    right = (blocks(rows, n_rows, ROWS_PER_BLOCK)
             .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
             .repartition(spread, "query_block", "block", "dim"))
    found = (left.join(right, ["query_block", "block", "dim"])
             .select("query_block", "dim", "query_wide", "query_ids", "query_vectors", "wide", "ids",
                     "vectors")
             .mapInArrow(_search(k, scale), _FOUND))
    order = Window.partitionBy("query_id", "query_no").orderBy(
        F.desc("beyond"), F.desc("magnitude"), F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows.where(F.col("vec_id") % QUERY_EVERY == 0), rows)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, r.e)]) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 20 = 0 AND r.vec_id <> q.vec_id AND len(r.e) = len(q.e)),
t AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 20
"""
