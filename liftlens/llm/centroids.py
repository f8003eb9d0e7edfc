"""Centroid clustering with equal-average equal-variance nearest neighbour search.

Vectors are quantised to integers. For two vectors of ``dim`` components with
component sums S and squared lengths Q, and V = sqrt(dim * Q - S * S),

    dim * distance**2 >= (S - S')**2 + (V - V')**2 .

Centroids are sorted by their component mean (S / dim). A vector looks at them
outward from its own mean; it stops where the means alone are too far apart
for the best distance found, leaves out those that the deviations reject, and
takes the exact integer distance to the others. The bounds are taken in
floating point with a margin on the side of keeping a centroid, so the result
is that of comparing with all centroids.

A round is one pass over the table: tasks assign their vectors and return sums
by cluster, which Spark adds; the driver holds the centroids and their sums (a
number fixed by parameters). Nothing is kept between rounds but the centroids,
so a lost executor costs the tasks it ran.

Integers of any size are exact: vectors with components beyond ``WIDE`` are
searched in Python's integers by the same bounds, and sums travel as digits of
``_DIGIT`` bits.

Defined results: vectors that are NULL, of another length, or that hold NULL or
non-finite components take no part. A row without an id is clustered but not
taken as a first centroid; repeated ids and rows count each (first centroids of
one hash: the smaller vector first). With fewer such rows than clusters there
are as many clusters as rows; without any there are no rows. A distance or a
sum of them beyond a long is NULL. Only the two named columns are read, so extra
columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import table, written

DIMENSION = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED_TEXT = "2:"
#: Components up to this size are searched in 64-bit integers.
WIDE = 1 << 24
_ROWS = 4_096
_DIGIT = 30
#: Share by which the bounds are widened; far above the rounding of doubles.
_MARGIN = 1e-9
_LONG = (1 << 63) - 1


def quantise(value: float, scale: int) -> int:
    """floor(scale * value), also where the product is no double."""
    product = scale * value
    return math.floor(product) if math.isfinite(product) else int(value) * scale


def _vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers of the vectors that take part, their components as doubles)."""
    valid = np.asarray(column.is_valid())
    rows = np.flatnonzero(valid & (np.asarray(pa.compute.list_value_length(column).fill_null(-1))
                                   == dim))
    if not len(rows):
        return rows, np.empty((0, dim))
    values = column.take(pa.array(rows)).flatten().cast(pa.float64())
    x = np.asarray(values.fill_null(np.nan)).reshape(-1, dim)
    finite = np.isfinite(x).all(axis=1)
    return rows[finite], x[finite]


def _shape(vector: list[int]) -> tuple[float, float]:
    """(S, V) of integers, as doubles (infinite where they do not fit)."""
    total, squares = sum(vector), sum(c * c for c in vector)
    try:
        return float(total), math.sqrt(len(vector) * squares - total * total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf, math.inf


def _apart(a, b):
    """A lower bound of |a - b| for values rounded to doubles."""
    return np.maximum(np.abs(a - b) - _MARGIN * (np.abs(a) + np.abs(b)), 0.0)


class Centroids:
    """Centroids by component mean, and the search for the nearest."""

    def __init__(self, vectors: list[list[int]]):
        shapes = [_shape(v) for v in vectors]
        self.order = sorted(range(len(vectors)), key=lambda i: (sum(vectors[i]), i))
        self.vectors = [vectors[i] for i in self.order]
        self.dim = len(vectors[0])
        self.sums = np.array([shapes[i][0] for i in self.order])
        self.deviations = np.array([shapes[i][1] for i in self.order])
        self.narrow = all(abs(c) <= WIDE for v in vectors for c in v)
        if self.narrow:
            self.matrix = np.array(self.vectors, np.int64)
        self.numbers = np.array(self.order, np.int64)

    def _outward(self, at: float) -> Iterator[int]:
        right = int(np.searchsorted(self.sums, at))
        left = right - 1
        while left >= 0 or right < len(self.sums):
            if right >= len(self.sums) or (left >= 0 and
                                           at - self.sums[left] <= self.sums[right] - at):
                yield left
                left -= 1
            else:
                yield right
                right += 1

    def nearest_exact(self, vector: list[int]) -> tuple[int, int]:
        """(centroid number, squared distance) in Python's integers."""
        total, deviation = _shape(vector)
        best, number = None, -1
        for i in self._outward(total):
            if best is not None:
                try:
                    limit = float(best) * self.dim * (1 + _MARGIN)
                except OverflowError:
                    limit = math.inf
                with np.errstate(all="ignore"):  # what is not finite rejects nothing
                    far = _apart(total, self.sums[i]) ** 2
                    if far > limit and math.isfinite(total):
                        break  # the means of all others are further away
                    if far + _apart(deviation, self.deviations[i]) ** 2 > limit and (
                            math.isfinite(deviation) and math.isfinite(self.deviations[i])):
                        continue
            distance = sum((a - b) ** 2 for a, b in zip(vector, self.vectors[i]))
            if best is None or (distance, self.order[i]) < (best, number):
                best, number = distance, self.order[i]
        return number, best

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid numbers, squared distances) of rows of components up to ``WIDE``."""
        if not self.narrow:
            found = [self.nearest_exact(row) for row in x.tolist()]
            return (np.array([n for n, _ in found], np.int64),
                    np.array([d for _, d in found], object))
        many, dim = len(self.vectors), self.dim
        total = x.sum(axis=1)
        deviation = np.sqrt((dim * (x * x).sum(axis=1) - total * total).astype(np.float64))
        total = total.astype(np.float64)
        best = np.full(len(x), _LONG, np.int64)
        number = np.full(len(x), -1, np.int64)
        right = np.searchsorted(self.sums, total)
        left = right - 1
        sums = np.concatenate([[-np.inf], self.sums, [np.inf]])  # centroid i stands at i + 1
        rows = np.arange(len(x))
        while len(rows):
            down, up = total[rows] - sums[left[rows] + 1], sums[right[rows] + 1] - total[rows]
            take_left = down <= up
            i = np.where(take_left, left[rows], right[rows])
            left[rows[take_left]] -= 1
            right[rows[~take_left]] += 1
            limit = best[rows].astype(np.float64) * (dim * (1 + _MARGIN))
            far = np.minimum(down, up) ** 2  # sums up to 2**30: their squares are exact enough
            going = far <= limit  # all others are further away; infinite: none is left
            rows, i, far, limit = rows[going], i[going], far[going], limit[going]
            near = far + _apart(deviation[rows], self.deviations[i]) ** 2 <= limit
            at, i = rows[near], i[near]
            step = x[at] - self.matrix[i]
            distance = np.einsum("ij,ij->i", step, step)
            better = (distance < best[at]) | ((distance == best[at])
                                              & (self.numbers[i] < number[at]))
            best[at[better]] = distance[better]
            number[at[better]] = self.numbers[i[better]]
        return number, best


def _assigned(column: pa.Array, centroids: Centroids, scale: int
              ) -> Iterator[tuple[np.ndarray, np.ndarray | list, np.ndarray, np.ndarray]]:
    """(rows, integer vectors, centroid numbers, squared distances) of parts of a batch."""
    rows, x = _vectors(column, centroids.dim)
    with np.errstate(over="ignore"):
        whole = np.floor(x * scale)
    fits = (np.abs(whole) <= WIDE).all(axis=1)
    for low in range(0, len(rows), _ROWS):
        part = fits[low:low + _ROWS]
        at, v = rows[low:low + _ROWS][part], whole[low:low + _ROWS][part].astype(np.int64)
        if len(at):
            yield at, v, *centroids.nearest(v)
    for at, v in zip(rows[~fits], x[~fits].tolist()):
        vector = [quantise(c, scale) for c in v]
        number, distance = centroids.nearest_exact(vector)
        yield np.array([at]), [vector], np.array([number]), np.array([distance], object)


def _sum_batches(vectors: list[list[int]], scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(vectors)
        many, dim = len(vectors), centroids.dim
        sums = np.zeros((many, dim), np.int64)  # of less than 2**38 vectors a task
        counts = np.zeros(many, np.int64)
        wide: dict[int, list[int]] = {}
        for batch in batches:
            for _, v, number, _ in _assigned(batch.column(0), centroids, scale):
                counts += np.bincount(number, minlength=many)
                if isinstance(v, np.ndarray):
                    order = np.argsort(number, kind="stable")
                    present, first = np.unique(number[order], return_index=True)
                    sums[present] += np.add.reduceat(v[order], first, axis=0)
                else:
                    old = wide.get(int(number[0]), [0] * dim)
                    wide[int(number[0])] = [a + b for a, b in zip(old, v[0])]
        out: list[tuple[int, int, int, int]] = []
        for c in np.flatnonzero(counts).tolist():
            out.append((c, -1, 0, int(counts[c])))
            for d in range(dim):
                value, digit = int(sums[c, d]) + (wide[c][d] if c in wide else 0), 0
                while value:  # digits of _DIGIT bits, each with the sign of the whole
                    rest = (abs(value) & ((1 << _DIGIT) - 1)) * (1 if value > 0 else -1)
                    out.append((c, d, digit, rest))
                    value, digit = (value - rest) >> _DIGIT, digit + 1
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
             pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())],
            names=["cluster", "component", "digit", "value"])
    return run


def moved(embeddings: DataFrame, vectors: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids after one round; a centroid without vectors stays."""
    sums = embeddings.mapInArrow(_sum_batches(vectors, scale),
                                 "cluster int, component int, digit int, value bigint")
    rows = (sums.groupBy("cluster", "component", "digit")
            .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    counts = {r.cluster: int(r.value) for r in rows if r.component < 0}
    out = [[0] * len(v) if c in counts else list(v) for c, v in enumerate(vectors)]
    for r in rows:
        if r.component >= 0:
            out[r.cluster][r.component] += int(r.value) << (_DIGIT * r.digit)
    return [[s // counts[c] for s in v] if c in counts else v for c, v in enumerate(out)]


def _takes_part(vector: str, dim: int):
    return (F.size(vector) == dim) & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))


def first_centroids(embeddings: DataFrame, clusters: int, scale: int, dim: int, vec: str,
                    vector: str) -> list[list[int]]:
    """The vectors with the smallest hashes of ``2:<id>``, as integers."""
    digest = F.sha2(F.concat(F.lit(SEED_TEXT), F.col(vec).cast("string")).cast("binary"), 256)
    doubles = F.col(vector).cast("array<double>")
    rows = (embeddings.where(F.col(vec).isNotNull()).select(doubles.alias("v"), digest.alias("h"))
            .where(_takes_part("v", dim)).orderBy("h", "v").limit(clusters).collect())
    return [[quantise(c, scale) for c in r.v] for r in rows]


def _place_batches(vectors: list[list[int]], scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(vectors)
        for batch in batches:
            for rows, _, number, distance in _assigned(batch.column(1), centroids, scale):
                long = [int(d) if d <= _LONG else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(number, pa.int32()),
                     pa.array(long, pa.int64())], names=["vec", "cluster", "distance"])
    return run


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            scale: int = SCALE, dim: int = DIMENSION, vec: str = "vec_id",
            vector: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """((vec, cluster, distance) of every vector that takes part, final centroids)."""
    kind = embeddings.schema[vec].dataType.simpleString()
    schema = f"`{vec}` {kind}, cluster int, distance bigint"
    vectors = first_centroids(embeddings, clusters, scale, dim, vec, vector)
    if not vectors:
        return embeddings.sparkSession.createDataFrame([], schema), []
    for _ in range(rounds):
        vectors = moved(embeddings.select(vector), vectors, scale)
    placed = embeddings.select(vec, vector).mapInArrow(_place_batches(vectors, scale),
                                                       schema.replace(f"`{vec}`", "vec", 1))
    return placed.withColumnRenamed("vec", vec), vectors


def centroid_digest(vector: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, vector)).encode()).hexdigest()


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, vectors = cluster(table(spark, sf_dir, "embeddings"))
    placed = written(placed, "centroids")
    wide = F.col("distance").cast("decimal(38,0)")
    # sums of at most one row a cluster; a NULL distance makes its sums NULL
    sums = (placed.groupBy("cluster").agg(
        F.when(F.count("distance") == F.count(F.lit(1)), F.sum(wide)).alias("s")).collect())
    by_cluster = {r.cluster: r.s for r in sums}
    whole = None if None in by_cluster.values() else sum(by_cluster.values())
    rows = [(c, int(s) if s is not None and s <= _LONG else None, centroid_digest(vectors[c]))
            for c, s in by_cluster.items()]
    totals = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    return (placed.join(F.broadcast(totals), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia",
                    F.lit(int(whole) if whole is not None and whole <= _LONG else None)
                    .cast("long").alias("inertia"), "centroid_sha256"))


def _oracle_rounds() -> str:
    """Common table expressions near0 .. nearR and c0 .. cR."""
    near = """
near{r} AS MATERIALIZED (
  SELECT rid, c, d FROM (
    SELECT x.rid, m.c, sum((x.x - m.x) * (x.x - m.x)) AS d
    FROM comps AS x JOIN c{r} AS m ON x.i = m.i GROUP BY x.rid, m.c)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)"""
    after = """
c{n} AS MATERIALIZED (
  SELECT m.c, m.i, CASE WHEN s.n IS NULL THEN m.x
    ELSE (s.total - ((s.total % s.n) + s.n) % s.n) // s.n END AS x
  FROM c{r} AS m LEFT JOIN (
    SELECT a.c, x.i, sum(x.x) AS total, count(*) AS n
    FROM near{r} AS a JOIN comps AS x ON x.rid = a.rid GROUP BY a.c, x.i) AS s
  ON s.c = m.c AND s.i = m.i)"""
    steps = []
    for r in range(ROUNDS):
        steps += [near.format(r=r), after.format(r=r, n=r + 1)]
    return ",".join([*steps, near.format(r=ROUNDS)])


ORACLE_SQL = f"""
WITH flat AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIMENSION}
),
parts AS (
  SELECT rid, vec_id, unnest(range(1, {DIMENSION} + 1)) AS i,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM flat
),
kept AS MATERIALIZED (
  SELECT rid, vec_id FROM parts GROUP BY rid, vec_id
  HAVING count(x) = {DIMENSION} AND bool_and(isfinite(x))
),
comps AS MATERIALIZED (
  SELECT rid, i, CAST(floor({SCALE} * x) AS BIGINT) AS x FROM parts WHERE rid IN (SELECT rid FROM kept)
),
firsts AS (
  SELECT k.rid, row_number() OVER (
    ORDER BY sha256('{SEED_TEXT}' || CAST(k.vec_id AS VARCHAR)), f.embedding) - 1 AS c
  FROM kept AS k JOIN flat AS f ON f.rid = k.rid WHERE k.vec_id IS NOT NULL
  QUALIFY c < {CLUSTERS}
),
c0 AS MATERIALIZED (SELECT f.c, x.i, x.x FROM firsts AS f JOIN comps AS x ON x.rid = f.rid),
{_oracle_rounds()},
digests AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM c{ROUNDS} GROUP BY c
)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, g.centroid_sha256
FROM near{ROUNDS} AS a JOIN kept AS k ON k.rid = a.rid JOIN digests AS g ON g.c = a.c"""
