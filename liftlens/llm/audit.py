"""Filter interaction audit: what each of five filters removes, in every order.

Failure conditions of a document (words: maximal runs of bytes other than
ASCII white space, as they are written):

    A  fewer than 200 words          B  100 * distinct words < 50 * words
    C  100 * letters A-Z > 3 * code points
    D  holds one of # $ % & * |      E  a smaller id has the same text

A document is a row of five bits, so a part of the table (a ``lang`` value) is
a game of five players: v(S), the number of documents that fail a filter of S,
is tabulated for all 32 coalitions. Every count of every order is a difference
of coalitions. The Shapley values are the solution of a least squares problem:
over the coalitions, weighted by the Shapley kernel, the additive function
closest to v that gives all five filters together v(all). Its normal equations
with that constraint are solved in rationals, so the values are exact; they are
reported times 120, the number of orders, which makes them integers.

Texts stay in the tasks that read them: what is shuffled is an id, a part, four
bits and the SHA-256 of the text. The first id of a text is a minimum with
map-side combine, joined back on (text, id), which spreads a large group of
copies over its ids; labels are joined as a written table, so that adaptive
execution may split a hot id. Texts are compared by their SHA-256.

Defined results: a NULL text is the empty text; a NULL ``lang`` is the part
``''``; a row without an id fails E never, makes no other row fail it, and has
no labels; repeated rows count each (the rows of the smallest id of a text do
not fail E); a document with several label rows is good or toxic if one says
so. An empty table has no parts and no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import table, text_bytes, written

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
SIGNS = b"#$%&*|"
#: Bytes of a long text whose words are counted at a time.
PIECE = 1 << 20

_N = len(FILTERS)
_ALL = (1 << _N) - 1
_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))
_WHITE = b" \t\n\v\f\r"


def word_counts(text: bytes) -> tuple[int, int]:
    """(words, distinct words); a long text is read in pieces that end at white space."""
    words, seen, at = 0, set(), 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in _WHITE:
            end += 1
        part = text[at:end].split()
        words += len(part)
        seen.update(part)
        at = end
    return words, len(seen)


def failures(text: bytes) -> int:
    """The filters A to D that a text fails, A as the lowest bit."""
    words, distinct = word_counts(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    failed = (words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words,
              100 * capitals > MOST_CAPITALS * points,
              len(text) != len(text.translate(None, SIGNS)))
    return sum(1 << i for i, f in enumerate(failed) if f)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        masks, keys = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            text = data[a:b].tobytes()
            masks.append(failures(text))
            keys.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(masks, pa.int32()), pa.array(keys, pa.binary())],
            names=["doc", "part", "mask", "key"])


def judged(docs: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "lang"
           ) -> DataFrame:
    """(doc, part, mask, key, n): the rows of each id, the filters A to D that they fail."""
    rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit(""))
                       .alias("part"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return (rows.mapInArrow(_judge, f"doc {kind}, part string, mask int, key binary")
            .groupBy("doc", "part", "mask", "key").agg(F.count(F.lit(1)).alias("n")))


def failure_counts(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text",
                   part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail."""
    rows = written(judged(docs, doc, text, part), "audit-rows")
    marks = written(labels.where(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("doc")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")), "audit-labels")
    with_id = rows.where("doc IS NOT NULL")
    first = (with_id.groupBy("key").agg(F.min("doc").alias("doc"))
             .withColumn("is_first", F.lit(True)))
    known = (with_id.join(marks, "doc", "left").join(first, ["key", "doc"], "left")
             .select("part", F.when(F.col("is_first"), F.col("mask"))
                     .otherwise(F.col("mask") + (1 << (_N - 1))).alias("mask"), "n",
                     F.when(F.col("is_good"), F.col("n")).otherwise(0).alias("good"),
                     F.when(F.col("is_toxic"), F.col("n")).otherwise(0).alias("toxic")))
    nameless = rows.where("doc IS NULL").select(
        "part", "mask", "n", F.lit(0).cast("long").alias("good"),
        F.lit(0).cast("long").alias("toxic"))
    return (known.unionByName(nameless).groupBy("part", "mask")
            .agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]))


# ------------------------------------------------------------------ the game

def coalition_removals(by_mask: dict[int, int]) -> list[int]:
    """v(S) for every set S of filters: documents that fail one of them."""
    return [sum(n for mask, n in by_mask.items() if mask & s) for s in range(1 << _N)]


def _inverse(matrix: list[list[Fraction]]) -> list[list[Fraction]]:
    n = len(matrix)
    rows = [[*row, *(Fraction(int(i == j)) for j in range(n))] for i, row in enumerate(matrix)]
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[n:] for row in rows]


class ShapleyRegression:
    """min sum w(S) (v(S) - sum of phi over S)**2 subject to sum of phi = v(all).

    w is the Shapley kernel over the coalitions other than none and all; the
    normal equations with the multiplier of the constraint are

        sum_j A_ij phi_j + lambda = b_i   (A_ij = sum of w(S) over S with i and j,
        sum_j phi_j = v(all)               b_i = sum of w(S) v(S) over S with i)
    """

    def __init__(self, players: int = _N):
        self.players = players
        self.weights = {s: Fraction(players - 1, comb(players, k) * k * (players - k))
                        for s in range(1, (1 << players) - 1) if (k := s.bit_count())}
        matrix = [[sum((w for s, w in self.weights.items() if s >> i & 1 and s >> j & 1),
                       Fraction(0)) for j in range(players)] + [Fraction(1)]
                  for i in range(players)]
        self.inverse = _inverse([*matrix, [Fraction(1)] * players + [Fraction(0)]])

    def solve(self, v: list[int]) -> list[Fraction]:
        right = [sum((w * v[s] for s, w in self.weights.items() if s >> i & 1), Fraction(0))
                 for i in range(self.players)] + [Fraction(v[-1])]
        return [sum((a * b for a, b in zip(row, right)), Fraction(0))
                for row in self.inverse[:self.players]]


def part_rows(counts: dict[int, tuple[int, int, int]], regression: ShapleyRegression
              ) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    v, good, toxic = (coalition_removals({m: c[i] for m, c in counts.items()}) for i in range(3))
    total = sum(c[0] for c in counts.values())
    shapley = []
    for value in regression.solve(v):
        value *= factorial(_N)
        if value.denominator != 1:
            raise ArithmeticError("a Shapley value times the number of orders is an integer")
        shapley.append(int(value))
    out = []
    for order in permutations(range(_N)):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = v[after] - v[before]
            out.append((name, step, total - v[after], removed, v[1 << i] - removed,
                        v[_ALL] - v[_ALL ^ 1 << i], good[after] - good[before],
                        toxic[after] - toxic[before], shapley[i]))
            before = after
    return out


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    regression = ShapleyRegression()
    for batch in batches:
        for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = part_rows({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks},
                             regression)
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.string()), pa.array(columns[0], pa.string()),
                 pa.array(columns[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in columns[2:]]],
                names=["part", "filter_order", "step", *_COUNTS])


def audit(counts: DataFrame) -> DataFrame:
    """600 rows for each part of ``failure_counts``: 120 orders of five steps."""
    parts = counts.groupBy("part").agg(  # at most 32 masks a part
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    schema = "part string, filter_order string, step int, " + ", ".join(
        f"{c} bigint" for c in _COUNTS)
    return parts.mapInArrow(_audit, schema)


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failure_counts(table(spark, sf_dir, "documents"),
                                table(spark, sf_dir, "labels")))


ORACLE_SQL = f"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
flags AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM docs
),
masks AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good,
         sum(coalesce(toxic, 0)) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY part, mask
),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(f, b)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31
),
steps AS (
  SELECT filter_order, s AS step, bits[s] AS own,
         CAST(coalesce(list_sum(bits[1:s - 1]), 0) AS INTEGER) AS earlier
  FROM orders, range(1, 6) AS r(s)
),
counted AS (
  SELECT m.part, s.filter_order, s.step, s.own,
    sum(CASE WHEN mask & (own | earlier) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks AS m, steps AS s GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _COUNTS[:-1])},
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted"""
