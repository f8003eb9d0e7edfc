"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is 13 consecutive words of a benchmark item (an item of fewer words
is one window). Of the hashes of all runs of 4 words, the smallest in every 10
consecutive ones is kept as a fingerprint, on both sides. Two texts that share
13 words share the 10 runs of 4 in them and so keep a common fingerprint: no
shared window is missed. Documents that share a fingerprint are read again,
the runs that carry it are extended to all windows around them, and these are
compared word by word with the benchmark's windows. Items of fewer than 13
words are looked up by the hash of all their words.

Defined results: a NULL or empty text has no words, is never hit and lists no
items; an empty benchmark hits nothing; an item with a NULL id still hits but
is not listed; repeated items count once; copies of a text are searched once
and each row gets the result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import ascii_lower, table, written

WINDOW = 13
RUN = 4
#: Fingerprints of the benchmark up to which they are broadcast (16 MB); more are joined by shuffle.
BROADCAST_FINGERPRINTS = 1_000_000
#: Texts that share a fingerprint, up to which their keys are broadcast (about 20 MB).
BROADCAST_TEXTS = 200_000
#: Words of a document whose hits are counted together.
PIECE = 512

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(lowered: Column) -> Column:
    """Array of the words of a lower-case text (empty for NULL)."""
    parts = F.split(F.coalesce(lowered, F.lit("")), _NOT_WORD)
    # only the first and the last part can be empty
    skip = (F.element_at(parts, 1) == "").cast("int")
    drop = F.when(F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("int")).otherwise(0)
    return F.slice(parts, skip + 1, F.greatest(F.size(parts) - skip - drop, F.lit(0)))


def _runs(words: Column, length: int) -> Column:
    """Hash of every run of ``length`` words, by start position."""
    count = F.size(words) - (length - 1)
    return F.when(count > 0, F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(length)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _winnowed(runs: Column, window: int, run: int) -> Column:
    """The distinct minima of all windows of runs (none if the text has no whole window)."""
    per_window = window - run + 1
    count = F.size(runs) - (per_window - 1)
    return F.when(count > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_min(F.slice(runs, i, per_window))))
    ).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Distinct windows: window text, its number of words, and the ids of its items."""
    words = benchmark.select(F.col(item).alias("_item"),
                             words_of(ascii_lower(F.col(text))).alias("_words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - (window - 1), F.lit(1)))
    return (words.where(F.size("_words") > 0)
            .withColumn("_start", F.explode(starts))
            .select("_item", F.slice("_words", F.col("_start"), window).alias("_span"))
            .groupBy(F.array_join("_span", " ").alias("window"), F.size("_span").alias("length"))
            .agg(F.array_sort(F.collect_set("_item")).alias("items")))


def _lookup(frame: DataFrame, rows: int, most: int) -> DataFrame:
    return F.broadcast(frame) if rows <= most else frame


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id",
                  text: str = "text", item: str = "item_id", window: int = WINDOW,
                  run: int = RUN) -> DataFrame:
    """One row per document: doc, n_words, n_hit, n_items, items_sha256, contaminated, text_sha256.

    ``contaminated``: at least one word in twenty is hit.
    """
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark, item, text, window)
    short = sorted(r[0] for r in windows.where(F.col("length") < window)
                   .select("length").distinct().collect())  # lengths below the window's
    parts = F.split("window", " ")
    fingerprints = written(
        windows.select(
            "length",
            F.explode(F.when(F.col("length") == window,
                             F.array(F.array_min(_runs(parts, run))))
                      .otherwise(F.array(_hash_all(parts, window)))).alias("fingerprint"))
        .distinct(), "benchmark-fingerprints")
    known = _lookup(fingerprints.select("fingerprint").distinct(), fingerprints.count(),
                    BROADCAST_FINGERPRINTS)

    # Every text once over: words counted, fingerprints kept.
    marks = [_winnowed(F.col("_runs"), window, run)]
    marks += [F.array_distinct(_runs(F.col("_words"), n)) for n in short]
    scanned = written(
        docs.select(F.col(doc).alias("_doc"), F.sha2(F.col(text).cast("binary"), 256).alias("_key"),
                    words_of(ascii_lower(F.col(text))).alias("_words"))
        .select("_doc", "_key", "_words", _runs(F.col("_words"), run).alias("_runs"))
        .select("_doc", "_key", F.size("_words").cast("long").alias("n_words"),
                (F.array_distinct(F.concat(*marks)) if short else marks[0]).alias("_marks")),
        "document-fingerprints")
    found = written(scanned.select("_key", F.explode("_marks").alias("fingerprint"))
                    .join(known, "fingerprint", "left_semi")
                    .groupBy("_key").agg(F.collect_set("fingerprint").alias("_found")),
                    "shared-fingerprints")

    # The texts that share a fingerprint, each once: extend hits to windows. Only these
    # texts are shuffled, unless there are too many to look their keys up in every task.
    few = _lookup(found.select("_key"), found.count(), BROADCAST_TEXTS)
    again = (docs.select(F.sha2(F.col(text).cast("binary"), 256).alias("_key"),
                         F.col(text).alias("_text"))
             .join(few, "_key", "left_semi")
             .groupBy("_key").agg(F.first("_text").alias("_text"))
             .join(found, "_key")
             .select("_key", "_found", words_of(ascii_lower(F.col("_text"))).alias("_words")))
    spans = [_around(F.col("_words"), F.col("_found"), window, run)]
    spans += [_around(F.col("_words"), F.col("_found"), n, n) for n in short]
    candidates = (again.select("_key", F.explode(F.transform(
        F.concat(*spans), lambda s: F.struct(
            s["start"].alias("start"), s["length"].alias("length"),
            F.array_join(F.slice(F.col("_words"), s["start"] + 1, s["length"]), " ").alias("window"))
    )).alias("_span")).select("_key", "_span.*"))
    hits = candidates.join(windows, ["window", "length"])

    # Words are counted by piece of a document, so a document of very many hits is
    # many small groups; a piece has at most PIECE * lengths spans.
    pieces = (hits.withColumn("_piece", F.explode(F.expr(
        f"sequence(start div {PIECE}, (start + length - 1) div {PIECE})")))
        .select("_key", "_piece", "items", F.expr(
            f"named_struct('start', greatest(start, _piece * {PIECE}), "
            f"'end', least(start + length, (_piece + 1) * {PIECE}))").alias("_cut")))
    covered = F.aggregate(
        F.array_sort("_cuts"),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0).cast("long"), s["end"]
                                       - F.greatest(acc["end"], s["start"]))).alias("total")),
        lambda acc: acc["total"])
    by_piece = (pieces.groupBy("_key", "_piece")
                .agg(F.collect_set("_cut").alias("_cuts"), F.collect_set("items").alias("_items"))
                .select("_key", covered.alias("_hit"),
                        F.array_distinct(F.flatten("_items")).alias("_items")))
    texts = F.array_sort(F.transform(F.array_distinct(F.flatten("_items")),
                                     lambda i: i.cast("string")))
    # a table, not an aggregate on the join's key: the rows of a large group of copies may be split
    judged = written(by_piece.groupBy("_key")
                     .agg(F.sum("_hit").alias("_hit"), F.collect_set("_items").alias("_items"))
                     .select("_key", "_hit", texts.alias("_items")), "judged-texts")
    n_hit = F.coalesce("_hit", F.lit(0).cast("long"))
    items = F.coalesce("_items", F.array().cast("array<string>"))
    out = scanned.drop("_marks").join(judged, "_key", "left")
    return out.select(
        F.col("_doc").alias(doc), "n_words", n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
        F.col("_key").alias("text_sha256"))


def _hash_all(words: Column, window: int) -> Column:
    """The hash that ``_runs`` gives the run of all these words (fewer than a window)."""
    out = F.lit(None).cast("long")
    for n in range(window - 1, 0, -1):
        out = F.when(F.size(words) == n, F.xxhash64(*[F.get(words, F.lit(j)) for j in range(n)])
                     ).otherwise(out)
    return out


def _around(words: Column, found: Column, window: int, run: int) -> Column:
    """Struct (start, length) of each window that holds a run whose hash was found."""
    runs = _runs(words, run)
    last = F.size(words) - window
    at = F.filter(F.transform(runs, lambda h, i: F.when(F.array_contains(found, h), i)),
                  lambda i: i.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(
        F.greatest(i - (window - run), F.lit(0)), F.greatest(F.least(i, last), F.lit(0))))))
    return F.transform(F.filter(starts, lambda s: s <= last),
                       lambda s: F.struct(s.alias("start"), F.lit(window).alias("length")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"),
                         table(spark, sf_dir, "benchmark")).drop("text_sha256")


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_starts AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, w[s:s + 12] AS win FROM item_starts),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
doc_starts AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM words, lengths WHERE len(w) >= n),
hits AS (
  SELECT d.r, d.s, d.n, v.item_id
  FROM (SELECT r, s, n, w[s:s + n - 1] AS win FROM doc_starts) d JOIN windows v ON v.win = d.win),
positions AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM hits)) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL)
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN positions USING (r) LEFT JOIN listed USING (r)
"""
