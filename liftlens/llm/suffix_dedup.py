"""Removal of repeated byte strings by distributed bucket-pointer refinement.

A position's bucket of depth ``q`` is a hash of its next ``q`` bytes. The
bucket of depth ``2 d`` is made of the position's own bucket of depth ``d``
and the bucket identifier found ``d`` bytes later, so every refinement reuses
the identifiers of the one before: q, 2q, 4q, 8q, 16q = ``length``. Two
positions start the same string of ``length`` bytes if they stay together to
the last depth. Identifiers depend on content only, so buckets of all texts
are compared by grouping them in Spark, and only positions whose bucket is
shared go on:

1. Anchors. Among the ``length - 4q + 1`` positions inside a string of
   ``length`` bytes the one with the smallest bucket of depth 4q is its
   anchor. Equal strings have equal anchors. Buckets that hold one anchor in
   all texts are dropped.
2. Blocks. The starts that share an anchor are cut into blocks by their
   distance to it. A block's core is what all its strings have in common, its
   span is all their bytes. A core that occurs once is dropped. A span that
   occurs twice settles its block: every start in it is repeated; one such
   block stays as a witness for other blocks with the same core.
3. Starts. Blocks that share a core and not a span are refined to the last
   depth, start by start.

What settles a string is a pair of 64-bit hashes (core and span, or core and
last bucket). No step gathers a group: buckets are counted, and each text gets
back only hashes of its own. Equal texts are put together at first (they are
repeated throughout if they have ``length`` bytes at all), so a large group of
copies is one row. A table goes as soon as what reads it is written, so that disk
holds the distinct texts, one step's tables and one step's shuffle.

Passages. ``shared_passages`` names the texts that share more than 50 words in
a row with another text, which may be fewer than ``length`` bytes and then stay
where they are. Of the runs of ``GRAM`` words in a window of words the one with
the smallest hash is its anchor; windows whose anchor other texts have too are
compared by their hashes. Texts that lose bytes hold a repeated string as it
is, so windows are only sent of anchors that some other text has.
``repeated_spans`` takes the bytes of such windows away too if it is asked for
passages: from every text that holds them, as with the byte strings.

Defined results: NULL counts as the empty text; texts of fewer than ``length``
bytes keep everything; a string that overlaps its own repetition counts; rows
that share a key or a text are judged each; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import (bucketed, discard, mix, powers, prefix_hash, span_hash, table,
                                 text_chunks, word_spans, written)

LENGTH = 400
#: Words in a row that make a passage, and words of the runs that windows are found by.
PASSAGE = 51
GRAM = 8
_POSITION_BITS = np.uint64(31)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Buckets:
    """Buckets, anchors and blocks of a run of whole texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.q, self.length = length // 16, length
        self.data, self.offsets = data, offsets
        self.prefix = prefix_hash(data)
        n = len(data)
        first = np.arange(max(0, n - self.q + 1))
        self.refined = {self.q: span_hash(self.prefix, first, first + self.q)}
        self._anchors()

    def depth(self, d: int) -> np.ndarray:
        """Buckets of depth d, refined from those of depth d / 2."""
        if d not in self.refined:
            half = self.depth(d // 2)
            n = max(0, len(half) - d // 2)
            self.refined[d] = mix(half[:n] * _STEP + half[d // 2:d // 2 + n])
        return self.refined[d]

    def _anchors(self) -> None:
        gram = self.depth(4 * self.q)
        n = len(self.data) - self.length + 1
        empty = np.empty(0, np.int64)
        self.x = self.lo = self.hi = self.owner = empty
        if n <= 0:
            return
        low = np.uint64((1 << int(_POSITION_BITS)) - 1)
        smallest = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        window, size = self.length - 4 * self.q + 1, 1
        while 2 * size <= window:  # minima over windows of doubling size
            smallest = np.minimum(smallest[:-size], smallest[size:])
            size *= 2
        rest = window - size
        smallest = np.minimum(smallest[:n], smallest[rest:rest + n])
        anchor = (smallest & low).astype(np.int64)
        lengths = np.diff(self.offsets)
        starts = np.zeros(n + 1, np.int8)  # +1 where a text's valid starts begin, -1 after them
        long = lengths >= self.length
        np.add.at(starts, self.offsets[:-1][long], 1)
        np.add.at(starts, (self.offsets[1:] - self.length + 1)[long], -1)
        valid = np.cumsum(starts[:n]) > 0
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | new[1:]
        self.lo, self.hi = np.flatnonzero(new), np.flatnonzero(last)
        self.x = anchor[self.lo]
        self.owner = np.searchsorted(self.offsets, self.lo, side="right") - 1

    def anchor_buckets(self) -> np.ndarray:
        return self.depth(4 * self.q)[self.x]

    def blocks(self, runs: np.ndarray) -> dict[str, np.ndarray]:
        """The blocks of the given runs of starts: first and last start, core and span hash."""
        width = 3 * self.q
        x, lo, hi, owner = self.x[runs], self.lo[runs], self.hi[runs], self.owner[runs]
        first = (x - hi) // width
        count = (x - lo) // width - first + 1
        at = np.repeat(np.arange(len(x)), count)
        k = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + first[at]
        x, owner = x[at], owner[at]
        farthest = np.minimum((k + 1) * width - 1, self.length - 4 * self.q)
        a, b = x - farthest, x - k * width
        core = span_hash(self.prefix, b, a + self.length)
        from_ = np.maximum(a, self.offsets[owner])
        to = np.minimum(b, self.offsets[owner + 1] - self.length)
        clip = ((from_ - a) * 1024 + (b - to)).astype(np.uint64)
        tag = k.astype(np.uint64) * _STEP
        span = span_hash(self.prefix, from_, to + self.length)
        return {"owner": owner, "from": from_, "to": to, "b": b, "core": mix(core + tag),
                "span": mix(span + tag + clip)}

    def last_buckets(self, block: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
        """(block number, start, hash of the last bucket and its place) of every start."""
        count = block["to"] - block["from"] + 1
        at = np.repeat(np.arange(len(count)), count)
        p = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + block["from"][at]
        place = (block["b"][at] - p).astype(np.uint64)
        return at, p, mix(self.depth(self.length)[p] + place * _STEP)


def _tally(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first index, count) of every distinct combination of the keys."""
    if not len(keys[0]):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _of_texts(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes made to belong to their text of the chunk."""
    return mix(hashes + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _lists(column: pa.Array, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, text number) of the lists of rows a to b."""
    part = column.slice(a, b - a)
    sizes = np.diff(np.asarray(part.offsets))
    values = np.asarray(part.flatten()).astype(np.int64).view(np.uint64)
    return values, np.repeat(np.arange(b - a), sizes)


def _emit(names: list[str], columns: list) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64)) if isinstance(c, np.ndarray) and c.dtype == np.uint64
              else c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                found = Buckets(data, offsets, length)
                bucket = found.anchor_buckets() if len(found.x) else np.empty(0, np.uint64)
                first, n = _tally([bucket, found.owner])
                keys = batch.column(0).take(pa.array(found.owner[first] + a))
                yield _emit(["bucket", "key", "n"], [bucket[first], keys, n.astype(np.int64)])
    return run


def _block_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                found = Buckets(data, offsets, length)
                if not len(found.x):
                    continue
                wanted = _of_texts(*_lists(batch.column(2), a, b))
                runs = np.flatnonzero(np.isin(_of_texts(found.anchor_buckets(), found.owner),
                                              wanted))
                block = found.blocks(runs)
                first, n = _tally([block["span"], block["core"], block["owner"]])
                keys = batch.column(0).take(pa.array(block["owner"][first] + a))
                yield _emit(["core", "span", "key", "n"],
                            [block["core"][first], block["span"][first], keys,
                             n.astype(np.int64)])
    return run


def _start_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                found = Buckets(data, offsets, length)
                if not len(found.x):
                    continue
                block = found.blocks(np.arange(len(found.x)))
                wanted = _of_texts(*_lists(batch.column(2), a, b))
                keep = np.isin(_of_texts(block["span"], block["owner"]), wanted)
                block = {name: values[keep] for name, values in block.items()}
                # equal blocks of one text have equal starts: one of them, with its count
                at, p, last = found.last_buckets(block)
                owner, core = block["owner"][at], block["core"][at]
                place, _ = _tally([p, last, core, owner])  # a start may lie in two runs' blocks
                first, n = _tally([last[place], core[place], owner[place]])
                first = place[first]
                keys = batch.column(0).take(pa.array(owner[first] + a))
                yield _emit(["core", "last", "key", "n"],
                            [core[first], last[first], keys, n.astype(np.int64)])
    return run


def _cut(length: int, with_text: bool, passage: int):
    """key, n_removed, n_spans, kept_sha256, spans (and the kept text) of marked texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                found = Buckets(data, offsets, length)
                change = np.zeros(len(data) + 1, np.int64)
                if len(found.x):
                    block = found.blocks(np.arange(len(found.x)))
                    settled = np.isin(_of_texts(block["span"], block["owner"]),
                                      _of_texts(*_lists(batch.column(2), a, b)))
                    np.add.at(change, block["from"][settled], 1)
                    np.add.at(change, block["to"][settled] + length, -1)
                    values, owner = _lists(batch.column(3), a, b)
                    some = np.zeros(b - a, bool)
                    some[owner] = True
                    rest = ~settled & some[block["owner"]]
                    block = {name: v[rest] for name, v in block.items()}
                    at, p, last = found.last_buckets(block)
                    hit = np.isin(_of_texts(last, block["owner"][at]), _of_texts(values, owner))
                    np.add.at(change, p[hit], 1)
                    np.add.at(change, p[hit] + length, -1)
                if passage:
                    words = Passages(data, offsets, passage)
                    values, owner = _lists(batch.column(4), a, b)
                    first = words.first
                    hit = first[np.isin(
                        _of_texts(words.runs(first, passage), words.owner[first]),
                        _of_texts(values, owner))] if len(first) else first
                    np.add.at(change, words.start[hit], 1)
                    np.add.at(change, words.end[hit + passage - 1], -1)
                covered = np.cumsum(change[:-1]) > 0
                yield _cut_texts(batch.column(0).slice(a, b - a), data, offsets, covered,
                                 with_text)
    return run


def _cut_texts(keys: pa.Array, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray,
               with_text: bool) -> pa.RecordBatch:
    removed, spans, digests, texts = [], [], [], []
    for i in range(len(offsets) - 1):
        mine = covered[offsets[i]:offsets[i + 1]]
        kept = data[offsets[i]:offsets[i + 1]][~mine].tobytes()
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]])))
        removed.append(int(mine.sum()))
        spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
        digests.append(hashlib.sha256(kept).hexdigest())
        if with_text:
            texts.append(kept.decode("utf-8", errors="ignore"))
    arrays = [keys, pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
              pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    names = ["key", "n_removed", "kept_sha256", "spans"]
    if with_text:
        arrays.append(pa.array(texts, pa.string()))
        names.append("kept")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _distinct_texts(docs: DataFrame, text: str, length: int) -> DataFrame:
    """key, text, copies of the distinct texts that are long enough, as a table bucketed by key.

    The buckets are the shuffle partitions of the grouping, so later joins on
    the key move no text.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = (docs.where(F.octet_length(text) >= length)
             .select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
             .groupBy("key").agg(F.first("text").alias("text"),
                                 F.count(F.lit(1)).alias("copies")))
    return bucketed(texts, "distinct_texts", "key", buckets)


def text_key(text: Column) -> Column:
    """The first half of the text's SHA-256 (128 bits); NULL counts as empty."""
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    return F.unhex(F.substring(digest, 1, 32))


class Passages:
    """Windows of a number of words of a run of whole texts, and their anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, words: int):
        white = (data == 32) | ((data >= 9) & (data <= 13))
        self.start, self.end, self.owner = word_spans(~white, offsets)
        values = span_hash(prefix_hash(data), self.start, self.end)
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=self.sums[1:])
        self.words, n = words, len(values) - words + 1
        self.first = self.anchor = np.empty(0, np.int64)
        if n <= 0:
            return
        low = np.uint64((1 << int(_POSITION_BITS)) - 1)
        size, span = min(GRAM, words), words - min(GRAM, words) + 1
        gram = self.runs(np.arange(len(values) - size + 1), size)
        self.gram = gram
        smallest = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            smallest = np.minimum(smallest[:-width], smallest[width:])
            width *= 2
        rest = span - width
        smallest = np.minimum(smallest[:n], smallest[rest:rest + n])
        whole = self.owner[:n] == self.owner[words - 1:words - 1 + n]
        self.first = np.flatnonzero(whole)
        self.anchor = (smallest & low).astype(np.int64)[whole]

    def runs(self, first: np.ndarray, size: int) -> np.ndarray:
        """Hashes of ``size`` words from each of the given ones on."""
        return mix((self.sums[first + size] - self.sums[first]) * self.down[first])


def _passage_anchors(words: int):
    """(bucket, key, known) of the distinct anchors of texts (key, text, known)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                found = Passages(data, offsets, words)
                anchor = np.unique(found.anchor)
                bucket = found.gram[anchor] if len(anchor) else np.empty(0, np.uint64)
                first, _ = _tally([bucket, found.owner[anchor]])
                rows = pa.array(found.owner[anchor][first] + a)
                yield _emit(["bucket", "key", "known"], [
                    bucket[first], batch.column(0).take(rows), batch.column(2).take(rows)])
    return run


def _passage_windows(words: int):
    """(passage, key) of the windows of texts (key, text, buckets) with these anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                found = Passages(data, offsets, words)
                if not len(found.first):
                    continue
                wanted = _of_texts(*_lists(batch.column(2), a, b))
                owner = found.owner[found.first]
                keep = np.isin(_of_texts(found.gram[found.anchor], owner), wanted)
                windows, owner = found.runs(found.first[keep], words), owner[keep]
                first, _ = _tally([windows, owner])
                yield _emit(["passage", "key"], [
                    windows[first], batch.column(0).take(pa.array(owner[first] + a))])
    return run


def _passages_of_two(texts: DataFrame, words: int, known: DataFrame | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """(passage, key) of windows whose anchors other texts have too, and the passages that
    several texts have."""
    if known is None:
        marked = texts.select("key", "text", F.lit(False).alias("known"))
    else:
        marked = texts.join(known.select("key", F.lit(True).alias("known")), "key", "left").select(
            "key", "text", F.coalesce("known", F.lit(False)).alias("known"))
    anchors = written(marked.mapInArrow(_passage_anchors(words),
                                        "bucket bigint, key binary, known boolean"),
                      "passage-anchors")
    short = F.xxhash64("key")
    shared = written(
        anchors.groupBy("bucket").agg(F.min(short).alias("a"), F.max(short).alias("b"),
                                      F.min("known").alias("known"))
        .where((F.col("a") != F.col("b")) & ~F.col("known")).select("bucket"), "shared-passages")
    by_text = (anchors.select("bucket", "key").join(shared, "bucket")
               .groupBy("key").agg(F.collect_list("bucket").alias("buckets")))
    windows = written(texts.join(by_text, "key").select("key", "text", "buckets")
                      .mapInArrow(_passage_windows(words), "passage bigint, key binary"),
                      "passage-windows")
    discard(anchors, shared)
    twice = written(windows.groupBy("passage").agg(F.min("key").alias("a"), F.max("key").alias("b"))
                    .where("a <> b").select("passage"), "passages-of-two")
    return windows, twice


def shared_passages(texts: DataFrame, known: DataFrame, words: int = PASSAGE) -> DataFrame:
    """key of the distinct texts (key, text, copies) that share ``words`` words in a row with
    another text or copy; ``known`` are keys that need no answer, but answer for others."""
    windows, twice = _passages_of_two(texts, words, known)
    copies = texts.where((F.col("copies") > 1) & (F.regexp_count(
        "text", F.lit("[^\\x20\\x09-\\x0D]+")) >= words)).select("key")
    return windows.join(twice, "passage").select("key").union(copies).distinct()


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH,
                   with_text: bool = False, passage: int = 0) -> DataFrame:
    """One row per distinct text that loses bytes: key, n_removed, kept_sha256, spans[, kept].

    A byte is lost if a string of ``length`` bytes that covers it starts
    anywhere else too, judged on the input; and, if ``passage`` is given, if it
    lies in so many words in a row that another text has too.
    """
    least = min(length, 2 * passage - 1) if passage else length  # one letter a word at least
    return _repeated_in(_distinct_texts(docs, text, least), length, with_text, passage)


def _repeated_in(texts: DataFrame, length: int, with_text: bool, passage: int = 0) -> DataFrame:
    if length % 16:
        raise ValueError("length must be a multiple of 16")
    every, texts = texts, texts.where(F.octet_length("text") >= length)
    # a table: counted by bucket and then put together by text
    anchors = written(texts.select("key", "text").mapInArrow(
        _anchor_rows(length), "bucket bigint, key binary, n bigint"), "anchors")
    # What a bucket's rows are joined with is a table and not an aggregate on the
    # join's own key, so Spark may split the rows of a common bucket.
    shared = written(anchors.groupBy("bucket").agg(F.sum("n").alias("n"))
                     .where(F.col("n") > 1).select("bucket"), "shared-anchors")
    by_text = (anchors.select("bucket", "key").join(shared, "bucket")
               .groupBy("key").agg(F.collect_list("bucket").alias("buckets")))
    blocks = written(
        texts.join(by_text, "key").select("key", "text", "buckets")
        .mapInArrow(_block_rows(length), "core bigint, span bigint, key binary, n bigint"),
        "repeated-blocks")
    discard(anchors, shared)

    spans = written(blocks.groupBy("core", "span")
                    .agg(F.sum("n").alias("n"), F.min("key").alias("key")), "block-spans")
    mixed = written(spans.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"))
                    .where(F.col("kinds") > 1).select("core"), "mixed-cores")
    unsettled = (spans.join(mixed, "core")
                 .groupBy("key").agg(F.collect_set("span").alias("spans")))
    starts = written(
        texts.join(unsettled, "key").select("key", "text", "spans")
        .mapInArrow(_start_rows(length), "core bigint, last bigint, key binary, n bigint"),
        "repeated-starts")
    discard(mixed)

    settled = spans.where(F.col("n") > 1).select("core", "span")
    repeated = written(starts.groupBy("core", "last").agg(F.sum("n").alias("n"))
                       .where(F.col("n") > 1).select("core", "last"), "repeated-strings")
    nothing = F.lit(None).cast("bigint")
    found = (blocks.join(settled, ["core", "span"])
             .select("key", "span", nothing.alias("last"), nothing.alias("passage"))
             .union(starts.join(repeated, ["core", "last"]).select("key", nothing, "last", nothing)))
    spent = [blocks, spans, starts, repeated]
    enough = F.octet_length("text") >= length
    if passage:
        windows, twice = _passages_of_two(every, passage)
        spent += [windows, twice]
        found = found.union(windows.join(twice, "passage")
                            .select("key", nothing, nothing, "passage"))
        # a copied text has all its words in common with its copies
        enough |= F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")) >= passage
    # a table: what names the strings goes before the texts are joined and cut
    marks = written(found.groupBy("key").agg(*[F.collect_set(c).alias(f"{c}s")
                                               for c in ("span", "last", "passage")]), "text-marks")
    discard(*spent)
    schema = ("key binary, n_removed bigint, kept_sha256 string, "
              "spans array<struct<start:bigint,end:bigint>>" + ", kept string" * with_text)
    cut = (every.where("copies = 1").join(marks, "key")
           .select("key", "text", "spans", "lasts", "passages")
           .mapInArrow(_cut(length, with_text, passage), schema).where("n_removed > 0"))
    size = F.octet_length("text").cast("long")
    whole = (every.where(F.col("copies") > 1).where(enough)
             .select("key", size.alias("n_removed"),
                     F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"),
                     F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end")))
                     .alias("spans"), *[F.lit("").alias("kept")] * with_text))
    return cut.union(whole)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = _distinct_texts(docs, "text", min(LENGTH, 2 * PASSAGE - 1))  # one letter a word at least
    lost = written(_repeated_in(texts, LENGTH, with_text=False), "repeated-spans")
    # a table, not an aggregate on the join's key: the rows of a large group of copies may be split
    passages = written(shared_passages(texts, lost).withColumn("_passage", F.lit(True)),
                       "passage-texts")
    nothing = F.lit(0).cast("long")
    return (docs.select("doc_id", text_key(F.col("text")).alias("key"),
                        F.octet_length(text).cast("long").alias("n_bytes"),
                        F.sha2(text.cast("binary"), 256).alias("_whole"))
            .join(lost, "key", "left").join(passages, "key", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", nothing).alias("n_removed"),
                    F.when(F.col("spans").isNull(), nothing)
                    .otherwise(F.size("spans")).cast("long").alias("n_spans"),
                    F.coalesce("kept_sha256", "_whole").alias("kept_sha256"),
                    (F.coalesce("n_removed", nothing) > 0).alias("loses_bytes"),
                    (F.col("spans").isNotNull() | F.coalesce("_passage", F.lit(False)))
                    .alias("repeats")))
