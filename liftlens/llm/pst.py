"""Language-model scoring with a probabilistic suffix tree.

The tree predicts the next byte of a text whose words (A-Z lower-cased, split
at white space) are joined by single spaces and closed by an end symbol. Its
states are contexts of 0 to ``DEPTH`` bytes. A context passes if it occurs
``LEAST_COUNT`` times and its next-byte counts diverge from those of its parent,
the context without its oldest byte: the log-likelihood ratio of the two must
reach ``DIVERGENCE``. Contexts that pass and all their suffixes are kept,
whatever the size of the corpus, so the kept contexts form a tree. A state's
distribution is smoothed towards that of its parent. Every byte is a symbol. A
text's score is the sum of the log10 probabilities that the longest kept suffix
of each place gives to what follows, so the probabilities of all texts (as word
sequences) sum to one at most.

The kept contexts are a written table that grows with the corpus. Tasks hold
the frequent ones (``LEAST_SHARE`` of all places, so 1 / LEAST_SHARE of a depth
at most) and settle the places whose ``DEPTH`` bytes of context are frequent.
The other places get the probability of their longest frequent state, and their
distinct contexts with the next byte meet the rare states in a join, which
gives what is to be added to the score.

The counts cover all training documents: every task counts runs of
``DEPTH + 1`` bytes and words of its part, and Spark sums them by key. The
same pass gives the word counts of the base score. There, the most frequent
words (``FREQUENT``, a fixed number) are looked up in each task; the remaining
ones, each at most 1 / FREQUENT of all tokens, meet their counts in a join.
Words are told apart by 64-bit hashes.

Defined results: NULL and empty texts are the end alone (one token); without
training documents the counts are 0, the base score is 0 and the symbols are
equally likely; repeated rows are scored each; a document without an id is
neither held out nor learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import (CHUNK_BYTES, id_remainder, prefix_hash, reduce_rows, span_hash,
                                 table, text_chunks, word_spans, written)

DEPTH = 5
LEAST_COUNT = 2
LEAST_SHARE = 2e-6  # of all places: contexts that tasks hold
DIVERGENCE = 6.0
SMOOTHING = 4.0
FREQUENT = 1 << 16
FOLDS = 7
COUNTED = 2 << 20  # counted runs that a task holds before it sends their sums

_BYTES = 256
_SPACE, _END = 0x20, 0x0A
_WORD, _RUN, _TEXT = 0, 1, 2  # kinds of counts


@dataclass
class Words:
    """Words of a run of whole texts and their texts as one stream of bytes."""

    hashes: np.ndarray
    owner: np.ndarray
    stream: np.ndarray  # each text: DEPTH spaces, words with spaces between them, the end
    scored: np.ndarray  # places of the stream that count
    place_owner: np.ndarray  # text number of these places


def parse(data: np.ndarray, offsets: np.ndarray) -> Words:
    rows = len(offsets) - 1
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    is_word = (data != 32) & ((data < 9) | (data > 13))
    start, end, owner = word_spans(is_word, offsets)
    hashes = span_hash(prefix_hash(data), start, end)
    size = end - start + 1  # with the separator
    per_text = np.bincount(owner, weights=size, minlength=rows).astype(np.int64)
    empty = per_text == 0
    per_text = per_text + empty + DEPTH
    begin = np.cumsum(per_text) - per_text
    stream = np.full(int(per_text.sum()), _SPACE, np.uint8)
    before = np.cumsum(size) - size  # output bytes of earlier words, over all texts
    first_of_text = np.searchsorted(owner, np.arange(rows))
    base = np.append(before, before[-1] + size[-1] if len(size) else 0)[first_of_text]
    at = begin[owner] + DEPTH + before - base[owner]
    places = np.flatnonzero(is_word)
    stream[places + np.repeat(at - start, end - start)] = data[places]
    stream[np.cumsum(per_text) - 1] = _END
    scored = np.ones(len(stream), bool)
    for j in range(DEPTH):
        scored[begin + j] = False
    return Words(hashes, owner, stream, np.flatnonzero(scored),
                 np.repeat(np.arange(rows), per_text - DEPTH))


def runs(words: Words) -> np.ndarray:
    """The DEPTH + 1 bytes that end at every scored place, as a number."""
    two = words.stream.astype(np.uint64)
    two[1:] |= two[:-1] << np.uint64(8)
    two &= np.uint64(0xFFFF)
    run = two.copy()  # DEPTH + 1 is even: two bytes at a time
    for j in range(2, DEPTH + 1, 2):
        run[j:] |= two[:-j] << np.uint64(8 * j)
    return run[words.scored]


def _summed(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts of several counted runs."""
    values, n = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(values)
    values, n = values[order], n[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[first], np.add.reduceat(n, first)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (_WORD, _RUN)
    found, counts, texts = {k: [] for k in kinds}, {k: [] for k in kinds}, 0

    def rows() -> Iterator[pa.RecordBatch]:
        for kind in kinds:
            if found[kind]:
                values, n = _summed(found[kind], counts[kind])
                yield _rows(np.full(len(values), kind), values.view(np.int64), n)
                found[kind].clear()
                counts[kind].clear()

    for batch in batches:
        for a, b, data, offsets in text_chunks(batch.column(0), 4 * CHUNK_BYTES):
            words = parse(data, offsets)
            for kind, values in ((_WORD, words.hashes), (_RUN, runs(words))):
                if len(values):
                    distinct, n = np.unique(values, return_counts=True)
                    found[kind].append(distinct)
                    counts[kind].append(n)
            texts += b - a
            if sum(len(x) for x in found[_RUN]) >= COUNTED:
                yield from rows()
    yield from rows()
    if texts:
        yield _rows(np.array([_TEXT]), np.array([0]), np.array([texts]))


def _rows(kind: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(n, pa.int64())],
        names=["kind", "key", "n"])


@dataclass
class SuffixTree:
    """The frequent states."""

    column: np.ndarray  # of each byte; the bytes that never occur have the last one
    contexts: list[np.ndarray]  # by depth: codes of the kept contexts
    log10: np.ndarray  # (states, columns), states by depth and order of their contexts
    settled: np.ndarray  # codes of the frequent contexts of DEPTH bytes, kept or not

    def finder(self) -> StateFinder:
        return StateFinder(self.settled, _longest(self.contexts, self.settled))


class StateFinder:
    """A hash table of the states of settled contexts; others have -1."""

    def __init__(self, codes: np.ndarray, states: np.ndarray):
        bits = max(4, int(4 * len(codes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, -1, np.int64)
        self.ids = np.zeros((1 << bits) + 64, np.int32)
        left, self.probes = np.arange(len(codes)), 0
        while len(left):
            slot = self._slot(codes[left]) + self.probes
            free = np.flatnonzero(self.keys[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            placed = free[one]
            self.keys[slot[placed]] = codes[left[placed]]
            self.ids[slot[placed]] = states[left[placed]]
            left = np.delete(left, placed)
            self.probes += 1

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
                ).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), -1, np.int32)
        slot, open_ = self._slot(codes), np.arange(len(codes))
        for _ in range(self.probes):
            found = self.keys[slot]
            hit = found == codes[open_]
            out[open_[hit]] = self.ids[slot[hit]]
            more = ~hit & (found >= 0)
            open_, slot = open_[more], slot[more] + 1
            if not len(open_):
                break
        return out


def _states(runs: DataFrame) -> DataFrame:
    """depth, context, size and nexts (symbol, n) of the contexts seen LEAST_COUNT times."""
    levels = []
    for depth in range(DEPTH + 1):
        code = F.col("key").bitwiseAND((1 << 8 * (depth + 1)) - 1)
        level = runs.select(F.shiftright(code, 8).alias("context"),
                            code.bitwiseAND(255).cast("int").alias("symbol"), "n")
        if depth < DEPTH:  # the runs themselves are told apart already
            level = level.groupBy("context", "symbol").agg(F.sum("n").alias("n"))
        levels.append(
            level.groupBy("context").agg(
                F.sum("n").alias("size"),
                F.sort_array(F.collect_list(F.struct("symbol", "n"))).alias("nexts"))
            .where(F.col("size") >= LEAST_COUNT)
            .select(F.lit(depth).alias("depth"), "context", "size", "nexts"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionAll(level)
    return out


def _suffix(context: str, depth: str) -> Column:
    return F.expr(f"{context} & (shiftleft(1L, 8 * ({depth})) - 1L)")


def _kept(states: DataFrame) -> DataFrame:
    """The states that pass the divergence test and those of their suffixes."""
    parents = states.select((F.col("depth") + 1).alias("depth"), F.col("context").alias("parent"),
                            F.col("size").alias("parent_size"),
                            F.map_from_entries("nexts").alias("parent_n"))
    gain = F.expr("aggregate(nexts, 0D, (sum, x) -> sum + x.n * ln("
                  "x.n / size * parent_size / element_at(parent_n, x.symbol)))")
    passed = (states.where(F.col("depth") > 0)
              .withColumn("parent", _suffix("context", "depth - 1"))
              .join(parents, ["depth", "parent"])
              .where(gain >= DIVERGENCE).select("depth", "context"))
    tree = (passed.select("context", F.explode(F.expr("sequence(1, depth)")).alias("depth"))
            .select("depth", _suffix("context", "depth").alias("context")).distinct())
    return states.join(tree, ["depth", "context"], "left_semi")


def _build(counts: DataFrame) -> tuple[SuffixTree, DataFrame]:
    """The frequent states (a bounded number, on the driver) and the table of the rare ones."""
    runs = counts.where(F.col("kind") == _RUN).select("key", "n")
    byte = F.col("key").bitwiseAND(255).cast("int")
    by_byte = {r[0]: r[1] for r in runs.groupBy(byte).agg(F.sum("n")).collect()}  # 256 at most
    seen = sorted(by_byte)
    column = np.full(_BYTES, len(seen), np.int64)
    column[seen] = np.arange(len(seen))
    total = sum(by_byte.values())
    root = np.array([by_byte[b] + 1 for b in seen] + [1], np.float64) / (total + _BYTES)
    contexts, probabilities = [np.zeros(1, np.int64)], [root[None, :].astype(np.float32)]
    least = max(float(LEAST_COUNT), LEAST_SHARE * total)
    states = written(_states(runs), "contexts")
    kept = written(_kept(states), "states")
    frequent = F.col("size") >= least
    for depth in range(1, DEPTH + 1):
        codes, sizes, matrix = _grouped(kept.where(frequent & (F.col("depth") == depth)),
                                        column, len(root))
        parents = _longest(contexts, codes)
        matrix += SMOOTHING * np.concatenate(probabilities)[parents]
        matrix /= sizes[:, None] + np.float32(SMOOTHING)
        contexts.append(codes)
        probabilities.append(matrix)
    log10 = np.concatenate(probabilities)
    np.log10(log10, out=log10)
    settled = np.sort(states.where(frequent & (F.col("depth") == DEPTH)).select("context")
                      .toArrow()["context"].to_numpy())
    return SuffixTree(column, contexts, log10, settled), kept.where(~frequent)


def _grouped(kept: DataFrame, column: np.ndarray, columns: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes in order, sizes and counts by column."""
    rows = kept.select("context", "size", "nexts").toArrow().combine_chunks()
    nexts = rows["nexts"].combine_chunks()
    flat = nexts.flatten()
    row = np.repeat(np.arange(len(nexts)), nexts.value_lengths().to_numpy())
    matrix = np.zeros((len(nexts), columns), np.float32)
    matrix[row, column[flat.field("symbol").to_numpy()]] = flat.field("n").to_numpy()
    codes = rows["context"].to_numpy()
    order = np.argsort(codes)
    return codes[order], rows["size"].to_numpy()[order].astype(np.float32), matrix[order]


def _longest(contexts: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """State number of the longest kept suffix of each context."""
    out = np.zeros(len(codes), np.int64)
    first = 0
    for d, known in enumerate(contexts):
        if len(known):
            suffix = codes & ((1 << 8 * d) - 1)
            at = np.minimum(np.searchsorted(known, suffix), len(known) - 1)
            hit = known[at] == suffix
            out[hit] = first + at[hit]
        first += len(known)
    return out


def _by_text(values: np.ndarray, owner: np.ndarray, rows: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by text and value; in it, the first places and numbers of equal ones; list offsets."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    return (order, first, np.diff(np.append(first, len(v))).astype(np.int32),
            np.searchsorted(o[first], np.arange(rows + 1)))


def _by_text_and_gram(grams: np.ndarray, owner: np.ndarray
                      ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct grams of each text in order, how often they occur, and their texts."""
    bits = 8 * (DEPTH + 1)
    top = 1 << (63 - bits)  # texts that fit into a number above a gram
    out = []
    cuts = np.searchsorted(owner, np.arange(0, int(owner[-1]) + 1 if len(owner) else 1, top))
    for k, (lo, hi) in enumerate(zip(cuts, np.append(cuts[1:], len(owner)), strict=True)):
        key, n = np.unique(((owner[lo:hi] - k * top) << bits) | grams[lo:hi], return_counts=True)
        out.append((key & ((1 << bits) - 1), n.astype(np.int32), (key >> bits) + k * top))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _scored(tree: SuffixTree, words: np.ndarray, logs: np.ndarray):
    """Scores by the frequent states, sums over the frequent words, and the other words and
    contexts with the next byte (and its log10 so far) of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = tree.finder()
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                text = parse(data, offsets)
                rows = b - a
                run = runs(text).view(np.int64)
                follows = tree.column[run & 255]
                state = states(run >> 8)
                settled = state >= 0
                score = reduce_rows(np.add, tree.log10[state[settled], follows[settled]]
                                    .astype(np.float64), text.place_owner[settled], rows, 0.0)
                grams, gram_times, gram_owner = _by_text_and_gram(
                    run[~settled], text.place_owner[~settled])
                gram_at = np.searchsorted(gram_owner, np.arange(rows + 1))
                so_far = tree.log10[_longest(tree.contexts[:DEPTH], grams >> 8),
                                    tree.column[grams & 255]]
                score += reduce_rows(np.add, so_far.astype(np.float64) * gram_times, gram_owner,
                                     rows, 0.0)
                place = np.minimum(np.searchsorted(words, text.hashes), max(0, len(words) - 1))
                known = words[place] == text.hashes if len(words) else np.zeros(
                    len(text.hashes), bool)
                n = np.bincount(text.owner, minlength=rows)
                frequent = np.bincount(text.owner[known], minlength=rows)
                total = np.bincount(text.owner[known], weights=logs[place[known]], minlength=rows
                                    ).astype(np.float64)  # integers if there are none
                h, o = text.hashes[~known], text.owner[~known]
                order, first, times, word_at = _by_text(h, o, rows)
                lists = pa.array(word_at, pa.int32())
                gram_lists = pa.array(gram_at, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(a, rows) for c in batch.columns[:-1]],
                    pa.array(n + 1, pa.int64()), pa.array(frequent, pa.int64()),
                    pa.array(total, pa.float64()), pa.array(score, pa.float64()),
                    pa.ListArray.from_arrays(lists, pa.array(h[order[first]].view(np.int64))),
                    pa.ListArray.from_arrays(lists, pa.array(times)),
                    pa.ListArray.from_arrays(gram_lists, pa.array(grams)),
                    pa.ListArray.from_arrays(gram_lists, pa.array(gram_times)),
                    pa.ListArray.from_arrays(gram_lists, pa.array(so_far))],
                    names=[*batch.schema.names[:-1], *_SCORED])
    return run


_SCORED = ["n_tokens", "_known", "_logs", "score", "_words", "_times", "_grams", "_gram_times",
           "_so_far"]


def _by_rare_states(scored: DataFrame, rare: DataFrame) -> DataFrame:
    """gram and what the rare states among its suffixes add to its log10."""
    grams = (scored.select(F.explode(F.arrays_zip("_grams", "_so_far")).alias("_g"))
             .groupBy(F.col("_g._grams").alias("gram"))
             .agg(F.first("_g._so_far").cast("double").alias("so_far")))  # one value a gram
    suffixes = (grams.select("gram", "so_far", F.explode(F.sequence(F.lit(1), F.lit(DEPTH)))
                             .alias("depth"))
                .withColumn("context", _suffix("shiftright(gram, 8)", "depth")))
    n = F.expr("aggregate(nexts, 0L, (sum, x) -> sum + if(x.symbol = (gram & 255), x.n, 0L))")
    # smoothed from the longest frequent state down, by depth
    return (suffixes.join(rare, ["depth", "context"])
            .groupBy("gram").agg(F.first("so_far").alias("so_far"), F.sort_array(F.collect_list(
                F.struct("depth", n.alias("n"), "size"))).alias("path"))
            .select("gram", F.expr(
                "log10(aggregate(path, power(10D, so_far), (p, x) -> "
                f"(x.n + {SMOOTHING}D * p) / (x.size + {SMOOTHING}D))) - so_far").alias("more")))


def score_texts(docs: DataFrame, learn: Column, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, n_tokens, n_known, train_tokens, base_score and score."""
    lines = F.coalesce(F.col(text), F.lit(""))
    counts = written(
        docs.where(learn).select(lines.alias("_text"))
        .mapInArrow(_counted, "kind int, key bigint, n bigint")
        .groupBy("kind", "key").agg(F.sum("n").alias("n")), "corpus-counts")
    vocabulary = counts.where(F.col("kind") == _WORD).select("key", "n")
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    texts = sums[_TEXT]["n"] if _TEXT in sums else 0
    tokens = texts + (sums[_WORD]["n"] if _WORD in sums else 0)
    distinct = (texts > 0) + (sums[_WORD]["v"] if _WORD in sums else 0)
    top = vocabulary.orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    words = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    logs = np.log10(top["n"].to_numpy() + 1.0)[order]
    tree, rare_states = _build(counts)

    frame = docs.select(*keep, lines.alias("_text"))
    schema = ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in keep)
    scored = written(
        frame.mapInArrow(_scored(tree, words[order], logs),
                         f"{schema}, n_tokens bigint, _known bigint, _logs double, score double, "
                         f"_words array<bigint>, _times array<int>, _grams array<bigint>, "
                         f"_gram_times array<int>, _so_far array<float>")
        .withColumn("_row", F.monotonically_increasing_id()), "scored-texts")
    rare = (scored.select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("_w"))
            .select("_row", F.col("_w._words").alias("key"), F.col("_w._times").alias("times"))
            .join(vocabulary, "key")
            .select("_row", F.col("times").cast("long").alias("_rare"),
                    (F.col("times") * F.log10(F.col("n") + 1.0)).alias("_rare_logs"),
                    F.lit(0.0).alias("_more")))
    deep = (scored.select("_row", F.explode(F.arrays_zip("_grams", "_gram_times")).alias("_g"))
            .select("_row", F.col("_g._grams").alias("gram"), F.col("_g._gram_times").alias("times"))
            .join(_by_rare_states(scored, rare_states), "gram")
            .select("_row", F.lit(0).cast("long").alias("_rare"), F.lit(0.0).alias("_rare_logs"),
                    (F.col("times") * F.col("more")).alias("_more")))
    rare = rare.unionAll(deep).groupBy("_row").agg(
        *[F.sum(c).alias(c) for c in ("_rare", "_rare_logs", "_more")])
    end = float(np.log10(texts + 1.0))
    scale = float(np.log10(tokens + distinct + 1.0))
    zero = F.lit(0)
    return (scored.drop("_words", "_times", "_grams", "_gram_times", "_so_far").join(rare, "_row", "left")
            .select(*keep, "n_tokens",
                    (F.col("_known") + F.coalesce("_rare", zero) + (1 if texts else 0))
                    .cast("long").alias("n_known"),
                    F.lit(tokens).cast("long").alias("train_tokens"),
                    (F.col("_logs") + F.coalesce("_rare_logs", zero) + end
                     - F.col("n_tokens") * scale).alias("base_score"),
                    (F.col("score") + F.coalesce("_more", F.lit(0.0))).alias("score")))


def op7_pst(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), FOLDS)
    return score_texts(docs.withColumn("held_out", F.coalesce(remainder == 2, F.lit(False))),
                       remainder != 2, ["doc_id", "held_out"])
