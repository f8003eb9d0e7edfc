"""Toxicity: a convolutional text classifier trained in numpy, in Spark tasks.

A word's embedding is the sum of a hashed embedding of the word and one of its
first four bytes. Filters of widths 1, 2 and 3 run over the words of a whole
text; each is max-pooled over the text (with a floor at 0) and a linear layer
gives a logit. Max pooling sends a gradient to one place per filter only, so
training touches a few words a text.

All labelled documents of the training fold, of any length, are learned from.
Four in five fit the weights: they are dealt by a hash, every task descends over
its rows from a common start, and Spark averages what the tasks changed, in
proportion to how often each task changed it; then the next round starts from
the average (``ROUNDS``; one task needs one). The remaining fifth calibrates one
threshold per language: its logits are counted by group, label and steps of
``1 / STEPS``. The languages and their telling words (those in many more texts
of one language than of any other) are learned from text and ``lang`` of the
labelled training documents; at scoring the language group of a text is told
from the text's own words (the column ``lang`` is never read), and the score is
the logistic function of the logit's distance from its group's threshold, so 0.5
is the calibrated decision for every language. A language with few texts, and
texts without a telling word, get the common threshold. The driver holds the
model (a fixed number of embeddings) and the counted logits, never a text.

Long texts are split into words in pieces that cut none and convolved in slices
that overlap by a window, so the result is that of the whole text.

Defined results: NULL and empty texts, and texts without words, have pooled
features of 0 and get the score of the bias; without labelled rows of both
classes every score is the share of toxic ones (0 without labels); a document
with several labels is toxic if one says so; repeated rows are scored, and
learned from, each; NULL texts are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftlens.llm.common import (CHUNK_BYTES, discard, id_remainder, letters, lower_latin,
                                 prefix_hash, reduce_rows, span_hash, table, text_chunks,
                                 word_safe_pieces, word_spans, written)

BUCKET_BITS = 16
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 12  # at most; or as many as make UPDATES, on few rows
UPDATES = 800
BATCH = 32
#: Rows that a task visits, over all epochs, unless ROUNDS visit more.
VISITS = 72_000
#: Averages of what the tasks learned; every round visits every row.
ROUNDS = 3
#: A training task has at least so many rows, and one is added for so many bytes of text.
LEAST_ROWS = 16_384
TASK_BYTES = 256 << 20
#: Words of parsed texts that a training task holds.
HELD_WORDS = 4 << 20
RATE = 0.15
PENALTY = 1e-4
#: Training texts that a bucket must occur in; rarer ones embed as nothing.
LEAST_TEXTS = 3
CALIBRATION_SHARE = 5  # one row in so many
FOLDS = 5

#: Telling words of a language: at most so many, in so much larger a share of its texts.
TELLING_WORDS = 24
TELLING_MARGIN = 0.3
#: Training texts that a language needs for a group of its own.
LEAST_GROUP = 50
#: Words that are convolved at a time.
SLICE = 1 << 17
#: Logits are counted in steps of one over this.
STEPS = 128

_BUCKETS = 1 << BUCKET_BITS
_PAD = 2 * _BUCKETS  # embedding of nothing


@dataclass
class ToxicityModel:
    embedding: np.ndarray  # (2 * buckets + 1, DIM): words, word beginnings, nothing
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: np.ndarray  # by language group; 0: no language
    constant: float | None = None  # the score where there was nothing to learn
    languages: list[str] = field(default_factory=list)
    telling: np.ndarray | None = None  # language group by word bucket


def learn_groups(words: list[np.ndarray], langs: list[str | None]
                 ) -> tuple[list[str], np.ndarray]:
    """(languages, language group by word bucket) from the texts' words; 0: no group."""
    count: dict[str, int] = {}
    for lang in langs:
        if lang is not None:
            count[lang] = count.get(lang, 0) + 1
    names = sorted(lang for lang, n in count.items() if n >= LEAST_GROUP)
    out = np.zeros(_BUCKETS, np.int16)
    if not names:
        return names, out
    share = np.zeros((len(names), _BUCKETS), np.float32)
    for ids, lang in zip(words, langs, strict=True):
        if lang in names:
            share[names.index(lang), np.unique(ids)] += 1 / count[lang]
    best = share.argmax(axis=0)
    margin = share.max(axis=0) - (np.sort(share, axis=0)[-2] if len(names) > 1 else 0)
    for g in range(len(names)):
        mine = np.flatnonzero((best == g) & (margin >= TELLING_MARGIN))
        out[mine[np.argsort(-margin[mine], kind="stable")][:TELLING_WORDS]] = g + 1
    return names, out


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, beginning bucket, text number) of every word of the texts."""
    if len(offsets) == 2 and len(data) > CHUNK_BYTES:
        parts = [_tokens(data[a:b], np.array([0, b - a])) for a, b in word_safe_pieces(data)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))
    return _tokens(data, offsets)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = lower_latin(data)
    start, end, owner = word_spans(letters(data), offsets)
    prefix = prefix_hash(data)
    shift = np.uint64(64 - BUCKET_BITS)
    words = (span_hash(prefix, start, end) >> shift).astype(np.int32)
    begin = (span_hash(prefix, start, np.minimum(start + 4, end)) * np.uint64(0x9E3779B97F4A7C15)
             >> shift).astype(np.int32)
    return words, begin + np.int32(_BUCKETS), owner


def _convolve(model: ToxicityModel, words: np.ndarray, begin: np.ndarray, owner: np.ndarray
              ) -> np.ndarray:
    """Filter outputs at every word (rows) before pooling; windows never leave a text."""
    x = model.embedding[words] + model.embedding[begin]
    n = len(words)
    same1 = np.append(owner[1:] == owner[:-1], False)[:n]
    same2 = np.append(owner[2:] == owner[:-2], [False, False])[:n]
    z = []
    for width, f in zip(WIDTHS, model.filters, strict=True):
        out = x @ f[0]
        for j, same in ((1, same1), (2, same2)):
            if j < width:
                y = x @ f[j]
                out[:-j] += y[j:] * same[:n - j, None]
        z.append(out)
    return np.concatenate(z, axis=1) + model.bias


def logits(model: ToxicityModel, words: np.ndarray, begin: np.ndarray, owner: np.ndarray,
           rows: int) -> np.ndarray:
    pooled = np.zeros((rows, len(model.bias)), np.float32)
    ahead = max(WIDTHS) - 1
    for a in range(0, len(words), SLICE):
        b = min(a + SLICE, len(words))
        z = _convolve(model, words[a:b + ahead], begin[a:b + ahead], owner[a:b + ahead])[:b - a]
        np.maximum(pooled, reduce_rows(np.maximum, z, owner[a:b], rows, 0.0), out=pooled)
    # row by row: a product of matrices may round a row by where it stands
    return (pooled * model.weights).sum(axis=1) + model.offset


def groups(model: ToxicityModel, words: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Language group of each text: whose telling words are most (0: none)."""
    width = len(model.languages) + 1
    g = model.telling[words]
    hit = g > 0
    counts = np.bincount(owner[hit] * width + g[hit], minlength=rows * width)
    counts = counts.reshape(rows, width)
    return np.where(counts.any(axis=1), counts.argmax(axis=1), 0)


def _new_model(rng: np.random.Generator) -> ToxicityModel:
    outputs = FILTERS * len(WIDTHS)
    table_ = rng.normal(0, 0.05, (2 * _BUCKETS + 1, DIM)).astype(np.float32)
    table_[_PAD] = 0
    return ToxicityModel(
        table_, [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(outputs, np.float32), rng.normal(0, 0.3, outputs).astype(np.float32), 0.0,
        np.zeros(1))


def train(texts: Iterable[str], labels: np.ndarray, share: float = 0.5, seed: int = 7,
          langs: list[str | None] | None = None) -> ToxicityModel:
    """Fit on texts and 0/1 labels in one process; ``share`` is the share of toxic rows elsewhere.

    ``langs`` names the texts' languages, from which the language groups are learned.
    """
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return ToxicityModel(np.empty((0, DIM)), [], np.empty(0), np.empty(0), 0.0, np.empty(0),
                             float(labels[0]) if len(labels) else 0.0)
    rng = np.random.default_rng(seed)
    model = _new_model(rng)
    parsed = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        words, begin, _ = tokens(data, np.array([0, len(data)]))
        parsed.append((words, begin))
    texts_with = np.zeros(2 * _BUCKETS + 1, np.int64)
    for pair in parsed:
        for ids in pair:
            texts_with[np.unique(ids)] += 1
    real = [words for words, _ in parsed]
    model.languages, model.telling = learn_groups(real, langs or [None] * len(real))
    rare = texts_with < min(LEAST_TEXTS, len(real))
    model.embedding[rare] = 0
    parsed = [tuple(np.where(rare[ids], _PAD, ids) for ids in pair) for pair in parsed]
    order = rng.permutation(len(real))
    held = order[::CALIBRATION_SHARE] if len(real) >= 10 * CALIBRATION_SHARE else order
    fit = np.setdiff1d(order, held) if len(held) < len(order) else order
    epochs = max(EPOCHS, -(-UPDATES * BATCH // len(fit)))
    Descent(model).run(parsed, labels, fit, epochs, float(labels[fit].mean()), rng)
    _calibrate(model, parsed, [real[r] for r in held], labels, held, share)
    return model


def _joined(parsed: list, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(parsed[r][0]) for r in rows]
    return (np.concatenate([parsed[r][0] for r in rows]),
            np.concatenate([parsed[r][1] for r in rows]), np.repeat(np.arange(len(rows)), sizes))


def _winners(model: ToxicityModel, words: np.ndarray, begin: np.ndarray, owner: np.ndarray,
             rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(pooled features, places of their windows; -1 where the floor won) of each text."""
    pooled = np.zeros((rows, len(model.bias)), np.float32)
    winner = np.full((rows, len(model.bias)), -1)
    ahead = max(WIDTHS) - 1
    for a in range(0, len(words), SLICE):
        b = min(a + SLICE, len(words))
        z = _convolve(model, words[a:b + ahead], begin[a:b + ahead], owner[a:b + ahead])[:b - a]
        first = np.flatnonzero(np.r_[True, owner[a + 1:b] != owner[a:b - 1]])
        for lo, hi in zip(first, np.append(first[1:], b - a), strict=True):
            r, part = owner[a + lo], z[lo:hi]
            best = part.argmax(axis=0)
            value = part[best, np.arange(part.shape[1])]
            more = value > pooled[r]
            winner[r][more] = best[more] + a + lo
            pooled[r][more] = value[more]
    return pooled, winner


class Descent:
    """Adagrad over small batches; pooling passes a gradient back to its winning window only."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.squares = {"e": np.full(model.embedding.shape, 1e-3, np.float32),
                        "f": [np.full(f.shape, 1e-2, np.float32) for f in model.filters],
                        "b": np.full(model.bias.shape, 1e-2, np.float32),
                        "w": np.full(model.weights.shape, 1e-2, np.float32)}
        self.offset_square = 1e-2
        self.steps = 0
        self.touched = np.zeros(len(model.embedding), np.int64)  # steps by embedding

    def run(self, parsed: list, labels: np.ndarray, fit: np.ndarray, epochs: int, share: float,
            rng: np.random.Generator) -> None:
        """So many epochs over the rows ``fit``; toxic ones weigh as much as the others in all."""
        weight = np.where(labels > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        for _ in range(epochs):
            for at in range(0, len(fit), BATCH):
                rows = fit[at:at + BATCH]
                self._step(*_joined(parsed, rows), labels[rows], weight[rows])
            rng.shuffle(fit)

    def _step(self, words: np.ndarray, begin: np.ndarray, owner: np.ndarray, labels: np.ndarray,
              weight: np.ndarray) -> None:
        model, squares, n = self.model, self.squares, len(labels)
        g_embed_rows, g_embed = [], []
        g_filters = [np.zeros_like(f) for f in model.filters]
        pooled, winner = _winners(model, words, begin, owner, n)
        p = 1 / (1 + np.exp(-np.clip(pooled @ model.weights + model.offset, -30, 30)))
        g = (weight * (p - labels) / n).astype(np.float32)
        g_weights = pooled.T @ g + PENALTY * model.weights
        g_pooled = g[:, None] * model.weights * (winner >= 0)
        for k, width in enumerate(WIDTHS):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            r, c = np.nonzero(winner[:, cols] >= 0)
            place, grad = winner[:, cols][r, c], g_pooled[:, cols][r, c]
            for j in range(width):
                inside = place + j < len(words)
                inside[inside] = owner[place[inside] + j] == r[inside]
                pos, gj, cj = place[inside] + j, grad[inside], c[inside]
                x = model.embedding[words[pos]] + model.embedding[begin[pos]]
                np.add.at(g_filters[k][j].T, cj, gj[:, None] * x)
                back = gj[:, None] * model.filters[k][j][:, cj].T
                for ids in (words[pos], begin[pos]):
                    g_embed_rows.append(ids)
                    g_embed.append(back)
        if g_embed_rows:
            ids, place = np.unique(np.concatenate(g_embed_rows), return_inverse=True)
            total = np.zeros((len(ids), DIM), np.float32)
            np.add.at(total, place, np.concatenate(g_embed))
            total += PENALTY * model.embedding[ids]
            squares["e"][ids] += total ** 2
            model.embedding[ids] -= RATE * total / np.sqrt(squares["e"][ids])
            model.embedding[_PAD] = 0
            self.touched[ids] += 1
        for k, gf in enumerate(g_filters):
            gf += PENALTY * model.filters[k]
            squares["f"][k] += gf ** 2
            model.filters[k] -= RATE * 0.3 * gf / np.sqrt(squares["f"][k])
        g_bias = g_pooled.sum(axis=0)
        squares["b"] += g_bias ** 2
        model.bias -= RATE * 0.3 * g_bias / np.sqrt(squares["b"])
        squares["w"] += g_weights ** 2
        model.weights -= RATE * g_weights / np.sqrt(squares["w"])
        self.offset_square += float(g.sum()) ** 2
        model.offset -= RATE * float(g.sum()) / self.offset_square ** 0.5
        self.steps += 1

    def state(self) -> np.ndarray:
        """Every parameter and its squares, (rows, 2 * DIM): the embeddings, then the others."""
        model, squares = self.model, self.squares
        out = []
        for big, small in ((model.embedding, [*model.filters, model.bias, model.weights,
                                              np.array([model.offset])]),
                           (squares["e"], [*squares["f"], squares["b"], squares["w"],
                                           np.array([self.offset_square])])):
            flat = np.concatenate([x.ravel() for x in small])
            rest = np.zeros((-(-len(flat) // DIM), DIM), np.float32)
            rest.ravel()[:len(flat)] = flat
            out.append(np.concatenate([big, rest]))
        return np.concatenate(out, axis=1)

    def restore(self, state: np.ndarray) -> None:
        """The inverse of ``state``; nothing has been touched since."""
        model, squares, n = self.model, self.squares, len(self.model.embedding)
        model.embedding, squares["e"] = state[:n, :DIM].copy(), state[:n, DIM:].copy()
        for half, small in ((state[n:, :DIM], [*model.filters, model.bias, model.weights]),
                            (state[n:, DIM:], [*squares["f"], squares["b"], squares["w"]])):
            flat, at = half.ravel(), 0
            for x in small:
                x[...] = flat[at:at + x.size].reshape(x.shape)
                at += x.size
            if small[0] is model.filters[0]:
                model.offset = float(flat[at])
            else:
                self.offset_square = float(flat[at])
        self.steps, self.touched = 0, np.zeros(n, np.int64)


def _best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Midpoint of the cut with the least weighted errors (the middle one of equal cuts)."""
    order = np.argsort(scores, kind="stable")
    s, y, w = scores[order], labels[order], weights[order]
    wrong = np.concatenate([[0.0], np.cumsum(w * y)])  # toxic below the cut
    wrong += np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0.0]])  # clean above it
    edges = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    allowed = np.concatenate([[True], s[1:] > s[:-1], [True]])
    best = np.flatnonzero(allowed & (wrong <= wrong[allowed].min() + 1e-9))
    return float(edges[best[len(best) // 2]])


def _calibrate(model: ToxicityModel, parsed: list, real: list, labels: np.ndarray,
               held: np.ndarray, share: float) -> None:
    parts = []
    for at in range(0, len(held), BATCH):
        rows = held[at:at + BATCH]
        words, begin, owner = _joined(parsed, rows)
        parts.append((logits(model, words, begin, owner, len(rows)),
                      groups(model, np.concatenate(real[at:at + BATCH]), owner, len(rows))))
    scores, group = (np.concatenate(p) for p in zip(*parts, strict=True))
    y = labels[held]
    # clean rows are rarer in the sample than in the corpus: they weigh more
    weights = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    common = _best_threshold(scores, y, weights)
    model.thresholds = np.zeros(len(model.languages) + 1)
    for g in range(len(model.thresholds)):
        mine = group == g
        enough = mine.sum() >= 40 and 5 <= y[mine].sum() <= mine.sum() - 5
        model.thresholds[g] = (_best_threshold(scores[mine], y[mine], weights[mine]) if enough
                               else common)


def _scorer(model: ToxicityModel, text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            out = np.full(batch.num_rows, model.constant or 0.0)
            threshold = np.zeros(batch.num_rows)
            if model.constant is None:
                for a, b, data, offsets in text_chunks(column, CHUNK_BYTES // 2):
                    words, begin, owner = tokens(data, offsets)
                    z = logits(model, words, begin, owner, b - a)
                    threshold[a:b] = model.thresholds[groups(model, words, owner, b - a)]
                    out[a:b] = 1 / (1 + np.exp(-np.clip(z - threshold[a:b], -30, 30)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            columns += [pa.array(out), pa.array((out >= 0.5).astype(np.int32)), pa.array(threshold)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *SCORES])
    return run


SCORES = ["score", "predicted", "threshold"]


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns plus score (0 to 1), predicted (0/1) and the logit's threshold."""
    frame = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    schema = ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in keep)
    return frame.mapInArrow(_scorer(model, text, keep),
                            f"{schema}, score double, predicted int, threshold double")


def _texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n): texts of a language (rows text, lang) that a bucket occurs in."""
    counts: dict[str | None, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(n[at])], names=["lang", "bucket", "n"])
        counts.clear()

    for batch in batches:
        for a, b, data, offsets in text_chunks(batch.column(0), CHUNK_BYTES // 2):
            langs = batch.column(1).slice(a, b - a).to_pylist()
            words, begin, owner = tokens(data, offsets)
            key = np.unique(np.concatenate([owner, owner]) * _PAD + np.concatenate([words, begin]))
            ids, owner = key % _PAD, key // _PAD
            for r, part in enumerate(np.split(ids, np.searchsorted(owner, np.arange(1, b - a)))):
                if langs[r] not in counts:
                    if len(counts) >= 64:
                        yield from rows()
                    counts[langs[r]] = np.zeros(_PAD, np.int64)
                counts[langs[r]][part] += 1
    yield from rows()


def _learn_vocabulary(model: ToxicityModel, rows: DataFrame) -> np.ndarray:
    """Sets the language groups of the model; which buckets are rare."""
    counts = written(rows.select("text", "_lang")
                     .mapInArrow(_texts_with, "lang string, bucket int, n bigint")
                     .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "word-texts")
    sizes = (rows.where("_lang is not null").groupBy(F.col("_lang").alias("lang"))
             .agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= LEAST_GROUP))
    model.languages = sorted(r["lang"] for r in sizes.collect())
    shares = (counts.where(F.col("bucket") < _BUCKETS).join(sizes, "lang")
              .select("bucket", "lang", (F.col("n") / F.col("size")).alias("share"))
              .groupBy("bucket").agg(
                  F.max(F.struct("share", "lang")).alias("top"),
                  F.sort_array(F.collect_list("share"), asc=False).alias("all")))
    margin = F.col("top.share") - F.coalesce(F.try_element_at("all", F.lit(2)), F.lit(0.0))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("margin"), "bucket"))
    telling = (shares.select("bucket", F.col("top.lang").alias("lang"), margin.alias("margin"))
               .where(F.col("margin") >= TELLING_MARGIN)
               .withColumn("rank", rank).where(F.col("rank") <= TELLING_WORDS).collect())
    model.telling = np.zeros(_BUCKETS, np.int16)
    for r in telling:
        model.telling[r["bucket"]] = model.languages.index(r["lang"]) + 1
    texts = rows.count()
    found = (counts.groupBy("bucket").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= min(LEAST_TEXTS, texts)).select("bucket").toArrow())
    rare = np.ones(_PAD + 1, bool)
    rare[found["bucket"].to_numpy()] = False
    discard(counts)
    return rare


def _round(descent: Descent, start: np.ndarray, rare: np.ndarray, epochs: int, share: float,
           seed: int):
    """What a task's descent over its rows (text, label) changes: id, touched, weighted change."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        descent.restore(start)
        parsed, labels, held = [], [], 0

        def learn() -> None:
            y = np.array(labels, np.float32)
            descent.run(parsed, y, rng.permutation(len(y)), epochs, share, rng)
            parsed.clear()
            labels.clear()

        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(0), CHUNK_BYTES // 2):
                words, begin, owner = tokens(data, offsets)
                words, begin = (np.where(rare[x], np.int32(_PAD), x) for x in (words, begin))
                cut = np.searchsorted(owner, np.arange(1, b - a))
                parsed += list(zip(np.split(words, cut), np.split(begin, cut), strict=True))
                labels += batch.column(1).slice(a, b - a).to_pylist()
                held += len(words)
                if held >= HELD_WORDS:
                    learn()
                    held = 0
        if labels:
            learn()
        if not descent.steps:
            return
        weight = np.concatenate([descent.touched, np.full(len(start) - len(descent.touched),
                                                          descent.steps)])
        ids = np.flatnonzero(weight)
        change = (descent.state()[ids] - start[ids]).astype(np.float64)
        # whole numbers: their sums do not depend on the order of the tasks
        change = np.rint(change * weight[ids, None] * _UNITS).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids.astype(np.int32)), pa.array(weight[ids]),
             *[pa.array(np.ascontiguousarray(c)) for c in change.T]],
            names=["id", "touched", *_CHANGES])
    return run


_UNITS = float(1 << 20)
_CHANGES = [f"c{i}" for i in range(2 * DIM)]


def _logit_counts(model: ToxicityModel, rare: np.ndarray):
    """(grp, step, label, n): counted logits of rows (text, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(0), CHUNK_BYTES // 2):
                words, begin, owner = tokens(data, offsets)
                z = logits(model, words, begin, owner, b - a)
                step = np.rint(np.clip(z, -30, 30) * STEPS).astype(np.int64)
                label = np.array(batch.column(1).slice(a, b - a).to_pylist(), np.int64)
                found, n = np.unique(
                    np.stack([groups(model, words, owner, b - a), step, label]), axis=1,
                    return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in found], pa.array(n)],
                                                 names=["grp", "step", "label", "n"])
    return run


def _thresholds(model: ToxicityModel, counted: pa.Table) -> np.ndarray:
    """By language group; groups with few rows of either label have the common one."""
    group, step, label, n = (counted[c].to_numpy() for c in ("grp", "step", "label", "n"))
    common = _best_threshold(step / STEPS, label, n.astype(np.float64))
    out = np.full(len(model.languages) + 1, common)
    for g in range(len(out)):
        mine = group == g
        rows, toxic = n[mine].sum(), n[mine & (label > 0)].sum()
        if rows >= 40 and 5 <= toxic <= rows - 5:
            out[g] = _best_threshold(step[mine] / STEPS, label[mine], n[mine].astype(np.float64))
    return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column, updates: int = UPDATES, seed: int = 7
        ) -> ToxicityModel:
    """Train on all labelled documents for which ``learn`` holds; ``updates`` a task at least."""
    spark = docs.sparkSession
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("_label")))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    rows = (docs.where(learn & F.col("text").isNotNull())
            .select("doc_id", "text", lang.cast("string").alias("_lang"),
                    F.xxhash64("text", "doc_id").alias("_order"),
                    F.octet_length("text").cast("long").alias("_size")))
    sizes = rows.select("doc_id", "_size").join(known, "doc_id", "left")
    totals = {r["_label"]: r for r in sizes.groupBy("_label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_size").alias("size")).collect()}
    size = sum(r["size"] for r in totals.values())  # of the texts without a label too
    totals.pop(None, None)
    if len(totals) < 2:
        return ToxicityModel(np.empty((0, DIM)), [], np.empty(0), np.empty(0), 0.0, np.empty(0),
                             float(next(iter(totals), 0)))
    n = sum(r["n"] for r in totals.values())
    share = totals[1]["n"] / n
    tasks = max(1, min(n // LEAST_ROWS, max(spark.sparkContext.defaultParallelism,
                                            size // TASK_BYTES)))
    rounds = ROUNDS if tasks > 1 else 1
    held = F.pmod("_order", F.lit(CALIBRATION_SHARE)) == 0
    # one shuffle of the texts deals them and joins them
    parts = max(tasks, size // TASK_BYTES)
    rows = written(rows.repartition(parts, "doc_id").join(known.repartition(parts, "doc_id"), "doc_id")
                   .sortWithinPartitions("_order", "doc_id")
                   .select("text", "_label", "_lang", held.alias("_held")), "training-texts")
    model = _new_model(np.random.default_rng(seed))
    rare = _learn_vocabulary(model, rows)
    model.embedding[rare] = 0
    few = n < 10 * CALIBRATION_SHARE
    fitted = (rows if few else rows.where("not _held")).coalesce(tasks)
    each = max(1, (n if few else n - n // CALIBRATION_SHARE) // tasks)
    epochs = max(min(EPOCHS, -(-VISITS // each)), -(-updates * BATCH // each))
    descent = Descent(model)
    state = descent.state()
    schema = "id int, touched bigint, " + ", ".join(f"{c} bigint" for c in _CHANGES)
    for i in range(rounds):
        changed = (fitted.select("text", "_label")
                   .mapInArrow(_round(descent, state, rare, -(-epochs // rounds), share, seed + i),
                               schema)
                   .groupBy("id").agg(*[(F.sum(c) / F.sum("touched") / _UNITS).cast("float")
                                        .alias(c) for c in _CHANGES]).toArrow())
        if changed.num_rows:
            at = changed["id"].to_numpy()
            state[at] += np.stack([changed[c].to_numpy() for c in _CHANGES], axis=1)
        descent.restore(state)
    counted = ((rows if few else rows.where("_held")).select("text", "_label")
               .mapInArrow(_logit_counts(model, rare), "grp bigint, step bigint, label bigint, "
                                                       "n bigint")
               .groupBy("grp", "step", "label").agg(F.sum("n").alias("n")).toArrow())
    discard(rows)
    model.thresholds = (_thresholds(model, counted) if counted.num_rows
                        else np.zeros(len(model.languages) + 1))
    return model


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), FOLDS)
    model = fit(docs, table(spark, sf_dir, "labels"), remainder != 0)
    out = score(docs.withColumn("held_out", F.coalesce(remainder == 0, F.lit(False))), model,
                ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "score", "predicted", "threshold")
