"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its subwords: every run of three
bytes inside a word (with its boundaries) and every whole word, hashed into
``1 << BUCKET_BITS`` buckets. A linear layer and a softmax follow; both layers
are trained together by stochastic gradient descent in numpy. Averaging and
the linear layer commute, so scoring sums one short row of class scores a
subword.

Training rows are a bounded sample: up to ``SAMPLE_PER_LANGUAGE`` texts of each
language, in hash order, up to ``LONGEST_SAMPLE`` bytes, and ``SAMPLE_ROWS`` of
all languages together (the first of each, then the second of each, and so on,
however many languages there are). Texts over ``CHUNK_BYTES`` are scored in
pieces that cut no word and whose class scores are added. A part is held back
to fit the softmax temperature and the rejection threshold: the score below
which at most ``REJECTED_SHARE`` of the right answers lie (a text below it is
marked ``rejected``; the answer stays the likeliest language).

Defined results: a NULL text or one without a letter is ``und`` with score 0;
without training rows every text is ``und``; rows with a NULL language are not
learned from; repeated rows are answered each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftlens.llm.common import (id_remainder, letters, lower_latin, prefix_hash, reduce_rows,
                                 span_hash, table, text_chunks, word_safe_pieces, word_spans)

SAMPLE_PER_LANGUAGE = 1_500
SAMPLE_ROWS = 6_000
LONGEST_SAMPLE = 32 << 10
BUCKET_BITS = 15
DIM = 12
EPOCHS = 8
BATCH = 16
RATE = 0.5
CALIBRATION_SHARE = 5
REJECTED_SHARE = 0.005
FOLDS = 3
UNKNOWN = "und"


@dataclass
class LanguageModel:
    names: list[str]
    scores: np.ndarray  # (buckets, languages): embedding times linear layer
    offset: np.ndarray
    temperature: float
    rejection: float


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of every subword, by text."""
    data = lower_latin(data)
    is_word = letters(data)
    start, end, owner = word_spans(is_word, offsets)
    shift = np.uint64(64 - BUCKET_BITS)
    prefix = prefix_hash(data)
    words = (span_hash(prefix, start, end) >> shift).astype(np.int32)
    # runs of three bytes: a word with a boundary byte (0) on either side
    padded = np.where(is_word, data, np.uint8(0)).astype(np.uint32)
    left = np.concatenate([[0], padded[:-1]]).astype(np.uint32)
    right = np.concatenate([padded[1:], [0]]).astype(np.uint32)
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    left[inner] = 0
    right[inner - 1] = 0
    at = np.flatnonzero(is_word)
    runs = ((left << np.uint32(16)) | (padded << np.uint32(8)) | right)[at] + np.uint32(1)
    runs = ((runs * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
    owners = np.concatenate([owner, np.searchsorted(offsets, at, side="right") - 1])
    order = np.argsort(owners, kind="stable")
    return np.concatenate([words, runs])[order], owners[order]


def _features(texts: Iterable[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares, for each text."""
    out = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        found, n = np.unique(subwords(data, np.array([0, len(data)]))[0], return_counts=True)
        out.append((found, (n / max(1, n.sum())).astype(np.float32)))
    return out


def train(texts: Iterable[str], languages: list[str], seed: int = 11) -> LanguageModel:
    names = sorted(set(languages))
    buckets = 1 << BUCKET_BITS
    if not names:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    features = _features(texts)
    y = np.array([names.index(x) for x in languages])
    order = rng.permutation(len(y))
    held = order[::CALIBRATION_SHARE] if len(y) >= 10 * CALIBRATION_SHARE else order
    fit = np.setdiff1d(order, held) if len(held) < len(order) else order
    embed = rng.normal(0, 0.1, (buckets, DIM)).astype(np.float32)
    weights = rng.normal(0, 0.5, (DIM, len(names))).astype(np.float32)
    offset = np.zeros(len(names), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        rng.shuffle(fit)
        for at in range(0, len(fit), BATCH):
            rows = fit[at:at + BATCH]
            sizes = [len(features[r][0]) for r in rows]
            ids = np.concatenate([features[r][0] for r in rows])
            part = np.concatenate([features[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), sizes)
            mean = reduce_rows(np.add, embed[ids] * part[:, None], owner, len(rows), 0.0)
            z = mean @ weights + offset
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            g_mean = (p @ weights.T).astype(np.float32)
            weights -= rate * (mean.T @ p).astype(np.float32) / len(rows)
            offset -= rate * 0.1 * p.mean(axis=0).astype(np.float32)
            # a subword has a small share of its text: a larger step for its embedding
            np.add.at(embed, ids, -rate * 20 * part[:, None] * g_mean[owner])
    model = LanguageModel(names, (embed @ weights).astype(np.float32), offset, 1.0, 0.0)
    z = np.array([(model.scores[f] * s[:, None]).sum(axis=0) + offset
                  for f, s in (features[r] for r in held)])
    losses = []
    for t in np.geomspace(0.05, 5, 40):
        q = z / t
        q = q - q.max(axis=1, keepdims=True)
        losses.append((float((np.log(np.exp(q).sum(axis=1)) - q[np.arange(len(held)), y[held]])
                             .mean()), t))
    model.temperature = float(min(losses)[1])
    best, which = _softmax(model, z)
    right = np.sort(best[which == y[held]])
    if len(right):
        model.rejection = float(right[int(REJECTED_SHARE * len(right))])
    return model


def _softmax(model: LanguageModel, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q = z / model.temperature
    q = np.exp(q - q.max(axis=1, keepdims=True))
    q /= q.sum(axis=1, keepdims=True)
    which = q.argmax(axis=1)
    return q[np.arange(len(q)), which], which


def class_scores(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, languages): the mean class scores of each text's subwords plus the offset."""
    rows = len(offsets) - 1
    total, count = np.zeros((rows, len(model.names)), np.float32), np.zeros((rows, 1), np.int64)
    pieces = word_safe_pieces(data) if rows == 1 else [(0, len(data))]
    for s, e in pieces:
        ids, owner = subwords(data[s:e], np.clip(offsets, s, e) - s)
        total += reduce_rows(np.add, model.scores[ids], owner, rows, 0.0)
        count += np.bincount(owner, minlength=rows)[:, None]
    return total / np.maximum(count, 1) + model.offset


def _predictor(model: LanguageModel):
    names = np.array([*model.names, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            lettered = np.asarray(batch.column(batch.num_columns - 2))
            which, best = np.full(n, len(model.names)), np.zeros(n)
            if model.names:
                for a, b, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                    z = class_scores(model, data, offsets)
                    best[a:b], which[a:b] = _softmax(model, z)
                which = np.where(lettered, which, len(model.names))
                best = np.where(lettered, best, 0.0)
            columns = batch.columns[:-2] + [
                pa.array(names[which], pa.string()), pa.array(best),
                pa.array((which == len(model.names)) | (best < model.rejection))]
            yield pa.RecordBatch.from_arrays(columns, names=[
                *batch.schema.names[:-2], "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text"
            ) -> DataFrame:
    """The kept columns plus lang_pred, score (0 to 1) and rejected."""
    frame = docs.select(*keep, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
                        .alias("_has_letter"), F.col(text).alias("_language_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-2])
    return frame.mapInArrow(_predictor(model), f"{schema}, lang_pred string, score double, "
                                               f"rejected boolean")


def fit(docs: DataFrame, learn: Column, per_language: int = SAMPLE_PER_LANGUAGE,
        in_all: int = SAMPLE_ROWS) -> LanguageModel:
    """Train on a bounded sample of the documents for which ``learn`` holds."""
    rows = docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull())
    order = F.xxhash64("text", "doc_id")
    picked = (rows.where((F.octet_length("text") <= LONGEST_SAMPLE) & F.col("text").rlike(r"\p{L}"))
              .select("lang", order.alias("_order")).distinct()
              .withColumn("_rank", F.row_number().over(
                  Window.partitionBy("lang").orderBy("_order")))
              .where(F.col("_rank") <= per_language)
              .orderBy("_rank", "_order").limit(in_all).drop("_rank"))
    # at most in_all rows, however many languages
    sample = (rows.select("lang", "text", order.alias("_order"))
              .join(F.broadcast(picked), ["lang", "_order"])
              .dropDuplicates(["lang", "_order"]).orderBy("lang", "_order")
              .select("lang", "text").toArrow())
    return train((text.as_py() for text in sample["text"]), sample["lang"].to_pylist())


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), FOLDS)
    model = fit(docs, remainder != 1)
    out = predict(docs.withColumn("held_out", F.coalesce(remainder == 1, F.lit(False))), model,
                  ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")
