"""Toxicity and language identification: held-out accuracy, fixed inputs, odd rows."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from liftlens.llm import common, langid, toxicity
from tests.llm.brute import remainder
from tests.llm.conftest import odd_rows

SF = "/root/testdata/sf0.01"


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    out = toxicity.op1_toxicity(spark, folder).toPandas()
    labels = pd.read_parquet(f"{folder}/labels.parquet").groupby("doc_id")["toxic"].max()
    assert len(out) == 10_000 and out.score.between(0, 1).all()
    assert ((out.score >= 0.5).astype(int) == out.predicted).all()
    assert (out.held_out == [remainder(i, 5) == 0 for i in out.doc_id]).all()
    held = out[out.held_out].join(labels, "doc_id", "inner")
    assert (held.predicted == held.toxic).mean() >= 0.97


def test_toxicity_reads_only_the_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = F.col("doc_id") % 2 == 0
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s"))
    a, b = (toxicity.fit(d, labels, learn, 100) for d in (docs, other))
    assert (a.embedding == b.embedding).all() and (a.weights == b.weights).all()
    one, two = (toxicity.score(d, a, ["doc_id"]).orderBy("doc_id", "score").collect()
                for d in (docs, other))
    assert one == two


def _toxic_rows(spark, count, long):
    """(documents, labels): every fourth text says so in one word, in a text of so many words."""
    docs = spark.range(count).select(
        F.col("id").alias("doc_id"), F.concat(
            F.expr(f"repeat(concat('day', id % 7, ' '), {long})"),
            F.when(F.col("id") % 4 == 0, "vile").otherwise("kind")).alias("text"),
        F.lit("en").alias("lang"))
    return docs, docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 AS int) AS toxic")


def test_toxicity_learns_from_long_texts(spark):
    """Texts over 64 KB were left out of the sample that the model was trained on before."""
    docs, labels = _toxic_rows(spark, 60, 15_000)
    model = toxicity.fit(docs, labels, F.lit(True), 60)
    assert model.constant is None
    got = toxicity.score(docs.join(labels, "doc_id"), model, ["toxic"]).collect()
    assert all(r.predicted == r.toxic for r in got)


def test_toxicity_learns_from_every_row(spark, monkeypatch):
    """No row is left out (3,000 a class before); averages of several tasks tell the classes
    apart, and the same rows give the same model."""
    monkeypatch.setattr(toxicity, "LEAST_ROWS", 1_200)
    docs, labels = _toxic_rows(spark, 4_500, 3)
    calibrated = []
    choose = toxicity._thresholds
    monkeypatch.setattr(toxicity, "_thresholds", lambda model, table: (
        calibrated.append(table["n"].to_pandas().sum()), choose(model, table))[1])
    a, b = (toxicity.fit(docs, labels, F.lit(True)) for _ in range(2))
    assert calibrated[0] == calibrated[1] and 750 < calibrated[0] < 1_050
    assert (a.embedding == b.embedding).all() and a.offset == b.offset
    got = toxicity.score(docs.join(labels, "doc_id"), a, ["toxic"]).collect()
    assert all(r.predicted == r.toxic for r in got)


def test_language_groups_are_learned(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").dropna(subset=["text", "lang"])
    docs = docs[docs.text.str.len() > 200].head(900)
    words = [toxicity.tokens(data, np.array([0, len(data)]))[0]
             for data in (np.frombuffer(t.encode(), np.uint8) for t in docs.text)]
    fit, test = slice(0, 600), slice(600, None)
    langs = docs.lang.tolist()
    names, telling = toxicity.learn_groups(words[fit], langs[fit])
    assert names == sorted(set(docs.lang))
    model = toxicity.ToxicityModel(np.empty(0), [], np.empty(0), np.empty(0), 0.0, np.empty(0),
                                   languages=names, telling=telling)
    told = [toxicity.groups(model, w, np.zeros(len(w), int), 1)[0] for w in words[test]]
    right = [g > 0 and names[g - 1] == lang for g, lang in zip(told, langs[test], strict=True)]
    assert np.mean(right) >= 0.95
    assert toxicity.learn_groups([], []) [0] == []
    assert toxicity.learn_groups(words, [None] * len(words))[0] == []


def test_long_texts_in_pieces(monkeypatch):
    """The scores of a text do not depend on the pieces that it is worked on in."""
    rng = np.random.default_rng(4)
    parts = ["w" * 700, "\u00e9" * 301, "", "A", "7;,", "Stra\u00dfe"]
    words = [str(rng.choice(parts)) if rng.random() < 0.05 else
             "".join(rng.choice(list("abcdeéß"), rng.integers(1, 9))) for _ in range(3_000)]
    text = " ".join(words)
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.array([0, len(data)])
    toxic = toxicity.train([text[i:i + 60] for i in range(0, 6_000, 60)], [0, 1] * 50)
    lang = langid.train([text[i:i + 60] for i in range(0, 6_000, 60)], ["x", "y"] * 50)
    whole = [toxicity.tokens(data, ends), langid.class_scores(lang, data, ends)]
    logit = toxicity.logits(toxic, *whole[0], 1)
    for limit in (64, 1_000):
        monkeypatch.setattr(common.word_safe_pieces, "__defaults__", (limit,))
        monkeypatch.setattr(toxicity, "CHUNK_BYTES", limit)
        monkeypatch.setattr(toxicity, "SLICE", limit)
        pieces = list(common.word_safe_pieces(data))
        assert len(pieces) > 10 and pieces[0][0] == 0 and pieces[-1][1] == len(data)
        for got, expected in zip(toxicity.tokens(data, ends), whole[0], strict=True):
            assert (got == expected).all()
        assert np.allclose(toxicity.logits(toxic, *whole[0], 1), logit, atol=1e-5)
        assert np.allclose(langid.class_scores(lang, data, ends), whole[1], atol=1e-4)


def test_a_text_of_64_megabytes():
    """Scoring works on pieces: its own memory stays far below a gigabyte."""
    code = """
import resource, sys
import numpy as np
from liftlens.llm import common, langid, toxicity
toxic = toxicity.train(["good day", "bad thing"] * 40, [0, 1] * 40)
lang = langid.train(["good day", "guten tag"] * 40, ["en", "de"] * 40)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
data = np.frombuffer(b"good day to bad things " * (64 * 1024 * 1024 // 23), np.uint8)
ends = np.array([0, len(data)])
toxicity.logits(toxic, *toxicity.tokens(data, ends), 1)
langid.class_scores(lang, data, ends)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=Path(__file__).parents[2])
    assert float(out.stdout) < 1_000


def test_the_sample_is_bounded_over_all_languages(spark):
    docs = spark.range(4_000).selectExpr(
        "id AS doc_id", "concat('word', id) AS text", "concat('l', id % 300) AS lang")
    seen = []
    old = langid.train
    try:
        langid.train = lambda texts, languages: seen.append((list(texts), languages))
        langid.fit(docs, F.lit(True), 5, 700)
    finally:
        langid.train = old
    texts, languages = seen[0]
    assert len(texts) == 700 and len(set(languages)) == 300
    assert max(pd.Series(languages).value_counts()) == 3


def test_langid_held_out(spark):
    out = langid.op4_langid(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    held = out[out.held_out].join(docs, "doc_id")
    assert (held.lang_pred == held.lang).mean() >= 0.97
    assert (out.held_out == [remainder(i, 3) == 1 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all()


@pytest.mark.parametrize("query", [toxicity.op1_toxicity, langid.op4_langid])
def test_odd_and_empty(spark, odd_dir, query):
    out = query(spark, odd_dir).toPandas()
    assert len(out) == len(odd_rows()) and out.score.notna().all()
    same = out[out.doc_id == 0].score
    assert len(same) == 3 and same.nunique() == 1
    if "lang_pred" in out:
        by_id = dict(zip(out.doc_id, out.lang_pred, strict=True))
        assert [by_id[i] for i in (4, 5, 6, 7, 17)] == ["und"] * 5
        assert set(out.lang_pred) <= {"en", "fr", "und"}


@pytest.mark.parametrize("query", [toxicity.op1_toxicity, langid.op4_langid])
def test_empty_tables(spark, empty_dir, query):
    assert query(spark, empty_dir).collect() == []
