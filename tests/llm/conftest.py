from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use for their own columns
    T.StructField("score", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("bin", T.StringType()),
    T.StructField("size", T.StringType())])


def odd_rows():
    """Nulls in every column, empty and very long texts, copies, repeated rows and ids."""
    rnd = random.Random(3)
    words = ["the", "and", "Of", "le", "der", "niño", "alpha", "beta", "GAMMA", "delta", "x1", "été"]
    long = " ".join(rnd.choice(words) + str(i % 97) for i in range(30_000))
    body = " ".join(rnd.choice(words) + str(rnd.randint(0, 999)) for _ in range(120))
    near = body.replace(" ", "  ", 3)
    texts = [body, near, body + " more", long, "", None, " \t\n", "...!!", "word", "two words",
             "été ÉTÉ été", "a" * 5_000, "ab " * 900, body, body, None, "", "12 34", long + " end"]
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 4}" if i % 5 else None,
             len(t) if t else None, "a", None, "k", None, "z") for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, body, None, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None, None),
             (3, "another text under a used id", "en", "s1", 28, "a", "b", "c", "d", "e")]
    return rows


@pytest.fixture
def odd_dir(spark, tmp_path):
    """A folder of tables whose documents are odd."""
    spark.createDataFrame(odd_rows(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (1, None, 1), (None, 0, 1), (8, 1, 0), (9, 0, 1), (9, 0, 0)],
                          "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "two words"), (2, None), (3, ""), (None, "word"), (1, "two words"),
                           (4, odd_rows()[0][1][30:400])], "item_id long, text string"
                          ).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.fixture
def empty_dir(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string"
                          ).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int"
                          ).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)
