"""A corpus pipeline: filter, deduplicate, decontaminate and pack ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the
columns of ``documents`` (the last: the packing). ``run`` writes each stage's
result as Parquet in the shared folder and reads it back for the next one.

NULL and empty texts, repeated rows and NULL ids are handled as the operators
define it. Extra columns of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from liftlens.llm.common import id_remainder, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"),
                         id_remainder(F.col("doc_id"), toxicity.FOLDS) != 0)
    scored = toxicity.score(docs.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns}), model,
                            [f"_in_{c}" for c in docs.columns], "_in_text")
    return (scored.where("predicted = 0").drop(*toxicity.SCORES)
            .withColumnsRenamed({f"_in_{c}": c for c in docs.columns}))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id."""
    key = suffix_dedup.text_key(F.col("text"))
    found = simhash.near_duplicates(docs.select("doc_id", "text", key.alias("text_key")),
                                    keep=("text_key",))
    one = (found.groupBy("component")
           .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
                .alias("first"))
           .select(F.col("first.doc_id").alias("__id"), F.col("first.text_key").alias("__first")))
    # the rows with that id and text; dropDuplicates, if several of them are alike
    return (docs.withColumn("__key", key)
            .join(one, (F.col("__key") == F.col("__first"))
                  & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
            .dropDuplicates(["__key", "doc_id"]).drop("__key"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str, passage: int = 0) -> DataFrame:
    """Bytes of strings that start in two places or more are cut from the texts; and, if
    ``passage`` is given, so many words in a row that two texts or more have."""
    lost = (suffix_dedup.repeated_spans(docs, with_text=True, passage=passage)
            .select(F.col("key").alias("__key"), F.col("kept").alias("__kept")))
    cut = docs.withColumn("__key", suffix_dedup.text_key(F.col("text"))).join(lost, "__key", "left")
    text = F.coalesce("__kept", "text")
    n_chars = F.when(F.col("__kept").isNull(), F.col("n_chars")).otherwise(
        F.length("__kept").cast(docs.schema["n_chars"].dataType))
    return cut.withColumns({"text": text, "n_chars": n_chars}).select(*docs.columns)


def cut_repeats_and_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated byte strings are cut, and passages of over 50 words that texts share."""
    return cut_repeats(spark, docs, sf_dir, suffix_dedup.PASSAGE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = judged.where("contaminated").select(F.col("text_sha256").alias("__bad")).distinct()
    key = F.sha2(F.col("text").cast("binary"), 256)
    return docs.join(bad, key == F.col("__bad"), "left_anti")


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents by bin: best fit, no two of one source or of equal texts."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats_and_passages),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_bins),
]

#: The stages train a model, follow links and cut bytes: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
