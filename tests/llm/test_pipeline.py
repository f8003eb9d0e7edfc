"""The corpus pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import random
import re
import time
from pathlib import Path

import pandas as pd

import corpus_pipeline as pipeline
from liftlens.llm import common
from liftlens.llm.common import written
from tests.llm import brute
from tests.llm.conftest import SCHEMA, odd_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _check_stages(spark, docs, folder, columns):
    toxic = written(pipeline.drop_toxic(spark, docs, folder), "t")
    assert toxic.columns == columns
    rows = toxic.toPandas()
    kept = written(pipeline.drop_near_duplicates(spark, toxic, folder), "t")
    assert kept.columns == columns
    prints = [brute.fingerprint(t) for t in rows.text]
    ids = [None if pd.isna(i) else int(i) for i in rows.doc_id]
    roots = brute.linked(prints)
    out = kept.toPandas()
    assert len(out) == len(set(roots))
    assert sorted(str(i) for i in brute.smallest_ids(ids, roots) if i is not None) is not None
    least = {r: i for r, i in zip(roots, brute.smallest_ids(ids, roots))}
    assert sorted(map(str, least.values())) == sorted(
        "None" if pd.isna(i) else str(int(i)) for i in out.doc_id)

    cut = written(pipeline.cut_repeats(spark, kept, folder), "t")
    assert cut.columns == columns and cut.schema == kept.schema
    after = cut.toPandas()
    expected = brute.repeats(out.text.tolist(), 400)
    lost = {(str(i), n - removed) for i, (n, removed, _, _) in zip(out.doc_id, expected)}
    for r in after.itertuples():
        size = len((r.text or "").encode())
        assert any(i == str(r.doc_id) and 0 <= n - size <= 12 for i, n in lost)

    clean = written(pipeline.drop_contaminated(spark, cut, folder), "t")
    assert clean.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    good = [hit == 0 or 20 * hit < n
            for n, hit, _ in brute.contaminated(after.text.tolist(), items)]
    assert clean.count() == sum(good)
    packed = pipeline.pack_bins(spark, clean, folder)
    assert packed.select("doc_id").distinct().count() == clean.select("doc_id").distinct().count()


def test_stages_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    _check_stages(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder, COLUMNS)


def test_stages_on_odd_rows(spark, odd_dir):
    _check_stages(spark, spark.read.parquet(f"{odd_dir}/documents.parquet"), odd_dir,
                  [f.name for f in SCHEMA.fields])
    assert len(odd_rows()) > 20


def test_run_on_empty_tables(spark, empty_dir):
    assert pipeline.run(spark, empty_dir).collect() == []


def test_toxic_documents_go(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {r.doc_id for r in pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    toxic, fine = set(labels[labels.toxic == 1].doc_id), set(labels[labels.toxic == 0].doc_id)
    assert len(toxic & left) <= 0.1 * len(toxic)
    assert len(fine - left) <= 0.02 * len(fine)


def _without_passages(texts, words):
    """Each text without the bytes that ``words`` words in a row cover which another text has."""
    spans = [list(re.finditer(rb"[^\x20\x09-\x0D]+", t.encode())) for t in texts]
    where = {}
    for i, found in enumerate(spans):
        for p in range(len(found) - words + 1):
            where.setdefault(tuple(m[0] for m in found[p:p + words]), set()).add(i)
    out = []
    for text, found in zip(texts, spans, strict=True):
        keep = bytearray(b"\x01" * len(text.encode()))
        for p in range(len(found) - words + 1):
            if len(where[tuple(m[0] for m in found[p:p + words])]) > 1:
                a, b = found[p].start(), found[p + words - 1].end()
                keep[a:b] = bytes(b - a)
        out.append(bytes(c for c, k in zip(text.encode(), keep, strict=True) if k).decode())
    return out


def test_shared_passages_are_cut(spark):
    """Passages of over 50 short words stayed in the texts before: 400 bytes had to repeat."""
    rnd = random.Random(5)
    prose = lambda n: ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 5)))
                       for _ in range(n)]
    passage, other = prose(51), prose(60)
    texts = [prose(70) + passage + prose(20), passage + prose(9), prose(30) + passage[:50],
             other, prose(5) + other + prose(5) + other, ["b"] * 300, prose(51), prose(90)]
    texts = ["  ".join(t) if i == 1 else " ".join(t) for i, t in enumerate(texts)]
    texts += [texts[6], "short", "short", ""]  # copies lose all: their words are shared
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(pipeline.STAGES)["suffix-array dedup"]
    got = {r.doc_id: r for r in stage(spark, docs, "").collect()}
    longest = [r[1] for r in brute.repeats(texts, 400)]
    assert longest[5] and not any(longest[:5] + longest[6:])
    for i, text in enumerate(_without_passages(texts, 51)):
        if i != 5:  # repeats itself
            assert got[i].text == text and got[i].n_chars == len(text)
    assert all(got[i].text != texts[i] for i in (0, 1, 3, 4, 5, 6, 8))
    assert all(got[i].text == texts[i] for i in (2, 7, 9, 10, 11))


def _left(spark, stage, docs, folder):
    """Rows of a stage, and the names of the tables that lie there while it is lazy."""
    shared = Path(common.shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    out = stage(spark, docs, folder)
    left = {p.name.rpartition("-")[0] for p in set(shared.iterdir()) - before}
    return out.collect(), left


def test_spent_tables_go(spark):
    """The tables of anchors, blocks and windows, and the training texts, lay there before until
    the driver ended."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)
    rows, left = _left(spark, stages["suffix-array dedup"], docs, folder)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert left == {"distinct_texts", "text-marks"}
    assert len(rows) == len(texts) and any(r.text != texts[r.doc_id] for r in rows)
    rows, left = _left(spark, stages["toxicity"], docs, folder)
    assert not left and rows


def test_written_tables_leave_no_shuffle_files(spark):
    """They stayed before until the driver collected its garbage."""
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                .localDirsString())
    files = lambda: {p.name for d in dirs for p in Path(d).rglob("shuffle_*")}
    before, setting = files(), spark.conf.get(common.SHUFFLE_CLEANUP)
    rows = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    made = [written(rows, "t"), common.bucketed(rows, "t", "k", 2)]
    for _ in range(50):  # they go in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == setting
    assert [df.count() for df in made] == [7, 7]
