"""SimHash components and repeated byte strings against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re

import pandas as pd
import pytest

from liftlens.llm import common, simhash, suffix_dedup
from liftlens.llm.components import components
from tests.llm import brute
from tests.llm.conftest import odd_rows


def _simhash_rows(ids, texts):
    prints = [brute.fingerprint(t) for t in texts]
    least = brute.smallest_ids(ids, brute.linked(prints))
    return sorted((str(i), f"{f:016x}", str(c)) for i, f, c in zip(ids, prints, least))


def _got(frame):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in frame.collect())


def test_simhash_on_documents(spark):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    assert _got(simhash.op3_simhash(spark, "/root/testdata/sf0.001")) == _simhash_rows(
        docs.doc_id.tolist(), docs.text.tolist())


def test_simhash_odd_rows(spark, odd_dir):
    rows = odd_rows()
    assert _got(simhash.op3_simhash(spark, odd_dir)) == _simhash_rows(
        [r[0] for r in rows], [r[1] for r in rows])


def test_simhash_empty(spark, empty_dir):
    assert simhash.op3_simhash(spark, empty_dir).collect() == []


def test_crowded_cells_keep_every_component(spark, monkeypatch):
    """Dense groups of fingerprints, through cells cut into many tiles and through plain pairs."""
    rnd = random.Random(1)
    prints = {rnd.getrandbits(64) for _ in range(200)}
    for _ in range(2):
        base = rnd.getrandbits(64)
        for _ in range(400):
            x = base
            for _ in range(rnd.randint(0, 6)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    frame = spark.createDataFrame([(x,) for x in signed], "f long")
    roots = brute.linked(list(prints))
    for crowded, tile in ((10, 40), (256, 2_000)):
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        monkeypatch.setattr(simhash, "TILE", tile)
        found = {r.node: r.root for r in components(simhash.links_within(frame)).collect()}
        got = [found.get(x, x) for x in signed]
        assert len(set(zip(roots, got))) == len(set(roots)) == len(set(got))


def test_repeats_on_documents(spark):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    expected = dict(zip(docs.doc_id, brute.repeats(docs.text.tolist(), 400)))
    out = suffix_dedup.op5_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(docs) and sum(r.n_removed for r in out) > 0
    for r in out:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id]


def test_repeats_odd_rows(spark, odd_dir):
    rows = odd_rows()
    expected = brute.repeats([r[1] for r in rows], 400)
    out = suffix_dedup.op5_suffix_dedup(spark, odd_dir).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) \
        == sorted((str(row[0]), *e) for row, e in zip(rows, expected))


def test_repeats_empty(spark, empty_dir):
    assert suffix_dedup.op5_suffix_dedup(spark, empty_dir).collect() == []


@pytest.mark.parametrize("length", [16, 48, 64])
def test_repeats_of_other_lengths(spark, length):
    rnd = random.Random(length)
    base = ["".join(rnd.choice("ab") for _ in range(200)) for _ in range(4)]
    texts = [None, "", "é" * 90]
    for i in range(80):
        text = "".join(rnd.choice("abcdé") for _ in range(rnd.randint(0, 120)))
        if i % 3 == 0:
            a = rnd.randint(0, 180)
            text += rnd.choice(base)[a:a + rnd.randint(5, 150)] + text[:7]
        texts.append("xy" * rnd.randint(0, 60) + text if i % 10 == 0 else text)
    texts += texts[:7]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    lost = {bytes(r.key): r for r in suffix_dedup.repeated_spans(
        frame, length=length, with_text=True).collect()}
    for text, (_, removed, spans, digest) in zip(texts, brute.repeats(texts, length)):
        whole = hashlib.sha256((text or "").encode()).digest()
        row = lost.get(whole[:16])
        assert (removed, spans, digest) == (
            (row.n_removed, len(row.spans), row.kept_sha256) if row else (0, 0, whole.hex()))


def test_intermediate_tables_can_be_removed(spark, odd_dir):
    out = suffix_dedup.op5_suffix_dedup(spark, odd_dir).collect()
    assert common._FOLDERS and common._TABLES and out
    folders = [f.removeprefix("file:") for f in common._FOLDERS]
    common.remove_written(spark)
    assert not any(os.path.exists(f) for f in folders)
    assert not common._FOLDERS and not common._TABLES


def test_the_links_of_a_large_star_are_split(spark):
    """No task gets all links of a centre: the smallest neighbours are a table of their own."""
    from liftlens.llm.components import _large_star, components
    from tests.test_skew import SPLIT_ALL, settings
    links = spark.range(1, 60_001).selectExpr("id AS a", "0L AS b")
    with settings(spark, {**SPLIT_ALL, "spark.sql.shuffle.partitions": "8",
                          "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
                          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096"}):
        moved = _large_star(links.repartition(4))
        # the centre is every link's smaller end: joined on it, cut by adaptive execution
        assert moved.where("b <> 0").count() == 0
        moved.collect()
        assert "skew=true" in moved._jdf.queryExecution().executedPlan().toString()
        assert components(links).where("root <> 0").count() == 0


def _sharing(texts, words):
    """Numbers of the texts that share so many words in a row with another one."""
    where = {}
    for i, text in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for p in range(len(w) - words + 1):
            where.setdefault(tuple(w[p:p + words]), set()).add(i)
    return {i for found in where.values() if len(found) > 1 for i in found}


def test_passages_below_the_length_are_named(spark, tmp_path):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    prose = lambda n: [word() for _ in range(n)]
    passage = prose(51)
    texts = [prose(80) + passage + prose(30), passage, ["x"] + passage, passage[1:] + prose(9),
             prose(40) + passage[:50] + prose(10), prose(200), passage[:25] + prose(1) + passage[25:],
             ["a"] * 51, ["b"] * 300, ["b"] * 60, prose(51)]
    texts = ["  ".join(t) if i == 2 else " ".join(t) for i, t in enumerate(texts)]
    texts += [texts[5], texts[10], "same short text", "same short text", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in suffix_dedup.op5_suffix_dedup(spark, str(tmp_path)).collect()}
    removed = {i for i, r in enumerate(brute.repeats(texts, 400)) if r[1]}
    assert {i for i, r in out.items() if r.loses_bytes} == removed
    assert {i for i, r in out.items() if r.repeats} == removed | _sharing(texts, 51)
    assert {0, 1, 2, 10, 12} <= {i for i, r in out.items() if r.repeats}
    assert not {3, 4, 6, 7, 13, 15, 16} & {i for i, r in out.items() if r.repeats}


def test_passages_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    out = suffix_dedup.op5_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    sharing = {docs.doc_id[i] for i in _sharing(docs.text.tolist(), 51)}
    assert {r.doc_id for r in out if r.repeats} == sharing | {
        r.doc_id for r in out if r.n_removed}
    assert {r.doc_id for r in out if r.repeats and not r.n_removed}


def test_anchors_of_a_text_are_found_once(spark, monkeypatch):
    """Both kinds of anchors were worked out twice a text before: to count and to put together."""
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abcdef") * rnd.randint(1, 9) for _ in range(150)) for _ in range(20)]
    texts = [t[:300] + texts[0][:450] if i % 3 else t for i, t in enumerate(texts)]
    seen = {name: spark.sparkContext.accumulator(0) for name in ("_anchor_rows", "_passage_anchors")}

    def counting(find, total):
        def made(size):
            inner = find(size)

            def run(batches):
                def noted():
                    for batch in batches:
                        total.add(batch.num_rows)
                        yield batch
                yield from inner(noted())
            return run
        return made

    for name, total in seen.items():
        monkeypatch.setattr(suffix_dedup, name, counting(getattr(suffix_dedup, name), total))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffix_dedup.repeated_spans(docs, passage=suffix_dedup.PASSAGE).count()
    assert found > 10
    assert [total.value for total in seen.values()] == [len(set(texts))] * 2
