"""Packing and sharding: laws of the results, and a plain best fit."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pandas as pd

from liftlens.llm import packing, sharding, simhash
from tests.llm.conftest import odd_rows


def _plain_best_fit(sizes, sources, clusters, capacity):
    bins = []  # [room, sources, clusters]
    placed = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(b[0], n) for n, b in enumerate(bins) if b[0] > 0 and b[0] >= sizes[i]
                and sources[i] not in b[1] - {None} and clusters[i] not in b[2] - {None}]
        if not fits:
            bins.append([capacity, set(), set()])
        n = min(fits)[1] if fits else len(bins) - 1
        bins[n][0] -= sizes[i]
        bins[n][1].add(sources[i])
        bins[n][2].add(clusters[i])
        placed[i] = n
    return placed


def test_best_fit_is_the_tightest_compatible_bin():
    rnd = random.Random(2)
    for _ in range(20):
        n = rnd.randint(0, 120)
        sizes = [rnd.randint(0, 100) for _ in range(n)]
        sources = [rnd.choice([None, "a", "b", "c", "d", "e"]) for _ in range(n)]
        clusters = [rnd.choice([None, 1, 2, 3, *range(10, 99)]) for _ in range(n)]
        bins, _ = packing.best_fit(sizes, sources, clusters, 100)
        assert bins == _plain_best_fit(sizes, sources, clusters, 100)


def _check_packing(rows, texts, capacity):
    pieces = Counter()
    for _, group in rows.groupby("bin"):
        assert group["size"].sum() <= capacity
        for column in ("source", "cluster"):
            assert not group[column].dropna().duplicated().any()
        at = 0
        for r in group.sort_values(["bin_offset", "size"]).itertuples():
            assert r.bin_offset == at
            at += r.size
    for r in rows.itertuples():
        pieces[(str(r.doc_id), r.start, r.size)] += 1
    expected = Counter()
    for i, text in texts:
        size = len((text or "").encode())
        for start in range(0, max(size, 1), capacity):
            expected[(str(i), start, min(capacity, size - start))] += 1
    assert pieces == expected


def test_packing_of_documents(spark):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.op6_packing(spark, "/root/testdata/sf0.01").toPandas()
    _check_packing(rows, list(zip(docs.doc_id, docs.text)), packing.CAPACITY)
    # the bins are those of the plain best fit, group by group in the order of the items
    per_group = rows.groupby(rows.bin // (1 << 20), sort=False)
    for _, group in per_group:
        sources, clusters = ([None if pd.isna(v) else v for v in group[c]]
                             for c in ("source", "cluster"))
        assert (group.bin % (1 << 20)).tolist() == _plain_best_fit(
            group["size"].tolist(), sources, clusters, packing.CAPACITY)
    # the clusters are the components of near-duplicates
    found = simhash.op3_simhash(spark, "/root/testdata/sf0.01").toPandas()
    component = dict(zip(found.doc_id, found.component_id))
    whole = rows.dropna(subset=["cluster"]).drop_duplicates("doc_id")
    named = whole.doc_id.map(component)
    assert len(whole) == (docs.text.fillna("") != "").sum()
    assert whole.groupby("cluster").doc_id.count().max() > 1
    assert len(set(zip(named, whole.cluster))) == whole.cluster.nunique() == named.nunique()


def test_packing_odd_rows_in_small_groups(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    from pyspark.sql import functions as F
    rows = packing.pack(docs, F.octet_length("text"), F.col("source"),
                        F.when(F.col("text") != "", F.xxhash64("text")), capacity=1_000,
                        per_group=16).toPandas()
    rows = rows.assign(doc_id=rows.doc_id.astype("Int64").astype(str).replace("<NA>", "None"))
    _check_packing(rows, [(r[0], r[1]) for r in odd_rows()], 1_000)


def test_empty(spark, empty_dir):
    assert packing.op6_packing(spark, empty_dir).collect() == []
    assert sharding.op9_sharding(spark, empty_dir).collect() == []


def test_sharding_odd_rows(spark, odd_dir, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_BLOCK", 5)
    monkeypatch.setattr(sharding, "COPIES_PER_PIECE", 2)
    out = sharding.op9_sharding(spark, odd_dir).toPandas()
    expected = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                      for i, t, *_ in odd_rows())
    ids = ["None" if pd.isna(i) else str(int(i)) for i in out.doc_id]
    assert sorted(zip(ids, out["size"], out.text_crc32)) == expected
    for _, shard in out.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    assert (pd.Series(ids).groupby(ids).size().shape[0]
            == len({(i, s) for i, s in zip(ids, out.shard)}))  # the id decides the shard


def test_growth_moves_rows_into_the_new_shard_only(spark):
    out = sharding.op9_sharding(spark, "/root/testdata/sf0.1").toPandas()
    moved = out[out.shard != out.grown_shard]
    assert (moved.grown_shard == 8).all()
    assert 0.08 < len(moved) / len(out) < 0.14
    share = out.groupby("shard").size() / len(out)
    assert len(share) == 8 and share.between(0.11, 0.14).all()


def test_weights_confine_movement_to_their_subtree(spark):
    from pyspark.sql import functions as F
    tree = sharding.EIGHT_SHARDS
    heavier = {**tree, "region1": {**tree["region1"], "rack0": {4: 1.0, 5: 3.0}}}
    rows = spark.range(20_000).select(
        sharding.place(F.col("id").cast("string"), tree).alias("a"),
        sharding.place(F.col("id").cast("string"), heavier).alias("b")).select("a.*", "b.*").toPandas()
    rows.columns = ["region", "rack", "shard", "region2", "rack2", "shard2"]
    assert (rows[rows.region != rows.region2].region2 == "region1").all()
    stayed = rows[(rows.region == rows.region2) & (rows.region == "region0")]
    assert (stayed.shard == stayed.shard2).all()
    assert (rows.shard2 == 5).mean() > 0.25
