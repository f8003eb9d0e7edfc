"""Top-k search, decontamination, license scans and language-model scores."""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from liftlens.llm import decontaminate, licenses, pst, topk
from tests.llm import brute
from tests.llm.conftest import odd_rows


def _brute_top(rows, k, scale=64, every=20):
    kept = []
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(scale * x) if abs(x) < 1e300 else int(x) * scale for x in v]))
    out = []
    for q, qv in kept:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in kept
                            if i != q and len(v) == len(qv))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 4_000])
def test_top_k_with_ties_and_odd_vectors(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, (np.round(rng.normal(0, 0.1, 8), 1)).tolist()) for i in range(150)]  # many ties
    rows += [(150 + i, rng.normal(0, 3, 8).tolist()) for i in range(40)]
    rows += [(400, None), (420, []), (440, [None] * 8), (460, [float("nan")] * 8),
             (480, [float("inf")] + [0.0] * 7), (None, [0.5] * 8), (500, [0.5] * 3),
             (501, [0.25] * 3), (520, [0.0] * 8), (7, rows[7][1]), (7, rows[7][1]),
             (540, [-2.0] * 8), (541, [1e30] * 8)]
    spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, "
                          "score int").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows += [(560, [-1e30, 1.0] + [0.0] * 6), (580, [1e308] * 8), (561, [2e6] * 8),
             (562, [2e6] * 7 + [2e6 + 1 / 64]), (600, [3e6, 1.0] + [0.0] * 6), (563, [2e6] * 8)]
    spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, "
                          "score int").write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    out = topk.op2_topk(spark, str(tmp_path)).collect()
    expected = [(q, n, i, s if -2**63 <= s < 2**63 else None)
                for q, n, i, s in _brute_top(rows, topk.K)]
    key = lambda r: (r[0], r[1], r[2], r[3] is None, r[3] or 0)
    assert sorted((tuple(r) for r in out), key=key) == sorted(expected, key=key)
    assert {541, 580} <= {r[0] for r in out} | {r[2] for r in out}


def test_scores_beyond_a_long_sort_by_value():
    values = [0, 5, -5, 1 << 63, -(1 << 63), (1 << 63) - 1, -(1 << 63) - 1, 1 << 300, -(1 << 300),
              (1 << 64) + 7, -(1 << 64) - 7]
    key = lambda s: (topk._beyond(s)[0], topk._beyond(s)[1] or b"",
                     0 if topk._beyond(s)[0] else s)
    assert sorted(values, key=key) == sorted(values)


def test_top_k_empty(spark, empty_dir):
    assert topk.op2_topk(spark, empty_dir).collect() == []


def test_decontamination_odd_rows(spark, odd_dir):
    rows = odd_rows()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{odd_dir}/benchmark.parquet").collect()]
    expected = []
    for row, (n, hit, ids) in zip(rows, brute.contaminated([r[1] for r in rows], items)):
        expected.append((str(row[0]), n, hit, len(ids),
                         hashlib.sha256(",".join(ids).encode()).hexdigest(),
                         hit > 0 and 20 * hit >= n))
    out = decontaminate.op10_decontaminate(spark, odd_dir).collect()
    assert sorted((str(r[0]), *r[1:]) for r in out) == sorted(expected)
    assert sum(r.n_hit > 0 for r in out) >= 5


def test_decontamination_shared_by_hash_joins(spark, monkeypatch):
    """The same result when the benchmark is too large to broadcast."""
    sf = "/root/testdata/sf0.001"
    usual = decontaminate.op10_decontaminate(spark, sf).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_FINGERPRINTS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_TEXTS", 0)
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    assert sorted(decontaminate.op10_decontaminate(spark, sf).collect()) == sorted(usual)


@pytest.mark.parametrize("window", [5, 13, 20])
def test_decontamination_by_other_windows(spark, window):
    words = [f"w{i}" for i in range(60)]
    items = [(1, " ".join(words[:15])), (2, " ".join(words[20:50])), (3, " ".join(words[52:56]))]
    texts = [" ".join(words), " ".join(words[:14]), " ".join(["x"] * 30 + words[22:44]), ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs, bench, window=window).collect()
    expected = brute.contaminated(texts, items, window)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in out} == {
        i: (n, hit, len(ids)) for i, (n, hit, ids) in enumerate(expected)}


def test_decontamination_empty(spark, empty_dir):
    assert decontaminate.op10_decontaminate(spark, empty_dir).collect() == []


def test_notices_are_found_with_their_differences(spark):
    filler = "onblea thern dou esh " * 3_000
    rows = [(1, "Released under the MIT License."), (2, filler + "Licensed under CC BY-NC 4.0.\n"),
            (3, "LICENSED UNDER THE APACHE LICENSE,\n   version 2.0\n" + filler),
            (4, "This work is licensed under the GNU Lesser Public License, version 3."),
            (5, "our license fees rose"), (6, ""), (7, None), (None, "Licensed under CC BY 4.0."),
            (8, "Released under the MIT License.\n" * 2), (8, filler)]
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((str(r.doc_id), r.license, r.differences) for r in out)
    assert found == [("1", "MIT", ""), ("2", "CC-BY-NC-4.0", ""), ("3", "Apache-2.0", ""),
                     ("4", "LGPL-3.0-only", "-general"), ("8", "MIT", ""), ("8", "MIT", ""),
                     ("None", "CC-BY-4.0", "")]
    texts = {i: t for i, t in rows[:2]}
    for r in out:
        if r.doc_id in texts and not r.differences:
            part = texts[r.doc_id].encode()[r.start:r.end].decode()
            assert part.startswith(("Released", "Licensed"))


def test_notices_in_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = {w for n, w in licenses.TEMPLATES}
    expected = sum(r.text.count(w) for r in docs.select("text").collect() for w in known)
    out = licenses.op8_licenses(spark, sf).collect()
    assert expected > 20 and len(out) == expected


def test_every_notice_of_a_crowded_block_is_found():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    wording = {n: w for n, w in reversed(licenses.TEMPLATES)}  # the short ones
    crowds = [["CC-BY-NC-4.0", "GPL-3.0-only", "MIT"], ["CC-BY-SA-4.0", "MIT", "Apache-2.0"],
              sorted(wording), sorted(wording, reverse=True)]
    for names in crowds:
        found = scanner.scan("\n".join(wording[n] for n in names).encode())
        assert [(n[2], n[5]) for n in found] == [(n, "") for n in names]


def test_altered_notices_and_names_are_told_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    rng = np.random.default_rng(6)
    for at, (_, wording) in enumerate(licenses.TEMPLATES):
        words = wording.split()
        for _ in range(8):  # a fifth of the words replaced, as the wording rule allows
            put = list(words)
            for i in rng.choice(len(put), len(put) // 5, replace=False):
                put[i] = "".join(rng.choice(list("bdfgkmpqvwxz"), 6))
            around = ["".join(rng.choice(list("abcdefghiklmnoprstuvwy"), rng.integers(2, 9)))
                      for _ in range(140)]
            text = " ".join(around[:70] + put + around[70:]).encode()
            found = scanner.places([w.lower() for w in licenses._WORD.findall(text)], at)
            if found and scanner.cue.search(text):
                assert scanner.scan(text)
    later = dict(licenses.TEMPLATES[:-1])["GPL-3.0-or-later"]
    for text, name in (
            (later, "GPL-3.0-or-later"),
            (later.replace("3.0", "2.0").replace("version 3", "version 2"), "GPL-2.0-or-later"),
            ("This work is licensed under the GNU Affero General Public License, version 3.",
             "AGPL-3.0-only"),
            ("This library is licensed under the GNU General Public License, version 2 or later.",
             "GPL-2.0-or-later"),
            ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
            ("Licensed under the Apache License, Version 7.", "NOASSERTION"),
            ("Licensed under CC BY-NC-ND 3.0.", "CC-BY-NC-ND-3.0"),
            ("/* SPDX-License-Identifier: BSD-2-Clause */", "BSD-2-Clause"),
            ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later")):
        found = scanner.scan(text.encode())
        assert [n[2] for n in found] == [name], (text, found)


def test_every_template_is_found_at_its_place():
    """Notices set into prose, some with a plain word replaced: what was planted, no more."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    rng = np.random.default_rng(8)

    def prose(n):
        return " ".join("".join(rng.choice(list("aeioubdfgklmnrst"), rng.integers(2, 9)))
                        for _ in range(n))

    for _ in range(25):
        text, planted = prose(20), []
        for t in rng.choice(len(licenses.TEMPLATES), 6, replace=False):
            name, wording = licenses.TEMPLATES[t]
            words = wording.rstrip(".").split()
            plain = [i for i, w in enumerate(words[1:-1], 1) if w.isalpha() and len(words) > 10
                     and not licenses.IDENTITY.fullmatch(w.lower().encode())]
            changes = ""
            if plain and rng.random() < 0.5:
                i = int(rng.choice(plain))
                changes = f"-{words[i].lower()} +zzqx"
                words[i] = "zzqx"
            start = len(text) + 1
            text += " " + " ".join(words)
            planted.append((start, len(text), name, changes))
            text += ". " + prose(int(rng.integers(3, 400)))
        found = [(n[0], n[1], n[2], n[5]) for n in scanner.scan(text.encode())]
        assert found == planted


def test_the_size_reduction_decides_between_overlapping_templates(monkeypatch):
    """Both wordings of Apache-2.0 and of the ISC stand in these texts; the reduction picks."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = dict(licenses._TEXTS)["ISC"].encode()
    assert {scanner.names[c[2]] for c in scanner.candidates(text)} >= {"0BSD", "ISC"}
    assert [n[2] for n in scanner.scan(text)] == ["ISC"]
    monkeypatch.setattr(scanner, "reduction", lambda block, template: template == scanner.names.index(
        "0BSD"))
    assert [n[2] for n in scanner.scan(text)] == ["0BSD"]


def test_notices_longer_than_a_piece_apart_and_at_its_edges():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    wording = "Released under the MIT License. "
    dense = (wording * 2_000).encode()
    assert [n[2] for n in scanner.scan(dense)] == ["MIT"] * 2_000
    for gap in range(0, 9 * scanner.longest, 397):
        text = ("license " + "x" * gap + " " + wording + "redistribut" * 40).encode()
        assert [(n[2], n[5]) for n in scanner.scan(text)] == [("MIT", "")]


def test_license_odd_rows(spark, odd_dir, empty_dir=None):
    assert licenses.op8_licenses(spark, odd_dir).collect() == []


def test_language_model_odd_rows(spark, odd_dir, monkeypatch):
    rows = odd_rows()
    expected, total = brute.base_scores([(r[0], r[1]) for r in rows])
    for frequent in (5, 1 << 16):
        monkeypatch.setattr(pst, "FREQUENT", frequent)
        out = pst.op7_pst(spark, odd_dir).collect()
        assert {r.train_tokens for r in out} == {total}
        got = sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out)
        assert got == sorted((str(row[0]), n, k, round(s, 6))
                             for row, (n, k, s) in zip(rows, expected))
        assert all(r.score < 0 for r in out)


def test_language_model_beats_the_base_on_held_out_texts(spark):
    out = pst.op7_pst(spark, "/root/testdata/sf0.01").toPandas()
    assert (out.score <= 0).all()
    known = out[~out.held_out]
    assert known.score.sum() > known.base_score.sum()


def test_language_model_is_a_distribution(spark, tmp_path):
    """The probabilities of all texts of up to three words of two letters sum to less than 1."""
    words = ["".join(p) for n in (1, 2) for p in itertools.product("ab", repeat=n)]
    texts = [" ".join(p) for n in (0, 1, 2, 3) for p in itertools.product(words, repeat=n)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    out = pst.op7_pst(spark, str(tmp_path)).toPandas()
    total = (10 ** out.score).sum()
    assert 0.3 < total <= 1 + 1e-9


def _tree_scores(learned, texts):
    """Scores by a suffix tree of dictionaries."""
    def line(text):
        return b" " * pst.DEPTH + b" ".join(text.encode().lower().split()) + b"\n"

    counts = {}
    for text in map(line, learned):
        for i in range(pst.DEPTH, len(text)):
            for d in range(pst.DEPTH + 1):
                nexts = counts.setdefault(text[i - d:i], {})
                nexts[text[i]] = nexts.get(text[i], 0) + 1
    size = {c: sum(n.values()) for c, n in counts.items()}
    kept = set()
    for c, nexts in counts.items():
        if c and size[c] >= 2 and pst.DIVERGENCE <= sum(
                n * math.log(n / size[c] / counts[c[1:]][s] * size[c[1:]])
                for s, n in nexts.items()):
            kept |= {c[i:] for i in range(len(c))}

    def log10(context, s):
        p = (counts[b""].get(s, 0) + 1) / (size[b""] + 256)
        for d in range(1, pst.DEPTH + 1):
            if (c := context[len(context) - d:]) in kept:
                p = (counts[c].get(s, 0) + pst.SMOOTHING * p) / (size[c] + pst.SMOOTHING)
        return math.log10(p)

    return [sum(log10(t[i - pst.DEPTH:i], t[i]) for i in range(pst.DEPTH, len(t)))
            for t in map(line, texts)]


@pytest.mark.parametrize("share", [2e-6, 0.002, 0.05, 2.0])
def test_language_model_keeps_rare_contexts_at_every_size(spark, tmp_path, monkeypatch, share):
    """The same scores by the whole tree, however few of its states are frequent."""
    rng = np.random.default_rng(2)
    words = ["the", "then", "other", "mother", "été", "больше", "語言", "zq", "qz", "ab", "abba"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(80)] + ["", "ÿ new!"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(pst, "LEAST_SHARE", share)
    out = sorted(pst.op7_pst(spark, str(tmp_path)).collect())
    expected = _tree_scores([texts[r.doc_id] for r in out if not r.held_out], texts)
    assert np.allclose([r.score for r in out], expected, rtol=1e-5)


def test_language_model_keeps_contexts_of_plain_parents_and_all_bytes(spark, tmp_path):
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(14):  # the third last letter and the one after tell the next, fewer letters nothing
        bits = [0, 1, 1]
        for noise in rng.random(3_000) < 0.05:
            bits.append(bits[-2] ^ bits[-3] ^ int(noise))
        texts.append("".join("ab"[b] for b in bits))
    cycle = "".join(map(chr, range(0x430, 0x450))) + "".join(map(chr, range(0x450, 0x4B0)))
    texts += [cycle * 20] * 14  # more than 64 bytes
    for part, least in ((texts[:14], -0.15), (texts[14:], -0.02)):
        at = f"{tmp_path}/{-least}"
        spark.createDataFrame(list(enumerate(part)), "doc_id long, text string"
                              ).write.parquet(f"{at}/documents.parquet")
        for r in pst.op7_pst(spark, at).collect():
            assert r.score > least * len(part[r.doc_id].encode())


def test_language_model_empty(spark, empty_dir):
    assert pst.op7_pst(spark, empty_dir).collect() == []


def test_a_task_sends_a_counted_run_once(monkeypatch):
    """A row for every run of every chunk went into the shuffle before."""
    monkeypatch.setattr(pst, "CHUNK_BYTES", 16)
    texts = pa.array(["some words here", "some more words", None, "", "a  b\tc", "more words here"] * 40)
    out = list(pst._counted(iter([pa.RecordBatch.from_arrays([texts], names=["t"])] * 2)))
    keys = [key for batch in out for key in zip(*[batch.column(i).to_pylist() for i in (0, 1)])]
    counts = {k: sum(n for b in out for kind, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist())
                     if kind == k) for k in (pst._WORD, pst._RUN, pst._TEXT)}
    assert len(keys) == len(set(keys))
    assert counts[pst._TEXT] == 480 and counts[pst._WORD] == 80 * (3 + 3 + 0 + 0 + 3 + 3)
    assert counts[pst._RUN] == 80 * (16 + 16 + 1 + 1 + 6 + 16)


def test_grams_of_more_texts_than_a_number_holds():
    owner = np.sort(np.random.default_rng(2).integers(0, 100_000, 3_000))
    grams = np.random.default_rng(3).integers(0, 3, 3_000) << 40
    got = pst._by_text_and_gram(grams, owner)
    pairs = sorted(zip(owner.tolist(), grams.tolist()))
    expected = [(k[1], len(list(g)), k[0]) for k, g in itertools.groupby(pairs)]
    assert list(zip(*[x.tolist() for x in got])) == expected
    assert [len(x) for x in pst._by_text_and_gram(grams[:0], owner[:0])] == [0, 0, 0]
