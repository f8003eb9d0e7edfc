"""Filter audit against a count of every order, document by document."""

from __future__ import annotations

import itertools
import random
import re

from liftlens.llm import audit
from liftlens.llm.common import table

from .conftest import odd_rows

LABELS = [(0, 1, 0), (1, None, 1), (None, 0, 1), (8, 1, 0), (9, 0, 1), (9, 0, 0)]


def _fails(rows):
    """(part, failed letters, doc) of rows (doc, text, lang)."""
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    for doc, text, lang in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
               "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)),
               "E": doc is not None and doc > least[t]}
        yield lang or "", {f for f, b in bad.items() if b}, doc


def _expected(rows, good, toxic):
    found = list(_fails(rows))
    out = {}
    for part in {p for p, _, _ in found}:
        docs = [(bad, doc) for p, bad, doc in found if p == part]
        shapley = dict.fromkeys(audit.FILTERS, 0)
        for order in itertools.permutations(audit.FILTERS):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                fails = sum(f in bad for bad, _ in docs)
                out[(part, "".join(order), step)] = [
                    len(left), len(gone), fails - len(gone),
                    sum(bad == {f} for bad, _ in docs),
                    sum(d in good for _, d in gone), sum(d in toxic for _, d in gone)]
                shapley[f] += len(gone)
        for order in itertools.permutations(audit.FILTERS):
            for step, f in enumerate(order, 1):
                out[(part, "".join(order), step)].append(shapley[f])
    return {k: tuple(v) for k, v in out.items()}


def _got(frame):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in audit._COUNTS)
            for r in frame.collect()}


def test_odd_rows_against_every_order(spark, odd_dir):
    got = _got(audit.op11_audit(spark, odd_dir))
    rows = [(r[0], r[1], r[2]) for r in odd_rows()]
    assert got == _expected(rows, good={0, 8}, toxic={1, 9})
    assert any(v[1] for k, v in got.items() if k[1][k[2] - 1] == "E")


def test_given_tables_against_every_order(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, sf, "documents").collect()]
    labels = table(spark, sf, "labels").collect()
    assert _got(audit.op11_audit(spark, sf)) == _expected(
        rows, {r.doc_id for r in labels if r.quality == 1},
        {r.doc_id for r in labels if r.toxic == 1})


def test_extra_columns_and_empty_tables(spark, empty_dir, tmp_path):
    assert audit.op11_audit(spark, empty_dir).collect() == []
    spark.createDataFrame([(1, "Aa $", "en", 0, b"k", True)],
                          "doc_id long, text string, lang string, n int, key binary, is_first boolean"
                          ).write.parquet(f"{tmp_path}/x/documents.parquet")
    spark.createDataFrame([(1, 1, 1, "m", 3)], "doc_id long, quality int, toxic int, mask string, n int"
                          ).write.parquet(f"{tmp_path}/x/labels.parquet")
    rows = _got(audit.op11_audit(spark, f"{tmp_path}/x"))
    assert len(rows) == 600 and rows[("en", "ABCDE", 1)] == (0, 1, 0, 0, 1, 1, 40)


def test_shapley_regression_is_the_mean_over_orders():
    rnd = random.Random(5)
    regression = audit.ShapleyRegression()
    for _ in range(20):
        v = audit.coalition_removals({m: rnd.randint(0, 10**9) for m in range(32)})
        assert v[0] == 0
        sums = [0] * 5
        for order in itertools.permutations(range(5)):
            before = 0
            for i in order:
                sums[i] += v[before | 1 << i] - v[before]
                before |= 1 << i
        assert [120 * x for x in regression.solve(v)] == sums


def test_words_of_long_texts_are_counted_in_pieces(monkeypatch):
    text = b" ".join(b"w%d" % (i % 701) for i in range(5_000)) + b"\n" + b"x" * 300
    whole = audit.word_counts(text)
    assert whole == (5_001, 702)
    monkeypatch.setattr(audit, "PIECE", 97)
    assert audit.word_counts(text) == whole
    assert audit.word_counts(b"") == (0, 0)
