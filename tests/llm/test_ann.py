import numpy as np
import pytest
from pyspark.sql import functions as F

from opinia.llm import ann


def brute(rows, asked, k):
    known = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in known:
        if asked(q):
            near = sorted((float(np.sqrt(((known[q] - v) ** 2).sum())), i) for i, v in known.items() if i != q)
            out[q] = near[:k]
    return out


def search(spark, rows, k=10, **settings):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, codes string, rank int")
    found = ann.search(df, F.col("vec_id") % 20 == 0, k=k, **settings).collect()
    out = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 200)
    monkeypatch.setattr(ann, "QUERIES", 10)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 40] + 0.3 * rng.standard_normal(8)]) for i in range(1500)]
    found, true = search(spark, rows), brute(rows, lambda i: i % 20 == 0, 10)
    assert found.keys() == true.keys()
    hits = [len({i for _, i in found[q]} & {i for _, i in true[q]}) for q in true]
    assert np.mean(hits) >= 9
    for q in true:
        assert found[q] == sorted(found[q])


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0] * 8) for i in range(60)] + [(i, [float(x) for x in (i % 3, 1, 2, 3, 4, 5, 6, 7)]) for i in range(60, 90)]
    rows += [(100, None), (120, [0.0] * 8), (140, [float("nan")] * 8), (160, [None] + [1.0] * 7), (180, [1.0] * 5), (None, [1.0] * 8), (0, [1.0] * 8)]
    found, true = search(spark, rows), brute(rows, lambda i: i % 20 == 0, 10)
    assert found.keys() == true.keys()
    for q in (0, 20, 40):
        assert found[q] == [(0.0, i) for i in range(11) if i != q][:10]
    for q in (60, 80):
        assert [i for _, i in found[q]] == [i for _, i in true[q]]
        assert [s for s, _ in found[q]] == pytest.approx([s for s, _ in true[q]])


def test_few_and_no_rows(spark):
    assert search(spark, [(20, [1.0, 2.0]), (21, [2.0, 2.0])]) == {20: [(1.0, 21)]}
    assert search(spark, []) == {} and search(spark, [(21, [1.0, 2.0])]) == {}
