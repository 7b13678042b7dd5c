from itertools import combinations

import numpy as np
import pytest

from opinia.llm import toxicity as T


def slow_kernel(a, b):
    """Shared quadruples by their definition."""

    def quads(word):
        marked, out = "^" + word, {}
        for at in combinations(range(len(marked)), T.ORDER):
            if at[-1] - at[0] < T.SPAN:
                key = "".join(marked[i] for i in at)
                out[key] = out.get(key, 0.0) + T.DECAY ** (at[-1] - at[0] + 1)
        return out

    x, y = quads(a), quads(b)
    size = [float(T.norms(np.array([len(w) + 1]))[0]) for w in (a, b)]
    return sum(v * y.get(k, 0.0) for k, v in x.items()) / size[0] / size[1]


WORDS = ["idiot", "id.iot", "stupid", "stpid", "wonderful", "ab", "", "idiotic", "moron", "more"]


def test_kernel_by_definition():
    marks = T._Landmarks(WORDS[:6])
    found = marks.similar(WORDS)
    for i, a in enumerate(WORDS):
        for j, b in enumerate(WORDS[:6]):
            assert found[i, j] == pytest.approx(slow_kernel(T.core(a), T.core(b)), abs=1e-5)


def test_gaps_keep_words_close():
    marks = T._Landmarks(["stupid"])
    near = marks.similar(["stupid", "st*upid", "stuxpid", "wonderful", "studio"])[:, 0]
    assert near[0] > near[1] > 3 * near[3] and near[2] > 3 * near[3]


def test_table_is_the_machine():
    marks = T._Landmarks(WORDS[:5])
    w = np.linspace(-1, 1, marks.root.shape[1] + 1)
    direct = marks.vectors(WORDS) @ w
    assert marks.machine(w).margins(WORDS) == pytest.approx(direct, abs=1e-4)


def test_sentences():
    assert list(T.words_of("One two. three\nfour\n\n you i d i o t now")) == [["one", "two."], ["three"], ["four"], ["you", "idiot", "now"]]


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (8, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    found = T.score(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r["score"] <= 1 for r in found)
    assert T.score(nothing, labels).count() == 0
    none = T.score(awkward, labels.limit(0)).collect()
    assert len(none) == len(found) and {r["score"] for r in none} == {0.0}
    kept = T.keep_clean(awkward, labels)
    assert kept.columns == awkward.columns and T.keep_clean(nothing, labels).count() == 0


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    found = T.score(known, labels).join(labels, "doc_id").where(T.bucket("doc_id", 4) == 2).collect()
    hits = sum(r["predicted"] for r in found if r["toxic"])
    wrong = sum(r["predicted"] for r in found if not r["toxic"])
    assert hits > 0.85 * sum(r["toxic"] for r in found)
    assert wrong < 0.03 * sum(1 - r["toxic"] for r in found)
