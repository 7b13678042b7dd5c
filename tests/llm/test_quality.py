import random

import numpy as np
import pytest

from opinia.llm import quality


def slow_repeats(words, window=5):
    seen = {}
    for k in range(len(words) - window + 1):
        seen.setdefault(tuple(words[k : k + window]), []).append(k)
    inside = {k + j for at in seen.values() if len(at) > 1 for k in at for j in range(window)}
    return len(inside)


@pytest.mark.parametrize("most", [quality.MOST_DIRECT, 3])
def test_repeated_words(monkeypatch, most):
    monkeypatch.setattr(quality, "MOST_DIRECT", most)
    rng = random.Random(5)
    for _ in range(200):
        words = [b"%d" % rng.randrange(rng.choice([2, 5, 30])) for _ in range(rng.randrange(60))]
        assert quality.repeated_words(words) == slow_repeats(words)


def test_counts_by_definition():
    found = dict(zip(quality.COUNTS, quality.counts("Ä b#\n\n b#\nb# $x!\n \nb#\tB&".encode())))
    assert found["n_words"] == 7 and found["word_chars"] == 14 and found["n_symbols"] == 6
    assert found["n_dup_lines"] == 0 and found["n_lines"] == 4
    again = dict(zip(quality.COUNTS, quality.counts(b"a b\n\n\na b\na b")))
    assert again["n_dup_lines"] == 2


def test_estimates_find_the_accuracies():
    rng = np.random.default_rng(6)
    good = rng.random(40_000) < 0.85
    right = [(0.99, 0.3), (0.97, 0.5), (0.995, 0.6), (0.9, 0.4)]
    votes = []
    for a, b in right:
        vote = np.where(good, np.where(rng.random(len(good)) < a, 1, -1), np.where(rng.random(len(good)) < b, -1, 1))
        votes.append(np.where(rng.random(len(good)) < 0.1, 0, vote))
    patterns, n = np.unique(np.stack(votes, 1), axis=0, return_counts=True)
    model = quality.fit([(*p, c) for p, c in zip(patterns.tolist(), n.tolist())], ("a", "b", "c", "d"))
    assert model.good == pytest.approx(0.85, abs=0.05)
    assert np.abs(model.right - np.array(right)).max() < 0.1


def test_awkward_rows(awkward, nothing):
    found = {(r["doc_id"], r["n_words"]): r for r in quality.judge(awkward).collect()}
    assert quality.judge(awkward).count() == awkward.count() and quality.judge(nothing).count() == 0
    assert all(found[(i, 0)]["base_failed"] and not found[(i, 0)]["kept"] for i in (4, 5, 6))
    assert found[(1, 35)]["kept"] and found[(9, 30_000)]["n_repeat_words"] == 0
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r["kept"] for r in quality.judge(awkward).collect())
    assert quality.keep_good(nothing).count() == 0


def test_verdicts_against_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").select("kept", "quality").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) > 0.95 * len(rows)
