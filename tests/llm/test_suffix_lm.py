import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from opinia.llm import suffix_lm as S


def tree_of(docs, least=5):
    found, n = np.unique(S.windows([p for d in docs for p in S.segments(S.stream(d))])[0], return_counts=True)
    moves, contexts = [], []
    for k in range(S.DEPTH + 1):
        move, at = np.unique(found & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        c = np.bincount(at, n).astype(np.int64)
        context, at = np.unique(move >> 8, return_inverse=True)
        size = np.bincount(at, c).astype(np.int64)
        moves.append((move[c >= least], c[c >= least]))
        contexts.append((context[size >= 2 * least], size[size >= 2 * least]))
    return S.grow(moves, contexts, int(n.sum()))


@pytest.fixture(scope="module")
def tree():
    rng = np.random.default_rng(1)
    words = [b"ab", b"abc", b"the", b"thing", b"x"]
    return tree_of([[words[k] for k in rng.integers(0, 5, 20)] for _ in range(80)])


def test_every_state_is_a_distribution(tree):
    assert sum(map(len, tree.contexts)) > 20
    for context in (b"the t", b"hing ", b"\0\0\0\0\n", b"zzzzz", b"c abc"):
        code = (int.from_bytes(context, "big") << 8) + np.arange(256)
        assert tree.probability(code).sum() == pytest.approx(1.0)


def test_contexts_are_closed_under_suffixes(tree):
    for k in range(2, S.DEPTH + 1):
        assert set((tree.contexts[k] & ((1 << 8 * (k - 1)) - 1)).tolist()) <= set(tree.contexts[k - 1].tolist())


def test_parts_add_up(tree, monkeypatch):
    text = S.stream([b"the", b"thing", b"abc"] * 20)
    whole = tree.log10(list(S.segments(text))).sum()
    monkeypatch.setattr(S, "STEP", 7)
    assert tree.log10(list(S.segments(text))).sum() == pytest.approx(whole)
    code = [int.from_bytes((S.BEFORE + text)[i : i + S.DEPTH + 1], "big") for i in range(len(text))]
    assert whole == pytest.approx(np.log10(tree.probability(np.array(code))).sum())


def test_base_scores_by_definition(spark, awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    docs = [
        (r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")) + [None])
        for r in rows
    ]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(t for i, ts in docs if not held(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), held(i), len(ts), sum(counts[t] > 0 for t in ts), n,
         round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), 3))
        for i, ts in docs
    )
    for frequent in (4e-6, 0.1):  # all words in the tasks, or most of them joined
        found = S.score(awkward, frequent=frequent).collect()
        got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in found)
        assert got == expected and all(r["score"] < 0 for r in found)
    assert S.score(nothing).count() == 0


def test_better_than_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = S.score(docs).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_rare_contexts_are_retained_and_scored(spark):
    """The tree of tables is the one of one process, with contexts seen twice; whether the tasks hold
    all states, some or none of them, scores are the same."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = docs.collect()
    split = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in rows}
    learnt = [w for i, w in split.items() if zlib.crc32(str(i).encode()) % 10]
    found, n = np.unique(S.windows([p for d in learnt for p in S.segments(S.stream(d))])[0], return_counts=True)
    moves, contexts = [], []
    for k in range(S.DEPTH + 1):
        move, at = np.unique(found & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        context, to = np.unique(move >> 8, return_inverse=True)
        c = np.bincount(at, n).astype(np.int64)
        size = np.bincount(to, c).astype(np.int64)
        moves.append((move, c))
        contexts.append((context[size >= 2], size[size >= 2]))
    tree = S.grow(moves, contexts, int(n.sum()))
    expected = {i: tree.log10(list(S.segments(S.stream(w)))).sum() for i, w in split.items()}
    for room in (S.ROOM, 3000, 0):
        got = {r["doc_id"]: r["score"] for r in S.score(docs, room=room).collect()}
        assert got == pytest.approx(expected)


def test_the_floor_is_a_count(spark):
    """A string seen a few times among ten million bytes has its states."""
    common = [(i, "the river ran past the old mill " * 6000) for i in range(60)]
    rare = [(i, "qzjxv") for i in range(1000, 1006)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in S.score(docs).collect()}
    assert score[1001] / 6 > -1.5
