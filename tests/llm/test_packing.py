import random

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from opinia.llm import catalogue, packing


def check(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_plan_places_each_piece_once():
    rng = random.Random(4)
    for capacity in (7, 30, 100):
        for _ in range(40):
            histogram = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(rng.randint(1, 20))}
            taken, used = {n: [] for n in histogram}, {}
            for length, first, count, copies, sequence, offset in packing.plan(histogram, capacity):
                for k in range(count * copies):
                    taken[length].append(first + k)
                    used.setdefault(sequence + k // copies, []).append((offset + k % copies * length, length))
            assert {n: sorted(r) for n, r in taken.items()} == {n: list(range(c)) for n, c in histogram.items()}
            for places in used.values():
                end = 0
                for offset, length in sorted(places):
                    assert offset == end
                    end += length
                assert end <= capacity and sum(3 * n > capacity for _, n in places) <= 2
            # Never worse than first-fit decreasing on the same pieces.
            bins = []
            for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
                at = next((i for i, room in enumerate(bins) if room >= n), None)
                if at is None:
                    bins.append(capacity - n)
                else:
                    bins[at] -= n
            assert len(used) <= len(bins) + 1


def test_runs_do_not_follow_the_corpus():
    few = packing.plan({n: 10 for n in range(1, 2049)}, 2048)
    many = packing.plan({n: 10**9 for n in range(1, 2049)}, 2048)
    assert len(many) < 3 * len(few) < 60_000


def test_ids_are_those_of_the_tokenizer(awkward):
    own = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    found = {}
    for r in catalogue.pieces_of(awkward.dropDuplicates(["doc_id", "text"]), 2048).collect():
        found.setdefault((r["doc_id"], r["length"] if r["doc_id"] is None else None), []).append(r)
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    for (doc_id, _), pieces in found.items():
        if doc_id is None:
            continue
        pieces.sort(key=lambda r: r["piece"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces])
        assert ids.tolist() == own.encode(texts[doc_id], add_special_tokens=False).ids + [0]
        assert [r["length"] for r in pieces[1:]] == [2048] * (len(pieces) - 1)
        assert [r["start"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces])[:-1].tolist()


def test_a_million_blanks(spark):
    texts = [" " * 1_000_000, "a" + "\n" * 1_000_000 + "b", "short"]
    own = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = packing.pack(catalogue.pieces_of(docs, 2048), 2048).collect()
    check(found, 2048)
    for k, text in enumerate(texts):
        pieces = sorted((r["piece"], bytes(r["ids"])) for r in found if r["doc_id"] == k)
        ids = np.frombuffer(b"".join(p for _, p in pieces), "<u4")
        assert ids.tolist() == own.encode(text, add_special_tokens=False).ids + [0]


def test_pieces_keep_their_columns(spark):
    rows = [(i, 0, 1 + i * 37 % 100, "x", "y", i) for i in range(300)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length int, _row string, _slice string, _rank int")
    found = packing.pack(pieces, 100)
    assert found.columns == [*pieces.columns, "sequence_id", "offset"]
    placed = found.collect()
    assert check(placed, 100) < 200 and {tuple(r)[:6] for r in placed} == set(rows)
    again = packing.pack(found, 100)
    assert again.columns == found.columns and again.count() == 300


@pytest.mark.parametrize("special", ["a<|endoftext|> b", "  x\n\n y", "don't I'LL", "a" * 3000, " " * 9000 + "\n", "é　\x85z"])
def test_odd_texts_are_encoded_alike(special):
    own = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    fast = packing.encoding(public.path("byte_bpe_50k.tiktoken"), public.PATTERN, {"<|endoftext|>": 50256})
    assert fast.encode(special, allowed_special="all") == own.encode(special, add_special_tokens=False).ids


def test_awkward_rows(awkward, nothing, monkeypatch):
    pieces = catalogue.pieces_of(awkward, 2048)
    rows = packing.pack(pieces, 2048).collect()
    assert len(rows) == pieces.count() and check(rows, 2048) <= -(-sum(r["length"] for r in rows) // 2048) + 1
    assert packing.pack(catalogue.pieces_of(nothing, 2048), 2048).count() == 0
    monkeypatch.setattr(packing, "SLICE", 1)
    sliced = packing.pack(pieces, 2048).collect()
    assert len(sliced) == len(rows) and check(sliced, 2048) == check(rows, 2048)
