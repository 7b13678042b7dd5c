import hashlib
import random
import zlib

import duckdb
import pytest

from opinia.llm import catalogue, trie

SCHEMA = "conv_id long, turn long, role string, text string, base string, turns string, path string, `range` string, lcp string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def rebuilt_paths(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, order, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + mine[h:]
    return out


def brute(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    rows = set()
    for node, some in members.items():
        d = len(node)
        below = [m for m in members if m[:d] == node]
        children = {m for m in below if len(m) == d + 1}
        leaves = [m for m in below if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in below)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = ",".join(map(str, sorted(c for c in some if len(paths[c]) == d)))
        parent = min(members[node[:-1]]) if d else None
        rows.add((min(some), d, parent, len(some), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def conversations(seed, n, words, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(5 * n), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn else "system", rng.choice(words)))
    return rows


@pytest.mark.parametrize(
    "rows",
    [
        conversations(1, 60, ["a", "bb"], 9),
        conversations(2, 150, ["", "é", "yes", "no, thanks"], 4),
        # Equal conversations run over all ranges.
        [(c, t, "user", "hello" * t) for c in range(1, 400) for t in range(7)]
        + [(c + 1000, *r) for c, *r in conversations(3, 40, ["x", "y"], 30)],
        # Most are left without turns.
        [(100 * c + 1, 0, "user", "a") for c in range(60)],
        [(7, None, None, None), (7, 0, "user", "x"), (7, 0, "user", "x"), (8, 1, "b", None), (None, 0, "a", "b")],
    ],
)
def test_against_brute_force(spark, rows):
    found = [tuple(r[c] for c in COLUMNS) for r in trie.nodes(trie.rebuilt(table(spark, rows))).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rebuilt_paths(rows))


def test_layout_does_not_matter(spark):
    rows = conversations(4, 80, ["a", "b"], 12)
    base = table(spark, rows)
    assert set(trie.nodes(trie.rebuilt(base)).collect()) == set(trie.nodes(trie.rebuilt(base.repartition(9))).collect())


def test_intervals_over_many_ranges(spark):
    """With a range for every few conversations, most intervals leave their range on both sides."""
    rows = conversations(5, 120, ["a", "b"], 6) + [(c, t, "system", "s") for c in range(1000, 1060) for t in range(5)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        found = {tuple(r[c] for c in COLUMNS) for r in trie.nodes(trie.rebuilt(table(spark, rows))).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == brute(rebuilt_paths(rows))


def test_nothing(spark):
    assert trie.nodes(trie.rebuilt(table(spark, []))).count() == 0
    assert trie.nodes(trie.rebuilt(table(spark, [(None, 0, "a", "b")]))).count() == 0


def test_one_long_conversation(spark):
    rows = [(1, t, "user", "w" * (t % 3)) for t in range(5000)] + [(2, 0, "user", "long " * 100_000)]
    found = trie.nodes(trie.rebuilt(table(spark, rows)))
    top = found.agg({"depth": "max", "n_leaves": "max"}).first()
    assert found.count() == len(brute_sizes(rebuilt_paths(rows))) and top["max(depth)"] >= 4995 and top["max(n_leaves)"] <= 2


def brute_sizes(paths):
    return {(c, d) for c, p in paths.items() for d in range(1, len(p) + 1)} | {(None, 0)}


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    con.execute(catalogue.SQL["op11_prefix_trie"])
    names = [c[0] for c in con.description]
    theirs = {tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in con.fetchall()}
    assert theirs == {tuple(r[c] for c in COLUMNS) for r in catalogue.op11_prefix_trie(spark, folder).collect()}
