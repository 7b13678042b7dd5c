import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from opinia.llm import catalogue, topk

SCHEMA = "vec_id long, embedding array<double>, row string, v string, score string, asks string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def brute(rows, k, every):
    usable = [
        (i, c, [math.floor(64.0 * x) for x in v])
        for i, (c, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    limit = lambda x: max(-(2**63), min(x, 2**63 - 1))
    out = []
    for i, q, a in usable:
        if q is None or q % every:
            continue
        scored = [(-limit(sum(x * y for x, y in zip(a, b))), c is None, c or 0, c) for j, c, b in usable if j != i]
        out += [(q, rank, c, -s) for rank, (s, _, _, c) in enumerate(sorted(scored, key=lambda t: t[:3])[:k], 1)]
    return sorted(out, key=repr)


def found_in(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(seed, n, width, scale=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.2) * scale for _ in range(width)]) for i in range(n)]


@pytest.fixture(params=[(16, 8), (4096, 2048)], ids=["small blocks", "one block"])
def blocks(request, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS", request.param[0])
    monkeypatch.setattr(topk, "QUERIES", request.param[1])


@pytest.mark.parametrize(
    "rows",
    [
        vectors(1, 200, 16),
        # Sums beyond single and double precision.
        vectors(2, 60, 8, 1e3),
        vectors(3, 60, 8, 1e7),
        # A third is one vector, and every score of it ties.
        vectors(4, 100, 6) + [(1000 + i, [0.5, -0.25, 0.0, 0.1, 0.2, 0.3]) for i in range(50)],
        # Few values, so that most scores tie.
        [(i, [float(i % 3), float(i % 2)]) for i in range(150)],
        [(0, [-1.0] * 4), (5, [-0.5] * 4), (10, [1.0] * 4)],
    ],
)
def test_against_brute_force(spark, blocks, rows):
    assert found_in(topk.search(table(spark, rows), F.col("vec_id") % 5 == 0, k=7)) == brute(rows, 7, 5)


def test_awkward_vectors(spark, blocks):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [3.0, 1.0]), (None, [3.0, 1.0]), (5, None), (10, [1.0, None]),
        (15, [float("nan"), 1.0]), (20, [float("inf"), 1.0]), (25, []), (30, [1.0]), (35, [1.0, 1.0, 1.0]), (40, [0.0, 0.0]),
        (41, [1e300, -1e300]), (45, [-1e300, 1.0]), (50, [0.5] * 3000),
    ]
    # A floor beyond longs is the nearest long.
    near = [(c, None if v is None else [x if x is None or abs(x) < 1e20 or not math.isfinite(x) else math.copysign(2**57, x) for x in v]) for c, v in rows]
    expected = [r for r in brute(near, 5, 5)]
    found = found_in(topk.search(table(spark, rows), F.col("vec_id") % 5 == 0, k=5))
    assert [r[:3] for r in found] == [r[:3] for r in expected]


def test_few_and_none(spark):
    one = table(spark, [(0, [1.0])])
    assert topk.search(one, F.col("vec_id") % 5 == 0).count() == 0
    assert topk.search(one.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    three = table(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0])])
    assert found_in(topk.search(three, F.col("vec_id") == 0)) == [(0, 1, 1, 64 * 128), (0, 2, 2, -64 * 64)]


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    con.execute(f"SELECT query_id, rank, vec_id, score FROM ({catalogue.SQL['op13_topk']})")
    assert found_in(catalogue.op13_topk(spark, folder)) == sorted(con.fetchall(), key=repr)
