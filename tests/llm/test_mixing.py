import duckdb
import pytest

from opinia.llm import catalogue, mixing
from opinia.llm.common import Scratch


def shares(sizes, weights, most=3):
    """Targets by sharing again and again."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        w = sum(x for i, x in enumerate(weights) if i not in capped)
        out = [most * s if i in capped else left * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if out[i] > most * s and i not in capped}
        if not over:
            return out
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 1, 2, 500], [5, 0, 7], [1, 1, 1, 1, 10**6]])
def test_targets(spark, sizes):
    names = [chr(97 + i) for i in range(len(sizes) - 1)] + [None]
    sources = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(sources, Scratch(spark, "t")).collect()}
    expected = shares(sizes, [k % 3 + 1 for k in range(len(sizes))])
    assert [found[n] for n in names] == pytest.approx(expected)


def test_takes_come_near_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 90)), "abcd"[i % 4 if i % 10 else 0]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    assert len(found) == 2000 and all(r["taken"] <= 3 * r["size"] for r in found)
    by_source = {}
    for r in found:
        taken, _ = by_source.get(r["source"], (0, 0))
        by_source[r["source"]] = (taken + r["taken"], r["target"])
    for taken, target in by_source.values():
        assert abs(taken - target) <= 90 and taken <= target
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found}


def test_odds_follow_weights(spark):
    rows = [(i, "w w w w", "b" if i % 3 else "a", 4.0 if i % 2 else 1.0) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, liked double")
    found = mixing.mix(docs, weight_col="liked", cycle=(1, 1)).where("source = 'a'").groupBy(mixing.F.col("doc_id") % 2).avg("copies").collect()
    rate = {r[0]: r[1] for r in found}
    assert rate[1] > rate[0] + 0.2


def test_awkward_rows(awkward, nothing):
    found = mixing.mix(awkward).collect()
    assert len(found) == awkward.count() and {r["size"] for r in found if r["doc_id"] in (4, 5, 6)} == {0}
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0
    out = mixing.mixed(awkward)
    assert out.columns == awkward.columns
    assert out.count() == sum(r["copies"] for r in found)


def test_no_python_runs(awkward):
    plan = mixing.mixed(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    own = {tuple(r) for r in catalogue.op9_mixing(spark, folder).collect()}
    assert own == set(con.execute(catalogue.SQL["op9_mixing"]).fetchall())


def test_no_document_that_fits_is_left(spark):
    found = catalogue.op9_mixing(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source"), "doc_id"
    )
    copies = mixing.F.col("taken") / mixing.F.col("size")
    passed = (mixing.F.col("size") > 0) & (copies == mixing.F.floor(mixing.F.col("target") / mixing.F.col("source_size")))
    left = (
        found.groupBy("source", "target", "source_size")
        .agg(mixing.F.sum("taken").alias("n"), mixing.F.min(mixing.F.when(passed, mixing.F.col("size"))).alias("least"))
        .where("target > source_size * floor(target / source_size) AND least <= target - n")
    )
    assert left.count() == 0
