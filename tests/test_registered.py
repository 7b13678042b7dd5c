"""Every registered query against its SQL twin, and the shape of the plans."""

import pytest

import __spark_entry__ as contract
import check
from opinia.plans import catalogue, oracle
from opinia.sources import reviews

FOLDER = "/root/testdata/sf0.001"
QUERIES, TWINS = catalogue.QUERIES, oracle.statements()


@pytest.fixture(scope="module")
def sql():
    return check.sql_connection(FOLDER)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_against_sql(spark, sql, name):
    found = QUERIES[name](spark, FOLDER)
    assert "Python" not in plan_of(found)
    assert check.differences(found.toPandas(), sql.execute(TWINS[name]).df()) is None


@pytest.mark.parametrize("name", ["hashing_tf", "score_lr", "score_dt", "score_svc", "score_rf"])
def test_rows_only(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    if name == "hashing_tf":
        assert {r["bucket"] for r in rows} <= set(range(20)) and all(r["tf"] > 0 for r in rows)
    elif name != "score_svc":
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) > 500 and max(r["rank"] for r in rows) == 5


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["term_counts"](spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "n_chars" not in plan and "source" not in plan


@pytest.mark.parametrize(
    "name", ["tokenize_ws", "tokenize_regex", "bigrams", "sentences", "token_table", "term_counts", "term_freq"]
)
def test_per_document_queries_add_no_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, FOLDER))


def test_strategies_share_one_pass(spark):
    plan = plan_of(QUERIES["strategy_stats"](spark, FOLDER))
    assert plan.count("FileScan") == 1


def test_binned_auc_encloses_the_exact_one(spark):
    bounds = QUERIES["auc_binned"](spark, FOLDER).first()
    assert bounds["auc_low"] <= QUERIES["auc"](spark, FOLDER).first()["auc"] <= bounds["auc_high"]


def test_coefficients_have_their_tokens(spark):
    found = {r["token"]: r["index"] for r in QUERIES["coef_terms"](spark, FOLDER).collect()}
    assert found == {r["token"]: r["index"] for r in QUERIES["train_vocabulary"](spark, FOLDER).collect()}


def test_documents_are_not_moved_again_for_their_edits(spark):
    """The annotated table is bucketed by document, so only the edits are shuffled."""
    # Small edits would be broadcast, and then nothing is shuffled at all.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["finish"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(doc_id") == 1


def test_arrays_are_computed_once(spark):
    for name in ("term_counts", "token_table", "sentences"):
        assert "DataFilters: []" in plan_of(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(TWINS))
def test_layout_does_not_matter(spark, sql, monkeypatch, name):
    read = reviews.read_table
    monkeypatch.setattr(reviews, "read_table", lambda *a: read(*a).repartition(7))
    found = QUERIES[name](spark, FOLDER).toPandas()
    assert check.differences(found, sql.execute(TWINS[name]).df()) is None
