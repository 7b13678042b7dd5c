import pytest
from pyspark.sql import types as T

from opinia.session import materialize, scratch_dir
from opinia.sources import reviews as sources


@pytest.fixture()
def folder(raw, tmp_path):
    raw.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    raw.where("doc_id <> 9").selectExpr("doc_id", "cast(label as int) as quality").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    return str(tmp_path)


def test_null_text_is_read_as_empty(spark, folder):
    rows = {r["doc_id"]: r for r in sources.load_reviews(spark, folder).collect()}
    assert rows[6]["text"] == "" and rows[6]["text_was_null"] and not rows[5]["text_was_null"]
    assert len(rows) == 9


def test_catalog_tables_and_extra_columns(spark, raw):
    raw.createOrReplaceTempView("some_reviews")
    df = sources.load_reviews(spark, "", "some_reviews", keep=["label"])
    assert df.columns == ["doc_id", "text", "text_was_null", "label"] and df.count() == 9


def test_labelled_docs_have_the_review_schema(spark, folder):
    df = sources.assert_schema(sources.labelled_docs(spark, folder), sources.REVIEW_SCHEMA)
    assert df.count() == 8


def test_schema_problems_are_named(raw):
    with pytest.raises(ValueError, match="missing column other"):
        sources.assert_schema(raw, T.StructType([T.StructField("other", T.LongType())]))
    with pytest.raises(ValueError, match="label is double, expected int"):
        sources.assert_schema(raw, T.StructType([T.StructField("label", T.IntegerType())]))


def test_profile_counts_nulls_and_empties(spark, folder):
    labels = sources.with_label(sources.read_table(spark, folder, "labels"), "quality")
    profile = sources.corpus_profile(sources.load_reviews(spark, folder), labels.select("doc_id", "label"))
    rows = {r["label"]: r for r in profile.collect()}
    assert (rows[1.0]["n_docs"], rows[1.0]["n_null_text"], rows[1.0]["n_empty_text"]) == (5, 1, 0)
    assert (rows[0.0]["n_docs"], rows[0.0]["n_null_text"], rows[0.0]["n_empty_text"]) == (3, 0, 1)
    assert rows[None]["n_docs"] == 1 and len(rows) == 3


def test_preview_is_ordered(spark, folder):
    shown = sources.preview(sources.load_reviews(spark, folder).repartition(5), 3).collect()
    assert [r["doc_id"] for r in shown] == [1, 2, 3]


def test_stored_tables_use_the_configured_folder(spark, raw):
    base = scratch_dir(spark)
    stored = materialize(raw, "probe")
    assert stored.schema == raw.schema and stored.count() == 9
    assert all(base.split(":", 1)[-1].strip("/") in f for f in stored.inputFiles())


class Elsewhere:
    """As much of a session as is asked for the folder, on a cluster without one."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "spark://driver:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Elsewhere)
