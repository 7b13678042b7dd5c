import corpus_pipeline
from opinia.llm import catalogue
from opinia.llm.common import Scratch


def test_stages_work_on_what_is_kept(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert name == "packing" or out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    ends = docs.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in ends) <= 2048


def test_awkward_and_empty_tables(spark, awkward, nothing):
    """Every stage ends on such rows, and keeps what it need not drop."""
    sf = "/root/testdata/sf0.001"
    for docs in (awkward, nothing):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = Scratch(spark, "test").store(stage(spark, docs, sf), name)
            assert name == "packing" or docs.columns == columns
        assert (docs.count() > 0) == (n > 0)


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in catalogue.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)
