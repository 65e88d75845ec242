import corpus_pipeline
from checks.compare import connect, differences
from salescope.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_queries_equal_their_sql(spark):
    tables = connect(FOLDER)
    for name, sql in queries.oracle_sql().items():
        assert differences(queries.queries()[name](spark, FOLDER), tables, sql) == []


def test_pipeline_keeps_columns_and_encodes_what_is_left(spark):
    docs = queries.table(spark, FOLDER, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
    assert 0 < docs.count() < queries.table(spark, FOLDER, "documents").count()
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.where("n_tokens <> size(ids)").count() == 0 and result.count() > 0
