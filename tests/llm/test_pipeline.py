"""The pipeline's stages, and the SQL equivalents of the text queries."""

import duckdb

import corpus_pipeline
from gleaner.llm import queries


def test_sql_equivalents(spark):
    sf = "/root/testdata/sf0.01"
    for name, sql in queries.oracle_sql().items():
        found = queries.queries()[name](spark, sf)
        link = duckdb.connect()
        for table in ("documents", "benchmark"):
            link.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
        want = link.sql(sql)
        assert sorted(want.columns) == sorted(found.columns)
        assert sorted(map(tuple, found.select(*want.columns).collect())) == sorted(want.fetchall())


def test_stages_keep_columns_and_take_effect(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, size = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name in ("language_id", "simhash", "decontamination"):
            assert docs.columns == columns and 0.5 * size < docs.count() <= size
            size = docs.count()
    assert docs.count() == corpus_pipeline.run(spark, sf).count() > 0
