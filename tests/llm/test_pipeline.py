import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.tables import SCHEMA, HAS_TABLES, SF_DIR, awkward, empty


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(3, 1), (5, 1), (8, 0), (13, 0)], "doc_id bigint, quality int").write.parquet(
        str(path / "labels.parquet"))
    return str(path)


def test_stages_over_awkward_rows(spark, small, tmp_path):
    docs, sizes = awkward(spark), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, small).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns == SCHEMA.names
    assert all(sizes) and sizes[1] < sizes[0] <= 16
    assert set(docs.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}


def test_stages_over_no_rows(spark, small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), small).count() == 0


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_run_equals_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    want = sorted(map(tuple, docs.select(*key).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(*key).collect())) == want


def test_texts_go_to_python_in_small_batches(spark):
    keys = [f"spark.sql.execution.arrow.max{what}PerBatch" for what in ("Records", "Bytes")]
    before = [spark.conf.get(k) for k in keys]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    def most(rows, text):
        docs = spark.range(rows).select(text.alias("text")).coalesce(1)
        found = docs.mapInArrow(sizes, "rows bigint, bytes bigint").agg(F.sum("rows"), F.max("rows"), F.max("bytes")).first()
        assert found[0] == rows
        return found[1:]
    try:
        corpus_pipeline.distinct_documents(spark, spark.createDataFrame([], "doc_id bigint, text string"), "")
        assert most(5000, F.lit("short"))[0] <= corpus_pipeline.BATCH_ROWS
        assert most(600, F.repeat(F.lit("x"), 100_000))[1] < 2 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(keys[0], "7")
        corpus_pipeline._small_batches(spark)
        assert spark.conf.get(keys[0]) == "7"
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)
