"""Documents to packed sequences: quality, near-copies, repeated passages, mix of sources, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of the documents
they get, extra ones included. Null ids, texts and sources, empty texts and empty tables have results of their own,
which the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff.llm import gray, mixing, packing, quality, suffix_dedup
from shelfdiff.llm.queries import tokenizer_path
from shelfdiff.session import scratch_path

#: Rows of whole texts, and bytes, that a task hands to Python at a time. Spark's 10,000 rows are some 60 MB of text,
#: held by the JVM's writer, by the reader and as Python's objects at once.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def _small_batches(spark: SparkSession) -> None:
    """Set for the session, as a stage's result is computed after the stage returns; a lower setting stays."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).removesuffix("B").removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality of at least one half; the lines are judged by a field fitted on all labels."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "quality")
    field = quality.train(docs, labels)
    return docs.filter(quality.score_of(F.col("text"), field) >= 0.5)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near-copies: five words, similarity 0.8."""
    _small_batches(spark)
    return gray.one_of_each_group(docs)


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 bytes and more that an earlier document has."""
    _small_batches(spark)
    return suffix_dedup.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, with the words it draws."""
    _small_batches(spark)
    return mixing.mixed_texts(docs, mixing.mix(docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of a document lies in the sequences."""
    _small_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", distinct_documents),
    ("suffix-array dedup", fresh_passages),
    ("mixing sources to target weights", mixed_sources),
    ("packing", packed_sequences),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again before the next stage."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
