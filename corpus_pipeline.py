"""From raw documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again before the next one.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.bpe import encode, word_bpe_path
from martflow.llm.common import keep, read
from martflow.llm.jaccard_join import one_of_each_group
from martflow.llm.mixing import mix, repeat_documents
from martflow.llm.quality_crf import keep_good
from martflow.llm.secret_scan import mask


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; ``n_chars`` follows the text."""
    return mask(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their targets; a document stands as often as it is taken."""
    return repeat_documents(docs, mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, their digest and that of the decoded tokens."""
    return encode(docs, word_bpe_path(), "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", quality),
    ("jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: SQL cannot express the classifier or the tokenizer; the tests compare the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
