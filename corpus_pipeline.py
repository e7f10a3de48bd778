"""A corpus pipeline from the operators of ``quarry.llm``.

Toxic documents go, then exact copies, then near copies; what is left is mixed
to source weights and packed into sequences. Each stage's result is written as
Parquet into the shared folder and read back as the next one's documents, and
the one before it is deleted.

Defined results, as the stages': null texts count as empty. An empty or null text
is not toxic; one of them stays as the copy of all others, is near to nothing, is in
the mix once and packs as the end id alone. Rows without an identifier lose
to copies with one. Repeated rows are copies; of equal texts the largest identifier
stays, of near ones the smallest. Very long texts go through whole. Other columns
come through all stages but the last as they are, whatever their names. Empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.exact_dedup import drop_copies
from quarry.llm.mixing import mixed_documents
from quarry.llm.ngram_join import drop_near_duplicates
from quarry.llm.packing import pack_documents, with_checksum
from quarry.llm.queries import BYTE_BPE
from quarry.llm.toxicity import drop_toxic
from quarry.session import remove_dir, scratch_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"), threshold=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs, keep="max")


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_checksum(pack_documents(docs, BYTE_BPE, 2048))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing sources", mixing),
    ("packing", packing),
]

# The classifier, the shingle join, the rounding and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_dir(spark, before)
        before = path
    return docs
