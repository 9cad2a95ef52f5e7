"""From raw documents to packed training sequences, in stages of written tables.

Every stage takes what its predecessor kept and returns the columns of
documents, the last one the places of documents in sequences.  The stages learn
from tables and search exactly, which SQL cannot express; ``ORACLE_SQL`` is
None and the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.llm.decontaminate import drop_contaminated
from verdance.llm.jaccard_join import jaccard_classes
from verdance.llm.packing import pack, sized
from verdance.llm.quality_model import keep_good, train
from verdance.llm.secrets import labelled_samples, redact
from verdance.llm.secrets import train as train_markov
from verdance.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, train(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near duplicates (five words, 80 %).

    Of rows that share a ``doc_id`` the one with the smallest text stays; rows
    without a ``doc_id`` stay.
    """
    classes = jaccard_classes(docs, shingle=5, percent=80)[0]
    first = classes.where("doc_id = component_id").select("doc_id").distinct()
    # The row is one column, so that no column of the documents can clash.
    row = F.struct(*docs.columns).alias("row")
    order = W.partitionBy("doc_id").orderBy(F.col("row.text").asc_nulls_last())
    ranked = docs.select("doc_id", row).join(first, "doc_id", "left_semi").withColumn("place", F.row_number().over(order))
    kept = ranked.where("place = 1").select("row.*")
    return kept.unionByName(docs.where("doc_id is null"))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    return redact(docs, train_markov(labelled_samples(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences."""
    return pack(sized(docs))


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", clean_of_benchmark),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
