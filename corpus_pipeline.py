"""The corpus pipeline: from raw documents to packed training sequences."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import SPACES, stage, table
from glimmer.llm.line_dedup import dedup_lines
from glimmer.llm.ngram_join import near_duplicates
from glimmer.llm.packing import pack_documents
from glimmer.llm.quality_classifier import keep_predicted
from glimmer.llm.quality_rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from the labels of those it gets, predicts as good."""
    return keep_predicted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated line runs; a document of which nothing is left goes."""
    cut = dedup_lines(docs)
    left = (F.col("n_removed") == 0) | (F.btrim("text", F.lit(SPACES)) != "")
    return cut.filter(left).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies (five words, similarity of at least 0.8).

    Rows that repeat an id are one document: of those that stay one row does, the first by a hash of its text. Documents
    without an id stay."""
    stay = near_duplicates(docs, width=5, percent=80).filter("doc_id = component_id").groupBy("doc_id").count()
    stay = stage(stay)
    rows = docs.join(stay.filter("count = 1").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    repeated = stay.filter("count > 1").select("doc_id")
    if not repeated.isEmpty():
        again = docs.join(repeated, "doc_id", "left_semi").withColumn("_row", F.struct(F.xxhash64("text").alias("h"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]))
        first = again.groupBy("doc_id").agg(F.min("_row").alias("_row"))
        rows = rows.unionByName(first.select(*[F.col(f"_row.c{k}").alias(c) for k, c in enumerate(docs.columns)]))
    return docs.filter("doc_id is null").unionByName(rows)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate_documents),
    ("best-fit packing", packing),
]

#: Estimation, prefix doubling and bin packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what one returns is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        docs = stage(docs) if k < len(STAGES) - 1 else docs
    return docs
