"""Inputs of the reference's formats, derived by Spark from the test tables.

Each derivation is a plain DataFrame plan over the parquet tables, so its work grows
with the data (see FIXTURES.md for the SQL each one stands for).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..operators.text import terms as text_terms
from ..session import cut_lineage
from .tables import read_spread, read_table

FOLD_SEED = "42"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text) of ``documents``, spread over the cores when it has few splits."""
    return read_spread(spark, sf, "documents", ["doc_id", "text"])


def terms(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, term) normalised tokens of ``documents``."""
    return text_terms(documents(spark, sf))


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """(i, j, r): customer x part, r = mean quantity / 10 over their line items."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .groupBy(F.col("o_custkey").alias("i"), F.col("l_partkey").alias("j"))
        .agg((F.avg("l_quantity") / 10).alias("r"))
        .dropna()  # a rating needs a user, an item and a value
    )


def ratings_folds(spark: SparkSession, sf: str, k: int = 5) -> DataFrame:
    """(i, j, r, fold): ratings with a hash fold in [0, k)."""
    return ratings(spark, sf).withColumn("fold", H.bucket(k, F.lit(FOLD_SEED), "i", "j").cast("int"))


def features_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """(id, feature, value, y): relative frequency of every term in the labelled documents.

    y = 2*quality - 1.  Only documents with at least one term have rows;
    ``examples`` gives every labelled document.  Documents without a label are dropped
    before their texts are tokenised.
    """
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    labelled = documents(spark, sf).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    # written once to the checkpoint folder: the counts feed the lengths and the features
    counts = cut_lineage(text_terms(labelled).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("c")))
    lengths = counts.groupBy("doc_id").agg(F.sum("c").alias("n"))
    return (
        counts.join(lengths.join(labels, "doc_id"), "doc_id")
        .select(
            F.col("doc_id").alias("id"),
            F.col("term").alias("feature"),
            (F.col("c").cast("double") / F.col("n")).alias("value"),
            (F.lit(2.0) * F.col("quality") - F.lit(1.0)).cast("double").alias("y"),
        )
    )


def examples(spark: SparkSession, sf: str) -> DataFrame:
    """(id, y): every labelled document, with or without features."""
    return read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), (F.lit(2.0) * F.col("quality") - F.lit(1.0)).cast("double").alias("y")
    )


def features_dense(spark: SparkSession, sf: str) -> DataFrame:
    """(id, y, x, label): embeddings as double vectors, y = +1 for labels 0-4, else -1."""
    return read_spread(spark, sf, "embeddings", ["vec_id", "embedding", "label"]).select(
        F.col("vec_id").alias("id"),
        F.when(F.col("label") < 5, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("y"),
        F.col("embedding").cast("array<double>").alias("x"),
        "label",
    )


def regression(spark: SparkSession, sf: str) -> DataFrame:
    """(y, x1, x2, x3) linear-regression rows from ``lineitem``."""
    return read_table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 10000).alias("y"),
        (F.col("l_quantity") / 50).alias("x1"),
        F.col("l_discount").alias("x2"),
        F.col("l_tax").alias("x3"),
    )


def numbers(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, value) numeric column of ``events``."""
    return read_table(spark, sf, "events").select("event_id", "value")
