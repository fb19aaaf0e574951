"""Multiclass classifiers over vectors.

* ``train_softmax``: softmax (multinomial logistic) regression by full-batch gradient
  steps.  The model is a table (c, w) of one vector per class, never on the driver; a plan
  reads it as one scalar (bounded by the label count and the vector length).  Each step is
  one pass over the persisted data whose per-class gradients are hash-aggregated.
* ``train_forest`` / ``train_mlp``: Spark ML's random forest and multilayer
  perceptron in a pipeline with a fixed seed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot, softmax
from ..operators.vectors import vector_sum_by
from ..session import check_model_size, cut_lineage

# The class names of the ten-class image set the reference classifies.
IMAGE_LABEL_NAMES = ["airplane", "automobile", "bird", "cat", "deer", "dog", "frog", "horse", "ship", "truck"]


def label_names(spark, names: Sequence[str] = IMAGE_LABEL_NAMES) -> DataFrame:
    """(label, name) dimension table."""
    return spark.createDataFrame(list(enumerate(names)), "label int, name string")


def zero_model(spark, n_classes: int, d: int) -> DataFrame:
    """(c, w): one d-long zero vector per class."""
    return spark.range(n_classes).select(F.col("id").cast("int").alias("c"), F.array_repeat(F.lit(0.0), d).alias("w"))


def _matrix(W: DataFrame) -> Column:
    """The model as one array of vectors, in class order (a scalar subquery: classes x d numbers)."""
    return W.agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "w"))), lambda e: e["w"])).scalar()


def softmax_gradient(df: DataFrame, x: str, label: str, W: DataFrame, d: int) -> DataFrame:
    """(c, grad): mean over rows of (p_c - [label = c]) x, as d-long arrays, one row per class.

    Each row's residual vector is exploded to its classes and the per-class
    vector sums are one hash aggregate.
    """
    scored = predict_softmax(df.select(x, label), x, W)
    resid = F.transform("probs", lambda v, i: v - F.when(F.col(label) == i, F.lit(1.0)).otherwise(F.lit(0.0)))
    rows = scored.select(x, F.posexplode(resid).alias("c", "_r"))
    scaled = rows.select("c", F.transform(x, lambda v: v * F.col("_r")).alias("_g"))
    n = df.select(F.count(F.lit(1))).scalar()
    sums = vector_sum_by(scaled, "c", "_g", d, out="_s").withColumn("_n", n)
    return sums.select("c", F.transform("_s", lambda v: v / F.col("_n")).alias("grad"))


def train_softmax(
    df: DataFrame,
    x: str = "x",
    label: str = "label",
    n_classes: int = 10,
    d: int | None = None,
    lr: float = 0.1,
    steps: int = 1,
    test: DataFrame | None = None,
):
    """Gradient descent on the mean cross-entropy from W = 0.  Returns (W, history).

    ``W`` is a (c, w) table.  ``history`` rows: (step, cross_entropy, accuracy, test_cross_entropy,
    test_accuracy) measured before each update, the last two on ``test`` (NULL without one; test
    rows are only scored, they never move the model).
    """
    spark = df.sparkSession
    rows = df.select(x, label).persist(StorageLevel.MEMORY_AND_DISK)
    held = None if test is None else test.select(x, label).persist(StorageLevel.MEMORY_AND_DISK)
    if d is None:
        d = rows.select(F.max(F.size(x))).first()[0]
    check_model_size(n_classes * (d or 0), "the softmax model")
    W = zero_model(spark, n_classes, d)
    hist = []
    for s in range(steps):
        m = evaluate_softmax(rows, x, label, W).first()
        t = (None, None)
        if held is not None:
            e = evaluate_softmax(held, x, label, W).first()
            t = (e["cross_entropy"], e["accuracy"])
        hist.append((s, m["cross_entropy"], m["accuracy"], *t))
        grad = softmax_gradient(rows, x, label, W, d)
        moved = F.zip_with("w", F.coalesce("grad", F.array_repeat(F.lit(0.0), d)), lambda w, g: w - F.lit(lr) * g)
        W = cut_lineage(W.join(grad, "c", "left").select("c", moved.alias("w")))
    rows.unpersist()
    if held is not None:
        held.unpersist()
    schema = "step int, cross_entropy double, accuracy double, test_cross_entropy double, test_accuracy double"
    return W, spark.createDataFrame(hist, schema)


def predict_softmax(df: DataFrame, x: str, W: DataFrame) -> DataFrame:
    """Adds ``probs`` (softmax of the class scores) and ``pred`` (first arg-max)."""
    # staged columns: a lambda must reference the model and the scores, not re-evaluate them per element
    out = df.withColumn("_W", _matrix(W)).withColumn("_scores", F.transform("_W", lambda w: dot(F.col(x), w)))
    out = out.withColumn("probs", softmax(F.col("_scores"))).drop("_scores", "_W")
    return out.withColumn("pred", (F.array_position("probs", F.array_max("probs")) - 1).cast("int"))


def evaluate_softmax(df: DataFrame, x: str, label: str, W: DataFrame) -> DataFrame:
    """One row (n, cross_entropy, accuracy)."""
    scored = predict_softmax(df, x, W)
    p_true = F.element_at("probs", F.col(label).cast("int") + 1)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(-F.ln(p_true)).alias("cross_entropy"),
        F.avg((F.col("pred") == F.col(label)).cast("double")).alias("accuracy"),
    )


# ------------------------------------------------------------------ Spark ML models
def _vectors(df: DataFrame, x: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("features", array_to_vector(F.col(x)))


def train_forest(df: DataFrame, x: str = "x", label: str = "label", trees: int = 20, depth: int = 5, seed: int = 7):
    """Random forest classifier (Spark ML) on ``array<double>`` features."""
    from pyspark.ml.classification import RandomForestClassifier

    rf = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
    )
    return rf.fit(_vectors(df, x).withColumn(label, F.col(label).cast("double")))


def train_mlp(df: DataFrame, x: str = "x", label: str = "label", layers=(64, 32, 10), max_iter: int = 50, seed: int = 7):
    """Multilayer perceptron classifier (Spark ML) on ``array<double>`` features."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    mlp = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol=label, layers=list(layers), maxIter=max_iter, seed=seed, blockSize=128
    )
    return mlp.fit(_vectors(df, x).withColumn(label, F.col(label).cast("double")))


def score_model(model, df: DataFrame, x: str = "x", label: str = "label") -> DataFrame:
    """One row (n, accuracy) of a fitted Spark ML classifier."""
    pred = model.transform(_vectors(df, x))
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("prediction") == F.col(label).cast("double")).cast("double")).alias("accuracy"),
    )
