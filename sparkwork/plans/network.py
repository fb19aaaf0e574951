"""A perceptron with one hidden layer, trained by back-propagation in array expressions and aggregates.

The model is one row of nested arrays: hidden weights ``w1`` (h x d) and ``b1``, output weights ``w2`` (c x h) and
``b2``; tanh in the hidden layer, softmax at the output, mean cross-entropy as the loss.  A plan reads the model as one
scalar row.  A step is one pass over the rows of its batch: forward and backward passes are expressions on a row, which
give it h + c numbers of error besides its activations; the weight gradients are sums over rows, by position,
with partial sums before the shuffle.

Training goes in epochs over mini-batches: rows are numbered within their split in a given order, the batch of a
step is a range of row numbers, and the rows are written once, sorted by number, so that a step reads its range only.  A
rest that does not fill a batch is left out of the steps of that epoch.  Test rows are scored and never stepped on.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions.vectors import dot, softmax
from ..operators.metrics import row_index
from ..operators.vectors import vector_sum_by
from ..session import check_model_size, cut_lineage


@dataclass(frozen=True)
class NetworkParams:
    hidden: int = 16
    classes: int = 10
    lr: float = 0.1
    epochs: int = 1
    batch: int | None = None  # rows of a step; None: all rows
    seed: int = 7


def initial_model(spark, d: int, p: NetworkParams) -> DataFrame:
    """One row (w1, b1, w2, b2): weights N(0, 1/inputs), a pure function of seed and place; zero biases."""

    def weights(layer: str, n_out: int, n_in: int) -> Column:
        def one(i: Column) -> Column:
            scale = F.lit(1.0 / math.sqrt(n_in))
            return F.transform(F.sequence(F.lit(0), F.lit(n_in - 1)), lambda j: H.normal(F.lit(str(p.seed)), F.lit(layer), i, j) * scale)

        return F.transform(F.sequence(F.lit(0), F.lit(n_out - 1)), one)

    row = spark.range(1).select(
        weights("w1", p.hidden, d).alias("w1"), F.array_repeat(F.lit(0.0), p.hidden).alias("b1"),
        weights("w2", p.classes, p.hidden).alias("w2"), F.array_repeat(F.lit(0.0), p.classes).alias("b2"),
    )
    return cut_lineage(row)


def _layer(weights: Column, bias: Column, x: Column) -> Column:
    return F.transform(weights, lambda w, i: dot(w, x) + F.get(bias, i))


def forward(df: DataFrame, x: str, model: DataFrame) -> DataFrame:
    """Adds ``_m`` (the model), ``_h`` (hidden activations), ``probs`` and ``pred`` (first arg-max)."""
    out = df.withColumn("_m", model.select(F.struct("w1", "b1", "w2", "b2")).scalar())
    # staged columns: a lambda must refer to a computed column, not compute it for each element
    out = out.withColumn("_h", F.transform(_layer(F.col("_m.w1"), F.col("_m.b1"), F.col(x)), F.tanh))
    out = out.withColumn("_z", _layer(F.col("_m.w2"), F.col("_m.b2"), F.col("_h")))
    out = out.withColumn("probs", softmax(F.col("_z"))).drop("_z")
    return out.withColumn("pred", (F.array_position("probs", F.array_max("probs")) - 1).cast("int"))


def gradient(df: DataFrame, x: str, label: str, model: DataFrame, d: int, p: NetworkParams) -> DataFrame:
    """(unit, g, n): for each unit (hidden ones first, then classes) the sums over rows of its weights' and bias's gradient."""
    out = forward(df.select(x, label), x, model)
    out = out.withColumn("_e2", F.transform("probs", lambda q, c: q - F.when(F.col(label) == c, F.lit(1.0)).otherwise(F.lit(0.0))))
    back = F.transform(
        F.sequence(F.lit(0), F.lit(p.hidden - 1)),
        lambda i: F.aggregate(F.zip_with("_e2", F.col("_m.w2"), lambda e, w: e * F.get(w, i)), F.lit(0.0), lambda s, v: s + v)
        * (F.lit(1.0) - F.get("_h", i) * F.get("_h", i)),
    )
    out = out.withColumn("_e1", back)
    # one row per unit: its error times (inputs, 1); inputs of both layers in arrays of one length
    size = max(d, p.hidden) + 1

    def padded(v: str, n: int) -> Column:
        return F.concat(F.col(v), F.array_repeat(F.lit(0.0), size - 1 - n), F.array(F.lit(1.0)))

    units = F.concat(
        F.transform("_e1", lambda e, i: F.struct(i.alias("unit"), e.alias("e"))),
        F.transform("_e2", lambda e, i: F.struct((i + p.hidden).alias("unit"), e.alias("e"))),
    )
    out = out.select(padded(x, d).alias("_x"), padded("_h", p.hidden).alias("_y"), F.inline(units))
    scaled = out.select("unit", F.transform(F.when(F.col("unit") < p.hidden, F.col("_x")).otherwise(F.col("_y")), lambda v: v * F.col("e")).alias("g"))
    return vector_sum_by(scaled, "unit", "g", size, out="g")


def stepped(model: DataFrame, grad: DataFrame, n: int, d: int, p: NetworkParams) -> DataFrame:
    """The model after a step against the mean gradient of ``n`` rows."""
    table = grad.agg(F.transform(F.array_sort(F.collect_list(F.struct("unit", "g"))), lambda e: e["g"])).scalar()  # a row per unit
    model = model.withColumn("_g", table)
    rate = F.lit(p.lr / n)

    def moved(weights: str, first: int, n_in: int) -> Column:
        return F.transform(
            weights, lambda w, i: F.zip_with(w, F.slice(F.get("_g", i + first), 1, n_in), lambda a, b: a - rate * b)
        )

    def moved_bias(bias: str, first: int) -> Column:
        return F.transform(bias, lambda b, i: b - rate * F.element_at(F.get("_g", i + first), -1))

    return model.select(
        moved("w1", 0, d).alias("w1"), moved_bias("b1", 0).alias("b1"),
        moved("w2", p.hidden, p.hidden).alias("w2"), moved_bias("b2", p.hidden).alias("b2"),
    )


def evaluate(df: DataFrame, x: str, label: str, model: DataFrame) -> DataFrame:
    """One row (n, loss, accuracy): mean cross-entropy and share of right predictions."""
    out = forward(df, x, model)
    true = F.element_at("probs", F.col(label).cast("int") + 1)
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.avg(-F.ln(true)).alias("loss"), F.avg((F.col("pred") == F.col(label)).cast("double")).alias("accuracy")
    )


def batch_means(df: DataFrame, x: str, label: str, model: DataFrame, batch: int, n: int) -> DataFrame:
    """One row (loss, accuracy): means over the full batches of numbered rows of the batches' means."""
    out = forward(df.where(F.col("_rn") < n // batch * batch), x, model)
    true = F.element_at("probs", F.col(label).cast("int") + 1)
    per = out.groupBy(F.floor(F.col("_rn") / batch)).agg(
        F.avg(-F.ln(true)).alias("loss"), F.avg((F.col("pred") == F.col(label)).cast("double")).alias("accuracy")
    )
    return per.agg(F.avg("loss").alias("loss"), F.avg("accuracy").alias("accuracy"))


def train_network(
    df: DataFrame, order: list[str], x: str = "x", label: str = "label", params: NetworkParams | None = None, test: DataFrame | None = None
):
    """Back-propagation in epochs over mini-batches; returns (model, history).

    Batches are ranges of rows in ``order`` (which must settle ties, for a run to be repeatable).  ``history`` rows are
    (epoch, loss, accuracy, test_loss, test_accuracy), after each epoch: means over full batches of the training and of
    the test rows (NULL without test rows, or fewer than a batch).  An empty table is an error.
    """
    p = params or NetworkParams()
    spark = df.sparkSession
    wanted = list(dict.fromkeys([*order, x, label]))

    def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
        rows = row_index(rows.select(*wanted), [F.asc(c) for c in order])
        rows = cut_lineage(rows.repartitionByRange("_rn").sortWithinPartitions("_rn"))
        return rows, rows.count()

    rows, n = numbered(df)
    if not n:
        raise ValueError("no rows to train on")
    held, n_held = numbered(test) if test is not None else (None, 0)
    d = rows.agg(F.max(F.size(x))).first()[0]
    check_model_size(p.hidden * (d + 1) + p.classes * (p.hidden + 1), "the network")
    batch = min(p.batch or n, n)
    model, history = initial_model(spark, d, p), []
    for epoch in range(p.epochs):
        for b in range(n // batch):
            part = rows.where((F.col("_rn") >= b * batch) & (F.col("_rn") < (b + 1) * batch))
            model = cut_lineage(stepped(model, gradient(part, x, label, model, d, p), batch, d, p))
        m = batch_means(rows, x, label, model, batch, n).first()
        t = batch_means(held, x, label, model, min(batch, max(n_held, 1)), n_held).first() if n_held else None
        history.append((epoch, m["loss"], m["accuracy"], t and t["loss"], t and t["accuracy"]))
    schema = "epoch int, loss double, accuracy double, test_loss double, test_accuracy double"
    return model, spark.createDataFrame(history, schema)


def model_rows(model: DataFrame) -> DataFrame:
    """(layer, unit, k, w): the weights, and the bias of a unit as its last one."""

    def layer(name: str, weights: str, bias: str) -> DataFrame:
        whole = F.transform(weights, lambda w, i: F.concat(w, F.array(F.get(bias, i))))
        rows = model.select(F.posexplode(whole).alias("unit", "ws"))
        return rows.select(F.lit(name).alias("layer"), "unit", F.posexplode("ws").alias("k", "w"))

    return layer("hidden", "w1", "b1").unionByName(layer("output", "w2", "b2"))
