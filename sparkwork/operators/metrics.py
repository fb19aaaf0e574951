"""Classification metrics, each one aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, sized_broadcast



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def binary_metrics(df: DataFrame, score: str | Column, y: str | Column) -> DataFrame:
    """One row (tp, fp, tn, fn, acc, pre, rec) for labels y in {+1, -1}.

    Predicted positive when score > 0; score <= 0 (zero included) is negative.
    A zero denominator gives NULL.
    """
    pos = _c(score) > 0
    yy = _c(y)
    counts = df.agg(
        F.count_if(pos & (yy > 0)).alias("tp"),
        F.count_if(pos & (yy <= 0)).alias("fp"),
        F.count_if(~pos & (yy <= 0)).alias("tn"),
        F.count_if(~pos & (yy > 0)).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    z = F.lit(0.0)
    return counts.select(
        "tp",
        "fp",
        "tn",
        "fn",
        ((tp + tn) / F.nullif(tp + fp + tn + fn, z)).alias("acc"),
        (tp / F.nullif(tp + fp, z)).alias("pre"),
        (tp / F.nullif(tp + fn, z)).alias("rec"),
    )


def multiclass_accuracy(df: DataFrame, pred: str | Column, label: str | Column) -> DataFrame:
    """One row (n, accuracy): share of rows with pred = label."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((_c(pred) == _c(label)).cast("double")).alias("accuracy"),
    )


def cross_entropy(df: DataFrame, probs: str | Column, label: str | Column) -> DataFrame:
    """One row (n, cross_entropy): mean of -ln p[label] over rows."""
    p = F.element_at(_c(probs), _c(label).cast("int") + 1)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(-F.ln(p)).alias("cross_entropy"))


def row_index(df: DataFrame, order: list, by: list[str] | None = None) -> DataFrame:
    """Adds ``_rn`` (0-based) in the total order ``order`` (within each ``by`` group) without a single-task window.

    The frame is range-partitioned and sorted by (by, order), written to the checkpoint
    folder (so partition contents are fixed), then each row gets the count of its
    group's rows in earlier partitions (a prefix sum over one row per partition and
    group) plus its position inside the partition.  ``order`` must be a total order
    for a reproducible result.
    """
    groups = list(by or [])
    sort_cols = [F.asc(g) for g in groups] + list(order)
    sorted_df = cut_lineage(
        df.orderBy(*sort_cols).withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    )
    per_part = sorted_df.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    # one row per (partition, group): broadcast after counting it, else joined by shuffle
    keys = ["_pid", *groups]
    indexed = sorted_df.join(sized_broadcast(offsets.select(*keys, "_off", "_first"), row_bytes=64), keys)
    return indexed.withColumn("_rn", F.col("_off") + F.col("_mid") - F.col("_first")).drop("_pid", "_mid", "_off", "_first")


def batch_metric_means(df: DataFrame, metrics: list[str], order: list, batch: int, by: list[str] | None = None) -> DataFrame:
    """(by..., n_batches, metrics...): of each metric, the mean over full batches of ``batch`` rows of the per-batch mean.

    Rows are numbered in ``order`` (per ``by`` group, e.g. train and test split), once for
    all metrics; the incomplete last batch of each group is dropped, as a mini-batch loop with
    ``int(n / batch)`` steps does.
    """
    groups = list(by or [])
    idx = row_index(df, order, groups)
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")) if groups else None
    per_row = idx.withColumn("_b", F.floor(F.col("_rn") / F.lit(batch)))
    if groups:
        per_row = per_row.join(sizes, groups).where(F.col("_b") < F.floor(F.col("_n") / F.lit(batch)))
    else:
        n = df.select(F.count(F.lit(1))).scalar()
        per_row = per_row.where(F.col("_b") < F.floor(n / F.lit(batch)))
    per_batch = per_row.groupBy(*groups, "_b").agg(*[F.avg(m).alias(m) for m in metrics])
    return per_batch.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_batches"), *[F.avg(m).alias(m) for m in metrics])


def batch_metric_mean(df: DataFrame, metric: str, order: list, batch: int, by: list[str] | None = None) -> DataFrame:
    """``batch_metric_means`` of one metric, as ``batch_mean``."""
    return batch_metric_means(df, [metric], order, batch, by).withColumnRenamed(metric, "batch_mean")
