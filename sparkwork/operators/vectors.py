"""Whole-table vector operators over ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import sized_broadcast


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def vector_minmax(df: DataFrame, vec: str) -> DataFrame:
    """One row (min_value, max_value) over all elements of all vectors."""
    return df.agg(F.min(F.array_min(vec)).alias("min_value"), F.max(F.array_max(vec)).alias("max_value"))


def element_mean(df: DataFrame, vec: str, scale: float = 1.0):
    """Scalar subquery column: the mean of all elements of ``vec`` after division by ``scale``.

    Per-row element sums are folded in the JVM (``aggregate``), then one global
    aggregate adds them; no row explosion.
    """
    s = F.lit(float(scale))
    row_sum = F.aggregate(F.col(vec), F.lit(0.0), lambda acc, x: acc + x / s)
    return df.select(F.sum(row_sum) / F.nullif(F.sum(F.size(vec)), F.lit(0))).scalar()


def center_by(df: DataFrame, vec: str, by: str | Sequence[str], scale: float = 255.0, out: str | None = None) -> DataFrame:
    """``center`` with a mean of its own for each group of ``by`` (a split: training rows, test rows).

    The means, a row per group, meet the rows in a join that is a broadcast if their counted size allows it.
    """
    s, keys = F.lit(float(scale)), _list(by)
    row_sum = F.aggregate(F.col(vec), F.lit(0.0), lambda acc, x: acc + x / s)
    means = df.groupBy(*keys).agg((F.sum(row_sum) / F.nullif(F.sum(F.size(vec)), F.lit(0))).alias("_mean"))
    means = means.select(*[F.col(k).alias(f"_by_{k}") for k in keys], "_mean")
    met = F.lit(True)
    for k in keys:
        met = met & F.col(k).eqNullSafe(F.col(f"_by_{k}"))
    joined = df.join(sized_broadcast(means, row_bytes=64), met)
    centred = joined.withColumn(out or vec, F.transform(F.col(vec), lambda x: x / s - F.col("_mean")))
    return centred.drop("_mean", *[f"_by_{k}" for k in keys])


def center(df: DataFrame, vec: str, scale: float = 255.0, out: str | None = None) -> DataFrame:
    """Divide every element by ``scale``, then subtract the global scalar mean of the scaled elements."""
    s = F.lit(float(scale))
    # the scalar subquery becomes a column first: subqueries may not sit inside lambdas
    with_mean = df.withColumn("_mean", element_mean(df, vec, scale))
    centred = with_mean.withColumn(out or vec, F.transform(F.col(vec), lambda x: x / s - F.col("_mean")))
    return centred.drop("_mean")


def vector_sum_by(df: DataFrame, key: str | Sequence[str], vec: str, d: int, out: str = "total") -> DataFrame:
    """(key..., total): element-wise sum of d-long vectors per key.

    The elements are exploded and summed by (key, position): partial sums per task before the
    shuffle, so a hot key ships d partial rows per task, and a plan that does not grow with d.
    Then one array per key is made of its d sums.
    """
    keys = _list(key)
    elements = df.select(*keys, F.posexplode(F.slice(vec, 1, d)).alias("_k", "_v"))
    sums = elements.groupBy(*keys, "_k").agg(F.sum("_v").alias("_s"))
    rows = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_k", "_s"))).alias("_e"))
    return rows.select(*keys, F.transform("_e", lambda e: e["_s"]).alias(out))


def explode_vector(df: DataFrame, keys: str | Sequence[str], vec: str, value: str = "value") -> DataFrame:
    """(keys..., k, value): one row per element (for comparisons and long-form joins).

    The generator's input is an expression (all elements from the first on), not the bare column: from a bare column
    the optimizer infers a filter on its size, pushes it below joins and aggregates to the scan, and so computes a
    derived vector once per input row there.
    """
    ks = _list(keys)
    return df.select(*ks, F.posexplode(F.slice(vec, 1, F.size(vec))).alias("k", value))


def label_lookup(df: DataFrame, names: DataFrame, label: str = "label") -> DataFrame:
    """Adds the class name of ``label`` from a (label, name) dimension.

    The dimension is broadcast only after its rows are counted under the threshold;
    a larger one is joined by shuffle.
    """
    return df.join(sized_broadcast(names, row_bytes=64), label, "left")


def sparse_axpy(alpha: float, x: DataFrame, y: DataFrame, key: str = "term", value: str = "val") -> DataFrame:
    """(key, value) = alpha * x + y for sparse vectors stored as (key, value) rows.

    A union and one hash aggregate by key (no full outer join); a key missing on one
    side contributes nothing there.
    """
    xs = x.select(F.col(key), (F.lit(float(alpha)) * F.col(value)).alias("_v"))
    ys = y.select(F.col(key), F.col(value).alias("_v"))
    return xs.unionByName(ys).groupBy(key).agg(F.sum("_v").alias(value))
