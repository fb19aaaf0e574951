"""k-fold assignment, train/test split and the training union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H


def assign_folds(df: DataFrame, key: str | Sequence[str], k: int, seed: int | str = 42, out: str = "fold") -> DataFrame:
    """Adds ``fold`` in [0, k) from the md5 of (seed, key...): reproducible and partition-independent."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(out, H.bucket(k, F.lit(str(seed)), *keys).cast("int"))


def split(df: DataFrame, fold: int, col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(train, test): all folds but ``fold``, and ``fold`` alone (filters, pushed to the scan)."""
    return df.where(F.col(col) != fold), df.where(F.col(col) == fold)


def train_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name (duplicates kept) of separately read folds."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_split_counts(df: DataFrame, k: int, col: str = "fold") -> DataFrame:
    """(fold, n_train, n_test) for leave-one-fold-out, from one aggregate pass.

    n_train(f) = total - n(f), so no per-fold re-scan is needed.
    """
    per = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_test"))
    total = df.select(F.count(F.lit(1))).scalar()
    return per.select(F.col(col).alias("fold"), (total - F.col("n_test")).alias("n_train"), "n_test")
