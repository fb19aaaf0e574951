"""The input tables (one parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread_small_input

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of ``{base}/{name}.parquet``; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_spread(spark: SparkSession, base: str, name: str, columns: list[str]) -> DataFrame:
    """``columns`` of a table, spread over the cores if it has fewer splits than cores.

    For tables whose rows carry heavy per-row work (long texts, vectors).  The
    column pruning happens before the spread, so only ``columns`` are read.
    """
    return spread_small_input(read_table(spark, base, name).select(*columns))
