"""Counts, averages, distinct keys, top-k and reproducible sampling.

All are hash aggregates (partial before the shuffle, final after) or filters; none
gathers a group into one row or one task.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import hashing as H
from ..session import cut_lineage, fits_broadcast


def _list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def count_rows(df: DataFrame, by: str | Sequence[str] | None = None) -> DataFrame:
    """(by..., n): number of rows."""
    return df.groupBy(*_list(by)).agg(F.count(F.lit(1)).alias("n"))


def average(df: DataFrame, col: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """(by..., n, total, mean, mean_sum_count): the mean twice, by ``avg`` and by sum/count.

    Both come from one pass; they are equal (a property test checks it).  Empty input
    gives NULL means instead of a division error.
    """
    x = F.col(col).cast("double")
    return df.groupBy(*_list(by)).agg(
        F.count(x).alias("n"),
        F.sum(x).alias("total"),
        F.avg(x).alias("mean"),
        (F.sum(x) / F.nullif(F.count(x), F.lit(0))).alias("mean_sum_count"),
    )


def distinct_keys(df: DataFrame, col: str | Sequence[str]) -> DataFrame:
    """Distinct values of ``col`` (an aggregate without measures)."""
    return df.select(*_list(col)).distinct()


def key_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: n and the exact number of distinct values of each key."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_distinct(k).alias(f"n_{k}") for k in keys])


def top_k(
    df: DataFrame,
    col: str,
    k: int,
    by: str | Sequence[str] | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """The k rows with the largest ``col`` (duplicates kept), optionally per group.

    Global: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject (each task keeps
    k rows).  Per group: ``row_number() <= k``, which Spark plans with a partial
    WindowGroupLimit before the shuffle (for k up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``), so a hot group ships at most
    k rows per map task.
    """
    order = [F.desc(col)] + [F.asc(t) for t in ties]
    groups = _list(by)
    if not groups:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hash_sample(df: DataFrame, key: str | Sequence[str], fraction: float, seed: int | str) -> DataFrame:
    """Bernoulli sample without replacement, reproducible: keep rows whose hash unit < fraction."""
    return df.where(H.unit(F.lit(str(seed)), *_list(key)) < F.lit(float(fraction)))


def balanced_sample(
    df: DataFrame,
    label: str,
    key: str,
    seed: int | str,
    level_bits: int = 15,
    total_bits: int = 60,
) -> DataFrame:
    """Class-balanced sample: from each class, the m rows first in hash order, m = smallest class size.

    Equals ``row_number() over (partition by label order by h, key) <= m`` but never
    sorts a class in one task: the m-th hash of each class is found by radix
    refinement, ``level_bits`` bits per pass, each pass a filtered histogram
    aggregate (classes x 2^level_bits rows).  The final hash value is resolved
    exactly; only rows sharing that one hash are ordered by key.  ``key`` must be
    unique; rows with a NULL label are not sampled.
    """
    spark = df.sparkSession
    rows = df.withColumn("_h", H.order_key(F.lit(str(seed)), key))
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).where(F.col(label).isNotNull()).cache()
    n_groups = counts.count()

    def small(state: DataFrame) -> DataFrame:  # one row per class
        return F.broadcast(state) if fits_broadcast(spark, n_groups, 64) else state

    # state per class: rows still to take (need) and the hash prefix (_p) resolved so far
    m = counts.select(F.min("n")).scalar()
    state = cut_lineage(counts.select(label, m.alias("need"), F.lit(0).cast("bigint").alias("_p")))
    mask = (1 << level_bits) - 1
    # label, hash and key are written once; each level reads what shares the prefix resolved before it
    left = cut_lineage(rows.select(label, F.col(key).alias("_key"), "_h"))
    for lvl in range(total_bits // level_bits):
        shift = total_bits - (lvl + 1) * level_bits
        bucket = F.shiftright("_h", shift).bitwiseAND(F.lit(mask))
        hist = left.groupBy(label, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
        cum = hist.withColumn("_cum", F.sum("_c").over(Window.partitionBy(label).orderBy("_b"))).join(small(state), label)
        hit = cum.where((F.col("_cum") >= F.col("need")) & (F.col("_cum") - F.col("_c") < F.col("need")))
        state = cut_lineage(
            hit.select(
                label,
                (F.col("need") - (F.col("_cum") - F.col("_c"))).alias("need"),
                (F.shiftleft("_p", level_bits) + F.col("_b")).alias("_p"),
            )
        )
        same = F.shiftright("_h", shift) == F.col("_p")
        left = cut_lineage(left.join(small(state.select(label, "_p")), label).where(same).drop("_p"))
    below = rows.join(small(state), label).where(F.col("_h") < F.col("_p"))
    tie_w = Window.partitionBy(label, "_h").orderBy("_key")  # rows of one 60-bit hash
    ties = left.withColumn("_r", F.row_number().over(tie_w)).join(small(state), label).where(F.col("_r") <= F.col("need"))
    ties = rows.join(ties.select(F.col(label).alias("_label"), "_key"), (F.col(label) == F.col("_label")) & (F.col(key) == F.col("_key")), "left_semi")
    cols = df.columns
    return below.select(*cols).unionByName(ties.select(*cols))


def two_phase_aggregate(df: DataFrame, zero, seq: Callable, comb: Callable, finish: Callable, schema: str, fan: int = 8) -> DataFrame:
    """An aggregate of the caller's own: ``seq`` folds rows into a state per partition, ``comb`` merges two states.

    ``zero()`` makes an empty state, ``seq(state, batch)`` takes an Arrow record batch of rows and returns a state, and
    ``finish(state)`` gives the result's rows, as tuples of ``schema``.  The states of the partitions are merged ``fan``
    at a time, level by level, so no task merges more than ``fan`` states and the depth grows with the logarithm of the
    number of partitions.  States are pickled; their size must be bounded by the caller, not by the rows.  Native
    aggregates are faster wherever one fits.  An empty table gives ``finish(zero())``.
    """

    def fold(batches):
        state = zero()
        for batch in batches:
            state = seq(state, batch)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], ["state"])

    def merge(table: pa.Table) -> pa.Table:
        states = [pickle.loads(s) for s in table["state"].to_pylist()]
        state = states[0]
        for other in states[1:]:
            state = comb(state, other)
        return pa.table([table["at"][:1].cast(pa.int64()), pa.array([pickle.dumps(state)], pa.binary())], ["at", "state"])

    def finished(batches):
        rows = [r for batch in batches for s in batch.column(0).to_pylist() for r in finish(pickle.loads(s))]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

    spark = df.sparkSession
    states = df.mapInArrow(fold, "state binary").withColumn("at", F.spark_partition_id().cast("long"))
    states = cut_lineage(states.select("at", "state"))
    left = states.agg(F.max("at").alias("n")).first()["n"]
    if left is None:  # not even a partition
        states = spark.createDataFrame([(0, pickle.dumps(zero()))], "at long, state binary")
    while left:
        left //= fan
        groups = states.select(F.floor(F.col("at") / fan).alias("at"), "state").groupBy("at")
        states = cut_lineage(groups.applyInArrow(merge, "at long, state binary"))
    out = StructType.fromDDL(schema)
    names, kinds = out.names, to_arrow_schema(out)
    return states.select("state").mapInArrow(finished, out)
