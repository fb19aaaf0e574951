import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkwork.operators import aggregates as A
from sparkwork.operators import folds as FO
from sparkwork.operators import metrics as M


def _nums(spark, xs):
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id long, x double")


def test_top_k_cases(spark):
    assert [r.x for r in A.top_k(_nums(spark, [5, 1, 5, 3]), "x", 3).collect()] == [5, 5, 3]
    assert [r.x for r in A.top_k(_nums(spark, [2, 1]), "x", 13).collect()] == [2, 1]
    assert A.top_k(_nums(spark, [2, 1]), "x", 0).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), max_size=40), st.integers(0, 12))
def test_top_k_is_sorted_prefix(spark, xs, k):
    got = [r.x for r in A.top_k(_nums(spark, xs), "x", k).collect()]
    assert got == sorted((float(x) for x in xs), reverse=True)[:k]


def test_average_case_and_empty(spark):
    r = A.average(_nums(spark, [1, 2, 4]), "x").first()
    assert abs(r.mean - 7 / 3) < 1e-12 and abs(r.mean_sum_count - 7 / 3) < 1e-12
    e = A.average(_nums(spark, []), "x").first()
    assert e.mean is None and e.mean_sum_count is None and e.n == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_average_forms_agree(spark, xs):
    r = A.average(_nums(spark, xs), "x").first()
    assert abs(r.mean - r.mean_sum_count) <= 1e-9 * max(1.0, abs(r.mean))


def test_count_and_distinct(spark):
    df = _nums(spark, [1, 1, 2])
    assert A.count_rows(df).first().n == 3
    assert sorted(r.x for r in A.distinct_keys(df, "x").collect()) == [1.0, 2.0]


def test_hash_sample_reproducible(spark):
    df = spark.range(2000)
    a = {r.id for r in A.hash_sample(df, "id", 0.3, 7).collect()}
    b = {r.id for r in A.hash_sample(df.repartition(5), "id", 0.3, 7).collect()}
    assert a == b and 450 < len(a) < 750


def test_balanced_sample_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, 1 if rnd.random() < 0.8 else 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, label int")
    got = sorted(r.k for r in A.balanced_sample(df, "label", "k", 11).collect())
    h = df.withColumn("h", F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("11"), F.col("k").cast("string"))), 1, 15), 16, 10).cast("bigint"))
    pdf = h.toPandas().sort_values(["label", "h", "k"])
    m = pdf.groupby("label").size().min()
    want = sorted(pdf.groupby("label").head(m)["k"].tolist())
    assert got == want


def test_folds_partition_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    f = FO.assign_folds(df, "k", 5, 42)
    counts = {r.fold: r.n_test for r in FO.fold_split_counts(f, 5).collect()}
    assert sum(counts.values()) == 1000 and set(counts) <= set(range(5))
    train, test = FO.split(f, 2)
    assert train.count() + test.count() == 1000
    assert train.join(test, "k").count() == 0


def test_binary_metrics_cases(spark):
    df = spark.createDataFrame([(2.0, 1.0), (-1.0, -1.0), (0.0, 1.0), (3.0, -1.0)], "s double, y double")
    r = M.binary_metrics(df, "s", "y").first()
    assert (r.tp, r.fp, r.tn, r.fn) == (1, 1, 1, 1)
    assert (r.acc, r.pre, r.rec) == (0.5, 0.5, 0.5)
    neg = spark.createDataFrame([(-1.0, 1.0), (-2.0, -1.0)], "s double, y double")
    assert M.binary_metrics(neg, "s", "y").first().pre is None


def test_row_index_and_batches(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id"), (F.col("id") % 3).cast("double").alias("m"))
    idx = M.row_index(df, [F.asc("id")])
    assert all(r.id == r._rn for r in idx.collect())
    r = M.batch_metric_mean(df, "m", [F.asc("id")], 64).first()
    import numpy as np

    ms = [np.mean([(i % 3) for i in range(b * 64, (b + 1) * 64)]) for b in range(1000 // 64)]
    assert r.n_batches == 1000 // 64 and abs(r.batch_mean - float(np.mean(ms))) < 1e-12


def test_balanced_sample_single_class_and_sample_edges(spark):
    df = spark.createDataFrame([(i, 1) for i in range(50)], "k long, label int")
    assert A.balanced_sample(df, "label", "k", 3).count() == 50
    nums = spark.range(100)
    assert A.hash_sample(nums, "id", 0.0, 1).count() == 0
    assert A.hash_sample(nums, "id", 1.0, 1).count() == 100
