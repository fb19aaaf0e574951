"""Scratch tables and their scope; a caller's own aggregate."""

import os
import tempfile

from pyspark.sql import functions as F

from sparkwork.operators import aggregates as A
from sparkwork.plans import factorise as MF
from sparkwork.session import cut_lineage, scratch_path, scratch_scope


def _files(folder):
    return [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs]


def test_scope_leaves_an_empty_folder_after_training(spark):
    old, folder = spark.sparkContext.getCheckpointDir(), tempfile.mkdtemp(prefix="scope-")
    spark.sparkContext.setCheckpointDir(folder)
    try:
        R = spark.createDataFrame([(i, j, float(i + j)) for i in range(5) for j in range(4)], "i long, j long, r double")
        with scratch_scope(spark):
            _, _, h = MF.train_mf(R, None, MF.MFParams(d=2, maxiter=2))
            assert h.count() == 2 and _files(folder)
        assert _files(folder) == []
        with scratch_scope(spark) as outer:
            with scratch_scope(spark) as inner:
                path = scratch_path(spark, "kept")
                spark.range(3).write.parquet(path)
                gone = cut_lineage(spark.range(2))
                assert gone.count() == 2
                kept = inner.keep(spark.read.parquet(path))
            assert kept.count() == 3 and outer.paths == [path] and all("kept" in f for f in _files(folder))
        assert _files(folder) == []
    finally:
        spark.sparkContext.setCheckpointDir(old)


def test_two_phase_aggregate_merges_in_a_tree(spark):
    calls = spark.sparkContext.accumulator(0)

    def comb(a, b):
        calls.add(1)
        return (a[0] + b[0], max(a[1], b[1]), a[2] + 1)

    rows = spark.range(0, 10_000, 1, 40).select("id")
    out = A.two_phase_aggregate(
        rows, lambda: (0, -1, 0), lambda s, b: (s[0] + sum(b.column(0).to_pylist()), max([s[1], *b.column(0).to_pylist()]), 0),
        comb, lambda s: [(s[0], s[1], s[2])], "total long, top long, merges long", fan=4,
    ).collect()
    assert [(r["total"], r["top"]) for r in out] == [(sum(range(10_000)), 9_999)]
    assert calls.value == 39 and out[0]["merges"] <= 9  # 40 -> 10 -> 3 -> 1: three merges a level at most
    empty = A.two_phase_aggregate(rows.where(F.lit(False)), lambda: 0, lambda s, b: s + len(b), lambda a, b: a + b, lambda s: [(s,)], "n long")
    assert [r["n"] for r in empty.collect()] == [0]
