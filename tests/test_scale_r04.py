"""Whole trainings, and steps whose cost grew faster than their input."""

import os
import tempfile
import tracemalloc
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from sparkwork.operators import text as T
from sparkwork.operators.folds import assign_folds
from sparkwork.plans import blocks
from sparkwork.plans import factorise as MF
from sparkwork.plans import linear as LN
from sparkwork.plans import multi
from sparkwork.registry import linear as linear_queries
from sparkwork.sources import files as FI


def _regression(spark):
    rows = [(i, f"x{k}", ((i * (k + 3)) % 17) / 17.0) for i in range(60) for k in range(3)]
    rows += [(7, "x1", 0.5), (60, "x0", 1.0)]  # a feature that comes twice, an example without a fold
    labels = [(i, float((i * 5) % 11)) for i in range(62)]  # 61 has no features
    E = assign_folds(spark.createDataFrame([*labels, (9, 3.0)], "id long, y double"), "id", 3, 1)  # 9 comes twice
    E = E.selectExpr("id", "y", "case when id <> 60 then fold end as fold")
    return spark.createDataFrame(rows, "id long, feature string, value double"), E


def test_product_sums_train_as_passes_do(spark, monkeypatch):
    X, E = _regression(spark)
    slots = [multi.Slot(0.3), multi.Slot(0.1, 0), multi.Slot(0.0, 2)]
    p = LN.LinearParams(loss="squared", max_iter=5)
    made = []
    for most in (multi.SUMMED_FEATURES, 0):
        monkeypatch.setattr(multi, "SUMMED_FEATURES", most)
        models, history, scores = multi.train_many(X, E, slots, p)
        columns = ["slot", "lam", "fold", "iter", "loss", "grad_norm", "gamma", "line_search_ok", "converged"]
        made.append((
            [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in history.select(*columns).collect()],
            sorted((r["slot"], r["feature"], round(r["beta"], 9)) for r in models.collect()),
            sorted((r["id"], r["y"], [round(v, 9) for v in r["s"]]) for r in scores.select("id", "y", "s").collect()),
        ))
    assert made[0] == made[1]


def test_descent_ends_at_the_solution():
    rng = np.random.default_rng(3)
    Z = rng.normal(size=(200, 4))
    beta, history = multi.descend(Z.T @ Z, 0.1, LN.LinearParams(loss="squared"))
    A, y = Z[:, :3], Z[:, 3]
    assert history[-1][-1] and len(history) < 100
    assert np.allclose(beta, np.linalg.solve(A.T @ A + 0.1 * np.eye(3), A.T @ y), atol=1e-3)
    with pytest.raises(ArithmeticError):
        multi.descend(np.full((2, 2), np.nan), 0.1, LN.LinearParams(loss="squared"))


def test_queries_train_to_the_end(spark, monkeypatch):
    """Two steps of a hundred leave models that are hardly trained."""
    class Seen(Exception):
        pass

    def seen(X, E, *rest, **more):
        raise Seen(next(x for x in rest if isinstance(x, LN.LinearParams)))

    whole = LN.LinearParams()
    for query, name in ((linear_queries.q_linear_cv, "cross_validate_linear"), (linear_queries.q_logistic_history_test, "train_linear")):
        with monkeypatch.context() as m:
            m.setattr(LN, name, seen)
            with pytest.raises(Seen) as got:
                query(spark, "/root/testdata/sf0.001")
        p = got.value.args[0]
        assert replace(p, loss=whole.loss, lam=whole.lam, max_rows_per_example=None) == whole


def test_documents_are_written_by_the_tasks_and_read_by_few(spark):
    """A process per file (Hadoop's local file system) and a task per handful of files take longer than the texts."""
    folder = tempfile.mkdtemp(prefix="docs-") + "/do cs"
    texts = [(f"k{i}" if i else None, f"w{i % 3} a\rbä") for i in range(400)] + [("k1", "again"), ("", ""), ("null", None)]
    docs = spark.createDataFrame(texts, "doc string, text string")
    FI.write_docs(docs, folder, "doc")
    assert len(os.listdir(folder)) == 402 and all(n.endswith(".txt") for n in os.listdir(folder))
    lines = FI.read_doc_lines(spark, folder)
    files = FI.list_docs(spark, folder, lines)
    assert files.count() == 402 and files.exceptAll(FI.list_docs(spark, folder)).isEmpty()
    assert lines.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    got = {r["term"]: r["df"] for r in T.idf_of_lines(lines, files).collect()}
    assert got == {"a": 400, "bä": 400, "w": 400, "again": 1}
    with pytest.raises(FileExistsError):
        FI.write_docs(docs, folder, "doc")


def test_no_document(spark):
    folder = tempfile.mkdtemp(prefix="docs-") + "/docs"
    FI.write_docs(spark.createDataFrame([], "doc_id long, text string"), folder)
    lines = FI.read_doc_lines(spark, folder)
    assert lines.count() == FI.list_docs(spark, folder, lines).count() == 0


def test_ratings_are_a_table_that_goes_with_the_training(spark, monkeypatch):
    """A checkpoint of the ratings is several times as large, and what the steps shuffled would stay on disk."""
    rows = [(i, (i * 7 + t) % 20, float((i + t) % 5)) for i in range(40) for t in range(4)]
    R = spark.createDataFrame(rows, "i long, j long, r double")
    read, released, plain = [], [], blocks.lay_out
    monkeypatch.setattr(blocks, "lay_out", lambda R, *a: read.extend(R.inputFiles()) or plain(R, *a))
    monkeypatch.setattr(MF, "release_unused", lambda s: released.append(1))
    p = MF.MFParams(d=2, maxiter=2, blockwise=True)
    U, V, _ = MF.train_mf(R, None, p)
    MF.cross_validate_mf(R, 2, p).collect()
    assert read and all(f.endswith(".parquet") for f in read) and len(released) == 6
    assert not [f for f in read if os.path.exists(f.removeprefix("file:").replace("///", "/"))]
    assert U.count() == 40 and V.count() == 20  # they need no ratings


def test_a_block_makes_no_copies_of_its_vectors():
    n, d = 300_000, 10
    at = np.arange(n)
    ratings = pa.table({"i": at % 1000, "j": at % 999, "r": np.ones(n)})
    keys = np.concatenate([np.arange(1000), np.arange(999)])
    sides = pa.array(["u"] * 1000 + ["v"] * 999)
    p = pa.FixedSizeListArray.from_arrays(pa.array(np.ones(1999 * d)), d).cast(pa.list_(pa.float64()))
    profiles = pa.table({"side": pa.chunked_array([sides]), "key": keys, "p": p})
    tracemalloc.start()
    found = blocks._scored(ratings, profiles, d)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(found[-1], d - 1.0) and len(found[-1]) == n
    assert peak < 20e6  # the vectors of all ratings are 48 MB
