import math

import pytest
from pyspark.sql import functions as F

from sparkwork.functions import vectors as VF
from sparkwork.operators import vectors as V
from sparkwork.plans import factorise as MF
from sparkwork.plans import linear as LN


def test_vector_expressions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], 2)], "u array<double>, v array<double>, lab int")
    r = df.select(
        VF.dot("u", "v").alias("d"),
        VF.axpy(F.lit(2.0), "u", "v").alias("ax"),
        VF.softmax("u").alias("sm"),
        VF.argmax("v").alias("am"),
        VF.one_hot("lab", 4).alias("oh"),
    ).first()
    assert r.d == 11.0 and r.ax == [5.0, 8.0] and r.am == 1 and r.oh == [0.0, 0.0, 1.0, 0.0]
    assert abs(sum(r.sm) - 1.0) < 1e-12 and abs(r.sm[1] - math.e / (1 + math.e)) < 1e-12


def test_argmax_first_max(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "x array<double>")
    assert df.select(VF.argmax("x").alias("a")).first().a == 1


def test_residual_and_user_step(spark):
    R = spark.createDataFrame([(1, 1, 10.0)], "i long, j long, r double")
    U = spark.createDataFrame([(1, [1.0, 2.0])], "i long, p array<double>")
    V_ = spark.createDataFrame([(1, [3.0, 4.0])], "j long, p array<double>")
    J = MF.predict(R, U, V_, d=2)
    assert J.first().delta == 1.0
    S = MF.step(J, "i", "u", "v", 0.1, 1.0, d=2).first()
    assert [round(x, 12) for x in S.p] == [0.2, 0.8]


def test_vector_sum_by(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "k long, x array<double>")
    got = {r.k: r.total for r in V.vector_sum_by(df, "k", "x", 2).collect()}
    assert got == {1: [4.0, 6.0], 2: [5.0, 6.0]}


def test_sparse_axpy(spark):
    x = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "term string, val double")
    y = spark.createDataFrame([("b", 1.0), ("c", 5.0)], "term string, val double")
    got = {r.term: r.val for r in V.sparse_axpy(2.0, x, y).collect()}
    assert got == {"a": 2.0, "b": 5.0, "c": 5.0}


def _toy(spark):
    X = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 0.5), (2, "a", -1.0), (3, "b", 2.0), (4, "c", 1.0)], "id long, feature string, value double"
    )
    E = spark.createDataFrame([(1, 1.0), (2, -1.0), (3, 1.0), (4, -1.0), (5, 1.0)], "id long, y double")
    return X, E


def _loss_at(spark, X, E, beta_map, loss, lam):
    beta = spark.createDataFrame(list(beta_map.items()), "feature string, beta double")
    EM = LN.margins(X, E, beta, len(beta_map))
    return LN.total_loss(EM, loss, lam, beta).first().loss


def test_gradient_matches_finite_difference(spark):
    X, E = _toy(spark)
    for loss in ("logistic", "squared"):
        b0 = {"a": 0.3, "b": -0.2, "c": 0.1}
        beta = spark.createDataFrame(list(b0.items()), "feature string, beta double")
        EM = LN.margins(X, E, beta, 3)
        g = {r.feature: r.grad for r in LN.gradient(X, EM, beta, loss, 0.5).collect()}
        h = 1e-6
        for f in b0:
            up = dict(b0, **{f: b0[f] + h})
            dn = dict(b0, **{f: b0[f] - h})
            fd = (_loss_at(spark, X, E, up, loss, 0.5) - _loss_at(spark, X, E, dn, loss, 0.5)) / (2 * h)
            assert abs(fd - g[f]) < 1e-5, (loss, f, fd, g[f])


def test_example_without_features_counts(spark):
    X, E = _toy(spark)
    L = _loss_at(spark, X, E, {"a": 0.0}, "logistic", 0.0)
    assert abs(L - 5 * math.log(2)) < 1e-12


def test_logistic_training_decreases_loss(spark):
    X, E = _toy(spark)
    beta, hist = LN.train_linear(X, E, LN.LinearParams(lam=0.1, max_iter=4))
    losses = [r.loss for r in hist.orderBy("iter").collect()]
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))
    assert beta.count() == 3


def test_mf_objective_falls_with_small_gain(spark):
    rows = [(i, j, float((i * 7 + j * 3) % 5) / 2) for i in range(30) for j in range(20) if (i + j) % 3 == 0]
    R = spark.createDataFrame(rows, "i long, j long, r double")
    _, _, hist = MF.train_mf(R, None, MF.MFParams(d=3, gain=0.002, maxiter=4))
    objs = [r.objective for r in hist.orderBy("iter").collect()]
    assert all(b < a for a, b in zip(objs, objs[1:]))


def test_mf_init_independent_of_partitioning(spark):
    R = spark.createDataFrame([(i, i % 7, 1.0) for i in range(200)], "i long, j long, r double")
    a = {r.i: r.p for r in MF.init_profiles(R, "i", 4, 1, "u").collect()}
    b = {r.i: r.p for r in MF.init_profiles(R.repartition(9), "i", 4, 1, "u").collect()}
    assert a == b


def test_flatten_tensor(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0]],)], "t array<array<double>>")
    assert df.select(VF.flatten_tensor("t").alias("v")).first().v == [1.0, 2.0, 3.0]


def test_train_all_and_save_profiles(spark):
    import tempfile

    from sparkwork.sources import files as FI

    rows = [(i, j, float((i + j) % 4)) for i in range(20) for j in range(10) if (i * j) % 3 == 0]
    R = spark.createDataFrame(rows, "i long, j long, r double")
    U, V_, hist = MF.train_mf(R, None, MF.MFParams(d=3, maxiter=2, partitions=4))
    d = tempfile.mkdtemp(prefix="sw-test-")
    FI.write_table(U, f"{d}/U")
    FI.write_table(V_, f"{d}/V")
    assert spark.read.parquet(f"{d}/U").count() == U.count() == 20
    assert hist.count() == 2


def test_train_linear_with_test_metrics_and_cv(spark):
    X, E = _toy(spark)
    _, hist = LN.train_linear(X, E, LN.LinearParams(lam=0.1, max_iter=2), test=(X, E))
    rows = hist.orderBy("iter").collect()
    assert len(rows) == 2 and all(r.acc is not None and 0.0 <= r.acc <= 1.0 for r in rows)
    cv = LN.cross_validate_linear(X, E, 2, LN.LinearParams(lam=0.1, max_iter=1)).collect()
    assert sorted(r.n_train + r.n_test for r in cv) == [5, 5]


def test_rmse_with_unseen_user(spark):
    R = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 1, 3.0)], "i long, j long, r double")
    U = MF.init_profiles(R, "i", 2, 5, "u")
    V_ = MF.init_profiles(R, "j", 2, 5, "v")
    test = spark.createDataFrame([(1, 1, 1.0), (9, 1, 2.0)], "i long, j long, r double")  # user 9 unseen
    r = MF.rmse(test, U, V_, d=2).first()
    assert (r.n_test, r.n_scored) == (2, 1)
    assert r.rmse_all_rows < r.rmse  # the reference's form divides by all test rows


def test_vector_add_subtract_scale(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 5.0])], "a array<double>, b array<double>")
    r = df.select(
        VF.add("a", "b").alias("s"), VF.subtract("b", "a").alias("d"), VF.scale(F.lit(3.0), "a").alias("m")
    ).first()
    assert (r.s, r.d, r.m) == ([4.0, 7.0], [2.0, 3.0], [3.0, 6.0])


def test_map_to_sparse(spark):
    df = spark.createDataFrame([({"a": 1.0, "b": 2.0}, 1.0), ({}, -1.0)], "x map<string,double>, y double")
    X, E = LN.map_to_sparse(df)
    assert X.count() == 2 and E.count() == 2


def test_line_search_goes_on_until_a_step_is_accepted(spark):
    """The loss is a sum: with large values the accepted size lies far beyond one batch of candidates."""
    rows = [(i, float(i % 7) * 3e4, float(i % 5) * 3e4) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    X = df.select("id", F.lit("a").alias("feature"), F.col("x").alias("value"))
    _, hist = LN.train_linear(X, df.select("id", "y"), LN.LinearParams(loss="squared", max_iter=2, candidates=6, eps=1e-3))
    steps = hist.orderBy("iter").collect()
    assert steps[0].gamma < 2**-30 and all(r.line_search_ok for r in steps)
    assert steps[1].loss < steps[0].loss and not steps[0].converged


def test_a_fold_without_scored_ratings_has_no_rmse(spark):
    # no user of fold 1 has ratings elsewhere, and the other way round
    rows = [(i, j, 1.0, i % 2) for i in range(4) for j in range(2)]
    R = spark.createDataFrame([(i, j + 10 * f, r, f) for i, j, r, f in rows], "i long, j long, r double, fold int")
    got = MF.cross_validate_mf(R, 2, MF.MFParams(d=2, maxiter=1), fold_col="fold").collect()
    assert [r.test_rmse for r in got] == [None, None] and got[0].mean_rmse is None


def test_a_wrong_bound_on_an_examples_rows_is_an_error(spark):
    X = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "a", 1.0)], "id long, feature string, value double")
    E = spark.createDataFrame([(1, 1.0), (2, -1.0)], "id long, y double")
    with pytest.raises(ValueError, match="2 rows"):
        LN.train_linear(X, E, LN.LinearParams(max_iter=1, max_rows_per_example=1))
