"""Models trained side by side against models trained one by one."""

import pytest

from sparkwork.operators.folds import assign_folds
from sparkwork.plans import linear as LN
from sparkwork.plans import multi

from .test_skew import conf


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = [], []
    for i in range(90):
        labels.append((i, 1.0 if (i * 7) % 5 < 2 else -1.0))
        rows += [(i, f"f{(i * k) % 11}", ((i + k) % 4) / 3.0) for k in range(1, 4)]
    rows.append((3, "only3", 2.0))  # a feature of one example
    labels.append((1000, 1.0))  # an example without features
    return spark.createDataFrame(rows, "id long, feature string, value double"), spark.createDataFrame(labels, "id long, y double")


def _rounded(rows, n):
    return [tuple(round(x, n) if isinstance(x, float) else x for x in r) for r in rows]


@pytest.mark.parametrize("loss", ["logistic", "squared"])
def test_slots_equal_single_trainings(spark, data, loss):
    X, E = data
    E = assign_folds(E, "id", 3, 1)
    slots = [multi.Slot(0.0), multi.Slot(0.5, 1)]
    p = LN.LinearParams(loss=loss, max_iter=3, eps=1e-6)
    models, history, scores = multi.train_many(X, E, slots, p)
    margins = {r["id"]: r["s"] for r in scores.collect()}
    for k, s in enumerate(slots):
        Es = E if s.fold is None else E.where(f"fold <> {s.fold}")
        beta, h = LN.train_linear(X.join(Es.select("id"), "id"), Es.select("id", "y"), LN.LinearParams(loss=loss, max_iter=3, eps=1e-6, lam=s.lam))
        columns = ["iter", "loss", "grad_norm", "gamma"]
        assert _rounded(history.where(f"slot = {k}").select(*columns).collect(), 8) == _rounded(h.select(*columns).collect(), 8)
        assert sorted(_rounded(models.where(f"slot = {k}").select("feature", "beta").collect(), 8)) == sorted(_rounded(beta.collect(), 8))
        for r in LN.score(X, E.select("id", "y"), beta).collect():
            assert margins[r["id"]][k] == pytest.approx(r["score"], abs=1e-9)


def test_one_layout_and_two_passes_an_iteration_whatever_the_slots(data, monkeypatch):
    X, E = data
    calls = {"laid": 0, "gradients": 0, "products": 0}

    def counted(name, f):
        def run(*a, **k):
            calls[name] += 1
            return f(*a, **k)

        return run

    monkeypatch.setattr(multi, "_laid_out", counted("laid", multi._laid_out))
    monkeypatch.setattr(multi, "gradients", counted("gradients", multi.gradients))
    monkeypatch.setattr(multi, "with_products", counted("products", multi.with_products))
    _, history = multi.sweep_lambdas(X, E, [0.0, 0.1, 0.2, 0.5, 1.0], LN.LinearParams(max_iter=2, eps=0.0))
    assert calls == {"laid": 1, "gradients": 2, "products": 2} and history.count() == 10


def test_hot_example_and_large_model(spark, data):
    X, E = data
    E = assign_folds(E, "id", 2, 1)
    slots = [multi.Slot(0.1, 0), multi.Slot(0.1, 1), multi.Slot(0.3)]
    p = LN.LinearParams(max_iter=2)
    made = []
    for settings in ({}, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "96b"}):
        with conf(spark, settings):
            models, history, _ = multi.train_many(X, E, slots, p)
            made.append((sorted(_rounded(models.collect(), 9)), _rounded(history.select("slot", "iter", "loss", "gamma").collect(), 9)))
    assert made[0] == made[1]


def test_sweep_and_folds_together(data):
    X, E = data
    E3 = assign_folds(E, "id", 3, 42)
    p = LN.LinearParams(loss="squared", max_iter=2)
    summary, _, _ = multi.cross_validate_many(X, E3, 3, [0.0, 0.4], p)
    for lam in (0.4,):
        one = LN.cross_validate_linear(X, E, 3, LN.LinearParams(loss="squared", max_iter=2, lam=lam))
        both = summary.where(f"lam = {lam}").select("fold", "n_train", "n_test", "rmse")
        assert sorted(_rounded(both.collect(), 9)) == sorted(_rounded(one.select("fold", "n_train", "n_test", "rmse").collect(), 9))
