"""Many linear models trained side by side: one slot per regularisation weight and held-out fold.

Every model-sized and every example-sized state is an array with an entry per slot: margins, coefficients, gradient,
model.  The features are laid out once, and each iteration reads them twice (gradient, and <gradient, x>), whatever
the number of slots; one aggregate tries the step sizes of all slots that still search.  A slot with a fold learns
from the examples of all other folds: its coefficients of the held-out ones are 0.  Margins are kept for those
too, so the scores of the held-out examples need no further pass.  A slot that has converged stands still.

The squared loss of few features is a quadratic of few numbers: one pass sums the products of features (and label) by
fold, every iteration of every slot is exact arithmetic on these sums, and one more pass gives the margins.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, fits_broadcast
from .linear import (
    MIN_STEP,
    LinearParams,
    _clean,
    _hot_keys,
    _laid_out,
    _repeated,
    check_rows_per_example,
    dloss_expr,
    loss_expr,
    prepare_by_feature,
)

SEARCH_SUMS = 120  # sums of one line-search aggregate; the search goes on until every slot has a step
SUMMED_FEATURES = 32  # up to so many features an example brings a row per pair of them to the product sums


@dataclass(frozen=True)
class Slot:
    lam: float = 0.0
    fold: int | None = None  # held out


def _array(items: list) -> Column:
    return F.array(*items).cast("array<double>")


def _sums(column: str, n: int, times: str | None = None) -> Column:
    """The sum of an array column by position; ``times`` is a number column that its entries are multiplied with.

    The products are made inside the sums, in generated code: no array per row, no lambda.
    """
    entries = [F.get(column, F.lit(k)) for k in range(n)]
    return F.array(*[F.sum(e if times is None else e * F.col(times)) for e in entries])


def _keeps(slot: Slot) -> Column:
    """Whether an example is learned from; an example without a fold is held out nowhere."""
    return F.lit(True) if slot.fold is None else F.coalesce(F.col("fold") != slot.fold, F.lit(True))


def _masked(slots: Sequence[Slot], value) -> list[Column]:
    return [F.when(_keeps(s), value(k)).otherwise(F.lit(0.0)) for k, s in enumerate(slots)]


def gradients(X: DataFrame, EM: DataFrame, beta: DataFrame, slots: Sequence[Slot], loss: str) -> DataFrame:
    """(feature, grad): the gradient of each slot's loss, regulariser included, from one pass over X."""
    c = _array(_masked(slots, lambda k: dloss_expr(loss, F.get("s", F.lit(k)), F.col("y"))))
    coef = EM.select("id", *[n for n in EM.columns if n == "salts"], c.alias("c"))
    coef, on = _repeated(coef, "id", X)
    data = X.join(coef, on).select("feature", "c", "value")
    lams = F.array(*[F.lit(2.0 * s.lam) for s in slots])
    reg = beta.select("feature", F.zip_with(lams, F.col("b"), lambda lam, b: lam * b).alias("c"), F.lit(1.0).alias("value"))
    return data.unionByName(reg).groupBy("feature").agg(_sums("c", len(slots), "value").alias("grad"))


def with_products(X: DataFrame, EM: DataFrame, grad: DataFrame, n_grad: int, slots: int, by_feature, row_bytes: int) -> DataFrame:
    """``EM`` with ``gs``: each slot's <gradient, x>, from one pass over X."""
    if fits_broadcast(grad.sparkSession, n_grad, row_bytes):
        met = X.join(F.broadcast(grad), "feature")
    else:
        laid, hot = by_feature
        side = grad if hot is None else grad.join(hot, "feature", "left")
        side, on = _repeated(side, "feature", laid)
        met = laid.join(side.hint("merge"), on)
    p = met.groupBy("id").agg(_sums("grad", slots, "value").alias("gs"))
    return EM.join(p, "id", "left").withColumn("gs", F.coalesce("gs", F.array_repeat(F.lit(0.0), slots)))


def search_steps(EMG: DataFrame, slots: Sequence[Slot], p: LinearParams, todo: list[int], L, g2, bg, b2) -> dict[int, tuple[float, float]]:
    """slot -> (gamma, loss): the largest step size b^t that the Armijo test accepts, for the slots ``todo``."""
    found: dict[int, tuple[float, float]] = {}
    start, left = 0, list(todo)
    while left:
        if p.b**start <= MIN_STEP:
            raise ArithmeticError(f"no step size above {MIN_STEP} decreases the losses of slots {left}")
        tries = range(start, start + max(1, SEARCH_SUMS // len(left)))
        sums = []
        for k in left:
            s, gs = F.get("s", F.lit(k)), F.get("gs", F.lit(k))
            sums += [F.sum(F.when(_keeps(slots[k]), loss_expr(p.loss, s - F.lit(p.b**t) * gs, F.col("y")))).alias(f"_{k}_{t}") for t in tries]
        row = EMG.agg(*sums).first()
        for k in list(left):
            for t in tries:
                gamma = p.b**t
                loss = (row[f"_{k}_{t}"] or 0.0) + slots[k].lam * (b2[k] - 2 * gamma * bg[k] + gamma * gamma * g2[k])
                if loss <= L[k] - p.a * gamma * g2[k]:
                    found[k] = gamma, loss
                    left.remove(k)
                    break
        start = tries.stop
    return found


def product_sums(X: DataFrame, E: DataFrame, names: Sequence[str]) -> dict[int | None, np.ndarray]:
    """fold -> the matrix of sums of z_a z_b over the fold's examples, z the values of features ``names`` and then the label.

    An example without features has zeros.  A row per pair of entries goes into one hash aggregate with partial sums, so a
    task returns no more rows than there are pairs and folds.
    """
    d, zero = len(names), F.lit(0.0)
    wide = X.groupBy("id").agg(F.array(*[F.coalesce(F.sum(F.when(F.col("feature") == n, F.col("value"))), zero) for n in names]).alias("x"))
    fold = F.col("fold") if "fold" in E.columns else F.lit(None).cast("int")
    none = F.array_repeat(zero, d)
    z = F.concat(F.coalesce("x", none), F.array("y")) if d else F.array("y")
    rows = E.join(wide, "id", "left").select(fold.alias("fold"), z.alias("z"))
    rows = rows.select("fold", "z", F.posexplode("z").alias("a", "za"))
    rows = rows.select("fold", "a", "za", F.posexplode(F.slice("z", F.col("a") + 1, d + 1)).alias("more", "zb"))
    sums = rows.groupBy("fold", "a", "more").agg(F.sum(F.col("za") * F.col("zb")).alias("s"))
    out: dict[int | None, np.ndarray] = {}
    for r in sums.collect():  # a row per fold and pair
        m = out.setdefault(r["fold"], np.zeros((d + 1, d + 1)))
        m[r["a"], r["a"] + r["more"]] = m[r["a"] + r["more"], r["a"]] = r["s"]
    return out


def descend(M: np.ndarray, lam: float, p: LinearParams) -> tuple[np.ndarray, list[tuple]]:
    """(beta, history rows from iter on) of ``train_linear``'s steps for squared loss, from a matrix of ``product_sums``.

    Along the gradient g the objective is L - t |g|^2 + t^2 q with q = g'Gg + lam |g|^2, so the test of the step sizes
    compares no two large sums.
    """
    G, c, yy = M[:-1, :-1], M[:-1, -1], float(M[-1, -1])
    beta, history, it, norm = np.zeros(len(c)), [], 0, 2 * p.eps
    while it < p.max_iter and norm > p.eps:
        t_start = time.perf_counter()
        loss = max(0.0, yy - 2.0 * float(beta @ c) + float(beta @ G @ beta)) + lam * float(beta @ beta)
        g = 2.0 * (G @ beta - c) + 2.0 * lam * beta
        g2 = float(g @ g)
        norm, q, gamma = math.sqrt(g2), float(g @ G @ g) + lam * g2, 1.0
        while not gamma * q <= (1.0 - p.a) * g2:
            gamma *= p.b
            if gamma <= MIN_STEP:
                raise ArithmeticError(f"no step size above {MIN_STEP} decreases the loss {loss} (gradient norm {norm})")
        beta = beta - gamma * g
        history.append((it, loss, norm, gamma, True, time.perf_counter() - t_start, None, None, None, norm <= p.eps))
        it += 1
    return beta, history


HISTORY = (
    "slot int, lam double, fold int, iter int, loss double, grad_norm double, gamma double, line_search_ok boolean, "
    "seconds double, acc double, pre double, rec double, converged boolean"
)


def _train_by_passes(Xp: DataFrame, EM: DataFrame, slots: Sequence[Slot], p: LinearParams, row_bytes: int, by_feature):
    """(beta, EM with the last margins, history rows), each iteration two passes over the features."""
    spark, K = Xp.sparkSession, len(slots)
    beta = cut_lineage(spark.createDataFrame([], "feature string, b array<double>"))
    first = EM.agg(*[F.sum(v).alias(f"_{k}") for k, v in enumerate(_masked(slots, lambda k: loss_expr(p.loss, F.get("s", F.lit(k)), F.col("y"))))]).first()
    L = [first[f"_{k}"] or 0.0 for k in range(K)]
    history, running, it = [], list(range(K)), 0
    while running and it < p.max_iter:
        t_start = time.perf_counter()
        grad = cut_lineage(gradients(Xp, EM, beta, slots, p.loss))
        # grad holds every feature of beta (its regulariser's rows)
        g, b = (lambda k: F.get("grad", F.lit(k))), (lambda k: F.coalesce(F.get("b", F.lit(k)), F.lit(0.0)))
        sums = [F.sum(x).alias(f"{name}{k}") for k in range(K) for name, x in (("g", g(k) * g(k)), ("m", g(k) * b(k)), ("b", b(k) * b(k)))]
        row = grad.join(beta, "feature", "left").agg(F.count(F.lit(1)).alias("n"), *sums).first()
        g2, bg, b2 = ([row[f"{name}{k}"] or 0.0 for k in range(K)] for name in "gmb")
        EMG = cut_lineage(with_products(Xp, EM, grad, row["n"], K, by_feature, row_bytes))
        steps = search_steps(EMG, slots, p, running, L, g2, bg, b2)
        gammas = F.array(*[F.lit(float(steps[k][0]) if k in steps else 0.0) for k in range(K)])
        moved = grad.select("feature", F.zip_with("grad", gammas, lambda x, y: -y * x).alias("b"))
        beta = cut_lineage(beta.unionByName(moved).groupBy("feature").agg(_sums("b", K).alias("b")))
        less = F.zip_with("gs", gammas, lambda x, y: y * x)
        EM = EMG.withColumn("s", F.zip_with("s", less, lambda x, y: x - y)).drop("gs")  # one projection of a checkpoint
        seconds = time.perf_counter() - t_start
        for k in running:
            norm = math.sqrt(g2[k])
            history.append((k, slots[k].lam, slots[k].fold, it, L[k], norm, steps[k][0], True, seconds, None, None, None, norm <= p.eps))
            L[k] = steps[k][1]
        running = [k for k in running if math.sqrt(g2[k]) > p.eps]
        it += 1
    return beta, EM, history


def _train_summed(Xp: DataFrame, EM: DataFrame, slots: Sequence[Slot], p: LinearParams, row_bytes: int, by_feature):
    """The same for the squared loss of few features, from their product sums; the margins by a pass with the last models."""
    spark, K = Xp.sparkSession, len(slots)
    names = sorted(r["feature"] for r in Xp.join(EM.select("id"), "id", "left_semi").select("feature").distinct().collect())
    sums = product_sums(Xp, EM, names)
    betas, history = [], []
    for k, s in enumerate(slots):
        own = [m for f, m in sums.items() if s.fold is None or f != s.fold]  # an example without a fold is held out nowhere
        beta, rows = descend(sum(own, np.zeros((len(names) + 1, len(names) + 1))), s.lam, p)
        betas.append(beta)
        history += [(k, s.lam, s.fold, *r) for r in rows]
    history.sort(key=lambda r: (r[3], r[0]))
    models = [(n, [float(b[i]) for b in betas]) for i, n in enumerate(names)]
    beta = cut_lineage(spark.createDataFrame(models, "feature string, b array<double>"))
    scored = with_products(Xp, EM, beta.withColumnRenamed("b", "grad"), len(names), K, by_feature, row_bytes)
    EM = cut_lineage(scored.withColumn("s", F.col("gs")).drop("gs"))
    return beta, EM, history


def train_many(X: DataFrame, E: DataFrame, slots: Sequence[Slot], params: LinearParams | None = None):
    """Gradient descent of all slots from beta = 0: (models, history, scores).

    ``E`` has id, y and, if a slot has one, fold.  ``models`` is (slot, feature, beta), of the features that the slot's
    own examples have; ``history`` as ``train_linear`` gives it, with the slot, its lam and its fold (acc, pre and rec are
    NULL); ``scores`` is (id, y, fold, s), the margins of every example, held out or not, by slot.
    """
    p = params or LinearParams()
    spark, K = X.sparkSession, len(slots)
    n = p.partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = ["fold"] if "fold" in E.columns else []
    xs, es = _clean(X, E, keep)
    hot = _hot_keys(xs, "id", p.max_rows_per_example)
    Xp = _laid_out(xs, "id", "feature", n, hot)
    check_rows_per_example(Xp, p.max_rows_per_example)
    if hot is not None:
        es = es.join(hot, "id", "left")
    EM = cut_lineage(es.withColumn("s", F.array_repeat(F.lit(0.0), K)))
    seen = Xp.agg(F.count_distinct("feature").alias("n"), F.max(F.octet_length("feature")).alias("longest")).first()
    row_bytes = 64 + 8 * K + (seen["longest"] or 0)
    by_feature = None if fits_broadcast(spark, seen["n"], row_bytes) else prepare_by_feature(Xp, p.partitions)
    if p.loss == "squared" and seen["n"] <= SUMMED_FEATURES:
        beta, EM, history = _train_summed(Xp, EM, slots, p, row_bytes, by_feature)
    else:
        beta, EM, history = _train_by_passes(Xp, EM, slots, p, row_bytes, by_feature)
    rows = beta.select("feature", F.posexplode("b").alias("slot", "beta"))
    if keep:  # a feature that only held-out examples have is none of the slot's
        folds = Xp.select("id", "feature").join(EM.select("id", "fold"), "id").groupBy("feature")
        folds = folds.agg(F.collect_set(F.coalesce("fold", F.lit(-1))).alias("folds"))  # as many as there are folds
        own = F.array(*[F.lit(s.fold).cast("int") for s in slots])
        rows = rows.join(folds, "feature").withColumn("_f", F.get(own, F.col("slot")))
        rows = rows.where(F.col("_f").isNull() | F.exists("folds", lambda f: f != F.col("_f")))
    models = cut_lineage(rows.select("slot", "feature", "beta"))
    for held in (Xp, *([by_feature[0]] if by_feature else [])):
        held.unpersist()
    return models, spark.createDataFrame(history, HISTORY), EM.select("id", "y", *keep, "s")


def sweep_lambdas(X: DataFrame, E: DataFrame, lams: Sequence[float], params: LinearParams | None = None):
    """(models with lam, history with lam) of one model per regularisation weight, trained side by side."""
    slots = [Slot(float(lam)) for lam in lams]
    models, history, _ = train_many(X, E, slots, params)
    lam = F.get(F.array(*[F.lit(s.lam) for s in slots]), F.col("slot")).alias("lam")
    return models.select(lam, "feature", "beta"), history.drop("slot", "fold")


def cross_validate_many(X: DataFrame, E: DataFrame, k: int, lams: Sequence[float], params: LinearParams | None = None):
    """k folds by as many regularisation weights in one training: (summary, models, history).

    ``E`` has a column fold.  ``summary`` is (lam, fold, n_train, n_test, acc, pre, rec, rmse): classification metrics of the
    held-out examples' sign for logistic loss, else their RMSE; NULL where nothing is held out.
    """
    p = params or LinearParams()
    spark = X.sparkSession
    slots = [Slot(float(lam), f) for lam in lams for f in range(k)]
    models, history, scores = train_many(X, E, slots, p)
    one = F.col("_s") > 0
    yes = F.col("y") > 0
    held = scores.where(F.col("fold").isNotNull()).select("y", "fold", F.posexplode("s").alias("slot", "_s"))
    held = held.where(F.get(F.array(*[F.lit(s.fold) for s in slots]), F.col("slot")) == F.col("fold"))
    per = held.groupBy("slot").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(one & yes).alias("tp"), F.count_if(one & ~yes).alias("fp"),
        F.count_if(~one & ~yes).alias("tn"), F.count_if(~one & yes).alias("fn"),
        F.sqrt(F.avg((F.col("_s") - F.col("y")) ** 2)).alias("rmse"),
    )
    found = {r["slot"]: r for r in per.collect()}  # a row per slot
    total = scores.count()
    rows = []
    for i, s in enumerate(slots):
        r = found.get(i)
        n = r["n"] if r else 0
        ratio = lambda a, b: a / b if b else None
        if r is None:
            metrics = (None,) * 4
        elif p.loss == "logistic":
            metrics = (ratio(r["tp"] + r["tn"], n), ratio(r["tp"], r["tp"] + r["fp"]), ratio(r["tp"], r["tp"] + r["fn"]), None)
        else:
            metrics = (None, None, None, r["rmse"])
        rows.append((s.lam, s.fold, total - n, n, *metrics))
    schema = "lam double, fold int, n_train bigint, n_test bigint, acc double, pre double, rec double, rmse double"
    at = lambda name, kind: F.get(F.array(*[F.lit(getattr(s, name)) for s in slots]), F.col("slot")).cast(kind).alias(name)
    models = models.select(at("lam", "double"), at("fold", "int"), "feature", "beta")
    return spark.createDataFrame(rows, schema), models, history.drop("slot")
