"""Logistic and linear regression by gradient descent with an Armijo line search.

Data layout (sparse, exploded): ``X(id, feature, value)`` and ``E(id, y)``, one row per
non-zero and per example; dense vectors are exploded to the same form.  The model
``beta(feature, beta)`` is a table; absent features are 0.

Per iteration (margins s = <beta, x> are kept per example and updated linearly,
s' = s - gamma <g, x>, so the data is read twice per step, not once per candidate):

1. gradient: X is hash-partitioned by ``id`` and persisted, so only the margins (one
   row per example) are shuffled to meet it; coefficient dloss/ds times value and the
   2 lam beta rows go into one hash aggregate by feature (partial sums before the shuffle);
2. line search: X meets the gradient on the feature.  A gradient whose counted size
   allows it is broadcast; beyond that, a second persisted copy of X, hash-partitioned
   by feature, meets it, so the gradient moves and X does not.  Partial sums of
   <g, x> per example are shuffled, and the candidate step sizes are evaluated in one
   aggregate per batch of them, batch after batch until one is accepted;
3. the model update is a union and one hash aggregate; margins, gradient and model
   are checkpointed.

A key (example or feature) whose rows alone exceed a target partition is split by a salt;
its side of the join is repeated once per salt.  The layout of all other keys is the same.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import binary_metrics
from ..session import advisory_partition_bytes, cut_lineage, fits_broadcast

MIN_STEP = 1e-300  # a smaller step size is no step: the search ends with an error

LOSSES = ("logistic", "squared")


@dataclass(frozen=True)
class LinearParams:
    loss: str = "logistic"
    lam: float = 0.0
    max_iter: int = 100
    eps: float = 0.01
    a: float = 0.3  # Armijo sufficient-decrease factor
    b: float = 0.5  # backtracking factor: candidates gamma = b^t
    candidates: int = 20  # step sizes evaluated in one aggregate; the search goes on until one is accepted
    partitions: int | None = None  # hash partitions of X and E by id (default: shuffle partitions)
    max_rows_per_example: int | None = None  # known bound on an example's non-zeros (else measured)


# ------------------------------------------------------------------ losses
def loss_expr(loss: str, s: Column, y: Column) -> Column:
    """Per-example loss at margin s = <beta, x>."""
    if loss == "logistic":
        m = y * s
        return F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))  # log(1 + e^-m), stable
    if loss == "squared":
        return (s - y) * (s - y)
    raise ValueError(f"unknown loss {loss!r}")


def dloss_expr(loss: str, s: Column, y: Column) -> Column:
    """d loss / d s; the per-row gradient is this times x."""
    if loss == "logistic":
        return -y / (F.lit(1.0) + F.exp(y * s))
    if loss == "squared":
        return F.lit(2.0) * (s - y)
    raise ValueError(f"unknown loss {loss!r}")


# ------------------------------------------------------------------ data
ROW_BYTES = 48  # an exploded (id, feature, value) row, roughly


def _hot_keys(X: DataFrame, key: str, known_top: int | None = None) -> DataFrame | None:
    """(key, salts) of the keys whose rows alone exceed a target partition; None if there are none."""
    most = max(1, advisory_partition_bytes(X.sparkSession) // ROW_BYTES)
    if known_top is not None and known_top <= most:
        return None
    counts = X.groupBy(key).agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > most)
    hot = cut_lineage(counts.select(key, F.ceil(F.col("_k") / most).cast("int").alias("salts")))
    return None if hot.isEmpty() else hot


def _laid_out(X: DataFrame, key: str, other: str, n: int, hot: DataFrame | None) -> DataFrame:
    """X hash-partitioned by ``key`` and persisted; rows of a hot key are dealt by a salt from ``other``."""
    if hot is None:
        out = X.repartition(n, key)
    else:
        salt = F.coalesce(F.pmod(F.xxhash64(other), F.col("salts")), F.lit(0)).cast("int")
        out = X.join(hot, key, "left").withColumn("salt", salt).drop("salts").repartition(n, key, "salt")
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()  # a cached plan reports its hash partitioning to later plans only once materialised
    return out


def _repeated(side: DataFrame, key: str, X: DataFrame) -> tuple[DataFrame, list[str]]:
    """``side`` with one row per salt of its key, and the columns to join X on."""
    if "salt" not in X.columns:
        return side.drop("salts"), [key]
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)).alias("salt")
    return side.select("*", salts).drop("salts"), [key, "salt"]


def _clean(X: DataFrame, E: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    xs = X.select("id", F.col("feature").cast("string").alias("feature"), F.col("value").cast("double").alias("value"))
    es = E.select("id", F.col("y").cast("double").alias("y"), *keep)
    return xs.dropna(), es.dropna(subset=["id", "y"])  # a NULL id, feature, value or label carries no example


def prepare_sparse(
    X: DataFrame,
    E: DataFrame,
    partitions: int | None = None,
    max_rows_per_example: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Lay out X(id, feature, value) and E(id, y) by id for the iterations and persist both.

    The persisted partitioning (which a checkpoint would not keep) lets the joins on
    ``id`` run without shuffling X.  The rows of an example that alone exceed a target
    partition (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) are split by a salt
    (column ``salt`` of X; E then says in ``salts`` how many).  Such examples are looked for
    by one aggregate, unless ``max_rows_per_example`` (dense vectors: d) rules them out.
    Lost cached partitions are recomputed from the input's fixed-length lineage; the
    state that grows with the iterations (margins, gradient, model) is checkpointed.
    """
    n = partitions or int(X.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    xs, es = _clean(X, E)
    hot = _hot_keys(xs, "id", max_rows_per_example)
    Xp = _laid_out(xs, "id", "feature", n, hot)
    check_rows_per_example(Xp, max_rows_per_example)
    if hot is not None:
        es = es.join(hot, "id", "left")
    Ep = es.repartition(n, "id").persist(StorageLevel.MEMORY_AND_DISK)
    Ep.count()
    return Xp, Ep


def check_rows_per_example(Xp: DataFrame, known_top: int | None) -> None:
    """Raise if an example has more rows than the caller vouched for; the layout by id makes this a pass without a shuffle."""
    if known_top is None:
        return
    top = Xp.groupBy("id").agg(F.count(F.lit(1)).alias("_k")).agg(F.max("_k").alias("top")).first()["top"] or 0
    if top > known_top:
        raise ValueError(f"an example has {top} rows, more than max_rows_per_example = {known_top}")


def prepare_by_feature(X: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(X laid out by feature and persisted, its hot features): meets a model too large to broadcast."""
    n = partitions or int(X.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    xs = X.select("id", "feature", "value")
    hot = _hot_keys(xs, "feature")
    return _laid_out(xs, "feature", "id", n, hot), hot


def explode_dense(df: DataFrame, x: str = "x", y: str = "y", id_col: str | None = "id") -> tuple[DataFrame, DataFrame]:
    """Dense ``array<double>`` rows to (X, E); features are the 0-based positions as strings.

    Without an id column, ids come from ``monotonically_increasing_id`` on a checkpointed
    copy (fixed once written).
    """
    if id_col is None:
        df = cut_lineage(df.withColumn("id", F.monotonically_increasing_id()))
        id_col = "id"
    X = df.select(F.col(id_col).alias("id"), F.posexplode(x).alias("k", "value")).select(
        "id", F.col("k").cast("string").alias("feature"), "value"
    )
    E = df.select(F.col(id_col).alias("id"), F.col(y).alias("y"))
    return X, E


def columns_to_sparse(
    df: DataFrame, features: list[str], y: str = "y", order: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Wide numeric columns to (X, E) with the column names as features.

    Ids come from ``monotonically_increasing_id`` on a checkpointed copy, or, with
    ``order``, are the row's rank in that order (a distributed sort, see
    ``operators.metrics.row_index``): reproducible anywhere, and rows that tie on
    every ``order`` column are interchangeable when ``order`` covers all columns.
    """
    cols = df.select(y, *features)
    if order:
        from ..operators.metrics import row_index

        base = row_index(cols, [F.asc(c) for c in order]).withColumnRenamed("_rn", "id")
    else:
        base = cut_lineage(cols.withColumn("id", F.monotonically_increasing_id()))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    X = base.select("id", F.inline(pairs))
    return X, base.select("id", F.col(y).alias("y"))


def empty_beta(spark) -> DataFrame:
    return spark.createDataFrame([], "feature string, beta double")


def _example_columns(E: DataFrame) -> list[str]:
    return [c for c in ("id", "y", "s", "salts") if c in E.columns]


def products(
    X: DataFrame,
    w: DataFrame,
    n_w: int,
    by_feature: tuple[DataFrame, DataFrame | None] | None = None,
    row_bytes: int = 64,
) -> DataFrame:
    """(id, p): p = <w, x> for w(feature, w) of ``n_w`` rows; examples without a known feature are absent.

    ``w`` is broadcast if its size allows; else it is shuffled to meet ``by_feature``
    (see ``prepare_by_feature``), if there is one, or meets X by a shuffle join.
    """
    if fits_broadcast(w.sparkSession, n_w, row_bytes):
        met = X.join(F.broadcast(w), "feature")
    elif by_feature is not None:
        laid, hot = by_feature
        side = w if hot is None else w.join(hot, "feature", "left")
        side, on = _repeated(side, "feature", laid)
        met = laid.join(side.hint("merge"), on)
    else:
        met = X.join(w, "feature")
    return met.groupBy("id").agg(F.sum(F.col("value") * F.col("w")).alias("p"))


# ------------------------------------------------------------------ pieces
def margins(X: DataFrame, E: DataFrame, beta: DataFrame, n_beta: int, by_feature=None, row_bytes: int = 64) -> DataFrame:
    """(id, y, s): s = <beta, x>; examples without a known feature get s = 0."""
    p = products(X, beta.select("feature", F.col("beta").alias("w")), n_beta, by_feature, row_bytes)
    return E.join(p, "id", "left").select(*_example_columns(E), F.coalesce(F.col("p"), F.lit(0.0)).alias("s"))


def total_loss(EM: DataFrame, loss: str, lam: float, beta: DataFrame) -> DataFrame:
    """One row (n, loss): sum of per-example losses + lam ||beta||^2."""
    reg = beta.select(F.coalesce(F.sum(F.col("beta") * F.col("beta")), F.lit(0.0))).scalar()
    return EM.agg(
        F.count(F.lit(1)).alias("n"),
        (F.coalesce(F.sum(loss_expr(loss, F.col("s"), F.col("y"))), F.lit(0.0)) + F.lit(float(lam)) * reg).alias("loss"),
    )


def gradient(X: DataFrame, EM: DataFrame, beta: DataFrame, loss: str, lam: float) -> DataFrame:
    """(feature, grad): sum over examples of dloss/ds * x, plus 2 lam beta.

    The regulariser rows are unioned into the same hash aggregate by feature (partial
    sums before the one shuffle) rather than full-outer-joined afterwards.
    """
    coef = EM.select(*_example_columns(EM), dloss_expr(loss, F.col("s"), F.col("y")).alias("c")).drop("y", "s")
    coef, on = _repeated(coef, "id", X)
    data = X.join(coef, on).select("feature", (F.col("c") * F.col("value")).alias("g"))
    reg = beta.select("feature", (F.lit(2.0 * lam) * F.col("beta")).alias("g"))
    return data.unionByName(reg).groupBy("feature").agg(F.sum("g").alias("grad"))


def direction_margins(
    X: DataFrame, EM: DataFrame, grad: DataFrame, n_grad: int, by_feature=None, row_bytes: int = 64
) -> DataFrame:
    """(id, y, s, gs): adds gs = <grad, x> per example."""
    p = products(X, grad.select("feature", F.col("grad").alias("w")), n_grad, by_feature, row_bytes)
    return EM.join(p, "id", "left").select(*_example_columns(EM), F.coalesce(F.col("p"), F.lit(0.0)).alias("gs"))


def search_sums(EMG: DataFrame, loss: str, b: float, tries: range) -> DataFrame:
    """One row of columns _l<t>: the examples' loss at gamma = b^t.  The same plan in every iteration, so it is compiled once."""
    s, gs, y = F.col("s"), F.col("gs"), F.col("y")
    return EMG.agg(*[F.sum(loss_expr(loss, s - F.lit(b**t) * gs, y)).alias(f"_l{t}") for t in tries])


def line_search_table(
    EMG: DataFrame,
    loss: str,
    lam: float,
    current_loss: float,
    gnorm2: float,
    beta_dot_g: float,
    beta_norm2: float,
    a: float = 0.3,
    b: float = 0.5,
    candidates: int = 20,
    start: int = 0,
) -> DataFrame:
    """(t, gamma, loss, ok) for gamma = b^t, ``candidates`` values of t from ``start`` on, from ONE aggregate.

    loss(gamma) = sum loss(s - gamma gs, y) + lam ||beta - gamma g||^2;
    ok when loss(gamma) <= current - a gamma ||g||^2 (Armijo).
    """
    row = search_sums(EMG, loss, b, range(start, start + candidates))
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("t"),
                F.lit(b**t).alias("gamma"),
                (
                    F.coalesce(F.col(f"_l{t}"), F.lit(0.0))
                    + F.lit(lam * (beta_norm2 - 2 * b**t * beta_dot_g + b ** (2 * t) * gnorm2))
                ).alias("loss"),
            )
            for t in range(start, start + candidates)
        ]
    )
    out = row.select(F.inline(rows))
    return out.withColumn("ok", F.col("loss") <= F.lit(current_loss) - F.lit(a) * F.col("gamma") * F.lit(gnorm2))


def search_step(EMG: DataFrame, p: LinearParams, loss: float, gnorm2: float, beta_dot_g: float, beta_norm2: float):
    """(gamma, loss) of the largest step size b^t that the Armijo test of ``line_search_table`` accepts.

    Batches of ``p.candidates`` sizes are evaluated until one is accepted; the needed size shrinks with the number of
    rows, so there is no last candidate.  A step too small to be one raises ``ArithmeticError``.
    """
    start = 0
    while p.b**start > MIN_STEP:
        tries = range(start, start + p.candidates)
        row = search_sums(EMG, p.loss, p.b, tries).first()
        for t in tries:
            gamma, of_data = p.b**t, row[f"_l{t}"]
            found = (0.0 if of_data is None else of_data) + p.lam * (beta_norm2 - 2 * gamma * beta_dot_g + gamma**2 * gnorm2)
            if found <= loss - p.a * gamma * gnorm2:
                return gamma, found
        start = tries.stop
    raise ArithmeticError(f"no step size above {MIN_STEP} decreases the loss {loss} (gradient norm {math.sqrt(gnorm2)})")


def update_beta(beta: DataFrame, grad: DataFrame, gamma: float) -> DataFrame:
    """beta - gamma * grad over the union of their features (a union and one hash aggregate)."""
    step = grad.select("feature", (F.lit(-gamma) * F.col("grad")).alias("beta"))
    return beta.select("feature", "beta").unionByName(step).groupBy("feature").agg(F.sum("beta").alias("beta"))


def score(X: DataFrame, E: DataFrame, beta: DataFrame, n_beta: int | None = None) -> DataFrame:
    """(id, y, score): score = <beta, x>."""
    n = beta.count() if n_beta is None else n_beta
    return margins(X, E, beta, n).withColumnRenamed("s", "score")


def evaluate(X: DataFrame, E: DataFrame, beta: DataFrame) -> DataFrame:
    """Binary metrics of sign(<beta, x>) against y (score <= 0 counts as negative)."""
    return binary_metrics(score(X, E, beta), "score", "y")


# ------------------------------------------------------------------ training
def train_linear(
    X: DataFrame,
    E: DataFrame,
    params: LinearParams | None = None,
    beta0: DataFrame | None = None,
    test: tuple[DataFrame, DataFrame] | None = None,
):
    """Gradient descent from beta0 (default 0).  Returns (beta, history).

    history: (iter, loss, grad_norm, gamma, line_search_ok, seconds, acc, pre, rec, converged);
    ``loss`` and ``grad_norm`` belong to the model before the step of that
    iteration.  With ``test=(X_test, E_test)`` the updated model of each iteration is
    scored on the test examples (accuracy, precision, recall in one aggregate);
    otherwise those columns are NULL.  The loop stops after ``max_iter`` steps or
    once ||grad|| <= eps (that step is still taken; ``converged`` is true in its row).
    No rejected step is taken, see ``search_step``.
    """
    p = params or LinearParams()
    spark = X.sparkSession
    Xp, Ep = prepare_sparse(X, E, p.partitions, p.max_rows_per_example)
    beta = cut_lineage(beta0.select("feature", "beta")) if beta0 is not None else empty_beta(spark)
    n_beta = beta.count()
    seen = Xp.agg(F.count_distinct("feature").alias("n"), F.max(F.octet_length("feature")).alias("longest")).first()
    row_bytes = 64 + (seen["longest"] or 0)  # no name is longer, so the size check holds for any names
    fits = fits_broadcast(spark, max(seen["n"], n_beta), row_bytes)
    by_feature = None if fits else prepare_by_feature(Xp, p.partitions)
    EM = cut_lineage(margins(Xp, Ep, beta, n_beta, by_feature, row_bytes))
    L = total_loss(EM, p.loss, p.lam, beta).first()["loss"]
    history = []
    k, gnorm = 0, 2 * p.eps
    while k < p.max_iter and gnorm > p.eps:
        t_start = time.perf_counter()
        grad = cut_lineage(gradient(Xp, EM, beta, p.loss, p.lam))
        # grad holds every feature of beta (its 2 lam beta term), so one left join gives all three sums
        g = grad.join(beta, "feature", "left").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("grad") * F.col("grad")).alias("g2"),
            F.sum(F.col("grad") * F.coalesce(F.col("beta"), F.lit(0.0))).alias("bg"),
            F.sum(F.coalesce(F.col("beta"), F.lit(0.0)) ** 2).alias("b2"),
        ).first()
        n_grad, g2, bg, b2 = g["n"], g["g2"] or 0.0, g["bg"] or 0.0, g["b2"] or 0.0
        gnorm = math.sqrt(g2)
        EMG = cut_lineage(direction_margins(Xp, EM, grad, n_grad, by_feature, row_bytes))
        gamma, found = search_step(EMG, p, L, g2, bg, b2)
        beta = cut_lineage(update_beta(beta, grad, gamma))
        metrics = (None, None, None)
        if test is not None:
            m = binary_metrics(score(test[0], test[1], beta, n_grad), "score", "y").first()
            metrics = (m["acc"], m["pre"], m["rec"])
        history.append((k, L, gnorm, gamma, True, time.perf_counter() - t_start, *metrics, gnorm <= p.eps))
        n_beta = n_grad  # grad covers every feature of beta (its 2 lam beta term)
        keep = [c for c in _example_columns(EMG) if c != "s"]
        EM = EMG.select(*keep, (F.col("s") - F.lit(gamma) * F.col("gs")).alias("s"))  # one projection of a checkpoint
        L = found
        k += 1
    hist = spark.createDataFrame(
        history,
        "iter int, loss double, grad_norm double, gamma double, line_search_ok boolean, seconds double, "
        "acc double, pre double, rec double, converged boolean",
    )
    for held in (Xp, Ep, *([by_feature[0]] if by_feature else [])):
        held.unpersist()
    return beta, hist


# ------------------------------------------------------------------ helpers over labelled maps
def data_summary(X: DataFrame, E: DataFrame) -> DataFrame:
    """One row (n_examples, n_features, n_nonzeros): what a training run reports about its data."""
    n_ex = E.select(F.count(F.lit(1))).scalar()
    return X.agg(F.count_distinct("feature").alias("n_features"), F.count(F.lit(1)).alias("n_nonzeros")).select(
        n_ex.alias("n_examples"), "n_features", "n_nonzeros"
    )


def feature_keys(df: DataFrame, x: str = "x") -> DataFrame:
    """(feature): distinct keys of a ``map<string,double>`` feature column."""
    return df.select(F.explode(F.map_keys(x)).alias("feature")).distinct()


def map_to_sparse(
    df: DataFrame, x: str = "x", y: str = "y", id_col: str | None = None, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(X, E) from rows of (x map, y); ids from ``monotonically_increasing_id`` on a checkpoint; both carry ``keep``."""
    base = df if id_col else cut_lineage(df.withColumn("id", F.monotonically_increasing_id()))
    ident = id_col or "id"
    X = base.select(F.col(ident).alias("id"), *keep, F.explode(x).alias("feature", "value"))
    return X, base.select(F.col(ident).alias("id"), F.col(y).alias("y"), *keep)


# ------------------------------------------------------------------ cross-validation
def cross_validate_models(
    X: DataFrame,
    E: DataFrame,
    k: int,
    params: LinearParams | None = None,
    seed: int | str = 42,
    fold_col: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """k-fold CV of ``train_linear``: (summary, models, histories).

    ``summary`` has one row per held-out fold plus the mean metric: logistic loss reports
    (acc, pre, rec) of sign(<beta, x>) on the held-out examples, squared loss the held-out
    RMSE (NULL if nothing is held out).  ``models`` is (fold, feature, beta), ``histories``
    the training histories with their fold.  Folds come from column ``fold_col`` of E
    (e.g. read from fold files), else from md5 buckets of the example id.  All folds are
    trained side by side (``multi``): the data is laid out once and read once per pass.
    """
    from ..operators.folds import assign_folds
    from .multi import cross_validate_many

    p = params or LinearParams()
    if fold_col:
        Ef = E.select("id", "y", F.col(fold_col).alias("fold"))
    else:
        Ef = assign_folds(E.select("id", "y"), "id", k, seed)
    out, models, histories = cross_validate_many(X.select("id", "feature", "value"), Ef, k, [p.lam], p)
    metric = "acc" if p.loss == "logistic" else "rmse"
    mean = out.select(F.avg(metric)).scalar()  # a row per fold
    out = out.drop("lam").withColumn(f"mean_{metric}", mean)
    columns = ["fold", "iter", "loss", "grad_norm", "gamma", "line_search_ok", "seconds", "acc", "pre", "rec", "converged"]
    return out, models.drop("lam"), histories.select(*columns)


def cross_validate_linear(
    X: DataFrame,
    E: DataFrame,
    k: int,
    params: LinearParams | None = None,
    seed: int | str = 42,
    fold_col: str | None = None,
) -> DataFrame:
    """The summary of ``cross_validate_models``."""
    return cross_validate_models(X, E, k, params, seed, fold_col)[0]
