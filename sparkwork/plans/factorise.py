"""Matrix factorisation R ~ U V^T by gradient descent, with k-fold cross-validation.

Data layout: ratings ``(i, j, r)``; profiles ``(id, p: array<double>)`` for users
(key ``i``) and items (key ``j``).

Per iteration the plan is:

1. one pass over the ratings: profile tables whose counted size is under the broadcast
   threshold are joined with them, the residual is computed, and each rating is emitted
   twice, once keyed by its user and once by its item; larger profile tables are shipped
   block-wise instead (``blocks``), each profile once per block of ratings;
2. one hash aggregate by (side, key) with partial aggregation before the shuffle,
   giving the new user and item profiles (the simultaneous update of both) plus each
   key's squared error and old norm, from which the objective follows;
3. the new profiles are checkpointed to the shared checkpoint folder (lineage cut,
   safe against lost executors);
4. one pass over the test ratings for the RMSE (none when testing on the training
   ratings: the step's own squared error gives it).

No rating is ever grouped into one row: the per-key sums are d numbers.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions.vectors import dot, norm_sq
from ..session import cut_lineage, drop_scratch, fits_broadcast, release_unused, written
from . import blocks


@dataclass(frozen=True)
class MFParams:
    d: int = 10
    gain: float = 0.001
    power: float = 0.2
    lam: float = 1.0
    mu: float = 1.0
    maxiter: int = 20
    eps: float = 1e-99
    seed: int = 1234567
    weighted: bool = True  # regulariser added per rating row, as in the reference's step
    partitions: int | None = None  # spread the ratings over this many partitions (else as they come)
    blockwise: bool = False  # ship the profiles block-wise even where they could be broadcast


def init_profiles(R: DataFrame, key: str, d: int, seed: int, salt: str) -> DataFrame:
    """(key, p): one N(0,1)^d vector per distinct key, a pure function of (seed, salt, key, k)."""
    ids = R.select(key).distinct()
    vec = F.array(*[H.normal(F.lit(str(seed)), F.lit(salt), F.col(key), F.lit(k)) for k in range(d)])
    return ids.select(key, vec.alias("p"))


def _profile_row_bytes(d: int) -> int:
    return 8 * d + 48


def _maybe_broadcast(P: DataFrame, rows: int | None, d: int) -> DataFrame:
    if rows is not None and fits_broadcast(P.sparkSession, rows, _profile_row_bytes(d)):
        return F.broadcast(P)
    return P


def predict(
    R: DataFrame,
    U: DataFrame,
    V: DataFrame,
    n_users: int | None = None,
    n_items: int | None = None,
    d: int = 10,
    last: str = "j",
) -> DataFrame:
    """(i, j, r, pred, delta, u, v): ratings joined with both profiles; delta = <u,v> - r.

    Inner joins: a rating whose user or item has no profile is not scored.  The side ``last`` is joined last: by
    shuffle, its ratings then lie together, and a step of that side sums them before its own shuffle.
    """
    u = _maybe_broadcast(U.select("i", F.col("p").alias("u")), n_users, d)
    v = _maybe_broadcast(V.select("j", F.col("p").alias("v")), n_items, d)
    sides = [(u, "i"), (v, "j")] if last == "j" else [(v, "j"), (u, "i")]
    joined = R.select("i", "j", "r")
    for side, key in sides:
        joined = joined.join(side, key)
    pred = dot("u", "v")
    return joined.select("i", "j", "r", pred.alias("pred"), (pred - F.col("r")).alias("delta"), "u", "v")


def sse(J: DataFrame) -> DataFrame:
    """One row (sse, n): sum of squared residuals and number of scored ratings."""
    return J.agg(F.coalesce(F.sum(F.col("delta") * F.col("delta")), F.lit(0.0)).alias("sse"), F.count(F.lit(1)).alias("n"))


def norm_penalty(P: DataFrame, lam: float) -> Column:
    """Scalar column lam * sum ||p||^2 (a scalar subquery)."""
    return P.select(F.lit(float(lam)) * F.coalesce(F.sum(norm_sq("p")), F.lit(0.0))).scalar()


def _step_sums(rows: DataFrame, keys: list[str], d: int, gamma: float, weighted: bool) -> DataFrame:
    """Aggregate (keys..., own, other, delta, _lam) rows into the updated ``p`` per key.

    Only fixed-width buffers (doubles, longs): the own vector is carried as d
    ``any_value`` components (every row of a key holds the same vector), so the
    plan is a hash aggregate with partial aggregation, not a sort-based one.
    """
    other = F.col("other")
    grads = [F.sum(F.lit(2.0) * F.col("delta") * F.get(other, k)).alias(f"_g{k}") for k in range(d)]
    owns = [F.any_value(F.get("own", k)).alias(f"_o{k}") for k in range(d)]
    agg = rows.groupBy(*keys).agg(
        F.any_value("_lam").alias("_lam"),
        F.count(F.lit(1)).alias("n_ratings"),
        F.sum(F.col("delta") * F.col("delta")).alias("sse"),
        *owns,
        *grads,
    )
    w = F.col("n_ratings").cast("double") if weighted else F.lit(1.0)
    g = F.lit(float(gamma))
    new = F.array(
        *[F.col(f"_o{k}") - g * (F.col(f"_g{k}") + F.lit(2.0) * F.col("_lam") * w * F.col(f"_o{k}")) for k in range(d)]
    )
    old_norm = sum((F.col(f"_o{k}") * F.col(f"_o{k}") for k in range(1, d)), F.col("_o0") * F.col("_o0"))
    return agg.select(*keys, new.alias("p"), "n_ratings", "sse", old_norm.alias("old_norm_sq"))


def step(
    J: DataFrame,
    key: str,
    own: str,
    other: str,
    gamma: float,
    lam: float,
    d: int = 10,
    weighted: bool = True,
) -> DataFrame:
    """(key, p, n_ratings, sse, old_norm_sq): one gradient step of one side.

    p <- p - gamma * sum over the key's ratings of (2 delta other + 2 lam p)
    (``weighted=False``: the regulariser once per key, as the stated objective has it).
    """
    # through a generator the key loses the join's partitioning: the sums get a shuffle of their own, after partial
    # sums, and AQE may split the join's hot keys
    row = F.struct(
        F.col(key).alias(key), F.col(own).alias("own"), F.col(other).alias("other"), F.lit(float(lam)).alias("_lam")
    )
    return _step_sums(J.select("delta", F.inline(F.array(row))), [key], d, gamma, weighted)


def joint_step(
    R: DataFrame,
    U: DataFrame,
    V: DataFrame,
    p: MFParams,
    gamma: float,
    n_users: int | None,
    n_items: int | None,
) -> DataFrame:
    """(side, key, p, n_ratings, sse, old_norm_sq) for both sides from ONE pass over the ratings.

    Each joined rating is emitted twice (side 'u' keyed by i, side 'v' keyed by j) and
    one hash aggregate by (side, key) computes both simultaneous updates.
    """
    J = predict(R, U, V, n_users, n_items, p.d)
    both = F.array(
        F.struct(
            F.lit("u").alias("side"),
            F.col("i").alias("key"),
            F.col("u").alias("own"),
            F.col("v").alias("other"),
            F.lit(float(p.lam)).alias("_lam"),
        ),
        F.struct(
            F.lit("v").alias("side"),
            F.col("j").alias("key"),
            F.col("v").alias("own"),
            F.col("u").alias("other"),
            F.lit(float(p.mu)).alias("_lam"),
        ),
    )
    rows = J.select("delta", F.inline(both))
    return _step_sums(rows, ["side", "key"], p.d, gamma, p.weighted)


def rmse(R_test: DataFrame, U: DataFrame, V: DataFrame, n_users=None, n_items=None, d: int = 10) -> DataFrame:
    """One row (n_test, n_scored, rmse, rmse_all_rows).

    ``rmse`` is over the ratings that could be scored (user and item both known);
    ``rmse_all_rows`` divides by all test ratings, as the reference does.
    """
    J = predict(R_test, U, V, n_users, n_items, d)
    s = J.agg(F.coalesce(F.sum(F.col("delta") * F.col("delta")), F.lit(0.0)).alias("sse"), F.count(F.lit(1)).alias("n_scored"))
    n_test = R_test.select(F.count(F.lit(1))).scalar()
    return s.select(
        n_test.alias("n_test"),
        "n_scored",
        F.sqrt(F.col("sse") / F.nullif(F.col("n_scored"), F.lit(0))).alias("rmse"),
        F.sqrt(F.col("sse") / F.nullif(n_test, F.lit(0))).alias("rmse_all_rows"),
    )


def train_mf(
    R: DataFrame,
    R_test: DataFrame | None = None,
    params: MFParams | None = None,
    materialize: bool = True,
):
    """Gradient-descent factorisation.  Returns (U, V, history).

    ``history`` rows: (iter, gamma, objective, sse, change, test_rmse, test_rmse_all_rows, seconds);
    the objective and test RMSE of iteration i are measured with the profiles before
    its step, the step size is gain / i^power, and the loop ends after ``maxiter``
    iterations or when |change of objective| <= eps.  ``R_test=None`` tests on the
    training ratings.  ``materialize=False`` skips writing the ratings to the checkpoint
    folder, for inputs that already are short-lineage reads (e.g. filters of one).
    """
    p = params or MFParams()
    spark = R.sparkSession
    scratch = []

    def keep(df: DataFrame) -> DataFrame:
        if p.partitions:  # each iteration would deal it anew; only a checkpoint keeps the partitions
            return cut_lineage(df)
        if materialize:
            df, path = written(df, "ratings")
            scratch.append(path)
        return df

    R = R.select("i", "j", "r").dropna()  # NULL user, item or rating: not a rating
    if p.partitions:
        R = R.repartition(p.partitions)  # round-robin: even tasks whatever the key skew
    R = keep(R)
    self_test = R_test is None
    R_test = R if self_test else keep(R_test.select("i", "j", "r").dropna())
    n_total = R.count() if self_test else None
    U = cut_lineage(init_profiles(R, "i", p.d, p.seed, "u"))
    V = cut_lineage(init_profiles(R, "j", p.d, p.seed, "v"))
    n_users, n_items = U.count(), V.count()
    # block-wise where the profile tables are too large to broadcast
    small = not p.blockwise and all(fits_broadcast(spark, n, _profile_row_bytes(p.d)) for n in (n_users, n_items))
    laid = None if small else blocks.lay_out(R, p.d, p.partitions)
    laid_test = None if small or self_test else blocks.lay_out(R_test, p.d, p.partitions)
    n_test = None if laid_test is None else R_test.count()
    release_unused(spark)
    history = []
    obj, change, it = float("inf"), float("inf"), 0
    while it < p.maxiter and change > p.eps:
        it += 1
        t_start = time.perf_counter()
        gamma = p.gain / it**p.power
        if laid is None:
            both = cut_lineage(joint_step(R, U, V, p, gamma, n_users, n_items))
        else:
            both = cut_lineage(blocks.block_step(laid, U, V, p.d, gamma, p.lam, p.mu, p.weighted))
        stats = both.groupBy().agg(
            F.sum(F.when(F.col("side") == "u", F.col("sse"))).alias("sse"),
            F.sum(F.when(F.col("side") == "u", F.col("n_ratings"))).alias("n_scored"),
            F.sum(F.when(F.col("side") == "u", F.col("old_norm_sq"))).alias("nu"),
            F.sum(F.when(F.col("side") == "v", F.col("old_norm_sq"))).alias("nv"),
        )
        srow = stats.first()  # one row to the driver
        if self_test:
            # testing on the training ratings: the step's own squared error gives the RMSE
            trow = _rmse_row(srow["sse"], srow["n_scored"], n_total)
        elif laid_test is not None:
            trow = _rmse_row(*blocks.block_errors(laid_test, U, V, p.d).first(), n_test)
        else:
            trow = rmse(R_test, U, V, n_users, n_items, p.d).first()
        s = srow["sse"] or 0.0
        new_obj = s + p.lam * (srow["nu"] or 0.0) + p.mu * (srow["nv"] or 0.0)
        change = abs(new_obj - obj) if obj != float("inf") else float("inf")
        obj = new_obj
        history.append(
            (it, gamma, obj, s, None if change == float("inf") else change, trow["rmse"], trow["rmse_all_rows"],
             time.perf_counter() - t_start)
        )
        U = both.where(F.col("side") == "u").select(F.col("key").alias("i"), "p")
        V = both.where(F.col("side") == "v").select(F.col("key").alias("j"), "p")
        release_unused(spark)
    hist = spark.createDataFrame(
        history,
        "iter int, gamma double, objective double, sse double, change double, test_rmse double, "
        "test_rmse_all_rows double, seconds double",
    )
    for held in (laid, laid_test):
        if held is not None:
            held.unpersist()
    for path in scratch:  # the profiles are checkpoints of their own
        drop_scratch(spark, path)
    return U, V, hist


def _rmse_row(sse: float | None, n_scored: int | None, n_all: int) -> dict:
    return {
        "rmse": math.sqrt((sse or 0.0) / n_scored) if n_scored else None,
        "rmse_all_rows": math.sqrt((sse or 0.0) / n_all) if n_all else None,
    }


def _fold_profiles(folded: DataFrame, key: str, k: int, p: MFParams, salt: str) -> DataFrame:
    """(key, p, alive): the first vector of a key, once per model, and the models in which it has a training rating."""
    vec = F.array(*[H.normal(F.lit(str(p.seed)), F.lit(salt), F.col(key), F.lit(c)) for c in range(p.d)])
    folds = folded.groupBy(key).agg(F.collect_set("fold").alias("_folds"))  # k at most
    alive = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: F.exists("_folds", lambda g: g != f))
    return cut_lineage(folds.select(key, F.flatten(F.array_repeat(vec, k)).alias("p"), alive.alias("alive")))


def _train_folds(folded: DataFrame, k: int, p: MFParams) -> list[tuple]:
    """(fold, n_train, n_test, test_rmse, test_rmse_all_rows) of k models, each trained on all folds but its own."""
    folded = folded.dropna(subset=["i", "j", "r"])
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    U, V = _fold_profiles(folded, "i", k, p, "u"), _fold_profiles(folded, "j", k, p, "v")
    alive = {"i": U.select("i", "alive"), "j": V.select("j", "alive")}
    laid = blocks.lay_out(folded, p.d * k, p.partitions, ("fold",))
    release_unused(folded.sparkSession)
    last, obj, running, it = {}, [float("inf")] * k, set(range(k)), 0

    def total_of(side: str, column: str, f: int) -> Column:
        # a key without a rating in the model has no profile there
        counts = (F.col("side") == side) & ((F.lit(side) == "t") | (F.get("n", F.lit(f)) > 0))
        return F.coalesce(F.sum(F.when(counts, F.get(column, F.lit(f)))), F.lit(0.0))

    while running and it < p.maxiter:
        it += 1
        gammas = [p.gain / it**p.power if f in running else 0.0 for f in range(k)]
        both = cut_lineage(blocks.fold_step(blocks.fold_sums(laid, U, V, p.d, k), U, V, p.d, k, gammas, p.lam, p.mu, p.weighted))
        wanted = {"sse": ("u", "sse"), "nu": ("u", "norms"), "nv": ("v", "norms"), "se": ("t", "sse"), "n": ("t", "n")}
        s = both.agg(*[total_of(*w, f).alias(f"{name}{f}") for f in range(k) for name, w in wanted.items()]).first()
        for f in sorted(running):
            new = s[f"sse{f}"] + p.lam * s[f"nu{f}"] + p.mu * s[f"nv{f}"]
            last[f] = _rmse_row(s[f"se{f}"], int(s[f"n{f}"]), sizes.get(f, 0))
            if abs(new - obj[f]) <= p.eps:
                running.discard(f)
            obj[f] = new
        U = both.where(F.col("side") == "u").select(F.col("key").alias("i"), "p").join(alive["i"], "i")
        V = both.where(F.col("side") == "v").select(F.col("key").alias("j"), "p").join(alive["j"], "j")
        release_unused(folded.sparkSession)
    laid.unpersist()
    none = {"rmse": None, "rmse_all_rows": None}
    rows = [(f, total - sizes.get(f, 0), sizes.get(f, 0), last.get(f, none)) for f in range(k)]
    return [(f, a, b, r["rmse"], r["rmse_all_rows"]) for f, a, b, r in rows]


def cross_validate_mf(
    R: DataFrame,
    k: int,
    params: MFParams | None = None,
    seed: int | str = 42,
    fold_col: str | None = None,
) -> DataFrame:
    """(fold, n_train, n_test, test_rmse, test_rmse_all_rows, mean_rmse): k-fold CV of ``train_mf``.

    Folds come from ``fold_col`` when given (e.g. read from fold files), else from the
    md5 of (seed, i, j); fold f trains on the others and reports the last
    iteration's test RMSE.  The models of all folds are trained side by side: an iteration reads
    the ratings once, block-wise (``blocks``).  k = 1 trains and tests on all ratings.
    """
    from ..operators.folds import assign_folds

    p = params or MFParams()
    spark = R.sparkSession
    rows = []
    if k <= 1:
        _, _, h = train_mf(R, None, p)
        last = h.orderBy(F.desc("iter")).first()
        n = R.count()
        rows.append((0, n, n, last["test_rmse"], last["test_rmse_all_rows"]))
    else:
        if fold_col:
            folded = R.select("i", "j", "r", F.col(fold_col).alias("fold"))
        else:
            folded = assign_folds(R.select("i", "j", "r"), ["i", "j"], k, seed)
        folded, path = written(folded, "folded-ratings")
        rows = _train_folds(folded, k, p)
        drop_scratch(spark, path)
    out = spark.createDataFrame(rows, "fold int, n_train bigint, n_test bigint, test_rmse double, test_rmse_all_rows double")
    scored = [r[3] for r in rows if r[3] is not None]  # a fold none of whose ratings can be scored has no RMSE
    return out.withColumn("mean_rmse", F.lit(sum(scored) / len(scored) if scored else None).cast("double"))


def with_params(p: MFParams, **kw) -> MFParams:
    return replace(p, **kw)
