"""Registered logistic / linear regression queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.folds import assign_folds
from ..plans import linear as LN
from ..plans.multi import cross_validate_many, sweep_lambdas
from ..session import cut_lineage
from ..sources import fixtures as X
from .aggregates import features_sparse_sql

LAM = 0.1
ITERS = 2


def _r(c, n=6, name=None):
    return F.round(c, n).alias(name or c)


def _sparse(spark, sf, written: bool = True):
    """(X, E); X, which a training reads several times, is ``written`` to the checkpoint folder once its lengths are joined."""
    fs = X.features_sparse(spark, sf).select("id", "feature", "value")
    return cut_lineage(fs) if written else fs, X.examples(spark, sf)


def _dense(spark, sf):
    return LN.explode_dense(X.features_dense(spark, sf))


SCALE = 10  # the scaled rows' curvature is 100 times the rows' own: the first steps need a smaller size


def _regression(spark, sf, ranked: bool = False, scale: int = 1):
    order = ["y", "x1", "x2", "x3"] if ranked else None  # ranked ids let the oracle rebuild the folds
    rows = X.regression(spark, sf)
    if scale != 1:
        rows = rows.select(*[(F.col(c) * scale).alias(c) for c in rows.columns])
    return LN.columns_to_sparse(rows, ["x1", "x2", "x3"], order=order)


def _params(loss="logistic", lam=LAM, iters=ITERS, bound=None):
    return LN.LinearParams(loss=loss, lam=lam, max_iter=iters, max_rows_per_example=bound)


FULL = LN.LinearParams().max_iter  # a whole training: until the gradient is small, after so many steps at most


def _gradient_at_zero(spark, Xd, Ed, loss, lam):
    Xp, Ep = LN.prepare_sparse(Xd, Ed)
    beta = LN.empty_beta(spark)
    EM = LN.margins(Xp, Ep, beta, 0)
    return Xp, Ep, LN.gradient(Xp, EM, beta, loss, lam)


def q_logistic_gradient(spark, sf):
    _, _, g = _gradient_at_zero(spark, *_sparse(spark, sf), "logistic", LAM)
    return g.select("feature", _r("grad"))


def q_logistic_loss(spark, sf):
    Xp, Ep, g = _gradient_at_zero(spark, *_sparse(spark, sf), "logistic", LAM)
    beta = g.select("feature", (F.lit(-0.01) * F.col("grad")).alias("beta"))
    EM = LN.margins(Xp, Ep, beta, beta.count())
    return LN.total_loss(EM, "logistic", LAM, beta).select("n", _r("loss"))


def q_line_search_table(spark, sf):
    Xp, Ep, g = _gradient_at_zero(spark, *_sparse(spark, sf), "logistic", LAM)
    beta = LN.empty_beta(spark)
    EM = LN.margins(Xp, Ep, beta, 0)
    L = LN.total_loss(EM, "logistic", LAM, beta).first()["loss"]
    g2 = g.select(F.sum(F.col("grad") * F.col("grad"))).first()[0]
    EMG = LN.direction_margins(Xp, EM, g, g.count())
    return LN.line_search_table(EMG, "logistic", LAM, L, g2, 0.0, 0.0).select("t", _r("gamma"), _r("loss"), "ok")


def q_line_search_deep(spark, sf):
    """Step sizes 2^-20 .. 2^-39 of the scaled regression: the search's second batch."""
    Xp, Ep, g = _gradient_at_zero(spark, *_regression(spark, sf, scale=SCALE), "squared", LAM)
    EM = LN.margins(Xp, Ep, LN.empty_beta(spark), 0)
    L = LN.total_loss(EM, "squared", LAM, LN.empty_beta(spark)).first()["loss"]
    g2 = g.select(F.sum(F.col("grad") * F.col("grad"))).first()[0]
    EMG = LN.direction_margins(Xp, EM, g, g.count())
    table = LN.line_search_table(EMG, "squared", LAM, L, g2, 0.0, 0.0, candidates=20, start=20)
    return table.select("t", F.round(F.col("gamma") * 1e9, 6).alias("gamma_e9"), _r("loss", 3), "ok")


def _history(df):
    return df.select("iter", _r("loss"), _r("grad_norm"), _r("gamma"), "line_search_ok")


def q_logistic_history(spark, sf):
    _, h = LN.train_linear(*_sparse(spark, sf), _params())
    return _history(h)


def q_logistic_score(spark, sf):
    Xd, Ed = _sparse(spark, sf)
    beta, _ = LN.train_linear(Xd, Ed, _params())
    return LN.evaluate(Xd, Ed, beta).select("tp", "fp", "tn", "fn", _r("acc"), _r("pre"), _r("rec"))


def q_logistic_dense_history(spark, sf):
    _, h = LN.train_linear(*_dense(spark, sf), _params(bound=64))
    return _history(h)


def q_linear_gradient(spark, sf):
    _, _, g = _gradient_at_zero(spark, *_regression(spark, sf), "squared", LAM)
    return g.select("feature", _r("grad"))


def q_linear_history(spark, sf):
    _, h = LN.train_linear(*_regression(spark, sf), _params("squared", bound=3))
    return _history(h)


def q_linear_history_scaled(spark, sf):
    """Training whose first steps need sizes beyond the search's first batch at scale."""
    _, h = LN.train_linear(*_regression(spark, sf, scale=SCALE), _params("squared", bound=3))
    return h.select("iter", _r("loss", 3), _r("grad_norm", 3), F.round(F.col("gamma") * 1e9, 6).alias("gamma_e9"), "line_search_ok")


def q_lambda_sweep(spark, sf):
    Xd, Ed = _sparse(spark, sf)
    _, out = sweep_lambdas(Xd, Ed, [0.0, 0.1, 1.0], _params(iters=1))
    return out.select("lam", "iter", _r("loss"), _r("grad_norm"), _r("gamma"), "line_search_ok")


def q_logistic_history_test(spark, sf):
    """Train on folds 1.. of a 2-fold split to the end, report test metrics of every iteration's model."""
    from ..operators.folds import assign_folds

    Xd, Ed = _sparse(spark, sf, written=False)
    folds = assign_folds(Ed, "id", 2, 42)
    tr, te = folds.where("fold <> 0").drop("fold"), folds.where("fold = 0").drop("fold")
    # the fold depends on the id alone: one join splits the features, and both parts are read several times
    Xf = cut_lineage(Xd.join(folds.select("id", "fold").distinct(), "id"))
    Xtr, Xte = Xf.where("fold <> 0").drop("fold"), Xf.where("fold = 0").drop("fold")
    _, h = LN.train_linear(Xtr, tr, _params(iters=FULL), test=(Xte, te))
    return h.select("iter", _r("loss"), _r("grad_norm"), _r("gamma"), _r("acc"), _r("pre"), _r("rec"))


def q_logistic_from_file(spark, sf):
    """The reference's flow: labelled examples read from a text file, then trained."""
    from ..session import scratch_path
    from ..sources import files as FI

    path = scratch_path(spark, "labelled-train")
    FI.write_table(FI.labelled_lines(*_sparse(spark, sf, written=False)), path, "text")
    Xd, Ed = LN.map_to_sparse(FI.read_labelled(spark, path))
    _, h = LN.train_linear(Xd, Ed, _params())
    return _history(h)


def _saved_model(spark, beta, name):
    from ..session import scratch_path
    from ..sources import files as FI

    path = scratch_path(spark, name)
    FI.write_model(beta, path)
    return FI.read_model(spark, path).select("feature", _r("beta"))


def q_logistic_model(spark, sf):
    """beta after 2 steps, written with the model sink and read back."""
    beta, _ = LN.train_linear(*_sparse(spark, sf), _params())
    return _saved_model(spark, beta, "logistic-beta")


def q_linear_model(spark, sf):
    beta, _ = LN.train_linear(*_regression(spark, sf), _params("squared", bound=3))
    return _saved_model(spark, beta, "linear-beta")


def q_labelled_summary(spark, sf):
    return LN.data_summary(*_sparse(spark, sf, written=False))


GRID = (0.0, 0.5, 2.0)


def q_lambda_cv(spark, sf):
    """Held-out RMSE of every fold and regularisation weight, all trained in one job."""
    Xd, Ed = _regression(spark, sf, ranked=True)
    summary, _, _ = cross_validate_many(Xd, assign_folds(Ed, "id", 3, 42), 3, GRID, _params("squared", bound=3))
    return summary.select("lam", "fold", "n_train", "n_test", _r("rmse"))


def q_logistic_cv(spark, sf):
    cv = LN.cross_validate_linear(*_sparse(spark, sf), 2, _params(), seed=42)
    return cv.select("fold", "n_train", "n_test", _r("acc"), _r("pre"), _r("rec"), "rmse", _r("mean_acc"))


def q_linear_cv(spark, sf):
    """Held-out RMSE of models that are trained to the end."""
    cv = LN.cross_validate_linear(*_regression(spark, sf, ranked=True), 3, _params("squared", iters=FULL, bound=3), seed=42)
    return cv.select("fold", "n_train", "n_test", _r("rmse"), _r("mean_rmse"))


def q_linear_cv_from_folds(spark, sf):
    """The same cross-validation from labelled text files, one folder per fold."""
    from ..operators.folds import assign_folds
    from ..session import scratch_path
    from ..sources import files as FI

    Xd, Ed = _regression(spark, sf, ranked=True)
    folder = scratch_path(spark, "labelled-folds")
    FI.write_folds(FI.labelled_lines(Xd, assign_folds(Ed, "id", 3, 42), keep=["fold"]), folder)  # one pass
    Xf, Ef = LN.map_to_sparse(FI.read_labelled_folds(spark, folder, 3), keep=["fold"])
    cv = LN.cross_validate_linear(Xf, Ef, 3, _params("squared", bound=3), fold_col="fold")
    return cv.select("fold", "n_train", "n_test", _r("rmse"), _r("mean_rmse"))


def q_linear_cv_models(spark, sf):
    """beta of each fold's training, written and read back."""
    from ..session import scratch_path
    from ..sources import files as FI

    _, models, _ = LN.cross_validate_models(*_regression(spark, sf, ranked=True), 3, _params("squared", bound=3), seed=42)
    path = scratch_path(spark, "fold-models")
    FI.write_table(models, path, partition_by=["fold"])
    return spark.read.parquet(path).select("fold", "feature", _r("beta"))


def q_linear_cv_history(spark, sf):
    """The training history of each fold, written and read back."""
    from ..session import scratch_path
    from ..sources import files as FI

    _, _, history = LN.cross_validate_models(*_regression(spark, sf, ranked=True), 3, _params("squared", bound=3), seed=42)
    path = scratch_path(spark, "fold-history")
    FI.write_table(history, path, partition_by=["fold"])
    return spark.read.parquet(path).select("fold", "iter", _r("loss"), _r("grad_norm"), _r("gamma"), "line_search_ok")


def q_logistic_score_saved(spark, sf):
    """Metrics of a model that was written and is read from its file."""
    from ..session import scratch_path
    from ..sources import files as FI

    Xd, Ed = _sparse(spark, sf)
    beta, _ = LN.train_linear(Xd, Ed, _params())
    path = scratch_path(spark, "scored-beta")
    FI.write_model(beta, path)
    out = LN.evaluate(Xd, Ed, FI.read_model(spark, path))
    return out.select("tp", "fp", "tn", "fn", _r("acc"), _r("pre"), _r("rec"))


def q_labelled_features(spark, sf):
    from ..session import scratch_path
    from ..sources import files as FI

    path = scratch_path(spark, "labelled-keys")
    FI.write_table(FI.labelled_lines(X.features_sparse(spark, sf), X.examples(spark, sf)), path, "text")
    return LN.feature_keys(FI.read_labelled(spark, path), "x")


QUERIES = {
    "logistic_model": q_logistic_model,
    "linear_model": q_linear_model,
    "labelled_summary": q_labelled_summary,
    "logistic_from_file": q_logistic_from_file,
    "logistic_history_test": q_logistic_history_test,
    "logistic_cv": q_logistic_cv,
    "linear_cv": q_linear_cv,
    "labelled_features": q_labelled_features,
    "logistic_gradient": q_logistic_gradient,
    "logistic_loss": q_logistic_loss,
    "line_search_table": q_line_search_table,
    "logistic_history": q_logistic_history,
    "logistic_score": q_logistic_score,
    "logistic_dense_history": q_logistic_dense_history,
    "linear_gradient": q_linear_gradient,
    "linear_history": q_linear_history,
    "lambda_sweep": q_lambda_sweep,
    "lambda_cv": q_lambda_cv,
    "line_search_deep": q_line_search_deep,
    "linear_history_scaled": q_linear_history_scaled,
    "linear_cv_from_folds": q_linear_cv_from_folds,
    "linear_cv_models": q_linear_cv_models,
    "linear_cv_history": q_linear_cv_history,
    "logistic_score_saved": q_logistic_score_saved,
}


# ---------------------------------------------------------------- oracle SQL
def _loss(loss: str, s: str, y: str) -> str:
    if loss == "logistic":
        m = f"(({y}) * ({s}))"
        return f"(greatest(-{m}, 0.0) + ln(1 + exp(-abs({m}))))"
    return f"((({s}) - ({y})) * (({s}) - ({y})))"


def _dloss(loss: str, s: str, y: str) -> str:
    if loss == "logistic":
        return f"(-({y}) / (1 + exp(({y}) * ({s}))))"
    return f"(2 * (({s}) - ({y})))"


def _lit(x: float) -> str:
    return f"({float(x)!r})::double"


SEARCHED = 45  # step sizes that the oracle tries; the engine's search has no last one


def lin_ctes(x_sql: str, e_sql: str, p: LN.LinearParams, pre: str = "") -> list[str]:
    """CTEs X, E, B0.., S{k}, G{k}, GS{k}, C{k} (candidates), H{k} (history rows), names prefixed by ``pre``."""
    lam, a = _lit(p.lam), _lit(p.a)
    tvals = ", ".join(f"({t}, {_lit(p.b ** t)})" for t in range(SEARCHED))
    X, E, TT = f"{pre}X", f"{pre}E", f"{pre}TT"

    def n(base: str, k: int) -> str:
        return f"{pre}{base}{k}"

    c = [
        f"{X} as ({x_sql})",
        f"{E} as ({e_sql})",
        f"{n('B', 0)} as (select feature, beta from (values ('', 0.0::double)) v(feature, beta) where false)",
        f"{TT} as (select * from (values {tvals}) v(t, gamma))",
        f"{n('S', 0)} as (select e.id, e.y, coalesce(m.s, 0.0) as s from {E} e left join (select x.id, sum(x.value * b.beta) as s "
        f"from {X} x join {n('B', 0)} b on x.feature = b.feature group by x.id) m on m.id = e.id)",
        f"{n('L', 0)} as (select sum({_loss(p.loss, 's', 'y')}) + {lam} * coalesce((select sum(beta * beta) from {n('B', 0)}), 0.0) "
        f"as loss from {n('S', 0)})",
    ]
    for k in range(p.max_iter):
        B, S, L, G, N, GS, C, CH = (n(b, k) for b in ("B", "S", "L", "G", "N", "GS", "C", "CH"))
        c += [
            f"{G} as (select coalesce(d.feature, r.feature) as feature, coalesce(d.g, 0.0) + coalesce(r.r, 0.0) as grad from "
            f"(select x.feature, sum(c.c * x.value) as g from {X} x join (select id, {_dloss(p.loss, 's', 'y')} as c from {S}) c "
            f"on c.id = x.id group by x.feature) d full outer join (select feature, 2 * {lam} * beta as r from {B}) r "
            f"on d.feature = r.feature)",
            f"{N} as (select sum(g.grad * g.grad) as g2, sum(g.grad * coalesce(b.beta, 0.0)) as bg, "
            f"coalesce((select sum(beta * beta) from {B}), 0.0) as b2 from {G} g left join {B} b on b.feature = g.feature)",
            f"{GS} as (select s.id, s.y, s.s, coalesce(m.gs, 0.0) as gs from {S} s left join (select x.id, "
            f"sum(x.value * g.grad) as gs from {X} x join {G} g on x.feature = g.feature group by x.id) m on m.id = s.id)",
            f"{C} as (select t, gamma, loss, loss <= (select loss from {L}) - {a} * gamma * (select g2 from {N}) as ok from "
            f"(select tt.t, tt.gamma, sum({_loss(p.loss, 'gs.s - tt.gamma * gs.gs', 'gs.y')}) + {lam} * "
            f"((select b2 from {N}) - 2 * tt.gamma * (select bg from {N}) + tt.gamma * tt.gamma * (select g2 from {N})) "
            f"as loss from {GS} gs, {TT} tt group by tt.t, tt.gamma))",
            f"{CH} as (select * from {C} where t = (select min(t) from {C} where ok))",
            f"{n('H', k)} as (select {k} as iter, (select loss from {L}) as loss, sqrt((select g2 from {N})) as grad_norm, "
            f"gamma, ok as line_search_ok from {CH})",
            f"{n('B', k + 1)} as (select coalesce(b.feature, g.feature) as feature, coalesce(b.beta, 0.0) - "
            f"(select gamma from {CH}) * coalesce(g.grad, 0.0) as beta from {B} b full outer join {G} g on b.feature = g.feature)",
            f"{n('S', k + 1)} as (select id, y, s - (select gamma from {CH}) * gs as s from {GS})",
            f"{n('L', k + 1)} as (select loss from {CH})",
        ]
    return c


def whole_ctes(x_sql: str, e_sql: str, p: LN.LinearParams, pre: str = "") -> list[str]:
    """CTEs X, E and W, a training until ||grad|| <= eps or ``max_iter`` steps, names prefixed by ``pre``.

    W is recursive: per step k a row (k, loss, grad_norm, gamma, ok) without a feature, and rows (k, feature, beta) of the
    model after it.  Unrolled, so many steps are nested too deeply.
    """
    lam = _lit(p.lam)
    tvals = ", ".join(f"({t}, {_lit(p.b ** t)})" for t in range(SEARCHED))
    X, E, W = f"{pre}X", f"{pre}E", f"{pre}W"
    step = [
        f"B as (select feature, beta from {W} where feature is not null)",
        "Q as (select coalesce(sum(beta * beta), 0.0) as b2 from B)",
        f"S as (select e.id, e.y, coalesce(m.s, 0.0) as s from {E} e left join (select x.id, sum(x.value * b.beta) as s "
        f"from {X} x join B b on x.feature = b.feature group by x.id) m on m.id = e.id)",
        f"L as (select sum({_loss(p.loss, 's', 'y')}) + {lam} * (select b2 from Q) as loss from S)",
        f"G as (select coalesce(d.feature, r.feature) as feature, coalesce(d.g, 0.0) + coalesce(r.r, 0.0) as grad from "
        f"(select x.feature, sum(c.c * x.value) as g from {X} x join (select id, {_dloss(p.loss, 's', 'y')} as c from S) c "
        f"on c.id = x.id group by x.feature) d full outer join (select feature, 2 * {lam} * beta as r from B) r "
        f"on d.feature = r.feature)",
        "N as (select sum(g.grad * g.grad) as g2, sum(g.grad * coalesce(b.beta, 0.0)) as bg "
        "from G g left join B b on b.feature = g.feature)",
        f"GS as (select s.y, s.s, coalesce(m.gs, 0.0) as gs from S s left join (select x.id, sum(x.value * g.grad) as gs "
        f"from {X} x join G g on x.feature = g.feature group by x.id) m on m.id = s.id)",
        f"C as (select t, gamma, loss <= (select loss from L) - {_lit(p.a)} * gamma * (select g2 from N) as ok from "
        f"(select tt.t, tt.gamma, sum({_loss(p.loss, 'gs.s - tt.gamma * gs.gs', 'gs.y')}) + {lam} * "
        f"((select b2 from Q) - 2 * tt.gamma * (select bg from N) + tt.gamma * tt.gamma * (select g2 from N)) "
        f"as loss from GS gs, (select * from (values {tvals}) v(t, gamma)) tt group by tt.t, tt.gamma))",
        "CH as (select gamma, ok from C where t = (select min(t) from C where ok))",
        f"K as (select k + 1 as k from {W} where feature is null and k + 1 < {p.max_iter} and coalesce(grad_norm > {_lit(p.eps)}, true))",
    ]
    return [
        f"{X} as materialized ({x_sql})",
        f"{E} as materialized ({e_sql})",
        f"{W} as (select -1 as k, null::varchar as feature, null::double as beta, null::double as loss, "
        f"null::double as grad_norm, null::double as gamma, null::boolean as ok union all (with " + ",\n".join(step) + "\n"
        "select K.k, null, null, (select loss from L), sqrt((select g2 from N)), CH.gamma, CH.ok from K, CH union all "
        "select K.k, coalesce(b.feature, g.feature), coalesce(b.beta, 0.0) - (select gamma from CH) * coalesce(g.grad, 0.0), "
        "null, null, null, null from K, B b full outer join G g on b.feature = g.feature))",
    ]


def _with_recursive(ctes, body):
    return "with recursive " + ",\n".join(ctes) + "\n" + body


def _with(ctes, body):
    return "with " + ",\n".join(ctes) + "\n" + body


SPARSE_X = f"select id, feature, value from ({features_sparse_sql()})"
SPARSE_E = "select doc_id as id, (2.0 * quality - 1)::double as y from labels"
DENSE_X = (
    "select vec_id as id, (pos - 1)::varchar as feature, embedding[pos]::double as value from "
    "(select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as pos from embeddings)"
)
DENSE_E = "select vec_id as id, (case when label < 5 then 1.0 else -1.0 end)::double as y from embeddings"
_REG = (
    "select row_number() over () as id, l_extendedprice / 10000 as y, l_quantity / 50 as x1, l_discount as x2, "
    "l_tax as x3 from lineitem"
)


def _reg_ctes(p, scale: int = 1):
    ctes = lin_ctes(
        "select id, feature, value from (select id, unnest(fs, recursive := true) from "
        "(select id, [{'feature': 'x1', 'value': x1}, {'feature': 'x2', 'value': x2}, {'feature': 'x3', 'value': x3}] as fs from R))",
        "select id, y from R",
        p,
    )
    rows = _REG if scale == 1 else f"select id, y * {scale} as y, x1 * {scale} as x1, x2 * {scale} as x2, x3 * {scale} as x3 from ({_REG})"
    return [f"R as ({rows})"] + ctes


_HIST_BODY = (
    "select iter, round(loss, 6) as loss, round(grad_norm, 6) as grad_norm, round(gamma, 6) as gamma, line_search_ok from ({})"
)


def _hist_union(iters):
    return " union all ".join(f"select * from H{k}" for k in range(iters))


_P = LN.LinearParams(loss="logistic", lam=LAM, max_iter=ITERS)
_P1 = LN.LinearParams(loss="logistic", lam=LAM, max_iter=1)
_PS = LN.LinearParams(loss="squared", lam=LAM, max_iter=ITERS)
_PW = LN.LinearParams(loss="logistic", lam=LAM, max_iter=FULL)


def _sweep_sql():
    parts = []
    for lam in (0.0, 0.1, 1.0):
        body = _with(
            lin_ctes(SPARSE_X, SPARSE_E, LN.LinearParams(loss="logistic", lam=lam, max_iter=1)),
            f"select {_lit(lam)} as lam, iter, round(loss, 6) as loss, round(grad_norm, 6) as grad_norm, "
            f"round(gamma, 6) as gamma, line_search_ok from H0",
        )
        parts.append(f"select * from ({body})")
    return " union all ".join(parts)


def _cv_sql(k: int = 2) -> str:
    fe = (
        f"select id, y, (('0x' || substr(md5(concat_ws(':', '42', id)), 1, 8))::bigint % {k}) as fold "
        f"from ({SPARSE_E})"
    )
    parts, ctes = [], [f"FE as ({fe})"]
    for f in range(k):
        pre = f"f{f}_"
        ctes += lin_ctes(
            f"select x.id, x.feature, x.value from ({SPARSE_X}) x join FE on FE.id = x.id where FE.fold <> {f}",
            f"select id, y from FE where fold <> {f}",
            _P,
            pre,
        )
        ctes += [
            f"{pre}SC as (select e.id, e.y, coalesce(m.s, 0.0) as s from (select id, y from FE where fold = {f}) e left join "
            f"(select x.id, sum(x.value * b.beta) as s from ({SPARSE_X}) x join {pre}B{ITERS} b on x.feature = b.feature "
            f"group by x.id) m on m.id = e.id)",
            f"{pre}CC as (select count(*) filter (where s > 0 and y > 0) as tp, count(*) filter (where s > 0 and y <= 0) as fp, "
            f"count(*) filter (where s <= 0 and y <= 0) as tn, count(*) filter (where s <= 0 and y > 0) as fn from {pre}SC)",
        ]
        parts.append(
            f"select {f} as fold, (select count(*) from FE where fold <> {f}) as n_train, "
            f"(select count(*) from FE where fold = {f}) as n_test, (tp + tn)::double / nullif(tp + fp + tn + fn, 0) as acc, "
            f"tp::double / nullif(tp + fp, 0) as pre, tp::double / nullif(tp + fn, 0) as rec from {pre}CC"
        )
    body = (
        "select fold, n_train, n_test, round(acc, 6) as acc, round(pre, 6) as pre, round(rec, 6) as rec, "
        "null::double as rmse, round(avg(acc) over (), 6) as mean_acc from (" + " union all ".join(parts) + ")"
    )
    return _with(ctes, body)


def _history_test_sql() -> str:
    fe = (
        "select id, y, (('0x' || substr(md5(concat_ws(':', '42', id)), 1, 8))::bigint % 2) as fold "
        f"from ({SPARSE_E})"
    )
    ctes = [f"FE as materialized ({fe})", f"XS as materialized ({SPARSE_X})"]
    ctes += whole_ctes(
        "select x.id, x.feature, x.value from XS x join FE on FE.id = x.id where FE.fold <> 0",
        "select id, y from FE where fold <> 0",
        _PW,
        "t_",
    )
    ctes += [
        "TE as (select id, y from FE where fold = 0)",
        "TS as (select x.id, w.k, sum(x.value * w.beta) as s from XS x join t_W w on x.feature = w.feature "
        "where x.id in (select id from TE) group by x.id, w.k)",
        "SC as (select h.k, e.y, coalesce(m.s, 0.0) as s from t_W h cross join TE e left join TS m on m.id = e.id and m.k = h.k "
        "where h.feature is null and h.k >= 0)",
        "CC as (select k, count(*) filter (where s > 0 and y > 0) as tp, count(*) filter (where s > 0 and y <= 0) as fp, "
        "count(*) filter (where s <= 0 and y <= 0) as tn, count(*) filter (where s <= 0 and y > 0) as fn from SC group by k)",
    ]
    body = (
        "select h.k as iter, round(loss, 6) as loss, round(grad_norm, 6) as grad_norm, round(gamma, 6) as gamma, "
        "round((tp + tn)::double / nullif(tp + fp + tn + fn, 0), 6) as acc, round(tp::double / nullif(tp + fp, 0), 6) as pre, "
        "round(tp::double / nullif(tp + fn, 0), 6) as rec from t_W h left join CC on CC.k = h.k where h.feature is null and h.k >= 0"
    )
    return _with_recursive(ctes, body)


def _linear_cv_sql(k: int = 3, part: str = "summary", lam: float = LAM, whole: bool = False) -> str:
    reg = (
        "select row_number() over (order by y, x1, x2, x3) - 1 as id, y, x1, x2, x3 from "
        "(select l_extendedprice / 10000 as y, l_quantity / 50 as x1, l_discount as x2, l_tax as x3 from lineitem)"
    )
    xs = (
        "select id, feature, value from (select id, unnest([{'feature': 'x1', 'value': x1}, {'feature': 'x2', 'value': x2}, "
        "{'feature': 'x3', 'value': x3}], recursive := true) from RG)"
    )
    fe = f"select id, y, (('0x' || substr(md5(concat_ws(':', '42', id)), 1, 8))::bigint % {k}) as fold from RG"
    p = LN.LinearParams(loss="squared", lam=lam, max_iter=FULL if whole else ITERS)
    ctes, parts = [f"RG as ({reg})", f"XS as ({xs})", f"FE as ({fe})"], []
    for f in range(k):
        pre = f"f{f}_"
        ctes += (whole_ctes if whole else lin_ctes)(
            f"select x.id, x.feature, x.value from XS x join FE on FE.id = x.id where FE.fold <> {f}",
            f"select id, y from FE where fold <> {f}",
            p,
            pre,
        )
        model = f"(select feature, beta from {pre}W where feature is not null and k = (select max(k) from {pre}W))" if whole else f"{pre}B{ITERS}"
        ctes.append(
            f"{pre}SC as (select e.id, e.y, coalesce(m.s, 0.0) as s from (select id, y from FE where fold = {f}) e left join "
            f"(select x.id, sum(x.value * b.beta) as s from XS x join {model} b on x.feature = b.feature "
            f"group by x.id) m on m.id = e.id)"
        )
        parts.append(
            f"select {f} as fold, (select count(*) from FE where fold <> {f}) as n_train, "
            f"(select count(*) from FE where fold = {f}) as n_test, sqrt(avg((s - y) * (s - y))) as rmse from {pre}SC"
        )
    if part == "models":
        betas = [f"select {f} as fold, feature, round(beta, 6) as beta from f{f}_B{ITERS}" for f in range(k)]
        return _with(ctes, " union all ".join(betas))
    if part == "history":
        rows = [
            f"select {f} as fold, iter, round(loss, 6) as loss, round(grad_norm, 6) as grad_norm, round(gamma, 6) as gamma, "
            f"line_search_ok from f{f}_H{i}"
            for f in range(k)
            for i in range(ITERS)
        ]
        return _with(ctes, " union all ".join(rows))
    body = (
        "select fold, n_train, n_test, round(rmse, 6) as rmse, round(avg(rmse) over (), 6) as mean_rmse from ("
        + " union all ".join(parts) + ")"
    )
    return (_with_recursive if whole else _with)(ctes, body)


ORACLE = {
    "logistic_model": _with(lin_ctes(SPARSE_X, SPARSE_E, _P), f"select feature, round(beta, 6) as beta from B{ITERS}"),
    "linear_model": _with(_reg_ctes(_PS), f"select feature, round(beta, 6) as beta from B{ITERS}"),
    "labelled_summary": (
        f"select (select count(*) from ({SPARSE_E})) as n_examples, count(distinct feature) as n_features, "
        f"count(*) as n_nonzeros from ({SPARSE_X})"
    ),
    "linear_cv": _linear_cv_sql(3, whole=True),
    "logistic_history_test": _history_test_sql(),
    "logistic_from_file": _with(lin_ctes(SPARSE_X, SPARSE_E, _P), _HIST_BODY.format(_hist_union(ITERS))),
    "logistic_cv": _cv_sql(2),
    "labelled_features": f"select distinct feature from ({SPARSE_X})",
    "logistic_gradient": _with(lin_ctes(SPARSE_X, SPARSE_E, _P1), "select feature, round(grad, 6) as grad from G0"),
    "logistic_loss": _with(
        lin_ctes(SPARSE_X, SPARSE_E, _P1)
        + [
            "BL as (select feature, -0.01::double * grad as beta from G0)",
            "SL as (select E.id, E.y, coalesce(m.s, 0.0) as s from E left join (select X.id, sum(X.value * B.beta) as s "
            "from X join BL B on X.feature = B.feature group by X.id) m on m.id = E.id)",
        ],
        f"select count(*) as n, round(sum({_loss('logistic', 's', 'y')}) + {_lit(LAM)} * "
        f"(select sum(beta * beta) from BL), 6) as loss from SL",
    ),
    "line_search_table": _with(
        lin_ctes(SPARSE_X, SPARSE_E, _P1), "select t, round(gamma, 6) as gamma, round(loss, 6) as loss, ok from C0 where t < 20"
    ),
    "logistic_history": _with(lin_ctes(SPARSE_X, SPARSE_E, _P), _HIST_BODY.format(_hist_union(ITERS))),
    "logistic_score": _with(
        lin_ctes(SPARSE_X, SPARSE_E, _P)
        + [
            f"SC as (select E.id, E.y, coalesce(m.s, 0.0) as s from E left join (select X.id, sum(X.value * B.beta) as s "
            f"from X join B{ITERS} B on X.feature = B.feature group by X.id) m on m.id = E.id)",
            "CC as (select count(*) filter (where s > 0 and y > 0) as tp, count(*) filter (where s > 0 and y <= 0) as fp, "
            "count(*) filter (where s <= 0 and y <= 0) as tn, count(*) filter (where s <= 0 and y > 0) as fn from SC)",
        ],
        "select tp, fp, tn, fn, round((tp + tn)::double / nullif(tp + fp + tn + fn, 0), 6) as acc, "
        "round(tp::double / nullif(tp + fp, 0), 6) as pre, round(tp::double / nullif(tp + fn, 0), 6) as rec from CC",
    ),
    "logistic_dense_history": _with(lin_ctes(DENSE_X, DENSE_E, _P), _HIST_BODY.format(_hist_union(ITERS))),
    "linear_gradient": _with(_reg_ctes(LN.LinearParams(loss="squared", lam=LAM, max_iter=1)), "select feature, round(grad, 6) as grad from G0"),
    "linear_history": _with(_reg_ctes(_PS), _HIST_BODY.format(_hist_union(ITERS))),
    "lambda_sweep": _sweep_sql(),
    "lambda_cv": " union all ".join(
        f"select {_lit(lam)} as lam, fold, n_train, n_test, rmse from ({_linear_cv_sql(3, lam=lam)})" for lam in GRID
    ),
    "line_search_deep": _with(
        _reg_ctes(LN.LinearParams(loss="squared", lam=LAM, max_iter=1), SCALE),
        "select t, round(gamma * 1e9, 6) as gamma_e9, round(loss, 3) as loss, ok from C0 where t between 20 and 39",
    ),
    "linear_history_scaled": _with(
        _reg_ctes(_PS, SCALE),
        "select iter, round(loss, 3) as loss, round(grad_norm, 3) as grad_norm, round(gamma * 1e9, 6) as gamma_e9, "
        f"line_search_ok from ({_hist_union(ITERS)})",
    ),
    "linear_cv_from_folds": _linear_cv_sql(3),
    "linear_cv_models": _linear_cv_sql(3, "models"),
    "linear_cv_history": _linear_cv_sql(3, "history"),
}
ORACLE["logistic_score_saved"] = ORACLE["logistic_score"]
