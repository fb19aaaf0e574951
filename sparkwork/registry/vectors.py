"""Registered vector and classifier queries and their DuckDB oracles."""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import functions as F

from ..functions.vectors import add, flatten_tensor, one_hot, scale, subtract
from ..operators import metrics as M
from ..operators import vectors as V
from ..operators.folds import assign_folds, split
from ..plans import classify as C
from ..plans import network as NN
from ..plans import trees as TR
from ..sources import fixtures as X
from .aggregates import DENSE
from .text import _TFIDF, two_documents

D = 64
N_CLASSES = 10
LR = 0.1


def _r(c, n=6, name=None):
    return F.round(c, n).alias(name or c)


def _dense(spark, sf):
    return X.features_dense(spark, sf)


def _model(spark, sf):
    """W after one softmax-regression step from zero, a (c, w) table."""
    W, _ = C.train_softmax(_dense(spark, sf), "x", "label", N_CLASSES, D, LR, steps=1)
    return W


def _scored(spark, sf):
    df = _dense(spark, sf)
    return C.predict_softmax(df, "x", _model(spark, sf))


def q_onehot_labels(spark, sf):
    df = _dense(spark, sf).select("id", one_hot("label", N_CLASSES).alias("v"))
    return V.explode_vector(df, "id", "v")


def q_vector_center(spark, sf):
    df = V.center(_dense(spark, sf).select("id", "x"), "x", 255.0)
    return V.explode_vector(df, "id", "x").select("id", "k", _r("value"))


def q_vector_center_split(spark, sf):
    """Training and test rows, each centred by the mean of its own split."""
    rows = assign_folds(_dense(spark, sf), "id", 5, 42)
    rows = rows.withColumn("split", F.when(F.col("fold") == 0, F.lit("test")).otherwise(F.lit("train")))
    centred = V.center_by(rows, "x", "split")
    return V.explode_vector(centred, ["id", "split"], "x").select("id", "split", "k", _r("value"))


def q_vector_minmax(spark, sf):
    return V.vector_minmax(_dense(spark, sf), "x").select(_r("min_value"), _r("max_value"))


def q_vector_sum_by_key(spark, sf):
    s = V.vector_sum_by(_dense(spark, sf), "label", "x", D)
    return V.explode_vector(s, "label", "total", "total").select("label", "k", _r("total"))


def q_vector_axpy(spark, sf):
    s = two_documents(spark, sf)
    a = s.where("doc_id = 0").select("term", "val")
    b = s.where("doc_id = 1").select("term", "val")
    return V.sparse_axpy(-0.5, b, a).select("term", _r("val"))


def q_softmax_gradient(spark, sf):
    g = C.softmax_gradient(_dense(spark, sf), "x", "label", C.zero_model(spark, N_CLASSES, D), D)
    return V.explode_vector(g, "c", "grad", "grad").select("c", "k", _r("grad"))


def q_softmax_scores(spark, sf):
    return V.explode_vector(_scored(spark, sf), "id", "probs", "p").select("id", "k", _r("p"))


def q_argmax_class(spark, sf):
    return _scored(spark, sf).select("id", "pred")


def q_cross_entropy(spark, sf):
    return M.cross_entropy(_scored(spark, sf), "probs", "label").select("n", _r("cross_entropy"))


def q_multiclass_accuracy(spark, sf):
    return M.multiclass_accuracy(_scored(spark, sf), "pred", "label").select("n", _r("accuracy"))


def q_batch_metric_mean(spark, sf):
    sc = _scored(spark, sf).select("id", (F.col("pred") == F.col("label")).cast("double").alias("correct"))
    return M.batch_metric_mean(sc, "correct", [F.asc("id")], 64).select("n_batches", _r("batch_mean"))


def q_batch_means_by_split(spark, sf):
    """Mini-batch means of correctness and cross-entropy, train (folds 1-4) and test (fold 0) numbered apart."""
    sc = assign_folds(_scored(spark, sf), "id", 5, 42).select(
        "id",
        F.when(F.col("fold") == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"),
        (F.col("pred") == F.col("label")).cast("double").alias("correct"),
        (-F.ln(F.element_at("probs", F.col("label") + 1))).alias("xent"),
    )
    out = M.batch_metric_means(sc, ["correct", "xent"], [F.asc("id")], 64, by=["split"])
    return out.select("split", "n_batches", _r("correct", name="batch_accuracy"), _r("xent", name="batch_loss"))


def q_label_lookup(spark, sf):
    pred = _scored(spark, sf).select("id", F.col("pred").alias("label"))
    return V.label_lookup(pred, C.label_names(spark)).select("id", F.col("label").alias("pred"), "name")


def _split(spark, sf):
    """(train, test) of vectors whose label follows from them: the signs of the first two elements."""
    sign = lambda k: F.when(F.get("x", k) > 0, 1).otherwise(0)
    rows = _dense(spark, sf).withColumn("label", (2 * sign(0) + sign(1)).cast("int"))
    return split(assign_folds(rows, "id", 5, 42), 0)


FOREST = TR.ForestParams(trees=3, depth=2, bins=16, share=0.25, seed=7)
NETWORK = NN.NetworkParams(hidden=16, classes=4, lr=0.5, epochs=2, seed=7)
BATCHES = 3


def _forest(spark, sf):
    train, test = _split(spark, sf)
    return TR.train_forest(train, "id", params=FOREST), test


def q_random_forest_score(spark, sf):
    """Accuracy of a forest of the given depth on the held-out fold."""
    forest, test = _forest(spark, sf)
    return forest.predict(test).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("pred") == F.col("label")).cast("double")), 6).alias("accuracy")
    )


def q_forest_splits(spark, sf):
    return _forest(spark, sf)[0].splits.select("tree", "node", "feature", "bin", _r("score"))


def q_forest_predictions(spark, sf):
    forest, test = _forest(spark, sf)
    return forest.predict(test).select("id", F.posexplode("votes").alias("tree", "vote"), "pred")


def q_mlp_score(spark, sf):
    """Loss and accuracy on the held-out fold after two steps of back-propagation on all training rows."""
    train, test = _split(spark, sf)
    model, _ = NN.train_network(train, ["id"], params=NETWORK)
    return NN.evaluate(test, "x", "label", model).select("n", _r("loss"), _r("accuracy"))


def q_mlp_model(spark, sf):
    train, _ = _split(spark, sf)
    model, _ = NN.train_network(train, ["id"], params=NETWORK)
    return NN.model_rows(model).select("layer", "unit", "k", _r("w"))


def q_mlp_epochs(spark, sf):
    """Two epochs over three mini-batches in the order of ids, with the means of full batches after each."""
    train, test = _split(spark, sf)
    params = dataclasses.replace(NETWORK, batch=max(train.count() // BATCHES, 1))
    _, history = NN.train_network(train, ["id"], params=params, test=test)
    return history.select("epoch", *[_r(c) for c in ("loss", "accuracy", "test_loss", "test_accuracy")])


WIDE = 48  # copies of an embedding side by side: 3,072 elements


def _wide(spark, sf):
    return _dense(spark, sf).withColumn("x", F.flatten(F.array_repeat("x", WIDE)))


def q_wide_vector_sum(spark, sf):
    s = V.vector_sum_by(_wide(spark, sf), "label", "x", D * WIDE)
    return V.explode_vector(s, "label", "total", "total").select("label", "k", _r("total"))


def q_wide_softmax_gradient(spark, sf):
    g = C.softmax_gradient(_wide(spark, sf), "x", "label", C.zero_model(spark, N_CLASSES, D * WIDE), D * WIDE)
    return V.explode_vector(g, "c", "grad", "grad").select("c", "k", _r("grad"))


def q_vector_add_dense(spark, sf):
    """x + y, x - y and 3 x of a vector and its reverse, element by element."""
    rows = _dense(spark, sf).select("id", "x", F.reverse("x").alias("y"))
    rows = rows.select("id", add("x", "y").alias("a"), subtract("x", "y").alias("s"), scale(F.lit(3.0), "x").alias("m"))
    both = rows.select("id", F.posexplode(F.arrays_zip("a", "s", "m")).alias("k", "e"))
    return both.select("id", "k", *[F.round(f"e.{c}", 6).alias(n) for c, n in (("a", "added"), ("s", "taken"), ("m", "tripled"))])


def q_flatten_halves(spark, sf):
    """Two halves of a vector as one tensor, flattened again."""
    halves = F.array(F.slice("x", 1, D // 2), F.slice("x", D // 2 + 1, D // 2)).alias("t")
    flat = _dense(spark, sf).select("id", halves).select("id", flatten_tensor("t").alias("x"))
    return V.explode_vector(flat, "id", "x").select("id", "k", _r("value"))


def q_softmax_history_test(spark, sf):
    """Loss and accuracy of every step on training folds and on the held-out one."""
    train, test = split(assign_folds(_dense(spark, sf), "id", 5, 42), 0)
    _, h = C.train_softmax(train, "x", "label", N_CLASSES, D, LR, steps=2, test=test)
    return h.select("step", _r("cross_entropy"), _r("accuracy"), _r("test_cross_entropy"), _r("test_accuracy"))


def q_softmax_model(spark, sf):
    """W after 3 steps: the classes x d model as (c, k, w) rows."""
    W, _ = C.train_softmax(_dense(spark, sf), "x", "label", N_CLASSES, D, LR, steps=3)
    return V.explode_vector(W, "c", "w", "w").select("c", "k", _r("w"))


def q_softmax_history(spark, sf):
    _, h = C.train_softmax(_dense(spark, sf), "x", "label", N_CLASSES, D, LR, steps=3)
    return h.select("step", _r("cross_entropy"), _r("accuracy"))


QUERIES = {
    "onehot_labels": q_onehot_labels,
    "vector_center": q_vector_center,
    "vector_minmax": q_vector_minmax,
    "vector_center_split": q_vector_center_split,
    "vector_sum_by_key": q_vector_sum_by_key,
    "vector_axpy": q_vector_axpy,
    "softmax_gradient": q_softmax_gradient,
    "softmax_scores": q_softmax_scores,
    "argmax_class": q_argmax_class,
    "cross_entropy": q_cross_entropy,
    "multiclass_accuracy": q_multiclass_accuracy,
    "batch_metric_mean": q_batch_metric_mean,
    "batch_means_by_split": q_batch_means_by_split,
    "label_lookup": q_label_lookup,
    "random_forest_score": q_random_forest_score,
    "forest_splits": q_forest_splits,
    "forest_predictions": q_forest_predictions,
    "mlp_score": q_mlp_score,
    "mlp_model": q_mlp_model,
    "mlp_epochs": q_mlp_epochs,
    "softmax_history": q_softmax_history,
    "softmax_model": q_softmax_model,
    "softmax_history_test": q_softmax_history_test,
    "wide_vector_sum": q_wide_vector_sum,
    "wide_softmax_gradient": q_wide_softmax_gradient,
    "vector_add_dense": q_vector_add_dense,
    "flatten_halves": q_flatten_halves,
}

# ---------------------------------------------------------------- oracle SQL
_LONG = (
    "select id, label, (pos - 1)::integer as k, x[pos] as v from "
    f"(select id, label, x, unnest(range(1, len(x) + 1)) as pos from ({DENSE}))"
)
_SOFTMAX_CTES = f"""
    L as ({_LONG}),
    NN as (select count(*)::double as n from ({DENSE})),
    CL as (select range::integer as c from range({N_CLASSES})),
    G0 as (select CL.c, L.k, sum((0.1::double - case when L.label = CL.c then 1.0 else 0.0 end) * L.v) / (select n from NN) as g
           from L, CL group by CL.c, L.k),
    W1 as (select c, k, 0.0::double - {LR!r}::double * g as w from G0),
    S as (select L.id, W1.c, sum(L.v * W1.w) as s from L join W1 on W1.k = L.k group by L.id, W1.c),
    E as (select id, c, exp(s - max(s) over (partition by id)) as e from S),
    P as (select id, c, e / sum(e) over (partition by id) as p from E),
    PM as (select id, max(p) as mp from P group by id),
    PR as (select P.id, min(P.c) as pred from P join PM on P.id = PM.id and P.p = PM.mp group by P.id),
    LB as (select id, label from ({DENSE})),
    SC as (select PR.id, PR.pred, LB.label from PR join LB on PR.id = LB.id)"""
_NAMES = "select * from (values " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(C.IMAGE_LABEL_NAMES)) + ") v(label, name)"

_FOLD = "(('0x' || substr(md5(concat_ws(':', '42', id)), 1, 8))::bigint % 5)"


def _softmax_history_sql(steps: int = 3, where: str = "true", test: bool = False) -> str:
    ctes = [
        f"L as (select * from ({_LONG}) where {where})",
        f"NN as (select count(*)::double as n from ({DENSE}) where {where})",
        f"CL as (select range::integer as c from range({N_CLASSES}))",
        f"KK as (select range::integer as k from range({D}))",
        "W0 as (select c, k, 0.0::double as w from CL, KK)",
    ]
    hist = []
    for s in range(steps):
        ctes += [
            f"S{s} as (select L.id, W.c, sum(L.v * W.w) as s from L join W{s} W on W.k = L.k group by L.id, W.c)",
            f"E{s} as (select id, c, exp(s - max(s) over (partition by id)) as e from S{s})",
            f"P{s} as (select id, c, e / sum(e) over (partition by id) as p from E{s})",
            f"PM{s} as (select id, max(p) as mp from P{s} group by id)",
            f"PR{s} as (select P.id, min(P.c) as pred from P{s} P join PM{s} M on P.id = M.id and P.p = M.mp group by P.id)",
            f"LB{s} as (select distinct id, label from L)",
            f"H{s} as (select {s} as step, (select avg(-ln(P.p)) from P{s} P join LB{s} B on P.id = B.id and P.c = B.label) "
            f"as cross_entropy, (select avg(case when R.pred = B.label then 1.0 else 0.0 end) from PR{s} R join LB{s} B "
            f"on R.id = B.id) as accuracy)",
            f"G{s} as (select P.c, L.k, sum((P.p - case when L.label = P.c then 1.0 else 0.0 end) * L.v) / (select n from NN) as g "
            f"from P{s} P join L on L.id = P.id group by P.c, L.k)",
            f"W{s + 1} as (select W.c, W.k, W.w - {LR!r}::double * G.g as w from W{s} W join G{s} G on G.c = W.c and G.k = W.k)",
        ]
        hist.append(f"select * from H{s}")
    if test:
        held = []
        for s in range(steps):
            ctes += [
                f"TS{s} as (select T.id, T.label, W.c, sum(T.v * W.w) as s from ({_LONG}) T join W{s} W on W.k = T.k "
                f"where {_FOLD} = 0 group by T.id, T.label, W.c)",
                f"TE{s} as (select *, exp(s - max(s) over (partition by id)) as e from TS{s})",
                f"TP{s} as (select *, e / sum(e) over (partition by id) as p from TE{s})",
                f"TM{s} as (select id, max(p) as mp from TP{s} group by id)",
                f"TR{s} as (select P.id, any_value(P.label) as label, min(P.c) as pred from TP{s} P join TM{s} M "
                f"on P.id = M.id and P.p = M.mp group by P.id)",
            ]
            held.append(
                f"select {s} as step, (select avg(-ln(p)) from TP{s} where c = label) as test_cross_entropy, "
                f"(select avg(case when pred = label then 1.0 else 0.0 end) from TR{s}) as test_accuracy"
            )
        body = (
            "select h.step, round(cross_entropy, 6) as cross_entropy, round(accuracy, 6) as accuracy, "
            "round(test_cross_entropy, 6) as test_cross_entropy, round(test_accuracy, 6) as test_accuracy from ("
            + " union all ".join(hist) + ") h join (" + " union all ".join(held) + ") t on t.step = h.step"
        )
        return "with " + ",\n".join(ctes) + "\n" + body
    body = (
        "select step, round(cross_entropy, 6) as cross_entropy, round(accuracy, 6) as accuracy from ("
        + " union all ".join(hist) + ")"
    )
    return "with " + ",\n".join(ctes) + "\n" + body


def _softmax_model_sql(steps: int = 3) -> str:
    full = _softmax_history_sql(steps)
    head = full[: full.rindex("\n") + 1]  # the CTEs, without the history body
    return head + f"select c, k, round(w, 6) as w from W{steps}"


_WIDE_LONG = f"select id, label, (k + j * {D})::integer as k, v from ({_LONG}), (select range as j from range({WIDE}))"
_SIGNED = (
    f"select id, (2 * (x[1] > 0)::integer + (x[2] > 0)::integer)::integer as label, x, {_FOLD} as fold from ({DENSE})"
)


def _hash_unit(seed: int, *parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(parts)})), 1, 8))::bigint / 4294967296.0::double)"


def _lit(x: float) -> str:
    return f"({float(x)!r})::double"


def _forest_sql(body: str, p: TR.ForestParams = FOREST) -> str:
    """The forest level by level: histograms, cumulative sums and the best split of each node."""
    u = _hash_unit(p.seed, "'row'", "t", "id")
    weight = "case " + " ".join(f"when {u} < {_lit(c)} then {k}" for k, c in enumerate(TR.POISSON)) + f" else {len(TR.POISSON)} end"
    ctes = [
        f"A as (select * from ({_SIGNED}))",
        "AL as (select id, label, fold, (pos - 1)::integer as k, x[pos] as v from (select *, unnest(range(1, len(x) + 1)) as pos from A))",
        "ED as (select k, min(v) as low, max(v) as high from AL where fold <> 0 group by k)",
        "BN as (select id, label, fold, k, coalesce(greatest(0, least(cast(floor((v - low) / nullif(high - low, 0.0::double) "
        f"* {_lit(p.bins)}) as bigint), {p.bins - 1})), 0)::integer as bin from AL join ED using (k))",
        f"TT as (select range::integer as t from range({p.trees}))",
        f"N0 as (select id, label, fold, t, 1::integer as node, {weight} as w from A, TT)",
    ]
    splits = []
    for lv in range(p.depth):
        lo, hi = 1 << lv, 2 << lv
        drawn = _hash_unit(p.seed, "'feature'", "t", "node", "k") + f" < {_lit(p.share)}"
        ctes += [
            f"D{lv} as (select t, node, k from (select distinct t, node from N{lv} where node >= {lo} and node < {hi}) q, "
            f"(select range::integer as k from range({D})) r where {drawn})",
            f"H{lv} as (select N.t, N.node, B.k, B.bin, N.label, sum(N.w)::bigint as n from N{lv} N join D{lv} Q on Q.t = N.t and "
            f"Q.node = N.node join BN B on B.id = N.id and B.k = Q.k where N.fold <> 0 and N.w > 0 group by all)",
            f"C{lv} as (select b.t, b.node, b.k, b.bin, l.label, (select coalesce(sum(h.n), 0) from H{lv} h where h.t = b.t and h.node = b.node "
            f"and h.k = b.k and h.label = l.label and h.bin <= b.bin)::bigint as nl, l.n as na from (select distinct t, node, k, bin from H{lv}) b "
            f"join (select t, node, k, label, sum(n)::bigint as n from H{lv} group by all) l using (t, node, k))",
            f"S{lv} as (select t, node, k, bin, sum(nl) as nl, sum(na) as na, sum(nl * nl) as sl, sum((na - nl) * (na - nl)) as sr, "
            f"sum(na * na) as sa from C{lv} group by all)",
            f"X{lv} as (select *, sl::double / nl::double + sr::double / (na - nl)::double as score from S{lv} where nl > 0 and nl < na)",
            f"B{lv} as (select * from (select *, row_number() over (partition by t, node order by score desc, k, bin) as r from X{lv} "
            f"where score > sa::double / na::double + 1e-9) where r = 1)",
            f"N{lv + 1} as (select N.id, N.label, N.fold, N.t, (case when S.k is null then N.node when B.bin <= S.bin then 2 * N.node "
            f"else 2 * N.node + 1 end)::integer as node, N.w from N{lv} N left join B{lv} S on S.t = N.t and S.node = N.node "
            f"left join BN B on B.id = N.id and B.k = S.k)",
        ]
        splits.append(f"select t, node, k, bin, score from B{lv}")
    ctes += [
        "SP as (" + " union all ".join(splits) + ")",
        f"LC as (select t, node, label, sum(w) as n from N{p.depth} where fold <> 0 and w > 0 group by all)",
        "LF as (select t, node, label from (select *, row_number() over (partition by t, node order by n desc, label) as r from LC) where r = 1)",
        f"VT as (select N.id, N.label, N.t, LF.label as vote from N{p.depth} N left join LF on LF.t = N.t and LF.node = N.node where N.fold = 0)",
        "PD as (select id, label, vote as pred from (select id, label, vote, row_number() over (partition by id order by count(*) desc, vote) as r "
        "from VT group by id, label, vote) where r = 1)",
    ]
    return "with " + ",\n".join(c.replace(" as (", " as materialized (", 1) for c in ctes) + "\n" + body


def _network_sql(steps: list[str], body: str, p: NN.NetworkParams = NETWORK) -> str:
    """Back-propagation unrolled: ``steps`` are conditions on rn, one per step; W1_s, W2_s are the weights after s steps."""
    h = lambda layer: f"md5(concat_ws(':', '{p.seed}', '{layer}', i, k))"

    def normal(layer: str, n_in: int) -> str:
        u1 = f"((('0x' || substr({h(layer)}, 1, 8))::bigint + 1) / 4294967297.0::double)"
        u2 = f"(('0x' || substr({h(layer)}, 9, 8))::bigint / 4294967296.0::double)"
        return f"sqrt(-2.0::double * ln({u1})) * cos(2 * pi() * {u2}) * {_lit(1 / math.sqrt(n_in))}"

    def initial(layer: str, n_out: int, n_in: int) -> str:
        return (
            f"select i, k, case when k < {n_in} then {normal(layer, n_in)} else 0.0::double end as w from "
            f"(select range::integer as i from range({n_out})), (select range::integer as k from range({n_in + 1}))"
        )

    def forward(name: str, s: int, where: str, rows: str = "R") -> list[str]:
        return [
            f"{name}H as (select L.id, W.i, tanh(sum(L.v * W.w)) as h from (select * from L join {rows} using (id) where {where}) L join W1_{s} W using (k) group by L.id, W.i)",
            f"{name}Y as (select id, i as k, h from {name}H union all select distinct id, {p.hidden}, 1.0::double from {name}H)",
            f"{name}Z as (select Y.id, W.i as c, sum(Y.h * W.w) as z from {name}Y Y join W2_{s} W using (k) group by Y.id, W.i)",
            f"{name}E as (select id, c, exp(z - max(z) over (partition by id)) as e from {name}Z)",
            f"{name}P as (select id, c, e / sum(e) over (partition by id) as p from {name}E)",
        ]

    ctes = [
        f"A as (select * from ({_SIGNED}))",
        "L as (select id, (pos - 1)::integer as k, x[pos] as v from (select *, unnest(range(1, len(x) + 1)) as pos from A) "
        f"union all select id, {D}, 1.0::double from A)",
        "R as (select id, label, row_number() over (order by id) - 1 as rn, count(*) over () as n from A where fold <> 0)",
        "T as (select id, label, row_number() over (order by id) - 1 as rn, count(*) over () as n from A where fold = 0)",
        f"W1_0 as ({initial('w1', p.hidden, D)})",
        f"W2_0 as ({initial('w2', p.classes, p.hidden)})",
    ]
    for s, where in enumerate(steps):
        ctes += forward(f"F{s}", s, where)
        ctes += [
            f"Q{s} as (select P.id, P.c, P.p - case when R.label = P.c then 1.0 else 0.0 end as e from F{s}P P join R using (id))",
            f"G{s} as (select Q.id, W.k as i, sum(Q.e * W.w) as e from Q{s} Q join W2_{s} W on W.i = Q.c where W.k < {p.hidden} group by Q.id, W.k)",
            f"M{s} as (select count(distinct id) as n from Q{s})",
            f"W1_{s + 1} as (select W.i, W.k, W.w - {_lit(p.lr)} / (select n from M{s}) * g.g as w from W1_{s} W join "
            f"(select G.i, L.k, sum(G.e * (1.0 - H.h * H.h) * L.v) as g from G{s} G join F{s}H H using (id, i) join L using (id) group by G.i, L.k) g using (i, k))",
            f"W2_{s + 1} as (select W.i, W.k, W.w - {_lit(p.lr)} / (select n from M{s}) * g.g as w from W2_{s} W join "
            f"(select Q.c as i, Y.k, sum(Q.e * Y.h) as g from Q{s} Q join F{s}Y Y using (id) group by Q.c, Y.k) g using (i, k))",
        ]
    more, body = body(forward) if callable(body) else ([], body)
    return "with " + ",\n".join(c.replace(" as (", " as materialized (", 1) for c in ctes + more) + "\n" + body


def _told(name: str, rows: str) -> str:
    """(id, loss, hit) of scored rows."""
    return (
        f"select q.id, rn, n, -ln(max(case when c = label then p end)) as loss, (arg_min(c, (-p, c)) = any_value(label))::integer as hit "
        f"from {name}P q join {rows} using (id) group by q.id, rn, n"
    )


def _mlp_score(forward):
    return forward("Z", 2, "true", "T"), f"select count(*) as n, round(avg(loss), 6) as loss, round(avg(hit), 6) as accuracy from ({_told('Z', 'T')})"


def _mlp_epochs(forward):
    more, rows = [], []
    size = f"greatest((select any_value(n) from R) // {BATCHES}, 1)"
    for e in range(NETWORK.epochs):
        parts = []
        for name, of in ((f"EV{e}", "R"), (f"ET{e}", "T")):
            more += forward(name, BATCHES * (e + 1), "true", of)
            batch = size if of == "R" else f"least({size}, (select any_value(n) from T))"
            parts.append(
                f"(select avg(loss) as loss, avg(hit) as hit from (select avg(loss) as loss, avg(hit) as hit from ({_told(name, of)}) "
                f"where rn < n // {batch} * {batch} group by rn // {batch}))"
            )
        rows.append(
            f"select {e} as epoch, round(a.loss, 6) as loss, round(a.hit, 6) as accuracy, round(b.loss, 6) as test_loss, "
            f"round(b.hit, 6) as test_accuracy from {parts[0]} a, {parts[1]} b"
        )
    return more, " union all ".join(rows)


_MLP_MODEL = (
    "select 'hidden' as layer, i as unit, k, round(w, 6) as w from W1_2 union all select 'output', i, k, round(w, 6) from W2_2"
)
_MLP_BATCHES = [f"rn >= {b} * greatest(n // {BATCHES}, 1) and rn < {b + 1} * greatest(n // {BATCHES}, 1)" for b in range(BATCHES)]

ORACLE = {
    "random_forest_score": _forest_sql("select count(*) as n, round(avg((pred = label)::integer), 6) as accuracy from PD"),
    "forest_splits": _forest_sql("select t as tree, node, k as feature, bin, round(score, 6) as score from SP"),
    "forest_predictions": _forest_sql("select VT.id, VT.t as tree, VT.vote, PD.pred from VT join PD using (id)"),
    "mlp_score": _network_sql(["true", "true"], _mlp_score),
    "mlp_model": _network_sql(["true", "true"], _MLP_MODEL),
    "mlp_epochs": _network_sql(_MLP_BATCHES * NETWORK.epochs, _mlp_epochs),
    "softmax_history_test": _softmax_history_sql(2, f"{_FOLD} <> 0", test=True),
    "wide_vector_sum": f"select label, k, round(sum(v), 6) as total from ({_WIDE_LONG}) group by label, k",
    "wide_softmax_gradient": f"""
        with L as ({_WIDE_LONG}), CL as (select range::integer as c from range({N_CLASSES}))
        select CL.c, L.k, round(sum((0.1::double - case when L.label = CL.c then 1.0 else 0.0 end) * L.v)
               / (select count(*) from ({DENSE})), 6) as grad from L, CL group by CL.c, L.k""",
    "vector_add_dense": f"""
        with L as ({_LONG})
        select a.id, a.k, round(a.v + b.v, 6) as added, round(a.v - b.v, 6) as taken, round(3.0 * a.v, 6) as tripled
        from L a join L b on a.id = b.id and b.k = {D - 1} - a.k""",
    "flatten_halves": f"select id, k, round(v, 6) as value from ({_LONG})",
    "softmax_model": _softmax_model_sql(3),
    "softmax_history": _softmax_history_sql(3),
    "onehot_labels": (
        f"select id, c as k, case when label = c then 1.0::double else 0.0::double end as value from ({DENSE}), "
        f"(select range::integer as c from range({N_CLASSES}))"
    ),
    "vector_center": f"""
        with L as ({_LONG}), M as (select avg(v / 255.0::double) as m from L)
        select id, k, round(v / 255.0::double - (select m from M), 6) as value from L""",
    "vector_center_split": f"""
        with L as (select *, case when {_FOLD} = 0 then 'test' else 'train' end as split from ({_LONG})),
        M as (select split, avg(v / 255.0::double) as m from L group by split)
        select id, split, k, round(v / 255.0::double - m, 6) as value from L join M using (split)""",
    "vector_minmax": f"select round(min(v), 6) as min_value, round(max(v), 6) as max_value from ({_LONG})",
    "vector_sum_by_key": f"select label, k, round(sum(v), 6) as total from ({_LONG}) group by label, k",
    "vector_axpy": f"""
        with s as ({_TFIDF}), a as (select term, val from s where doc_id = 0), b as (select term, val from s where doc_id = 1)
        select coalesce(a.term, b.term) as term, round(-0.5::double * coalesce(b.val, 0.0) + coalesce(a.val, 0.0), 6) as val
        from a full outer join b on a.term = b.term""",
    "softmax_gradient": f"with {_SOFTMAX_CTES} select c, k, round(g, 6) as grad from G0",
    "softmax_scores": f"with {_SOFTMAX_CTES} select id, c as k, round(p, 6) as p from P",
    "argmax_class": f"with {_SOFTMAX_CTES} select id, pred from PR",
    "cross_entropy": f"""with {_SOFTMAX_CTES}
        select count(*) as n, round(avg(-ln(P.p)), 6) as cross_entropy from P join LB on P.id = LB.id and P.c = LB.label""",
    "multiclass_accuracy": f"""with {_SOFTMAX_CTES}
        select count(*) as n, round(avg(case when pred = label then 1.0 else 0.0 end), 6) as accuracy from SC""",
    "batch_metric_mean": f"""with {_SOFTMAX_CTES},
        R as (select (row_number() over (order by id) - 1) as rn, case when pred = label then 1.0 else 0.0 end as correct from SC),
        B as (select floor(rn / 64) as b, avg(correct) as m from R where floor(rn / 64) < floor((select count(*) from R) / 64) group by 1)
        select count(*) as n_batches, round(avg(m), 6) as batch_mean from B""",
    "batch_means_by_split": f"""with {_SOFTMAX_CTES},
        PL as (select P.id, -ln(P.p) as xent from P join LB on P.id = LB.id and P.c = LB.label),
        R as (select SC.id, case when (('0x' || substr(md5(concat_ws(':', '42', SC.id)), 1, 8))::bigint % 5) = 0
                     then 'test' else 'train' end as split,
                     case when pred = label then 1.0 else 0.0 end as correct, PL.xent
              from SC join PL on SC.id = PL.id),
        RN as (select *, (row_number() over (partition by split order by id) - 1) as rn,
                      count(*) over (partition by split) as n from R),
        B as (select split, floor(rn / 64) as b, avg(correct) as ma, avg(xent) as ml from RN
              where floor(rn / 64) < floor(n / 64) group by split, floor(rn / 64))
        select split, count(*) as n_batches, round(avg(ma), 6) as batch_accuracy, round(avg(ml), 6) as batch_loss
        from B group by split""",
    "label_lookup": f"""with {_SOFTMAX_CTES}, NM as ({_NAMES})
        select PR.id, PR.pred, NM.name from PR left join NM on NM.label = PR.pred""",
}
