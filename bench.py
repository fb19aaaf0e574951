"""Benchmark of the headline queries.

Runs each query over the tables in ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.
Every result is computed in full and discarded through the ``noop`` sink (nothing
is collected to the driver).  ``value`` sums the end-to-end query times; the
training runs also report their last iteration's wall time (``mf_iteration``,
``logistic_step``, ``linear_step``), which is not added to ``value``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from sparkwork import registry  # noqa: E402
from sparkwork.operators import text as T  # noqa: E402
from sparkwork.plans import factorise as MF  # noqa: E402
from sparkwork.plans import linear as LN  # noqa: E402
from sparkwork.session import local_session  # noqa: E402
from sparkwork.sources import fixtures as X  # noqa: E402


def _sink(df):
    df.write.format("noop").mode("overwrite").save()


def q_word_count(spark, sf):
    _sink(T.word_count(X.documents(spark, sf)))


def q_tfidf(spark, sf):
    docs = X.documents(spark, sf)
    tf = T.tf(T.terms(docs))
    _sink(T.tfidf(tf, T.idf_from_tf(tf, docs)))


def q_cosine_one_to_many(spark, sf):
    docs = X.documents(spark, sf)
    tf = T.tf(T.terms(docs))
    _sink(T.cosine_to(T.tfidf(tf, T.idf_from_tf(tf, docs)), 0))


STEP_TIMES: dict[str, float] = {}


def _last_step(name: str, hist) -> None:
    """Record the wall time of the last (warm) iteration of a training history."""
    rows = hist.orderBy("iter").collect()  # one row per iteration
    STEP_TIMES[name] = round(rows[-1]["seconds"], 3)


def q_mf_train_2iter(spark, sf):
    _, _, h = MF.train_mf(X.ratings(spark, sf), None, MF.MFParams(maxiter=2))
    _last_step("mf_iteration", h)


def q_logistic_train_2iter(spark, sf):
    Xd = X.features_sparse(spark, sf).select("id", "feature", "value")
    _, h = LN.train_linear(Xd, X.examples(spark, sf), LN.LinearParams(lam=0.1, max_iter=2))
    _last_step("logistic_step", h)


def q_linear_train_2iter(spark, sf):
    Xd, Ed = LN.columns_to_sparse(X.regression(spark, sf), ["x1", "x2", "x3"])
    _, h = LN.train_linear(Xd, Ed, LN.LinearParams(loss="squared", lam=0.1, max_iter=2, max_rows_per_example=3))
    _last_step("linear_step", h)


def q_balanced_sample(spark, sf):
    _sink(registry.queries()["balanced_sample"](spark, sf))


def q_softmax_scores(spark, sf):
    _sink(registry.queries()["softmax_scores"](spark, sf))


HEADLINE = {
    "word_count": q_word_count,
    "tfidf": q_tfidf,
    "cosine_one_to_many": q_cosine_one_to_many,
    "mf_train_2iter": q_mf_train_2iter,
    "logistic_train_2iter": q_logistic_train_2iter,
    "linear_train_2iter": q_linear_train_2iter,
    "balanced_sample": q_balanced_sample,
    "softmax_scores": q_softmax_scores,
}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(os.environ.get("BENCH_PARTITIONS", "16")), app="sparkwork-bench")
    spark.sparkContext.setLogLevel("ERROR")
    only = [a for a in sys.argv[1:] if a in HEADLINE]
    # warm the JVM (class loading, JIT, codegen caches) by running every query once on the smallest tables
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and warm != sf:
        for name, fn in HEADLINE.items():
            if not only or name in only:
                fn(spark, warm)
    times = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf)
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf)
    total = round(sum(times.values()), 3)  # end-to-end query times only
    times.update(STEP_TIMES)  # plus the warm per-iteration times inside the training runs
    out = {
        "metric": "total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
