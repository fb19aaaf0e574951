"""Hot keys: results must not change when joins fall back from broadcast to shuffle
joins with AQE skew splitting.  Thresholds are forced low, and the final plans must show
the split (``skew=true``)."""

from contextlib import contextmanager

from sparkwork.operators import text as T
from sparkwork.plans import factorise as MF
from sparkwork.plans import linear as LN
from sparkwork.session import cut_lineage

NO_BROADCAST_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def collected(df):
    """(rows, whether the plan that ran split a hot partition of a join)."""
    rows = df.collect()
    return rows, "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def _hot_ratings(spark, user: bool):
    # one user (or item) holds a third of all ratings; the rest are spread
    rows = [(0, j, float(j % 5)) for j in range(4000)]
    rows += [(i, (i * 7 + t) % 4000, float((i + t) % 5)) for i in range(1, 2700) for t in range(3)]
    schema = "i long, j long, r double" if user else "j long, i long, r double"
    return cut_lineage(spark.createDataFrame(rows, schema).select("i", "j", "r"))


def _profiles(R, d):
    # written, as the trainer has them
    return cut_lineage(MF.init_profiles(R, "i", d, 1, "u")), cut_lineage(MF.init_profiles(R, "j", d, 1, "v"))


def _rounded(rows, keys):
    return sorted((*[r[k] for k in keys], tuple(round(x, 9) for x in r.p), round(r.sse, 9)) for r in rows)


def test_mf_steps_split_a_hot_user_and_a_hot_item(spark):
    p = MF.MFParams(d=4)
    for hot, other in (("i", "j"), ("j", "i")):
        R = _hot_ratings(spark, hot == "i")
        U, V = _profiles(R, p.d)
        nu, nv = U.count(), V.count()
        one = lambda J, key: MF.step(J, key, *(("u", "v") if key == "i" else ("v", "u")), 0.001, 1.0, p.d)
        broadcast = [
            _rounded(MF.joint_step(R, U, V, p, 0.001, nu, nv).collect(), ["side", "key"]),
            _rounded(one(MF.predict(R, U, V, nu, nv, p.d), hot).collect(), [hot]),
            _rounded(one(MF.predict(R, U, V, nu, nv, p.d), other).collect(), [other]),
        ]
        with conf(spark, NO_BROADCAST_SKEW):
            both, split_both = collected(MF.joint_step(R, U, V, p, 0.001, None, None))
            own, split_own = collected(one(MF.predict(R, U, V, d=p.d), hot))
            others, _ = collected(one(MF.predict(R, U, V, d=p.d), other))
        assert split_both and split_own
        assert [_rounded(both, ["side", "key"]), _rounded(own, [hot]), _rounded(others, [other])] == broadcast


def _common_term_docs(spark, n, own=3):
    """Documents that all have the term "the", and some of their own."""
    name = lambda i: "k" + "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, "the " + " ".join(name(i * 40 + t) for t in range(own))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_tfidf_splits_a_hot_term(spark):
    docs = _common_term_docs(spark, 6000)

    def scores():
        tf = T.tf(T.terms(docs))
        return T.tfidf(tf, T.idf_from_tf(tf, docs))

    known = sorted((r.doc_id, r.term, round(r.val, 9)) for r in scores().collect())
    with conf(spark, NO_BROADCAST_SKEW):
        rows, split = collected(scores())
    assert split and sorted((r.doc_id, r.term, round(r.val, 9)) for r in rows) == known


def test_cosine_splits_a_hot_term(spark):
    docs = cut_lineage(_common_term_docs(spark, 6000, own=1))
    tf = T.tf(T.terms(docs))
    scores = T.tfidf(tf, T.idf_from_tf(tf, docs, smooth=True)).repartition(8)
    known = sorted((r.doc_id, round(r.sim, 9)) for r in T.cosine_to(scores, 0).collect())
    with conf(spark, NO_BROADCAST_SKEW):
        rows, split = collected(T.cosine_to(scores, 0))
    assert split and sorted((r.doc_id, round(r.sim, 9)) for r in rows) == known and len(known) == 5999


def test_cosine_keeps_documents_without_terms(spark):
    docs = spark.createDataFrame([(0, "a b"), (1, "a"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.dot, r.sim) for r in T.cosine_to(T.tfidf(T.tf(T.terms(docs)), T.idf(docs)), 0, docs=docs).collect()}
    assert set(got) == {1, 2, 3} and got[1][1] > 0 and got[2] == got[3] == (0.0, None)


def test_word_count_independent_of_partitioning(spark):
    docs = spark.createDataFrame([(i, "a b " * (i % 7) + "c") for i in range(500)], "doc_id long, text string")
    a = {r.word: r.n for r in T.word_count(docs).collect()}
    b = {r.word: r.n for r in T.word_count(docs.repartition(13)).collect()}
    assert a == b and a["c"] == 500


def _hot_linear(spark):
    # example 0 holds about a third of all non-zeros, feature f0 is in every example
    rows = [(0, f"f{k}", 1.0 / (k + 1)) for k in range(300)]
    rows += [(i, f"f{(i * 7 + t) % 299 + 1}", 1.0) for i in range(1, 300) for t in range(2)]
    rows += [(i, "f0", 0.5) for i in range(1, 300)]
    X = spark.createDataFrame(rows, "id long, feature string, value double")
    E = spark.createDataFrame([(i, 1.0 if i % 3 else -1.0) for i in range(300)], "id long, y double")
    return X, E


def _steps(hist):
    return [(r.iter, round(r.loss, 9), round(r.gamma, 9)) for r in hist.orderBy("iter").collect()]


def test_linear_salted_layouts_give_the_same_model(spark):
    X, E = _hot_linear(spark)
    params = LN.LinearParams(lam=0.1, max_iter=2, partitions=8)
    even = _steps(LN.train_linear(X, E, params)[1])
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB"}  # 300 rows outweigh a partition
    with conf(spark, small):
        assert _steps(LN.train_linear(X, E, params)[1]) == even
    with conf(spark, NO_BROADCAST_SKEW | small):  # and a second layout by feature
        assert _steps(LN.train_linear(X, E, params)[1]) == even


def test_large_gradient_moves_and_the_features_do_not(spark):
    X, E = _hot_linear(spark)
    for size in ("4KB", "64MB"):  # with and without salted keys
        with conf(spark, NO_BROADCAST_SKEW | {"spark.sql.adaptive.advisoryPartitionSizeInBytes": size}):
            Xp, Ep = LN.prepare_sparse(X, E, 8)
            by_feature = LN.prepare_by_feature(Xp, 8)
            assert ("salt" in Xp.columns) == (by_feature[1] is not None) == (size == "4KB")
            EM = cut_lineage(LN.margins(Xp, Ep, LN.empty_beta(spark), 0, by_feature))
            grad = cut_lineage(LN.gradient(Xp, EM, LN.empty_beta(spark), "logistic", 0.1))
            for df in (LN.direction_margins(Xp, EM, grad, 300, by_feature), LN.gradient(Xp, EM, LN.empty_beta(spark), "logistic", 0.1)):
                assert not moved_features(df._jdf.queryExecution().executedPlan())


def moved_features(plan) -> bool:
    """Whether the cached features are exchanged before an aggregate has summed them up."""

    def walk(node, above):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan(), above)
        if name == "InMemoryTableScan" and "value#" in node.toString():
            path = above[::-1]
            summed = next((i for i, n in enumerate(path) if "Aggregate" in n), len(path))
            return any("Exchange" in n for n in path[:summed])
        children = node.children()
        return any(walk(children.apply(i), [*above, name]) for i in range(children.size()))

    return walk(plan, [])


def test_mf_training_same_with_partitioned_ratings(spark):
    # no hot user: without broadcast the ratings are hash-partitioned by user and persisted
    rows = [(i, (i * 7 + t) % 150, float((i + t) % 5)) for i in range(300) for t in range(4)]
    R = spark.createDataFrame(rows, "i long, j long, r double")
    p = MF.MFParams(d=3, maxiter=2)
    _, _, h_b = MF.train_mf(R, None, p)
    with conf(spark, NO_BROADCAST_SKEW | {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB"}):
        _, _, h_s = MF.train_mf(R, None, p)
    a = [(r.iter, round(r.objective, 6)) for r in h_b.orderBy("iter").collect()]
    b = [(r.iter, round(r.objective, 6)) for r in h_s.orderBy("iter").collect()]
    assert a == b
