"""Block-wise factorisation against the broadcast plans."""

import re

from sparkwork.plans import blocks
from sparkwork.plans import factorise as MF

from .test_skew import conf

SMALL_BLOCKS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}


def _ratings(spark):
    """User 0 and item 0 hold a third of the ratings each."""
    rows = [(0, j, float(j % 5)) for j in range(400)] + [(i, 0, float(i % 4)) for i in range(1, 400)]
    rows += [(i, (i * 7 + t) % 150 + 1, float((i + t) % 5)) for i in range(1, 200) for t in range(2)]
    return spark.createDataFrame(rows, "i long, j long, r double")


def _profiles(df, key):
    return {r[key]: [round(x, 9) for x in r["p"]] for r in df.collect()}


def test_block_training_equals_broadcast_training(spark):
    R = _ratings(spark)
    test = spark.createDataFrame([(0, 5, 1.0), (3, 0, 2.0), (9999, 0, 1.0), (1, 8888, 1.0)], "i long, j long, r double")
    p = MF.MFParams(d=3, maxiter=2, lam=0.3, mu=0.7)
    for held in (None, test):
        made = []
        for settings in ({}, SMALL_BLOCKS):
            with conf(spark, settings):
                U, V, h = MF.train_mf(R, held, p)
                hist = [tuple(round(x, 8) if isinstance(x, float) else x for x in r[:-1]) for r in h.orderBy("iter").collect()]
                made.append((_profiles(U, "i"), _profiles(V, "j"), hist))
        assert made[0] == made[1]


def test_a_hot_user_is_dealt_over_blocks_and_profiles_go_once_to_each(spark):
    with conf(spark, SMALL_BLOCKS):
        R = _ratings(spark)
        laid = blocks.lay_out(R, 3)
        most = 8192 // (blocks.RATING_BYTES + 16 * 3)
        sizes = [r["count"] for r in laid.ratings.groupBy("blk").count().collect()]
        assert sum(sizes) == R.count() and max(sizes) <= 2 * most
        assert laid.users.where("i = 0").count() > 3
        U, V = MF.init_profiles(R, "i", 3, 1, "u"), MF.init_profiles(R, "j", 3, 1, "v")
        sent = blocks.shipped(laid, U, V)
        assert sent.count() == sent.select("blk", "side", "key").distinct().count() == laid.users.count() + laid.items.count()
        laid.unpersist()


def test_no_exchange_holds_a_rating_with_a_vector(spark):
    with conf(spark, SMALL_BLOCKS):
        R = _ratings(spark)
        laid = blocks.lay_out(R, 3)
        U, V = MF.init_profiles(R, "i", 3, 1, "u").checkpoint(), MF.init_profiles(R, "j", 3, 1, "v").checkpoint()
        step = blocks.block_step(laid, U, V, 3, 0.1, 1.0, 1.0, True)
        plan = step._jdf.queryExecution().executedPlan().toString()
        text = spark._sc._jvm.PythonSQLUtils.explainString(step._jdf.queryExecution(), "formatted")
        exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
        assert len(exchanges) >= 4
        for columns in exchanges:
            assert not (re.search(r"\br#", columns) and re.search(r"\b(p|own|grad)#", columns))
        # nothing moves the persisted ratings on their way to the co-grouping
        lines = [(len(x) - len(x.lstrip(" :+-*()0123456789")), x) for x in plan.split("\n")]
        at = next(i for i, (_, x) in enumerate(lines) if "InMemoryTableScan" in x and "r#" in x)
        depth, above = lines[at][0], []
        for indent, x in lines[at::-1]:
            if indent < depth:
                depth = indent
                above.append(x)
                if "CoGroups" in x:
                    break
        assert "CoGroups" in above[-1] and not any("Exchange" in x for x in above)
        laid.unpersist()


def test_no_ratings(spark):
    R = spark.createDataFrame([], "i long, j long, r double")
    with conf(spark, SMALL_BLOCKS):
        U, V, h = MF.train_mf(R, None, MF.MFParams(d=2, maxiter=1))
        assert U.count() == V.count() == 0 and h.first()["objective"] == 0.0


def test_folds_trained_side_by_side_equal_single_trainings(spark, monkeypatch):
    from sparkwork.operators.folds import assign_folds, split

    R = _ratings(spark).where("i < 60 or j = 0")
    p = MF.MFParams(d=3, maxiter=3, lam=0.2, mu=0.4)
    calls = []
    plain = blocks.fold_sums
    monkeypatch.setattr(blocks, "fold_sums", lambda *a: calls.append(1) or plain(*a))
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB"}):
        cv = {r["fold"]: r for r in MF.cross_validate_mf(R, 3, p, seed=5).collect()}
    assert len(calls) == 3  # one pass over the ratings an iteration, whatever the folds
    folded = assign_folds(R, ["i", "j"], 3, 5)
    for f in range(3):
        train, test = split(folded, f)
        _, _, h = MF.train_mf(train.drop("fold"), test.drop("fold"), p)
        last = h.orderBy("iter").collect()[-1]
        assert (cv[f]["n_train"], cv[f]["n_test"]) == (train.count(), test.count())
        assert abs(cv[f]["test_rmse"] - last["test_rmse"]) < 1e-9 and abs(cv[f]["test_rmse_all_rows"] - last["test_rmse_all_rows"]) < 1e-9


def test_executors_need_no_copy_of_the_package(spark):
    """The functions that run inside tasks unpickle where the package cannot be imported."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    code = "import sys, pickle; f = pickle.loads(sys.stdin.buffer.read()); assert 'sparkwork' not in sys.modules; print(f.__name__)"
    out = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(blocks._scored), capture_output=True, cwd="/", timeout=60)
    assert out.stdout.decode().strip() == "_scored", out.stderr
