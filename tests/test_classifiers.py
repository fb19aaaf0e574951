"""What the forest and the perceptron are given."""

from pyspark.sql import functions as F

from sparkwork.registry import vectors

SF_SMALL = "/root/testdata/sf0.001"


def test_forest_and_perceptron_see_whole_vectors(spark):
    whole = {r["id"]: r["x"] for r in vectors._dense(spark, SF_SMALL).collect()}
    for rows in vectors._split(spark, SF_SMALL):
        assert all(r["x"] == whole[r["id"]] and len(r["x"]) == vectors.D for r in rows.collect())
        assert rows.select(F.countDistinct("label")).first()[0] == 4


def test_forest_learns_and_takes_odd_rows(spark):
    from sparkwork.plans import trees as TR

    rows = [(i, [float(i % 7), float(i % 3), 1.0], int(i % 7 > 3) + int(i % 3 == 1)) for i in range(300)]
    df = spark.createDataFrame([*rows, (1000, None, 1), (1001, [1.0, 1.0, 1.0], None)], "id long, x array<double>, label int")
    forest = TR.train_forest(df, "id", params=TR.ForestParams(trees=7, depth=3, bins=8, share=0.8))
    out = forest.predict(df.where("id < 1000")).select("label", "pred").collect()
    assert sum(r["label"] == r["pred"] for r in out) > 0.9 * len(out)
    none = TR.train_forest(df.where("false"), "id", params=TR.ForestParams(trees=2, depth=2))
    assert none.splits.count() == none.leaves.count() == 0


def test_network_learns_and_never_steps_on_test_rows(spark):
    from sparkwork.plans import network as NN

    rows = spark.createDataFrame([(i, [float(i % 2), float(i // 2 % 2)], int(i % 2 == 1)) for i in range(40)], "id long, x array<double>, label int")
    p = NN.NetworkParams(hidden=3, classes=2, lr=1.0, epochs=3, batch=16)
    model, h = NN.train_network(rows, ["id"], params=p, test=rows.where("id < 20"))
    other, _ = NN.train_network(rows, ["id"], params=p)
    h = h.orderBy("epoch").collect()
    assert h[-1]["loss"] < h[0]["loss"] and h[-1]["test_loss"] < h[0]["test_loss"]
    assert model.collect() == other.collect()
