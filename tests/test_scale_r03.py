"""Steps whose cost grew faster than their input."""

import os
import re
import tempfile

from pyspark.sql import functions as F

from sparkwork.functions import literals as L
from sparkwork.functions.text import normalise
from sparkwork.operators import folds as FO
from sparkwork.operators import text as T
from sparkwork.operators.vectors import explode_vector
from sparkwork.plans import blocks
from sparkwork.plans import factorise as MF
from sparkwork.plans import multi
from sparkwork.registry import linear as linear_queries
from sparkwork.sources import files as FI


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_files_of_one_folder(spark):
    folder = tempfile.mkdtemp(prefix="docs-") + "/docs"
    docs = spark.createDataFrame([(1, "a b"), (1, "a c"), (2, ""), (3, None), (None, "a")], "doc_id long, text string")
    FI.write_docs(docs, folder)
    assert not [d for _, ds, _ in os.walk(folder) for d in ds]  # a folder per document would be listed by a task each
    files = FI.list_docs(spark, folder)
    assert files.count() == files.distinct().count() == 4
    lines = FI.read_doc_lines(spark, folder)
    assert {r["term"]: r["df"] for r in T.idf_of_lines(lines, files).collect()} == {"a": 2, "b": 1, "c": 1}


LINES = [
    '({"a": 1.5, "b":2}, -1)',
    "({'a': 1e-3, 'it': -2.}, 1.0)",
    "( { } , 3 )",
    '({"a": 1, "a": 2}, 1)',
    "({u'a': 1l, 2: .5,}, 1,)",
    '({"x\\ty": 1, "#": 2, "a,b:c": 3}, 1)',
    '({"it\'s": 1}, 0)',
]


def test_labelled_lines_of_the_plain_form_read_as_the_others(spark):
    folder = tempfile.mkdtemp(prefix="labelled-") + "/lines"
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(folder)
    got = sorted((sorted(r["x"].items()), r["y"]) for r in FI.read_labelled(spark, folder).collect())
    general = spark.createDataFrame([(x,) for x in LINES], "value string").select(L.labelled(F.col("value")).alias("r"))
    assert got == sorted((sorted(r["r"]["x"].items()), r["r"]["y"]) for r in general.collect())


def test_malformed_labelled_lines_still_fail(spark):
    for line in ('({"a": 1 2}, 1)', '({,}, 1)', '({"a": 1,, "b": 2}, 1)', '({#}, 1)', '({"a": #}, 1)', '({"a": 1} 1)', '({"a" "b": 1}, 1)'):
        folder = tempfile.mkdtemp(prefix="labelled-") + "/lines"
        spark.createDataFrame([(line,)], "value string").write.text(folder)
        try:
            FI.read_labelled(spark, folder).count()
        except Exception as e:
            assert "malformed labelled line" in str(e)
        else:
            raise AssertionError(line)


def test_a_line_is_parsed_once(spark):
    folder = tempfile.mkdtemp(prefix="labelled-") + "/lines"
    spark.createDataFrame([(LINES[0],)], "value string").write.text(folder)
    rows = FI.read_labelled(spark, folder).select(F.explode("x").alias("feature", "value"), "y")
    optimized = rows._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("map_from_arrays") == 1


def test_blocks_are_a_grid(spark):
    """100 ratings a user and item: a profile goes to one row or column of the blocks, not to as many as it has ratings."""
    R = spark.createDataFrame([(i, (i * 37 + t * 11) % 500, 1.0) for i in range(500) for t in range(100)], "i long, j long, r double")
    laid = blocks.lay_out(R, 10)
    n = laid.ratings.select("blk").distinct().count()
    side = round(n**0.5)
    assert n >= 4
    for routes, key in ((laid.users, "i"), (laid.items, "j")):
        most = max(r["count"] for r in routes.groupBy(key).count().collect())
        assert most <= side + 1
    U, V = MF.init_profiles(R, "i", 10, 1, "u"), MF.init_profiles(R, "j", 10, 1, "v")
    assert "own" not in blocks.block_sums(laid, U, V, 10).columns  # a profile does not come back from every block
    laid.unpersist()


def test_user_step_sums_before_its_shuffle(spark):
    R = spark.createDataFrame([(i % 7, i % 11, 1.0) for i in range(77)], "i long, j long, r double")
    U, V = MF.init_profiles(R, "i", 2, 1, "u"), MF.init_profiles(R, "j", 2, 1, "v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = {}
        for last in ("i", "j"):
            J = MF.predict(R, U, V, last=last)
            joins = re.findall(r"SortMergeJoin \[(\w+)#", _plan(J))
            assert joins[0] == last
            S = MF.step(J, "i", "u", "v", 0.1, 1.0, 2)
            rows[last] = sorted((r["i"], [round(x, 9) for x in r["p"]]) for r in S.collect())
        assert rows["i"] == rows["j"] and len(rows["i"]) == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_training_union_joins_the_tables_once(spark, monkeypatch):
    from sparkwork.registry import aggregates as A

    made = []
    monkeypatch.setattr(FO, "train_union", lambda parts: made.extend(parts) or parts[0])
    A.q_train_union(spark, "/root/testdata/sf0.001")
    assert len(made) == 4 and not any("Join" in _plan(p) for p in made)


def test_initial_profiles_are_made_after_the_ratings_are_grouped(spark):
    """A filter inferred from the exploded array would be pushed to the scan, with a digest per rating in it."""
    R = spark.createDataFrame([(1, 2, 3.0), (1, 3, 1.0), (4, 2, None)], "i long, j long, r double").dropna()
    V = explode_vector(MF.init_profiles(R, "j", 3, 7, "v"), "j", "p")
    optimized = V._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in optimized.splitlines() if "Filter" in x and "md5" in x]
    assert sorted((r["j"], r["k"]) for r in V.collect()) == [(j, k) for j in (2, 3) for k in range(3)]


def test_explode_vector_of_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, []), (3, None), (4, [None, 5.0])], "id long, v array<double>")
    got = sorted((r["id"], r["k"], r["value"]) for r in explode_vector(df, "id", "v").collect() if r["value"] is not None)
    assert got == [(1, 0, 1.0), (1, 1, 2.0), (4, 1, 5.0)]
    assert explode_vector(df, "id", "v").count() == 4


def _all_characters():
    """A text per 4096 code points, each one between letters and as a word of its own."""
    for a in range(0, 0x110000, 4096):
        yield "".join(f"x{chr(c)}y {chr(c)} " for c in range(a, a + 4096) if not 0xD800 <= c < 0xE000)


def test_terms_of_every_character(spark):
    """Splitting a whole text equals splitting first and normalising each token."""
    docs = spark.createDataFrame([(i, x) for i, x in enumerate([*_all_characters(), "", None, " ", "1 ", "a\u00851b"])], "doc_id long, text string")
    words = T.tokens(docs).select("doc_id", normalise("word").alias("term")).where("term <> ''")
    got, want = T.terms(docs), words
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_tfidf_tokenises_the_texts_once(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b 1 c"), (None, "a"), (3, None)], "doc_id long, text string")
    tf = T.tf(T.terms(docs))
    plan = T.tfidf(tf, T.idf_from_tf(tf, docs))
    rows = sorted((r["doc_id"] or 0, r["term"], round(r["val"], 6)) for r in plan.collect())
    assert [r[:2] for r in rows] == [(0, "a"), (1, "a"), (1, "b"), (2, "b"), (2, "c")]
    found = [n for n in re.findall(r"Filter.*concat\(term", plan._jdf.queryExecution().optimizedPlan().toString())]
    assert not found
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = T.tfidf(tf, T.idf_from_tf(tf, docs))
        assert _plan(again).count("ReusedExchange") == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_training_features_are_read_not_joined_again(spark):
    X, _ = linear_queries._sparse(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in _plan(X)
    assert X.columns == ["id", "feature", "value"]


def test_slot_products_make_no_array_per_row(spark):
    X = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0), (2, "a", 3.0)], "id long, feature string, value double")
    EM = spark.createDataFrame([(1, 1.0, [0.0, 0.0]), (2, -1.0, [0.0, 0.0])], "id long, y double, s array<double>")
    grad = spark.createDataFrame([("a", [1.0, 10.0]), ("b", [5.0, None])], "feature string, grad array<double>")
    out = multi.with_products(X, EM, grad, 2, 2, None, 64)
    assert "transform(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["id"]: r["gs"] for r in out.collect()} == {1: [7.0, 20.0], 2: [3.0, 30.0]}
