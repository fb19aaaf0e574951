import tempfile

import pytest

from sparkwork.sources import files as FI
from sparkwork.streaming.wordcount import latest_counts, word_count_stream


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_read_ratings_and_folds(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    import os

    for f in range(2):
        os.makedirs(f"{d}/fold{f}")
        _write(f"{d}/fold{f}/part-0", f"1,{f},2.5\n 3 , 4 , 1.0\n")
    folds = sorted(tuple(r) for r in FI.read_folds(spark, d, 2).collect())
    assert folds == [(1, 0, 2.5, 0), (1, 1, 2.5, 1), (3, 4, 1.0, 0), (3, 4, 1.0, 1)]
    _write(f"{d}/bad.csv", "1,x,2\n")
    with pytest.raises(Exception):
        FI.read_ratings(spark, f"{d}/bad.csv").collect()


def test_read_labelled_and_pairs(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    _write(f"{d}/lab.txt", "({'a': 1, \"b\": -2.5}, -1)\n({\"a\":1},+1)\n({},1.0)\n")
    rows = FI.read_labelled(spark, f"{d}/lab.txt").collect()
    assert [dict(r.x) for r in rows] == [{"a": 1.0, "b": -2.5}, {"a": 1.0}, {}]
    assert [r.y for r in rows] == [-1.0, 1.0, 1.0]
    _write(f"{d}/bad.txt", "(['a'], 1)\n")
    with pytest.raises(Exception):
        FI.read_labelled(spark, f"{d}/bad.txt").collect()
    _write(f"{d}/pairs.txt", "(u'foo', 3)\n('bar', 3.5)\n(baz,2)\n")
    got = [(r.term, r.val) for r in FI.read_pairs(spark, f"{d}/pairs.txt").collect()]
    assert got == [("foo", 3.0), ("bar", 3.5), ("baz", 2.0)]


@pytest.mark.parametrize("columns", [None, ["i"], ["j"], ["r"], ["i", "r"]])
def test_bad_ratings_fail_whatever_is_read(spark, columns):
    d = tempfile.mkdtemp(prefix="sw-test-")
    for k, bad in enumerate(["1,x,2", "1,2,abc", "1,2", "1,2,3,4", "x,2,3"]):
        _write(f"{d}/{k}.csv", f"1,2,3.5\n{bad}\n")
        with pytest.raises(Exception, match="malformed rating line"):
            rows = FI.read_ratings(spark, f"{d}/{k}.csv")
            rows.select(*columns).collect() if columns else rows.count()


@pytest.mark.parametrize("columns", [None, ["x"], ["y"]])
def test_bad_labelled_lines_fail_whatever_is_read(spark, columns):
    d = tempfile.mkdtemp(prefix="sw-test-")
    for k, bad in enumerate(["({'a': 1}, z)", "(['a'], 1)", "({'a': }, 1)", "nothing"]):
        _write(f"{d}/{k}.txt", "({'a': 1}, 1)\n" + bad + "\n")
        with pytest.raises(Exception):
            rows = FI.read_labelled(spark, f"{d}/{k}.txt")
            rows.select(*columns).collect() if columns else rows.count()


@pytest.mark.parametrize("columns", [None, ["term"], ["val"]])
def test_bad_pairs_fail_whatever_is_read(spark, columns):
    d = tempfile.mkdtemp(prefix="sw-test-")
    for k, bad in enumerate(["(a, b)", "a, 3", "('a' 3)"]):
        _write(f"{d}/{k}.txt", f"('a', 1)\n{bad}\n")
        with pytest.raises(Exception, match="malformed pair line"):
            rows = FI.read_pairs(spark, f"{d}/{k}.txt")
            rows.select(*columns).collect() if columns else rows.count()


def test_read_docs_and_sink_refuses_overwrite(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    _write(f"{d}/a.txt", "x y\nz")
    _write(f"{d}/b.txt", "w")
    docs = sorted((r.doc.rsplit("/", 1)[-1], r.text) for r in FI.read_docs(spark, [f"{d}/a.txt", f"{d}/b.txt"]).collect())
    assert docs == [("a.txt", "x y\nz"), ("b.txt", "w")]
    out = f"{d}/model"
    beta = spark.createDataFrame([("a", 1.0)], "feature string, beta double")
    FI.write_model(beta, out)
    assert FI.read_model(spark, out).first().beta == 1.0
    with pytest.raises(Exception):
        FI.write_model(beta, out)


def test_streaming_word_count(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    import os

    os.makedirs(f"{d}/src")
    _write(f"{d}/src/1.txt", "a b a\n")
    _write(f"{d}/src/2.txt", "b c\n")
    q = word_count_stream(spark, f"{d}/src", f"{d}/out", f"{d}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    got = {r.word: r.n for r in latest_counts(spark, f"{d}/out").collect()}
    assert got == {"a": 2, "b": 2, "c": 1}


def test_streaming_resumes_from_checkpoint(spark):
    import os

    d = tempfile.mkdtemp(prefix="sw-test-")
    os.makedirs(f"{d}/src")
    _write(f"{d}/src/1.txt", "a b\n")
    word_count_stream(spark, f"{d}/src", f"{d}/out", f"{d}/ckpt").awaitTermination()
    _write(f"{d}/src/2.txt", "a c\n")
    # a restart with the same checkpoint processes only the new file and keeps the state
    word_count_stream(spark, f"{d}/src", f"{d}/out", f"{d}/ckpt").awaitTermination()
    got = {r.word: r.n for r in latest_counts(spark, f"{d}/out").collect()}
    assert got == {"a": 2, "b": 1, "c": 1}
