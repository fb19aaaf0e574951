"""Python literals, pairs, folds and documents of many lines."""

import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkwork.operators import text as T
from sparkwork.sources import files as FI

GOOD = [
    ("({u'a': 1, u\"b\": -2.5}, -1)", {"a": 1.0, "b": -2.5}, -1.0),
    ("({1: 2.0, 2.5: 3}, 1)", {"1": 2.0, "2.5": 3.0}, 1.0),
    (r"({u'caf\xe9': 1.0, 'x€y': 2, '\U0001f600': 3, u'😀!': 4}, 1)", {"café": 1.0, "x€y": 2.0, "😀": 3.0, "😀!": 4.0}, 1.0),
    ("({'a': 1,}, 1,)", {"a": 1.0}, 1.0),
    (r"""({'it\'s': 1, "say \"x\"": 2, 'a, b: {c}': 3, '\\n': 4, '\n\t\101\0z': 5, r'\n': 6, '\q': 7}, +1)""",
     {"it's": 1.0, 'say "x"': 2.0, "a, b: {c}": 3.0, "\n\tA\0z": 5.0, "\\n": 6.0, "\\q": 7.0}, 1.0),
    ("  ( { } , 1.0 )  ", {}, 1.0),
    ("({'a': 1, 'b': 2, 'a': 3}, 1L)", {"a": 3.0, "b": 2.0}, 1.0),
    ("({'e': 1e-3, 'f': .5, 'g': 2., 'h': +7}, -1)", {"e": 0.001, "f": 0.5, "g": 2.0, "h": 7.0}, -1.0),
]
BAD = [
    "x", "({'a': 1}, 1", "({'a': 1} 1)", "({'a': b}, 1)", "({'a'}, 1)", "({'a': 1 'b': 2}, 1)", "({'a': 1}, 'y')", "({'a': 1}, 1) x",
    "({'a: 1}, 1)", "({,}, 1)", "({'a': 1,,}, 1)", "({'a': {}}, 1)", "({'a': 1}, 1, 2)", "[{'a': 1}, 1]", "({'a': __import__('os')}, 1)",
    "({'a' 'b': 1}, 1)", "({'a': 1 2}, 1)", "({: 1}, 1)",
]


def _write(text):
    path = os.path.join(tempfile.mkdtemp(prefix="formats-"), "lines.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_labelled_literals(spark):
    rows = FI.read_labelled(spark, _write("\n".join(line for line, _, _ in GOOD))).collect()
    assert [(r["x"], r["y"]) for r in rows] == [(x, y) for _, x, y in GOOD]


def test_junk_fails(spark):
    from sparkwork.functions import literals as L

    rows = spark.createDataFrame(list(enumerate(BAD)), "i int, value string")
    assert rows.where(L.labelled(F.col("value"))["x"].isNotNull()).collect() == []
    for line in BAD[:3]:
        with pytest.raises(Exception, match="malformed labelled line"):
            FI.read_labelled(spark, _write(line)).select("y").collect()


def test_a_long_example(spark):
    n = 20_000
    line = "({" + ", ".join(f"u'f{i}': {i}.5" for i in range(n)) + "}, 1)"
    (row,) = FI.read_labelled(spark, _write(line)).collect()
    assert len(row["x"]) == n and row["x"]["f777"] == 777.5


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), max_size=8), min_size=1, max_size=20))
def test_pairs_round_trip(spark, words):
    words = [*words, "it's", "a,b", 'say "x"', "\\", "\n", "u'", "(", "\\u0041", ""]
    rows = spark.createDataFrame([(w, float(i)) for i, w in enumerate(words)], "w string, v double")
    path = tempfile.mkdtemp(prefix="pairs-") + "/out"
    FI.write_table(FI.pair_lines(rows, "w", "v"), path, "text")
    got = [(r["term"], r["val"]) for r in FI.read_pairs(spark, path).collect()]
    assert sorted(got) == sorted((w, float(i)) for i, w in enumerate(words))


def test_make_folds_is_one_pass(spark):
    path, out = _write("\n".join([f"{i},{i % 7},1.5" for i in range(300)] + ["1,1,1.5"] * 3 + [""])), tempfile.mkdtemp(prefix="folds-") + "/out"
    sc = spark.sparkContext
    sc.setJobGroup("make-folds", "one job")
    try:
        FI.make_folds(spark, path, out, 5)
        assert len(sc.statusTracker().getJobIdsForGroup("make-folds")) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    rows = FI.read_folds(spark, out, 5).collect()
    assert len(rows) == 303 and {r["fold"] for r in rows} == set(range(5))
    assert len({r["fold"] for r in rows if (r["i"], r["j"]) == (1, 1)}) == 1
    os.makedirs(out + "-named/fold_old")
    with open(out + "-named/fold_old/part", "w") as f:
        f.write("9,9,9\n")
    os.makedirs(out + "-named/fold0")
    with open(out + "-named/fold0/part", "w") as f:
        f.write("1,2,3\n")
    with pytest.raises(FileNotFoundError, match="1"):
        FI.read_folds(spark, out + "-named", 2)
    assert [tuple(r) for r in FI.read_folds(spark, out + "-named", 1).collect()] == [(1, 2, 3.0, 0)]


def test_idf_of_many_documents_in_a_folder(spark):
    folder = tempfile.mkdtemp(prefix="docs-")
    texts = {"a.txt": "One two\nthree one\n\n", "b.txt": "two", "c.txt": "", "d.txt": "four\n" * 30_000 + "one"}
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32KB")
    try:
        lines = FI.read_doc_lines(spark, folder)
        assert lines.where(F.col("doc").endswith("d.txt")).select(F.spark_partition_id()).distinct().count() > 2
        got = {r["term"]: (r["df"], round(r["idf"], 6)) for r in T.idf_of_lines(lines, FI.list_docs(spark, folder)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {"one": (2, 0.693147), "two": (2, 0.693147), "three": (1, 1.386294), "four": (1, 1.386294)}
