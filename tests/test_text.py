from pyspark.sql import functions as F

from sparkwork.functions.text import NON_LETTER, normalise
from sparkwork.operators import text as T


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_lowercase_and_strip(spark):
    df = spark.createDataFrame([("BaNaNa",), ("B:a,n+a1n$a",), ("Ba,Na:Na.123",)], "w string")
    out = df.select(F.lower("w").alias("lo"), F.regexp_replace("w", NON_LETTER, "").alias("st"), normalise("w").alias("n"))
    rows = out.collect()
    assert rows[0]["lo"] == "banana"
    assert rows[1]["st"] == "Banana"
    assert rows[2]["n"] == "banana"


def test_terms_drop_empty_and_unicode_letters(spark):
    docs = _docs(spark, ["123 -- Ba,Na:Na.123  Über naïve", None, "   "])
    got = sorted((r.doc_id, r.term) for r in T.terms(docs).collect())
    assert got == [(0, "banana"), (0, "naïve"), (0, "über")]


def test_tokens_match_python_split(spark):
    texts = ["a  b\tc\nd", " lead trail ", "x\x1cy\x1fz w v", "", "one"]
    got = sorted((r.doc_id, r.word) for r in T.tokens(_docs(spark, texts)).collect())
    want = sorted((i, w) for i, t in enumerate(texts) for w in t.split())
    assert got == want


def test_word_count_sorted(spark):
    wc = T.word_count(_docs(spark, ["b a b", "c b a"])).collect()
    assert [(r.word, r.n) for r in wc] == [("b", 3), ("a", 2), ("c", 1)]


def test_tf_idf_tfidf(spark):
    docs = _docs(spark, ["a a b", "b c", ""])
    tf = {(r.doc_id, r.term): r.tf for r in T.tf(T.terms(docs)).collect()}
    assert tf == {(0, "a"): 2, (0, "b"): 1, (1, "b"): 1, (1, "c"): 1}
    idf = {r.term: (r.df, r.idf) for r in T.idf(docs).collect()}
    import math

    assert idf["b"][0] == 2 and abs(idf["b"][1] - math.log(3 / 2)) < 1e-12
    assert idf["a"][0] == 1 and abs(idf["a"][1] - math.log(3)) < 1e-12
    rel = {(r.doc_id, r.term): r.tf for r in T.tf(T.terms(docs), relative=True).collect()}
    assert abs(rel[(0, "a")] - 2 / 3) < 1e-12


def test_cosine(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "term string, val double")
    b = spark.createDataFrame([("x", 2.0), ("y", 4.0), ("z", 0.0)], "term string, val double")
    r = T.cosine(a, b).first()
    assert abs(r.sim - 1.0) < 1e-12
    c = spark.createDataFrame([("q", 1.0)], "term string, val double")
    assert T.cosine(a, c).first().sim == 0.0


def test_cosine_to_includes_zero_overlap(spark):
    s = spark.createDataFrame(
        [(0, "x", 1.0), (1, "x", 1.0), (2, "y", 3.0)], "doc_id long, term string, val double"
    )
    got = {r.doc_id: r.sim for r in T.cosine_to(s, 0).collect()}
    assert got == {1: 1.0, 2: 0.0}


def test_top_terms(spark):
    p = spark.createDataFrame([(f"t{i}", float(i % 7)) for i in range(50)], "term string, val double")
    got = [(r.term, r.val) for r in T.top_terms(p, 5).collect()]
    want = sorted(((f"t{i}", float(i % 7)) for i in range(50)), key=lambda x: (-x[1], x[0]))[:5]
    assert got == want


def test_cosine_zero_norm_is_null(spark):
    a = spark.createDataFrame([("x", 0.0)], "term string, val double")
    b = spark.createDataFrame([("x", 1.0)], "term string, val double")
    assert T.cosine(a, b).first().sim is None


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ALPHABET = "abcXYZ019.,:'-éÜßçñΣσ" + " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0  　"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=6))
def test_tokens_and_terms_match_python(spark, texts):
    docs = _docs(spark, texts)
    got_tokens = sorted((r.doc_id, r.word) for r in T.tokens(docs).collect())
    assert got_tokens == sorted((i, w) for i, t in enumerate(texts) for w in t.split())
    got_terms = sorted((r.doc_id, r.term) for r in T.terms(docs).collect())
    want = []
    for i, t in enumerate(texts):
        for w in t.split():
            term = "".join(c for c in w.lower() if c.isalpha())
            if term:
                want.append((i, term))
    assert got_terms == sorted(want)


def test_relative_tf_without_keys_and_missing_cosine_target(spark):
    docs = _docs(spark, ["a a b", "b"])
    rel = {r.term: r.tf for r in T.tf(T.terms(docs, keys=None), keys=None, relative=True).collect()}
    assert rel == {"a": 0.5, "b": 0.5}
    s = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "doc_id long, term string, val double")
    got = {r.doc_id: (r.dot, r.sim) for r in T.cosine_to(s, 99).collect()}
    assert got == {1: (0.0, None), 2: (0.0, None)}  # no target vector: no similarity
