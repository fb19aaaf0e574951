"""Registered text queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import NON_LETTER, WHITESPACE_RUN
from ..operators import text as T
from ..sources import fixtures as X

R6 = 6  # decimals kept on every float compared with the oracle


def _docs(spark, sf):
    return X.documents(spark, sf)


def q_word_count(spark, sf):
    return T.word_count(_docs(spark, sf))


def q_tokens_raw(spark, sf):
    return T.tokens(_docs(spark, sf))


def q_terms_normalised(spark, sf):
    return T.terms(_docs(spark, sf))


def q_tf(spark, sf):
    return T.tf(T.terms(_docs(spark, sf)))


def q_tf_relative(spark, sf):
    return T.tf(T.terms(_docs(spark, sf)), relative=True).select("doc_id", "term", F.round("tf", R6).alias("tf"))


def q_idf(spark, sf):
    return T.idf(_docs(spark, sf)).select("term", "df", F.round("idf", R6).alias("idf"))


def q_idf_smooth(spark, sf):
    return T.idf(_docs(spark, sf), smooth=True).select("term", "df", F.round("idf", R6).alias("idf"))


def _tfidf(spark, sf):
    docs = _docs(spark, sf)
    tf = T.tf(T.terms(docs))
    return T.tfidf(tf, T.idf_from_tf(tf, docs))


def q_tfidf(spark, sf):
    return _tfidf(spark, sf).select("doc_id", "term", F.round("val", R6).alias("val"))


def q_top_terms(spark, sf):
    pairs = T.terms(_docs(spark, sf), keys=None).groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("val"))
    return T.top_terms(pairs, 20)


def two_documents(spark, sf):
    """TF-IDF scores of documents 0 and 1: only the IDF needs the whole corpus."""
    from ..session import cut_lineage

    docs = _docs(spark, sf)
    tf = T.tf(T.terms(docs.where(F.col("doc_id").isin(0, 1))))
    return cut_lineage(T.tfidf(tf, T.idf(docs)))  # two documents' rows, read several times


def q_cosine_pair(spark, sf):
    s = two_documents(spark, sf)
    a = s.where("doc_id = 0").select("term", "val")
    b = s.where("doc_id = 1").select("term", "val")
    return T.cosine(a, b).select(*[F.round(c, R6).alias(c) for c in ("dot", "norm_a", "norm_b", "sim")])


def q_cosine_one_to_many(spark, sf):
    return T.cosine_to(_tfidf(spark, sf), 0, docs=_docs(spark, sf)).select(
        "doc_id", F.round("dot", R6).alias("dot"), F.round("sim", R6).alias("sim")
    )


QUERIES = {
    "word_count": q_word_count,
    "tokens_raw": q_tokens_raw,
    "terms_normalised": q_terms_normalised,
    "tf": q_tf,
    "tf_relative": q_tf_relative,
    "idf": q_idf,
    "idf_smooth": q_idf_smooth,
    "tfidf": q_tfidf,
    "top_terms": q_top_terms,
    "cosine_pair": q_cosine_pair,
    "cosine_one_to_many": q_cosine_one_to_many,
}

# The oracle splits first and normalises each token, as the reference describes.
_TOKENS = f"select doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '{WHITESPACE_RUN}')) as word from documents"
_TERMS = (
    f"select doc_id, term from (select doc_id, regexp_replace(lower(word), '{NON_LETTER}', '', 'g') as term "
    f"from ({_TOKENS})) where term <> ''"
)
_TF = f"select doc_id, term, count(*) as tf from ({_TERMS}) group by doc_id, term"
_IDF = (
    f"select term, count(*) as df, ln((select count(distinct doc_id) from documents)::double / count(*)) as idf "
    f"from (select distinct doc_id, term from ({_TERMS})) group by term"
)
_TFIDF = f"select t.doc_id, t.term, t.tf * i.idf as val from ({_TF}) t join ({_IDF}) i on t.term = i.term"

ORACLE = {
    "word_count": f"select word, count(*) as n from ({_TOKENS}) where word <> '' group by word",
    "tokens_raw": f"select doc_id, word from ({_TOKENS}) where word <> ''",
    "terms_normalised": _TERMS,
    "tf": _TF,
    "tf_relative": (
        f"select doc_id, term, round(tf::double / sum(tf) over (partition by doc_id), 6) as tf from ({_TF})"
    ),
    "idf": f"select term, df, round(idf, 6) as idf from ({_IDF})",
    "idf_smooth": (
        f"select term, count(*) as df, round(ln((1 + (select count(distinct doc_id) from documents))::double "
        f"/ (1 + count(*))) + 1, 6) as idf from (select distinct doc_id, term from ({_TERMS})) group by term"
    ),
    "tfidf": f"select doc_id, term, round(val, 6) as val from ({_TFIDF})",
    "top_terms": (
        f"select term, count(*)::double as val from ({_TERMS}) group by term order by val desc, term limit 20"
    ),
    "cosine_pair": f"""
        with s as ({_TFIDF}),
        a as (select term, val from s where doc_id = 0),
        b as (select term, val from s where doc_id = 1),
        d as (select coalesce(sum(a.val * b.val), 0.0) as dot from a join b on a.term = b.term),
        n as (select (select sqrt(sum(val * val)) from a) as na, (select sqrt(sum(val * val)) from b) as nb)
        select round(dot, 6) as dot, round(na, 6) as norm_a, round(nb, 6) as norm_b,
               round(dot / nullif(na * nb, 0), 6) as sim from d, n""",
    "cosine_one_to_many": f"""
        with s as ({_TFIDF}),
        t as (select term, val from s where doc_id = 0),
        tn as (select sqrt(sum(val * val)) as nb from t),
        o as (select d.doc_id, sqrt(sum(s.val * s.val)) as na from (select distinct doc_id from documents) d
              left join s on s.doc_id = d.doc_id where d.doc_id <> 0 group by d.doc_id),
        d as (select s.doc_id, sum(s.val * t.val) as dot from s join t on s.term = t.term
              where s.doc_id <> 0 group by s.doc_id)
        select o.doc_id, round(coalesce(d.dot, 0.0), 6) as dot,
               round(coalesce(d.dot, 0.0) / nullif(o.na * (select nb from tn), 0), 6) as sim
        from o left join d on o.doc_id = d.doc_id""",
}
