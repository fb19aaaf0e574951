"""Registered file-format round trips and the streaming word count.

Each query writes data that Spark derives from the given tables to a fresh folder
under the shared checkpoint folder, reads it back with the format's reader and
runs the operator, so the reader is checked against the oracle on whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as T
from ..session import cut_lineage, scratch_path
from ..sources import files as FI
from ..sources import fixtures as X
from ..sources.tables import read_table
from ..streaming.wordcount import latest_counts, word_count_stream
from .aggregates import FOLDS, RATINGS, features_sparse_sql
from .text import _IDF, _TERMS
from .text import ORACLE as TEXT_ORACLE


def q_ratings_scan(spark, sf):
    path = scratch_path(spark, "ratings")
    FI.write_table(X.ratings(spark, sf).select(F.concat_ws(",", "i", "j", "r").alias("value")), path, "text")
    return FI.read_ratings(spark, path).select("i", "j", F.round("r", 6).alias("r"))


def _fold_files(spark, sf, name):
    """The ratings as text, a folder per fold, written in one pass."""
    base = scratch_path(spark, name)
    FI.write_folds(X.ratings_folds(spark, sf).select(F.concat_ws(",", "i", "j", "r").alias("value"), "fold"), base)
    return base


def q_make_folds(spark, sf):
    """Lines of a ratings file split into five fold files; how many lines each fold got."""
    path, base = scratch_path(spark, "rating-lines"), scratch_path(spark, "made-folds")
    ratings = X.ratings(spark, sf).select(F.concat_ws(",", "i", "j").alias("value"))
    FI.write_table(ratings.select(F.concat("value", F.lit(",1.5")).alias("value")), path, "text")
    FI.make_folds(spark, path, base, 5)
    return FI.read_folds(spark, base, 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("j").alias("sum_j"))


def q_pairs_raw(spark, sf):
    """Raw word counts, whatever characters the words hold, written as pairs and read back."""
    path = scratch_path(spark, "raw-pairs")
    FI.write_table(FI.pair_lines(T.word_count(X.documents(spark, sf)), "word", "n"), path, "text")
    return FI.read_pairs(spark, path).select(F.col("term").alias("word"), F.col("val").cast("bigint").alias("n"))


def q_folds_scan(spark, sf):
    base = _fold_files(spark, sf, "folds")
    return FI.read_folds(spark, base, 5).select("i", "j", F.round("r", 6).alias("r"), "fold")


def q_labelled_scan(spark, sf):
    path = scratch_path(spark, "labelled")
    FI.write_table(FI.labelled_lines(X.features_sparse(spark, sf), X.examples(spark, sf)), path, "text")
    rows = FI.read_labelled(spark, path)
    return rows.select(F.explode("x").alias("feature", "value"), "y").select(
        "feature", F.round("value", 6).alias("value"), "y"
    )


def q_pairs_scan(spark, sf):
    path = scratch_path(spark, "pairs")
    pairs = X.terms(spark, sf).groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("val"))
    FI.write_table(FI.pair_lines(pairs, "term", "val"), path, "text")
    return T.top_terms(FI.read_pairs(spark, path), 20)


def q_word_count_lines(spark, sf):
    path = scratch_path(spark, "lines")
    FI.write_table(read_table(spark, sf, "documents").select(F.coalesce("text", F.lit("")).alias("value")), path, "text")
    return T.word_count(FI.read_lines(spark, path), "value")


def q_word_count_stream(spark, sf):
    src = scratch_path(spark, "stream-src")
    FI.write_table(read_table(spark, sf, "documents").select(F.coalesce("text", F.lit("")).alias("value")), src, "text")
    out = scratch_path(spark, "stream-out")
    q = word_count_stream(spark, src, out, max_files_per_trigger=1)
    q.awaitTermination()
    return latest_counts(spark, out).select("word", "n")


def q_model_roundtrip(spark, sf):
    path = scratch_path(spark, "model")
    pairs = X.features_sparse(spark, sf).groupBy("feature").agg(F.avg("value").alias("beta"))
    FI.write_model(pairs, path)
    return FI.read_model(spark, path).select("feature", F.round("beta", 6).alias("beta"))


def q_tf_file(spark, sf):
    """TF of one text file: every document's text written as lines of one folder."""
    path = scratch_path(spark, "tf-file")
    FI.write_table(read_table(spark, sf, "documents").select(F.coalesce("text", F.lit("")).alias("value")), path, "text")
    return T.tf(T.terms(FI.read_lines(spark, path), "value", keys=None), keys=None)


def q_idf_files(spark, sf):
    """IDF over a list of files, one document per file, read line by line (the file path is the document key)."""
    base = scratch_path(spark, "idf-files")
    FI.write_docs(read_table(spark, sf, "documents").select("doc_id", "text"), base)
    lines = FI.read_doc_lines(spark, base)
    out = T.idf_of_lines(lines, FI.list_docs(spark, base, lines))
    return out.select("term", "df", F.round("idf", 6).alias("idf"))


def _pair_file(spark, df, key, value, name):
    path = scratch_path(spark, name)
    FI.write_table(FI.pair_lines(df, key, value), path, "text")
    return FI.read_pairs(spark, path)


def q_tfidf_files(spark, sf):
    """TFIDF mode: TF pairs of one text and IDF pairs of the collection, each read from a pair file."""
    docs = X.documents(spark, sf)
    tf = T.tf(T.terms(docs, keys=None), keys=None)
    idf = T.idf(docs)
    tf_pairs = _pair_file(spark, tf, "term", "tf", "tf-pairs").withColumnRenamed("val", "tf")
    idf_pairs = _pair_file(spark, idf, "term", "idf", "idf-pairs").withColumnRenamed("val", "idf")
    return T.tfidf(tf_pairs, idf_pairs, keys=None).select("term", F.round("val", 6).alias("val"))


def q_cosine_files(spark, sf):
    """SIM mode: the TF-IDF scores of two documents, each read from a pair file."""
    from .text import two_documents

    s = two_documents(spark, sf)
    a = _pair_file(spark, s.where("doc_id = 0"), "term", "val", "sim-a")
    b = _pair_file(spark, s.where("doc_id = 1"), "term", "val", "sim-b")
    return T.cosine(a, b).select(*[F.round(c, 6).alias(c) for c in ("dot", "norm_a", "norm_b", "sim")])


def q_mf_cv_from_folds(spark, sf):
    """The reference's flow: ratings read from fold0..fold4 files, 5-fold CV, 2 iterations per fold."""
    from ..plans import factorise as MF

    base = _fold_files(spark, sf, "mf-folds")
    cv = MF.cross_validate_mf(FI.read_folds(spark, base, 5), 5, MF.MFParams(maxiter=2), fold_col="fold")
    return cv.select(
        "fold", "n_train", "n_test", *[F.round(c, 6).alias(c) for c in ("test_rmse", "test_rmse_all_rows", "mean_rmse")]
    )


QUERIES = {
    "mf_cv_from_folds": q_mf_cv_from_folds,
    "tfidf_files": q_tfidf_files,
    "cosine_files": q_cosine_files,
    "tf_file": q_tf_file,
    "idf_files": q_idf_files,
    "ratings_scan": q_ratings_scan,
    "folds_scan": q_folds_scan,
    "make_folds": q_make_folds,
    "pairs_raw": q_pairs_raw,
    "labelled_scan": q_labelled_scan,
    "pairs_scan": q_pairs_scan,
    "word_count_lines": q_word_count_lines,
    "word_count_stream": q_word_count_stream,
    "model_roundtrip": q_model_roundtrip,
}

def _mf_cv5_sql() -> str:
    from .factorise import _with, mf_ctes

    ctes, parts = [], []
    for f in range(5):
        ctes += mf_ctes(
            f"f{f}_", f"select i, j, r from ({FOLDS}) where fold <> {f}", f"select i, j, r from ({FOLDS}) where fold = {f}", 2
        )
        parts.append(
            f"select {f} as fold, (select count(*) from f{f}_R) as n_train, (select count(*) from f{f}_T) as n_test, "
            f"test_rmse, test_rmse_all_rows from f{f}_H2"
        )
    return _with(
        ctes,
        "select fold, n_train, n_test, round(test_rmse, 6) as test_rmse, round(test_rmse_all_rows, 6) as test_rmse_all_rows, "
        "round(avg(test_rmse) over (), 6) as mean_rmse from (" + " union all ".join(parts) + ")",
    )


ORACLE = {
    "mf_cv_from_folds": _mf_cv5_sql(),
    "tf_file": f"select term, count(*) as tf from ({_TERMS}) group by term",
    "tfidf_files": (
        f"select t.term, round(t.tf * i.idf, 6) as val from (select term, count(*)::double as tf from ({_TERMS}) "
        f"group by term) t join ({_IDF}) i on t.term = i.term"
    ),
    "cosine_files": TEXT_ORACLE["cosine_pair"],
    "idf_files": TEXT_ORACLE["idf"],
    "ratings_scan": f"select i, j, round(r, 6) as r from ({RATINGS})",
    "folds_scan": f"select i, j, round(r, 6) as r, fold from ({FOLDS})",
    "make_folds": (
        "select fold::integer as fold, count(*) as n, sum(j)::bigint as sum_j from (select j, ('0x' || substr(md5(concat_ws(':', '42', "
        f"concat_ws(',', i, j, '1.5'))), 1, 8))::bigint % 5 as fold from ({RATINGS})) group by fold"
    ),
    "pairs_raw": TEXT_ORACLE["word_count"],
    "labelled_scan": f"select feature, round(value, 6) as value, y from ({features_sparse_sql()})",
    "pairs_scan": TEXT_ORACLE["top_terms"],
    "word_count_lines": TEXT_ORACLE["word_count"],
    "word_count_stream": TEXT_ORACLE["word_count"],
    "model_roundtrip": f"select feature, round(avg(value), 6) as beta from ({features_sparse_sql()}) group by feature",
}

