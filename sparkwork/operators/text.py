"""Text statistics: tokens, word counts, TF, IDF, TF-IDF, top terms, cosine similarity.

Every operator is a DataFrame transformation.  Tokenising is ``explode(split())``
inside whole-stage codegen; counts are hash aggregates with map-side partial
aggregation, so a very frequent word costs one partial row per task, not one
row per occurrence, before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_terms, split_words
from ..session import cut_lineage, sized_broadcast


def _keys(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def tokens(df: DataFrame, text: str = "text", keys: str | Sequence[str] | None = "doc_id") -> DataFrame:
    """(keys..., word): whitespace tokens of ``text``, case and punctuation kept."""
    ks = _keys(keys)
    return df.select(*ks, F.explode(split_words(text)).alias("word")).where(F.col("word") != "")


def terms(df: DataFrame, text: str = "text", keys: str | Sequence[str] | None = "doc_id") -> DataFrame:
    """(keys..., term): lowercased, letters-only tokens; empty ones dropped.

    They are dropped before the explode: a filter on ``term`` would be copied to one side of the join in ``tfidf`` only, the
    two TF aggregates would differ, and the texts would be tokenised and shuffled twice.
    """
    ks = _keys(keys)
    return df.select(*ks, F.explode(F.array_remove(split_terms(text), "")).alias("term"))


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts, most frequent first (ties by word)."""
    counted = tokens(df, text, keys=None).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc("word"))


def tf(term_rows: DataFrame, keys: str | Sequence[str] | None = "doc_id", relative: bool = False) -> DataFrame:
    """(keys..., term, tf): occurrences of each term per key.

    ``relative=True`` divides by the number of terms of the key.  The per-key total
    is a separate aggregate joined back on the key (no window holding a whole
    document in one task).
    """
    ks = _keys(keys)
    counts = term_rows.groupBy(*ks, "term").agg(F.count(F.lit(1)).alias("tf"))
    if not relative:
        return counts
    if not ks:
        total = term_rows.select(F.count(F.lit(1))).scalar()
        return counts.select("term", (F.col("tf") / total).alias("tf"))
    totals = counts.groupBy(*ks).agg(F.sum("tf").alias("_total"))
    return counts.join(totals, ks).select(*ks, "term", (F.col("tf") / F.col("_total")).alias("tf"))


def idf(
    docs: DataFrame,
    text: str = "text",
    doc: str = "doc_id",
    smooth: bool = False,
) -> DataFrame:
    """(term, df, idf) over a collection of documents.

    ``df`` is the number of documents holding the term; N is the number of distinct
    documents in ``docs`` (documents without any term count too).
    ``idf = ln(N/df)``; ``smooth=True`` gives ``ln((1+N)/(1+df)) + 1``.
    N enters the plan as a scalar subquery, not through a driver round trip.
    """
    return idf_from_tf(tf(terms(docs, text, keys=doc), keys=doc), docs, doc, smooth)


def idf_of_lines(lines: DataFrame, files: DataFrame, text: str = "text", doc: str = "doc", smooth: bool = False) -> DataFrame:
    """``idf`` where a document's text is many rows (its lines) of ``lines``; ``files`` has a row per document.

    A document is never put together: its terms are counted across its rows by one (document, term) aggregate.
    """
    return idf_from_tf(tf(terms(lines, text, keys=doc), keys=doc), files, doc, smooth)


def idf_from_tf(
    tf_rows: DataFrame,
    docs: DataFrame,
    doc: str = "doc_id",
    smooth: bool = False,
) -> DataFrame:
    """``idf`` from (doc, term, tf) rows: each row is one distinct (doc, term) pair.

    Sharing the TF rows with ``tfidf`` lets Spark reuse their shuffle, so the texts
    are tokenised once.
    """
    n_docs = docs.select(F.count_distinct(doc)).scalar()
    # count_if(tf > 0) equals count(*) here but reads ``tf``, so the optimizer keeps the
    # TF aggregate identical to the one feeding ``tfidf`` and Spark reuses its shuffle
    # instead of tokenising the texts a second time
    freq = tf_rows.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    n = n_docs.cast("double")
    dfc = F.col("df").cast("double")
    score = F.ln((n + 1) / (dfc + 1)) + 1 if smooth else F.ln(n / dfc)
    return freq.select("term", "df", score.alias("idf"))


def tfidf(tf_rows: DataFrame, idf_rows: DataFrame, keys: str | Sequence[str] | None = "doc_id") -> DataFrame:
    """(keys..., term, val) with val = tf * idf (inner join on term).

    The IDF table has one row per term.  Catalyst/AQE broadcast it when the runtime
    size allows; otherwise it is a sort-merge join whose hot-term partitions AQE splits.
    """
    ks = _keys(keys)
    # AQE splits a join's partitions only if both sides come from a shuffle of their own.  The IDF aggregate is
    # already partitioned by term; under a key that is an expression it is shuffled once more, a row per term.
    side = idf_rows.select(F.concat("term", F.lit("")).alias("_term"), "idf")
    return tf_rows.join(side, F.col("term") == F.col("_term")).select(*ks, "term", (F.col("tf") * F.col("idf")).alias("val"))


def top_terms(pairs: DataFrame, k: int = 20, value: str = "val", term: str = "term") -> DataFrame:
    """The k pairs with the largest value (ties by term); planned as TakeOrderedAndProject."""
    return pairs.orderBy(F.desc(value), F.asc(term)).limit(k)


def _norm(rows: DataFrame, value: str) -> Column:
    return rows.select(F.sqrt(F.sum(F.col(value) * F.col(value)))).scalar()


def cosine(a: DataFrame, b: DataFrame, term: str = "term", value: str = "val") -> DataFrame:
    """One row (dot, norm_a, norm_b, sim): cosine similarity of two (term, val) score sets."""
    left = a.select(F.col(term).alias("_t"), F.col(value).alias("_a"))
    right = b.select(F.col(term).alias("_t"), F.col(value).alias("_b"))
    dot = left.join(right, "_t").agg(F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0.0)).alias("dot"))
    na, nb = _norm(a, value), _norm(b, value)
    return dot.select(
        "dot",
        na.alias("norm_a"),
        nb.alias("norm_b"),
        (F.col("dot") / F.nullif(na * nb, F.lit(0.0))).alias("sim"),
    )


def cosine_to(
    scores: DataFrame,
    target,
    doc: str = "doc_id",
    term: str = "term",
    value: str = "val",
    target_max_terms: int | None = None,
    docs: DataFrame | None = None,
) -> DataFrame:
    """(doc, dot, sim): cosine of every other document's score vector to ``target``'s.

    One-to-many, never all pairs.  The scores are materialised once; then every row is left-joined with
    the target's vector on the term and ONE aggregate by document yields each
    document's squared norm and its dot product with the target (the target's own
    row gives the target norm).  The target's terms are counted, unless the caller knows a
    bound (``target_max_terms``): under the threshold the target is broadcast, so the
    scores are not shuffled by term (else a shuffle join with hot-term splitting).  Documents sharing no term get sim 0; a
    zero norm gives NULL.  With ``docs``, which has every document's key, those without any term
    are in the result too: dot 0, sim NULL.
    """
    # the scores feed three branches (target vector, per-document sums, target norm):
    # write them once to the checkpoint folder instead of recomputing them per branch
    scores = cut_lineage(scores.select(doc, term, value))
    tgt = scores.where(F.col(doc) == F.lit(target)).select(F.col(term).alias("_t"), F.col(value).alias("_b"))
    if target_max_terms is not None:
        tgt = sized_broadcast(tgt, row_bytes=64, rows=target_max_terms)
    else:
        tgt = cut_lineage(tgt)
        seen = tgt.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("_t")).alias("longest")).first()
        tgt = sized_broadcast(tgt, row_bytes=64 + (seen["longest"] or 0), rows=seen["n"])
    rows = scores.select(doc, F.col(term).alias("_t"), F.col(value).alias("_a"))
    per_doc = (
        rows.join(tgt, "_t", "left")
        .groupBy(doc)
        .agg(
            F.sqrt(F.sum(F.col("_a") * F.col("_a"))).alias("_na"),
            F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0.0)).alias("dot"),
        )
    )
    t_norm = per_doc.where(F.col(doc) == F.lit(target)).select(F.max("_na")).scalar()
    if docs is not None:
        every = docs.select(doc).distinct().join(per_doc, doc, "left")
        per_doc = every.withColumn("dot", F.coalesce("dot", F.lit(0.0)))
    others = per_doc.where(F.col(doc) != F.lit(target))
    return others.select(doc, "dot", (F.col("dot") / F.nullif(F.col("_na") * t_norm, F.lit(0.0))).alias("sim"))
