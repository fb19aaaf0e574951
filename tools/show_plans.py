"""Print the physical plans (``explain("formatted")``) of the headline operators.

Usage: python tools/show_plans.py [sf_dir] [name ...]
Names: word_count tfidf cosine_one_to_many mf_step mf_block_step many_gradients forest_level logistic_gradient balanced_sample_level
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sparkwork.operators import text as T  # noqa: E402
from sparkwork.plans import blocks, multi, trees  # noqa: E402
from sparkwork.plans import factorise as MF  # noqa: E402
from sparkwork.plans import linear as LN  # noqa: E402
from sparkwork.session import cut_lineage, local_session  # noqa: E402
from sparkwork.sources import fixtures as X  # noqa: E402


def word_count(spark, sf):
    return T.word_count(X.documents(spark, sf))


def tfidf(spark, sf):
    docs = X.documents(spark, sf)
    tf = T.tf(T.terms(docs))
    return T.tfidf(tf, T.idf_from_tf(tf, docs))


def cosine_one_to_many(spark, sf):
    return T.cosine_to(tfidf(spark, sf), 0)


def mf_step(spark, sf):
    # as inside train_mf: ratings and profiles are checkpoints when an iteration is planned
    R = cut_lineage(X.ratings(spark, sf))
    p = MF.MFParams()
    U = cut_lineage(MF.init_profiles(R, "i", p.d, p.seed, "u"))
    V = cut_lineage(MF.init_profiles(R, "j", p.d, p.seed, "v"))
    return MF.joint_step(R, U, V, p, p.gain, U.count(), V.count())


def mf_block_step(spark, sf):
    """The step beyond the broadcast bound."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    R = cut_lineage(X.ratings(spark, sf))
    p = MF.MFParams()
    laid = blocks.lay_out(R, p.d)
    U = cut_lineage(MF.init_profiles(R, "i", p.d, p.seed, "u"))
    V = cut_lineage(MF.init_profiles(R, "j", p.d, p.seed, "v"))
    return blocks.block_step(laid, U, V, p.d, p.gain, p.lam, p.mu, p.weighted)


def many_gradients(spark, sf):
    """The gradients of five regularisation weights in one pass over the features laid out by example."""
    Xp, Ep = LN.prepare_sparse(X.features_sparse(spark, sf).select("id", "feature", "value"), X.examples(spark, sf))
    slots = [multi.Slot(lam) for lam in (0.0, 0.1, 0.2, 0.5, 1.0)]
    EM = cut_lineage(Ep.withColumn("s", F.array_repeat(F.lit(0.0), len(slots))))
    beta = spark.createDataFrame([("the", [0.1] * len(slots))], "feature string, b array<double>")
    return multi.gradients(Xp, EM, beta, slots, "logistic")


def forest_level(spark, sf):
    """The counts of the second level of a forest."""
    rows = X.features_dense(spark, sf).select("id", "x", "label")
    p = trees.ForestParams()
    binned = trees.binned(rows, "x", trees.bin_edges(rows, "x"), p.bins)
    standing = binned.select("label", "bins", F.array_repeat(F.lit(1), p.trees).alias("weights"), F.array_repeat(F.lit(2), p.trees).alias("nodes"))
    return trees.level_counts(cut_lineage(standing), 1, 64, p)


def logistic_gradient(spark, sf):
    Xp, Ep = LN.prepare_sparse(X.features_sparse(spark, sf).select("id", "feature", "value"), X.examples(spark, sf))
    beta = spark.createDataFrame([("the", 0.1)], "feature string, beta double")
    EM = LN.margins(Xp, Ep, beta, 1)
    return LN.gradient(Xp, EM, beta, "logistic", 0.1)


def balanced_sample_level(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return labels.groupBy("quality", F.shiftright(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 15), 16, 10).cast("bigint"), 45).alias("b")).count()


PLANS = {
    "word_count": word_count,
    "mf_block_step": mf_block_step,
    "many_gradients": many_gradients,
    "forest_level": forest_level,
    "tfidf": tfidf,
    "cosine_one_to_many": cosine_one_to_many,
    "mf_step": mf_step,
    "logistic_gradient": logistic_gradient,
    "balanced_sample_level": balanced_sample_level,
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(PLANS)
    spark = local_session(8, 8, app="sparkwork-plans")
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        print(f"===== {name}")
        PLANS[name](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
