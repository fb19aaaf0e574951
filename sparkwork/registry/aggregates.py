"""Registered aggregate, sampling, fold and metric queries with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import folds as FO
from ..operators import metrics as M
from ..session import cut_lineage
from ..sources import fixtures as X
from ..sources.tables import read_table

R6 = 6


def _r(c, name=None):
    return F.round(c, R6).alias(name or c)


def q_agg_count(spark, sf):
    return A.count_rows(X.numbers(spark, sf))


def q_agg_avg(spark, sf):
    return A.average(X.numbers(spark, sf), "value").select(
        "n", _r("total"), _r("mean"), _r("mean_sum_count")
    )


def q_agg_avg_by_type(spark, sf):
    ev = read_table(spark, sf, "events").select("event_type", "value")
    return A.average(ev, "value", by="event_type").select(
        "event_type", "n", _r("total"), _r("mean"), _r("mean_sum_count")
    )


def q_distinct_users(spark, sf):
    return A.distinct_keys(X.ratings(spark, sf), "i")


def q_distinct_items(spark, sf):
    return A.distinct_keys(X.ratings(spark, sf), "j")


def q_rating_stats(spark, sf):
    return A.key_stats(X.ratings(spark, sf), ["i", "j"])


def q_feature_vocab(spark, sf):
    return A.distinct_keys(X.features_sparse(spark, sf), "feature")


def q_topk_values(spark, sf):
    return A.top_k(X.numbers(spark, sf), "value", 13, ties=["event_id"])


def q_topk_two_phase(spark, sf):
    """The same by a caller's own aggregate: bounded lists of the 13 largest, folded per partition and merged in a tree."""

    def largest(rows):
        return sorted(rows, key=lambda r: (-r[1], r[0]))[:13]

    def fold(state, batch):
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        return largest([*state, *((i, v) for i, v in rows if v is not None)])

    return A.two_phase_aggregate(
        X.numbers(spark, sf).select("event_id", "value"), list, fold, lambda a, b: largest(a + b), lambda state: state,
        "event_id long, value double",
    )


def q_topk_per_type(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "value")
    return A.top_k(ev, "value", 3, by="event_type", ties=["event_id"])


def q_hash_sample(spark, sf):
    return A.hash_sample(X.numbers(spark, sf), "event_id", 0.5, 42)


def q_balanced_sample(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return A.balanced_sample(labels, "quality", "doc_id", 42)


def q_binary_metrics(spark, sf):
    dense = X.features_dense(spark, sf)
    return M.binary_metrics(dense, F.get("x", 0), "y").select(
        "tp", "fp", "tn", "fn", _r("acc"), _r("pre"), _r("rec")
    )


def q_fold_assign(spark, sf):
    return X.ratings_folds(spark, sf).select("i", "j", "fold")


def q_fold_split_counts(spark, sf):
    return FO.fold_split_counts(X.ratings_folds(spark, sf), 5)


def q_train_union(spark, sf):
    rf = cut_lineage(X.ratings_folds(spark, sf))  # joined and averaged once, not once per fold
    parts = [rf.where(F.col("fold") == k).select("i", "j", "r") for k in range(1, 5)]
    return FO.train_union(parts).select("i", "j", _r("r"))


QUERIES = {
    "agg_count": q_agg_count,
    "agg_avg": q_agg_avg,
    "agg_avg_by_type": q_agg_avg_by_type,
    "distinct_users": q_distinct_users,
    "distinct_items": q_distinct_items,
    "rating_stats": q_rating_stats,
    "feature_vocab": q_feature_vocab,
    "topk_values": q_topk_values,
    "topk_two_phase": q_topk_two_phase,
    "topk_per_type": q_topk_per_type,
    "hash_sample": q_hash_sample,
    "balanced_sample": q_balanced_sample,
    "binary_metrics": q_binary_metrics,
    "fold_assign": q_fold_assign,
    "fold_split_counts": q_fold_split_counts,
    "train_union": q_train_union,
}

# Shared derived tables as DuckDB SQL (see FIXTURES.md).
RATINGS = (
    "select o_custkey as i, l_partkey as j, avg(l_quantity) / 10 as r "
    "from lineitem join orders on l_orderkey = o_orderkey group by o_custkey, l_partkey "
    "having o_custkey is not null and l_partkey is not null and avg(l_quantity) is not null"
)
FOLDS = (
    f"select i, j, r, (('0x' || substr(md5(concat_ws(':', '42', i, j)), 1, 8))::bigint % 5)::integer as fold "
    f"from ({RATINGS})"
)


def terms_sql():
    from .text import _TERMS

    return _TERMS


FEATURES_SPARSE = (
    "select t.doc_id as id, t.term as feature, count(*)::double / any_value(n.n) as value, "
    "any_value(2.0 * l.quality - 1)::double as y "
    "from ({terms}) t join labels l on l.doc_id = t.doc_id "
    "join (select doc_id, count(*) as n from ({terms}) group by doc_id) n on n.doc_id = t.doc_id "
    "group by t.doc_id, t.term"
)


def features_sparse_sql():
    return FEATURES_SPARSE.format(terms=terms_sql())


DENSE = (
    "select vec_id as id, (case when label < 5 then 1.0 else -1.0 end)::double as y, "
    "embedding::double[] as x, label from embeddings"
)
HASH_UNIT = "('0x' || substr(md5(concat_ws(':', '{seed}', {key})), 1, 8))::bigint / 4294967296.0"
ORDER_KEY = "('0x' || substr(md5(concat_ws(':', '{seed}', {key})), 1, 15))::bigint"

ORACLE = {
    "agg_count": "select count(*) as n from events",
    "agg_avg": (
        "select count(value) as n, round(sum(value), 6) as total, round(avg(value), 6) as mean, "
        "round(sum(value) / nullif(count(value), 0), 6) as mean_sum_count from events"
    ),
    "agg_avg_by_type": (
        "select event_type, count(value) as n, round(sum(value), 6) as total, round(avg(value), 6) as mean, "
        "round(sum(value) / nullif(count(value), 0), 6) as mean_sum_count from events group by event_type"
    ),
    "distinct_users": f"select distinct i from ({RATINGS})",
    "distinct_items": f"select distinct j from ({RATINGS})",
    "rating_stats": f"select count(*) as n, count(distinct i) as n_i, count(distinct j) as n_j from ({RATINGS})",
    "feature_vocab": f"select distinct feature from ({features_sparse_sql()})",
    "topk_values": "select event_id, value from events order by value desc, event_id limit 13",
    "topk_two_phase": "select event_id, value from events order by value desc, event_id limit 13",
    "topk_per_type": (
        "select * from (select event_id, event_type, value, cast(row_number() over "
        "(partition by event_type order by value desc, event_id) as integer) as rank from events) where rank <= 3"
    ),
    "hash_sample": f"select event_id, value from events where {HASH_UNIT.format(seed='42', key='event_id')} < 0.5",
    "balanced_sample": f"""
        with h as (select doc_id, quality, toxic, {ORDER_KEY.format(seed='42', key='doc_id')} as h from labels),
        r as (select *, row_number() over (partition by quality order by h, doc_id) as rn from h)
        select doc_id, quality, toxic from r
        where rn <= (select min(n) from (select count(*) as n from labels group by quality))""",
    "binary_metrics": f"""
        with s as (select x[1] as score, y from ({DENSE})),
        c as (select count(*) filter (where score > 0 and y > 0) as tp,
                     count(*) filter (where score > 0 and y <= 0) as fp,
                     count(*) filter (where score <= 0 and y <= 0) as tn,
                     count(*) filter (where score <= 0 and y > 0) as fn from s)
        select tp, fp, tn, fn, round((tp + tn)::double / nullif(tp + fp + tn + fn, 0), 6) as acc,
               round(tp::double / nullif(tp + fp, 0), 6) as pre, round(tp::double / nullif(tp + fn, 0), 6) as rec
        from c""",
    "fold_assign": f"select i, j, fold from ({FOLDS})",
    "fold_split_counts": (
        f"select fold, (select count(*) from ({FOLDS})) - count(*) as n_train, count(*) as n_test "
        f"from ({FOLDS}) group by fold"
    ),
    "train_union": f"select i, j, round(r, 6) as r from ({FOLDS}) where fold <> 0",
}
