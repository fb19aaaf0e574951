"""Histogram trees, grown level by level for all trees of a forest at once.

Features become bins of equal width between their smallest and largest value.  A row carries its bins and, for each
tree, its bootstrap weight (a Poisson(1) number from a hash of seed, tree and row id) and the node it stands in.  A
level is one aggregate: the weights by (tree, node, feature, bin, label), of the features that a hash draws for the node,
with partial sums before the shuffle.  Split search is a cumulative sum over at most ``bins`` rows per feature and one
maximum per node; the splits, a bounded table, go to the rows as one scalar row.  No group of rows is ever collected.

Nodes are numbered as in a heap: the root is 1, the children of n are 2n and 2n + 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..operators.vectors import _list
from ..session import check_model_size, cut_lineage

#: cumulative probabilities of the Poisson distribution of mean 1
POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(6)]


@dataclass(frozen=True)
class ForestParams:
    trees: int = 20
    depth: int = 5
    bins: int = 16
    share: float | None = None  # of the features, drawn for each node; None: the root of their number
    seed: int = 7


def bootstrap_weight(seed: int, tree: Column, row: Column) -> Column:
    """How often a row is drawn for a tree."""
    u = H.unit(F.lit(str(seed)), F.lit("row"), tree, row)
    out = F.lit(len(POISSON))
    for k in reversed(range(len(POISSON))):
        out = F.when(u < F.lit(POISSON[k]), F.lit(k)).otherwise(out)
    return out


def bin_edges(df: DataFrame, x: str) -> DataFrame:
    """(k, low, high) of every feature."""
    return df.select(F.posexplode(x).alias("k", "v")).groupBy("k").agg(F.min("v").alias("low"), F.max("v").alias("high"))


def _edges(edges: DataFrame) -> Column:
    """The edges as one array in feature order (a scalar subquery: two numbers per feature)."""
    return edges.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "low", "high"))), lambda e: F.struct(e["low"].alias("low"), e["high"].alias("high")))).scalar()


def binned(df: DataFrame, x: str, edges: DataFrame, bins: int) -> DataFrame:
    """``df`` with ``bins``: the bin of each feature; values outside the edges are in the outer bins."""

    def one(v: Column, k: Column) -> Column:
        low, high = F.get("_edges", k)["low"], F.get("_edges", k)["high"]
        at = F.floor((v - low) / F.nullif(high - low, F.lit(0.0)) * F.lit(float(bins)))
        return F.coalesce(F.greatest(F.lit(0), F.least(at, F.lit(bins - 1))), F.lit(0)).cast("int")

    return df.withColumn("_edges", _edges(edges)).withColumn("bins", F.transform(x, one)).drop("_edges")


def drawn_features(spark, level: int, d: int, p: ForestParams) -> DataFrame:
    """(tree, node, features) of a level: those whose hash lies below the share; every node of the level has a row."""
    share = p.share if p.share is not None else 1 / math.sqrt(d)
    nodes = spark.range(p.trees << level).select(
        (F.col("id") / (1 << level)).cast("int").alias("tree"), (F.col("id") % (1 << level) + (1 << level)).cast("int").alias("node")
    )
    hashed = lambda k: H.unit(F.lit(str(p.seed)), F.lit("feature"), F.col("tree"), F.col("node"), k) < F.lit(share)
    return nodes.select("tree", "node", F.filter(F.sequence(F.lit(0), F.lit(d - 1)), hashed).alias("features"))


def _by_node(table: DataFrame, value: Column, level: int, p: ForestParams) -> Column:
    """A table of (tree, node, ...) as one array over the level's nodes of all trees; null where a node has no row."""
    at = (F.col("tree") * (1 << level) + F.col("node") - (1 << level)).alias("at")
    pairs = table.select(at, value.alias("value"))
    whole = table.sparkSession.range(p.trees << level).join(pairs, F.col("id") == F.col("at"), "left")
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "value"))), lambda e: e["value"])).scalar()


def level_counts(rows: DataFrame, level: int, d: int, p: ForestParams) -> DataFrame:
    """(tree, node, feature, bin, label, n): the weights of a level's nodes, from one aggregate over the rows."""
    start = 1 << level
    features = _by_node(drawn_features(rows.sparkSession, level, d, p), F.col("features"), level, p)
    at = rows.withColumn("_features", features).select(
        "label", "bins", "_features", F.posexplode(F.arrays_zip("nodes", "weights")).alias("tree", "e")
    )
    at = at.where((F.col("e.weights") > 0) & (F.col("e.nodes") >= start))
    mine = F.get("_features", F.col("tree") * start + F.col("e.nodes") - start)
    cells = at.select(
        "label", "tree", F.col("e.nodes").alias("node"), F.col("e.weights").alias("w"),
        F.inline(F.transform(mine, lambda k: F.struct(k.alias("feature"), F.get("bins", k).alias("bin")))),
    )
    return cells.groupBy("tree", "node", "feature", "bin", "label").agg(F.sum("w").alias("n"))


def level_splits(rows: DataFrame, level: int, d: int, p: ForestParams) -> DataFrame:
    """(tree, node, feature, bin, score): the best split of each node; nodes that no split improves are absent.

    Rows with a bin of the split or below go left.  The score is the sum over both sides of sum(count^2)/sum(count) over
    the labels, which is largest where the Gini impurity is least; ties go to the first feature and bin.
    """
    # written: what follows reads this table of bounded size three times, and the rows once
    counts = cut_lineage(level_counts(rows, level, d, p))
    # over at most bins x labels rows of a node's feature
    feature = Window.partitionBy("tree", "node", "feature", "label")
    every = _grid(counts)
    upto = every.withColumn("left", F.sum("n").over(feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    upto = upto.withColumn("all", F.sum("n").over(feature))
    sides = upto.groupBy("tree", "node", "feature", "bin").agg(
        F.sum("left").alias("nl"), F.sum("all").alias("na"),
        F.sum(F.col("left") * F.col("left")).alias("sl"),
        F.sum((F.col("all") - F.col("left")) * (F.col("all") - F.col("left"))).alias("sr"),
        F.sum(F.col("all") * F.col("all")).alias("sa"),
    )
    sides = sides.where((F.col("nl") > 0) & (F.col("nl") < F.col("na")))
    score = F.col("sl").cast("double") / F.col("nl") + F.col("sr").cast("double") / (F.col("na") - F.col("nl"))
    scored = sides.withColumn("score", score).where(F.col("score") > F.col("sa").cast("double") / F.col("na") + F.lit(1e-9))
    best = F.max_by(F.struct("feature", "bin", "score"), F.struct("score", -F.col("feature"), -F.col("bin"))).alias("best")
    return scored.groupBy("tree", "node").agg(best).select("tree", "node", "best.*")


def _grid(counts: DataFrame) -> DataFrame:
    """``counts`` with a zero row for every bin of a node's feature and every label of the node that it lacks."""
    bins = counts.select("tree", "node", "feature", "bin").distinct()
    labels = counts.select("tree", "node", "feature", "label").distinct()
    whole = bins.join(labels, ["tree", "node", "feature"])
    return whole.join(counts, ["tree", "node", "feature", "bin", "label"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def descended(rows: DataFrame, splits: DataFrame, level: int, p: ForestParams) -> DataFrame:
    """``rows`` with their nodes after the splits of a level; rows of nodes without a split stay."""
    start = 1 << level
    table = _by_node(splits, F.struct("feature", "bin"), level, p)

    def one(node: Column, tree: Column) -> Column:
        split = F.get("_splits", tree * start + node - start)
        moved = F.when(F.get("bins", split["feature"]) <= split["bin"], node * 2).otherwise(node * 2 + 1)
        return F.when((node >= start) & split.isNotNull(), moved).otherwise(node)

    return rows.withColumn("_splits", table).withColumn("nodes", F.transform("nodes", one)).drop("_splits")


@dataclass
class Forest:
    """``splits`` (tree, node, feature, bin, score) of all levels, ``leaves`` (tree, node, label), ``edges`` of the bins."""

    splits: DataFrame
    leaves: DataFrame
    edges: DataFrame
    params: ForestParams

    def nodes(self, df: DataFrame, x: str) -> DataFrame:
        p = self.params
        rows = binned(df, x, self.edges, p.bins).withColumn("nodes", F.array_repeat(F.lit(1), p.trees))
        for level in range(p.depth):
            rows = descended(rows, self.splits.where((F.col("node") >= 1 << level) & (F.col("node") < 2 << level)), level, p)
        return rows.drop("bins")

    def predict(self, df: DataFrame, x: str = "x") -> DataFrame:
        """``df`` with ``votes`` (a label per tree) and ``pred``: the most frequent one, the least of several."""
        p = self.params
        width = 2 << p.depth
        at = (F.col("tree") * width + F.col("node")).alias("at")
        whole = df.sparkSession.range(p.trees * width).join(self.leaves.select(at, "label"), F.col("id") == F.col("at"), "left")
        table = whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "label"))), lambda e: e["label"])).scalar()
        rows = self.nodes(df, x).withColumn("_leaves", table)
        rows = rows.withColumn("votes", F.transform("nodes", lambda n, t: F.get("_leaves", t * width + n))).drop("_leaves", "nodes")
        counted = F.transform(
            F.array_distinct("votes"), lambda v: F.struct(F.size(F.filter("votes", lambda w: w == v)).alias("n"), (-v).alias("v"))
        )
        return rows.withColumn("pred", -F.array_max(counted)["v"])


def train_forest(df: DataFrame, key: str | list[str], x: str = "x", label: str = "label", params: ForestParams | None = None) -> Forest:
    """Grow a forest on rows of an id (``key``: what the bootstrap hashes), a vector and an integer label.

    Rows with a null label or vector are not learned from.  Without rows the forest has no splits and no leaves, and
    predicts nothing (null).
    """
    p = params or ForestParams()
    spark = df.sparkSession
    rows = df.select(*_list(key), F.col(x).alias("x"), F.col(label).cast("int").alias("label")).dropna(subset=["x", "label"])
    edges = cut_lineage(bin_edges(rows, "x"))
    d = edges.count()
    check_model_size((p.trees << p.depth) * max(2, math.ceil(d * (p.share or 1 / math.sqrt(max(d, 1))))), "a level of the forest")
    weights = F.transform(
        F.sequence(F.lit(0), F.lit(p.trees - 1)), lambda t: bootstrap_weight(p.seed, t, F.concat_ws(":", *[F.col(k).cast("string") for k in _list(key)]))
    )
    rows = binned(rows, "x", edges, p.bins).select(
        "label", "bins", weights.alias("weights"), F.array_repeat(F.lit(1), p.trees).alias("nodes")
    )
    rows, levels = cut_lineage(rows), []
    for level in range(p.depth if d else 0):
        splits = cut_lineage(level_splits(rows, level, d, p))
        levels.append(splits)
        if splits.isEmpty():
            break
        rows = cut_lineage(descended(rows, splits, level, p))
    standing = rows.select("label", F.posexplode(F.arrays_zip("nodes", "weights")).alias("tree", "e")).where("e.weights > 0")
    counts = standing.groupBy("tree", F.col("e.nodes").alias("node"), "label").agg(F.sum("e.weights").alias("n"))
    leaves = counts.groupBy("tree", "node").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("label"))
    schema = "tree int, node int, feature int, bin int, score double"
    splits = spark.createDataFrame([], schema)
    for some in levels:
        splits = splits.unionByName(some)
    return Forest(cut_lineage(splits), cut_lineage(leaves), edges, p)
