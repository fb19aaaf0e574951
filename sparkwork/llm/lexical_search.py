"""Ranked lexical search: the best documents of every item, by an exact dual-tree search.

A score is a sum over terms of an item's weight times a document's impact, an inner product of two sparse vectors
without negative entries.  Both sides are put into trees whose nodes hold the maximum of each coordinate among their
members, so the inner product of two nodes bounds every score between their members.  A pair of nodes whose bound is
below the weakest k-th best score of the node's items is dropped with all of its members; nothing else is dropped.

Pass 1 reads the texts once and keeps, for each document, its length and the counts of the items' terms.  Pass 2 takes
from these the number of documents, their mean length and document frequencies.  Pass 3 finds for each term the k-th best
impact within some task, which bounds every item's k-th best score from below before any score is known.  The
documents are then put in order of the term they weigh most, so that a tree's nodes hold similar ones, and
pass 4 searches: each task builds trees over its documents, batch by batch, and its first k per item meet in one ranking.

Items are taken in blocks of bounded size, chosen by hash; each block is searched against all documents.
"""

from __future__ import annotations

import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import read_table
from .common import stored, words_of, worker_cache_of

BEST = 20
BLOCK_TERMS = 16_384  # terms, with repeats, that the items of a block have about; a longer item is a block of its own
BLOCK_ITEMS = 512  # items of a block, about
FANOUT = 4  # children of a node
LEAF = 4  # documents of a leaf; an item is a leaf by itself
CHUNK = 1024  # pairs of leaves scored before the others are held against the new weakest scores
BATCH = 4096  # documents of one tree ...
CELLS = 1 << 23  # ... or fewer: as many as fill so many numbers over the block's terms
POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"
FOUND = "item int, doc_id long, score long"


NO_TERM = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # what stands between terms


def terms_of(text: str) -> Column:
    """The terms of a text column between single spaces."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, NO_TERM, " "))


def keyed_items(items: DataFrame) -> DataFrame:
    """(item_id, text_key, text): the items that have a term, their terms between single spaces and a key of these."""
    rows = items.select("item_id", terms_of("text").alias("text")).filter("text != ''")
    return rows.select("item_id", F.sha2("text", 256).alias("text_key"), "text").dropDuplicates(["item_id", "text_key"])


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: all its terms counted, those of the vocabulary listed."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a block's terms

    def run(batches):
        worker_cache_of("terms")
        get = held.value.get
        for batch in batches:
            ids, n, ends, terms, tfs = [], [], [0], [], []
            for i, t in enumerate(batch.column(1).cast(pa.binary())):
                words = words_of(t.as_py() or b"")
                if not words:
                    continue
                known = np.array([w for w in map(get, words) if w is not None], dtype=np.int32)
                at, count = np.unique(known, return_counts=True)
                ids.append(i)
                n.append(len(words))
                terms.append(at.astype(np.int32))
                tfs.append(count.astype(np.int64))
                ends.append(ends[-1] + len(at))
            offsets = pa.array(ends, pa.int32())
            flat = [np.concatenate(x) if x else np.zeros(0, k) for x, k in ((terms, np.int32), (tfs, np.int64))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()).take(pa.array(ids, pa.int64())),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat[0], pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(flat[1], pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, POSTINGS)


def statistics(index: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, document frequency of each term of the vocabulary)."""
    sums = index.agg(F.count("*").alias("docs"), F.sum(F.col("n").cast("decimal(38,0)")).alias("length")).first()
    df = np.zeros(terms, dtype=np.int64)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[r["t"]] = r["df"]  # the block's terms
    return sums["docs"], int(sums["length"] or 0), df


def with_impacts(index: DataFrame, n_docs: int, length: int) -> DataFrame:
    """(doc_id, terms, impacts): the integer impact of each listed term of each document that has any."""
    m = F.expr(f"75 + cast((cast(n as decimal(20,0)) * {25 * n_docs}BD) div {max(length, 1)}BD as bigint)")
    rows = index.filter(F.size("terms") > 0).withColumn("m", m)
    return rows.select("doc_id", "terms", F.expr("transform(tfs, t -> (1000000000L * t) div (1000L * t + 12L * m))").alias("impacts"))


class Tree:
    """Coordinate maxima of the rows of a matrix: ``levels[0]`` are leaves of ``leaf`` rows, the last is the root."""

    def __init__(self, rows: np.ndarray, leaf: int):
        self.size, self.levels, width, top = len(rows), [], leaf, rows
        while not self.levels or len(top) > 1:
            top = np.maximum.reduceat(top, np.arange(0, len(top), width), axis=0)
            self.levels.append(top)
            width = FANOUT


def dense(starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """A matrix of the sparse rows [starts[i], starts[i + 1]); whole numbers in doubles."""
    out = np.zeros((len(starts) - 1, width))
    out[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), columns] = values
    return out


class Search:
    """The items of a block, in a tree, with their best scores so far; documents are searched batch by batch.

    ``weights`` has for each item (a distinct text) its terms, ascending, and their weights; ``floor`` are lower
    bounds of the items' ``best``-th scores.  Bounds are sums of doubles: a slack above their rounding error keeps
    every dropped pair below the weakest score for certain.  Scores are exact integers.
    """

    SLACK = 1 + 1e-9

    def __init__(self, weights: list[tuple[np.ndarray, np.ndarray]], terms: int, floor: np.ndarray, best: int):
        self.best, self.terms = best, terms
        # similar items next to each other: by their heaviest term
        self.order = np.array(sorted(range(len(weights)), key=lambda i: (int(weights[i][0][weights[i][1].argmax()]), i)), dtype=np.int64)
        self.weights = [(weights[i][0], weights[i][1].astype(np.int64)) for i in self.order]
        starts = np.cumsum([0] + [len(t) for t, _ in self.weights])
        columns, values = (np.concatenate([w[k] for w in self.weights]) for k in (0, 1))
        self.tree = Tree(dense(starts, columns, values, terms), 1)
        self.floor = floor[self.order].astype(np.int64)  # in the tree's order
        self.scores = np.zeros((len(self.order), best), dtype=np.int64)  # 0: none
        self.ids = np.zeros((len(self.order), best), dtype=np.int64)
        self.blank = np.ones((len(self.order), best), dtype=bool)  # a null document id
        self.scored = self.pairs = 0  # pairs of leaves

    def weakest(self) -> np.ndarray:
        """A score that an item's documents must reach."""
        return np.maximum(np.maximum(self.floor, self.scores[:, -1]), 1)

    def batch(self, ids: np.ndarray, blank: np.ndarray, starts: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> None:
        """Search a batch of documents; ``blank`` marks null ids."""
        docs = dense(starts, columns, impacts, self.terms)
        tree = Tree(docs, LEAF)
        # pairs of nodes, from the two roots down; the higher one is opened
        i, d = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        up, down = len(self.tree.levels) - 1, len(tree.levels) - 1
        while True:
            weak = self._weak_of(up)
            bound = self._bounds(self.tree.levels[up], tree.levels[down], i, d) * self.SLACK
            keep = bound >= weak[i]
            i, d, bound = i[keep], d[keep], bound[keep]
            if not len(i) or up == down == 0:
                break
            if down >= up:
                i, d = self._open(i, d, len(tree.levels[down - 1]))
                down -= 1
            else:
                d, i = self._open(d, i, len(self.tree.levels[up - 1]))
                up -= 1
        self.pairs += len(self.order) * len(tree.levels[0])
        # the most promising pairs first: they raise the weakest scores that the others are held against
        order = np.argsort(-bound / self.weakest()[i], kind="stable")
        i, d, bound = i[order], d[order], bound[order]
        while len(i):
            for item, leaf in zip(i[:CHUNK].tolist(), d[:CHUNK].tolist(), strict=True):
                x, y = leaf * LEAF, min((leaf + 1) * LEAF, tree.size)
                terms, weights = self.weights[item]
                self._take(item, docs[x:y, terms].astype(np.int64) @ weights, ids[x:y], blank[x:y])
            self.scored += min(len(i), CHUNK)
            i, d, bound = i[CHUNK:], d[CHUNK:], bound[CHUNK:]
            keep = bound >= self.weakest()[i]
            i, d, bound = i[keep], d[keep], bound[keep]

    def _weak_of(self, level: int) -> np.ndarray:
        """The weakest k-th score of each item node."""
        weak = self.weakest()
        for _ in range(level):
            weak = np.minimum.reduceat(weak, np.arange(0, len(weak), FANOUT))
        return weak

    @staticmethod
    def _bounds(items: np.ndarray, docs: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        rows, at = np.unique(i, return_inverse=True)
        columns, to = np.unique(d, return_inverse=True)
        return (items[rows] @ docs[columns].T)[at, to]

    @staticmethod
    def _open(fixed: np.ndarray, opened: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Each pair with the children, of ``n`` nodes below, of its second node."""
        children = opened[:, None] * FANOUT + np.arange(FANOUT)
        inside = children < n
        return np.repeat(fixed, inside.sum(axis=1)), children[inside]

    def _take(self, item: int, scores: np.ndarray, ids: np.ndarray, blank: np.ndarray) -> None:
        """Put scores among an item's best; equal scores by ascending id, null ids last."""
        new = np.flatnonzero(scores >= max(self.floor[item], self.scores[item, -1], 1))
        if len(new):
            s = np.concatenate([self.scores[item], scores[new]])
            k, no = np.concatenate([self.ids[item], ids[new]]), np.concatenate([self.blank[item], blank[new]])
            top = np.lexsort((k, no, -s))[: self.best]
            self.scores[item], self.ids[item], self.blank[item] = s[top], k[top], no[top]

    def found(self) -> pa.RecordBatch:
        item, at = np.nonzero(self.scores > 0)
        ids = pa.array(self.ids[item, at], pa.int64(), mask=self.blank[item, at])
        return pa.RecordBatch.from_arrays(
            [pa.array(self.order[item].astype(np.int32)), ids, pa.array(self.scores[item, at])], ["item", "doc_id", "score"]
        )


def floors(impacts: DataFrame, weights: list[tuple[np.ndarray, np.ndarray]], terms: int, best: int) -> np.ndarray:
    """For each item a lower bound of its ``best``-th score: its best single term in the documents of some task."""

    def run(batches):
        top = np.zeros((0, 2), dtype=np.int64)  # (term, impact), the ``best`` largest of each term
        for batch in batches:
            t, v = (batch.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            top = np.concatenate([top, np.stack([t, v], axis=1)])
            order = np.lexsort((-top[:, 1], top[:, 0]))
            top = top[order]
            first = np.searchsorted(top[:, 0], top[:, 0])
            top = top[np.arange(len(top)) - first < best]
        first = np.searchsorted(top[:, 0], top[:, 0])
        weakest = top[np.arange(len(top)) - first == best - 1]
        yield pa.RecordBatch.from_arrays([pa.array(weakest[:, 0]), pa.array(weakest[:, 1])], ["term", "impact"])

    rows = impacts.select("terms", "impacts").mapInArrow(run, "term long, impact long")
    least = np.zeros(terms, dtype=np.int64)
    for r in rows.groupBy("term").agg(F.max("impact").alias("impact")).collect():  # the block's terms
        least[r["term"]] = r["impact"]
    return np.array([int((w * least[t]).max()) for t, w in weights], dtype=np.int64)


def search_block(docs: DataFrame, texts: list[str], best: int) -> DataFrame:
    """(item, doc_id, score): for each of a block's texts (normalised terms between single spaces) its first documents."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    counted = []
    for text in texts:
        at, n = np.unique([vocabulary.setdefault(w, len(vocabulary)) for w in text.encode().split(b" ")], return_counts=True)
        counted.append((at, n))
    index = stored(postings(docs, vocabulary), "postings")
    n_docs, length, df = statistics(index, len(vocabulary))
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    weights = [(t, n * weight[t]) for t, n in counted]
    impacts = with_impacts(index, n_docs, length)
    # similar documents next to each other: by the term they weigh most; a common term's documents are split by id
    heavy = spark.sparkContext.broadcast(weight)

    def keyed(batches):
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            t = batch.column(1).values.to_numpy(zero_copy_only=False)
            v = batch.column(2).values.to_numpy(zero_copy_only=False) * heavy.value[t]
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            order = np.lexsort((-v, row))
            main = t[order][ends[:-1]] if len(t) else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(main, pa.int32()), *batch.columns], ["main", "doc_id", "terms", "impacts"])

    near = impacts.mapInArrow(keyed, "main int, doc_id long, terms array<int>, impacts array<long>")
    tie = F.xxhash64("doc_id", "terms", "impacts")
    near = near.repartitionByRange("main", tie).sortWithinPartitions("main", tie).select("doc_id", "terms", "impacts")
    near = stored(near, "similar-documents")
    held = spark.sparkContext.broadcast((weights, floors(near.select("terms", "impacts"), weights, len(vocabulary), best)))
    n_terms, own = len(vocabulary), uuid.uuid4().hex

    def run(batches):
        cache = worker_cache_of("search")
        weights, floor = held.value
        # scores that earlier tasks of this worker reached: their documents are among all, so they are lower bounds too
        reached = cache.get(own, floor)
        search = Search(weights, n_terms, np.maximum(floor, reached), best)
        rows = max(LEAF, min(BATCH, CELLS // n_terms))
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                part = batch.slice(a, rows)
                ids = part.column(0)
                ends = part.column(1).offsets.to_numpy()
                t, v = (part.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2))
                blank = ids.is_null().to_numpy(zero_copy_only=False)
                search.batch(ids.fill_null(0).to_numpy(), blank, ends - ends[0], t, v)
        reached = reached.copy()
        reached[search.order] = np.maximum(reached[search.order], search.scores[:, -1])
        cache[own] = reached
        yield search.found()

    return near.mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its ``best`` documents with a score above 0.

    The score is that of the module's contract (``op11_lexical_search``); equal scores stand by ascending doc_id, a null
    doc_id after all others.  Every row of ``docs`` is a document, repeated ones too; null texts and texts without a
    term are none.  Rows of ``items`` equal in item_id and terms are one item; null item_ids are items; items
    without a term have no rows, nor has an empty table.  Columns but doc_id, item_id and text are not read.
    """
    spark = docs.sparkSession
    asked = stored(keyed_items(items), "items")
    texts = asked.groupBy("text_key").agg(F.first("text").alias("text")).withColumn("n", F.size(F.split("text", " ")).cast("long"))
    texts = stored(texts, "item-texts")
    sizes = texts.agg(F.count("*").alias("items"), F.sum("n").alias("n")).first()
    n_blocks = max(-(-(sizes["n"] or 0) // block_terms), -(-sizes["items"] // BLOCK_ITEMS))
    usual = texts.filter(F.col("n") <= block_terms)
    blocks = chain(
        (usual.filter(F.pmod(F.xxhash64("text_key"), F.lit(n_blocks)) == b).collect() for b in range(n_blocks)),
        ([r] for r in texts.filter(F.col("n") > block_terms).toLocalIterator()),
    )
    found = None
    for block in blocks:  # the driver holds one block of items at a time
        if not block:
            continue
        block = sorted((r["text_key"], r["text"]) for r in block)
        keys = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(block)], "item int, text_key string")
        best_of = search_block(docs, [t for _, t in block], best)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best_of.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        part = stored(ranked.join(F.broadcast(keys), "item").select("text_key", "rank", "doc_id", "score"), "ranked")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return asked.join(found, "text_key").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op11_lexical_search": op11_lexical_search}

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = {
    "op11_lexical_search": rf"""
with d as (
    select row_number() over () as row_id, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') as terms
    from documents where text is not null
), n as (
    select row_id, doc_id, cast(len(terms) as bigint) as n from d where len(terms) > 0
), g as (
    select count(*) as docs, cast(sum(n) as bigint) as length from n
), m as (
    select row_id, doc_id, 75 + (25 * n * docs) // length as m from n, g
), tf as (
    select row_id, term, count(*) as tf from (select row_id, unnest(terms) as term from d) group by row_id, term
), w as (
    select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w from tf, g group by term, docs
), i as (
    select item_id, term, count(*) as c from (
        select item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as term from benchmark where text is not null
    ) group by item_id, term
), s as (
    select item_id, m.doc_id, tf.row_id, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
    from i join w using (term) join tf using (term) join m on m.row_id = tf.row_id group by item_id, m.doc_id, tf.row_id
)
select item_id, cast(rank as integer) as rank, doc_id, score from (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0
) where rank <= {BEST}
"""
}
