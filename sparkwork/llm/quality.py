"""Quality classifier: hashed subword embeddings averaged per document, softmax output, trained by numpy SGD.

Features of a text are its words (between white space, as they stand), its byte n-grams,
and a mark wherever a word follows itself.  Each feature is hashed to a row of the
embedding table; a document is the mean of its features' rows; a softmax layer over it gives the
classes.  For scoring, embeddings and softmax of two classes collapse to one number a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import doc_bucket, span_hashes, worker_cache_of
from .tokens import batches_by_size

BUCKETS = 1 << 16  # rows of the embedding table; the last is the mark of a repeated word
DIMENSIONS = 8
GRAMS = (3, 5)  # bytes
SAMPLE_DOCS = 2500  # labelled documents per class, those of the smallest id hash
PART = 1 << 20  # bytes hashed at once; a longer text is the sum of its parts
EPOCHS, RATE, BATCH = 12, 4.0, 16
MIXER = np.uint64(0x9E3779B97F4A7C15)


def features(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of the texts in UTF-8, in no special order."""
    data = np.frombuffer(b"\n" + b"\n".join(raws) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws])
    owner = np.repeat(np.arange(len(raws)), [len(r) + 1 for r in raws])
    edge = np.diff((data > 32).view(np.int8))
    at, to = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    word, whose = span_hashes(data, at, to), np.searchsorted(ends, at - 1, side="right")
    again = (word[1:] == word[:-1]) & (whose[1:] == whose[:-1])
    texts = [whose, whose[1:][again]]
    buckets = [bucket(word, 0), np.full(int(again.sum()), BUCKETS - 1)]
    wide = data.astype(np.uint64)
    for n in GRAMS:
        if len(data) > n:
            gram = wide[1 : len(data) - n + 1].copy()
            for k in range(1, n):
                gram |= wide[1 + k : len(data) - n + 1 + k] << np.uint64(8 * k)
            first = owner[: len(gram)]
            whole = owner[n - 1 : n - 1 + len(gram)] == first  # of one text, its closing line feed perhaps included
            texts.append(first[whole])
            buckets.append(bucket(gram[whole], n))
    return np.concatenate(texts), np.concatenate(buckets)


def bucket(keys: np.ndarray, kind: int) -> np.ndarray:
    mixed = (keys + np.uint64(kind)) * MIXER
    mixed ^= mixed >> np.uint64(32)
    mixed *= MIXER
    return (mixed >> np.uint64(40)).astype(np.int64) % (BUCKETS - 1)


def train(texts: list[bytes], labels: list[int], prior: float, seed: int = 7) -> tuple[np.ndarray, float]:
    """(score per bucket, bias): the log odds of class 1 are the mean score of a text's features plus the bias.

    ``prior`` is the log odds of class 1 among all rows that may be learned from; the sample's own are replaced by it.
    """
    rng = np.random.default_rng(seed)
    rows = []
    for raw in texts:
        n = sum(np.bincount(features([raw[a : a + PART]])[1], minlength=BUCKETS) for a in range(0, max(len(raw), 1), PART))
        at = np.flatnonzero(n)
        rows.append((at, (n[at] / max(n.sum(), 1)).astype(np.float32)))
    y = np.array(labels, dtype=np.int64)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights, bias = np.zeros((DIMENSIONS, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = EPOCHS * -(-len(rows) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            some = [i for i in order[a : a + BATCH] if len(rows[i][0])]
            rate, done = RATE * (1 - done / steps), done + 1
            if not some:
                continue
            at = np.concatenate([rows[i][0] for i in some])
            share = np.concatenate([rows[i][1] for i in some])[:, None]
            doc = np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some])
            start = np.cumsum([0] + [len(rows[i][0]) for i in some[:-1]])
            mean = np.add.reduceat(table[at] * share, start)
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            back = p @ weights.T
            weights -= rate / len(some) * (mean.T @ p)
            bias -= rate / len(some) * 0.1 * p.sum(axis=0)
            np.subtract.at(table, at, rate * share * back[doc])
    score = (table @ (weights[:, 1] - weights[:, 0])).astype(np.float64)
    n = np.bincount(y, minlength=2) if len(y) else np.ones(2)
    own = float(np.log(max(n[1], 1) / max(n[0], 1)))
    return score, float(bias[1] - bias[0]) + prior - own


def scores(raws: list[bytes], model: tuple[np.ndarray, float]) -> np.ndarray:
    """The probability of class 1 of each text; of one without features, what the bias alone gives."""
    table, bias = model
    parts = [(i, raw[a : a + PART]) for i, raw in enumerate(raws) for a in range(0, max(len(raw), 1), PART)]
    of = np.array([i for i, _ in parts], dtype=np.int64)
    n, total = np.zeros(len(raws)), np.zeros(len(raws))
    for a, b in batches_by_size([p for _, p in parts], PART):
        text, at = features([p for _, p in parts[a:b]])
        text = of[a:b][text]
        n += np.bincount(text, minlength=len(raws))
        total += np.bincount(text, weights=table[at], minlength=len(raws))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Train on the whole texts of a bounded sample of the labelled rows, SAMPLE_DOCS a class.

    ``labels`` has doc_id and quality; rows of a null or another quality than 0 and 1 are not used, repeated rows count
    once.  Of several documents of a sampled id the one of the least text hash is used.  With one class only, or none,
    the model gives the prior odds of the labels, smoothed by one row a class.
    """
    known = labels.filter("quality in (0, 1) and doc_id is not null").select("doc_id", "quality").distinct()
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    prior = float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)))
    if len(counts) < 2:
        return np.zeros(BUCKETS), prior
    hashed = known.withColumn("h", F.xxhash64("doc_id"))
    # each task keeps its first rows only, and the first of those are merged: no task sees all labels of a class
    zero, one = (hashed.filter(F.col("quality") == q).orderBy("h", "doc_id").limit(SAMPLE_DOCS) for q in (0, 1))
    ids = zero.unionByName(one).select("doc_id", "quality")
    found = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "quality", "text", F.xxhash64("text").alias("t"))
    sample = found.groupBy("doc_id", "quality").agg(F.min_by("text", "t").alias("text"))  # 2 * SAMPLE_DOCS rows at most
    rows = sorted((r["doc_id"], r["quality"], r["text"] or "") for r in sample.collect())
    return train([p.encode() for _, _, p in rows], [q for _, q, _ in rows], prior)


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) of every whole text; a null or empty text has no feature and gets the prior's score.

    Repeated rows are scored each, a null doc_id stays null, an empty table gives no rows; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches):
        worker_cache_of("hashes")
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for a, b in batches_by_size(texts):
                out = scores(texts[a:b], held.value)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(out)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.coalesce(doc_bucket("doc_id", 3) == 1, F.lit(False))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels").filter(~held_out()))
    return score_quality(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {"op10_quality": op10_quality}
