"""Document fingerprints: a homomorphic multiset hash of paragraphs, with lanes that tell likeness.

A paragraph (a line that is not empty) has a wide vector: EXACT lanes of 64 bits from a
cryptographic hash of its bytes, and SKETCH lanes of 32 bits to which each of its word
triples adds +1 or -1 at a hashed place.  A document's vector is the sum of its
paragraphs' vectors, modulo 2^64 and 2^32 a lane.  So it does not depend on
the order of paragraphs, and a paragraph is inserted or deleted by adding or subtracting
its vector.  Equal texts have equal fingerprints; the sketch lanes' products estimate the
Jaccard likeness of the two multisets of word triples.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import WORD_BYTES, span_hashes, worker_cache_of
from .tokens import batches_by_size

EXACT, SKETCH = 4, 128
PART = 1 << 20  # bytes hashed at once
CHUNKS_PER_PARTITION = 2  # chunks of the global order for each shuffle partition at least ...
CHUNK_BYTES = 64 << 20  # ... and as many as have about so many bytes of text each
WORD_TABLE = np.frombuffer(WORD_BYTES, dtype=np.uint8)
ODD_1, ODD_2, ODD_3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _vectors(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    exact = np.zeros((len(raws), EXACT), dtype=np.uint64)
    for i, raw in enumerate(raws):
        digests = b"".join(hashlib.blake2b(p, digest_size=8 * EXACT).digest() for p in raw.split(b"\n") if p)
        exact[i] = np.frombuffer(digests, dtype="<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
    data = np.frombuffer(b"\n" + b"\n".join(raws) + b"\n", dtype=np.uint8)
    plain = WORD_TABLE[data]
    edge = np.diff((plain != 32).view(np.int8))
    at, to = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    if not len(at):
        return exact, np.zeros((len(raws), SKETCH), dtype=np.int32)
    word = span_hashes(plain, at, to)
    paragraph = np.cumsum(data == 10)[at]
    # the word and the two after it in its paragraph
    with np.errstate(over="ignore"):
        triple = word * ODD_1
        for k, odd in ((1, ODD_2), (2, ODD_3)):
            same = paragraph[k:] == paragraph[:-k]
            triple[:-k][same] ^= (word[k:][same] * odd) << np.uint64(k)
        triple ^= triple >> np.uint64(29)
        triple *= ODD_2
        triple ^= triple >> np.uint64(32)
    ends = np.cumsum([len(r) + 1 for r in raws])
    doc = np.searchsorted(ends, at - 1, side="right")
    lane = doc * SKETCH + (triple >> np.uint64(1)).astype(np.int64) % SKETCH
    sign = 1.0 - 2.0 * (triple & np.uint64(1)).astype(np.float64)
    total = np.bincount(lane, weights=sign, minlength=len(raws) * SKETCH)
    return exact, total.astype(np.int64).astype(np.int32).reshape(len(raws), SKETCH)


def vectors(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(EXACT lanes as uint64, SKETCH lanes as int32) of each text in UTF-8; a long text is the sum of its parts."""
    parts, of = [], []
    for i, raw in enumerate(raws):
        a = 0
        while len(raw) - a > PART and (b := raw.find(b"\n", a + PART)) >= 0:
            parts.append(raw[a:b])
            of.append(i)
            a = b + 1
        parts.append(raw[a:])
        of.append(i)
    exact, sketch = np.zeros((len(raws), EXACT), dtype=np.uint64), np.zeros((len(raws), SKETCH), dtype=np.int32)
    for a, b in batches_by_size(parts, PART):
        e, s = _vectors(parts[a:b])
        np.add.at(exact, of[a:b], e)
        np.add.at(sketch, of[a:b], s)
    return exact, sketch


def as_text(exact: np.ndarray, sketch: np.ndarray) -> str:
    return exact.astype("<u8").tobytes().hex() + sketch.astype("<i4").tobytes().hex()


def from_text(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[: 8 * EXACT], dtype="<u8"), np.frombuffer(raw[8 * EXACT :], dtype="<i4")


def combined(a: str, b: str, sign: int = 1) -> str:
    """The fingerprint of both multisets of paragraphs together; ``sign=-1`` takes the second out of the first."""
    (ea, sa), (eb, sb) = from_text(a), from_text(b)
    with np.errstate(over="ignore"):
        return as_text(ea + eb, sa + sb) if sign > 0 else as_text(ea - eb, sa - sb)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Estimated Jaccard likeness, 0 to 1; exactly 1 for equal fingerprints; texts without words are like their equals only."""
    if (a[0] == b[0]).all():
        return 1.0
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    both = x @ y
    either = x @ x + y @ y - both
    return float(min(max(both / either, 0.0), 1.0)) if either > 0 else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of each row; a null or empty text has the fingerprint of no paragraph.

    Repeated rows have one each, equal ones; null ids stay null; an empty table gives no rows; other columns are not read.
    """

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            keys = batch.column(0)
            for a, b in batches_by_size(texts):
                exact, sketch = vectors(texts[a:b])
                out = [as_text(e, s) for e, s in zip(exact, sketch, strict=True)]
                yield pa.RecordBatch.from_arrays([keys[a:b], pa.array(out)], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def order_key(doc_id, tie: int) -> tuple:
    """The global order: doc_id descending, null ids last, ties by the text's hash."""
    return (True, 0, tie) if doc_id is None or doc_id != doc_id else (False, -int(doc_id), tie)


def chunk_starts(docs: DataFrame, chunks: int) -> list[tuple]:
    """The order keys at which the chunks of the global order begin: one row per range partition, ids only."""

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    keys = docs.select("doc_id", F.xxhash64("text").alias("tie"))
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    ranges = keys.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    return sorted({order_key(r["doc_id"], r["tie"]) for r in ranges.mapInArrow(first, "doc_id long, tie long").collect()})


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text (see ``op8_fingerprint``), with the fingerprints of both.

    The order is cut into chunks; a chunk also gets the first document of the next one, so every
    document meets its successor in one shuffle of the texts, whatever the chunks' sizes.  Rows equal in doc_id stand in the
    order of their text's hash, null ids after all others; repeated rows follow each other, in one chunk; a null or empty
    text is an empty document; a single row is its own successor; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    chunks = max(CHUNKS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // CHUNK_BYTES))
    starts = chunk_starts(docs, chunks)

    @F.pandas_udf("array<struct<chunk:int,sentinel:boolean>>")
    def targets(doc_id: pd.Series, tie: pd.Series) -> pd.Series:
        out = []
        for d, t in zip(doc_id, tie, strict=True):
            key = order_key(None if pd.isna(d) else int(d), int(t))
            c = bisect_right(starts, key) - 1
            own = [{"chunk": c, "sentinel": False}]
            if starts[c] == key:  # the chunk before ends with it
                own.append({"chunk": (c - 1) % len(starts), "sentinel": True})
            out.append(own)
        return pd.Series(out)

    dealt = docs.withColumn("tie", F.xxhash64("text"))
    dealt = dealt.withColumn("to", F.explode(targets(F.col("doc_id").cast("decimal(20,0)").cast("string"), "tie")))
    dealt = dealt.select("doc_id", "text", "tie", "to.chunk", "to.sentinel")
    dealt = dealt.repartition(max(len(starts), 1), "chunk").sortWithinPartitions(
        "chunk", "sentinel", F.desc_nulls_last("doc_id"), F.asc("tie")
    )

    def digest(held: list, after: bytes):
        """Rows of consecutive documents; ``after`` is the text of the one behind the last."""
        raws = [raw for _, raw in held] + [after]
        texts = [raw.decode("utf-8", "replace") for raw in raws]
        edits = []
        for text, following in zip(texts, texts[1:], strict=False):
            k = len(text) // 2
            edits.append((text[: len(text) - k] + following[:k]).encode())
        own, edited = vectors(raws), vectors(edits)
        rows = []
        for i, (key, _) in enumerate(held):
            a, b, c = ((v[0][j], v[1][j]) for v, j in ((own, i), (edited, i), (own, i + 1)))
            rows.append(
                (key, len(texts[i]), hashlib.sha256(edits[i]).hexdigest(), as_text(*a), as_text(*b), likeness(a, b), likeness(a, c))
            )
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches):
        worker_cache_of("hashes")
        held, chunk, size, done = [], None, 0, False
        for batch in batches:
            columns = [batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2), batch.column(3)]
            for key, text, c, sentinel in zip(*columns, strict=True):
                c, raw = c.as_py(), text.as_py() or b""
                if c != chunk:
                    held, chunk, size, done = [], c, 0, False
                if done:
                    continue  # another copy of the next chunk's first row
                if held and (size >= 1 << 20 or sentinel.as_py()):
                    yield digest(held, raw)
                    held, size = [], 0
                if sentinel.as_py():
                    done = True
                else:
                    held.append((key.as_py(), raw))
                    size += len(raw)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return dealt.select("doc_id", "text", "chunk", "sentinel").mapInArrow(run, schema)


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and of their edits.

    The edited text: the last floor(n_chars/2) code points replaced by the first as many (or all) of the next
    document in descending doc_id; after the last comes the first.
    """
    return edited_pairs(read_table(spark, sf_dir, "documents"))


QUERIES = {"op8_fingerprint": op8_fingerprint}
