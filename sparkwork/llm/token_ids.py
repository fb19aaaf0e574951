"""Token-id files: canonical length-limited Huffman code, blocks that decode alone, bit-offset checkpoints.

Format, one folder:

* ``codebook``  Parquet rows (token int, bits int): the code length of every id that occurs.  Codes are
  canonical: numbered in order of (bits, token), so the lengths are the whole code.
* ``blocks``  Parquet rows in ascending document order: shard, block (numbered from 0 in each shard), first
  (ids before it in the shard), doc_id and doc_tokens (arrays, one entry per document), n_tokens, checkpoints
  (bit offset of every ``every``-th id) and payload (the bits, most significant first).  A block holds whole
  documents; any run between two checkpoints decodes without what stands before.

Shards are the range partitions of the sorted documents; a document's start is its shard's
offset (a sum of one count per shard) plus ``first`` plus the documents before it in the block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_table
from .common import stored, worker_cache, worker_cache_of
from .tokens import batches_by_size, encoder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MAX_BITS = 18  # longest code; raised to fit where more than 2^18 ids occur
BLOCK_TOKENS = 1 << 16  # a block is closed by the document that reaches it
CHECKPOINT_EVERY = 128
BLOCKS_SCHEMA = (
    "shard int, block int, first long, doc_id array<long>, doc_tokens array<long>, "
    "n_tokens long, every int, checkpoints array<long>, payload binary"
)
IDS_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def packed(ids: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """uint32 ids as zstandard-packed byte planes; two planes if the ids fit them, else four."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    n = 4 if len(ids) and ids.max() > 0xFFFF else 2
    return bytes([n]) + squeeze.compress(planes[:, :n].T.tobytes())


def unpacked(z: bytes) -> np.ndarray:
    """The ids of one ``packed`` value."""
    cache = worker_cache()
    if "unzip" not in cache:
        cache["unzip"] = zstandard.ZstdDecompressor()
    planes = np.frombuffer(cache["unzip"].decompress(z[1:]), dtype=np.uint8).reshape(z[0], -1)
    ids = planes[0] | planes[1].astype(np.uint32) << 8
    return ids if z[0] == 2 else ids | planes[2].astype(np.uint32) << 16 | planes[3].astype(np.uint32) << 24


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids): ids are ``packed``, ``end_id`` last.  Null text is empty."""

    def run(batches):
        worker_cache_of("tokenizer")
        enc, squeeze = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in batches_by_size(texts):
                ids = [np.append(x, np.uint32(end_id)) for x in enc.encode(texts[a:b])]
                n, z = [len(x) for x in ids], [packed(x, squeeze) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:b], pa.int64()), pa.array(n, pa.int64()), pa.array(z, pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def token_counts(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs in all rows of ``tokenised``; as many entries as ids of the vocabulary occur."""

    def run(batches):
        worker_cache_of("ids")
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            column = batch.column(0).to_pylist()
            for a in range(0, len(column), 512):
                c = np.bincount(np.concatenate([unpacked(z) for z in column[a : a + 512]]))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[: len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["token", "n"])

    rows = ids.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in rows.collect()}  # bounded by the vocabulary


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` bits, by package-merge."""
    n = len(counts)
    if n <= 1:
        return dict.fromkeys(counts, 1)
    max_bits = max(max_bits, (n - 1).bit_length())
    tokens = np.array(sorted(counts, key=lambda t: (counts[t], t)), dtype=np.int64)
    leaf = np.array([counts[int(t)] for t in tokens], dtype=np.float64)
    lists, merged = [], np.zeros(0)
    for _ in range(max_bits):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaf, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        lists.append(order < n)  # which of the merged items are leaves
    bits, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_leaf in reversed(lists):
        leaves = int(is_leaf[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    return {int(t): int(b) for t, b in zip(tokens, bits, strict=True)}


def canonical(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, bits, codes) in canonical order."""
    order = sorted(lengths, key=lambda t: (lengths[t], t))
    bits = np.array([lengths[t] for t in order], dtype=np.int64)
    codes, code, last = np.zeros(len(order), dtype=np.int64), 0, 0
    for i, b in enumerate(bits):
        code <<= int(b) - last
        codes[i], last = code, int(b)
        code += 1
    return np.array(order, dtype=np.int64), bits, codes


def encode_bits(code: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Concatenate codes: (bit offset of each, the bytes)."""
    ends = np.cumsum(bits)
    at = ends - bits
    word = at >> 6
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros((int(ends[-1]) + 63 >> 6) + 1, dtype=np.uint64)
    shift = 64 - (at & 63) - bits  # room left in the word; negative: the code runs over, one at most per word
    over = np.flatnonzero(shift < 0)
    spill = code[over].astype(np.uint64) << (64 + shift[over]).astype(np.uint64)
    head = code.astype(np.uint64) << np.maximum(shift, 0).astype(np.uint64)
    head[over] = code[over].astype(np.uint64) >> (-shift[over]).astype(np.uint64)
    out[word[first]] = np.bitwise_or.reduceat(head, first)
    out[word[over] + 1] |= spill
    return at, out.astype(">u8").tobytes()[: int(ends[-1]) + 7 >> 3]


def decode_bits(payload: bytes, checkpoints: np.ndarray, n: int, every: int, table: np.ndarray, top: int) -> np.ndarray:
    """All ``n`` ids of a block; the runs between checkpoints advance side by side, one table look-up per id."""
    data = np.frombuffer(payload + bytes(4), dtype=np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    out = np.zeros((len(checkpoints), every), dtype=np.uint32)
    pos = np.array(checkpoints, dtype=np.int64)
    left = n - (len(pos) - 1) * every  # ids of the last run
    for j in range(every):
        if j == left:
            pos = pos[:-1]
        if not len(pos):
            break
        hit = table[(window[pos >> 3] >> (32 - top - (pos & 7)).astype(np.uint32)) & np.uint32((1 << top) - 1)]
        out[: len(pos), j] = hit >> 5
        pos = pos + (hit & 31)
    return out.ravel()[:n]


def write_ids(docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = 0, max_bits: int = MAX_BITS) -> None:
    """Tokenise every whole text and write the id files in ascending ``doc_id`` order (null ids first).

    Repeated ids stand in the order of their tokens' hash; a null or empty text is one end id.  An
    empty table writes an empty codebook and no blocks.  Columns but doc_id and text are not read.
    """
    spark = docs.sparkSession
    ids = stored(tokenised(docs, tokenizer, end_id), "token-ids", "uncompressed")  # packed already
    lengths = code_lengths(token_counts(ids), max_bits)
    rows = [(t, b) for t, b in sorted(lengths.items())]
    spark.createDataFrame(rows, "token int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    tokens, bits, codes = canonical(lengths)
    code_of = np.zeros((2, int(tokens.max()) + 1 if len(tokens) else 1), dtype=np.int64)
    code_of[0, tokens], code_of[1, tokens] = codes, bits

    def run(batches):
        worker_cache_of("ids")
        shard, block, first, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def closed():
            flat = np.concatenate([x for _, x in held])
            at, payload = encode_bits(code_of[0, flat], code_of[1, flat])
            row = {
                "shard": shard, "block": block, "first": first, "doc_id": [k for k, _ in held],
                "doc_tokens": [len(x) for _, x in held], "n_tokens": len(flat), "every": CHECKPOINT_EVERY,
                "checkpoints": at[::CHECKPOINT_EVERY].tolist(), "payload": payload,
            }
            return pa.RecordBatch.from_pylist([row], schema=blocks_arrow)

        for batch in batches:
            for key, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((key, unpacked(z)))
                size += len(held[-1][1])
                if size >= BLOCK_TOKENS:
                    yield closed()
                    block, first, held, size = block + 1, first + size, [], 0
        if held:
            yield closed()

    blocks_arrow = pa.schema(
        [
            ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_id", pa.list_(pa.int64())),
            ("doc_tokens", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("every", pa.int32()),
            ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary()),
        ]
    )
    tie = F.xxhash64("ids")
    ordered = ids.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie).select("doc_id", "ids")
    ordered.mapInArrow(run, BLOCKS_SCHEMA).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Read id files back: doc_id, start (ids before the document), n_tokens, ids (little-endian uint32 bytes)."""
    lengths = {r["token"]: r["bits"] for r in spark.read.parquet(f"{path}/codebook").collect()}  # the vocabulary
    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks")
    shards = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    offset, before = {}, 0
    for s in sorted(shards):
        offset[s], before = before, before + shards[s]
    tokens, bits, codes = canonical(lengths)
    top = int(bits.max()) if len(bits) else 1

    def decoder():
        cache = worker_cache_of("ids")
        if cache.get("decoder of") != path:
            table = np.zeros(1 << top, dtype=np.uint32)
            for t, b, c in zip(tokens.tolist(), bits.tolist(), codes.tolist(), strict=True):
                table[c << top - b : c + 1 << top - b] = t << 5 | b
            cache["decoder of"], cache["decoder"] = path, table
        return cache["decoder"]

    def run(batches):
        table = decoder()
        for batch in batches:
            for r in batch.to_pylist():
                ids = decode_bits(r["payload"], r["checkpoints"], r["n_tokens"], r["every"], table, top)
                raw, n = ids.astype("<u4").tobytes(), np.array(r["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["doc_id"], pa.int64()),
                        pa.array(ends - n + r["first"] + offset[r["shard"]]),
                        pa.array(n),
                        pa.array([raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(run, IDS_SCHEMA)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids, read the files back, and digest what was read."""
    path = scratch_path(spark, "id-files")
    write_ids(read_table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op1_token_ids": op1_token_ids}
