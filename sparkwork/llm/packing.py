"""Sequence packing by cutting-stock column generation over the histogram of piece lengths.

A document's ids are cut into whole sequences and one rest.  Rests are counted by
length class (lengths rounded up to ``unit`` ids), a linear program over patterns
of classes that fill a sequence is solved by column generation (a knapsack dynamic
program prices the next pattern), the solution is rounded down, and the pieces of a
class, ranked, take the places that the patterns hold for it.  What rounding leaves
over holds at most one sequence per pattern, whatever the size of the input; those
pieces are laid end to end and cut at the sequence length, the last ids at powers of two.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import read_table
from .common import stored, trim, worker_cache_of
from .token_ids import packed, unpacked
from .tokens import batches_by_size, encoder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SEQUENCE = 2048
UNIT = 8  # ids by which length classes differ; a piece wastes less than this in its place
TOLERANCE = 0.002  # the program is solved to this share of the least number of sequences
REFACTOR = 64  # pivots after which the basis is inverted anew
PIECES_SCHEMA = (
    "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, units int, part int, nth long, ids binary"
)
PLACED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, unit: int) -> DataFrame:
    """Tokenise whole texts and cut them; ``nth`` counts the pieces of a class in its input partition ``part``."""

    def run(batches):
        worker_cache_of("tokenizer")
        enc, squeeze, part, nth = encoder(tokenizer), zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), {}
        for batch in batches:
            trim()
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in batches_by_size(texts):
                rows = []
                for key, ids in zip(keys[a:b], enc.encode(texts[a:b]), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        raw, units = piece.tobytes(), -(-len(piece) // unit)
                        nth[units] = nth.get(units, -1) + 1
                        rows.append((key, len(ids), start, len(piece), zlib.crc32(raw), units, part, nth[units], packed(piece, squeeze)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names
                )
        keys = texts = rows = None
        trim()

    names = [c.split()[0] for c in PIECES_SCHEMA.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64(), pa.binary()]
    return docs.select("doc_id", "text").mapInArrow(run, PIECES_SCHEMA)


def best_pattern(price: np.ndarray, units: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of classes of the highest total price within ``capacity`` (an unbounded knapsack)."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(units, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        if k := fits[c]:
            gain = price[:k] + value[c - units[:k]]
            j = int(gain.argmax())
            if gain[j] > value[c] + 1e-12:
                value[c], choice[c] = gain[j], j
    pattern, c = np.zeros(len(units)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[choice[c]] += 1
            c -= units[choice[c]]
    return float(value[capacity]), pattern


def inverted(a: np.ndarray) -> np.ndarray:
    """The inverse by Gauss-Jordan elimination with row pivots, in one thread."""
    n = len(a)
    both = np.concatenate([a, np.eye(n)], axis=1)
    for c in range(n):
        r = c + int(np.abs(both[c:, c]).argmax())
        both[[c, r]] = both[[r, c]]
        both[c] /= both[c, c]
        factor = both[:, c].copy()
        factor[c] = 0
        both -= factor[:, None] * both[c]
    return both[:, n:]


def solve_patterns(demand: dict[int, int], capacity: int, tolerance: float = TOLERANCE) -> list[tuple[dict[int, int], int]]:
    """[(pattern: class -> pieces, times)], rounded down, never using more pieces of a class than there are.

    A revised simplex over the classes that occur (at most ``capacity`` rows); it stops when the number of sequences
    is within ``tolerance`` of a lower bound, or no pattern improves it.  What is left of the demand then
    takes fewer units than a sequence per class and one more: larger leftovers get patterns of the largest pieces first.
    """
    if not demand:
        return []
    units = np.array(sorted(demand))
    need = np.array([demand[int(u)] for u in units], dtype=np.float64)
    # demands moved a little: ties between bases, which could lead in circles, are broken
    moved = need + 1e-4 * np.random.default_rng(0).random(len(need))
    columns = np.diag(capacity // units).astype(np.float64)
    least = need @ units / capacity
    pivots = gained = 0
    gap = np.inf
    while pivots - gained <= 20 * len(units):  # rounding errors alone move nothing any more
        if pivots % REFACTOR == 0:
            inverse = inverted(columns)
            times = np.maximum(inverse @ moved, 0)
        value, column = best_pattern(inverse.sum(axis=0), units, capacity)
        total = times.sum()
        least = max(least, total / max(value, 1.0))
        if value <= 1 + 1e-9 or total - least <= tolerance * total:
            break
        if total - least < gap * (1 - 1e-6):
            gap, gained = total - least, pivots
        step = inverse @ column
        ratio = np.where(step > 1e-9, times / np.where(step > 1e-9, step, 1), np.inf)
        r = int(ratio.argmin())
        if not np.isfinite(ratio[r]):
            break  # rounding: no basis change is left
        inverse[r] /= step[r]
        times[r] = ratio[r]
        rest = step.copy()
        rest[r] = 0
        inverse -= np.outer(rest, inverse[r])
        times = np.maximum(times - rest * times[r], 0)
        columns[:, r] = column
        pivots += 1
    left, out = need.copy(), []
    for r in np.argsort(-times, kind="stable"):
        column = columns[:, r]
        used = column > 0
        k = int(min(np.floor(times[r] + 1e-6), (left[used] // column[used]).min()))
        if k > 0:
            left -= k * column
            out.append(({int(u): int(a) for u, a in zip(units[used], column[used], strict=True)}, k))
    while left @ units > (len(units) + 1) * capacity:
        pattern, room = {}, capacity
        for j in range(len(units) - 1, -1, -1):
            if a := int(min(room // units[j], left[j])):
                pattern[int(units[j])] = a
                room -= a * int(units[j])
        of = {int(u): n for u, n in zip(units, left, strict=True)}
        k = int(min(of[u] // a for u, a in pattern.items()))
        left -= k * np.array([pattern.get(int(u), 0) for u in units])
        out.append((pattern, k))
    return out


def places(patterns: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each class the ranges of ranks that each pattern takes; at most classes times patterns entries."""
    rows, taken, first = [], {}, 0
    for pattern, k in patterns:
        for u, a in pattern.items():
            rows.append((u, taken.get(u, 0), a, first, k * a))
            taken[u] = taken.get(u, 0) + k * a
        first += k
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {"units": table[:, 0], "low": table[:, 1], "each": table[:, 2], "first": table[:, 3], "count": table[:, 4]}


def lay_out(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces end to end: (piece, from, length, sequence from 0, offset); cut at ``size``, at the end at powers of two."""
    rows, sequence, room, used, left = [], 0, 0, 0, sum(lengths)
    for i, n in enumerate(lengths):
        at = 0
        while at < n:
            if not room:
                room, used = size if left >= size else 1 << left.bit_length() - 1, 0
            take = min(room, n - at)
            rows.append((i, at, take, sequence, used))
            at, room, used, left = at + take, room - take, used + take, left - take
            sequence += not room
    return rows


def pack(
    docs: DataFrame, tokenizer: str = WORD_BPE, end_id: int = 1, size: int = SEQUENCE, unit: int = UNIT, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    Every id of every document, its end id included, lies in exactly one piece.  A null or empty text is one
    end id; an empty table gives no rows; repeated ids and rows are documents of their own; columns but doc_id and
    text are not read.  A sequence that the pieces do not fill is meant to be padded to ``size`` unless its length
    is a power of two.  ``ids`` are packed as ``token_ids.unpacked`` reads them.
    """
    pieces = stored(cut_pieces(docs, tokenizer, end_id, size, unit), "pieces", "uncompressed")  # ids are packed already
    counts = pieces.groupBy("units", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("units").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-ranks")
    demand = {r["units"]: r["n"] for r in offsets.groupBy("units").agg(F.sum("n").alias("n")).collect()}  # one per class
    patterns = solve_patterns(demand, -(-size // unit))
    table, whole = places(patterns), sum(k for _, k in patterns)
    span = 1 << 44  # more than the ranks of a class
    keys = table["units"] * span + table["low"]

    @F.pandas_udf("long")
    def sequence_of(units: pd.Series, rank: pd.Series) -> pd.Series:
        u, r = units.to_numpy(np.int64), rank.to_numpy(np.int64)
        if not len(keys):
            return pd.Series(np.full(len(u), -1))
        i = np.maximum(np.searchsorted(keys, u * span + r, side="right") - 1, 0)
        at = r - table["low"][i]
        held = (table["units"][i] == u) & (at < table["count"][i])
        return pd.Series(np.where(held, table["first"][i] + at // table["each"][i], -1))

    ids = ["ids"] if with_ids else []
    ranked = pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "units", "part", "nth", *ids)
    ranked = ranked.join(offsets.select("units", "part", "base"), ["units", "part"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth"))
    placed = ranked.withColumn("sequence_id", sequence_of("units", "rank"))
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("units"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    main = placed.filter("sequence_id >= 0").withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))

    def cut_rest(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("part", "ascending"), ("nth", "ascending"), ("units", "ascending")])
        columns = {c: table[c].to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids")}
        flat, rows, squeeze = [unpacked(z) for z in columns["ids"]], [], zstandard.ZstdCompressor(level=1)
        for i, at, n, sequence, offset in lay_out(columns["length"], size):
            part = flat[i][at : at + n].astype("<u4")
            row = (columns["doc_id"][i], columns["start"][i] + at, n, zlib.crc32(part.tobytes()), columns["doc_tokens"][i], whole + sequence, offset)
            rows.append((*row, packed(part, squeeze))[: 7 + with_ids])
        kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*PLACED, *ids])

    # at most a sequence of ids per class and one more (see solve_patterns): a bound that the classes set, not the input
    rest = F.broadcast(placed.filter("sequence_id < 0").select("units", "part", "nth"))
    rest = pieces.join(rest, ["units", "part", "nth"]).groupBy(F.lit("rest").alias("all")).applyInArrow(
        cut_rest, ", ".join([f"{c} long" for c in PLACED] + [f"{c} binary" for c in ids])
    )
    return main.select(*PLACED, *ids).unionByName(rest)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_packing": op4_packing}
