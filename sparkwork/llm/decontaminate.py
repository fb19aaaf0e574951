"""Benchmark decontamination: a generalised suffix automaton of the test items, streamed over the documents.

The items' words are inserted into one automaton per block of items, bounded in words and chosen by hash; long items
are cut into parts that overlap by a window less a word, so no window is lost.  With several blocks each is a pass of its
own over the distinct texts, which writes the hits only.  A document's words walk the
automaton, which tells the longest suffix that occurs in an item.  Where it is at least
``window`` words long, the last ``window`` words are hit, and the state tells the items.
An item shorter than the window counts as one window.
"""

from __future__ import annotations

import re
import uuid
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_table
from .common import WORD_BYTES, free_name, stored, words_of, worker_cache_of

WINDOW = 10
BLOCK_WORDS = 100_000  # item words of one automaton
MAX_COVERAGE = 0.5  # a document of which more words are hit is dropped whole
WORD = re.compile(rb"[^ ]+")
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),  # [from, to) of hit words, ascending
        T.StructField("items", T.ArrayType(T.LongType())),  # distinct ids, ascending
        T.StructField("cleaned", T.StringType()),  # the text without the spans; null where nothing is hit
    ]
)
HITS_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))),
        ("items", pa.list_(pa.int64())),
        ("cleaned", pa.string()),
    ]
)


class SuffixAutomaton:
    """All word sequences that occur in the items of a block: (item_id, words) pairs."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int, int]] = []  # (state, item, words up to here)
        whole: dict[int, tuple[int, set[int]]] = {}  # short items by the state of their last word
        for item, words in items:
            last = 0
            for n, w in enumerate(words, 1):
                last = self._add(last, self.ids.setdefault(w, len(self.ids) + 1))
                ends.append((last, item, n))
            if 0 < len(words) < window:
                whole.setdefault(last, (len(words), set()))[1].add(item)
        # the state of a window's words: the suffix of that length, up the links
        self.window_of = [-1] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.length[v] >= window:
                up = self.link[v]
                self.window_of[v] = v if self.length[up] < window else self.window_of[up]
        self.items_of: dict[int, set[int]] = {}
        for v, item, n in ends:
            if n >= window:
                self.items_of.setdefault(self.window_of[v], set()).add(item)
        self.shortest = min([n for n, _ in whole.values()] + ([window] if self.items_of else []), default=0)
        # the short items that end where a state's words end: its own and those of its suffixes
        self.short_of: dict[int, list[tuple[int, set[int]]]] = {}
        if whole:
            for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                own = ([whole[v]] if v in whole else []) + self.short_of.get(self.link[v], [])
                if own:
                    self.short_of[v] = own

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, c: int) -> int:
        """The state that ``c`` leads to from ``p``, cut to the words of ``p`` and ``c``."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        state = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, c)
        return state

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(hit [from, to) word spans, items whose windows occur)."""
        if not self.shortest:
            return [], set()
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), dtype=np.int64, count=len(words))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):  # runs of words that items have
            if b - a >= self.shortest:
                self._walk(ids[a:b].tolist(), a, spans, items)
        return spans, items

    def _walk(self, ids: list[int], base: int, spans: list, items: set) -> None:
        follow, link, length, window, window_of, short_of = (
            self.next, self.link, self.length, self.window, self.window_of, self.short_of,
        )
        v = size = 0
        states = set()
        for i, c in enumerate(ids, base + 1):
            while v and c not in follow[v]:
                v = link[v]
                size = length[v]
            if c in follow[v]:
                v = follow[v][c]
                size += 1
            hit = 0
            if size >= window:
                hit = window
                states.add(window_of[v])
            if v in short_of:
                for n, some in short_of[v]:
                    if n <= size:
                        items |= some
                        hit = max(hit, n)
            if hit:
                a = i - hit
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, i))
        for s in states:
            items |= self.items_of.get(s, set())


def merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without(raw: bytes, spans: list) -> str:
    """The text with each span of words, and what stands between them, replaced by a line feed."""
    place = [m.span() for m in WORD.finditer(raw.translate(WORD_BYTES))]
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at : place[a][0]])
        at = place[b - 1][1]
    return b"\n".join([*parts, raw[at:]]).decode()


def item_blocks(items: DataFrame, block_words: int, window: int) -> tuple[DataFrame, int]:
    """((block, item_id, words) of the different items, number of blocks): about ``block_words`` words in each block.

    A longer item is cut into parts that overlap by ``window`` - 1 words; ``words`` are joined by single spaces.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text or b"")
                step = max(block_words, window)
                for a in range(0, max(len(words) - window + 1, 1), step) if words else ():
                    part = words[a : a + step + window - 1]
                    rows.append((item, b" ".join(part), len(part)))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item_id", "words", "n"])

    parts = items.select(F.col("item_id").cast("long"), "text").distinct().mapInArrow(run, "item_id long, words binary, n long")
    parts = stored(parts, "items")
    blocks = -(-(parts.agg(F.sum("n").alias("n")).first()["n"] or 0) // block_words)
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(max(blocks, 1))).cast("int")
    return parts.select(block.alias("block"), "item_id", "words"), blocks


def read_block(parts: DataFrame, block: int) -> list[tuple[int, list[bytes]]]:
    rows = parts.filter(F.col("block") == block).select("item_id", "words").collect()  # bounded by the block's words
    return sorted(((r["item_id"], bytes(r["words"]).split(b" ")) for r in rows), key=lambda r: (r[0] is not None, r))


def mark_hits(docs: DataFrame, items: DataFrame, name: str, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a struct column ``name`` (see HITS); every row and column is kept.

    A null or empty text has no words; items without words have no windows; items of a null id hit
    words but are not listed; repeated rows are marked each.  Without items nothing is hit.  Items of one block
    take one pass and no shuffle; with more, the hits of each distinct text are joined to the rows.
    """
    parts, blocks = item_blocks(items, block_words, window)
    if blocks <= 1:
        return _marked(docs, name, searcher(docs, read_block(parts, 0), window))
    key = free_name("text_key", docs)
    keyed = docs.withColumn(key, F.sha2("text", 256))
    texts = stored(keyed.filter("text is not null").groupBy(key).agg(F.first("text").alias("text")), "texts")
    hits = None
    for block in range(blocks):  # one block on the driver, and one automaton in a worker, at a time
        found = stored(block_hits(texts, key, searcher(docs, read_block(parts, block), window)), "block-hits")
        hits = found if hits is None else hits.unionByName(found)
    spans, ids, known = free_name("spans", keyed), free_name("items", keyed), free_name("known_key", keyed)
    hits = hits.groupBy(F.col(key).alias(known)).agg(
        F.flatten(F.collect_list("spans")).alias(spans), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(ids)
    )
    rows = keyed.join(hits, F.col(key) == F.col(known), "left").drop(key, known)
    return _marked(rows, name, None, spans, ids).drop(spans, ids)


def searcher(docs: DataFrame, block: list, window: int):
    """A function that gives a worker's automaton of a block."""
    held, own = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex  # bounded by block_words

    def get() -> SuffixAutomaton:
        cache = worker_cache_of("items")
        if cache.get("items of") != own:
            cache.pop("items", None)
            cache["items of"], cache["items"] = own, SuffixAutomaton(held.value, window)
        return cache["items"]

    return get


def block_hits(texts: DataFrame, key: str, automaton) -> DataFrame:
    """(key, spans, items) of the texts that a block's items hit."""

    def run(batches):
        found = automaton()
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                spans, ids = found.find(words_of(t.as_py() or b""))
                if spans:
                    rows.append((k, [list(s) for s in spans], sorted(i for i in ids if i is not None)))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.string(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "spans", "items"])

    return texts.select(key, "text").mapInArrow(run, f"`{key}` string, spans array<array<bigint>>, items array<bigint>")


def _marked(docs: DataFrame, name: str, automaton=None, spans_of: str | None = None, items_of: str | None = None) -> DataFrame:
    """The column ``name`` from an automaton, or from columns of spans, in any order, and items."""
    text = docs.columns.index("text")
    known = None if automaton else (docs.columns.index(spans_of), docs.columns.index(items_of))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, HITS)])

    def run(batches):
        found = automaton() if automaton else None
        for batch in batches:
            earlier = zip(batch.column(known[0]), batch.column(known[1]), strict=True) if known else repeat(None)
            rows = []
            for t, e in zip(batch.column(text).cast(pa.binary()), earlier, strict=False):
                raw = t.as_py() or b""
                words = words_of(raw)
                spans, ids = found.find(words) if found else (merged(e[0].as_py() or []), e[1].as_py() or [])
                rows.append(
                    {
                        "n_words": len(words),
                        "spans": [list(s) for s in spans],
                        "items": sorted(i for i in ids if i is not None),
                        "cleaned": without(raw, spans) if spans else None,
                    }
                )
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, HITS_ARROW)], schema.names)

    return docs.mapInArrow(run, schema)


def covered(spans):
    """Hit words of a spans column."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` with hit spans cut out of the texts; documents with more than ``max_coverage`` of words hit are dropped.

    Columns stay as they are, whatever their names, but text and n_chars, its length, of cut texts.  Null and empty texts
    are kept; without items all rows are.
    """
    name = free_name("hits", docs)
    out = mark_hits(docs, items, name, window)
    share = covered(F.col(f"{name}.spans")) / F.greatest(F.col(f"{name}.n_words"), F.lit(1))
    out = out.filter(share <= max_coverage).withColumn("text", F.coalesce(F.col(f"{name}.cleaned"), F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(f"{name}.cleaned").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_hits(docs, read_table(spark, sf_dir, "benchmark"), "hits")
    ids = F.array_join(F.sort_array(F.transform("hits.items", lambda i: i.cast("string"))), ",")
    return marked.select(
        "doc_id",
        "hits.n_words",
        covered(F.col("hits.spans")).alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("hits.spans") > 0).alias("contaminated"),
    )


QUERIES = {"op6_decontaminate": op6_decontaminate}
