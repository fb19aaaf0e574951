"""Near-duplicate documents: BagMinHash signatures of word-shingle multisets, banded, verified, joined to groups.

Signature.  Each distinct shingle owns independent Poisson processes on the weight levels [0,1), [1,2),
[2,4), [4,8) ...; a process of width v emits points at rate v times the number of components, each at
a random time, for a random component and at a random level, all functions of the shingle's hash alone.
A shingle that occurs w times takes the points at levels below w.  A component keeps the earliest
point, so two documents agree in a component with the probability of their weighted Jaccard
similarity.  Only points before a time that depends on the document's weight are made.

Candidates.  Documents of equal word sequences are one node.  Nodes that share a band of components are in one
bucket.  First each bucket's nodes are compared with one of them (a star, linear in the bucket); rounds with other
centres follow while large buckets still hold many groups.  What is left is compared exhaustively between
the groups of a bucket: the nodes outside the bucket's largest group are cut into blocks of bounded size that
every node of the bucket meets.  Signatures tell which nodes of a block have a likely partner there, and those nodes'
whole texts are compared through an inverted index of the block's shingles.  No pairs are written but links.

Large buckets, centres and groups are split: joins on them are over written tables, which adaptive execution
can split, comparisons are dealt by centre and salt or by block, and aggregates combine before they are shuffled.
"""

from __future__ import annotations

import hashlib
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import GOLDEN, WORD_BYTES, free_name, hashed_words, mixed, span_words, stored, words_of, worker_cache_of
from .tokens import batches_by_size

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5  # a pair at 0.8 shares no band with probability (1 - 0.8^5)^24 = 7e-5
COMPONENTS = BANDS * ROWS
SURE = 0.65  # estimates below it are not verified: four deviations of a pair at 0.8
STAR_SALT = 256  # comparisons of one centre in one group
BLOCK = 256  # nodes of one side in an exhaustive comparison
MAX_STARS = 3  # star rounds before the exhaustive one
EXCESS = 8  # star rounds go on while the exhaustive one would read more than so many times the buckets' rows
BATCH = 1 << 20  # bytes of texts whose signatures are made at once
NO_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # what stands between words
WORD_TABLE = np.frombuffer(WORD_BYTES, dtype=np.uint8)


def shingle_counts(raws: list[bytes], checked: bool = False) -> tuple[np.ndarray, ...]:
    """(text, shingle hash, count) of the distinct shingles of texts in UTF-8, ordered by text.

    A text of fewer words than a shingle has one shingle of all its words; one without words has none.  ``checked``
    adds a second, independent hash of each shingle: comparisons of both are of 128 bits.
    """
    data = WORD_TABLE[np.frombuffer(b"\n" + b"\n".join(raws) + b"\n", dtype=np.uint8)]
    edge = np.diff((data != 32).view(np.int8))
    at, to = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    words = span_words(data, at, to)
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), at - 1, side="right")
    n = np.bincount(owner, minlength=len(raws))
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    inside = owner[: max(len(at) - SHINGLE + 1, 0)] == owner[SHINGLE - 1 :]
    keys = [_shingle_keys(hashed_words(words, salt), n, inside, short) for salt in range(1 + checked)]
    doc, key = np.concatenate([owner[: len(inside)][inside], short]), keys[0]
    order = np.argsort((doc.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20)), kind="stable")
    same = (doc[order][1:] == doc[order][:-1]) & (key[order][1:] >> np.uint64(20) == key[order][:-1] >> np.uint64(20))
    if any((k[order][1:] != k[order][:-1])[same].any() for k in keys):  # different keys, equal in their upper bits
        order = np.lexsort((*keys[::-1], doc))
    doc, keys = doc[order], [k[order] for k in keys]
    changes = [np.concatenate([[True], x[1:] != x[:-1]]) for x in (doc, *keys)] if len(doc) else [np.zeros(0, dtype=bool)]
    new = np.flatnonzero(np.logical_or.reduce(changes))
    return doc[new], keys[0][new], np.diff(np.append(new, len(doc))), *(k[new] for k in keys[1:])


def _shingle_keys(word: np.ndarray, n: np.ndarray, inside: np.ndarray, short: np.ndarray) -> np.ndarray:
    """A hash of each full shingle, then of all words of each short text."""
    key = np.zeros(len(inside), dtype=np.uint64)
    for k in range(SHINGLE if len(inside) else 0):
        key = mixed(key * GOLDEN + word[k : k + len(inside)]) if k else word[: len(inside)].copy()
    first = np.cumsum(n) - n
    whole = [hashlib.blake2b(word[first[i] : first[i] + n[i]].tobytes(), digest_size=8).digest() for i in short]
    return mixed(np.concatenate([key[inside], np.frombuffer(b"".join(whole), dtype="<u8")]))


def signatures(raws: list[bytes]) -> np.ndarray:
    """BagMinHash: for each text COMPONENTS 64-bit names of the earliest points; zeros for a text without words."""
    doc, key, count = shingle_counts(raws)
    out = np.zeros((len(raws), COMPONENTS), dtype=np.uint64)
    weight = np.bincount(doc, weights=count, minlength=len(raws))
    horizon = np.log(COMPONENTS) + 4.0  # times the weight; few texts have an empty component then
    todo = weight > 0
    while todo.any():
        names, filled = _earliest(doc, key, count, horizon / np.maximum(weight, 1), todo)
        done = todo & filled
        out[done] = names[done]
        todo &= ~filled
        horizon *= 2
    return out


def _earliest(doc, key, count, until, todo) -> tuple[np.ndarray, np.ndarray]:
    """(names, whether all components have a point) from the points before ``until`` of the texts ``todo``."""
    take = todo[doc]
    doc, key, count = doc[take], key[take], count[take]
    levels = np.frexp(np.maximum(count - 1, 0))[1]  # processes beyond the first: 1 for count 2, 2 for 3 and 4, ...
    of = np.repeat(np.arange(len(doc)), levels + 1)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels + 1) - levels - 1, levels + 1)
    low = np.where(level > 0, np.left_shift(1, np.maximum(level - 1, 0)), 0)
    width = np.maximum(low, 1)
    seed = mixed(key[of] + level.astype(np.uint64) * GOLDEN)
    text, most, end, time = doc[of], count[of], until[doc[of]], np.zeros(len(of))
    best = np.full(len(until) * COMPONENTS, np.inf)
    names = np.zeros(len(best), dtype=np.uint64)
    while len(seed):
        seed = seed + GOLDEN
        draw = mixed(seed)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (width * COMPONENTS)
        alive = time <= end
        seed, text, most, end, time, low, width, draw = (a[alive] for a in (seed, text, most, end, time, low, width, draw))
        other = mixed(draw)
        at = low + ((other >> np.uint64(44)).astype(np.int64) * width >> 20)  # the point's level, uniform in the process
        taken = (low == 0) | (at < most)
        cell = (text * COMPONENTS + ((other & np.uint64(0xFFFFFFFF)) % np.uint64(COMPONENTS)).astype(np.int64))[taken]
        when, name = time[taken], draw[taken]
        np.minimum.at(best, cell, when)
        first = best[cell] == when
        names[cell[first]] = name[first]
    return names.reshape(-1, COMPONENTS), np.isfinite(best.reshape(-1, COMPONENTS)).all(axis=1)


def similarity(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    """Weighted Jaccard similarity of two (distinct shingles, counts, second hashes)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    equal = a[2][i] == b[2][j]
    i, j = i[equal], j[equal]
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(int(a[1].sum()) + int(b[1].sum()) - both, 1)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, words, bands, sketch) of every row: names of the text and of its word sequence, bands, 16 bits a component.

    A text without words has null ``words``.
    """

    def run(batches):
        worker_cache_of("shingles")
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            for a, b in batches_by_size(texts, BATCH):
                some = texts[a:b]
                names = signatures(some)
                words = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() if (w := words_of(t)) else None for t in some]
                bands = names.reshape(-1, BANDS, ROWS)
                key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
                for k in range(ROWS):
                    key = mixed(key * GOLDEN + bands[:, :, k])
                ends = pa.array(np.arange(0, BANDS * (len(some) + 1), BANDS, dtype=np.int32))
                low = names.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b],
                        batch.column(1)[a:b],
                        pa.array(words, pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(key.ravel().view(np.int64))),
                        pa.array([row.tobytes() for row in low], pa.binary()),
                    ],
                    ["doc_id", "tie", "words", "bands", "sketch"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(run, "doc_id long, tie long, words binary, bands array<long>, sketch binary")


def with_sketches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sketches do not rule out the similarity."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)

    def run(batches):
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(-1, COMPONENTS) for c in (2, 3)
            )
            near = (left == right).mean(axis=1) >= SURE
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar; ``b`` may have many partners, they are dealt by salt."""
    partners = stored(pairs.groupBy("b").agg(F.count("*").alias("n")), "centres")
    dealt = pairs.join(partners, "b").withColumn("salt", F.pmod(F.hash("a"), F.ceil(F.col("n") / STAR_SALT)).cast("int"))
    dealt = dealt.select("a", "b", "salt")
    centres = dealt.select("b", "salt").distinct().join(texts.withColumnRenamed("node", "b"), "b")
    members = dealt.join(texts.withColumnRenamed("node", "a"), "a")
    rows = centres.select("b", "salt", F.lit(None).cast("long").alias("a"), "text").unionByName(
        members.select("b", "salt", "a", "text")
    )
    rows = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))

    def run(batches):
        worker_cache_of("shingles")
        centre, held = None, None
        for batch in batches:
            found = []
            for b, salt, a, text in zip(*(batch.column(i) for i in range(3)), batch.column(3).cast(pa.binary()), strict=True):
                _, key, count, check = shingle_counts([text.as_py()], checked=True)
                order = np.argsort(key)
                own = key[order], count[order], check[order]
                if a.as_py() is None:
                    centre, held = (b.as_py(), salt.as_py()), own
                elif centre == (b.as_py(), salt.as_py()) and similarity(own, held) >= SIMILARITY:
                    found.append((a.as_py(), b.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"]
            )

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, comp) of all nodes with an edge (a, b): comp is the least node of the connected component.

    Each round a node takes the least label among its own and its neighbours', then its label's label; labels
    are written to the shared folder in each round.  After a given number of ``rounds`` a label stands for connected
    nodes still, but perhaps not for all of them.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp"))
    labels = stored(labels, "labels")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node")
        step = stored(step.select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("now")), "labels")
        if rounds is None and not step.filter("now != was").limit(1).count():
            return step.select("node", F.col("now").alias("comp"))
        jump = step.select(F.col("node").alias("now"), F.col("now").alias("next"))
        labels = step.join(jump, "now").select("node", F.col("next").alias("comp"))
        if turn == rounds:
            return stored(labels, "labels")


def labelled(rows: DataFrame, comps: DataFrame | None, node: str, name: str) -> DataFrame:
    """``rows`` with the component of column ``node``; a node without one is its own."""
    if comps is None:
        return rows.withColumn(name, F.col(node))
    named = comps.select(F.col("node").alias(node), F.col("comp").alias(name))
    return rows.join(named, node, "left").withColumn(name, F.coalesce(name, node))


def joined_groups(comps: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """The labels after groups with links between them have been joined: components of the groups, not of the nodes."""
    between = labelled(labelled(links, comps, "a", "x"), comps, "b", "y").filter("x != y")
    between = stored(between.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "group-links")
    if between.isEmpty():
        return comps
    own = labelled(nodes.select("node"), comps, "node", "comp")
    return stored(labelled(own, components(between), "comp", "joined").select("node", F.col("joined").alias("comp")), "labels")


def star_pairs(buckets: DataFrame, turn: int) -> DataFrame:
    """Distinct (a, b): every node of a bucket with the bucket's centre, where they are in different groups.

    The centre is the least node after a bijection that differs by ``turn``.
    """
    flip = int(mixed(np.array([turn + 1], dtype=np.uint64)).view(np.int64)[0])
    centre = F.min(F.col("node").bitwiseXOR(F.lit(flip))).bitwiseXOR(F.lit(flip)).alias("b")
    mixed_up = (F.min("comp") != F.max("comp")).alias("several")
    centres = stored(buckets.groupBy("band").agg(centre, mixed_up).filter("several").drop("several"), "bucket-centres")
    pairs = buckets.join(centres, "band").select(F.col("node").alias("a"), "b", "comp")
    return pairs.filter("a != b").groupBy("a", "b").agg(F.first("comp").alias("comp"))


def open_buckets(buckets: DataFrame) -> DataFrame:
    """Buckets with several groups: (band, common, others), the most frequent group and how many nodes are not of it."""
    sizes = buckets.groupBy("band", "comp").agg(F.count("*").alias("n"))
    per = sizes.groupBy("band").agg(
        F.sum("n").alias("total"), F.max("n").alias("most"), F.max_by("comp", F.struct("n", "comp")).alias("common")
    )
    return per.filter("total > most").select("band", "common", "total", (F.col("total") - F.col("most")).alias("others"))


def in_blocks(buckets: DataFrame, open_: DataFrame) -> DataFrame:
    """(band, block, node, comp, left): every node of a bucket once per block of the nodes outside its largest group.

    ``left`` marks the block's own nodes.
    """
    rows = buckets.join(open_, "band")
    blocks = F.ceil(F.col("others") / BLOCK).cast("int")
    own = F.when(F.col("comp") != F.col("common"), F.pmod(F.hash("node", "band"), blocks)).alias("own")
    rows = rows.select("band", "node", "comp", own, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    return rows.select("band", "block", "node", "comp", F.coalesce(F.col("own") == F.col("block"), F.lit(False)).alias("left"))


def by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("band", "block").sortWithinPartitions("band", "block", F.desc("left"))


def block_groups(batches, width: int):
    """((band, block), its own rows, an iterator of its other rows) of batches sorted by ``by_block``."""

    def each():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True)

    for key, group in groupby(each(), key=lambda r: (r[0], r[1])):
        lefts = []
        rest = iter(())
        for row in group:
            if not row[4]:
                rest = chain([row], group)
                break
            lefts.append(row)
        if lefts:
            yield key, lefts, rest


def root(forest: dict[int, int], x: int) -> int:
    while x in forest:
        x = forest[x]
    return x


def likely_members(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``in_blocks`` whose node has a likely partner of another group in the block.

    A pair counts in the first band only that both nodes share.
    """
    full = by_block(rows.join(nodes.select("node", "sketch", "bands"), "node").select(*rows.columns, "sketch", "bands"))

    def run(batches):
        for (band, _), lefts, rest in block_groups(batches, 7):
            comps = np.array([r[3] for r in lefts])
            sketch = np.stack([np.frombuffer(r[5], dtype="<u2") for r in lefts])
            bands = np.array([r[6] for r in lefts])
            wanted, out = np.zeros(len(lefts), dtype=bool), []
            for row in chain(lefts, rest):
                near = np.flatnonzero((comps != row[3]) & ((sketch == np.frombuffer(row[5], dtype="<u2")).mean(axis=1) >= SURE))
                if len(near):
                    shared = bands[near] == np.array(row[6])
                    first = bands[near, shared.argmax(axis=1)] == band
                    wanted[near[first]] = True
                    if not row[4] and first.any():
                        out.append(row[:5])
                if len(out) >= 4096:
                    yield told(out)
                    out = []
            out += [r[:5] for r, w in zip(lefts, wanted, strict=True) if w]
            if out:
                yield told(out)

    def told(some):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    names = ["band", "block", "node", "comp", "left"]
    return full.mapInArrow(run, "band long, block int, node long, comp long, left boolean")


def block_links(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among the nodes of each block, exact; as many as join all of its groups that are linked."""
    full = by_block(rows.join(texts, "node").select("band", "block", "node", "comp", "left", "text"))

    def run(batches):
        worker_cache_of("shingles")
        for _, lefts, rest in block_groups(batches, 6):
            ids, comps = np.array([r[2] for r in lefts]), np.array([r[3] for r in lefts])
            doc, key, count, check = shingle_counts([r[5].encode() for r in lefts], checked=True)
            total = np.bincount(doc, weights=count, minlength=len(lefts))
            order = np.argsort(key, kind="stable")
            doc, key, count, check = doc[order], key[order], count[order], check[order]
            found, met = [], {}  # groups linked so far in this block, as a forest
            for row in chain(lefts, rest):
                _, own, times, second = shingle_counts([row[5].encode()], checked=True)
                a, b = np.searchsorted(key, own, side="left"), np.searchsorted(key, own, side="right")
                n = b - a
                at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                equal = check[at] == np.repeat(second, n)
                both = np.bincount(doc[at], weights=np.minimum(count[at], np.repeat(times, n)) * equal, minlength=len(lefts))
                near = np.flatnonzero((comps != row[3]) & (both >= SIMILARITY * (total + times.sum() - both)))
                for i in near[np.unique(comps[near], return_index=True)[1]].tolist():
                    x, y = root(met, row[3]), root(met, int(comps[i]))
                    if x != y:
                        met[x] = y
                        found.append((row[2], int(ids[i])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return full.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, tie (hash of the text), class_id, group_id, kept.

    class_id is the least doc_id among the documents of the same word sequence; group_id the least among all
    documents linked by similarities of SIMILARITY or more between multisets of SHINGLE-word shingles, directly or
    through others.  A null text, or one without words, is like nothing: both ids are its own, it is kept.  Repeated rows are
    copies of each other; null ids are greater than all; an empty table gives no rows; other columns are not read.
    """
    rows = stored(sketches(docs), "sketches")
    known = rows.filter("words is not null")
    least = F.min_by(F.struct("doc_id", "tie"), F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("least")
    nodes = known.groupBy("words").agg(least, F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = nodes.select("words", "least.doc_id", "least.tie", "bands", "sketch")
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = stored(bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band"), "shared-bands")
    buckets = stored(bands.join(shared, "band"), "buckets")
    members = stored(buckets.select("node").distinct().join(nodes.select("node", "doc_id", "tie"), "node"), "members")
    members = members.select("node", F.col("doc_id").alias("member_id"), F.col("tie").alias("member_tie"))
    met = F.col("doc_id").eqNullSafe(F.col("member_id")) & (F.col("tie") == F.col("member_tie"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).join(members.hint("merge"), met).select("node", "text")
    texts = stored(texts, "member-texts")

    first, comps = None, None  # comps: labels of connected nodes, fewer after each kind of link
    for turn in range(MAX_STARS + 1):
        now = buckets.withColumn("comp", F.col("node"))
        if turn:
            now = stored(labelled(buckets, comps, "node", "comp"), "bucket-groups")
            open_ = stored(open_buckets(now), "open-buckets")
            blocks = F.col("total") * F.ceil(F.col("others") / BLOCK)
            cost = open_.agg(F.sum(blocks).alias("rows"), F.sum("total").alias("total")).first()
            if not cost["total"]:
                break
            if turn == MAX_STARS or cost["rows"] <= EXCESS * cost["total"]:
                likely = stored(likely_members(in_blocks(now, open_), nodes), "likely-members")
                comps = joined_groups(comps, stored(block_links(likely, texts), "links").unionByName(first), nodes)
                first = None
                break
        pairs = labelled(star_pairs(now, turn), comps, "b", "comp_b").filter("comp != comp_b").select("a", "b")
        links = stored(verified(stored(with_sketches(pairs, nodes), "likely-pairs"), texts), "links")
        if not turn:  # these labels need not be complete: the links are joined again with the next ones
            first, comps = links, components(links, 1)
        else:
            comps = joined_groups(comps, links.unionByName(first), nodes)
    if first is not None and comps is not None:
        comps = joined_groups(comps, first, nodes)

    grouped = nodes.select("words", "node", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie").alias("least"))
    grouped = stored(labelled(grouped, comps, "node", "comp").select("words", "least", "comp"), "node-groups")
    groups = stored(grouped.groupBy("comp").agg(F.min("least").alias("first")), "groups")
    named = grouped.join(groups, "comp").select("words", F.col("least.doc_id").alias("class_id"), "first")
    out = rows.select("doc_id", "tie", "words").join(stored(named, "named-nodes"), "words", "left")
    alone = F.col("words").isNull()
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tie") == F.col("first.tie"))
    return out.select(
        "doc_id",
        "tie",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("group_id"),
        (alone | chosen).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps: the least document of each group, once if rows repeat.

    Documents without words are all kept.  All columns stay, whatever their names.
    """
    found = stored(near_duplicates(docs), "near-duplicates")
    keys = found.filter("kept").groupBy("doc_id", "tie").agg(F.count("*").alias("n"))
    name, kept_id, kept_tie, n = (free_name(c, docs) for c in ("text_hash", "kept_id", "kept_tie", "kept_rows"))
    keys = stored(keys.select(F.col("doc_id").alias(kept_id), F.col("tie").alias(kept_tie), F.col("n").alias(n)), "kept")
    rows = docs.withColumn(name, F.xxhash64("text"))
    met = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(name) == F.col(kept_tie))
    out = rows.join(keys.filter(F.col(n) == 1).hint("merge"), met, "left_semi")
    if keys.filter(F.col(n) > 1).limit(1).count():  # rows of one id and text
        again = rows.join(keys.filter(F.col(n) > 1), met, "left_semi")
        worded = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), NO_WORD, "")) > 0
        out = out.unionByName(again.filter(worded).dropDuplicates(["doc_id", name])).unionByName(again.filter(~worded))
    return out.select(*docs.columns)


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "group_id")


QUERIES = {"op5_near_dup": op5_near_dup}
