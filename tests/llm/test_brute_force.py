"""The queries at the smallest tables against plain Python over the same rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from sparkwork.llm import license_scan, near_dup, packing, token_ids, tokens

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
ODD_TEXTS = [
    "", " ", "\n", "a  b", " a", "a ", "a\n b", "a \nb", "a\n\nb", "a\tb  c\n", "it's  I'll\n\n x", "<|endoftext|> a<|endoftext|>",
    "é é́x", "a ́b", "a b 　c", "\x1c \x1d a\x1cb", "ABC Éa", "x" * 1000, "日本 語。 x\n\n",
    "a\r\nb", "  \n  lead", "1 2 34 a1b2 ... !!", "a​b ﻿", "nul\0nul", "×a÷b, ßx.",
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def table(name, columns):
    return duckdb.connect().execute(f"select {columns} from '{SF_SMALL}/{name}.parquet' order by 1").fetchall()


@pytest.fixture(scope="module")
def texts():
    return table("documents", "doc_id, text")


@pytest.fixture(scope="module")
def result(spark):
    return lambda name: [r.asDict() for r in E.queries()[name](spark, SF_SMALL).collect()]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_as_the_whole(name, texts):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    batch = ODD_TEXTS + [t or "" for _, t in texts]
    made = tokens.PieceEncoder(path)
    assert made.kind in ("byte", "word")
    for _ in range(2):  # the second time from the cache
        for text, ids in zip(batch, made.encode(batch), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_long_text_is_encoded_in_parts(texts, monkeypatch):
    monkeypatch.setattr(tokens, "LONG", 5000)
    made = tokens.PieceEncoder(token_ids.BYTE_BPE)
    text = " ".join(t for _, t in texts if t)
    assert made.encode([text])[0].tolist() == made.tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("counts", [{5: 3}, {1: 1, 2: 1}, {i: 1 for i in range(300)}, {i: 2**i for i in range(40)}])
def test_huffman_round_trip(counts):
    lengths = token_ids.code_lengths(counts)
    assert sum(2.0**-b for b in lengths.values()) <= 1 and max(lengths.values()) <= token_ids.MAX_BITS
    order, bits, codes = token_ids.canonical(lengths)
    code_of = np.zeros((2, int(order.max()) + 1), dtype=np.int64)
    code_of[0, order], code_of[1, order] = codes, bits
    ids = np.random.default_rng(1).choice(order, 1000)
    at, payload = token_ids.encode_bits(code_of[0, ids], code_of[1, ids])
    top = int(bits.max())
    look_up = np.zeros(1 << top, dtype=np.uint32)
    for t, b, c in zip(order.tolist(), bits.tolist(), codes.tolist(), strict=True):
        look_up[c << top - b : c + 1 << top - b] = t << 5 | b
    for every in (7, 64, 1000, 2000):
        assert (token_ids.decode_bits(payload, at[::every], len(ids), every, look_up, top) == ids).all()


def test_code_lengths_are_optimal_without_the_limit():
    counts = {i: int(c) for i, c in enumerate(np.random.default_rng(2).integers(1, 1000, 50))}
    heap = sorted(counts.values())
    cost = 0
    while len(heap) > 1:
        a, b = heap[:2]
        cost += a + b
        heap = sorted([*heap[2:], a + b])
    lengths = token_ids.code_lengths(counts)
    assert sum(counts[t] * b for t, b in lengths.items()) == cost


def encoded(name, texts, end):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    return {d: np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], dtype="<u4") for d, t in texts}


def test_op1(result, texts):
    got, start = {r["doc_id"]: r for r in result("op1_token_ids")}, 0
    for d, ids in encoded("byte_bpe_50k.json", texts, 0).items():
        r = got.pop(d)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_op2(result, texts):
    got = {r["doc_id"]: r for r in result("op2_license_scan")}
    for d, text in texts:
        w, r, found = words(text), got[d], []
        for phrase, label in license_scan.BASE.items():
            p = phrase.split()
            found += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
        assert (r["n_words"], r["n_base"]) == (len(w), len(found))
        assert (r["first_word"], r["last_word"]) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert {x for _, x in found} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


@pytest.mark.parametrize(
    "text, labels, score",
    [
        ("(MIT OR GPL-3.0-only) AND Apache-2.0", {"mit", "gpl", "apache"}, 0.9),
        ("MIT OR GPL-3.0-only AND Apache-2.0", {"mit", "gpl", "apache"}, 0.95),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0", {"gpl"}, 0.5),
        ("GPL-2.0+ and more words", {"gpl"}, None),
        ("MIT */ int main", {"mit"}, 0.95),
        ("CC-BY-NC-ND-4.0", {"cc-by", "cc-by-nc-nd"}, 0.1),  # the words "cc by" are a base phrase
        ("LicenseRef-mine OR MIT", {"licenseref", "mit"}, 0.95),
        ("mit and", None, None),
        ("(mit or", None, None),
        (") mit", None, None),
        ("mit-like", None, None),
        ("something", None, None),
        ("MIT WITH Apache-2.0", None, None),
        ("MIT AND Classpath-exception-2.0", None, None),
        ("", None, None),
    ],
)
def test_license_expressions(text, labels, score):
    out = license_scan.scan(f"// SPDX-License-Identifier: {text}\n".encode(), license_scan.automata())
    if labels is None or score is None:  # no whole expression
        assert out[5:] == ("", 0.0)
    else:
        assert set(out[5].split(",")) == labels and out[6] == pytest.approx(score)


def test_license_notices():
    scan = lambda t: license_scan.scan(t.encode(), license_scan.automata())[4:]
    assert scan("Dedicated to the public domain.") == ("", "public-domain", 1.0)
    assert scan("this is not public domain") == ("", "", 0.0)
    assert scan("not under the MIT License") == ("mit", "mit", 0.0) or scan("not an MIT License") == ("mit", "mit", 0.0)
    assert scan("MIT License. Redistribution and use in source and binary forms") == ("mit", "bsd,mit", 0.95)
    many = "SPDX-License-Identifier: MIT\r\nx SPDX-License-Identifier:GPL-3.0\nSPDX License Identifier: ISC"
    assert scan(many) == ("", "gpl,mit", 0.3)


def test_license_labels_of_whole_texts(result, texts):
    """Labels and score by plain search in the normalised words."""
    for r in result("op2_license_scan"):
        line = " " + " ".join(words(dict(texts)[r["doc_id"]])) + " "
        labels = {label for phrase, label in (license_scan.NOTICES | license_scan.BASE).items() if f" {phrase} " in line}
        if not any(f" {w} " in line for w in license_scan.NEGATIONS | {"spdx"}):
            assert r["labels"] == ",".join(sorted(labels))
            assert r["score"] == min((license_scan.FREEDOM[x] for x in labels), default=0.0)


def test_op3(result):
    rows = result("op3_language_id")
    lang = dict(table("documents", "doc_id, lang"))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert sum(r["rejected"] for r in rows) <= 0.03 * len(rows)


def test_op4(result, texts):
    ids, rows = encoded("word_bpe_49k.json", texts, 1), result("op4_packing")
    at, sequences = defaultdict(int), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(own)
        at[r["doc_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : at[r["doc_id"]]].tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert dict(at) == {d: len(x) for d, x in ids.items()}
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
        padding += 2048 - end if end & end - 1 else 0
    assert padding < 0.02 * sum(at.values())


def test_patterns_fill_and_never_overuse():
    rng = np.random.default_rng(5)
    demand = Counter((rng.integers(1, 257, 20_000)).tolist())
    patterns = packing.solve_patterns(dict(demand), 256)
    used = Counter()
    for pattern, k in patterns:
        assert sum(u * a for u, a in pattern.items()) <= 256 and k > 0
        used.update({u: a * k for u, a in pattern.items()})
    assert all(used[u] <= demand[u] for u in used)
    n = sum(k for _, k in patterns)
    assert sum(u * c for u, c in used.items()) > 0.985 * 256 * n
    assert sum(demand.values()) - sum(used.values()) < 3000


def test_op5(result, texts):
    shingles = {}
    for d, t in texts:
        w = words(t)
        shingles[d] = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])
    parent = {d: d for d in shingles}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    docs = sorted(shingles)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            both = (shingles[a] & shingles[b]).total()
            if both and both >= 0.8 * (shingles[a].total() + shingles[b].total() - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {r["doc_id"]: r["group_id"] for r in result("op5_near_dup")} == {d: root(d) for d in docs}


def test_links_by_band_of_similarity(spark):
    """sf0.01: every pair at 0.8 or more is in one group; groups join nothing else than such pairs do."""
    rows = duckdb.connect().execute("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    shingles, holders = {}, defaultdict(list)
    for d, t in rows:
        w = words(t)
        shingles[d] = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])
        for s in shingles[d]:
            holders[s].append(d)
    pairs = {(a, b) for held in holders.values() for i, a in enumerate(held) for b in held[i + 1 :]}
    parent = {d: d for d in shingles}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    bands = Counter()
    for a, b in pairs:
        both = (shingles[a] & shingles[b]).total()
        value = both / (shingles[a].total() + shingles[b].total() - both)
        bands[min(int(value * 10), 9)] += 1
        if value >= 0.8:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["group_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert got == {d: root(d) for d in got}
    assert bands[8] + bands[9] > 50


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    a, b, truth = [], [], []
    for _ in range(200):
        x, y = rng.integers(0, 4, 60), rng.integers(0, 4, 60)
        y = np.where(rng.random(60) < rng.random(), x, y)
        pair = [" ".join(f"u{i} v{i} w{i} x{i} y{i}" for i, n in enumerate(z) for _ in range(n)) for z in (x, y)]
        counts = [dict(zip(*near_dup.shingle_counts([p.encode()])[1:], strict=True)) for p in pair]
        keys = set(counts[0]) | set(counts[1])
        low = sum(min(counts[0].get(k, 0), counts[1].get(k, 0)) for k in keys)
        truth.append(low / sum(max(counts[0].get(k, 0), counts[1].get(k, 0)) for k in keys))
        a.append(pair[0].encode())
        b.append(pair[1].encode())
    truth = np.array(truth)
    error = (near_dup.signatures(a) == near_dup.signatures(b)).mean(axis=1) - truth
    assert abs(error.mean()) < 0.012
    assert np.sqrt((error**2).mean()) < 1.25 * np.sqrt((truth * (1 - truth) / near_dup.COMPONENTS).mean())


def test_large_buckets_of_several_groups(spark, monkeypatch):
    """A chain and stars whose links only the exhaustive rounds find, with tiny blocks and a single star round."""
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    monkeypatch.setattr(near_dup, "MAX_STARS", 1)
    monkeypatch.setattr(near_dup, "STAR_SALT", 2)
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(40):  # each differs from the one before in some places: near neighbours are similar, far ones not
        rows.append((k, " ".join(base)))
        for i in rng.choice(200, 3, replace=False):
            base[i] = f"n{k}x{i}"
    shingles = {d: set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for d, t in rows}
    parent = list(range(40))

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i in range(40):
        for j in range(i):
            if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["group_id"] for r in got} == {d: root(d) for d in range(40)}


def test_op6(result, texts):
    windows = defaultdict(set)
    for item, text in table("benchmark", "item_id, text"):
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    sizes = {len(w) for w in windows}
    got = {r["doc_id"]: r for r in result("op6_decontaminate")}
    for d, text in texts:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    items |= found
        r, listed = got[d], ",".join(sorted(map(str, items)))
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(w), len(hit), len(items), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


def test_automaton_against_windows():
    from sparkwork.llm.decontaminate import SuffixAutomaton, merged

    rng = np.random.default_rng(8)
    for _ in range(60):
        items = [(i, [b"%d" % x for x in rng.integers(0, 3, rng.integers(1, 12))]) for i in range(6)]
        doc = [b"%d" % x for x in rng.integers(0, 4, 60)]
        hit, found = set(), set()
        for item, w in items:
            n = min(len(w), 4)
            for k in range(len(w) - n + 1):
                for i in range(len(doc) - n + 1):
                    if doc[i : i + n] == w[k : k + n]:
                        hit |= set(range(i, i + n))
                        found.add(item)
        spans, ids = SuffixAutomaton(items, 4).find(doc)
        assert {i for a, b in spans for i in range(a, b)} == hit and ids == found
        assert merged(spans) == merged([list(s) for s in spans])


def test_op8(result, texts):
    got = {r["doc_id"]: r for r in result("op8_fingerprint")}
    order, prints = sorted(texts, reverse=True), defaultdict(set)
    for i, (d, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        k, r = len(text) // 2, got[d]
        edited = text[: len(text) - k] + following[:k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints[text].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len({*map(min, prints.values())}) == len(prints)
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.25 > np.mean([r["near_next"] for r in got.values()])


def test_fingerprints_add_and_take_out_paragraphs():
    from sparkwork.llm.fingerprint import as_text, combined, vectors

    def one(text):
        exact, sketch = vectors([text.encode()])
        return as_text(exact[0], sketch[0])

    a, b = "first line here\nand a second", "a third, longer line of words"
    assert one(f"{a}\n{b}") == one(f"{b}\n{a}") == combined(one(a), one(b))
    assert combined(one(f"{b}\n{a}"), one(b), -1) == one(a) != one(b)


def test_op10(result):
    quality = dict(table("labels", "doc_id, quality"))
    rows = [r for r in result("op10_quality") if r["doc_id"] in quality]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    good = [r["score"] for r in held if quality[r["doc_id"]] == 1]
    bad = [r["score"] for r in held if quality[r["doc_id"]] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_language_scores_by_compression_anew(spark, result, texts):
    """Each text compressed again, chunk by chunk, with dictionaries made of all learned texts in the order of their hashes."""
    import zstandard

    from sparkwork.llm import language_id

    rows = {r["doc_id"]: r for r in result("op3_language_id")}
    learned = defaultdict(dict)
    for d, t, lang in table("documents", "doc_id, text, lang"):
        if t is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            learned[lang][t] = learned[lang].get(t, 0) + 1
    assert all(len(v) <= language_id.SAMPLE_DOCS for v in learned.values())  # so every text is in its dictionary
    hashes = {r[0]: r[1] for r in spark.createDataFrame([(t,) for t in {t for v in learned.values() for t in v}], "t string").select("t", F.xxhash64("t")).collect()}
    held = {}
    for lang, some in learned.items():
        data = b" ".join(language_id.normal(x.encode()) for x in sorted(some, key=hashes.get))
        held[lang] = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held[lang].precompute_compress(level=language_id.LEVEL)

    def size(words, lang):
        made = zstandard.ZstdCompressor(dict_data=held[lang], write_checksum=False, write_content_size=False)
        return sum(len(made.compress(words[a : a + language_id.CHUNK])) for a in range(0, len(words), language_id.CHUNK))

    for d, t in texts:
        r = rows[d]
        if not t or not any(map(str.isalpha, t)):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        sizes = sorted((size(language_id.normal(t.encode()), lang), -sum(some.values()), lang) for lang, some in learned.items())
        assert r["lang_pred"] == sizes[0][2] and r["score"] == pytest.approx(1 - sizes[0][0] / sizes[1][0])
        assert r["rejected"] == (r["score"] < language_id.MIN_MARGIN)


def test_quality_scores_by_features_one_by_one(spark, texts):
    """The score of a text is the logistic function of the mean of its features' numbers plus the bias."""
    from sparkwork.llm import quality
    from sparkwork.llm.common import hashed_words, span_words

    rng = np.random.default_rng(1)
    model = rng.normal(size=quality.BUCKETS), 0.3

    def one(raw):
        spans = [(m.start(), m.end()) for m in re.finditer(rb"[^\x00-\x20]+", raw)]
        found, last = [], None
        for a, b in spans:
            w = hashed_words(span_words(np.frombuffer(raw, dtype=np.uint8), np.array([a]), np.array([b])))
            found.append(int(quality.bucket(w, 0)[0]))
            if last == raw[a:b]:
                found.append(quality.BUCKETS - 1)
            last = raw[a:b]
        line = raw + b"\n"
        for n in quality.GRAMS:
            found += [int(quality.bucket(np.array([int.from_bytes(line[i : i + n], "little")], dtype=np.uint64), n)[0]) for i in range(len(line) - n + 1)]
        return 1 / (1 + np.exp(-(np.mean([model[0][f] for f in found] or [0.0]) + model[1])))

    some = [t for _, t in texts if t and len(t) < 600][:40] + ["", "a", "the the the", "x\ny"]
    got = quality.scores([t.encode() for t in some], model)
    assert np.allclose(got, [one(t.encode()) for t in some])


def test_blocks_of_items_find_what_one_block_finds(spark):
    from sparkwork.llm import decontaminate
    from sparkwork.sources.tables import read_table

    docs, items = read_table(spark, SF_SMALL, "documents").select("doc_id", "text"), read_table(spark, SF_SMALL, "benchmark")
    docs = docs.unionByName(docs.limit(20)).withColumn("spans", F.lit(1))
    made = {n: decontaminate.mark_hits(docs, items, "hits", block_words=n) for n in (10**6, 30)}
    one, many = (sorted((r["doc_id"], r["spans"], r["hits"].asDict()) for r in df.collect()) for df in made.values())
    assert decontaminate.item_blocks(items, 30, 10)[1] >= 50
    assert many == one and any(h["spans"] for _, _, h in one)
    for df in made.values():  # one Python worker a task, whatever the number of blocks
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1


def test_a_long_item_is_cut_without_losing_a_window(spark):
    from sparkwork.llm import decontaminate

    item = [f"w{i}" for i in range(500)]
    docs = [(i, " ".join(["x", *item[i : i + 10], "y"])) for i in range(491)]
    made = decontaminate.mark_hits(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"), "hits", block_words=20,
    )
    rows = made.select("hits.*").collect()
    assert len(rows) == 491 and all(r["spans"] == [[1, 11]] and r["items"] == [7] for r in rows)


def thue_morse(a, b, n=1024):
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


def test_words_that_a_polynomial_hash_confuses(spark):
    """Thue-Morse words of 1,024 letters and of swapped letters: equal under any polynomial hash modulo 2^64."""
    pair = [thue_morse("a", "b"), thue_morse("b", "a")]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        made = tokens.PieceEncoder(public_tokenizers.path(name))
        for text in (pair, pair[::-1], [" ".join(pair)]):
            assert [i.tolist() for i in made.encode(text)] == [made.tok.encode(t, add_special_tokens=False).ids for t in text]
    docs = spark.createDataFrame(list(enumerate(pair + pair)), "doc_id long, text string")
    assert {r["doc_id"]: r["group_id"] for r in near_dup.near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 0, 3: 1}
    assert sorted(r["doc_id"] for r in near_dup.keep_one(docs).collect()) == [0, 1]


def test_names_that_agree_are_compared(monkeypatch):
    """With names of two bits only, pieces of one name get others."""
    plain = tokens.hashed_words
    monkeypatch.setattr(tokens, "hashed_words", lambda w, salt: plain(w, salt) >> np.uint64(62 if salt < 3 else 0))
    made = tokens.PieceEncoder(token_ids.BYTE_BPE)
    for text in ("one two three four five six", "seven one, and two more words", "again one two"):
        assert made.encode([text])[0].tolist() == made.tok.encode(text, add_special_tokens=False).ids
    assert made.salt == 3


def test_span_words_tell_spans_apart():
    data = np.frombuffer(b"abcdefgh" * 6, dtype=np.uint8)
    spans = [(a, b) for a in range(48) for b in range(a + 1, 49)]
    at, to = np.array(spans).T
    words = list(zip(*(w.tolist() for w in tokens.span_words(data, at, to)), strict=True))
    raw = data.tobytes()
    assert len({(w, raw[a:b]) for w, (a, b) in zip(words, spans, strict=True)}) == len(set(words)) == len({raw[a:b] for a, b in spans})


def test_packing_keeps_large_ids_beside_null_ones(spark):
    ids = [None, 2**60 + 1, 2**60 + 3]
    rows = packing.pack(spark.createDataFrame([(i, "some text of a few words") for i in ids], "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in rows} == set(ids)


def test_leftovers_of_patterns_are_bounded():
    for demand in ({1: 10**6, 255: 1}, {128: 3, 129: 10**5, 127: 10**5 - 1}, {k: 7 for k in range(1, 257)}, {200: 10**7}):
        left = Counter(demand)
        for pattern, k in packing.solve_patterns(demand, 256):
            for u, a in pattern.items():
                left[u] -= a * k
        assert min(left.values()) >= 0
        assert sum(u * n for u, n in left.items()) <= (len(demand) + 1) * 256
