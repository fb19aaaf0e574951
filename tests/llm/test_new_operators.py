"""Operators 11 to 13 against plain Python, and their results on odd inputs."""

import hashlib
import math
import random
import re
import string

import numpy as np
import pytest

from sparkwork.llm import lexical_search, secret_scan, whitening
from sparkwork.sources.tables import read_table

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ 11
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, best=20):
    """[(item_id, rank, doc_id, score)] by comparing all pairs."""
    docs = [(k, t) for k, text in docs if (t := terms(text))]
    n_docs, length = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in {(i, tuple(terms(t))) for i, t in items}:
        scores = []
        for k, t in docs:
            m, s = 75 + 25 * len(t) * n_docs // length, 0
            for w in text:
                if tf := t.count(w):
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if s > 0:
                scores.append((-s, k is None, k or 0, k))
        out += [(item, r, k, -s) for r, (s, _, _, k) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_equals_all_pairs(spark):
    docs = read_table(spark, SF, "documents")
    items = read_table(spark, SF, "benchmark")
    want = ranked([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(lexical_search.op11_lexical_search(spark, SF)) == want
    # in several blocks, long items by themselves
    assert found(lexical_search.search(docs, items, block_terms=60)) == want


def test_search_odd_rows(spark):
    texts = ["a b c", "A b C", "a-b c", None, "", "...", "é a", "a " * 3000, "x y z", "b b b b c", "a b c"]
    docs = [(i % 9 if i != 5 else None, t) for i, t in enumerate(texts)] + [(None, "a b")]
    items = [(1, "a b"), (1, "B b é"), (1, "a  B"), (None, "c"), (2, None), (3, "."), (4, "nowhere"), (5, "a " * 500 + "é")]
    rows = spark.createDataFrame([(*d, 0, 0.0) for d in docs], "doc_id long, text string, term int, impacts double")
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, rank int")
    for best in (1, 3, 20):
        assert found(lexical_search.search(rows, asked, best)) == ranked(docs, [i for i in items if terms(i[1])], best)
    assert found(lexical_search.search(rows.filter("false"), asked)) == []
    assert found(lexical_search.search(rows, asked.filter("false"))) == []


def test_tree_search_prunes_and_stays_exact():
    rng = np.random.default_rng(4)
    n_terms, n_docs, n_items, best = 300, 3000, 60, 5
    weights = []
    for i in range(n_items):  # items and documents of 30 topics of ten terms each, and some terms from anywhere
        t = np.unique(np.concatenate([rng.integers(0, 10, 8) + 10 * (i % 30), rng.integers(0, n_terms, 2)]))
        weights.append((t, rng.integers(1, 9000, len(t))))
    rows = [np.unique(np.concatenate([rng.integers(0, 10, 8) + 10 * (i * 30 // n_docs), rng.integers(0, n_terms, 2)])) for i in range(n_docs)]
    values = [rng.integers(1, 800_000, len(r)) for r in rows]
    search = lexical_search.Search(weights, n_terms, np.zeros(n_items, dtype=np.int64), best)
    for a in range(0, n_docs, 700):
        ends = np.cumsum([0] + [len(r) for r in rows[a : a + 700]])
        ids = np.arange(a, min(a + 700, n_docs))
        search.batch(ids, np.zeros(len(ids), bool), ends, np.concatenate(rows[a : a + 700]), np.concatenate(values[a : a + 700]))
    got = sorted(zip(*(c.to_pylist() for c in search.found().columns), strict=True))
    want = []
    for i, (t, w) in enumerate(weights):
        full = dict(zip(t.tolist(), w.tolist(), strict=True))
        s = [(-sum(full.get(c, 0) * v for c, v in zip(r.tolist(), x.tolist(), strict=True)), k) for k, (r, x) in enumerate(zip(rows, values, strict=True))]
        want += [(i, k, -x) for x, k in sorted(s)[:best] if x]
    assert got == sorted(want)
    assert search.scored < search.pairs / 10  # most pairs of leaves are dropped by bounds


# ------------------------------------------------------------------ 12
def whitened(vectors, components=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)) + 1e6
    n = len(x)
    z = x - x.sum(axis=0) / n
    values, q = np.linalg.eigh(z.T @ z / n)
    values, q = values[::-1], q[:, ::-1]
    return values / values.sum(), (z @ q[:, :components]) / np.sqrt(np.maximum(values[:components], 1e-300))


def same_up_to_sign(a, b, tolerance):
    sign = np.sign((a * b).sum(axis=0))
    return np.abs(a * sign - b).max() < tolerance


def test_whitening_equals_dense_eigenvectors(spark):
    rows = whitening.op12_whitening(spark, SF).collect()
    source = read_table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    source = [r for r in source if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    share, want = whitened([r[1] for r in source])
    got = np.zeros_like(want)
    place = {r[0]: i for i, r in enumerate(source)}
    assert len(rows) == len(source) * 32
    exact = np.floor(64 * np.array([r[1] for r in source], dtype=np.float64)).astype(np.int64) + 1_000_000
    deviation = ((len(exact) * exact - exact.sum(axis=0)) ** 2).sum(axis=1)
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(source) and r.deviation == deviation[place[r.vec_id]]
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    assert same_up_to_sign(got, want, 1e-8)


@pytest.mark.parametrize("shape", ["flat", "steep", "ties"])
def test_leading_eigenvectors_of_hard_spectra(shape):
    rng = np.random.default_rng(9)
    d, wanted = 200, 20
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"flat": np.linspace(1.07, 0.93, d), "steep": 10.0 ** -np.linspace(0, 12, d), "ties": np.repeat(np.arange(20, 0, -1.0), 10)}[shape]
    passes = []

    def apply(x):
        passes.append(x.shape[1])
        return (q * values) @ (q.T @ x)

    got, vectors = whitening.leading(apply, d, wanted, guard=8)
    assert np.abs(got - values[:wanted]).max() < 1e-10
    assert np.linalg.norm(apply(vectors) - vectors * got, axis=0).max() < 1e-9
    assert max(passes) == wanted + 8 and len(passes) < 400


def test_whitening_odd_rows(spark):
    good = [[float(i), float(i * i % 7), 1.0, float(i % 3)] for i in range(12)]
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, math.nan, 2.0, 3.0], [math.inf, 0.0, 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0, 0.0]]
    rows = [(i if i else None, v, "x") for i, v in enumerate(good + bad)] + [(3, good[3], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    out = whitening.whiten(df).collect()
    assert len(out) == 13 and all(len(r.whitened) == 3 and r.n == 13 for r in out)  # a constant dimension is no direction
    _, want = whitened([*good, good[3]], 3)
    got = sorted((r.vec_id is not None, r.vec_id or 0, r.whitened) for r in out)
    order = sorted(range(13), key=lambda i: [*range(12), 3][i])
    assert same_up_to_sign(np.array([g[2] for g in got]), want[order], 1e-9)
    assert whitening.whiten(df.filter("false")).collect() == []
    assert whitening.whiten(df.filter("embedding is null")).collect() == []
    one = whitening.whiten(df.filter("vec_id = 5")).collect()
    assert [(r.vec_id, r.whitened, int(r.deviation), r.identity_error) for r in one] == [(5, [], 0, 0.0)]


def test_whitening_of_large_entries(spark):
    values = [[2.0**46 * (-1) ** i, float(i)] for i in range(5)]
    out = whitening.whiten(spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in values]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((5 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in out} == want


# ------------------------------------------------------------------ 13
def base_spans(text):
    out = []
    kinds = [
        (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    for k, (pattern, keep) in enumerate(kinds):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if keep(m)]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets_of_whole_texts(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    rows = secret_scan.op13_secret_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == [s for s in want.split(",") if s]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(f"{k}:") for k in ("assign", "access", "hex"))


def test_random_strings_are_found_and_others_left():
    vocabulary = secret_scan.encoding(secret_scan.VOCABULARY)
    rng = random.Random(5)
    found = 0
    for _ in range(500):
        secret = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.randrange(24, 200)))
        spans = secret_scan.scan(f"the key (é) is {secret}, keep it", vocabulary)
        found += [s[:3] for s in spans if s[0] == "random"] == [("random", 15, 15 + len(secret))]
    assert found >= 495
    for plain in (
        "https://example.com/internationalization/characteristics", "550e8400-e29b-41d4-a716-446655440000", "getInternationalizedCharacterSequence",
        "da39a3ee5e6b4b0d3255bfef95601890afd80709".upper(), "4111-1111-1111-1111-4111-1111", "some_long_identifier_of_many_words",
        "Donaudampfschifffahrtsgesellschaft", "internationalisation-characteristics", "=" * 60, "-" * 60, "a" * 100_000,
    ):
        assert [s for s in secret_scan.scan(plain, vocabulary) if s[0] == "random"] == [], plain


def test_secret_rows_and_redaction(spark):
    blob = "".join(random.Random(1).choices(string.ascii_letters + string.digits, k=50_000))
    texts = [None, "", "ünïcode password: hunter2hunter2", "token=secret=abcdefgh", "ſecret = abcdefghij", "AKIA1234", "x " * 10 + blob, "x " * 10 + blob]
    df = spark.createDataFrame([(None if i == 2 else i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {(r.doc_id, tuple(tuple(s)[:3] for s in r.spans)) for r in secret_scan.find_secrets(df).collect()}
    assert got == {
        (0, ()), (1, ()), (None, (("assign", 8, 32),)), (3, (("assign", 0, 21),)), (4, ()), (5, ()),
        (6, (("random", 20, 50_020),)), (7, (("random", 20, 50_020),)),
    }
    out = secret_scan.redact(df)
    assert out.columns == df.columns
    assert {r.text for r in out.collect()} == {None, "", "ünïcode [secret]", "[secret]", "ſecret = abcdefghij", "AKIA1234", "x " * 10 + "[secret]"}
    assert secret_scan.find_secrets(df.filter("false")).collect() == []
