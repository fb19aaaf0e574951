"""Repeated ids, rows and words: nothing of them is lost."""

import numpy as np
import pytest

from sparkwork.llm import decontaminate, fingerprint, quality


def test_short_items_of_one_id_are_all_hit():
    long = [b"w%d" % i for i in range(12)]
    items = [(None, [b"a", b"b"]), (None, [b"c", b"d"]), (7, [b"e", b"f"]), (7, long), (8, [b"g"]), (8, [b"h", b"i"])]
    found = decontaminate.SuffixAutomaton(items, 10)
    for _, words in items:
        assert found.find([b"x", *words, b"x"])[0] == [(1, 1 + len(words))]
    assert found.find([b"e", b"f", b"g"])[1] == {7, 8}


def test_quality_sample_holds_a_document_once(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, f"text of {i} {k}") for i in range(20) for k in range(4 if i < 8 else 1)] * 3, "doc_id long, text string"
    )
    labels = [(i, i % 2) for i in range(20) for _ in range(50 if i < 8 else 1)]
    seen = []
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 6)
    monkeypatch.setattr(quality, "train", lambda raws, y, prior: seen.append((raws, y, prior)) or (np.zeros(1), 0.0))
    quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    quality.fit(docs, spark.createDataFrame(labels[::-1], "doc_id long, quality int"))
    (raws, y, prior), again = seen
    assert len({r.split()[2] for r in raws}) == len(raws) == 12 and sorted(y) == [0] * 6 + [1] * 6
    assert again == (raws, y, prior) and prior == 0


def test_likeness_of_many_repeats():
    (_, many), (_, some) = (tuple(v[0] for v in fingerprint.vectors([b"one two three " * n])) for n in (40_000, 20_000))
    assert np.abs(many.astype(int)).max() >= 39_998
    different = np.zeros(fingerprint.EXACT), np.ones(fingerprint.EXACT)
    assert fingerprint.likeness((different[0], many), (different[1], some)) == pytest.approx(2 / 3, abs=0.01)
    both = fingerprint.from_text(fingerprint.combined(*[fingerprint.as_text(np.zeros(fingerprint.EXACT), s) for s in (many, some)]))
    assert (both[1] == many.astype(int) + some).all()
