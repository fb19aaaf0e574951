"""The pipeline at the smallest tables: each stage against what it is for."""

import re

import duckdb
import pytest

import corpus_pipeline
from sparkwork.llm import line_dedup
from sparkwork.llm.common import stored
from sparkwork.sources.tables import read_table

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def outputs(spark):
    """(input rows, output rows) of each stage by name."""
    docs, out = read_table(spark, SF_SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in made.collect()])
        docs = made
    return out


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dup", "decontaminate", "packing"]


def test_language_stage_only_drops(outputs):
    before, after = outputs["language_id"]
    known = {r["doc_id"]: r for r in before}
    assert all(known[r["doc_id"]] == r for r in after) and len(after) >= 0.95 * len(before)


def test_line_stage_leaves_no_line_twice_and_no_stub(outputs):
    before, after = outputs["line_dedup"]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(r["doc_id"], r["text"]) for r in before])
    rows = con.execute(line_dedup.ORACLE["op9_line_dedup"]).fetchall()
    long = {r["doc_id"]: len(r["text"] or "") for r in before}
    want = {d: text for d, text, _, removed in rows if not removed or (text.strip("\n ") and 2 * len(text) >= long[d])}
    assert len(want) > 0.6 * len(rows)
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_dup_stage_leaves_no_similar_pair_and_one_of_each_group(outputs):
    before, after = outputs["near_dup"]

    def shingles(text):
        w = WORD.findall(text.lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    kept = {r["doc_id"] for r in after}
    similar = lambda a, b: len(sets[a] & sets[b]) >= 0.78 * len(sets[a] | sets[b])  # noqa: E731  sets, not multisets
    for a in kept:
        assert not any(b < a and len(sets[a] & sets[b]) > 0.85 * len(sets[a] | sets[b]) for b in kept)
    for d in set(sets) - kept:
        assert any(similar(d, b) for b in sets if b != d)


def test_decontamination_stage_leaves_no_window(outputs):
    before, after = outputs["decontaminate"]
    items = duckdb.connect().execute(f"select text from '{SF_SMALL}/benchmark.parquet'").fetchall()
    windows = set()
    for (text,) in items:
        w = WORD.findall((text or "").lower())
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(w) for w in windows}

    def hit(text):
        w = WORD.findall(text.lower())
        return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    assert any(hit(r["text"]) for r in before) and not any(hit(r["text"]) for r in after)
    kept = {r["doc_id"]: r["text"] for r in after}
    assert all(kept[r["doc_id"]] == r["text"] for r in before if not hit(r["text"]))


def test_packing_stage_packs_every_document(outputs):
    before, after = outputs["packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    got = {}
    for r in after:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert all(got[r["doc_id"]] == r["doc_tokens"] for r in after)
