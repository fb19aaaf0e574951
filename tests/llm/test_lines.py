"""Line dedup against brute force over maximal runs, with and without a floor on their words."""

import random

import duckdb
import pytest

from sparkwork.llm import line_dedup


def removed(docs, min_words):
    """{doc_id: kept text}: every run of lines that also stands earlier and has enough words is deleted."""
    lines = [(d, i, t.strip(" ")) for d, text in docs for i, t in enumerate(text.split("\n")) if t.strip(" ")]
    gone = set()
    for s in range(len(lines)):
        for t in range(s):
            n = 0
            while (
                s + n < len(lines) and t + n < len(lines) and lines[s + n][0] == lines[s][0] and lines[t + n][0] == lines[t][0]
                and lines[s + n][2] == lines[t + n][2]
            ):
                n += 1
            if n and sum(len(x.split(" ")) for _, _, x in lines[s : s + n]) >= min_words:
                gone |= {(d, i) for d, i, _ in lines[s : s + n]}
    return {d: "\n".join(x for i, x in enumerate(text.split("\n")) if (d, i) not in gone) for d, text in docs}


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    words = ["a b c", "d", "e f", "g h i j", "k", "", "  "]
    base = [rng.choice(words) + rng.choice(["", " x", " y"]) for _ in range(60)]
    out = [(i, "\n".join(rng.choices(base, k=rng.randrange(1, 12)))) for i in range(25)]
    out += [(30, "\n".join(base)), (31, "new\n" + "\n".join(base[5:40]) + "\nother"), (32, "\n".join(["same line"] * 37))]
    return out


@pytest.mark.parametrize("min_words", [1, 4, 9, 40])
def test_equals_brute_force_over_maximal_runs(spark, docs, min_words):
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words).collect()
    assert {r["doc_id"]: r["text"] for r in got} == removed(docs, min_words)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    assert {d: t for d, t, *_ in con.execute(line_dedup.oracle(min_words)).fetchall()} == removed(docs, min_words)


def test_suffix_array_is_sorted_and_doubling_goes_on(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = line_dedup.suffix_array(df).collect()
    lines = {}
    for r in line_dedup.numbered_lines(df).collect():
        lines[r["doc_id"], r["line"]] = (r["h"], r["g"]), r["place"]
    at = {p: k for k, (_, p) in lines.items()}
    ids = {p: h for h, p in lines.values()}

    def suffix(p, n):
        return [ids[q] for q in range(p, p + n) if q in at and at[q][0] == at[p][0]]

    repeats = {h for h in ids.values() if list(ids.values()).count(h) > 1}
    assert {r["place"] for r in rows} == {p for p, h in ids.items() if h in repeats}
    assert max(r["lines"] for r in rows) == 32  # of runs of 33 and more lines
    for a, b in zip(rows, rows[1:], strict=False):
        n = min(a["lines"], b["lines"])
        assert suffix(a["place"], n) <= suffix(b["place"], n)
    runs = [tuple(suffix(p, r["lines"])) for r in rows for p in [r["place"]]]
    assert all(len(x) == r["lines"] for x, r in zip(runs, rows, strict=True))
