"""Every operator on empty tables, nulls, empty and long texts, repeated rows and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkwork.llm import (
    chat_format,
    decontaminate,
    fingerprint,
    language_id,
    license_scan,
    line_dedup,
    near_dup,
    packing,
    quality,
    token_ids,
)
from sparkwork.session import scratch_path

LONG = "word and other words\n" * 60_000
ROWS = [
    (1, "A small text. With two sentences.", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, "A small text. With two sentences.", "en"),
    (4, "A small text. With two sentences.", "en"),
    (None, "Another text of no id, mit license.", "en"),
    (None, None, None),
    (5, "\n\n", "de"),
    (6, "ein kurzer text und noch ein wort", "de"),
    (7, "12 !! 34", "de"),
    (8, LONG, "en"),
]
SCHEMA = "doc_id long, text string, lang string"


def extra(df):
    """Columns whose names the operators use themselves."""
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(INTERNAL)])


#: every name that the operators give to a column of their own
INTERNAL = (
    "score n_words labels hits lid tie node start ids sketch n_removed removed chunk n_lines gone_id gone_tie kept_id kept_tie kept_rows "
    "text_hash text_key spans items known_key words bands comp block line place rank lang_pred rejected fingerprint length sequence_id"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    return extra(spark.createDataFrame(ROWS, SCHEMA))


@pytest.fixture(scope="module")
def none(spark):
    return extra(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "two words"), (2, None), (3, ""), (None, "no id"), (4, "a b c d e f g h i j k l"), (4, "a b c d e f g h i j k l")]
    return spark.createDataFrame(rows, "item_id long, text string")


def ids_round_trip(docs):
    spark = docs.sparkSession
    path = scratch_path(spark, "ids-test")
    token_ids.write_ids(docs, path)
    return token_ids.read_ids(spark, path)


def identified(docs):
    return language_id.identify(docs, language_id.train(docs), "found").select("doc_id", "found.*")


PER_ROW = {
    "token_ids": ids_round_trip,
    "licenses": license_scan.scan_licenses,
    "languages": identified,
    "fingerprints": fingerprint.fingerprints,
    "edited": fingerprint.edited_pairs,
    "lines": line_dedup.dedup_lines,
    "near": near_dup.near_duplicates,
    "quality": lambda d: quality.score_quality(d, quality.fit(d, d.selectExpr("doc_id", "1 as quality"))),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_result_per_row(docs, name):
    got = PER_ROW[name](docs).select("doc_id").collect()
    assert sorted(str(r[0]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", PER_ROW)
def test_no_result_of_an_empty_table(none, name):
    assert PER_ROW[name](none).collect() == []


def test_language_rejects_texts_without_letters(docs):
    rows = identified(docs).collect()
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {2, 3, 5, 7, None}
    assert all(r["rejected"] and r["score"] == 0 for r in rows if r["lang_pred"] == "und")


def test_near_duplicates_group_repeated_rows_and_keep_wordless_ones(docs):
    rows = near_dup.near_duplicates(docs).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [r["group_id"] for r in by_id[4]] == [1, 1] and by_id[1][0]["kept"] and not by_id[4][0]["kept"]
    assert all(r["group_id"] == i and r["kept"] for i in (2, 3, 5) for r in by_id[i])
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, None, None, 5, 6, 7, 8]))


def test_repeated_rows_leave_one(spark):
    rows = spark.createDataFrame([(1, "one two three four five six")] * 3 + [(2, None)] * 2, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_dup.keep_one(rows).collect()) == [1, 2, 2]


def test_packing_covers_every_id_once(docs, none):
    rows = packing.pack(docs, with_ids=True).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (2, 3)) == 2  # the end ids of no text
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(token_ids.unpacked(r["ids"])) == r["length"]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    assert packing.pack(none).collect() == []


def test_decontamination(docs, none, items):
    hits = decontaminate.mark_hits(docs, items, "found").select("doc_id", "found.*").collect()
    assert {r["doc_id"]: r["spans"] for r in hits if r["doc_id"] in (1, 6)} == {1: [], 6: []}
    assert [r["items"] for r in hits if r["n_words"] and r["spans"]] == [[]]  # "no id" hits the text without one
    assert decontaminate.decontaminate(docs, items).columns == docs.columns
    assert decontaminate.decontaminate(none, items).collect() == []
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == len(ROWS)


def test_chats(spark):
    rows = [
        (1, 0, "user", "hi <|im_end|> \\<|x"), (1, 1, "user", None), (1, 2, "assistant", "a\\"), (1, 2, "assistant", "a\\"),
        (1, None, "system", "first"), (None, 0, None, ""), (2, 0, "a\nb<|", "<\\|im_sep|>"),
    ]
    df = extra(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = chat_format.format_chats(df)
    got = {r["conv_id"]: r for r in chat_format.read_chats(made).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [
        ("system", "first"), ("user", "hi <|im_end|> \\<|x"), ("user", ""), ("assistant", "a\\"), ("assistant", "a\\"),
    ]
    assert got[1]["loss_text"] == "a\\a\\"
    assert [tuple(t) for t in got[2]["turns"]] == [("a\nb<|", "<\\|im_sep|>")] and [tuple(t) for t in got[None]["turns"]] == [("", "")]
    assert chat_format.format_chats(df.limit(0)).collect() == []


def test_quality_of_one_class_and_of_none(docs, spark):
    labels = spark.createDataFrame([(1, 1), (3, None), (6, 7)], "doc_id long, quality int")
    assert {r["score"] > 0.5 for r in quality.score_quality(docs, quality.fit(docs, labels)).collect()} == {True}
    assert {round(r["score"], 6) for r in quality.score_quality(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}


@pytest.mark.parametrize("stage", range(5))
def test_stages_keep_columns_and_take_empty_tables(spark, stage, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, "two words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(k, t, lang, "s", len(t or "")) for k, t, lang in ROWS[:-1]]
    _, run = corpus_pipeline.STAGES[stage]
    for some in (rows, []):
        docs = extra(spark.createDataFrame(some, schema))
        out = run(spark, docs, str(tmp_path))
        got = out.collect()
        if stage < 4:
            assert out.columns == docs.columns
            assert len(got) <= len(some)
            assert all(r[c] == i for r in got for i, c in enumerate(INTERNAL))
        else:
            assert {r["doc_id"] for r in got} == {k for k, *_ in some}
