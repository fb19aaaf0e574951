"""Scratch tables of the operators, and conversations of many turns."""

import os
import tempfile

from pyspark.sql import functions as F

from sparkwork.llm import chat_format, line_dedup, near_dup
from sparkwork.session import scratch_scope


def test_scope_leaves_an_empty_folder_after_operators(spark):
    old, folder = spark.sparkContext.getCheckpointDir(), tempfile.mkdtemp(prefix="scope-")
    spark.sparkContext.setCheckpointDir(folder)
    try:
        rows = [(i, f"one two three four five six seven\nand line {i % 3}") for i in range(12)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        with scratch_scope(spark):
            assert near_dup.near_duplicates(docs).count() == 12
            assert line_dedup.dedup_lines(docs).count() == 12
            assert any(files for _, _, files in os.walk(folder))
        assert not any(files for _, _, files in os.walk(folder))
    finally:
        spark.sparkContext.setCheckpointDir(old)


def test_many_turns(spark):
    n = 20_000
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("<|im_sep|> é "), F.col("id").cast("string")).alias("text"),
    )
    (made,) = chat_format.read_chats(chat_format.format_chats(turns)).collect()
    assert len(made["turns"]) == n
    assert made["loss_text"] == "".join(f"<|im_sep|> é {i}" for i in range(n) if i % 3)


def test_other_spans_than_the_templates_are_cut_from_the_whole(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a<|b"), (1, 1, "assistant", "c\\d")], "conv_id int, turn int, role string, text string")
    made = chat_format.format_chats(turns)
    start = made.collect()[0]["formatted"].index("a<")
    spans = F.array(F.struct(F.lit(start).alias("start"), F.lit(5).alias("length")))
    (row,) = chat_format.read_chats(made.withColumn("loss_spans", spans)).collect()
    assert row["loss_text"] == "a<|b"
