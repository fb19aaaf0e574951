"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage reads what the stage before wrote.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwork.llm import decontaminate, language_id, line_dedup, near_dup, packing
from sparkwork.llm.common import free_name, stored
from sparkwork.sources.tables import read_table

#: SQL has no tokenizer and no compressor; the stages are tested against brute force
ORACLE_SQL = None


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those whose language the margin does not settle.

    Null and empty texts have no letter; repeated rows are judged each; an empty table gives none; columns stay.
    """
    dictionaries = language_id.train(docs.filter(~language_id.held_out()))
    name = free_name("lid", docs)
    return language_id.identify(docs, dictionaries, name).filter(~F.col(f"{name}.rejected")).select(*docs.columns)


#: of a document's characters, as many may go as later copies; one that loses more is a copy itself, not a text with some
MAX_COPIED = 0.5


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later copies of repeated line runs; a document of which more than half is copies goes whole.

    What is left of a copy, the lines in which it differs, would be no text; a null or empty text has no copies and stays.
    """
    n_lines, n_removed, before = (free_name(c, docs) for c in ("n_lines", "n_removed", "n_before"))
    out = line_dedup.dedup_lines(docs.withColumn(before, F.length("text")))
    cut = F.col(n_removed) > 0
    left = ~cut | ((F.trim(F.replace("text", F.lit("\n"), F.lit(""))) != "") & (F.length("text") >= (1 - MAX_COPIED) * F.col(before)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.filter(left).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates; of repeated rows one; every document without words."""
    return near_dup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of test items; a document that is mostly such passages goes.

    Null and empty texts and repeated rows stay as they are; without items nothing changes; columns stay.
    """
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise what is left and pack it into sequences: every id of every row, a null or empty text's end id too."""
    return packing.pack(docs)


STAGES = [
    ("language_id", languages),
    ("line_dedup", lines),
    ("near_dup", near_duplicates),
    ("decontaminate", benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = out if stage is pack else stored(out, f"pipeline-{name}")
    return docs
