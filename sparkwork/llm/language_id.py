"""Language identification by compression: the language whose dictionary shortens a text most.

For each language a raw-content zstandard dictionary is made from a bounded sample of
labelled texts.  A whole text, reduced to its words, is cut into chunks; each chunk is
compressed with every dictionary, and the language of the smallest sum wins.  The
score is the relative margin to the second; a narrow margin is a rejection.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut_lineage, sized_broadcast
from ..sources.tables import read_table
from .common import WORD_BYTES, doc_bucket, worker_cache_of

SAMPLE_DOCS = 192  # distinct labelled texts per language, those of the smallest hash
DRAWN = 4  # times as many are drawn before they are ranked
CHUNK = 1024  # bytes compressed at once: small beside the dictionary, so that it decides
LEVEL = 6  # of compression, for texts of every size
MIN_MARGIN = 0.002  # a smaller share of bytes between the first and the second language is no decision
UNKNOWN = "und"
SCHEMA = "lang_pred string, score double, rejected boolean"


def normal(raw: bytes) -> bytes:
    return b" ".join(raw.translate(WORD_BYTES).split())


def train(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """[(language, dictionary)], the most frequent language first (it wins ties).

    Takes rows of text and lang; the sample of a language are the SAMPLE_DOCS distinct texts of the least hashes, whole.
    It is drawn from the DRAWN times as many texts that the least hashes are expected to be, and drawn again from
    more if a language falls short.
    """
    rows = labelled.filter("lang is not null and text is not null").withColumn("h", F.xxhash64("text"))
    texts = rows.groupBy("lang", "h").agg(F.count("*").alias("n"))  # the copies of a text share its hash
    counts = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("n_texts"))
    counts = sized_broadcast(cut_lineage(counts), row_bytes=128)  # a row per language
    order = Window.partitionBy("lang").orderBy("h")
    unit = F.col("h") / F.lit(2.0**64) + 0.5  # the hash as a number from 0 to 1: the first texts have the least
    texts = rows.select("lang", "h", "text").join(counts, "lang")
    n_texts = {r["lang"]: r["n_texts"] for r in counts.collect()}
    out: dict[str, list[bytes]] = {}
    drawn = DRAWN
    while any(len(out.get(lang, [])) < min(SAMPLE_DOCS, n) for lang, n in n_texts.items()):
        sample = (
            texts.filter(unit <= F.lit(float(drawn * SAMPLE_DOCS)) / F.col("n_texts"))  # bounds a language's task
            .groupBy("lang", "n", "h")
            .agg(F.min("text").alias("text"))
            .withColumn("k", F.row_number().over(order))
            .filter(F.col("k") <= SAMPLE_DOCS)
            .orderBy(F.desc("n"), "lang", "k")
        )
        out = {}
        for r in sample.collect():  # bounded by the sample
            out.setdefault(r["lang"], []).append(normal(r["text"].encode()))
        drawn *= 4
    return [(lang, b" ".join(parts)) for lang, parts in out.items()]


def classify(raw: bytes, models: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    """(language, score, rejected) of a text in UTF-8."""
    if not models or not any(map(str.isalpha, raw.decode("utf-8", "replace"))):
        return UNKNOWN, 0.0, True
    words = normal(raw)
    chunks = [words[a : a + CHUNK] for a in range(0, len(words), CHUNK)] or [raw]
    sizes = [(sum(len(m[1].compress(c)) for c in chunks), i) for i, m in enumerate(models)]
    best, second = sorted(sizes)[:2] if len(sizes) > 1 else (sizes[0], (2 * sizes[0][0], 0))
    score = 1 - best[0] / second[0]
    return models[best[1]][0], score, score < MIN_MARGIN


def compressors(dictionaries: list[tuple[str, bytes]]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    """(language, compressor) of each dictionary."""

    def made(data: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(data or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=held, write_checksum=False, write_content_size=False)

    return [(lang, made(data)) for lang, data in dictionaries]


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], name: str = "lid") -> DataFrame:
    """``docs`` with a struct column ``name``: lang_pred, score (0 to 1), rejected.

    A null text, or one without a letter, is ``und``, score 0, rejected; so is every text if no language
    was learned.  Every row and column is kept; nothing is shuffled.
    """
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType.fromDDL(SCHEMA))])
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        worker_cache_of("languages")  # frees what another operator left
        models = compressors(dictionaries)
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            found = [classify(t.as_py() or b"", models) for t in texts]
            rows = [dict(zip(("lang_pred", "score", "rejected"), f, strict=True)) for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from; a null id is learned from."""
    return F.coalesce(doc_bucket(doc_id, 4) == 2, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    dictionaries = train(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), dictionaries).select(
        "doc_id", held_out().alias("held_out"), "lid.lang_pred", "lid.score", "lid.rejected"
    )


QUERIES = {"op3_language_id": op3_language_id}
