"""Word count over a growing folder of text files (Structured Streaming).

The same tokeniser as the batch ``word_count``; the running counts live in the
state store, partitioned by word across executors.  Each micro-batch's complete
result is written with ``foreachBatch`` to a folder of its own, ``epoch=<n>`` (file sinks only accept
append mode, which an unwindowed count cannot use); readers take the newest folder that is
complete, so a reader never sees a half-written result, and the one before the newest stays for those that
still read it.  Restarting with the same checkpoint location resumes after lost executors or drivers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_words
from ..session import scratch_path


def running_word_count(lines: DataFrame) -> DataFrame:
    """(word, n) over a streaming DataFrame of ``value`` lines."""
    words = lines.select(F.explode(split_words("value")).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    where, files = _files(spark, path)
    files.delete(where, True)


def _epochs(spark: SparkSession, output: str) -> list[tuple[int, str]]:
    """(epoch, path) of the complete results below ``output``, in order."""
    pattern, files = _files(spark, f"{output}/epoch=*/_SUCCESS")
    paths = [s.getPath().getParent().toString() for s in files.globStatus(pattern) or []]
    return sorted((int(p.rsplit("=", 1)[1]), p) for p in paths)


def latest_counts(spark: SparkSession, output: str) -> DataFrame:
    """(word, n) of the newest complete result below ``output``; none yet is an empty table."""
    found = _epochs(spark, output)
    if not found:
        return spark.createDataFrame([], "word string, n long")
    return spark.read.parquet(found[-1][1])


def word_count_stream(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
):
    """Start the streaming word count from ``source`` into epoch folders below ``output`` (see ``latest_counts``).

    ``available_now=True`` processes every file present and stops (batch-like runs
    with exactly-once bookkeeping); otherwise the query keeps running.  Returns the
    ``StreamingQuery``.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = running_word_count(reader.load(source))

    def publish(batch: DataFrame, epoch: int) -> None:
        # complete once Spark's job commit has written _SUCCESS; an epoch that is run again replaces its own folder
        batch.write.mode("overwrite").parquet(f"{output}/epoch={epoch}")
        for old, path in _epochs(spark, output):
            if old < epoch - 1:
                _delete(spark, path)

    writer = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
