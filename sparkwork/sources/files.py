"""Readers and writers for the reference's text formats.

All readers are ``spark.read`` scans with explicit schemas (no inference pass) and
parse with built-in expressions; malformed records fail the job (FAILFAST), as the
reference's parsers raise on the first bad line.  Writers refuse to overwrite.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import literals as L
from ..session import _bytes as session_bytes

# what runs inside tasks is pickled by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed pattern: a pair "(TERM, VAL)"; the term is a Python string literal or bare characters.
PAIR_PATTERN = rf"^\s*\(\s*(?:({L.STRING})|([^'\",]*?))\s*,\s*([^,()]*?)\s*,?\s*\)\s*$"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value): one row per line of the files."""
    return spark.read.text(_paths(path))


def read_docs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(doc, text): one row per file, the file path as the document key.  For files that fit a row."""
    df = spark.read.text(_paths(paths), wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("doc"), F.col("value").alias("text"))


def read_doc_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(doc, text): one row per line, the file path as the document key; a large file is read by several tasks.

    Files without a line have no row: ``list_docs`` has all.
    """
    df = spark.read.text(_paths(paths))
    return _fewer_tasks(df.select(F.col("_metadata.file_path").alias("doc"), F.col("value").alias("text")))


def _fewer_tasks(scan: DataFrame) -> DataFrame:
    """A scan of many small files with as many tasks as its bytes call for, four per core at least.

    Spark counts each file as 4 MB (``spark.sql.files.openCostInBytes``), so a task would read a handful.  No file is
    split or moved: a task reads more of the scan's partitions, one after another.
    """
    spark = scan.sparkSession
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    each = session_bytes(str(spark.conf.get("spark.sql.files.maxPartitionBytes", "128MB")))
    most = max(4 * spark.sparkContext.defaultParallelism, math.ceil(4 * size / each))
    return scan.coalesce(most) if scan.rdd.getNumPartitions() > most else scan


def list_docs(spark: SparkSession, paths: str | Sequence[str], scan: DataFrame | None = None) -> DataFrame:
    """(doc): the path of every file, empty ones too, from the listing that a scan makes on the driver anyway.

    ``scan`` is what ``read_doc_lines`` gave for the paths; its listing is used then.  The paths come to Python as one string,
    as each element of a Java array is a call.
    """
    if scan is None:
        scan = spark.read.option("recursiveFileLookup", "true").text(_paths(paths))
    paths = spark._jvm.org.apache.hadoop.util.StringUtils.join("\n", scan._jdf.inputFiles())  # as URLs: none holds a newline
    return spark.createDataFrame(pa.table({"doc": pa.array(paths.split("\n") if paths else [], pa.string())}))


def write_docs(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> None:
    """Write each document as one text file, all of them in one folder; the rows of a key are the lines of its file.

    A folder per document would be listed by a task of its own.  In a ``file:`` folder (one that all machines share, as any
    checkpoint folder) the tasks write the files themselves, see ``_write_files``.  Elsewhere Spark's writer does, and its
    tasks move their files into place (the committer's second algorithm): the driver would move them one by one.
    """
    rows = docs.groupBy(doc).agg(F.array_join(F.collect_list(F.coalesce(text, F.lit(""))), "\n").alias("value"))
    spark = docs.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        if fs.exists(where):
            raise FileExistsError(path)
        fs.mkdirs(where)
        _write_files(rows.select(F.col(doc).cast("string").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")), where.toUri().getPath())
        return
    one = rows.select("value").write.mode("errorifexists").option("maxRecordsPerFile", 1)
    one.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)


def _write_files(rows: DataFrame, folder: str) -> None:
    """Write each (key, value) as a file of ``folder``, named by the key, which is unique.

    Hadoop's local file system starts a process (chmod) for each file and for each checksum, some 10 ms each.  A file
    is written under another name and then renamed, so a task that runs again leaves the same files.
    """

    def write(batches):
        for batch in batches:
            for key, value in zip(batch["key"], batch["value"], strict=True):
                # a NULL key is no text
                name = "null" if not key.is_valid else "key-" + hashlib.sha256(key.as_buffer()).hexdigest()
                part = os.path.join(folder, f"_{name}-{os.urandom(6).hex()}")
                with open(part, "xb") as f:
                    f.write(value.as_buffer())
                    f.write(b"\n")
                os.replace(part, os.path.join(folder, f"{name}.txt"))
            yield pa.record_batch({"n": pa.array([len(batch)], pa.int64())})

    rows.mapInArrow(write, "n bigint").agg(F.sum("n")).first()


def _checked(rows: DataFrame, parsed, ok, what: str) -> DataFrame:
    """The fields of the struct ``parsed`` of rows that are ``ok``; any other row fails the job.

    The guard is a filter over the parsed line, so it holds whatever columns a query
    reads, ``count()`` included: column pruning cannot take it away.  A generator makes the struct: the
    optimizer would copy a projected one into the guard and into every field read, and parse the line as often.
    """
    guard = F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"malformed {what} line: "), F.col("value"))).cast("boolean")
    )
    # nullable fields would let the optimizer drop a guard on a constant; the line itself is not one
    return rows.select("*", F.explode(F.array(parsed)).alias("_row")).where(guard).drop("value")


RATING_PATTERN = r"^\s*([+-]?\d+)\s*,\s*([+-]?\d+)\s*,\s*([^,]+?)\s*$"


def _rating_rows(raw: DataFrame) -> DataFrame:
    def part(k: int, kind: str):
        return F.regexp_extract("value", RATING_PATTERN, k).try_cast(kind)

    row = F.struct(part(1, "bigint").alias("i"), part(2, "bigint").alias("j"), part(3, "double").alias("r"))
    ok = F.col("_row.i").isNotNull() & F.col("_row.j").isNotNull() & F.col("_row.r").isNotNull()
    return _checked(raw.where(F.trim("value") != ""), row, ok, "rating")


def read_ratings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(i, j, r) from ``i,j,r`` lines."""
    return _rating_rows(read_lines(spark, path)).select("_row.*")


def _fold_lines(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """(value, fold) of the folds 0 ... k-1 below ``folder``; fold from the file path.

    Folds are files or folders ``fold0``, ``fold1``, ..., all of which must be there, or folders ``fold=0``, ``fold=1``, ...
    as ``write_folds`` makes them, where an empty fold has none.
    """
    rows = spark.read.option("recursiveFileLookup", "true").text(f"{folder.rstrip('/')}/fold*")
    found = [m for f in rows.inputFiles() if (m := re.search(r"/fold(=|%3D)?(\d+)(/[^/]*)?$", f))]
    named = {int(m[2]) for m in found if not m[1]}
    if named and (missing := set(range(k)) - named):
        raise FileNotFoundError(f"folds {sorted(missing)} are missing in {folder}")
    fold = F.regexp_extract(F.col("_metadata.file_path"), r"/fold(?:=|%3D)?(\d+)(/[^/]*)?$", 1).try_cast("int")
    return rows.select("value", fold.alias("fold")).where(F.col("fold") < k)


def write_folds(df: DataFrame, folder: str, value: str = "value", fold: str = "fold") -> None:
    """Write lines with their fold as text, one folder ``fold=<n>`` per fold, in one pass over ``df``."""
    write_table(df.select(F.col(value).alias("value"), F.col(fold).alias("fold")), folder, "text", partition_by=["fold"])


def make_folds(spark: SparkSession, path: str | Sequence[str], folder: str, k: int = 5, seed: int | str = 42) -> None:
    """Split the lines of text files into ``k`` folds by their hash and write them below ``folder``, in one job.

    Equal lines go to one fold.  Empty lines are dropped.
    """
    lines = read_lines(spark, path).where(F.col("value") != "")
    write_folds(lines.select("value", H.bucket(k, F.lit(str(seed)), F.col("value")).cast("int").alias("fold")), folder)


def read_folds(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """(i, j, r, fold) from fold folders of ``i,j,r`` lines."""
    return _rating_rows(_fold_lines(spark, folder, k)).select("_row.*", "fold")


def _labelled_rows(raw: DataFrame) -> DataFrame:
    ok = F.col("_row").isNotNull() & F.col("_row.x").isNotNull() & F.col("_row.y").isNotNull()
    cut = raw.where(F.trim("value") != "").select("*", F.inline(F.array(L.plain_parts(F.col("value")))))
    cut = cut.select("*", F.inline(F.array(L.plain_pairs(F.col("_body")))))
    rows = _checked(cut, L.labelled_of_parts(F.col("value")), ok, "labelled")
    return rows.drop("_body", "_label", "_names", "_values", "_rest")


def read_labelled(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(x: map<string,double>, y: double) from ``({feature: value, ...}, y)`` lines.

    Read as Python literals (never evaluated as code): string keys with prefixes and escapes, number keys, trailing
    commas.  A line that does not parse fails the job.
    """
    return _labelled_rows(read_lines(spark, path)).select("_row.*")


def read_labelled_folds(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """(x, y, fold) from fold folders of labelled lines."""
    return _labelled_rows(_fold_lines(spark, folder, k)).select("_row.*", "fold")


def read_pairs(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(term, val) from ``(TERM, VAL)`` lines."""
    raw = read_lines(spark, path).where(F.trim("value") != "")
    literal, bare, val = (F.regexp_extract("value", PAIR_PATTERN, k) for k in (1, 2, 3))
    term = F.when(literal != "", L.string(literal)).otherwise(bare)
    row = F.struct(term.alias("term"), F.trim(val).try_cast("double").alias("val"))
    return _checked(raw, row, F.col("_row.val").isNotNull(), "pair").select("_row.*")


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """(feature, beta) model table."""
    return spark.read.parquet(path).select("feature", "beta")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> None:
    """Write ``df`` as parquet (default), csv or text; an existing path is an error.

    ``partition_by`` writes one sub-folder per value of those columns.
    """
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.csv(path)
    elif fmt == "text":
        w.text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_model(beta: DataFrame, path: str) -> None:
    """Write a (feature, beta) model as parquet."""
    write_table(beta.select("feature", "beta"), path, "parquet")


def pair_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """(value: string) lines ``('key', value)`` for the text sink; whatever the key holds, ``read_pairs`` restores it."""
    return df.select(F.concat(F.lit("("), L.quoted(F.col(key)), F.lit(", "), F.col(value).cast("string"), F.lit(")")).alias("value"))


def labelled_lines(X: DataFrame, E: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(value: string, keep...) lines ``({"feature": value, ...}, y)`` for (id, feature, value) and (id, y, keep...).

    One line per example; its map holds the example's own features only.  A label that
    is a whole number is written without a fraction.
    """
    maps = X.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("x"))
    rows = E.join(maps, "id", "left")
    body = F.coalesce(F.to_json("x"), F.lit("{}"))
    y = F.col("y")
    whole = y.cast("long")
    label = F.when(y == whole, whole.cast("string")).otherwise(y.cast("string"))
    return rows.select(F.format_string("(%s, %s)", body, label).alias("value"), *keep)
