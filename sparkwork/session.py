"""Session-level helpers: checkpoint location, lineage cuts, size-checked broadcast.

The library never creates a session for the caller; these helpers only read
what the session owner configured.  ``local_session`` exists for tests and the
bench script.
"""

from __future__ import annotations

import gc
import os
import tempfile
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "sparkwork") -> SparkSession:
    """A local session for tests and benchmarks (never used by the library itself)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's current setting).  Only a
    local-mode session without one gets a fresh temporary folder; on a cluster an
    unset folder is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")
    folder = tempfile.mkdtemp(prefix="sparkwork-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


class ScratchScope:
    """Owns the scratch tables and checkpoints made while it is open, and deletes them when it is closed.

    ``with scratch_scope(spark): ...`` around a job and whatever reads its result (scopes nest; a table belongs to the
    innermost one).  A DataFrame that outlives the scope must not read what was deleted: write it elsewhere, collect it, or
    hand its tables on with ``keep``.  Without a scope tables stay until the folder's owner removes them.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> ScratchScope:
        _SCOPES.append(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, whose files now belong to the scope around this one (or to none)."""
        files = {unquote(f) for f in df.inputFiles()}
        # without the scheme, which one may write with one slash and the other with three
        mine = [p for p in self.paths if any(p.split(":", 1)[-1].lstrip("/") in f for f in files)]
        self.paths = [p for p in self.paths if p not in mine]
        at = _SCOPES.index(self)
        if at:
            _SCOPES[at - 1].paths += mine
        return df

    def __exit__(self, *failed) -> None:
        _SCOPES.remove(self)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


_SCOPES: list[ScratchScope] = []


def scratch_scope(spark: SparkSession) -> ScratchScope:
    return ScratchScope(spark)


def _owned(path: str) -> None:
    if _SCOPES:
        _SCOPES[-1].paths.append(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables; it belongs to the open scope."""
    base = checkpoint_dir(spark)
    token = os.urandom(6).hex()
    path = f"{base.rstrip('/')}/sparkwork-{name}-{token}"
    _owned(path)
    return path


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(``df`` read from a table in the shared checkpoint folder, its path): for large tables that only one job reads.

    A checkpoint holds serialised rows, a parquet table compressed columns.  It goes with ``drop_scratch``, or when its
    scope ends.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_scratch(spark: SparkSession, path: str | None) -> None:
    """Delete a scratch table before its scope ends."""
    if path is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release_unused(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints that nothing refers to any more.

    It does so once the driver has collected its garbage, which a driver that only plans hardly ever does: the files of
    all finished steps would stay on the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return a short-lineage copy.

    Reliable checkpoints survive lost executors (unlike local checkpoints).  The copy does not
    tell its partitioning to later plans: an aggregation or join on the same key shuffles it again.
    """
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _SCOPES:
        file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            _owned(file.get())
    return out


def _bytes(raw: str) -> int:
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def broadcast_limit_bytes(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (``-1`` disables broadcasting)."""
    return _bytes(str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")))


def advisory_partition_bytes(spark: SparkSession) -> int:
    """The session's target partition size (AQE coalescing and skew splitting)."""
    return _bytes(str(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")))


def fits_broadcast(spark: SparkSession, rows: int, row_bytes: int) -> bool:
    """True when ``rows`` rows of about ``row_bytes`` bytes stay under the broadcast threshold."""
    limit = broadcast_limit_bytes(spark)
    return limit > 0 and rows * row_bytes <= limit


def sized_broadcast(small: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """Mark ``small`` for broadcast only when its measured size is under the threshold.

    ``rows`` is the known row count of ``small`` (for a materialised table); when it is
    not given, one count job measures it.  Above the bound the frame is returned
    unchanged and Catalyst/AQE choose a shuffle join (with skew splitting).
    """
    n = small.count() if rows is None else rows
    if fits_broadcast(small.sparkSession, n, row_bytes):
        return F.broadcast(small)
    return small


def spread_small_input(df: DataFrame) -> DataFrame:
    """Round-robin a freshly read table over the cores when it has fewer splits than cores.

    For CPU-heavy per-row work (tokenising long texts, vector scoring) on an input of
    a few large splits.  A large input already has many splits and is returned
    unchanged, so no shuffle is added at scale.  Call it on a source scan only:
    asking a plan that contains shuffles for its partition count would run them.
    The explicit partition count is kept by AQE.
    """
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


MODEL_NUMBERS = 1 << 25  # 256 MB of doubles


def check_model_size(numbers: int, what: str) -> None:
    """Raise if a model that plans read as one scalar row has more numbers than a task should hold."""
    if numbers > MODEL_NUMBERS:
        raise ValueError(f"{what} has {numbers} numbers, more than the {MODEL_NUMBERS} that are read as one row")
