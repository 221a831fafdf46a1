"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # larger generated methods are not compiled by the JIT
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole pages and texts travel in Arrow batches, which also have a limit in bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # a checkpoint goes when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "filingframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master falls
    back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="filingframe-checkpoint-")
    context.setCheckpointDir(own)
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt in turn to as many tasks as a shuffle has, or as there are cores, for work that is long a row.

    The number is fixed, as adaptive execution joins tasks by their bytes, not by their work.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), cores))


#: Folder of each table that `materialise` gave out and nobody has dropped.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialise(df: DataFrame, name: str, replaces: DataFrame | None = None) -> DataFrame:
    """Write an intermediate result once as a table in the shared folder and read it back.

    For results that several branches of a job use: each branch then reads only
    its own columns, and a lost executor costs a re-read, not a recomputation.
    Tables lie in a folder of the application; ``replaces`` is a table that nothing
    needs any more once this one is written, as in the rounds of an iteration.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if replaces is not None:
        drop(replaces)
    table = spark.read.parquet(path)
    _FOLDERS[table] = path
    return table


def drop(table: DataFrame) -> None:
    """Delete a table that :func:`materialise` gave out; other frames are left alone."""
    path = _FOLDERS.pop(table, None)
    if path:
        jvm = table.sparkSession._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        configuration = table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(configuration).delete(folder, True)
