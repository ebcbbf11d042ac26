"""Session, table loading and lineage helpers shared by every operator."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


ROWS_PER_BATCH = 400
BYTES_PER_BATCH = 8 << 20


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "grist") -> SparkSession:
    """Builder with the settings every job here relies on.

    AQE stays on so the runtime can coalesce small shuffle partitions and
    split skewed sort-merge joins; the explicit hot-key handling in
    ``operators.skew`` does not depend on it but benefits from it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # checkpoints go when nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    ensure_checkpoint_dir(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Session settings the text operators rely on for speed.

    ``lower`` on non-ASCII text goes through ICU case mapping by default in
    Spark 4, about six times slower than the JVM's own full Unicode mapping
    (same results on the scripts we handle); every classifier feature and the
    dedup normalisation lower-case whole documents.

    Arrow batches have at most ``ROWS_PER_BATCH`` rows and ``BYTES_PER_BATCH`` bytes:
    a worker's memory follows its batch, whose words and numbers take many times
    the text's size, so the batch must not grow with the partition.
    """
    spark.conf.set("spark.sql.icu.caseMappings.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def release_memory() -> None:
    """Give back what earlier batches used: a Python worker outlives its tasks, and
    neither Arrow's pool nor the C library returns freed memory by itself."""
    pa.default_memory_pool().release_unused()
    trim = libc().malloc_trim if hasattr(libc(), "malloc_trim") else None     # of the GNU C library
    if trim:
        trim(0)


@lru_cache(1)
def libc() -> ctypes.CDLL:
    return ctypes.CDLL(None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system); a
    machine-local folder would not survive the loss of an executor. Only in
    local mode (tests, benches) do we create one when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):         # local-cluster is a cluster
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for lineage cuts")
    local = tempfile.mkdtemp(prefix="grist-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage there: an executor lost later costs no recomputation, and
    a table used twice is made once. The files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one driver table, narrowed to ``columns``; the scan's own splits
    decide the parallelism, at every size, and nothing is kept in memory.

    A caller whose files have fewer row groups than it has cores may set
    ``spark.grist.spread`` to the number of partitions that rows are dealt to
    after the scan (one shuffle of the table). It is unset by default: large
    tables have splits enough."""
    tune(spark)
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    df = df.select(*columns) if columns else df
    spread = spark.conf.get("spark.grist.spread", None)
    return df.repartition(int(spread)) if spread else df
