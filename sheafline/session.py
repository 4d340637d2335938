"""Session helpers: table reading, spreading small inputs, and stage tables in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Upper bound of an Arrow batch handed to Python, so that a batch of long texts fits a worker.
ARROW_BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on this machine alone (tests) a temporary folder is
    made, removed when Python ends; on a cluster the setting is required.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="sheafline-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        sc.setCheckpointDir(at)
    return at


def stage(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder, in a folder a value of ``by``, and return the table: lineage ends here.

    A lost executor costs at most the tasks it ran, never an earlier stage.
    """
    spark = df.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/sheafline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out._stage = at
    return out


def unstage(*tables: DataFrame) -> None:
    """Remove stage tables that nothing reads any more, so that a long job's disk use stays that of its live stages."""
    for df in tables:
        at = df.__dict__.pop("_stage", None)
        if at:
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input that arrives in fewer partitions than there are cores.

    An input that already has a partition per core is returned as it is, without a shuffle.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch unless the session already does."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        if int(spark.conf.get(key, "-1")) <= 0 or int(spark.conf.get(key)) > 1 << 30:
            spark.conf.set(key, str(ARROW_BATCH_BYTES))
    except Exception:  # noqa: BLE001 - older releases have no such setting
        pass
