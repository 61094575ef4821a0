"""Session helpers: a local session for tests and benches, and the
checkpoint directory that operators needing a lineage cut rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "quire") -> SparkSession:
    """A local-mode session configured the way the tests and bench expect.

    On a cluster, build the session with the cluster's own settings instead;
    every operator only assumes a working ``spark.checkpoint.dir``.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # checkpoint files of DataFrames that went out of scope are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint directory the session already uses, if any."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return conf
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir`` and that is
    what we use. Only a local-mode session without one (tests, bench) gets a
    fresh scratch folder of its own.
    """
    current = checkpoint_dir(spark)
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS, S3, ...) "
            "so that lineage cuts survive the loss of executors")
    path = tempfile.mkdtemp(prefix="quire-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path for scratch data below the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have an existing scratch path removed when the driver ends (results
    that read it are lazy, so it cannot go earlier)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)


def pin(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint folder and read it
    from there: for an intermediate that several branches of a plan consume
    (each would otherwise recompute it from the raw text). The table is
    shared storage, so it survives lost executors; consumers read only the
    columns they need, and no session setting is touched."""
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
