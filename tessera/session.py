"""Session settings and shared scratch storage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Used only where ``spark.checkpoint.dir`` is unset and the master is local (tests, bench).
LOCAL_SCRATCH = "file:///tmp/checkpoints"


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A local master falls back to a folder under /tmp; a cluster without the setting is an error,
    since a machine-local folder would lose rows there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return LOCAL_SCRATCH


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized frame that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class AlreadyRunning(RuntimeError):
    """Another writer holds the folder."""


@contextmanager
def single_writer(spark: SparkSession, folder: str):
    """Hold a folder for one writer: a second one is refused at once.

    The mark is a file ``_writer``, created only if there is none. It stays if the driver is killed, and is then
    removed by hand, as no other driver can know that the first has ended.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_writer")
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.createNewFile(at):
        raise AlreadyRunning(f"{folder} has a writer; remove {at} if it has ended")
    try:
        yield
    finally:
        system.delete(at, False)
