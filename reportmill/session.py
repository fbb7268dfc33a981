"""Session settings sized from the data, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

MIB = 1 << 20

_local_dirs: dict[str, str] = {}


def session_conf(
    data_bytes: int, cores: int, split_bytes: int | None = None, reducer_bytes: int = 256 * MIB
) -> dict[str, str]:
    """Spark settings for an input of ``data_bytes`` on ``cores`` executor cores.

    Input splits grow with the data, from 128 MiB, so that there are at most 100,000 map tasks;
    ``split_bytes`` sets another size. The shuffle starts from one reducer per ``reducer_bytes``
    at any size of the data, so a reducer's share does not grow; adaptive execution merges the
    small ones and splits the skewed ones.
    """
    split = split_bytes or max(128 * MIB, data_bytes // 100_000)
    reducers = max(cores, -(-data_bytes // reducer_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(reducer_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }


def build_session(
    app_name: str, master: str | None = None, data_bytes: int = 0, cores: int = 8, **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**session_conf(data_bytes, cores), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir``, a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="reportmill-")
    return _local_dirs[context.applicationId]


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop path object for ``path`` and the file system it lies on."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    location, files = hadoop_path(spark, path)
    return files.exists(location)


def work_dir(spark: SparkSession) -> str:
    """A new folder under :func:`shared_dir`, removed when the Spark application ends."""
    location, files = hadoop_path(spark, f"{shared_dir(spark)}/run-{uuid.uuid4().hex}")
    files.mkdirs(location)
    files.deleteOnExit(location)
    return location.toString()


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = f"{work_dir(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
