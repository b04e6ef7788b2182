"""Shared working folder: where fitted tables and cut lineage are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session may go
    without one; a cluster must name a folder that all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared)
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors.")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="gableframe-")
        spark.sparkContext.setCheckpointDir(_local_folder[app])
    return _local_folder[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{workspace(spark)}/gableframe/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage, survives lost executors, and gives
    the optimizer true sizes. For fitted tables, which are far smaller than
    the data they were fitted on."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that nobody has created yet; False when it is there
    already. Of several writers exactly one gets True, on any file system that
    creates exclusively (HDFS and its like; local disks through the Java call that
    is atomic there, which Hadoop's own local file system is not)."""
    from py4j.protocol import Py4JJavaError

    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(place.getParent())
    if system.getUri().getScheme() == "file":
        return jvm.java.io.File(place.toUri().getPath()).createNewFile()
    try:
        system.create(place, False).close()
    except Py4JJavaError as error:
        if system.exists(place):
            return False
        raise error
    return True


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, on any file system Spark knows. The
    file system is asked; nothing below the path is listed."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
