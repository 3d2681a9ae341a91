"""Session helpers: UTC pinning and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def pin_utc(spark: SparkSession) -> SparkSession:
    """All event-time arithmetic here assumes a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="blocktide-"))
    return sc.getCheckpointDir().rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/blocktide/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder; return it read back, and its row count.

    Cuts the lineage durably (executor loss costs nothing), gives the
    optimizer real file sizes, and the count decides what may be broadcast.
    """
    spark = df.sparkSession
    path = new_work_dir(spark, name)
    size = Observation()
    df.observe(size, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), size.get.get("rows", 0)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library wrote earlier (old state versions)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(hadoop_path, True)


def child_names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.globStatus(hadoop_path) or []]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there: written beside its place, then renamed."""
    jvm = spark._jvm
    target, fresh = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.fresh")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(fresh, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    source = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = source.getFileSystem(spark._jsc.hadoopConfiguration()).open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; False if somebody else wrote it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        return False
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True
