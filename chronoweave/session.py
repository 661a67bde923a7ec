"""Session helpers: a local session for tests/bench, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "chronoweave") -> SparkSession:
    """Local session used by tests and the bench (the cluster supplies its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the deployment sets it, on a file system that the driver and all executors
    share; without it this raises, since a folder of the driver's machine would be another one
    on every executor.  Only under a local master, where there is one machine, a private
    temporary folder is made, and removed when Python exits."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="chronoweave-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local(master: str) -> bool:
    """One JVM on one machine (``local``, ``local[8]``), not ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for a written intermediate table."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    path = f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application has written so far (call it when
    the results built on them have been written); returns how many there were."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        fs, hpath = _file_system(spark, path)
        fs.delete(hpath, True)
    return len(paths)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence as Spark's own readers and writers see it: a path without a scheme belongs to
    the default file system."""
    fs, hpath = _file_system(spark, path)
    return bool(fs.exists(hpath))


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already (one of several writers succeeds)."""
    fs, hpath = _file_system(spark, path)
    if fs.exists(hpath):
        return False
    try:
        fs.create(hpath, False).close()
    except Py4JJavaError:
        return False
    return True


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it is not there)."""
    fs, hpath = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def is_flat_folder(spark: SparkSession, path: str) -> bool:
    """A folder that is there and holds no folder of data."""
    fs, hpath = _file_system(spark, path)
    return bool(fs.exists(hpath)) and fs.getFileStatus(hpath).isDirectory() and not any(
        s.isDirectory() and not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def qualified_path(spark: SparkSession, path: str) -> str:
    """A path as the scan's file metadata writes it: with scheme, escaped as a URI."""
    fs, hpath = _file_system(spark, path)
    return fs.makeQualified(hpath).toUri().toString()


def materialized(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back: the lineage
    is cut (lost executors re-read the table instead of recomputing its plan) and later plans
    built on it stay short.  One job, unlike ``Dataset.checkpoint`` which computes twice.  A filter on
    ``partition_by`` columns reads only the folders that it needs."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not partition_by:
        df.write.parquet(path)
        return spark.read.parquet(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
