"""Session defaults, the shared scratch location, and stages written to it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What the operators rely on. `build_session` sets these; on a session made elsewhere `require` says what is missing.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_LOCAL: dict[str, str] = {}


def build_session(app_name: str = "fathomline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on. Cluster sizing stays with the cluster."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one named by spark.checkpoint.dir.

    Where it is absent, a session on one machine (`local[...]`) gets a temporary folder; on any other master this is an
    error, since each executor would write to a disk of its own. The session's settings are not changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="fathomline-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _file_system(spark: SparkSession, path: str, encoded: bool = False):
    """A path and the file system it is on; `encoded` for paths as Spark's file metadata gives them."""
    fs = spark._jvm.org.apache.hadoop.fs
    target = fs.Path(spark._jvm.java.net.URI(path)) if encoded else fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _file_system(spark, path)
    return system.exists(target)


def remove_path(spark: SparkSession, path: str, encoded: bool = False) -> bool:
    """Delete a folder, on whichever file system it is; False where there was nothing to delete."""
    target, system = _file_system(spark, path, encoded)
    return system.delete(target, True)


class Stages:
    """Intermediate tables of one job, in the shared folder.

    `write` runs the job that fills the table at once (so a caller pays for it when the frame is built, not when it is
    read) and returns the table read back: lineage ends there and a lost executor loses nothing. `remove` deletes a table
    that no later step reads; used as a context manager, everything that is left goes at the end.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def put(self, df: DataFrame, name: str, *by: str) -> str:
        """Write df as `write` does, in subfolders by the values of columns; returns the folder, for tasks that open files."""
        path = scratch_path(self.spark, name)
        df.write.partitionBy(*by).parquet(path)
        self.paths[name] = path
        return path

    def remove(self, *names: str) -> None:
        for name in names or tuple(self.paths):
            remove_path(self.spark, self.paths.pop(name))

    def keep(self, *names: str) -> None:
        """Delete all tables but these: no later step reads the others."""
        for name in set(self.paths) - set(names):
            self.remove(name)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *exc: object) -> None:
        self.remove()


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df once to the shared folder and read it back (see Stages.write); its files stay until the folder is cleaned."""
    return Stages(df.sparkSession).write(df, name)
