"""Session, table access and lineage cutting shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_scratch: dict[str, str] = {}


def get_spark(app: str = "kiteloom", cores: str = "*") -> SparkSession:
    """A local session with the settings tests and the bench use; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() or 8) if cores == "*" else cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; in local mode without it, a temporary folder of this process.

    On a cluster without the setting this raises: a folder of one machine would not survive the loss of an executor.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _own_scratch:
        path = tempfile.mkdtemp(prefix="kiteloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _own_scratch[key] = path
    return _own_scratch[key]


class Scratch:
    """Tables written to the shared folder to cut lineage; they survive the loss of executors.

    ``cut`` writes a frame and returns it read back; ``drop`` deletes tables that are no longer read. What is left is
    deleted when the driver ends.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.base = f"{scratch_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        atexit.register(self._forget)

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := df.__dict__.pop("_scratch_path", None):
                self._delete(path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _forget(self) -> None:
        local = self.base.removeprefix("file://")
        if os.path.isdir(local):
            shutil.rmtree(local, ignore_errors=True)
            return
        try:
            self._delete(self.base)
        except Exception:  # the session may be gone already
            pass
