"""Single files on whatever file system a path names, through Hadoop's own clients, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop's objects."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A whole file; FileNotFoundError if it is missing. For files that fit the driver."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream))
    finally:
        stream.close()


class Writer:
    """Text to one file, in pieces; the file appears under its name when it is whole."""

    PIECE = 1 << 20

    def __init__(self, spark: SparkSession, path: str):
        self.fs, self.path = file_system(spark, path)
        self.beside = file_system(spark, f"{path}.part")[1]
        self.stream = self.fs.create(self.beside, True)
        self.held: list[str] = []
        self.size = 0

    def write(self, text: str) -> None:
        self.held.append(text)
        self.size += len(text)
        if self.size >= self.PIECE:
            self._flush()

    def _flush(self) -> None:
        data = "".join(self.held).encode("utf-8")
        self.stream.write(data, 0, len(data))
        self.held, self.size = [], 0

    def __enter__(self) -> "Writer":
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self._flush()
        self.stream.close()
        if kind is not None:
            self.fs.delete(self.beside, False)
            return
        self.fs.delete(self.path, False)
        self.fs.rename(self.beside, self.path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    with Writer(spark, path) as f:
        f.write(text)
