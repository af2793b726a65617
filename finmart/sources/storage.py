"""Questions to the file system that Spark itself uses for a path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; any other trouble (rights, network) raises."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty if the folder isn't there."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def publish_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file that appears whole or not at all: written under another
    name, then renamed; an existing file of that name is never replaced."""
    fs, p = _fs(spark, f"{folder}/{name}")
    fs.mkdirs(p.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".draft-{name}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p) or not fs.rename(draft, p):
        raise FileExistsError(f"{folder}/{name} is already published")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
