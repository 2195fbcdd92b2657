"""Small path helpers on the cluster's own file system (names only, never data)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def rename_children(spark: SparkSession, root: str, old: str, new: str, ending: str) -> None:
    """Give files in the folders below `root` another prefix and ending."""
    fs, p = _fs(spark, root)
    for folder in fs.listStatus(p):
        for f in fs.listStatus(folder.getPath()) if folder.isDirectory() else []:
            name = f.getPath().getName()
            if name.startswith(old):
                stem = name.removeprefix(old).rsplit(".", 1)[0]
                fs.rename(f.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder.getPath(), new + stem + ending))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def files_and_bytes(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and size of the data files below a folder."""
    fs, p = _fs(spark, path)
    sizes = [s.getLen() for s in fs.listStatus(p) if not s.getPath().getName().startswith((".", "_"))]
    return len(sizes), sum(sizes)


def create_once(spark: SparkSession, path: str) -> None:
    """Create an empty file; fails when somebody else created it first."""
    fs, p = _fs(spark, path)
    fs.create(p, False).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; fails when somebody else wrote it first."""
    fs, p = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p) or not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
