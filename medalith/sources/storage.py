"""File-system calls through the Hadoop client, so any path Spark can read works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly below ``path``, sorted; none when it does not exist."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def replace_folder(spark: SparkSession, staged: str, live: str) -> None:
    """Put a completely written folder in the place of ``live``."""
    fs, staged_path = _open(spark, staged)
    _, live_path = _open(spark, live)
    _, old_path = _open(spark, staged + "-old")
    had_live = fs.exists(live_path)
    if had_live and not fs.rename(live_path, old_path):
        raise OSError(f"cannot set aside {live}")
    if not fs.rename(staged_path, live_path):
        if had_live:
            fs.rename(old_path, live_path)
        raise OSError(f"cannot move {staged} to {live}")
    if had_live:
        fs.delete(old_path, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _open(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
