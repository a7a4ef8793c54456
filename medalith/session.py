"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, name: str = "medalith") -> SparkSession:
    """Single-machine session for tests and the bench. On a cluster, pass the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor sees: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of the machine, which goes
    when the session's process ends.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_roots:
        folder = tempfile.mkdtemp(prefix="medalith-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_roots[context.applicationId] = folder
    return _local_roots[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the shared root; Spark creates it on the first write."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(spark: SparkSession, df: DataFrame, label: str, **options) -> DataFrame:
    """Write a frame to the shared work folder and read it back: short lineage that survives lost executors."""
    path = work_dir(spark, label)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that made them ends; each step is stored, so nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
