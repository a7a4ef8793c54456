"""Analytics over run records: jobs, their tasks and logs, and pipeline dependencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col
from medalith.operators.lookup import missing
from medalith.operators.preview import page
from medalith.session import work_dir

# Task results that make the job fail; a partly ingested pipeline counts as failed.
FAILED_STATUSES = ("failed", "partial")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with fractions; null while one of the stamps is missing."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000)


def iso_time(stamp: Column) -> Column:
    """ISO text of a stamp, with microseconds only when there are any."""
    return F.replace(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(".000000"), F.lit(""))


def job_rollup(tasks: DataFrame) -> DataFrame:
    """Per job: task counts, progress percent, start, end and final status.

    ``tasks`` has job_id, status, started_at, completed_at. A cancelled task makes the job cancelled,
    else a failed one failed; a job with open tasks is running.
    """
    status = F.col("status")
    total = F.count(F.lit(1))
    done, failed = F.count_if(status == "success"), F.count_if(status.isin(*FAILED_STATUSES))
    cancelled = F.count_if(status == "cancelled")
    final = (
        F.when(cancelled > 0, "cancelled")
        .when(failed > 0, "failed")
        .when(done < total, "running")
        .otherwise("success")
    )
    return tasks.groupBy("job_id").agg(
        total.alias("total_tasks"),
        done.alias("completed_tasks"),
        failed.alias("failed_tasks"),
        (done / total * 100).alias("progress_percent"),
        F.min("started_at").alias("started_at"),
        F.max("completed_at").alias("completed_at"),
        final.alias("status"),
    )


def ordered_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks by job and start time with their duration.

    One sorted row per task instead of one list per job: a range sort splits even a job that owns a
    third of the tasks.
    """
    return tasks.withColumn(
        "duration_seconds", seconds_between(F.col("started_at"), F.col("completed_at"))
    ).orderBy("job_id", F.col("started_at").asc_nulls_first(), "task_id")


def recent(df: DataFrame, by: str, limit: int, ties: list[str] = ()) -> DataFrame:
    """The ``limit`` newest rows."""
    return df.orderBy(col(by).desc_nulls_last(), *[col(t) for t in ties]).limit(limit)


def log_page(
    logs: DataFrame, job_id: object, task_id: object = None, limit: int = 100, offset: int = 0, ties: list[str] = ()
) -> DataFrame:
    """One page of a job's log in time order, optionally of one task."""
    rows = logs.filter(F.col("job_id") == job_id)
    if task_id is not None:
        rows = rows.filter(F.col("task_id") == task_id)
    return page(rows, [F.col("timestamp").asc_nulls_last(), *[col(t) for t in ties]], limit, offset)


def latest_log_lines(
    logs: DataFrame, jobs: DataFrame, newest_jobs: int = 10, limit: int = 500, ties: list[str] = ()
) -> DataFrame:
    """The last ``limit`` log rows of the newest jobs, oldest first."""
    chosen = recent(jobs, "started_at", newest_jobs, ["job_id"]).select("job_id")
    rows = logs.join(chosen, "job_id", "left_semi")
    return recent(rows, "timestamp", limit, ties).orderBy(F.col("timestamp").asc_nulls_first(), *[col(t) for t in ties])


def retain(logs: DataFrame, cutoff: Column, timestamp: str = "timestamp") -> DataFrame:
    """Rows at or after the cutoff, and rows without a time."""
    return logs.filter((col(timestamp) >= cutoff) | col(timestamp).isNull())


def missing_dependencies(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (node, dependency) whose dependency is no known node."""
    return missing(edges, nodes, {"dependency": "node"})


def dependency_closure(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Everything each root depends on, as (root, node, depth) with the root itself at depth 0.

    ``edges`` has (node, dependency); without ``roots`` (column ``node``) every node is a root.
    Breadth first: each round joins the newest pairs with the edges and keeps the pairs not yet seen,
    so cycles end. Every round is written below the shared work folder, which cuts the lineage and
    survives the loss of executors.
    """
    spark = edges.sparkSession
    edges = edges.select("node", "dependency")
    if roots is None:
        roots = edges.select("node").union(edges.select(F.col("dependency").alias("node")))
    folder = work_dir(spark, "closure")
    edges.distinct().write.parquet(f"{folder}/edges")
    edges = spark.read.schema(edges.schema).parquet(f"{folder}/edges")
    first = roots.select(F.col("node").alias("root"), "node").distinct()
    first.write.parquet(f"{folder}/depth=0")
    pairs = spark.read.schema(T.StructType([*first.schema.fields, T.StructField("depth", T.IntegerType())]))

    def levels(*depths: int) -> DataFrame:
        return pairs.option("basePath", folder).parquet(*[f"{folder}/depth={d}" for d in depths])

    depth = 0
    while not levels(depth).isEmpty():
        reached = levels(depth).join(edges, "node").select("root", F.col("dependency").alias("node"))
        seen = levels(*range(depth + 1)).select("root", "node")
        depth += 1
        # Distinct and "not seen before" in one grouped pass, hence one shuffle of either side.
        new = (
            reached.withColumn("seen", F.lit(0))
            .unionByName(seen.withColumn("seen", F.lit(1)))
            .groupBy("root", "node")
            .agg(F.max("seen").alias("seen"))
            .filter("seen = 0")
        )
        new.drop("seen").write.parquet(f"{folder}/depth={depth}")
    return levels(*range(max(depth, 1)))


def cyclic_nodes(edges: DataFrame, closure: DataFrame) -> DataFrame:
    """Roots that depend on themselves: a dependency of the closure points back at its root."""
    back = edges.select(F.col("node"), F.col("dependency").alias("root")).distinct()
    return closure.join(back, ["root", "node"], "left_semi").select(F.col("root").alias("node")).distinct()


def execution_order(closure: DataFrame) -> DataFrame:
    """Nodes with a position that puts every node after its dependencies.

    In an acyclic graph a node has strictly more transitive dependencies than each of them, so their
    number is such a position. ``closure`` must have every node as a root.
    """
    return closure.groupBy(F.col("root").alias("node")).agg((F.count(F.lit(1)) - 1).alias("position"))
