"""Work tables in the folder the cluster shares, and independent jobs side by side.

A step that must not be recomputed (positions handed out once, files written for a stream) is
written there as parquet and read back, so a lost executor costs a retry and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

# Names of catalog entries made for work tables.
WORK_ENTRIES = ("hashed_", "staging_")


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, or else the session's warehouse.

    Outside local mode a folder of one machine is refused.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    root = given or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir", None) or ""
    scheme = root.partition(":")[0] if ":" in root else "file"
    if not spark.sparkContext.master.startswith("local") and scheme == "file":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every node can reach")
    return root.rstrip("/")


def work_root(spark: SparkSession) -> str:
    """What this application writes below the shared folder."""
    return f"{shared_root(spark)}/martloom/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once and return the written table: later steps see one fixed set of rows."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """The path and the file system that holds it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    found, files = hadoop_path(spark, path)
    files.delete(found, True)


def drop_work_tables(spark: SparkSession) -> None:
    """Remove every work table of this application, and the catalog entries made for them.

    Call it when the results built from them are written: they are read until then.
    """
    root = work_root(spark)
    inside = root.rpartition(":")[2].lstrip("/") + "/"
    for entry in spark.catalog.listTables():
        if entry.name.startswith(WORK_ENTRIES):
            place = spark.sql(f"DESCRIBE FORMATTED `{entry.name}`").where("col_name = 'Location'")
            if any(inside in r.data_type for r in place.collect()):
                spark.sql(f"DROP TABLE `{entry.name}`")
    remove_folder(spark, root)


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the work tables at the end of the block, also after a failure."""
    try:
        yield
    finally:
        drop_work_tables(spark)


def side_by_side(
    spark: SparkSession, jobs: Mapping[str, Callable[[], Result]], at_once: int = 4
) -> dict[str, Result]:
    """Run independent jobs from `at_once` threads: the last tasks of one leave no core idle."""
    inherits = inheritable_thread_target(spark)
    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(inherits(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in started.items()}
