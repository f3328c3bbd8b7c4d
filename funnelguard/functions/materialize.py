"""Materialise small intermediate results as tables in the cluster's checkpoint folder.

Writing a rollup once and reading it back (i) computes it once however
many checks read it, (ii) cuts the lineage, so a lost executor does not
send the recomputation back to the fact scans, and (iii) gives the
planner real file sizes, so joins with the result are broadcast only when
it is measured to be small. The folder is the one the cluster names in
``spark.checkpoint.dir``; without it there is an error, as a lazy plan would
read the fact tables once for every value. ``close()`` deletes the run's
folder; what is left open goes when the application ends.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    return root or None


class Materializer:
    """Writes DataFrames as Parquet tables under one run folder of the checkpoint directory."""

    def __init__(self, spark: SparkSession, label: str, work_dir: str | None = None):
        self.spark = spark
        root = work_dir or checkpoint_root(spark)
        if not root:
            raise ValueError("name a work folder that driver and executors share: work_dir or spark.checkpoint.dir")
        self.folder = f"{root.rstrip('/')}/funnelguard/{label}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._close_quietly)

    def close(self) -> None:
        """Delete the run's folder."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _close_quietly(self) -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            self.close()

    def __call__(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """``by``: a column of few values whose rows are stored apart, so that a reader of one value reads only its files."""
        path = f"{self.folder}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
        # the schema is known: no job to infer it, also where a partition column has no value yet
        schema = df.schema if by is None else T.StructType([f for f in df.schema if f.name != by] + [df.schema[by]])
        return self.spark.read.schema(schema).parquet(path)


def run_concurrently(tasks: Sequence[Callable[[], object]], threads: int,
                     spark: SparkSession | None = None) -> list:
    """Run independent driver-side tasks (each submitting Spark jobs) on a small thread pool.

    Job-group and other local properties of the calling thread are carried
    into the workers, so the jobs stay attributable.
    """
    from pyspark.util import inheritable_thread_target

    if threads <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    session = spark or SparkSession.getActiveSession()
    inherit = inheritable_thread_target(session) if session is not None else inheritable_thread_target
    wrapped = [inherit(task) for task in tasks]
    with ThreadPoolExecutor(max_workers=min(threads, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(task) for task in wrapped]]
