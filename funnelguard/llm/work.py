"""Work tables in the shared checkpoint folder, and settings for Arrow batches of long texts."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch sent to a Python worker: texts may be long.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20


def _delete(spark: SparkSession, folder: str) -> None:
    # at the end of the application; a JVM that has gone leaves the folder to the cluster's own cleaning
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, deleted when the application ends.

    The setting is read from the session; only a local session (tests) without it gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-work-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex[:12]}"
    atexit.register(_delete, spark, folder)
    return folder


def stored(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """``df`` written to ``path`` and read back: computed once, with its lineage cut."""
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *paths: str) -> None:
    """Delete tables that no later step reads, and let go of the shuffles of finished steps.

    Spark deletes a shuffle's files once the driver's JVM has collected its handle, which in a quiet driver can take long.
    """
    for path in paths:
        _delete(spark, path)
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by bytes as well as rows, for tables of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``doc_id`` and ``text`` (null: empty) alone, so that no other column can clash."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def parts(rows: int, each: int) -> int:
    """Partitions for ``rows`` rows at ``each`` rows a partition."""
    return max(1, -(-rows // each))
